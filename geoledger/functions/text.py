"""Names, paths, logs and durations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The file name without its last suffix."""
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """The last suffix with its dot; empty without one."""
    return F.regexp_extract(file_name(path), r"(\.[^.]*)$", 1)


def parent(path: Column) -> Column:
    """What stands before the last slash; empty without one."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def first_token(path: Column) -> Column:
    """The file name up to its first dot."""
    return F.substring_index(file_name(path), ".", 1)


def year_in_name(name: Column) -> Column:
    """The second token between underscores as a number; 0 if it isn't one."""
    return F.coalesce(F.get(F.split(stem(name), "_"), F.lit(1)).try_cast("int"), F.lit(0))


def year_in_path(path: Column, default: int = 2024) -> Column:
    """The first part of four digits from 2000 to 2100."""
    years = F.filter(F.split(path, "/"), lambda p: p.rlike(r"^(20\d\d|2100)$"))
    return F.coalesce(F.get(years, F.lit(0)).cast("int"), F.lit(default))


def region_in_path(path: Column, codes: dict[str, str], default: str = "440000") -> Column:
    """The code of the first part that is a known region's name."""
    known = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    found = F.filter(F.split(path, "/"), lambda p: F.map_contains_key(known, p))
    return F.coalesce(F.try_element_at(known, F.get(found, F.lit(0))), F.lit(default))


def result_name(post: Column, pre: Column, county: Column) -> Column:
    return F.format_string("output_%s_%s_%s.shp", post, pre, county)


def duration_text(seconds: Column) -> Column:
    """Hours, minutes and seconds; negative is 0."""
    s = F.greatest(F.floor(seconds), F.lit(0)).cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    minutes = F.concat(m.cast("string"), F.lit("m"), r.cast("string"), F.lit("s"))
    return F.when(h > 0, F.concat(h.cast("string"), F.lit("h"), minutes)).when(m > 0, minutes).otherwise(F.concat(r.cast("string"), F.lit("s")))


def size_text(size: Column) -> Column:
    """Bytes to TB with one decimal."""
    out, value = None, size.cast("double")
    for power, unit in enumerate(("B", "KB", "MB", "GB")):
        text = F.format_string("%.1f " + unit, value / 1024**power)
        out = (F if out is None else out).when(value < 1024 ** (power + 1), text)
    return out.otherwise(F.format_string("%.1f TB", value / 1024**4))


def progress_value(index: Column, total: Column, low: float = 0, high: float = 100) -> Column:
    """Whole progress between two bounds; the lower one for an empty total."""
    part = F.try_divide(index, total) * (high - low) + low
    return F.coalesce(part, F.lit(low)).cast("int")


def nested_progress(value: Column, low: float, high: float) -> Column:
    """Progress of 0 to 100 within a range, to two decimals."""
    return F.round(low + value / 100.0 * (high - low), 2)


def hash_rank(key: Column) -> Column:
    """A number that orders rows at random, but always alike: the first 15 hex digits of the SHA-256."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 15), 16, 10).cast("long")


def log_time(line: Column) -> Column:
    """The time in a log line's first 23 characters; null if there is none."""
    return F.try_to_timestamp(F.translate(F.substring(line, 1, 23), ",", "."), F.lit("yyyy-MM-dd HH:mm:ss.SSS"))


def log_header(line: Column) -> dict[str, Column]:
    """index, total, pre, post and result of a line that begins an attempt; empty texts in other lines."""
    pattern = r"Processing \((\d+)/(\d+)\).*pre=(.*?), post=(.*?) -> (.*)$"
    return {n: F.regexp_extract(line, pattern, i) for i, n in enumerate(("index", "total", "pre", "post", "result"), 1)}
