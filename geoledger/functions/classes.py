"""Land-cover codes and scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fine classes by major class, for the two fine legends, and the major classes' names.
MAJOR_OF_14 = {1: [1, 2], 2: [3, 4], 3: [5], 4: [11], 5: [6, 7, 8, 9], 6: [10, 12, 13]}
MAJOR_OF_31 = {1: [1, 2], 2: [*range(3, 14)], 3: [*range(14, 18)], 4: [25, 30], 5: [*range(18, 25), 26, 28, 29], 6: [27]}
NAMES = {1: "cropland", 2: "woodland", 3: "grassland", 4: "water", 5: "built-up", 6: "bare land"}
UNKNOWN = "unknown"
TRUE_WORDS = ("1", "true", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "no", "n", "off", "")


def _lookup(code: Column, groups: dict[int, list[int]]) -> Column:
    out = None
    for major, fine in groups.items():
        out = (F if out is None else out).when(code.isin(fine), F.lit(major))
    return out.otherwise(F.lit(0))


def major_class(code: Column) -> Column:
    """The major class, 0 to 6, of a fine class of the 14-class legend; anything else, null too, is 0."""
    return _lookup(code, MAJOR_OF_14)


def major_class_31(code: Column) -> Column:
    """The same for the 31-class legend."""
    return _lookup(code, MAJOR_OF_31)


def collapsed_land_use(code: Column) -> Column:
    """111 to 115 become 11 and 121 to 125 become 12; other codes stay."""
    return F.when(code.between(111, 115), 11).when(code.between(121, 125), 12).otherwise(code)


def class_name(code: Column) -> Column:
    """Name of a code given as a number or text; null, unknown and non-numeric codes have the name of the unknown."""
    number = code.cast("string").try_cast("double").cast("int")
    names = F.create_map(*[x for k, v in NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(names, number), F.lit(UNKNOWN))


def kept_class(code: Column, keep: int) -> Column:
    """The class where it is the one to keep, else 0."""
    return F.when(code == keep, code).otherwise(0)


def has_padded_code(code: Column, keep: str) -> Column:
    """Whether the code, padded to two digits, is the one to keep."""
    return F.lpad(code.cast("string"), 2, "0") == keep


def forced_class(code: Column, wanted: int | list[int], foreground: int = 1) -> Column:
    """A list: its members become its first, others 0. One class: others become 0. Class 1 then becomes the foreground."""
    out = F.when(code.isin(wanted), F.lit(wanted[0])).otherwise(0) if isinstance(wanted, list) else kept_class(code, wanted)
    return F.when(out == 1, F.lit(foreground)).otherwise(out)


def as_bool(text: Column) -> Column:
    """The usual words for true and false, any case; other words are an error, null stays null."""
    word = F.lower(F.trim(text))
    wrong = F.raise_error(F.concat(F.lit("not a boolean: "), word)).cast("boolean")
    return F.when(text.isNull(), F.lit(None).cast("boolean")).when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(wrong)


def clamped(text: Column, low: float, high: float, default: float) -> Column:
    """A number within bounds; what isn't one becomes the default."""
    number = text.try_cast("double")
    return F.when(number.isNull(), F.lit(float(default))).otherwise(F.greatest(F.least(number, F.lit(float(high))), F.lit(float(low))))


def is_harmless(message: Column, markers: list[str]) -> Column:
    """Whether a message holds any of the markers, whatever the case."""
    found = F.lit(False)
    for m in markers:
        found = found | F.contains(F.lower(message), F.lit(m.lower()))
    return F.coalesce(found, F.lit(False))


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def softmax(scores: Column) -> Column:
    """Probabilities of an array of scores; the largest is taken off first, so that nothing overflows."""
    # An expression within a lambda is worked out for each element again; an array of one makes it the lambda's variable.
    once = lambda value, use: F.transform(F.array(value), use)[0]
    exps = once(F.array_max(scores), lambda top: F.transform(scores, lambda x: F.exp(x - top)))
    shares = lambda e: once(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(e, lambda x: x / total))
    return once(exps, shares)


def binary_mask(x: Column) -> Column:
    """1 where the probability of a score rounds, half to even, to 1."""
    return F.bround(logistic(x), 0).cast("int")


def best_class(scores: Column) -> Column:
    """Index, from 0, of the largest score; the first of equal ones."""
    return F.array_position(scores, F.array_max(scores)).cast("int") - 1


def no_data(pre: list[Column], post: list[Column]) -> Column:
    """Whether the 8-bit products, which wrap at 256, of both dates' bands are all 0."""
    out = F.lit(True)
    for a, b in zip(pre, post, strict=True):
        out = out & ((a * b) % 256 == 0)
    return out


def has_value_in_all(bands: list[Column], value: float) -> Column:
    """Whether each band has the given value; null and not-a-number never have."""
    out = F.lit(True)
    for b in bands:
        out = out & F.coalesce((b == F.lit(value)) & ~F.isnan(b.cast("double")), F.lit(False))
    return out
