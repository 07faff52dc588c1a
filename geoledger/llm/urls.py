"""URL rules: a blocked Bloom filter over the listed canonical URLs, then an exact hash join.

A rule is a host and the beginning of a path. It fits its host and all subdomains if a URL's path begins with the
rule's. All keys that could fit a URL are few: each suffix of its host at a label's start, with the path cut to each
length that a listed path has. Those the Bloom filter passes go to an exact join with the rules, which removes false
positives; the longest rule that fits wins.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a block, bits set in it per key, and keys per block at which the filter lets through about one in a hundred.
BLOCK_BITS, PROBES, KEYS_PER_BLOCK = 64, 4, 5
#: The filter is broadcast up to so many blocks (16 bytes each); beyond, it is joined by shuffle.
BROADCAST_BLOCKS = 500_000


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, verdict, rule_host, rule_path) of (verdict, host with the beginning of a path) pairs."""
    rows = [(r, v, r.partition("/")[0].lower(), "/" + r.partition("/")[2] if "/" in r else "") for v, r in rules]
    return spark.createDataFrame(rows, "rule string, verdict string, rule_host string, rule_path string")


def _key(host_: Column, path_: Column) -> Column:
    return F.concat(host_, F.lit("\n"), path_)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> Column:
    """The key's bits in its block."""
    h = F.xxhash64(key, F.lit(1))
    out = F.lit(0).cast("long")
    for i in range(PROBES):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(BLOCK_BITS - 1).cast("long")).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """``pages`` with columns host, path, rule and verdict; replaced if ``pages`` has such columns.

    ``rules`` has rule, verdict, rule_host, rule_path and may be large; of repeated rules one is taken, block before
    allow. Of the rules that fit, the longest wins (ties: the longer host, then the smaller text). URLs that no rule
    fits, null ones and those without ``://`` get ``otherwise`` and a null rule. Rows stay as they are, repeated ones
    too; no rules, or no pages, give the same columns.
    """
    listed = rules.groupBy("rule_host", "rule_path").agg(F.max_by(F.struct("rule", "verdict"), "verdict").alias("x"))
    listed = listed.select(_key(F.col("rule_host"), F.col("rule_path")).alias("k"), "x.*", F.length("rule_host").alias("n"))
    # A table of the lengths that listed paths have: at most as many as a URL has characters.
    stats = rules.agg(F.count("*").alias("n"), F.collect_set(F.length("rule_path")).alias("lengths"), F.collect_set(F.size(F.split("rule_host", r"\.", -1))).alias("labels")).first()
    blocks = max(1, math.ceil(stats["n"] / KEYS_PER_BLOCK))
    lengths = F.array(*[F.lit(n) for n in sorted(stats["lengths"])]).cast("array<int>")
    bloom = listed.groupBy(_block(F.col("k"), blocks).alias("block")).agg(F.bit_or(_bits(F.col("k"))).alias("word"))
    if blocks <= BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)

    # A URL's verdict depends on nothing else, so that each is judged once.
    urls = pages.select(F.col(url_col).alias("u")).where(F.col("u").isNotNull()).distinct().select("u", host(F.col("u")).alias("h"), path(F.col("u")).alias("p"))
    labels = F.split("h", r"\.", -1)
    # Only ends of as many labels as a listed host has can be listed.
    sizes = F.array(*[F.lit(n) for n in sorted(stats["labels"])]).cast("array<int>")
    ends = F.transform(F.filter(sizes, lambda n: n <= F.size(labels)), lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    tried = urls.where("h != ''").select("u", "p", F.explode(ends).alias("end"))
    tried = tried.select("u", "end", "p", F.explode(F.filter(lengths, lambda n: n <= F.length("p"))).alias("cut"))
    tried = tried.select("u", _key(F.col("end"), F.expr("substring(p, 1, cut)")).alias("k"))
    passed = tried.withColumn("block", _block(F.col("k"), blocks)).join(bloom, "block").where(F.col("word").bitwiseAND(_bits(F.col("k"))) == _bits(F.col("k")))
    fits = passed.select("u", "k").join(listed, "k")
    best = fits.groupBy("u").agg(F.min_by(F.struct("rule", "verdict"), F.struct(-F.length("rule"), -F.col("n"), "rule")).alias("best"))
    out = pages.drop(*[c for c in ("host", "path", "rule", "verdict") if c != url_col])
    url = out[url_col]
    out = out.join(best, url == best["u"], "left").drop("u")
    return out.withColumns({"host": host(url), "path": path(url), "rule": F.col("best.rule"), "verdict": F.coalesce(F.col("best.verdict"), F.lit(otherwise))}).drop("best")
