"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

The filter is a table with one row of four 64-bit words per block.  A key sets one bit in each word
of its block.  A URL whose bits are all set may be listed; only those URLs are joined
with the list by their canonical form, which removes false positives.  Explicit host and path
rules come first.  All steps are DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BITS_PER_KEY = 16
BLOCK_BITS = 256
BROADCAST_BLOCKS = 500_000   # 40-byte blocks (20 MB) up to which the filter is broadcast

#: Verdict, host/path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` and path without a trailing ``/`` or ``.html``; NULL without a host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""),
                                       F.regexp_replace(path, r"(\.html|/)$", "")))


def rule_match(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _bits(key: Column) -> list[Column]:
    """One bit per word of the block, from four independent hashes."""
    return [F.expr(f"shiftleft(1L, cast(pmod(xxhash64(key, {i + 1}), 64) as int))") for i in range(4)]


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3) from distinct non-NULL ``key`` rows; the ORs are combined map-side."""
    rows = keys.select(_block(blocks), *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col("key")))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def judge_urls(pages: DataFrame, listed: DataFrame, url_col: str = "url", listed_col: str = "url",
               rules=RULES) -> DataFrame:
    """All rows and columns of ``pages`` with host, path, rule and verdict.

    The verdict is the longest fitting rule's; without one, ``block`` if the canonical URL is
    listed, else ``allow``.  NULL or malformed URLs have empty host and path, no rule and are allowed.
    Repeated pages are judged alike; repeated, NULL or malformed list entries change nothing; either table
    may be empty.  Columns named like the four new ones are replaced.
    """
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    entries = listed.select(canonical(host_of(F.col(listed_col)), path_of(F.col(listed_col))).alias("key"))
    entries = saved(entries.where("key is not null").distinct())
    blocks = max(1, math.ceil(entries.count() * BITS_PER_KEY / BLOCK_BITS))
    bloom = bloom_filter(entries, blocks)

    row = F.struct(*own).alias("row")       # keeps the caller's columns apart from ours
    u = F.col("row")[url_col]
    base = pages.select(row).select("row", host_of(u).alias("host"), path_of(u).alias("path"))
    base = base.withColumns({"match": rule_match(F.col("host"), F.col("path"), rules),
                             "key": canonical(F.col("host"), F.col("path"))})
    asked = F.col("match").isNull() & F.col("key").isNotNull()
    out = [F.col("row")[c].alias(c) for c in own] + ["host", "path", F.col("match.rule").alias("rule")]
    plain = base.where(~asked).select(*out, F.coalesce("match.verdict", F.lit("allow")).alias("verdict"))
    probe = base.where(asked).withColumn("block", _block(blocks))
    probe = probe.join(F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom, "block", "left")
    set_ = [F.col(f"w{i}").bitwiseAND(b) == b for i, b in enumerate(_bits(F.col("key")))]
    maybe = F.coalesce(set_[0] & set_[1] & set_[2] & set_[3], F.lit(False))
    probe = probe.withColumn("maybe", maybe)
    missed = probe.where(~F.col("maybe")).select(*out, F.lit("allow").alias("verdict"))
    hits = probe.where("maybe").join(entries.select(F.col("key"), F.lit(True).alias("listed")), "key", "left")
    hits = hits.select(*out, F.when(F.col("listed"), "block").otherwise("allow").alias("verdict"))
    return plain.unionByName(missed).unionByName(hits)
