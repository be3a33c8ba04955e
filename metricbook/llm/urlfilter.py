"""URL rules through a blocked Bloom filter and an exact hash join.

A listed entry is a canonical ``host/path`` prefix; it fits its host and all subdomains where the
path starts with the listed one. A url's candidate keys are its host suffixes (no more labels than
any listed host has) times its path prefixes (only the lengths that listed paths have), so every
entry that fits is one of them. Candidates first pass a blocked Bloom filter: one block of eight
32-bit words per key, one bit in each word. What passes is joined with the list by key, which takes
out false positives; the longest entry that fits wins.

Defined results: a null url or one without ``://`` has empty host and path, fits nothing and is
allowed; repeated urls are judged once and every row gets the verdict; an empty list allows all;
an entry listed twice with both verdicts blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricbook.llm.common import materialise

WORDS = 8
KEYS_PER_BLOCK = 16  # 16 bits of filter for each key
BROADCAST_BLOCKS = 1 << 18  # blocks of some 50 bytes: the filter is broadcast up to about 13 MB


def _lower(host: Column) -> Column:
    """A-Z only, on both sides alike."""
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return (pages.withColumn("_rest", rest)
            .withColumn("host", _lower(F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1)))
            .withColumn("path", F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1)).drop("_rest"))


def listed(entries: DataFrame) -> DataFrame:
    """Entries (``rule`` like ``host/path``, ``verdict``) as keys; blocking wins over allowing."""
    host = _lower(F.regexp_extract("rule", r"^([^/]*)", 1))
    return (entries.withColumn("key", F.concat(host, F.regexp_extract("rule", r"^[^/]*(.*)$", 1)))
            .groupBy("key").agg(F.max("verdict").alias("verdict"), F.min("rule").alias("rule"))
            .withColumn("key_host", F.regexp_extract("key", r"^([^/]*)", 1)))


def _block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(blocks)).cast("int")


def _bit_in(key: Column, word: int) -> Column:
    return F.expr(f"shiftleft(1, cast(pmod(xxhash64(key, {word + 1}), 32) as int))")


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row per block that holds a key: ``block`` and its words ``w0`` to ``w7``."""
    return (keys.select(_block_of(F.col("key"), blocks).alias("block"),
                        *[_bit_in(F.col("key"), i).alias(f"b{i}") for i in range(WORDS)])
            .groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)]))


def candidates(urls: DataFrame, labels: int, path_lengths: list[int]) -> DataFrame:
    """(host, path, key) for every host suffix and path prefix that a listed entry could equal."""
    hosts = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in range(1, labels + 1)]))
    paths = F.array_distinct(F.filter(
        F.array(*[F.when(F.char_length("path") >= n, F.substring("path", 1, n)) for n in path_lengths]),
        lambda p: p.isNotNull()))
    return (urls.where("host <> ''").select("host", "path", F.explode(hosts).alias("_h"), paths.alias("_p"))
            .select("host", "path", F.col("_h"), F.explode("_p").alias("_p"))
            .select("host", "path", F.concat("_h", "_p").alias("key")))


def judge(pages: DataFrame, entries: DataFrame, keep: list[str], url: str = "url") -> DataFrame:
    """``keep`` columns, ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``."""
    keys = listed(entries)
    facts = keys.agg(F.count("*").alias("n"), F.max(F.size(F.split("key_host", r"\."))).alias("labels"),
                     F.collect_set(F.char_length("key") - F.char_length("key_host")).alias("lengths")).first()
    named = pages.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(url).alias("_url"))
    rows = with_host_and_path(named, "_url").drop("_url")
    out = [F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)]
    if not facts["n"]:
        return rows.select(*out, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    blocks = max(1, math.ceil(facts["n"] / KEYS_PER_BLOCK))
    bloom = bloom_filter(keys, blocks)
    urls = rows.select("host", "path").distinct()
    tried = candidates(urls, facts["labels"], sorted(facts["lengths"])).withColumn("block", _block_of(F.col("key"), blocks))

    def passed(some: DataFrame, bloom: DataFrame) -> DataFrame:
        maybe = some.join(bloom, "block")
        for i in range(WORDS):
            maybe = maybe.where(F.col(f"w{i}").bitwiseAND(_bit_in(F.col("key"), i)) != 0)
        return maybe

    entries_ = keys.select("key", "rule", "verdict")
    if blocks <= BROADCAST_BLOCKS:
        fits = passed(tried, F.broadcast(bloom)).select("host", "path", "key").join(entries_, "key")
    else:
        # Filter and list move, and so do the candidates: each key once, however many urls share it (as they do
        # top-level hosts). Written, the few listed ones meet the candidates of all urls in a join that can be split.
        hit = materialise(passed(tried.select("key", "block").distinct(), bloom).select("key").join(entries_, "key"), "url-hits")
        fits = tried.select("host", "path", "key").join(hit, "key")
    # Longest entry; between equal lengths the longer host, then the text.
    best = F.max_by(F.struct("rule", "verdict"),
                    F.struct(F.char_length("key"), F.char_length(F.substring_index("key", "/", 1)), F.col("key")))
    # Written, so that the join below can be split where many rows have one url, or none.
    winner = materialise(fits.groupBy("host", "path").agg(best.alias("_w")), "url-verdicts")
    # The file is small for what it holds (urls compress well), so its size must not decide for a broadcast.
    return (rows.join(winner.hint("merge"), ["host", "path"], "left")
            .select(*out, "host", "path", F.col("_w.rule").alias("rule"),
                    F.coalesce("_w.verdict", F.lit("allow")).alias("verdict")))
