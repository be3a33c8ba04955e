"""Document fingerprints by winnowing.

The k-grams are runs of ``GRAM`` tokens (words; a letter of a script written without spaces is a
token of its own). Of every window of ``WINDOW`` consecutive k-gram hashes the smallest is kept, the
rightmost one on ties, with its position. So two texts that share a run of ``GRAM + WINDOW - 1``
tokens share a fingerprint hash, and none shorter than ``GRAM`` tokens can match by itself.

Hashes and minima are built by doubling (pairs, then pairs of pairs), all in array expressions over
one row: no shuffle and no Python.

Defined results: a null text counts as empty; a text without tokens has the empty fingerprint; with
fewer than ``GRAM`` tokens the whole text is one k-gram, with fewer than ``WINDOW`` k-grams there is
one window; two empty fingerprints have likeness 1, an empty and another 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricbook.llm.common import let, zip_shifted

GRAM, WINDOW = 5, 4
POSITION_BITS = 27  # a string has fewer tokens than 2**27; hashes keep the other 36 bits
#: Letters of scripts written without spaces (Thai, Lao, Myanmar, Khmer, kana, Han): each is a token.
_ALONE = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
TOKEN = rf"[{_ALONE}]|[^\x20\x09-\x0D{_ALONE}]+"


def _last(position: Column) -> Column:
    return F.lit((1 << POSITION_BITS) - 1) - position


def _grams(tokens: Column) -> Column:
    """Hash of every run of GRAM tokens; of all tokens if they are fewer."""
    def pair(a: Column, b: Column) -> Column:
        return F.xxhash64(a, b)

    def of(h: Column) -> Column:
        twos = zip_shifted(h, h, 1, pair)
        fours = let(twos, lambda g: zip_shifted(g, g, 2, pair))
        return F.when(F.size(h) >= GRAM, zip_shifted(fours, h, GRAM - 1, pair)).when(
            F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<long>"))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), of)


def selected(text: Column) -> Column:
    """The selected k-grams as longs, hash above and reversed position below, so that the smallest
    long is the smallest hash with its rightmost position."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    placed = F.transform(_grams(tokens), lambda x, i: F.shiftleft(
        F.shiftrightunsigned(x, POSITION_BITS + 1), POSITION_BITS).bitwiseOR(_last(i.cast("long"))))

    def minima(g: Column) -> Column:
        twos = zip_shifted(g, g, 1, lambda a, b: F.least(a, b))
        fours = let(twos, lambda x: zip_shifted(x, x, 2, lambda a, b: F.least(a, b)))
        return F.when(F.size(g) >= WINDOW, F.array_distinct(fours)).when(
            F.size(g) > 0, F.array(F.array_min(g))).otherwise(g)

    return let(placed, minima)


def as_text(selection: Column) -> Column:
    """``hash:position`` of every selected k-gram, hexadecimal and decimal, space-separated."""
    return F.array_join(F.transform(selection, lambda v: F.concat_ws(
        ":", F.lower(F.hex(F.shiftrightunsigned(v, POSITION_BITS))),
        _last(v.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))).cast("string"))), " ")


def hashes(selection: Column) -> Column:
    return F.array_distinct(F.transform(selection, lambda v: F.shiftrightunsigned(v, POSITION_BITS)))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two hash sets."""
    counts = F.struct(F.size(F.array_intersect(a, b)).alias("shared"), (F.size(a) + F.size(b)).alias("both"))
    return let(counts, lambda x: F.when(x.both == 0, F.lit(1.0)).otherwise(x.shared / (x.both - x.shared)))


def _count_up_to(cuts: list[int], value: Column) -> Column:
    """How many of the sorted ``cuts`` are at most ``value``, looked up in two steps of about sqrt(n)."""
    step = math.isqrt(len(cuts)) + 1
    chunks = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    heads = F.array(*[F.lit(c[0]).cast("long") for c in chunks])
    table = F.array(*[F.array(*[F.lit(x).cast("long") for x in c]) for c in chunks])

    def within(chunk: Column) -> Column:
        return F.when(chunk == 0, 0).otherwise((chunk - 1) * step + F.size(F.filter(
            F.element_at(table, F.greatest(chunk, F.lit(1))), lambda c: c <= value)))

    return let(F.size(F.filter(heads, lambda c: c <= value)), within)


def with_next_row(df: DataFrame, id_col: str, columns: dict[str, str], tie: list[str]) -> DataFrame:
    """Adds columns (new name: column) of the next row in descending ``id_col``; after the last row
    comes the first. Nulls go last; ``tie`` orders rows of one id.

    Rows are dealt into ranges of ids by approximate quantiles (a bounded list); the first rows of a
    range are also sent to the range before, so that no window spans all rows."""
    spark = df.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.agg(F.percentile_approx(id_col, [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
    cuts = sorted(set(cuts or [])) or [0]
    ident = F.col(id_col)
    dealt = df.withColumn("_range", F.when(ident.isNull(), F.lit(-1)).otherwise(_count_up_to(cuts, ident)))
    tops = sorted(((r[0], r[1]) for r in dealt.groupBy("_range").agg(F.max(id_col)).collect()), reverse=True)
    if not tops:
        return df.select("*", *[F.col(c).alias(n) for n, c in columns.items()])
    before = [(r, top, tops[i - 1][0], i == 0) for i, (r, top) in enumerate(tops)]  # the first follows the last
    halo = spark.createDataFrame(before, "_range int, _top long, _before int, _wraps boolean")
    sent = (dealt.join(F.broadcast(halo), "_range")  # one row per range
            .withColumn("_copy", F.explode(F.when(ident.eqNullSafe(F.col("_top")), F.array(F.lit(False), F.lit(True)))
                                           .otherwise(F.array(F.lit(False)))))
            .withColumn("_range", F.when(F.col("_copy"), F.col("_before")).otherwise(F.col("_range")))
            .withColumn("_late", F.col("_copy") & F.col("_wraps")))
    order = Window.partitionBy("_range").orderBy("_late", ident.desc_nulls_last(), *tie, "_copy")
    led = sent.select("*", *[F.lead(c).over(order).alias(n) for n, c in columns.items()])
    return led.where(~F.col("_copy")).drop("_range", "_top", "_before", "_wraps", "_copy", "_late")
