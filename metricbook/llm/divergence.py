"""Divergence audit of sources: how far the term shares of each source lie from those of the other sources
of its language, and which terms it over-uses.

Strings are materialised late. Texts are read once; each task writes its term counts under 64-bit digests
and each term's string only where it first meets it. Everything that counts, joins or ranks then reads and
shuffles fixed-width columns only (digests of group, language and term, and numbers). The one pass over
strings goes from the digests with enough documents to smallest and largest string (a kept term's digest is
always among them). Where these differ, several terms share a digest: the texts are then counted once more
with the string in every row, and the rows of such digests get a second key, the place of the term among
the terms of that digest. Strings come back for kept outputs only.

A sum over all kept terms for each pair of sources is taken apart, so that no zero count is ever a row.
With f00 for a term that neither has, and ``both`` for the terms that both have:
    sum f = sum_both f(p, q) + (sum_own f(p, q0) - the same over both) + (sum_other f(p0, q) - the same over both)
            + f00 * (terms that neither has).
Sums over own terms come from counts of equal counts. Those over both are added up inside the task that
holds a term, so a task returns a row per pair of sources, not per term.

All arithmetic is in integers: shares by 38-digit decimals, as 10^9 * count may pass 64 bits. A share is
at most 10^9 + 1, and shares of up to 10^9 terms add up to at most 2 * 10^9, so every sum of f stays below
2^63.

Defined results: null text, language or source count as empty strings; texts without terms only name their
group; a language without kept terms has pairs of value 0 and no terms; repeated rows count each time; an
empty table gives an empty result; ties rank by the item's UTF-8 bytes; other columns play no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricbook.llm.common import materialise

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
HELD = 1 << 22  # occurrences of terms a task holds before it counts and writes them
HELD_BYTES = 1 << 25  # bytes of text, likewise: terms may be long
KNOWN = 1 << 20  # terms a task has numbered at most; it begins anew from half of them
KNOWN_BYTES = 1 << 27  # bytes of text after which it does so too
ROWS_AT_ONCE = 1 << 16  # rows in a batch that a task returns
PAIRS_AT_ONCE = 1 << 18  # pairs of sources handled in one numpy step
DIGEST_BITS = 64
TERM = ["tid", "lid", "split"]

_UPPER, _LOWER = range(0x41, 0x5B), range(0x61, 0x7B)
#: Bytes of a term stay, A-Z become a-z, all others a blank. Bytes from 0x80 belong to characters beyond ASCII.
_FOLD = bytes(b if b in _LOWER or b >= 0x80 else b + 32 if b in _UPPER else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in a UTF-8 text, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def _groups(docs: DataFrame) -> tuple[DataFrame, int]:
    """(lang, source, gid, lid) of every occurring group; and the seed under which the digests differ."""
    found = materialise(docs.select("lang", "source").distinct(), "divergence-groups")
    seed = 0
    while True:
        keyed = found.select("lang", "source", *_group_ids(seed))
        told = keyed.agg(F.count("*") == F.count_distinct("gid"), F.count_distinct("lang") == F.count_distinct("lid")).first()
        if told[0] and told[1]:
            return keyed, seed
        seed += 1


def _group_ids(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), "lang", "source").alias("gid"), F.xxhash64(F.lit(seed), "lang").alias("lid")]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in ascending order, and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.diff(np.append(first, len(values)))


def task_counts(docs: DataFrame, seed: int, digest_bits: int = DIGEST_BITS, every: bool = False) -> DataFrame:
    """Per task: (gid, lid, tid, n occurrences, docs with the term, term); one key may come several times.

    ``term`` is null but in one row of each term of a task; with ``every`` each row has it."""
    schema = "gid long, lid long, tid long, n long, docs long, term string"
    mask = (1 << digest_bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)  # of the terms, in order of first sight
        tids = np.empty(0, np.uint64)  # of the terms already written
        groups: dict[tuple[int, int], int] = {}
        held: list[np.ndarray] = []  # the terms of each text by number
        group_of: list[int] = []
        occurrences = size = seen = 0

        def counted() -> Iterator[pa.RecordBatch]:
            nonlocal tids
            written, terms_ = len(tids), len(numbers)
            fresh = list(islice(numbers, written, None))
            tids = np.concatenate((tids, np.fromiter((xxhash.xxh64_intdigest(t) & mask for t in fresh), np.uint64, len(fresh))))
            ids, sizes, of = np.concatenate(held), np.fromiter(map(len, held), np.int64, len(held)), np.array(group_of)
            keys, n = _runs(np.repeat(of * terms_, sizes) + ids)
            once, _ = _runs(np.repeat(np.arange(len(held)) * terms_, sizes) + ids)
            doc, number = np.divmod(once, terms_)
            _, n_docs = _runs(of[doc] * terms_ + number)  # has the same keys
            group, number = np.divmod(keys, terms_)
            if every:
                strings, chosen = pa.array(numbers, pa.binary()), pa.array(number)
            else:
                where = np.flatnonzero(number >= written)
                place = np.empty(len(fresh), np.int64)
                place[number[where] - written] = where  # one row per fresh term, the last one assigned
                other = np.ones(len(keys), bool)
                other[place] = False
                strings, chosen = pa.array(fresh, pa.binary()), pa.array(np.where(other, 0, number - written), mask=other)
            ends = np.array(list(groups), np.int64)
            table = pa.table([pa.array(ends[group, 0]), pa.array(ends[group, 1]), pa.array(tids[number].view(np.int64)), pa.array(n),
                              pa.array(n_docs), strings.cast(pa.string()).take(chosen)],
                             names=["gid", "lid", "tid", "n", "docs", "term"])
            yield from table.to_batches(max_chunksize=ROWS_AT_ONCE)

        for batch in batches:
            for gid, lid, text in zip(*(batch.column(c) for c in ("gid", "lid", "text"))):
                text = text.as_py()
                own = terms(text)
                if own:
                    held.append(np.fromiter(map(numbers.__getitem__, own), np.int32, len(own)))
                    group_of.append(groups.setdefault((gid.as_py(), lid.as_py()), len(groups)))
                    occurrences += len(own)
                    size += len(text)
                if occurrences > HELD or size > HELD_BYTES or len(numbers) > KNOWN:
                    yield from counted()
                    held, group_of, groups, seen, occurrences, size = [], [], {}, seen + size, 0, 0
                    if len(numbers) > KNOWN // 2 or seen > KNOWN_BYTES:
                        numbers, tids, seen = defaultdict(count().__next__), tids[:0], 0
        if held:
            yield from counted()

    return docs.select(*_group_ids(seed), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _kept(partial: DataFrame, keys: list[str], min_docs: int) -> DataFrame:
    """Per group and term (``keys``) of at least ``min_docs`` documents of the language: (gid, keys, n, lang_n, first).
    ``first`` holds in one row of each term of a language. Partitioned by term once, so that all of it is one shuffle."""
    of_term = Window.partitionBy(*keys)
    return (partial.repartition(*keys).groupBy("gid", *keys).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .select("gid", *keys, "n", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("docs"),
                    (F.col("gid") == F.min("gid").over(of_term)).alias("first"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def _kept_terms(docs: DataFrame, seed: int, digest_bits: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``_kept``, with ``split`` 0 where a digest has one term, and (tid, split, term)."""
    partial = materialise(task_counts(docs, seed, digest_bits), "divergence-tasks")
    rows = materialise(_kept(partial, ["tid", "lid"], min_docs).withColumn("split", F.lit(0)), "divergence-rows")
    vocabulary = materialise(partial.where("term is not null").select("tid", "term")
                             .join(rows.where("first").select("tid"), "tid", "left_semi")
                             .groupBy("tid").agg(F.min("term").alias("least_term"), F.max("term").alias("greatest_term")),
                             "divergence-vocabulary")
    shared = materialise(vocabulary.where("least_term <> greatest_term").select("tid"), "divergence-collisions")
    names = vocabulary.where("least_term = greatest_term").select("tid", F.lit(0).alias("split"), F.col("least_term").alias("term"))
    if shared.isEmpty():
        return rows, names
    partial = materialise(task_counts(docs, seed, digest_bits, every=True), "divergence-tasks")
    place = F.row_number().over(Window.partitionBy("tid").orderBy("term"))
    spread = materialise(partial.join(shared, "tid", "left_semi").select("tid", "term").distinct()
                         .select("tid", "term", place.alias("split")), "divergence-splits")
    alone = partial.join(shared, "tid", "left_anti").withColumn("split", F.lit(0))
    rows = _kept(alone.unionByName(partial.join(spread, ["tid", "term"])), TERM, min_docs)
    return materialise(rows, "divergence-rows"), names.unionByName(spread.select("tid", "split", "term"))


def _share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total), exact; by decimals where a product may pass 64 bits."""
    wide = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)"), total.cast("decimal(20,0)"))
    return F.lit(1) + F.when(count < 9 * SCALE, F.call_function("div", F.lit(SCALE).cast("long") * (count + 1), total)).otherwise(wide)


def _f(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _sums_over_both(rows: DataFrame) -> DataFrame:
    """Per ordered pair of groups (s, t), added up over the terms that both have: their number ``n_both``,
    ``a`` = f(p_s, p_t), ``b`` = f(p_s, p0_t), ``c`` = f(p0_s, p_t).

    ``rows``: one per term and group, with share ``p`` and the group's share ``p0`` of a term it lacks."""
    schema = "s long, t long, n_both long, a long, b long, c long"
    names = ["s", "t", "n_both", "a", "b", "c"]

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        d = p - q
        return ((d * d).view(np.uint64) // q.view(np.uint64)).view(np.int64)  # quicker than signed, both are positive

    def added(s: np.ndarray, t: np.ndarray, gids: np.ndarray, *values: np.ndarray) -> np.ndarray:
        """One block of pairs (places in ``gids``), added up at once where that takes no more room than the block may."""
        if len(gids) ** 2 > PAIRS_AT_ONCE:
            return np.column_stack((gids[s], gids[t], np.ones(len(s), np.int64), *values))
        key = s * len(gids) + t
        n = np.bincount(key, minlength=len(gids) ** 2)
        met = np.flatnonzero(n)
        sums = np.zeros((len(values), len(n)), np.int64)
        for total, value in zip(sums, values):
            np.add.at(total, key, value)
        s, t = np.divmod(met, len(gids))
        return np.column_stack((gids[s], gids[t], n[met], *(total[met] for total in sums)))

    def summed(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        if not len(rows):
            return rows
        first = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1))))
        return np.column_stack((rows[first, :2], np.add.reduceat(rows[:, 2:], first, axis=0)))

    def batch_of(x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(6)], names=names)

    def pairs_of(x: np.ndarray) -> Iterator[np.ndarray]:
        """Blocks of pairs from whole terms (columns tid, lid, split, gid, p, p0)."""
        gids, group = np.unique(x[:, 3], return_inverse=True)
        all_p, all_p0 = np.ascontiguousarray(x[:, 4]), np.ascontiguousarray(x[:, 5])
        begin = np.flatnonzero(np.concatenate(([True], (x[1:, :3] != x[:-1, :3]).any(axis=1))))
        size = np.diff(np.append(begin, len(x)))
        wide, start = np.repeat(size, size), np.repeat(begin, size)  # each row meets the rows of its term
        ends = np.cumsum(wide)
        at = 0
        while at < len(x):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
            w = wide[at:stop]
            left = np.repeat(np.arange(at, stop), w)
            right = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w - start[at:stop], w)
            left, right = left[left != right], right[left != right]
            p, q, p0, q0 = all_p[left], all_p[right], all_p0[left], all_p0[right]
            yield added(group[left], group[right], gids, f(p, q), f(p, q0), f(p0, q))
            at = stop

    def whole_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        rest = np.empty((0, 6), np.int64)
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                                 for c in (*TERM, "gid", "p", "p0")])
            x = np.concatenate((rest, x))
            last = np.flatnonzero((x[:, :3] != x[-1:, :3]).any(axis=1))
            stop = last[-1] + 1 if len(last) else 0  # the last term may go on in the next batch
            rest = x[stop:]
            if stop:
                yield x[:stop]
        if len(rest):
            yield rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = 0, []
        for x in whole_terms(batches):
            for block in pairs_of(x):
                total.append(block)
                held += len(block)
                if held > 4 * PAIRS_AT_ONCE:
                    total = [summed(total)]
                    held = len(total[0])
                    if held > 2 * PAIRS_AT_ONCE:  # more pairs of sources than a task should keep
                        yield batch_of(total[0])
                        held, total = 0, []
        if total:
            yield batch_of(summed(total))

    sums = (rows.select(*TERM, "gid", "p", "p0").repartition(*TERM).sortWithinPartitions(*TERM).mapInArrow(run, schema))
    return sums.groupBy("s", "t").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in names[2:]])


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
          top: int = TOP, digest_bits: int = DIGEST_BITS) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value`` and ``rank``.

    ``digest_bits`` below 64 serves tests: collisions are then common, the result is the same."""
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((text, "text"), (lang, "lang"), (source, "source"))])
    groups, seed = _groups(docs)
    rows, names = _kept_terms(docs, seed, digest_bits, min_docs)

    of_lang = rows.groupBy("lid").agg(F.count_if("first").alias("v"), F.sum("n").alias("lang_total"))
    of_group = rows.groupBy("gid").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
    # A language without kept terms has no share; 1 stands for its denominator, which nothing uses.
    over = {c: F.greatest(F.col(c) + F.col("v"), F.lit(1)) for c in ("total", "lang_total")}
    zero = F.lit(0).cast("long")
    facts = materialise(groups.join(of_lang, "lid", "left").join(of_group, "gid", "left")
                        .fillna(0, ["v", "k", "total", "lang_total"])
                        .select("gid", "lid", "lang", "source", "v", "k", over["total"].alias("over"),
                                over["lang_total"].alias("lang_over"), _share(zero, over["total"]).alias("p0")),
                        "divergence-facts")
    shares = materialise(rows.join(facts.select("gid", "over", "lang_over", "p0"), "gid")
                         .select("gid", *TERM, _share(F.col("n"), F.col("over")).alias("p"), "p0",
                                 _share(F.col("lang_n"), F.col("lang_over")).alias("q")), "divergence-shares")
    return _pairs(shares, facts).unionByName(_terms(shares, facts, names, top))


def _pairs(shares: DataFrame, facts: DataFrame) -> DataFrame:
    both = materialise(_sums_over_both(shares), "divergence-both")
    equal = materialise(shares.groupBy("lid", "gid", "p").agg(F.count("*").alias("times")), "divergence-equal")
    other = facts.select("lid", F.col("gid").alias("other"), F.col("p0").alias("z"))
    # One pass for both directions: f(p, z) where the other lacks the term, f(z, p) seen from the other.
    one_sided = materialise(equal.join(other, "lid").where("gid <> other").groupBy("gid", "other").agg(
        *[F.sum((f * F.col("times").cast("decimal(18,0)"))).cast("decimal(38,0)").alias(c)
          for c, f in (("own", _f("p", "z").cast("decimal(19,0)")), ("seen", _f("z", "p").cast("decimal(19,0)")))]),
        "divergence-one-sided")
    pairs = (facts.select("lid", "lang", "source", F.col("gid").alias("s"), "v", F.col("k").alias("k_s"), F.col("p0").alias("p0_s"))
             .join(facts.select("lid", F.col("source").alias("item"), F.col("gid").alias("t"), F.col("k").alias("k_t"),
                                F.col("p0").alias("p0_t")), "lid").where("s <> t")
             .join(both, ["s", "t"], "left")
             .join(one_sided.select(F.col("gid").alias("s"), F.col("other").alias("t"), "own"), ["s", "t"], "left")
             .join(one_sided.select(F.col("other").alias("s"), F.col("gid").alias("t"), "seen"), ["s", "t"], "left")
             .fillna(0, ["n_both", "a", "b", "c", "own", "seen"]))
    neither = F.col("v").cast("decimal(20,0)") - F.col("k_s") - F.col("k_t") + F.col("n_both")
    value = (F.col("a") + F.col("own") - F.col("b") + F.col("seen") - F.col("c")
             + neither.cast("decimal(19,0)") * _f("p0_s", "p0_t").cast("decimal(19,0)"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (pairs.select("lang", "source", F.lit("pair").alias("part"), "item",
                         F.when(F.col("v") > 0, value).otherwise(F.lit(0)).cast("long").alias("value"))
            .withColumn("rank", F.row_number().over(order).cast("int")))


def _terms(shares: DataFrame, facts: DataFrame, names: DataFrame, top: int) -> DataFrame:
    """The ``top`` over-used terms of each group. The value of the last place comes from digests alone; only
    terms of at least that value get their string, which then settles ties."""
    valued = shares.where("p > q").select("gid", "tid", "split", _f("p", "q").alias("value"))
    by_value = Window.partitionBy("gid").orderBy(F.col("value").desc(), "tid", "split")
    least = materialise(valued.withColumn("_place", F.row_number().over(by_value)).where(F.col("_place") <= top)
                        .groupBy("gid").agg(F.min("value").alias("least")), "divergence-least")
    named = (valued.join(least, "gid").where("value >= least").join(names, ["tid", "split"])
             .select("gid", "term", "value"))
    order = Window.partitionBy("gid").orderBy(F.col("value").desc(), "term")
    ranked = materialise(named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "divergence-terms")
    return ranked.join(facts, "gid").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                            "value", F.col("rank").cast("int").alias("rank"))
