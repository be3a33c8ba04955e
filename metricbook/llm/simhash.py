"""SimHash near-duplicate groups by a binary trie self-join.

Fingerprints that differ in at most ``max_bits`` of 64 bits agree on at least one of
``max_bits + 1`` bit blocks. For each block the fingerprints are rotated so that this block leads:
the subtrees below one block value are disjoint tries, and each is joined with itself. A join walks
pairs of trie nodes of equal depth together, adds up the bits in which their paths differ and drops
a pair as soon as that exceeds the budget. A subtree with too many fingerprints is cut further into
pairs of deeper nodes that still fit the budget, each its own unit of work.

Links found in one task are united there, so a task returns at most one row per fingerprint instead
of all pairs; the components of the whole corpus then come from star contraction on Spark.

Defined results: a null text counts as empty; a text without words has fingerprint zero and links
like any other; fewer words than a shingle give one shingle of all words; repeated rows share a
component; an empty table gives an empty result; null ids rank after all others. Links and components
are between fingerprints, so ids may be null or repeat; the smallest id only names a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricbook.llm.common import materialise

SPLIT_ROWS = 32_768  # a subtree with more fingerprints than this is cut into deeper node pairs
PAIRS_AT_ONCE = 1 << 15  # node pairs walked in one numpy step; times LEAF_PAIRS bounds its memory
LEAF_PAIRS = 64  # node pairs with so few fingerprint pairs are compared at once


def fingerprint(text: str | None, shingle_words: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles (A-Z lower-cased, repeats counted)."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle_words, len(tokens))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in
                          zip(starts[: len(tokens) - k + 1].tolist(), ends[k - 1:].tolist())),
                         np.uint64, len(tokens) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle_words: int = 4) -> DataFrame:
    """``keep`` columns and ``fp`` (the 64 bits as a signed long)."""
    chosen = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = chosen.drop("_text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle_words) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(np.array(fps, np.uint64).view(np.int64))],
                names=[f"_k{i}" for i in range(len(keep))] + ["fp"])

    out = chosen.mapInArrow(run, schema)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "fp")


class Forest:
    """Union-find over row numbers, on arrays."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        up = self.parent[x]
        while True:
            higher = self.parent[up]
            if np.array_equal(higher, up):
                return up
            self.parent[x] = higher
            up = higher

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _first_one(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Per node [lo, hi): where its right child begins, the first value with the bit set."""
    low, high = lo.copy(), hi.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high) >> 1
        one = (values[np.minimum(mid, len(values) - 1)] >> bit) & np.uint64(1) == 1
        high = np.where(open_ & one, mid, high)
        low = np.where(open_ & ~one, mid + 1, low)


def _spans(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices lo..lo+size-1 of all spans, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - lo, size)


def trie_join(values: np.ndarray, roots: np.ndarray, max_bits: int, forest: Forest) -> None:
    """Unites rows of linked fingerprints. ``roots``: rows (a_lo, a_hi, b_lo, b_hi, depth, differing
    bits so far) of node pairs, each node a sorted run of ``values`` with a common path."""
    stack = [roots]
    while stack:
        pairs = stack.pop()
        if len(pairs) > PAIRS_AT_ONCE:
            stack.append(pairs[PAIRS_AT_ONCE:])
            pairs = pairs[:PAIRS_AT_ONCE]
        na, nb = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        pairs, na, nb = (x[(na > 0) & (nb > 0)] for x in (pairs, na, nb))
        done = (na * nb <= LEAF_PAIRS) | (pairs[:, 4] >= 64)
        leaf = pairs[done]
        if len(leaf):
            a_of = np.repeat(np.arange(len(leaf)), na[done])
            a = _spans(leaf[:, 0], na[done])
            wide = nb[done][a_of]
            left, right = np.repeat(a, wide), _spans(leaf[a_of, 2], wide)
            near = np.bitwise_count(values[left] ^ values[right]) <= max_bits
            near &= left < right
            forest.unite(left[near], right[near])
        node = pairs[~done]
        if not len(node):
            continue
        bit = (63 - node[:, 4]).astype(np.uint64)
        a_mid, b_mid = (_first_one(values, node[:, i], node[:, i + 1], bit) for i in (0, 2))
        self_pair = (node[:, 0] == node[:, 2]) & (node[:, 1] == node[:, 3])
        depth, differ = node[:, 4] + 1, node[:, 5]
        children = [
            np.column_stack((node[:, 0], a_mid, node[:, 2], b_mid, depth, differ)),
            np.column_stack((a_mid, node[:, 1], b_mid, node[:, 3], depth, differ)),
            np.column_stack((node[:, 0], a_mid, b_mid, node[:, 3], depth, differ + 1)),
            np.column_stack((a_mid, node[:, 1], node[:, 2], b_mid, depth, differ + 1))[~self_pair]]
        following = np.concatenate(children)
        stack.append(following[following[:, 5] <= max_bits])


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit from the left, length) of max_bits + 1 blocks that share 64 bits."""
    n = max_bits + 1
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(n)]


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Edges (u, v) between representatives: a spanning forest of the links inside each subtree.

    ``distinct``: one row per fingerprint, ``fp`` long and ``rep`` long."""
    spec = _blocks(max_bits)

    def rotated(first: int):
        fp = F.col("fp")
        return fp if first == 0 else F.shiftleft(fp, first).bitwiseOR(F.shiftrightunsigned(fp, 64 - first))

    rows = (distinct.select("rep", F.inline(F.array(*[
        F.struct(F.lit(i).alias("block"), rotated(a).alias("rot"),
                 F.shiftrightunsigned(rotated(a), 64 - n).alias("head")) for i, (a, n) in enumerate(spec)]))))
    # How many more levels a large subtree is cut: its node pairs become separate units of work.
    heavy = (rows.groupBy("block", "head").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT_ROWS)
             .select("block", "head", F.least(F.ceil(F.log2(F.col("n") / SPLIT_ROWS)), F.lit(10))
                     .cast("int").alias("levels")))
    widths = F.array(*[F.lit(n) for _, n in spec])
    cut = (rows.join(heavy, ["block", "head"], "left")
           .withColumn("levels", F.coalesce("levels", F.lit(0)))
           .withColumn("width", F.element_at(widths, F.col("block") + 1))
           .withColumn("node", F.when(F.col("levels") == 0, F.lit(0)).otherwise(F.expr(
               "cast(shiftrightunsigned(shiftleft(rot, width), 64 - levels) as int)"))))
    partners = F.when(F.col("levels") == 0, F.array(F.lit(0))).otherwise(F.expr(
        f"filter(sequence(0, shiftleft(1, levels) - 1), x -> bit_count(x ^ node) <= {max_bits})"))
    units = (cut.withColumn("other", F.explode(partners))
             .select("block", "head", "levels", F.least("node", "other").alias("a"),
                     F.greatest("node", "other").alias("b"), (F.col("node") > F.col("other")).alias("side"),
                     "rot", "rep"))
    lengths = [n for _, n in spec]

    def join_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
            n = len(cols["rot"])
            values = cols["rot"].view(np.uint64)
            keys = np.column_stack([cols[c] for c in ("block", "head", "a", "b", "side")])
            new = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], n)
            at = keys[begin]
            depth = np.array(lengths)[at[:, 0]] + cols["levels"][begin]
            own = at[:, 2] == at[:, 3]
            roots = [np.column_stack((begin, end, begin, end, depth, np.zeros_like(begin)))[own]]
            first = np.flatnonzero(~own[:-1] & ~own[1:] & (at[:-1, :4] == at[1:, :4]).all(axis=1))
            roots.append(np.column_stack((begin[first], end[first], begin[first + 1], end[first + 1], depth[first],
                                          np.bitwise_count(at[first, 2] ^ at[first, 3]))))
            forest = Forest(n)
            trie_join(values, np.concatenate(roots).astype(np.int64), max_bits, forest)
            root = forest.find(np.arange(n))
            moved = np.flatnonzero(root != np.arange(n))
            return pa.RecordBatch.from_arrays([pa.array(cols["rep"][moved]), pa.array(cols["rep"][root[moved]])],
                                              names=["u", "v"])

        held: list[dict[str, np.ndarray]] = []
        rows_held = 0
        names = ("block", "head", "levels", "a", "b", "side", "rot", "rep")
        for batch in batches:
            held.append({c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names})
            rows_held += batch.num_rows
            if rows_held < 1 << 19:
                continue
            cols = {c: np.concatenate([h[c] for h in held]) for c in names}
            unit = np.column_stack([cols[c] for c in ("block", "head", "a", "b")])
            last = np.flatnonzero((unit != unit[-1]).any(axis=1))
            if len(last):  # whole units only; the last one may go on in the next batch
                stop = last[-1] + 1
                yield solve({c: x[:stop] for c, x in cols.items()})
                cols = {c: x[stop:] for c, x in cols.items()}
            held, rows_held = [cols], len(cols["rot"])
        if rows_held:
            yield solve({c: np.concatenate([h[c] for h in held]) for c in names})

    # The rotated values sort as unsigned numbers, as a trie does, once their top bit is flipped.
    return (units.repartition("block", "head", "a", "b")
            .withColumn("_sort", F.col("rot").bitwiseXOR(F.expr("shiftleft(1L, 63)")))
            .sortWithinPartitions("block", "head", "a", "b", "side", "_sort").drop("_sort")
            .mapInArrow(join_units, "u long, v long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge: the smallest node reachable.

    Alternating star contraction; each round is written to the shared folder, and only a count and
    a checksum reach the driver."""
    state = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "edges")
    mark = None
    while True:
        seen = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        mark = seen
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m")
                 .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        state = materialise(small, "edges")


def near_duplicates(docs: DataFrame, id_col: str, keep: list[str], text: str = "text", shingle_words: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """``keep`` columns, ``fp``, ``component`` (smallest ``id_col`` reachable, null where all are) and
    ``component_fp`` (smallest fingerprint reachable, never null) for every row.

    Only ``component_fp`` tells components apart: two of them may have the same smallest id, or none."""
    columns = list(dict.fromkeys([id_col, *keep]))
    fps = materialise(fingerprints(docs, columns, text, shingle_words), "simhash")
    distinct = materialise(fps.groupBy("fp").agg(F.min(id_col).alias("_id")), "simhash-distinct")
    comp = components(links(distinct.select("fp", F.col("fp").alias("rep")), max_bits))
    grouped = materialise(distinct.join(comp, distinct.fp == comp.node, "left")
                          .select("fp", "_id", F.coalesce("component", "fp").alias("component_fp")), "simhash-grouped")
    # Written, so that the join below is between plain exchanges and a large component can be split.
    named = materialise(grouped.groupBy("component_fp").agg(F.min("_id").alias("component")), "simhash-named")
    labelled = grouped.join(named, "component_fp").select("fp", "component", "component_fp")
    return fps.join(labelled, "fp").select(*keep, "fp", "component", "component_fp")
