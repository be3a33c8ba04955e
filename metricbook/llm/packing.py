"""Best-fit packing of token pieces with the linear grouping scheme.

Large pieces are sorted by length and cut into groups of equal cardinality; each counts as long as
the longest of its group. For these few sizes configurations (how many pieces of each group share a
sequence) are optimised one after the other: the best-filling one that holds the largest remaining
size is used as often as the groups allow. Actual pieces then take the places of their group, and
small pieces go best-fit into what is really left.

The driver only ever sees counts per length and per residual (at most ``capacity`` numbers each, for
any number of documents) and turns them into intervals of piece ranks; ranking, placing and laying
out run on Spark. A length that a third of all pieces share is ranked in hash buckets.

Defined results: a null text is empty and packs as the single id 0; repeated rows are packed one by
one; an empty table gives an empty result; only documents longer than ``capacity`` are cut; the
strings of ``added`` tokens are ordinary text where none are given; a text with a run of white space that is too
long for the quicker tokenizer's pattern gets its ids from the JSON tokenizer of the same vocabulary.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricbook.llm.common import materialise, with_running_offset

CAPACITY = 2048
GROUPS = 384  # size groups of the large pieces
LONG_RUN = 100_000
_LONG_RUN = re.compile(rf"\s{{{LONG_RUN}}}")
SMALL_SHARE = 8  # pieces of at most capacity / SMALL_SHARE tokens are small


@lru_cache(maxsize=4)
def tokenizer(path: str, added: tuple[tuple[str, int], ...] = ()):
    """Byte-level BPE of a rank file, and the ids of added tokens, which are cut out of a text first."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(added))


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def default_slow() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@lru_cache(maxsize=4)
def _slow_tokenizer(path: str, plain: bool):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    out.encode_special_tokens = plain
    return out


def encoder(path: str, added: tuple[tuple[str, int], ...], slow: str | None) -> Callable[[str], list[int]]:
    """Ids of a text. The rank file's pattern goes back step by step over a run of white space and gives up at
    some hundred thousand; texts with such a run go to the JSON tokenizer ``slow``."""
    bpe = tokenizer(path, added)
    quick = partial(bpe.encode, allowed_special="all", disallowed_special=()) if added else bpe.encode_ordinary

    def encode(text: str) -> list[int]:
        if slow and len(text) >= LONG_RUN and _LONG_RUN.search(text):
            return _slow_tokenizer(slow, not added).encode(text, add_special_tokens=False).ids
        return quick(text)

    return encode


def default_added() -> dict[str, int]:
    """The added tokens (text: id) of the JSON tokenizer, which the rank file does not hold."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t[how] for t in tokens for how in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("only added tokens that are matched as they stand")
    return {t["content"]: t["id"] for t in tokens}


def pieces(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None,
           capacity: int = CAPACITY, end_id: int = 0, added: dict[str, int] | None = None, slow: str | None = None) -> DataFrame:
    """``keep`` columns, ``piece``, ``start``, ``length`` and ``ids_crc32`` of every piece.

    ``added``: strings that are one token each wherever they stand in a text, and their ids. ``slow``: the JSON
    tokenizer of the vocabulary of ``path``, by default that of the default one."""
    slow = slow or (default_slow() if path is None else None)
    path = path or default_tokenizer()
    special = tuple((added or {}).items())
    chosen = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = chosen.drop("_text").schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, special, slow)
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for at, value in enumerate(batch.column("_text")):
                ids = np.array([*encode(value.as_py() or ""), end_id], "<u4")
                n = len(ids)
                cuts = [0, n] if n <= capacity else [0, *range(n % capacity or capacity, n + 1, capacity)]
                rows += [(at, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                         for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            at, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows)) if rows else [np.empty(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(pa.array(at)) for i in range(len(keep))]
                + [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                names=schema.names)

    return chosen.mapInArrow(run, schema).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                                                 "piece", "start", "length", "ids_crc32")


def fill(first: int, sizes: list[int], counts: list[int], capacity: int) -> dict[int, int]:
    """The configuration (index of a size: copies) that holds ``sizes[first]`` and fills most.

    Subset sums as bit sets; ``sizes`` descend, so later sizes are no larger."""
    room = capacity - sizes[first]
    mask = (1 << (room + 1)) - 1
    reach, history = 1, []
    for i in range(first, len(sizes)):
        copies = min(counts[i] - (i == first), room // sizes[i])
        before = reach
        for _ in range(copies):
            more = reach | (reach << sizes[i]) & mask
            if more == reach:
                break
            reach = more
        history.append((i, copies, before))
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used = {first: 1}
    for i, copies, before in reversed(history):
        for n in range(copies + 1):
            rest = total - n * sizes[i]
            if rest >= 0 and before >> rest & 1:
                if n:
                    used[i] = used.get(i, 0) + n
                total = rest
                break
    return used


def plan_large(histogram: dict[int, int], capacity: int, groups: int) -> tuple[np.ndarray, int]:
    """Intervals (first rank, first sequence, pieces per sequence) over the large pieces in
    descending order of length, and the number of sequences."""
    lengths = sorted(histogram, reverse=True)
    total = sum(histogram.values())
    size = max(1, -(-total // groups))
    before = np.cumsum([0] + [histogram[x] for x in lengths])
    longest = [lengths[int(np.searchsorted(before, at, "right")) - 1] for at in range(0, total, size)]
    group_sizes, left, taken = longest, [min(size, total - at) for at in range(0, total, size)], [0] * len(longest)
    rows, sequences, first = [], 0, 0
    while first < len(left):
        if not left[first]:
            first += 1
            continue
        used = fill(first, group_sizes, left, capacity)
        times = min(left[i] // n for i, n in used.items())
        for i, n in used.items():
            rows.append((i * size + taken[i], sequences, n))
            taken[i] += times * n
            left[i] -= times * n
        sequences += times
    return np.array(sorted(rows), np.int64).reshape(-1, 3), sequences


def plan_small(histogram: dict[int, int], residuals: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit of the small pieces: intervals (first rank, residual class, first sequence of the
    class, pieces per sequence), and the number of new sequences (class ``capacity``)."""
    rooms: dict[int, list[tuple[int, int, int]]] = {r: [(r, 0, n)] for r, n in residuals.items()}
    rows, rank, new = [], 0, 0
    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        while count:
            room = min((r for r, x in rooms.items() if r >= length and x), default=None)
            if room is None:
                opened = -(-count // (capacity // length))
                rooms.setdefault(capacity, []).append((capacity, new, new + opened))
                new += opened
                continue
            origin, a, b = rooms[room].pop()
            copies = room // length
            times = min(b - a, count // copies)
            if not times:
                times, copies = 1, count
            rows.append((rank, origin, a, copies))
            rank += times * copies
            count -= times * copies
            if a + times < b:
                rooms[room].append((origin, a + times, b))
            if room > copies * length:
                rooms.setdefault(room - copies * length, []).append((origin, a, a + times))
    return np.array(rows, np.int64).reshape(-1, 4), new


def _histogram(df: DataFrame, column: str) -> dict[int, int]:
    """Counts per value; the values are lengths or residuals, so at most ``capacity`` of them."""
    return {int(r[0]): int(r[1]) for r in df.groupBy(column).agg(F.count("*")).collect()}


def _ranked(items: DataFrame, histogram: dict[int, int], order: list[str]) -> DataFrame:
    """Adds ``_rank``: place among the items in descending order of length."""
    lengths = sorted(histogram, reverse=True)
    before = np.concatenate(([0], np.cumsum([histogram[x] for x in lengths])[:-1])) if lengths else []
    start = items.sparkSession.createDataFrame([(int(x), int(b)) for x, b in zip(lengths, before)] or [(-1, 0)],
                                               "length long, _before long")
    one = items.withColumn("_one", F.lit(1).cast("long"))
    return (with_running_offset(one, ["length"], order, "_one", "_within", buckets=256)
            .join(F.broadcast(start), "length")  # at most `capacity` rows
            .withColumn("_rank", F.col("_before") + F.col("_within")).drop("_before", "_within", "_one"))


def _place(plan: np.ndarray, fields: str):
    """Column function: rank -> (the interval's fixed values, sequence within the interval)."""
    first, rest = plan[:, 0], plan[:, 1:]

    @F.pandas_udf(fields)
    def placed(rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(first, rank.to_numpy(), "right") - 1
        values = rest[at]
        sequence = values[:, -2] + (rank.to_numpy() - first[at]) // values[:, -1]
        return pd.DataFrame({"room": values[:, 0] if rest.shape[1] == 3 else np.zeros(len(at), np.int64),
                             "sequence": sequence})

    return placed("_rank")


def pack(pieced: DataFrame, keys: list[str], capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (columns ``keys``, ``length`` and any others)."""
    pieced = materialise(pieced, "pack-pieces")
    histogram = _histogram(pieced, "length")
    small_most = capacity // SMALL_SHARE
    parts = {"full": {k: v for k, v in histogram.items() if k == capacity},
             "large": {k: v for k, v in histogram.items() if small_most < k < capacity},
             "small": {k: v for k, v in histogram.items() if k <= small_most}}
    n_full = sum(parts["full"].values())
    large_plan, n_large = plan_large(parts["large"], capacity, groups)
    fields = "room long, sequence long"
    full = _ranked(pieced.where(F.col("length") == capacity), parts["full"], keys) \
        .withColumn("sequence_id", F.col("_rank")).drop("_rank")
    placed = full
    residual_rows = None
    if parts["large"]:
        large = _ranked(pieced.where((F.col("length") > small_most) & (F.col("length") < capacity)), parts["large"], keys)
        large = materialise(large.withColumn("sequence_id", _place(large_plan, fields)["sequence"] + n_full)
                            .drop("_rank"), "pack-large")
        placed = placed.unionByName(large)
        residual_rows = materialise(large.groupBy("sequence_id").agg((capacity - F.sum("length")).alias("room"))
                                    .where("room > 0"), "pack-rooms")
    if parts["small"]:
        rooms = _histogram(residual_rows, "room") if residual_rows is not None else {}
        small_plan, _ = plan_small(parts["small"], rooms, capacity)
        small = _ranked(pieced.where(F.col("length") <= small_most), parts["small"], keys) \
            .withColumn("_at", _place(small_plan, fields)).drop("_rank") \
            .withColumn("room", F.col("_at.room")).withColumn("_n", F.col("_at.sequence")).drop("_at")
        fresh = small.where(F.col("room") == capacity).withColumn("sequence_id", F.col("_n") + n_full + n_large)
        placed = placed.unionByName(fresh.drop("room", "_n"))
        if residual_rows is not None:
            ranked = with_running_offset(residual_rows.withColumn("_one", F.lit(1).cast("long")), ["room"],
                                         ["sequence_id"], "_one", "_n", buckets=256).drop("_one")
            placed = placed.unionByName(small.where(F.col("room") < capacity).join(ranked, ["room", "_n"])
                                        .drop("room", "_n"))
    inside = (Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), *keys)
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long"))
