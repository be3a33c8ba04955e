"""Mixing sources to target weights.

The words of each source, document after document, form one stream that is cut into blocks of
``block_words``. A source's target (its weight's share of all words, at most ``max_epochs`` times
the source, the excess going to the others by weight) fixes how many slots of the output it fills.
First the source counts of each output shard are drawn, multinomial given every source's total, which stays
on its target. A source's slots are then numbered shard after shard; the number gives the epoch and, through
a pseudorandom permutation of the source's block indexes (one per epoch), the block. Slots meet blocks in one
equi-join by index.

Defined results: null and wordless texts have size 0 and are never taken; a null source is its own
source, ranked last; repeated rows are separate documents; no rows or no words take nothing. Only
(source, epoch) facts are ever gathered per source; a source with most of the rows is spread over
blocks and buckets everywhere else.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricbook.llm.common import ROW_FILE, ROW_INDEX, WORD, materialise, named_rows, with_running_offset

BLOCK_WORDS = 128
SHARD_WORDS = 1 << 20
ROUNDS = 16
SLOTS_PER_CHUNK = 1 << 14
CYCLE = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 17


def permuted(x: str, n: str, key: list[str], inverse: bool = False) -> Column:
    """Pseudorandom permutation of 0..n-1 applied to ``x`` (or its inverse), by swap-or-not.

    Each round pairs x with (k - x) mod n and swaps the two on a keyed bit of the pair; a round is
    its own inverse, for any n."""
    size = F.col(n)

    def swap(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), size) - at, size)
        bit = F.pmod(F.xxhash64(*key, r + ROUNDS, F.greatest(at, partner)), F.lit(2))
        return F.when(bit == 1, partner).otherwise(at)

    order = reversed(range(ROUNDS)) if inverse else range(ROUNDS)
    # Never null: without the coalesce Catalyst would evaluate it once more in an inferred filter.
    return F.coalesce(F.aggregate(F.array(*map(F.lit, order)), F.col(x).cast("long"), swap), F.lit(-1).cast("long"))


def sizes(docs: DataFrame, keep: list[str], text: str = "text", source: str = "source") -> DataFrame:
    """``keep`` columns, ``source`` and ``size`` (words of the text)."""
    return docs.select(*keep, F.col(source).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, cycle: tuple[float, ...] = CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``rank`` (code-point order, null last), ``source``, ``source_size``,
    ``weight``, ``target``.

    Sources are few; their table is ordered in one window. In ascending order of ceiling / weight a
    source stops at its ceiling exactly if its share of what the earlier ones leave would pass it."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    weighted = (ranked.withColumn("weight", F.element_at(weights, (F.col("rank") % len(cycle) + 1).cast("int")))
                .withColumn("_ceiling", F.lit(max_epochs) * F.col("source_size")))
    order = Window.orderBy(F.col("_ceiling") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    return (weighted
            .withColumn("_left", F.sum("source_size").over(whole) - F.coalesce(F.sum("_ceiling").over(before), F.lit(0)))
            .withColumn("_share", F.col("weight") * F.col("_left") / F.sum("weight").over(onward))
            .withColumn("_stops", F.col("_share") >= F.col("_ceiling"))
            .withColumn("_level", F.max(F.when(~F.col("_stops"), F.col("_share") / F.col("weight"))).over(whole))
            .select(F.col("rank").cast("int").alias("rank"), "source", "source_size", "weight",
                    F.when(F.col("_stops"), F.col("_ceiling").cast("double"))
                    .otherwise(F.col("_level") * F.col("weight")).alias("target")))


def _plan(per_source: DataFrame, block_words: int, seed: int) -> DataFrame:
    """Per source: blocks, whole epochs, and how many slots and words the last epoch takes."""
    base = (per_source.where("source_size > 0")
            .withColumn("words", F.floor("target").cast("long"))
            # never zero: the optimizer may evaluate what follows before the filter
            .withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("long"))
            .withColumn("last_len", F.col("source_size") - (F.col("blocks") - 1) * block_words)
            .withColumn("epochs", F.expr("words div greatest(source_size, 1)"))
            .withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size"))
            .withColumn("seed", F.lit(seed)).withColumn("_end", F.col("blocks") - 1))
    # Where the short last block comes in the last epoch's order decides that epoch's word counts.
    base = base.withColumn("short_at", permuted("_end", "blocks", ["seed", "rank", "epochs"], inverse=True))
    missing = F.lit(block_words) - F.col("last_len")
    return (base.withColumn("rest_slots", F.when(
        F.col("rest") <= F.col("short_at") * block_words, F.ceil(F.col("rest") / block_words))
        .otherwise(F.ceil((F.col("rest") + missing) / block_words)).cast("long"))
        .withColumn("slots", F.col("epochs") * F.col("blocks") + F.col("rest_slots"))
        .drop("_end"))


def draw_shards(plan: DataFrame, shards: int) -> DataFrame:
    """The multinomial draw: how many of its slots each source (row of ``plan``) has in each output shard.

    Every slot of a source draws a shard, so the counts of a source are multinomial over the shards, those of a
    shard follow the target weights, and each source's sum stays on its target. (rank, shard, n)."""
    chunks = plan.select("seed", "rank", "slots", F.explode(F.expr(
        f"sequence(0L, (slots - 1) div {SLOTS_PER_CHUNK})")).alias("_chunk")).where("slots > 0")
    # A fixed number of partitions: the few chunk rows look too small to deal out, their slots are not.
    partitions = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = (chunks.repartition(partitions, "rank", "_chunk")
             .withColumn("_draw", F.explode(F.expr(
                 f"sequence(_chunk * {SLOTS_PER_CHUNK}, least(slots, (_chunk + 1) * {SLOTS_PER_CHUNK}) - 1)"))))
    shard = F.pmod(F.xxhash64(F.lit("shard"), "seed", "rank", "_draw"), F.lit(shards))
    return drawn.groupBy("rank", shard.alias("shard")).agg(F.count("*").alias("n"))


def slots(per_source: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED, shards: int = 1) -> DataFrame:
    """The mixture: one row per slot (``shard``, ``rank`` of the source, ``slot``, ``epoch``,
    ``block``, ``take`` words from the block's start).

    The counts of each shard are drawn first; a source's slots are then numbered shard after shard."""
    plan = _plan(per_source, block_words, seed)
    counts = materialise(draw_shards(plan, shards), "mix-shards")
    numbered = with_running_offset(counts, ["rank"], ["shard"], "n", "_first", buckets=64)
    partitions = int(per_source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (numbered.repartition(partitions, "rank", "shard").join(plan, "rank")
            .withColumn("slot", F.explode(F.expr("sequence(_first, _first + n - 1)")))
            .withColumn("epoch", F.expr("slot div blocks")).withColumn("_at", F.col("slot") % F.col("blocks")))
    rows = rows.withColumn("block", permuted("_at", "blocks", ["seed", "rank", "epoch"]))
    length = F.when(F.col("block") == F.col("blocks") - 1, F.col("last_len")).otherwise(F.lit(block_words))
    done = (F.col("_at") * block_words
            - F.when(F.col("_at") > F.col("short_at"), F.lit(block_words) - F.col("last_len")).otherwise(F.lit(0)))
    take = F.when(F.col("epoch") < F.col("epochs"), length).otherwise(F.least(length, F.col("rest") - done))
    return rows.select("shard", "rank", "slot", "epoch", "block", take.cast("long").alias("take"))


def shard_counts(mixture: DataFrame) -> DataFrame:
    """Slots of each source in each output shard of a mixture."""
    return mixture.groupBy("shard", "rank").agg(F.count("*").alias("slots"))


def _streams(docs: DataFrame, keep: list[str], text: str, source: str, cycle: tuple[float, ...],
             order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Sized documents with their place (``rank``, ``start``) in their source's stream, and targets. The stream is
    in the order of the columns ``order``, then of ``keep``."""
    chosen = [*keep, *(order or [])]
    kept = [f"_keep{i}" for i in range(len(chosen))]
    named = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(chosen, kept)], F.col(f"`{text}`").alias("_text"),
                        F.col(f"`{source}`").alias("_source"))
    sized = materialise(sizes(named, kept, "_text", "_source"), "mix-sizes")
    goal = materialise(targets(sized, cycle), "mix-targets")
    placed = with_running_offset(sized.join(goal, sized.source.eqNullSafe(goal.source)).drop(sized.source),
                                 ["rank"], [*kept[len(keep):], *kept[:len(keep)], "size"], "size", "start", spread_by=kept[len(keep):] or None)
    return materialise(placed, "mix-streams"), goal


def _taken_spans(placed: DataFrame, goal: DataFrame, block_words: int, seed: int) -> DataFrame:
    """(rank, start) of a document, epoch, block, and the words [lo, hi) of its stream taken there."""
    total = goal.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    mixture = slots(goal, block_words, seed, max(1, math.ceil(total / SHARD_WORDS)))
    pieces = (placed.where("size > 0")
              .select("rank", "start", (F.col("start") + F.col("size")).alias("_end"),
                      F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})"))
                      .alias("block")))
    first = F.col("block") * block_words
    # Both sides grow with the words; sizes guessed before the explodes must not turn one into a broadcast.
    return (mixture.join(pieces.hint("merge"), ["rank", "block"])
            .select("rank", "start", "shard", "epoch", "block", F.greatest("start", first).alias("lo"),
                    F.least(F.col("_end"), first + F.col("take")).alias("hi")).where("hi > lo"))


def mix(docs: DataFrame, keep: list[str], text: str = "text", source: str = "source",
        cycle: tuple[float, ...] = CYCLE, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """Per document: ``keep`` columns, ``source``, ``size``, ``source_size``, ``target``, ``taken`` and
    ``shard_words``, the words that each output shard takes of it."""
    placed, goal = _streams(docs, keep, text, source, cycle)
    taken = (_taken_spans(placed, goal, block_words, seed).groupBy("rank", "start", "shard")
             .agg(F.sum(F.col("hi") - F.col("lo")).alias("words"))
             .groupBy("rank", "start").agg(F.sum("words").alias("_taken"),
                                           F.array_sort(F.collect_list(F.struct("shard", "words"))).alias("_shards")))
    return (placed.join(taken, ["rank", "start"], "left")
            .select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], "source", "size", "source_size",
                    "target", F.when(F.col("size") > 0, F.coalesce("_taken", F.lit(0))).otherwise(F.lit(0))
                    .cast("long").alias("taken"),
                    F.when((F.col("size") > 0) & F.col("_shards").isNotNull(), F.col("_shards"))
                    .otherwise(F.array().cast("array<struct<shard:bigint,words:bigint>>")).alias("shard_words")))


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", n_chars: str | None = None,
                    cycle: tuple[float, ...] = CYCLE, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mixture as documents with the columns of ``docs``: one row per document and epoch that
    takes words of it, its text cut to those words (untouched where all are taken)."""
    columns = docs.columns
    own = {c: f"_c{i}" for i, c in enumerate(columns)}  # input columns by names that nothing here uses
    rows = named_rows(docs, {name: F.col(f"`{c}`") for c, name in own.items()})
    ids = [ROW_FILE, ROW_INDEX]
    # The streams are in an order of content, so that a rerun over other files takes the same words.
    content = [name for c, name in own.items() if "map<" not in dict(docs.dtypes)[c] and dict(docs.dtypes)[c] != "variant"]
    ordered = rows.withColumn("_o0", F.xxhash64(*content)).withColumn("_o1", F.xxhash64(F.lit(1), *content))
    placed, goal = _streams(ordered, ids, own[text], own[source], cycle, ["_o0", "_o1"])
    spans = (_taken_spans(placed, goal, block_words, seed).groupBy("rank", "start", "epoch")
             .agg(F.array_sort(F.collect_list(F.struct((F.col("lo") - F.col("start") + 1).cast("int").alias("first"),
                                                       (F.col("hi") - F.col("lo")).cast("int").alias("n"))))
                  .alias("_spans"), F.sum(F.col("hi") - F.col("lo")).alias("_taken")))
    per_doc = (placed.select("rank", "start", "size", F.col("_keep0").alias(ROW_FILE), F.col("_keep1").alias(ROW_INDEX))
               .where("size > 0").join(spans, ["rank", "start"])
               .groupBy(*ids).agg(F.collect_list(F.when(F.col("_taken") < F.col("size"), F.col("_spans"))
                                                 .otherwise(F.array().cast(
                                                     "array<struct<first:int,n:int>>"))).alias("_copies")))
    body = own[text]
    cut = rows.join(per_doc, ids).withColumn("_spans", F.explode("_copies"))
    pieces = F.regexp_extract_all(F.col(body), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    taken_text = F.array_join(F.flatten(F.transform("_spans", lambda s: F.slice(pieces, s.first, s.n))), "")
    cut = cut.withColumn(body, F.when(F.size("_spans") == 0, F.col(body)).otherwise(
        F.regexp_replace(taken_text, r"^[\x20\x09-\x0D]+", "")))
    if n_chars:
        cut = cut.withColumn(own[n_chars], F.char_length(body).cast(docs.schema[n_chars].dataType))
    return cut.select(*[F.col(name).alias(c) for c, name in own.items()])
