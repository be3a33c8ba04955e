"""Quality classifier: regularised quadratic discriminant analysis.

Document statistics, transformed to be near normal, feed one Gaussian per class. The class moments
are sums over the labelled rows (one aggregation); covariances are shrunk towards the pooled one and
towards a multiple of the identity. The Cholesky factor of each class is computed once and kept in
the model; a score is the logistic of the difference of the two log densities, whose Mahalanobis
distances come from triangular solves.

Defined results: a null or empty text has all counts 0 and is scored like any other; labels that
disagree on one id are averaged (half or more: 1); rows without a label only get a score; with fewer
than two classes among the labels every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricbook.llm.common import SPACE, materialise, words, zip_shifted

STATISTICS = ("length", "word_length", "symbols", "punctuation", "upper", "digits", "lines", "line_words",
              "duplicate_lines", "distinct_words", "distinct_pairs", "short_words", "sentence_ends", "loud")
TO_POOLED, TO_SPHERE = 0.2, 0.05


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the transformed statistics of every whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def count(pattern: str) -> Column:
        return F.char_length(t) - F.char_length(F.regexp_replace(t, pattern, ""))

    base = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], words(F.col(text)).alias("_w"), lines.alias("_l"),
        F.char_length(t).alias("chars"), count(SPACE + "+").alias("spaces"), count(r"[#*$%&|<>]+").alias("symbols"),
        count(r"[.,;:'\x22()-]+").alias("marks"), count(r"\p{Lu}+").alias("upper"), count(r"[0-9]+").alias("digits"),
        count(r"!+").alias("bangs"), F.size(F.split(t, r"[.?](?:\s|$)", -1)).alias("ends"))
    counted = (base.select("*", F.size("_w").alias("n"), F.size("_l").alias("lines"),
                           (F.size("_l") - F.size(F.array_distinct("_l"))).alias("dup"),
                           F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
                           F.size(F.filter("_w", lambda w: F.char_length(w) <= 3)).alias("short"))
               .withColumn("_p", zip_shifted(F.col("_h"), F.col("_h"), 1, lambda a, b: F.xxhash64(a, b)))
               .select("*", F.size(F.array_distinct("_h")).alias("kinds"),
                       F.coalesce(F.size(F.array_distinct("_p")), F.lit(0)).alias("pair_kinds")).drop("_w", "_l", "_h", "_p"))
    n = F.greatest(F.col("n"), F.lit(1))
    letters = F.greatest(F.col("chars") - F.col("spaces"), F.lit(1))

    def share(part: Column, whole: Column) -> Column:
        """A share, its square root to spread the small values."""
        return F.sqrt(F.greatest(part, F.lit(0)) / whole)

    values = {
        "length": F.log1p("n"), "word_length": F.log((F.col("chars") - F.col("spaces")) / n + 0.5),
        "symbols": share(F.col("symbols"), n), "punctuation": share(F.col("marks"), n), "upper": share(F.col("upper"), letters),
        "digits": share(F.col("digits"), letters), "lines": F.log1p("lines"),
        "line_words": F.log1p(F.col("n") / F.greatest(F.col("lines"), F.lit(1))),
        "duplicate_lines": share(F.col("dup"), F.greatest(F.col("lines"), F.lit(1))),
        "distinct_words": F.log(F.col("kinds") / n + 0.01), "distinct_pairs": F.log(F.col("pair_kinds") / n + 0.01),
        "short_words": share(F.col("short"), n), "sentence_ends": share(F.col("ends") - 1, n), "loud": share(F.col("bangs"), n)}
    return counted.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                          *[values[s].cast("double").alias(s) for s in STATISTICS])


@dataclass(frozen=True)
class Model:
    """Class means and inverse Cholesky factors in the standardised space; ``offset`` holds the log
    determinants and priors."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray  # 2 x d
    factors: np.ndarray  # 2 x d x d, lower triangular: inverses of the Cholesky factors, formed once
    offset: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        half = [np.square((z - self.means[k]) @ self.factors[k].T).sum(axis=1) / 2 for k in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(half[0] - half[1] + self.offset, -500, 500)))


def fit(labelled: DataFrame, label: str = "quality") -> Model | None:
    """Model of the labelled rows (label 0 or 1); None with fewer than two classes.

    The driver gets sums: d + d (d + 1) / 2 numbers per class, whatever the number of rows."""
    d = len(STATISTICS)
    spread = labelled.agg(*[f(s) for s in STATISTICS for f in (F.avg, F.stddev_pop)]).first()
    if spread[0] is None:
        return None
    centre, scale = np.array(spread[0::2], float), np.array(spread[1::2], float)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = [((F.col(s) - float(c)) / float(w)).alias(s) for s, c, w in zip(STATISTICS, centre, scale)]
    rows = (labelled.select(label, *z).groupBy(label).agg(
        F.count("*"), *[F.sum(s) for s in STATISTICS],
        *[F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])) for i in range(d) for j in range(i + 1)])).collect()
    sums = {int(r[0]): np.array(r[1:], float) for r in rows if r[0] in (0, 1)}
    if len(sums) < 2:
        return None
    counts = np.array([sums[k][0] for k in (0, 1)])
    means = np.array([sums[k][1:d + 1] / sums[k][0] for k in (0, 1)])
    lower = np.tril_indices(d)
    own = np.zeros((2, d, d))
    for k in (0, 1):
        own[k][lower] = sums[k][d + 1:] / counts[k]
        own[k] = own[k] + np.tril(own[k], -1).T - np.outer(means[k], means[k])
    pooled = np.average(own, axis=0, weights=counts)
    factors = []
    for k in (0, 1):
        near = (1 - TO_POOLED) * own[k] + TO_POOLED * pooled
        factors.append(np.linalg.cholesky((1 - TO_SPHERE) * near + TO_SPHERE * max(np.trace(near) / d, 1e-6) * np.eye(d)))
    logs = [np.log(np.diagonal(f)).sum() for f in factors]
    inverses = np.array([np.tril(np.linalg.inv(f)) for f in factors])
    return Model(centre, scale, means, inverses, float(logs[0] - logs[1] + np.log(counts[1] / counts[0])))


def score(stats: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted``; only numbers go to Python, not the texts."""
    if model is None:
        return stats.select(*keep, F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))

    chosen = stats.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], *STATISTICS)
    schema = chosen.drop(*STATISTICS).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(s).to_numpy(zero_copy_only=False) for s in STATISTICS])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(model.score(x))], names=schema.names)

    return (chosen.mapInArrow(run, schema).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "score")
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str, held_out: Column, text: str = "text",
             label: str = "quality") -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` for every row; ``held_out`` (an
    expression over ``id_col``) marks rows whose labels are not learnt."""
    stats = materialise(statistics(docs, [id_col], text).withColumn("held_out", held_out), "qda-statistics")
    known = (labels.where(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.when(F.avg(label) >= 0.5, 1).otherwise(0).alias("_label")))
    train = stats.where(~F.col("held_out")).join(known, F.col(id_col) == F.col("_id"))
    return score(stats, fit(train.select("_label", *STATISTICS), "_label"), [id_col, "held_out"])
