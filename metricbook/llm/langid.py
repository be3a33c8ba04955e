"""Language identification by multilingual mixture inference.

Letters of a text, lower-cased and with word borders, give hashed character n-grams of one to three
letters. Every language is a distribution over the n-grams, counted over all training texts. A text
is a mixture: expectation-maximisation estimates the share of every language; languages are then
dropped one at a time as long as the likelihood lost is less than the penalty of a parameter
(half its weight times the log of the number of n-grams). The prediction is the language with the
largest share among those left.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with no training text
everything is ``und``; training rows without a language are left out; repeated rows count as often as
they come; ties go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

FEATURES = 1 << 12
ITERATIONS = 12
PENALTY = 3.0  # weight of log(n) per language kept
BATCH = 128
PART = 1 << 16  # characters of a text counted at once


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def counts(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None if it has no letter."""
    total, found = np.zeros(FEATURES, np.float32), False
    text = text or ""
    for at in range(0, len(text), PART):
        points = np.frombuffer(text[at:at + PART].encode("utf-32-le", "surrogatepass"), np.uint32)
        x = _letters()[np.concatenate(([0], points, [0]))]
        x = x[np.concatenate(([True], (x[1:] != 0) | (x[:-1] != 0)))].astype(np.uint64)  # one border between words
        if len(x) < 3:
            continue
        found = True
        a, b, c = x[:-2], x[1:-1], x[2:]
        mid = b != 0
        one = b[mid] * np.uint64(0x9E3779B97F4A7C15)
        two = (a * np.uint64(0xC2B2AE3D27D4EB4F) + b * np.uint64(0x165667B19E3779F9))[mid | (a != 0)]
        three = (a * np.uint64(0x27D4EB2F165667C5) + b * np.uint64(0x85EBCA77C2B2AE63)
                 + c * np.uint64(0xD6E8FEB86659FD93))[mid]
        for grams, salt in ((one, 1), (two, 2), (three, 3)):
            mixed = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(salt)
            total += np.bincount((mixed >> np.uint64(52)).astype(np.int64), minlength=FEATURES).astype(np.float32)
    return total if found else None


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and their n-gram distributions (languages x FEATURES).

    Each task sends one vector per language; the driver gets their sums, bounded by languages times
    FEATURES."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, lang_ in zip(batch.column("_text"), batch.column("_lang").to_pylist()):
                got = counts(t.as_py())
                if got is not None:
                    if lang_ not in sums:
                        sums[lang_] = np.zeros(FEATURES)
                    sums[lang_] += got
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([vector.astype(np.int64)])], names=["lang", "n"])

    parts = (docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("_text"), F.col(lang).alias("_lang"))
             .mapInArrow(run, "lang string, n array<long>"))
    rows = (parts.select("lang", F.posexplode("n").alias("feature", "n")).where("n > 0")
            .groupBy("lang", "feature").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.collect_list(F.struct("feature", "n")).alias("v")).collect())
    names = sorted(r["lang"] for r in rows)
    table = np.zeros((len(names), FEATURES))
    for r in rows:
        at = np.array([tuple(x) for x in r["v"]])
        table[names.index(r["lang"]), at[:, 0]] = at[:, 1]
    table += 0.5
    return names, table / table.sum(axis=1, keepdims=True)


def _shares(c: np.ndarray, p: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM for a block of texts: shares (texts x languages) and log likelihoods. ``allowed`` masks
    the languages of each text."""
    n = np.maximum(c.sum(axis=1, keepdims=True), 1)
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ITERATIONS):
        pi = pi * ((c / np.maximum(pi @ p, 1e-30)) @ p.T) / n
    return pi, (c * np.log(np.maximum(pi @ p, 1e-30))).sum(axis=1)


def infer(c: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Shares of the languages that the penalised likelihood keeps."""
    size = len(p)
    cost = PENALTY / 2 * np.log(np.maximum(c.sum(axis=1), 2))
    allowed = np.ones((len(c), size), p.dtype)
    pi, fit = _shares(c, p, allowed)
    best = pi.copy()
    active = np.arange(len(c))
    for _ in range(size - 1):
        # Try without the smallest share; stay with it where that loses less than a parameter costs.
        smallest = np.where(allowed[active] > 0, best[active], np.inf).argmin(axis=1)
        fewer = allowed[active].copy()
        fewer[np.arange(len(active)), smallest] = 0
        pi, without = _shares(c[active], p, fewer)
        better = without + cost[active] >= fit[active]
        active = active[better]
        if not len(active):
            break
        allowed[active], best[active], fit[active] = fewer[better], pi[better], without[better]
    return best


def predict(docs: DataFrame, keep: list[str], names: list[str], table: np.ndarray, text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` (its share) and ``shares`` of all languages."""
    chosen = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = chosen.drop("_text").schema.add("lang_pred", "string").add("score", "double").add("shares", ArrayType(DoubleType()))
    p = table.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                got = [counts(t.as_py()) for t in batch.column("_text")]
                known = [i for i, g in enumerate(got) if g is not None] if len(names) else []
                shares = np.zeros((batch.num_rows, len(names)))
                if known:
                    shares[known] = infer(np.array([got[i] for i in known]), p)
                top = shares.argmax(axis=1) if len(names) else np.zeros(batch.num_rows, int)
                is_known = np.zeros(batch.num_rows, bool)
                is_known[known] = True
                pred = [names[j] if k else "und" for j, k in zip(top, is_known)]
                score = [min(1.0, float(s[j])) if k else 0.0 for s, j, k in zip(shares, top, is_known)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                     pa.array(list(shares), pa.list_(pa.float64()))], names=schema.names)

    return chosen.mapInArrow(run, schema).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                                                 "lang_pred", "score", "shares")


def identify(docs: DataFrame, id_col: str, held_out: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred`` and ``score``; held-out rows teach nothing."""
    names, table = train(docs.where(~held_out), text, lang)
    return (predict(docs.withColumn("_held_out", held_out), [id_col, "_held_out"], names, table, text)
            .select(id_col, F.col("_held_out").alias("held_out"), "lang_pred", "score"))
