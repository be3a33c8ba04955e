"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; policies are versioned sets of rules, applied to the bits with ``&``; ablations (what would a
policy keep without one rule) come out of one aggregation over the bits.

Defined results: a null or empty text has no word, all counts are 0 and the base rules fail; equal
rows give equal ledger rows; an empty table gives an empty ledger; columns of the input other than
the text are carried along untouched (``keep``), whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricbook.llm.common import SPACE, let, words, zip_shifted

WINDOW_WORDS = 8


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: Callable[[Column], Column]  # of the struct of measurements


RULES = (
    Rule(0, "too_few_words", lambda m: m.n_words < 20),
    Rule(1, "repeated_words", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
    Rule(2, "symbols", lambda m: 4 * m.n_symbols > m.n_words),
    Rule(3, "duplicate_lines", lambda m: (m.n_lines >= 6) & (2 * m.n_dup_lines > m.n_lines)),
    Rule(4, "word_length", lambda m: (m.n_words > 0) & ((m.word_chars < 2 * m.n_words) | (m.word_chars > 20 * m.n_words))),
    Rule(5, "stutter", lambda m: 100 * m.n_same_as_before > 30 * m.n_words),
)

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("too_few_words", "repeated_words"),
    "v1": ("too_few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": ("too_few_words", "repeated_words", "symbols", "duplicate_lines", "word_length"),
    "v3": ("too_few_words", "repeated_words", "symbols", "duplicate_lines", "word_length", "stutter"),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_as_before")


def policy_mask(policy: str) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in POLICIES[policy])


def _covered_words(window_hashes: Column) -> Column:
    """Number of words that lie in a window whose hash occurs twice or more."""
    order = F.array_sort(F.transform(window_hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = let(order, lambda o: zip_shifted(o, o, 1, lambda a, b: F.when(
        a.h == b.h, F.array(a.i, b.i)).otherwise(F.array().cast("array<int>"))))
    starts = F.array_sort(F.array_distinct(F.flatten(same)))
    # Each start covers its window up to the next start's.
    return let(starts, lambda s: F.aggregate(
        zip_shifted(s, s, 1, lambda a, b: F.least(b - a, F.lit(WINDOW_WORDS))), F.lit(WINDOW_WORDS), lambda x, y: x + y))


def _repeated_words(tokens: Column) -> Column:
    """Words in windows of eight that occur twice or more; window hashes by doubling (2, 4, 8 words)."""
    def doubled(hashes: Column, width: int) -> Column:
        return let(hashes, lambda h: zip_shifted(h, h, width, lambda a, b: F.xxhash64(a, b)))

    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    return let(reduce(doubled, (1, 2, 4), hashes), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered_words(h)).otherwise(F.lit(0)))


def measured(text: Column) -> Column:
    """Struct of the measurements and ``failed_bits`` (bit of :data:`RULES` set: it fails)."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    word_counts = let(words(text), lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("again"), F.aggregate(
        zip_shifted(w, w, 1, lambda a, b: (a == b).cast("int")), F.lit(0), lambda x, y: x + y).alias("same")))
    raw = F.struct(word_counts.alias("w"), line_counts.alias("l"),
                   F.char_length(F.regexp_replace(t, SPACE + "+", "")).alias("chars"),
                   (F.char_length(t) - F.char_length(F.regexp_replace(t, "[#*$%&|<>]+", ""))).alias("symbols"))
    measures = let(raw, lambda x: F.struct(*[c.cast("long").alias(name) for name, c in zip(
        MEASURES, (x.w.n, x.chars, x.symbols, x.l.n, x.l.dup, x.w.again, x.w.same))]))

    def with_bits(m: Column) -> Column:
        bits = [F.when(r.fails(m), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
        return F.struct(*[m[c].alias(c) for c in MEASURES], reduce(add, bits).cast("long").alias("failed_bits"))

    return let(measures, with_bits)


def ledger(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, the measurements, and ``failed_bits``.

    One pass over whole texts, no shuffle, no Python."""
    kept = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    return (docs.select(*kept, measured(F.col(text)).alias("_m"))
            .select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], "_m.*"))


def passes(policy: str, bits: Column | None = None) -> Column:
    """True where no rule of the policy has failed (reads only the bits)."""
    bits = F.col("failed_bits") if bits is None else bits
    return bits.bitwiseAND(F.lit(policy_mask(policy))) == 0


def ablations(led: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it rejects, and that the policy would
    keep without it. The ledger is first reduced to one row per bit pattern."""
    mask = policy_mask(policy)
    patterns = led.groupBy("failed_bits").agg(F.count("*").alias("docs"))
    rules = [r for r in RULES if r.name in POLICIES[policy]]
    masked = F.col("failed_bits").bitwiseAND(F.lit(mask))
    wide = patterns.agg(
        F.sum(F.when(masked == 0, F.col("docs")).otherwise(0)).alias("kept"),
        *[F.sum(F.when(F.col("failed_bits").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("docs")).otherwise(0))
          .alias(f"fails_{r.bit}") for r in rules],
        *[F.sum(F.when(masked == (1 << r.bit), F.col("docs")).otherwise(0)).alias(f"only_{r.bit}") for r in rules])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(policy).alias("policy"), F.lit(r.name).alias("rule"),
                 F.coalesce(F.col(f"fails_{r.bit}"), F.lit(0)).alias("docs_failing"),
                 F.coalesce(F.col(f"only_{r.bit}"), F.lit(0)).alias("docs_only_this"),
                 (F.coalesce(F.col("kept"), F.lit(0)) + F.coalesce(F.col(f"only_{r.bit}"), F.lit(0)))
                 .alias("kept_without")) for r in rules])))


def keep_passing(docs: DataFrame, policy: str, text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that pass the policy."""
    return docs.where(passes(policy, measured(F.col(text)).failed_bits))
