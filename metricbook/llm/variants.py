"""Spelling variants: words one edit apart, the form each should take, and the root of such forms.

The join of near words uses an index of variable-length grams. A dictionary is built from the grams of all
words (a mark before and behind each): base grams of ``Q_MIN`` characters always count, and a gram that is
frequent is prolonged, so that its long list falls into shorter ones. A word is decomposed into the longest
dictionary gram at each place, without those that lie inside an earlier one, and listed under all of these by
gram, place and length. For each edit of a word the grams that it can affect at most are worked out: those
that hold its place, and those that it could let a longer gram swallow (the characters before the place begin
a dictionary gram, or those behind it end one). All others must stand in the other word, at the same place or
one further. From these bounds each word takes the two grams, rarest together, that no edit can affect both:
a near word is in one of their lists. Only these are merged, by one equi-join, and what they hold is verified.

A word without two such grams cannot look for others, but is found by those that have them. For pairs of two
such words these are listed once more under an empty dictionary, where the grams are the base grams.

Broadcast with the tasks' code is the dictionary only: at most ``MAX_PREFIXES`` grams are prolonged, each by
one of 92 characters (26 letters, 64 others, 2 marks), whatever the size of the corpus.

Defined results: null and empty texts have no words; a null id counts as an empty one in the digest that
plants edits; repeated rows count each time; no word means no row; other columns play no part. Words have two
characters at least: one by itself has too few grams to be found and counts as near to nothing.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricbook.llm.common import materialise

Q_MIN, Q_MAX = 2, 4
MIN_FREQUENT = 64  # grams in fewer words are not prolonged
MAX_PREFIXES = 4096
HELD = 1 << 18  # distinct words a task holds before it writes them
SHORT = 64  # words up to this length are verified where they meet, longer ones once per pair
ROWS_AT_ONCE = 1 << 16
BEGIN, END = "^", "$"

#: In Latin-1, where a character is a byte: letters stay, A-Z become a-z, all others a blank.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def runs(text: str) -> list[bytes]:
    """The maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` in Latin-1, A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def edited(run: bytes, id_digest: int, every: int | None) -> bytes:
    """The run, or where ``every`` divides the digest of id and run, the run without one character."""
    if every:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), id_digest)
        if h % every == 0:
            at = h % len(run)
            return run[:at] + run[at + 1:]
    return run


def count_words(docs: DataFrame, id_col: str, text: str = "text", every: int | None = None, min_chars: int = 5,
                min_n: int = 3) -> DataFrame:
    """(word, n) of all words with at least ``min_chars`` characters and ``min_n`` occurrences."""
    schema = "word string, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                              pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for key, value in zip(batch.column("_id"), batch.column("_text")):
                id_digest = zlib.crc32(f"{key.as_py()}:".encode())
                for word, n in Counter(runs(value.as_py())).items():
                    word = edited(word, id_digest, every)
                    if len(word) >= min_chars:
                        held[word] += n
                if len(held) > HELD:
                    yield flush()
        yield flush()

    chosen = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
                         F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return (chosen.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_n))


class Dictionary:
    """Grams longer than ``q_min`` that a decomposition may use, and how frequent grams are."""

    def __init__(self, grams: set[str], frequency: dict[str, int], q_min: int = Q_MIN, q_max: int = Q_MAX):
        self.grams, self.frequency, self.q_min, self.q_max = grams, frequency, q_min, q_max
        self.begins = {g[:i] for g in grams for i in range(1, len(g))}
        self.ends = {g[i:] for g in grams for i in range(1, len(g))}

    def decompose(self, word: str) -> list[tuple[int, str]]:
        """(place, gram) of a marked word, none inside an earlier one."""
        out, reach = [], 0
        for p in range(len(word) - self.q_min + 1):
            longest = min(self.q_max, len(word) - p)
            q = next((n for n in range(longest, self.q_min, -1) if word[p:p + n] in self.grams), self.q_min)
            if p + q > reach:
                out.append((p, word[p:p + q]))
                reach = p + q
        return out

    def affected(self, word: str, grams: list[tuple[int, str]]) -> list[tuple[int, int]]:
        """For every edit of one character between the marks, the grams (from, to) of a marked word that it can
        affect: those that reach over its place, and those that lie between it and the farthest place to its
        left from where the characters begin a dictionary gram, or to its right where they end one."""
        n, most = len(word), self.q_max - 1
        begun, ended = [0] * (n + 1), [0] * (n + 1)  # grams that begin before a place; that end at it or before
        for p, g in grams:
            begun[p + 1] += 1
            ended[p + len(g)] += 1
        for x in range(n):
            begun[x + 1] += begun[x]
            ended[x + 1] += ended[x]
        begins, ends = self.begins, self.ends
        lows, highs = [0] * n, [0] * n
        for x in range(1, n):
            left = right = x
            for k in range(min(most, x), 0, -1):
                if word[x - k:x] in begins:
                    left = x - k
                    break
            for k in range(min(most, n - x), 0, -1):
                if word[x:x + k] in ends:
                    right = x + k
                    break
            lows[x], highs[x] = min(ended[x], begun[left]), max(begun[x], ended[right])
        out = [(lows[1], highs[1])]
        for x in range(2, n):  # the character before x replaced or taken out; something put in before x
            out += [(lows[x - 1], highs[x]), (lows[x], highs[x])]
        return out

    def rarest_apart(self, word: str, grams: list[tuple[int, str]]) -> tuple[int, int] | None:
        """The two grams, rarest together, that no edit can affect both; None if there are none such."""
        beyond = [i + 1 for i in range(len(grams))]  # the first gram that no edit of this one can affect
        for low, high in self.affected(word, grams):
            for i in range(low, high):
                if beyond[i] < high:
                    beyond[i] = high
        cost = [self.frequency.get(g, 0) for _, g in grams]
        least: list[int] = [0] * len(grams)  # from a gram on, the rarest one
        for i in range(len(grams) - 1, -1, -1):
            least[i] = i if i + 1 == len(grams) or cost[i] <= cost[least[i + 1]] else least[i + 1]
        pairs = [(cost[i] + cost[least[j]], i, least[j]) for i, j in enumerate(beyond) if j < len(grams)]
        return min(pairs)[1:] if pairs else None


def dictionary(words: DataFrame, q_min: int = Q_MIN, q_max: int = Q_MAX, min_frequent: int = MIN_FREQUENT,
               max_prefixes: int = MAX_PREFIXES) -> Dictionary:
    """The frequency-pruned gram dictionary of (word, ..)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(held.values(), pa.int64())],
                                             names=["gram", "frequency"])
            held.clear()
            return out

        for batch in batches:
            for word in batch.column("word").to_pylist():
                marked = BEGIN + word + END
                for q in range(q_min, q_max + 1):
                    held.update(marked[i:i + q] for i in range(len(marked) - q + 1))
                if len(held) > HELD:
                    yield flush()
        yield flush()

    grams = materialise(words.select("word").mapInArrow(run, "gram string, frequency long")
                        .groupBy("gram").agg(F.sum("frequency").alias("frequency")), "variant-grams")
    # A gram is never more frequent than its beginning, so what is chosen holds the beginnings of its grams.
    frequent = (grams.where((F.length("gram") < q_max) & (F.col("frequency") >= min_frequent))
                .orderBy(F.col("frequency").desc(), F.length("gram"), "gram").limit(max_prefixes).select(F.col("gram").alias("begin")))
    longer = (grams.where(F.length("gram") > q_min)
              .join(F.broadcast(frequent), F.expr("substring(gram, 1, length(gram) - 1)") == F.col("begin")).drop("begin"))
    found = {r.gram: r.frequency for r in longer.collect()}  # at most 92 for each of max_prefixes
    base = {r.gram: r.frequency for r in grams.where(F.length("gram") == q_min).collect()}  # at most 92 ** q_min
    return Dictionary(set(found), base | found, q_min, q_max)


def near_pairs(words: DataFrame, book: Dictionary) -> DataFrame:
    """(a, n_a, b, n_b), once for each pair of words that one inserted, deleted or replaced character sets apart.

    ``words``: (id, word, n), a written table with each id and word once."""
    plain = Dictionary(set(), book.frequency, book.q_min, book.q_max)
    schema = "base boolean, gram string, place int, size int, id long, letters long, short string, probe boolean, found boolean"
    kinds = (pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
                letters = 0
                for c in set(word):
                    letters |= 1 << (ord(c) & 63)
                letters -= (letters >> 63) << 64  # as a signed number
                short, marked = word if len(word) <= SHORT else None, BEGIN + word + END
                for base, book_ in ((False, book), (True, plain)):
                    grams = book_.decompose(marked)
                    apart = book_.rarest_apart(marked, grams)
                    rows += [(base, g, p, len(word), key, letters, short, apart is not None and i in apart, apart is not None)
                             for i, (p, g) in enumerate(grams)]
                    if apart is not None:
                        break  # else listed once more, under base grams
                if len(rows) > ROWS_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    names = [c.split()[0] for c in schema.split(", ")]
    index = materialise(words.select("id", "word").mapInArrow(run, schema), "variant-index")
    # A gram beside the edit stands at the same place in both words, or further by what the edit adds.
    at = [(0, 0), (0, 1), (1, 1), (0, -1), (-1, -1)]
    probes = index.where("probe").select(
        "base", "gram", F.col("id").alias("b"), F.col("letters").alias("letters_b"), F.col("short").alias("short_b"),
        F.inline(F.array(*[F.struct((F.col("place") + p).alias("place"), (F.col("size") + n).alias("size"), F.lit(n).alias("longer"))
                           for p, n in at])))
    lists = index.select("base", "gram", "place", "size", F.col("id").alias("a"), F.col("letters").alias("letters_a"),
                         F.col("short").alias("short_a"), "found")
    # Where both words look for the other, the longer one (of equal ones the later) need not.
    met = materialise(lists.join(probes, ["base", "gram", "place", "size"])
                      .where("(NOT found OR longer > 0 OR (longer = 0 AND a < b)) AND a <> b "
                             "AND bit_count(letters_a ^ letters_b) <= 2")
                      .where(F.coalesce(F.levenshtein("short_a", "short_b", 1) == 1, F.lit(True)))
                      .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "variant-met")
    left, right = (words.select(F.col("id").alias(x), F.col("word").alias(f"word_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    return (met.join(left, "a").join(right, "b").where(F.levenshtein("word_a", "word_b", 1) == 1)  # long ones are not yet
            .select(F.col("word_a").alias("a"), "n_a", F.col("word_b").alias("b"), "n_b"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following (word, form) to the last: the way doubles each round. Forms grow at least
    twofold in number, so there are no circles and at most 63 steps."""
    state = materialise(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        beyond = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = materialise(state.join(beyond, "root", "left")
                            .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                            "variant-roots")
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.drop("moved")


def variants(words: DataFrame, factor: int = 2, **options: int) -> DataFrame:
    """``word``, ``form`` (the near word of largest n, if at least ``factor`` times as frequent), ``root``, ``n``,
    ``n_near`` and ``form_n`` of (word, n)."""
    words = materialise(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "variant-words")
    pairs = materialise(near_pairs(words, dictionary(words, **options)), "variant-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    formed = materialise(words.join(best, "word", "left").withColumn("_form_n", -F.col("best.less"))
                         .withColumn("_taken", F.coalesce(F.col("_form_n") >= factor * F.col("n"), F.lit(False)))
                         .select("word", F.expr("if(_taken, best.near, null)").alias("form"), "n",
                                 F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.expr("if(_taken, _form_n, null)").alias("form_n")), "variant-forms")
    last = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return (formed.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
