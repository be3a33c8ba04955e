"""Spelling variants against all pairs, token counts against whole-text encoding, divergence against plain sums."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from metricbook.llm import divergence, tokencount, variants
from metricbook.llm import queries as Q

SF = "/root/testdata/sf0.001"
LETTERS = r"[A-Za-zÀ-ÿ]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- operator 11

def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants_by_hand(docs, every, min_n=3):
    n = Counter()
    for key, text in docs:
        for run in re.findall(LETTERS, text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= min_n}
    variant_of = defaultdict(list)  # word without one character -> words
    for w in n:
        for x in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            variant_of[x].append(w)
    near = {w: set() for w in n}
    for group in variant_of.values():
        for a in group:
            near[a] |= {b for b in group if _one_edit(a, b)}
    out = {}
    for w, c in n.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        out[w] = best if best is not None and n[best] >= 2 * c else None
    rows = set()
    for w, form in out.items():
        root = w
        while out[root] is not None:
            root = out[root]
        rows.add((w, form, root, n[w], len(near[w]), n[form] if form else None))
    return rows


def _rows(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_of_the_test_table(spark):
    got = Q.QUERIES["op11_variants"](spark, SF)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = _variants_by_hand(docs, 97)
    rows = got.collect()
    assert len(rows) == len(want) and _rows(got) == want
    assert any(r.form for r in rows)


@pytest.mark.parametrize("options", [{}, {"min_frequent": 2}, {"min_frequent": 1, "q_max": 5}, {"max_prefixes": 3, "min_frequent": 1}])
def test_variants_with_dictionaries_of_any_size(spark, options):
    draw = random.Random(3)
    words = {"".join(draw.choice("abÀ") for _ in range(draw.randint(5, 8))): draw.randint(3, 400) for _ in range(300)}
    got = _rows(variants.variants(spark.createDataFrame(list(words.items()), "word string, n long"), **options))
    assert got == _variants_by_hand([(1, " ".join(f"{w} " * n for w, n in words.items()))], None)


def test_chains_lead_to_the_last_form(spark):
    words = [("a" * 5 + "b" * i, 3 * 3 ** i) for i in range(12)]  # each is one edit from the next, thrice as frequent
    got = _rows(variants.variants(spark.createDataFrame(words, "word string, n long")))
    assert {r[2] for r in got} == {words[-1][0]}
    assert {r[0]: r[1] for r in got} == {w: (words[i + 1][0] if i < 11 else None) for i, (w, _) in enumerate(words)}


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("ab^$", min_size=3, max_size=4), max_size=25), st.text("ab", min_size=2, max_size=9), st.data())
def test_what_an_edit_cannot_affect_stands_in_the_other_word(grams, word, data):
    book = variants.Dictionary(grams, {})
    marked = "^" + word + "$"
    own = book.decompose(marked)
    at = data.draw(st.integers(0, len(word)))
    taken = data.draw(st.integers(0, min(1, len(word) - at)))
    put = data.draw(st.sampled_from(["", "a", "b"] if taken else ["a", "b"]))
    theirs = set(book.decompose("^" + word[:at] + put + word[at + taken:] + "$"))
    shift = len(put) - taken
    lost = [i for i, (p, g) in enumerate(own) if (p, g) not in theirs and (p + shift, g) not in theirs]
    bounds = book.affected(marked, own)
    assert len(bounds) == 2 * len(word) + 1
    low, high = bounds[2 * at + taken]
    assert all(low <= i < high for i in lost)
    apart = book.rarest_apart(marked, own)
    assert apart is None or not set(apart) <= set(lost)


HOSTILE = [(1, None), (2, ""), (None, "straße Straße STRAßE éclair Éclair ÉCLAIR naïve×naive"), (3, "漢字words 漢wordś"),
           (4, "word\u0000words a\tb\x0bc 12words34 ÿÿÿÿÿ"), (4, "words worda wordb " * 50), (4, "words worda wordb " * 50),
           (-7, "x" * 2_000 + " " + "x" * 2_001 + " " + "yz" * 60), (5, " ".join(f"{'abcdefghij'[i % 10] * 5}{'klm'[i % 3]}" for i in range(60_000)))]


def test_variants_of_hostile_texts(spark):
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in HOSTILE], "doc_id long, text string, word string, n int")
    for every, least in ((97, 1), (None, 2), (2, 1)):
        got = variants.variants(variants.count_words(df, "doc_id", every=every, min_n=least))
        assert _rows(got) == _variants_by_hand(HOSTILE, every, least)
    assert variants.variants(variants.count_words(df.limit(0), "doc_id")).count() == 0


def test_very_long_words(spark):
    draw = random.Random(4)
    mixed = "".join(draw.choices("abcdefgh", k=60_000))
    words = ["x" * 60_000, "x" * 60_001, mixed, mixed[:29_000] + mixed[29_001:], mixed + "ab"]
    got = _rows(variants.variants(spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long")))
    assert {(words.index(r[0]), r[4]) for r in got} == {(0, 1), (1, 1), (2, 1), (3, 1), (4, 0)}


# ---- operator 12

def _whole(path):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


BLANKS = st.lists(st.sampled_from([" ", "▁", "▂", "a", "é", "\n", "\t", "漢", "<s>", " ", "\u0000", "the"]), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(BLANKS)
def test_runs_count_as_whole_texts_do(text):
    path = tokencount.default_tokenizer()
    assert tokencount.runs_are_apart(path)
    assert tokencount.counter(path)([text.replace("▁", " ")]) == [len(_whole(path).encode(text))]


def test_token_counts_of_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    whole = _whole(tokencount.default_tokenizer())
    want = sorted((r.doc_id, len((r.text or "").encode()), len(whole.encode(r.text or ""))) for r in docs)
    got = Q.QUERIES["op12_token_counts"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


TEXTS = [None, "", " ", "   ", "▁", "a ▁b", "a▁ b", "<s> </s> <unk>", "x\u0000y", "\n\n \t ", "é é", " " * 300_000, "z" * 300_000,
         "漢" * 100_000, "ab \n" * 80_000, "same", "same", "same"]


def test_cache_serves_stored_counts_and_encodes_the_rest(spark, tmp_path, monkeypatch):
    whole = _whole(tokencount.default_tokenizer())
    df = spark.createDataFrame([(i % 5 or None, t, "clash", 0, 0) for i, t in enumerate(TEXTS)],
                               "doc_id int, text string, digest string, _row_file int, _metadata int")
    cache = str(tmp_path / "cache")
    want = sorted(((i % 5 or -1, len((t or "").encode()), len(whole.encode(t or ""))) for i, t in enumerate(TEXTS)))

    def run(frame):
        rows = tokencount.count_tokens(frame, ["doc_id", "digest"], cache).collect()
        assert all(r.digest == "clash" for r in rows)
        return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in rows), {r.cached for r in rows}

    assert run(df) == (want, {False})
    folder = f"{cache}/tokenizer={tokencount.tokenizer_digest(tokencount.default_tokenizer())}"
    n = spark.read.parquet(folder).count()
    normal = {(t or "").replace("▁", " ") for t in TEXTS}
    assert n == len(normal)  # distinct texts only, the spellings of a blank being one
    assert run(df) == (want, {True})
    assert spark.read.parquet(folder).count() == n
    spark.read.parquet(folder).write.mode("append").parquet(folder + "-copy")
    spark.read.parquet(folder + "-copy").write.mode("append").parquet(folder)  # an append that ran twice
    more = df.unionByName(spark.createDataFrame([(9, "a new text", "clash", 0, 0)], df.schema))
    assert run(more) == (sorted(want + [(9, 10, len(whole.encode("a new text")))]), {True, False})
    assert run(df.limit(0)) == ([], set())


def test_another_tokenizer_has_its_own_counts(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a ▁b", "a  b", "end <|endoftext|> next", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    cache = str(tmp_path / "cache")
    tokencount.count_tokens(df, ["doc_id"], cache).collect()
    got = tokencount.count_tokens(df, ["doc_id"], cache, path=path).orderBy("doc_id").collect()
    want = [len(Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert [r.n_tokens for r in got] == want and not any(r.cached for r in got)


# ---- operator 13

def _audit_by_hand(docs, min_docs=3, top=200):
    occur, df, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
        occur[lang or "", source or ""].update(found)
        df[lang or ""].update(set(found))
        langs[lang or ""].add(source or "")
    rows = set()
    for lang, sources in langs.items():
        kept = sorted(t for t, n in df[lang].items() if n >= min_docs)
        whole = Counter()
        for s in sources:
            whole.update(occur[lang, s])

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(occur[lang, s]) for s in sources}
        q = shares(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            over = [(f(p[s][t], q[t]), t) for t in kept if occur[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", over, top)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    rows.add((lang, s, part, item, value, rank))
    return rows


def _audit(df, **options):
    rows = divergence.audit(df, **options).collect()
    out = {(r.lang, r.source, r.part, r.item, r["value"], r["rank"]) for r in rows}
    assert len(out) == len(rows)
    return out


def _mixed_docs():
    draw = random.Random(8)
    vocabulary = [f"w{c}{d}" for c in "abcdefghijklmnopqrst" for d in "éü漢xyz"]
    docs = [(" ".join(draw.choices(vocabulary, [1 / (i + 1 + 3 * (k % 4)) for i in range(len(vocabulary))], k=60)), "en" if k % 5 else "de", f"s{k % 4}")
            for k in range(60)]
    return docs + [(None, None, None), ("", "fr", "only"), ("a b", "fr", None), ("Zz9zZ Zz", "", "s1"), ("\u0000a\u007fb­", "en", "ÿ"),
                   ("漢 漢", "en", "\U0001F600"), ("long " * 100_000 + "x" * 100_000, "en", "s1")] + docs[:5] * 2


@pytest.mark.parametrize("bits", [64, 5, 0])
def test_divergence_by_hand_also_where_digests_collide(spark, bits):
    docs = _mixed_docs()
    df = spark.createDataFrame([(*d, 1, "clash") for d in docs], "text string, lang string, source string, gid int, term string")
    assert _audit(df, digest_bits=bits) == _audit_by_hand(docs)
    assert _audit(df, digest_bits=bits, top=3, min_docs=1) == _audit_by_hand(docs, 1, 3)


def test_divergence_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 4)
    monkeypatch.setattr(divergence, "HELD", 10)
    docs = _mixed_docs()
    rows = spark.createDataFrame(docs, "text string, lang string, source string")
    assert _audit(rows) == _audit_by_hand(docs)
    assert divergence.audit(rows.limit(0)).count() == 0


def test_divergence_shares_are_exact_beyond_64_bits(spark):
    n, total = 2 ** 62 - 5, 2 ** 62 + 12_345
    row = spark.createDataFrame([(n, total)], "n long, total long").select(divergence._share(*map(divergence.F.col, ("n", "total"))).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (n + 1) // total


def _task_rows(df, **options):
    text = "lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' '))"  # the rows below have ASCII letters only
    found = divergence.task_counts(df.selectExpr(f"{text} text", "coalesce(lang, '') lang", "coalesce(source, '') source"), 0, **options).collect()
    n = Counter()
    for r in found:
        n[r.gid, r.lid, r.tid] += r.n
        n[r.gid, r.lid, r.tid, "docs"] += r.docs
    return found, n


def test_divergence_tasks_write_a_string_once_per_term(spark, monkeypatch):
    docs = [("to be or not to be", "en", f"s{k % 3}") for k in range(9)] + [("or so", "de", "s0"), ("", "en", "s1"), (None, None, None)]
    df = spark.createDataFrame(docs, "text string, lang string, source string").coalesce(1)
    found, n = _task_rows(df)
    assert len(found) == 3 * 4 + 2  # terms of the three groups of en and of the one of de
    assert sorted(r.term for r in found if r.term is not None) == ["be", "not", "or", "so", "to"]
    assert sorted(n.values()) == sorted(3 * [6, 3, 6, 3, 3, 3, 3, 3] + 4 * [1])
    every, same = _task_rows(df, every=True)
    assert same == n and Counter(r.term for r in every) == {"to": 3, "be": 3, "or": 4, "not": 3, "so": 1}
    for limits in ({"HELD": 7}, {"HELD_BYTES": 7}, {"KNOWN": 3}, {"HELD": 7, "KNOWN_BYTES": 7}):
        with monkeypatch.context() as m:
            for name, value in limits.items():
                m.setattr(divergence, name, value)
            for option in ({}, {"every": True}):
                pieces, same = _task_rows(df, **option)
                assert same == n and len(pieces) > len(found)
                assert {r.term for r in pieces} >= {"be", "not", "or", "so", "to"}
                assert not option or all(r.term is not None for r in pieces)


def test_divergence_pairs_of_many_and_of_few_groups_agree(spark, monkeypatch):
    docs = _mixed_docs()
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    want = _audit_by_hand(docs)
    for at_once in (1, 30, 1 << 18):  # every block has more groups than room, some have, none has
        monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", at_once)
        assert _audit(df) == want


def test_divergence_shares_on_both_sides_of_64_bits(spark):
    counts = [0, 1, 9 * 10 ** 9 - 1, 9 * 10 ** 9, 9 * 10 ** 9 + 1, 2 ** 62]
    df = spark.createDataFrame([(n, n + d) for n in counts for d in (1, 7, 10 ** 9)], "n long, total long")
    out = df.select("n", "total", divergence._share(divergence.F.col("n"), divergence.F.col("total")).alias("p")).collect()
    assert all(r.p == 1 + 10 ** 9 * (r.n + 1) // r.total for r in out)
