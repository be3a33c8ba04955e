"""Rule ledger against SQL and plain Python; SimHash groups against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from metricbook.llm import queries as Q
from metricbook.llm import rules, simhash
from oracle_harness import compare

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
TEXTS = [None, "", " \n\t", "one", "a b c d e f g h", " ".join("abcdefgh") * 4, "x y " * 40, "line one\nline one\nother\n\nline one",
         "é à ü " * 10, "# $ % | < > & *", LONG, "A\x0bB\x0cC\x1fD\u00a0E", "same words here again " * 9, "This This This This thhant thhant thhant end " * 9]


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_matches_sql(spark, name):
    assert compare(spark, name, SF)["match"]


def _measure(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(grams)
    covered = {p for i, g in enumerate(grams) if n[g] > 1 for p in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(covered),
            sum(a == b for a, b in zip(w, w[1:])))


def test_measurements_by_hand(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS + TEXTS[:3])], "doc_id long, text string, n_words string")
    got = {r.doc_id: tuple(r[c] for c in rules.MEASURES) for r in rules.ledger(df, ["doc_id"]).collect()}
    assert got == {i: _measure(t) for i, t in enumerate(TEXTS + TEXTS[:3])}
    kept = rules.keep_passing(df, "v2")
    assert kept.columns == df.columns
    bits = {r.doc_id: r.failed_bits for r in rules.ledger(df, ["doc_id"]).collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, b in bits.items() if b & rules.policy_mask("v2") == 0}
    assert rules.ledger(df.limit(0), ["doc_id"]).count() == 0


def test_ablations_follow_the_bits(spark):
    led = spark.createDataFrame([(0,), (1,), (1,), (3,), (2,), (4,)], "failed_bits long")
    got = {r.rule: (r.docs_failing, r.docs_only_this, r.kept_without) for r in rules.ablations(led, "base").collect()}
    assert got == {"too_few_words": (3, 2, 4), "repeated_words": (2, 1, 3)}


def test_stutter_is_rejected_from_v3_on(spark):
    text = " ".join(f"{w} " * 6 for w in "This thhant ond reather as aning theour".split())
    row = rules.ledger(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"])
    got = row.select(*[rules.passes(p).alias(p) for p in ("base", "v1", "v2", "v3")]).first()
    assert (got.base, got.v1, got.v2, got.v3) == (True, True, True, False)


def test_clean_documents_are_kept(spark):
    led = Q.QUERIES["op9_quality_rules"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    good = led.join(labels.where("quality = 1"), "doc_id").where("NOT base_failed")
    assert good.where("NOT kept").count() == 0


def _fingerprint(text):
    w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _groups(fps, most):
    """fps: id -> fingerprint; smallest id reachable over links of at most ``most`` bits."""
    parent = {i: i for i in fps}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(fps)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}


def test_simhash_edges(spark):
    texts = TEXTS + ["ÀB c D", TEXTS[4], None]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, fp int, rep int")
    out = {r.doc_id: (r.fp, r.component) for r in simhash.near_duplicates(df, "doc_id", ["doc_id"]).collect()}
    fps = {i: _fingerprint(t) for i, t in enumerate(texts)}
    assert {i: f & (1 << 64) - 1 for i, (f, _) in out.items()} == fps
    assert {i: c for i, (_, c) in out.items()} == _groups(fps, 4)
    assert simhash.near_duplicates(df.limit(0), "doc_id", ["doc_id"]).count() == 0


def test_simhash_whole_table(spark):
    out = Q.QUERIES["op10_simhash"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    fps = {r.doc_id: _fingerprint(r.text) for r in docs}
    assert {r.doc_id: int(r.fingerprint, 16) for r in out} == fps
    assert {r.doc_id: r.component_id for r in out} == _groups(fps, 4)


def _near_chain():
    """Three texts of which the second is near the first and the third, and these two are not near."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words)]
    while True:
        words[len(texts) * 7 % 400] = f"new{len(texts)}"
        texts.append(" ".join(words))
        near = [[(_fingerprint(a) ^ _fingerprint(b)).bit_count() <= 4 for b in texts] for a in (texts[0], texts[-1])]
        if not near[0][-1]:
            bridge = [i for i in range(1, len(texts) - 1) if near[0][i] and near[1][i]]
            if bridge:
                return texts[0], texts[bridge[0]], texts[-1]


def test_simhash_null_and_repeated_ids(spark):
    one, bridge, other = _near_chain()
    apart = [" ".join(f"{x}{i}" for i in range(60)) for x in "abcd"]
    rows = [(1, one), (None, bridge), (2, other), (None, apart[0]), (None, apart[1]), (9, apart[2]), (9, apart[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.text: r for r in simhash.near_duplicates(df, "doc_id", ["doc_id", "text"]).collect()}
    assert [out[t].component for t in (one, bridge, other, *apart)] == [1, 1, 1, None, None, 9, 9]
    assert len({out[t].component_fp for t in (one, bridge, other)}) == 1
    assert len({r.component_fp for r in out.values()}) == 5 and all(r.component_fp is not None for r in out.values())


@pytest.mark.parametrize("split", [32_768, 16])
def test_trie_join_finds_every_link(spark, monkeypatch, split):
    """Dense groups around few centres, chains at the limit, and subtrees cut into node pairs."""
    monkeypatch.setattr(simhash, "SPLIT_ROWS", split)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 64)
    monkeypatch.setattr(simhash, "LEAF_PAIRS", 4)
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1, 15, 31, 1 << 63}
    for centre in [rng.getrandbits(64) for _ in range(4)]:
        for _ in range(60):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
        chain = centre
        for _ in range(8):
            chain ^= sum(1 << b for b in rng.sample(range(64), 4))
            values.add(chain)
    fps = dict(enumerate(sorted(values, key=lambda v: (v * 7919) % 10_007)))
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)), i) for i, v in fps.items()], "fp long, rep long")
    comp = {r.node: r.component for r in simhash.components(simhash.links(df, 4)).collect()}
    assert {i: comp.get(i, i) for i in fps} == _groups(fps, 4)


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.range(n - 1).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.component for r in simhash.components(edges).collect()} == {0}
    assert simhash.components(edges.limit(0)).count() == 0
