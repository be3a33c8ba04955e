"""The quality and language models against plain versions of their methods."""

import math
import zlib
from collections import Counter

import numpy as np

from metricbook.llm import langid, qda
from metricbook.llm import queries as Q

SF = "/root/testdata/sf0.01"


def test_quality_scores_are_those_of_a_plain_discriminant(spark):
    """Statistics from the operator; means, shrunk covariances, log densities and Bayes' rule by themselves."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = qda.statistics(docs, ["doc_id"]).collect()
    x = {r.doc_id: np.array([r[s] for s in qda.STATISTICS]) for r in rows}
    taught = [(r.doc_id, r.quality) for r in labels.collect() if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    known = np.array([x[d] for d, _ in taught])
    y = np.array([q for _, q in taught])
    centre, scale = known.mean(axis=0), known.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1)
    z = (known - centre) / scale
    own = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    n = [int((y == k).sum()) for k in (0, 1)]
    pooled = (n[0] * own[0] + n[1] * own[1]) / sum(n)

    def log_density(v, k):
        near = 0.8 * own[k] + 0.2 * pooled
        d = len(near)
        cov = 0.95 * near + 0.05 * np.trace(near) / d * np.eye(d)
        off = v - z[y == k].mean(axis=0)
        return math.log(n[k]) - np.linalg.slogdet(cov)[1] / 2 - off @ np.linalg.solve(cov, off) / 2

    got = {r.doc_id: r for r in Q.QUERIES["op4_quality"](spark, SF).collect()}
    assert set(got) == set(x) and min(n) > 20
    for d, v in x.items():
        v = (v - centre) / scale
        margin = np.clip(log_density(v, 0) - log_density(v, 1), -500, 500)
        assert abs(got[d].score - 1 / (1 + math.exp(margin))) < 1e-6
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and got[d].predicted == int(got[d].score >= 0.5)


MASK = (1 << 64) - 1


def _grams(text):
    """Hashed 1- to 3-grams of the lower-cased letters, runs of other characters being one border; one by one."""
    letters, border = [0], True
    for c in text or "":
        if c.isalpha():
            low = c.lower()
            letters.append(ord(low) if len(low) == 1 else ord(c))
            border = False
        elif not border:
            letters.append(0)
            border = True
    if not border:
        letters.append(0)
    out = Counter()

    def add(value, salt):
        value &= MASK
        out[((((value ^ (value >> 29)) * 0xBF58476D1CE4E5B9) + salt) & MASK) >> 52] += 1

    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if b:
            add(b * 0x9E3779B97F4A7C15, 1)
        if a or b:
            add(a * 0xC2B2AE3D27D4EB4F + b * 0x165667B19E3779F9, 2)
        if b:
            add(a * 0x27D4EB2F165667C5 + b * 0x85EBCA77C2B2AE63 + c * 0xD6E8FEB86659FD93, 3)
    return out


def _em(grams, table, allowed):
    n = sum(grams.values())
    share = {k: 1 / len(allowed) for k in allowed}
    for _ in range(langid.ITERATIONS):
        new = dict.fromkeys(allowed, 0.0)
        for g, times in grams.items():
            whole = sum(share[k] * table[k][g] for k in allowed)
            for k in allowed:
                new[k] += times * share[k] * table[k][g] / whole
        share = {k: v / n for k, v in new.items()}
    return share, sum(t * math.log(sum(share[k] * table[k][g] for k in allowed)) for g, t in grams.items())


def _infer(grams, table):
    allowed = list(range(len(table)))
    share, fit = _em(grams, table, allowed)
    cost = langid.PENALTY / 2 * math.log(max(sum(grams.values()), 2))
    while len(allowed) > 1:
        fewer = [k for k in allowed if k != min(allowed, key=lambda k: share[k])]
        less, without = _em(grams, table, fewer)
        if without + cost < fit:
            break
        allowed, share, fit = fewer, less, without
    return [share.get(k, 0.0) for k in range(len(table))]


def test_language_shares_are_those_of_a_plain_em(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    names, table = langid.train(docs.where("crc32(CAST(doc_id AS STRING)) % 4 <> 2"))
    sums = {k: Counter() for k in names}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            sums[r.lang].update(_grams((r.text or "")) if len(r.text or "") < langid.PART else {})
    plain = [[(sums[k][f] + 0.5) for f in range(langid.FEATURES)] for k in names]
    plain = [[v / sum(row) for v in row] for row in plain]
    assert max(len(r.text or "") for r in rows) < langid.PART and np.allclose(plain, table, rtol=1e-9)
    by_lang = {k: next(r.text for r in rows if r.lang == k and r.text and len(r.text) > 800)[:800] for k in names}
    texts = [r.text for r in rows[:25]] + [None, "", "12 34", "a", "Ä", "word"]
    texts += [by_lang[a] + " " + by_lang[b][:n] for a in names for b in names if a < b for n in (60, 300, 800)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(df, ["doc_id"], names, table).collect()}
    mixed = 0
    for i, t in enumerate(texts):
        grams = _grams(t)
        if not grams:
            assert got[i].lang_pred == "und" and got[i].score == 0
            continue
        want = _infer(grams, plain)
        assert np.allclose(got[i].shares, want, atol=2e-3), (i, got[i].shares, want)
        assert got[i].lang_pred == names[int(np.argmax(want))] and abs(got[i].score - max(want)) < 2e-3
        mixed += sum(w > 0.1 for w in want) > 1
    assert mixed >= 6
