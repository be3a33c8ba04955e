"""Mixing against its arithmetic, packing against the tokenizer and the bound on sequences."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from metricbook.llm import mixing, packing
from metricbook.llm import queries as Q

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def _targets(sizes, cycle=(5, 2, 1), most=3):
    """Repeated resharing of what passes the ceilings."""
    ranked = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(ranked)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in ranked if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else share[s] for s in ranked}
        capped |= over


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation_is_one(spark, n):
    df = spark.range(n).select("id", F.lit(n).cast("long").alias("n"), F.lit(3).alias("k"))
    df = df.withColumn("p", mixing.permuted("id", "n", ["k"])).withColumn("back", mixing.permuted("p", "n", ["k"], inverse=True))
    rows = df.collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def _docs(spark):
    rows = [(i, None if i % 11 == 0 else " ".join(f"w{j}" for j in range(i * 7 % 130)), s, "x", 5)
            for i, s in enumerate((["a"] * 60 + ["b"] * 12 + [None] * 9 + ["é"] * 4 + ["z"]) * 2)]
    rows += rows[5:8] + [(500, " lead\tand tail \n" * 300, "b", "x", 5), (501, "", "empty", "x", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, rank string, start int")


def test_mix_reaches_its_targets(spark):
    out = mixing.mix(_docs(spark), ["doc_id", "rank"], block_words=16).collect()
    size, taken = defaultdict(int), defaultdict(int)
    for r in out:
        size[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    want = _targets(dict(size))
    for r in out:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
    assert {s: t for s, t in taken.items()} == {s: int(np.floor(want[s] + 1e-6)) for s in want}
    again = mixing.mix(_docs(spark).repartition(5), ["doc_id", "rank"], block_words=16).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mix_whole_table(spark):
    out = Q.QUERIES["op2_mixing"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    assert dict(zip(out.doc_id, out["size"])) == {d: len(re.findall(WORD, t or "")) for d, t in zip(docs.doc_id, docs.text)}
    by = out.groupby("source").agg({"taken": "sum", "target": "first"})
    assert (abs(by.taken - by.target) <= 1).all()


def test_mix_without_rows_or_words(spark):
    assert mixing.mix(_docs(spark).limit(0), ["doc_id"]).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix(blank, ["doc_id"]).collect()] == [0, 0]


def test_shards_hold_the_targets(spark):
    sized = spark.createDataFrame([("a", 60_000), ("b", 30_000), ("c", 10_000)], "source string, size long")
    mixture = mixing.slots(mixing.targets(sized), block_words=10, shards=8)
    counts = mixing.shard_counts(mixture).toPandas().pivot(index="shard", columns="rank", values="slots")
    share = counts.div(counts.sum(axis=1), axis=0)
    assert abs(share.mean() - share).max().max() < 0.06 and len(counts) == 8


def test_mixed_documents_hold_the_words_taken(spark):
    docs = _docs(spark).withColumn("n_chars", F.char_length("text").cast("long"))
    out = mixing.mixed_documents(docs, n_chars="n_chars", block_words=16)
    assert out.columns == docs.columns
    rows = out.toPandas()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert (rows.n_chars == rows.text.str.len()).all()
    for r in rows.itertuples():
        have, rest = re.findall(WORD, texts[r.doc_id]), iter(re.findall(WORD, texts[r.doc_id]))
        mine = re.findall(WORD, r.text)
        assert mine and all(w in rest for w in mine) and (len(mine) < len(have) or r.text == texts[r.doc_id])
    words = rows.assign(n=rows.text.map(lambda t: len(re.findall(WORD, t))), source=rows.source.fillna("-")).groupby("source").n.sum()
    taken = mixing.mix(docs, ["doc_id"], block_words=16).toPandas()
    taken = taken.assign(source=taken.source.fillna("-")).groupby("source").taken.sum()
    assert words.to_dict() == {s: n for s, n in taken.items() if n}


@pytest.fixture(scope="module")
def bpe():
    import public_tokenizers
    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def _check(rows, texts, bpe, capacity=2048):
    """Every id of every document is packed once, in pieces that fit and lie gapless."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for d, parts in by_doc.items():
        ids, parts = bpe(texts[d]), sorted(parts, key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and sum(r.length for r in parts) == len(ids)
        assert len(parts) == 1 or all(r.length == capacity for r in parts[1:])
        for r in parts:
            piece = np.array(ids[r.start:r.start + r.length], "<u4")
            assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(r.length for r in rows)


def test_packing_whole_table(spark, bpe):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    used, tokens = _check(Q.QUERIES["op5_packing"](spark, sf).collect(), texts, bpe)
    assert used <= -(-tokens // 2048) * 1.01 + 1


def test_packing_edges(spark, bpe):
    texts = {0: None, 1: "", 2: "a", 3: "<|endoftext|> 's \n\n  x", 4: "word " * 2047, 5: "word " * 5000, 6: "é" * 9000, 7: "x" * 40_000}
    texts |= {i: "same length here" for i in range(10, 300)}
    df = spark.createDataFrame([(k, t, 9) for k, t in texts.items()], "doc_id long, text string, length int")
    used, tokens = _check(packing.pack(packing.pieces(df, ["doc_id"]), ["doc_id", "piece"]).collect(), texts, bpe)
    assert used <= -(-tokens // 2048) + 1
    twice = df.where("doc_id < 3").unionByName(df.where("doc_id < 3"))
    assert packing.pack(packing.pieces(twice, ["doc_id"]), ["doc_id", "piece"]).count() == 6
    assert packing.pack(packing.pieces(df.limit(0), ["doc_id"]), ["doc_id", "piece"]).count() == 0


def test_packing_survives_long_runs(spark, tmp_path):
    """Runs that the quicker tokenizer's pattern gives up on, with the ids of the JSON tokenizer."""
    import public_tokenizers
    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    n = 2_000_000
    texts = dict(enumerate([" " * n, "\n" * n, "x" * n, "漢" * (n // 4), "a" + " " * n + "<|endoftext|>" + "\t" * 150_000 + "b", "\u3000" * 150_000]))
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    exact = {k: t.encode(x, add_special_tokens=False).ids + [0] for k, x in texts.items()}
    by_text = {x: exact[k] for k, x in texts.items()}
    _check(Q.QUERIES["op5_packing"](spark, str(tmp_path)).collect(), texts, by_text.__getitem__)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    _check(P.best_fit_packing(spark, docs, None).collect(), texts, by_text.__getitem__)


def test_packing_emits_added_tokens(spark, tmp_path):
    """The query and the pipeline's stage against the JSON tokenizer as it comes."""
    import public_tokenizers
    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    end = "<|endoftext|>"
    assert t.encode(f"end {end} next", add_special_tokens=False).ids == [437, 220, 50256, 1306]
    texts = dict(enumerate([f"end {end} next", end, end * 3, f" {end}\n\n  {end} ", "<|endoftext", f"a  {end}  b <|endof{end}text|>",
                            f"word  {end} " * 1500, "é" + end + "'s", "plain", None]))
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    exact = lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]
    _check(Q.QUERIES["op5_packing"](spark, str(tmp_path)).collect(), texts, exact)
    _check(P.best_fit_packing(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), None).collect(), texts, exact)


def test_configurations_fill(spark):
    assert packing.fill(0, [60, 41, 39, 20], [1, 5, 5, 5], 100) == {0: 1, 3: 2}
    assert packing.fill(0, [50, 30], [2, 1], 100) == {0: 2}
    rows, n = packing.plan_large({70: 2, 30: 2, 50: 3}, 100, 1000)
    assert n == 4 and len(rows) > 0
