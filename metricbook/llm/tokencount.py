"""Token counts behind a digest cache.

A stored count belongs to (digest of the tokenizer's file, library version and options; digest of the
normalised text). Counting a corpus hashes every text, joins the distinct digests to the stored counts,
encodes one text for each digest that has none, and appends the new counts. A row of the cache is a fact
of its own, so an append that was cut short or ran twice does no harm, and a new tokenizer version starts
its own folder.

Normalisation only merges texts that the tokenizer itself makes equal: null becomes empty, and where a
model has no normaliser of its own but writes blanks as U+2581, that character becomes a blank.

Within a text, a model none of whose pieces holds a blank after something else cannot join pieces across
the beginning of a run of blanks; such texts are encoded run by run, and a task remembers the counts of
the runs it has met. Other models get whole texts.

Defined results: a null or empty text has no bytes and no tokens; repeated rows, repeated or null ids get
one result each; no row is cut, however long; an empty table gives an empty result; further columns pass
only if named in ``keep``, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricbook.llm.common import ROW_FILE, ROW_INDEX, materialise, named_rows

BLANK = "▁"  # how sentencepiece writes a blank
REMEMBERED = 1 << 18  # runs whose counts a task keeps
RUN = re.compile(r" *[^ ]+| +$")
STORED = "digest binary, n_tokens long"


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


@lru_cache(maxsize=4)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def _json(path: str):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


def tokenizer_digest(path: str) -> str:
    """Names everything that a count depends on beside the text."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f"{library} {version(library)} bare\n".encode() + f.read()).hexdigest()


@lru_cache(maxsize=4)
def blanks_are_marks(path: str) -> bool:
    """Whether the model takes texts as they are, except for writing blanks as U+2581 and adding one in front."""
    if not path.endswith(".model"):
        return False
    probe = "AÅÅ  ﬁ İ\t　é "
    return _model(path).normalize(probe) == (BLANK + probe).replace(" ", BLANK)


@lru_cache(maxsize=4)
def runs_are_apart(path: str) -> bool:
    """Whether no piece holds a blank after another character: then no merge crosses where a run of blanks begins."""
    if not blanks_are_marks(path):
        return False
    model = _model(path)
    return not any(re.search(f"[^{BLANK}]{BLANK}| ", model.id_to_piece(i)) for i in range(model.get_piece_size()))


def normalised(text: Column, path: str) -> Column:
    out = F.coalesce(text, F.lit(""))
    return F.replace(out, F.lit(BLANK), F.lit(" ")) if blanks_are_marks(path) else out


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Token counts of a list of normalised texts."""
    if not path.endswith(".model"):
        return lambda texts: [len(x.ids) for x in _json(path).encode_batch(texts, add_special_tokens=False)]
    model = _model(path)
    if not runs_are_apart(path):
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    seen: dict[str, int] = {}

    def by_runs(texts: list[str]) -> list[int]:
        out = []
        for text in texts:
            runs = RUN.findall(" " + text) if text else []  # the model's own blank in front
            new = list({r for r in runs if r not in seen})
            if len(seen) + len(new) > REMEMBERED:
                seen.clear()
                new = list(set(runs))
            # Encoding adds the run's first blank again; one that is nothing else is a piece by itself.
            seen.update(zip(new, (len(x) or 1 for x in model.encode([r[1:] for r in new], num_threads=1))))
            out.append(sum(map(seen.__getitem__, runs)))
        return out

    return by_runs


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(STORED).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)


def _encode(texts: DataFrame, path: str) -> DataFrame:
    """(digest, n_tokens) of (digest, _text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            n = np.fromiter((count([t.as_py()])[0] for t in batch.column("_text")), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n)], names=["digest", "n_tokens"])

    return texts.select("digest", "_text").mapInArrow(run, STORED)


def count_tokens(docs: DataFrame, keep: list[str], cache: str, text: str = "text", path: str | None = None) -> DataFrame:
    """``keep`` columns, ``n_bytes`` and ``n_tokens`` of every text, and ``cached``: whether the count was
    stored before. New counts are appended to the folder ``cache``."""
    spark = docs.sparkSession
    path = path or default_tokenizer()
    folder = f"{cache}/tokenizer={tokenizer_digest(path)}"
    kept = {f"_k{i}": F.col(c) for i, c in enumerate(keep)}
    rows = named_rows(docs, kept | {"_text": normalised(F.col(text), path),
                                    "_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long")})
    rows = rows.withColumn("digest", F.unhex(F.sha2("_text", 256)))
    facts = materialise(rows.drop("_text"), "token-digests")
    known = _stored(spark, folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    first = facts.groupBy("digest").agg(F.min(F.struct(ROW_FILE, ROW_INDEX)).alias("at"))
    state = materialise(first.join(known, "digest", "left").select("digest", "at.*", "n_tokens"), "token-state")
    misses = state.where("n_tokens IS NULL").drop("n_tokens")
    texts = rows.select(ROW_FILE, ROW_INDEX, "_text").join(misses, [ROW_FILE, ROW_INDEX])
    fresh = materialise(_encode(texts, path), "token-counts")
    fresh.write.mode("append").parquet(folder)
    # Written tables on both sides: a digest that a third of all rows share can be split.
    counts = (state.where("n_tokens IS NOT NULL").select("digest", "n_tokens", F.lit(True).alias("cached"))
              .unionByName(fresh.select("digest", "n_tokens", F.lit(False).alias("cached"))))
    return facts.join(counts, "digest").select(*[F.col(k).alias(c) for k, c in zip(kept, keep)],
                                               F.col("_bytes").alias("n_bytes"), "n_tokens", "cached")
