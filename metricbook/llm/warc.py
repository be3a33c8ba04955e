"""WARC archives through a chunked record table.

Payloads become rows (record, chunk number, bytes) of at most ``chunk_bytes``, cut from the Arrow buffer they
came in, each with its own digest and the running SHA-1 of the payload up to its end; no step holds more than
a chunk beyond the row it was given. Every chunk is written as one record: the first as ``response``, later
ones as ``continuation`` segments of it, and the last one carries the payload's digest, which is its running
one. A record whose payload equals that of an earlier one (and has at least ``min_bytes``) is written as
``revisit`` without payload. Reading goes line by line through the files, takes each block by its
Content-Length, and carries one hash over the segments that follow one another: the payload digest returned
is that of the bytes read, and a record is intact only if it is the stated one and no segment is missing,
damaged or out of turn.

Archives are gzip files written by Spark's text writer into a folder that all executors see; no
payload passes the driver.

Defined results: a null html is the empty payload; equal rows get records numbered in turn, the first
of them the response; a null id ranks after all ids; an empty table writes an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricbook.llm.common import ROW_FILE, ROW_INDEX, materialise, named_rows, shared_dir, with_running_offset

CHUNK_BYTES = 1 << 20


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def payloads(pages: DataFrame, id_col: str = "page_id", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """Row identity, ``id``, ``copy`` (numbers rows of one id), ``refers_to``/``refers_copy`` of the
    record with the same payload that comes first (null: this one is written as response).

    Only digests are compared and shuffled. The first record of a payload is found by an aggregate,
    so a payload that a third of all pages share is reduced before it moves."""
    body = F.coalesce(F.col(payload), F.lit(""))
    facts = pages.select(ROW_FILE, ROW_INDEX, F.col(id_col).alias("id"), F.sha1(body).alias("sha1"),
                         F.octet_length(body).cast("long").alias("n_bytes"))
    own = facts.where("id IS NOT NULL").withColumn("copy", F.row_number().over(
        Window.partitionBy("id").orderBy(ROW_FILE, ROW_INDEX)) - 1)
    # Rows without an id may be a large part of the table: numbered in buckets, not in one window.
    bare = with_running_offset(facts.where("id IS NULL").withColumn("_one", F.lit(1)).withColumn("_none", F.lit(0)), ["_none"],
                               [ROW_FILE, ROW_INDEX], "_one", "copy").select(*facts.columns, F.col("copy").cast("int").alias("copy"))
    numbered = materialise(own.unionByName(bare), "warc-digests")
    place = F.struct(F.col("id").isNull().alias("z"), F.col("id").alias("id"), F.col("copy").alias("copy"))
    first = (numbered.where(F.col("n_bytes") >= min_bytes).groupBy("sha1").agg(F.min(place).alias("first"))
             .where("first IS NOT NULL"))
    # Written, so that the join is between plain exchanges and a payload that many share can be split.
    found = numbered.join(materialise(first, "warc-first"), "sha1", "left")
    later = (F.col("n_bytes") >= min_bytes) & ~(F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.copy") == F.col("copy")))
    return found.select(ROW_FILE, ROW_INDEX, "id", "copy",
                        F.when(later, F.col("first.id")).alias("refers_to"),
                        F.when(later, F.col("first.copy")).alias("refers_copy"), later.alias("revisit"))


def _cut(data: memoryview, at: int, most: int) -> int:
    """End of the chunk that begins at ``at``: at most ``most`` bytes, not inside a character."""
    end = min(len(data), at + most)
    while at < end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return end


def chunk_table(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Records (``id``, ``copy``, ``url``, ``refers_to``, ``refers_copy``, ``revisit``, ``payload``) as
    chunk rows; a revisit is one row without data."""
    schema = ("id long, copy int, url string, refers_to long, refers_copy int, revisit boolean, chunk int, segmented boolean, "
              "last boolean, payload_bytes long, running_digest string, chunk_digest string, data string")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in names[:6]]
            payload = batch.column("payload")
            rows: list[tuple] = []
            held = 0
            for at in range(batch.num_rows):
                data = memoryview(payload[at].as_buffer() if payload[at].is_valid else b"")
                head = tuple(c[at].as_py() for c in columns)
                running, chunk, end = hashlib.sha1(), 0, 0
                while chunk == 0 or end < len(data):
                    start, end, chunk = end, _cut(data, end, chunk_bytes), chunk + 1
                    part = data[start:end]
                    running.update(part)
                    if head[5]:  # a revisit: only its digest is wanted
                        continue
                    rows.append((*head, chunk, len(data) > chunk_bytes, end == len(data), len(data), base32(running.digest()),
                                 base32(hashlib.sha1(part).digest()), str(part, "utf-8")))
                    held += end - start
                    if held > 8 * chunk_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)
                        rows, held = [], 0
                if head[5]:
                    rows.append((*head, 1, False, True, len(data), base32(running.digest()), base32(hashlib.sha1().digest()), ""))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    types = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(),
             pa.string(), pa.string(), pa.string()]
    return records.select("id", "copy", "url", "refers_to", "refers_copy", "revisit", "payload").mapInArrow(run, schema)


def _urn(ident: Column, copy: Column, chunk: Column | None = None) -> Column:
    name = F.concat_ws("-", F.coalesce(ident.cast("string"), F.lit("null")), copy.cast("string"))
    if chunk is not None:
        name = F.when(chunk > 1, F.concat_ws("-", name, F.lit("s"), chunk.cast("string"))).otherwise(name)
    return F.concat(F.lit("<urn:x-corpus:"), name, F.lit(">"))


def record_text(date: str) -> Column:
    """A chunk row as a WARC record without its very last line end (the text writer adds it)."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def optional(when: Column, *lines: Column) -> Column:
        return F.when(when, F.concat(*lines)).otherwise(F.lit(""))

    segmented, first = F.col("segmented"), F.col("chunk") == 1
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", _urn(F.col("id"), F.col("copy"), F.col("chunk"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.col("chunk_digest"))),
        optional(F.col("last"), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("running_digest")))),
        optional(first & F.col("revisit"),
                 line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                 line("WARC-Refers-To", _urn(F.col("refers_to"), F.col("refers_copy"))),
                 line("X-Payload-Length", F.col("payload_bytes").cast("string"))),
        optional(segmented, line("WARC-Segment-Number", F.col("chunk").cast("string"))),
        optional(~first, line("WARC-Segment-Origin-ID", _urn(F.col("id"), F.col("copy")))),
        optional(segmented & F.col("last"),
                 line("WARC-Segment-Total-Length", F.col("payload_bytes").cast("string"))),
        optional(segmented, line("X-Running-Digest", F.concat(F.lit("sha1:"), F.col("running_digest")))),
        line("Content-Length", F.octet_length("data").cast("string")),
        F.lit("\r\n"), F.col("data"), F.lit("\r\n\r"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
                   min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES, date: str = "2024-01-01T00:00:00Z") -> None:
    """One record per row of ``pages`` into gzip archives under ``path``. Chunks of a record follow
    one another: they come from one row and are not moved after that."""
    rows = named_rows(pages, {"page": F.col(id_col).cast("long"), "address": F.col(url), "body": F.col(payload)})
    known = payloads(rows, "page", "body", min_bytes)
    # Only the facts of rows that are no plain first copy travel to the payloads. Written first, their
    # size is known to the join: while they are few, the payloads need not move.
    special = materialise(known.where("revisit OR copy > 0"), "warc-special")
    records = (rows.join(special, [ROW_FILE, ROW_INDEX], "left")
               .select(F.col("page").alias("id"), F.coalesce("copy", F.lit(0)).alias("copy"), F.col("address").alias("url"),
                       "refers_to", "refers_copy", F.coalesce("revisit", F.lit(False)).alias("revisit"),
                       F.col("body").alias("payload")))
    (chunk_table(records, chunk_bytes).select(record_text(date).alias("value"))
     .write.option("lineSep", "\n").option("compression", "gzip").text(path))


def _records(lines: Iterator[tuple[str, str]]) -> Iterator[dict]:
    """Records of archives given as (file, line) in file order: headers, the block's digest and length taken line
    by line, the running digest over the segments of a record so far, and whether these followed one another."""
    name, head, need, digest, first = None, None, 0, None, True
    origin, segment, running = None, 0, None
    for file, text in lines:
        if file != name:
            if head is not None:
                raise ValueError(f"{name}: archive ends inside a record")
            name, head, first, need, origin, segment = file, None, True, 0, None, 0
        if head is None:
            if text in ("", "\r"):
                continue
            if text != "WARC/1.1\r":
                raise ValueError(f"{file}: no record begins with {text[:40]!r}")
            head, reading = {}, True
            continue
        if reading:
            if text == "\r":
                reading, need, digest, first = False, int(head["content-length"]), hashlib.sha1(), True
                number = int(head.get("warc-segment-number", 1))
                goes_on = head.get("warc-type") == "continuation"
                head["_unbroken"] = (head.get("warc-segment-origin-id") == origin and number == segment + 1) if goes_on else number == 1
                if not goes_on or not head["_unbroken"]:
                    running = hashlib.sha1()
                origin, segment = head.get("warc-segment-origin-id" if goes_on else "warc-record-id"), number
                head["_length"] = need
            else:
                field, _, value = text.rstrip("\r").partition(": ")
                head[field.lower()] = value
            continue
        data = (text if first else "\n" + text).encode()
        first = False
        if len(data) < need:
            digest.update(data)
            running.update(data)
            need -= len(data)
            continue
        digest.update(data[:need])
        running.update(data[:need])
        if data[need:] != b"\r":
            raise ValueError(f"{file}: a block does not end where its length says")
        head["_digest"], head["_running"] = base32(digest.digest()), base32(running.digest())
        yield head
        head = None
    if head is not None:
        raise ValueError(f"{name}: archive ends inside a record")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment: ``id``, ``copy``, ``chunk``, ``type``, ``payload_bytes`` and ``payload_digest`` (as stated,
    on the last segment), ``running_digest`` (of the bytes read so far), ``refers_to``, ``block_bytes``,
    ``block_digest`` (of the bytes read) and ``intact`` (block as stated, segment in its turn)."""
    schema = ("id long, copy int, chunk int, type string, payload_bytes long, payload_digest string, "
              "running_digest string, refers_to long, block_bytes long, block_digest string, intact boolean")
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(),
             pa.string(), pa.bool_()]

    def ident(urn: str) -> tuple[int | None, int]:
        page, _, copy = urn.removeprefix("<urn:x-corpus:").removesuffix(">").split("-s-")[0].rpartition("-")
        return (None if page == "null" else int(page)), int(copy)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), batch.column("value").to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for r in _records(lines(batches)):
            kind = r["warc-type"]
            page, copy = ident(r["warc-segment-origin-id"] if kind == "continuation" else r["warc-record-id"])
            total = r.get("x-payload-length") or r.get("warc-segment-total-length")
            if total is None and "warc-segment-number" not in r:
                total = r["_length"]
            rows.append((page, copy, int(r.get("warc-segment-number", 1)), kind, None if total is None else int(total),
                         r.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                         r["_running"],
                         ident(r["warc-refers-to"])[0] if kind == "revisit" else None, r["_length"], r["_digest"],
                         r["warc-block-digest"] == "sha1:" + r["_digest"] and r["_unbroken"]))
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    # gzip files are read from their first line to the last by one task.
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file")).mapInArrow(run, schema)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record: ``id``, ``copy``, ``payload_bytes``, ``payload_digest`` (of the bytes read; of a revisit,
    which has none, the stated one), ``type``, ``refers_to`` and ``intact``: all segments are there, in turn and as
    their blocks' digests say, and the bytes read have the length and the digest stated for the payload."""
    segments = read_archives(spark, path)
    head = F.col("type") != "continuation"
    whole = segments.groupBy("id", "copy").agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("_stated"),
        F.max(F.when(head, F.col("type"))).alias("type"), F.max("refers_to").alias("refers_to"), F.sum("block_bytes").alias("_read"),
        F.max_by("running_digest", "chunk").alias("_running"), F.min("intact").alias("_blocks"),
        ((F.max("chunk") == F.count("*")) & (F.count_if(head) == 1)).alias("_all"))
    revisit = F.col("type") == "revisit"
    sound = F.col("_blocks") & F.col("_all") & F.col("_stated").isNotNull() & (
        revisit | ((F.col("_running") == F.col("_stated")) & (F.col("_read") == F.col("payload_bytes"))))
    return whole.select("id", "copy", F.when(revisit, F.col("payload_bytes")).otherwise(F.col("_read")).alias("payload_bytes"),
                        F.when(revisit, F.col("_stated")).otherwise(F.col("_running")).alias("payload_digest"), "type", "refers_to",
                        F.coalesce(sound, F.lit(False)).alias("intact"))


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html",
                     min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Writes ``pages`` into archives in the shared folder and reads them back."""
    path = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, id_col, url, payload, min_bytes, chunk_bytes)
    return read_payloads(pages.sparkSession, path)
