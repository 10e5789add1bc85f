"""Web archives written and read as tables of record chunks.

A payload is cut into chunks where its row is read: from there on a record is rows of its number, the chunk's number and the chunk. Each chunk
is a WARC/1.1 record of its own: the first a ``response``, the others ``continuation`` records with their segment number,
as the format provides for segmented records. Both ways records are told apart by Content-Length, and digests are
carried from chunk to chunk, so no step behind the source's own rows holds more than a chunk.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdq.llm import shared
from salesdq.plans import join_many_to_one

CHUNK_CHARS = 1 << 16
VERSION, EOL = "WARC/1.1", "\r\n"
#: Between two records: the end of a block, and the next record's first line.
BREAK = EOL + EOL + VERSION + EOL
DIGESTS = "page_id long, payload_key long, payload_bytes long, payload_digest string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _base32(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


def chunk_table(pages: DataFrame, *keep: str) -> DataFrame:
    """A row for each chunk: page_id, payload_key (a hash of the payload), record (a number of the row), chunks, k and chunk.

    pages: page_id, payload and what else to ``keep``. Chunks are CHUNK_CHARS characters each but the last, cut by Spark in one walk over the payload; an empty payload is one
    empty chunk. A record's chunks follow each other in one task.
    """
    cut = F.regexp_extract_all("payload", F.lit(f"(?s).{{1,{CHUNK_CHARS}}}+"), F.lit(0))  # possessive: a loop, without recursion
    rows = pages.select("page_id", *keep, F.xxhash64("payload").alias("payload_key"), F.monotonically_increasing_id().alias("record"), cut.alias("cut"))
    rows = rows.withColumn("chunks", F.greatest(F.size("cut"), F.lit(1)))
    rows = rows.select("page_id", *keep, "payload_key", "record", "chunks", F.posexplode_outer("cut").alias("k", "chunk"))
    return rows.withColumns({"k": F.coalesce("k", F.lit(0)), "chunk": F.coalesce("chunk", F.lit(""))})


def carried_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(page_id, payload_key, bytes, SHA-1) of each record of a chunk table, whose rows come in order."""
    sha1, size = hashlib.sha1(), 0
    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "payload_key", "chunks", "k", "chunk")]
        for i in range(batch.num_rows):
            page_id, key, chunks, k, chunk = (c[i] for c in columns)
            block = chunk.as_buffer()
            sha1.update(block)
            size += block.size
            if k.as_py() == chunks.as_py() - 1:
                yield page_id.as_py(), key.as_py(), size, _base32(sha1)
                sha1, size = hashlib.sha1(), 0


def payload_digests(chunks: DataFrame) -> DataFrame:
    """Bytes and SHA-1 of each payload, summed up chunk by chunk; ``payload_key`` is a hash to find the record again."""
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = carried_digests(parts)
        while some := list(islice(found, 1000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names)

    return chunks.mapInArrow(run, DIGESTS)


def _segment(page_id, url, chunks, k, chunk, size, digest, kind, refers_to) -> str:
    """A chunk's record as text."""

    def record(name: str, block: str, *more: str) -> str:
        data = block.encode()
        block_digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        header = [VERSION, f"WARC-Type: {name}", *more, f"WARC-Block-Digest: sha1:{block_digest}", "Content-Type: text/html"]
        return EOL.join([*header, f"Content-Length: {len(data)}", "", block])

    own = "none" if page_id is None else page_id
    origin = f"<urn:page:{own}:{digest}>"
    common = [f"WARC-Target-URI: {(url or '').replace(chr(13), ' ').replace(chr(10), ' ')}", "WARC-Date: 1970-01-01T00:00:00Z"]
    facts = [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", f"X-Page-Id: {own}"]
    if kind == "revisit":
        return record("revisit", "", f"WARC-Record-ID: {origin}", *common, *facts, f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>", f"X-Refers-To: {refers_to}")
    place = [f"WARC-Segment-Number: {k + 1}"] if chunks > 1 else []
    if k:
        place += [f"WARC-Segment-Origin-ID: {origin}"]
    return record("continuation" if k else "response", chunk, f"WARC-Record-ID: {f'<urn:page:{own}:{digest}:{k + 1}>' if k else origin}", *common, *facts, *place)


def archive_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of a chunk table with the facts of its payloads, as text, some chunks at a time."""
    names = ("page_id", "url", "chunks", "k", "chunk", "payload_bytes", "payload_digest", "record_type", "refers_to")
    for batch in batches:
        out, size = [], 0
        columns = [batch.column(c) for c in names]
        for i in range(batch.num_rows):
            out.append(_segment(*(c[i].as_py() for c in columns)))
            size += len(out[-1])
            if size > 16 * CHUNK_CHARS:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write one record for each row of (page_id, url, html) to gzip-compressed archives below ``path``.

    Of rows with equal payloads of at least ``least_bytes`` bytes, that with the largest page_id is a response and holds the
    payload; the others are revisits that refer to it. A null html is an empty payload. Rows that repeat a response's page_id
    and payload are responses too; a null page_id counts as smaller than any other. Other columns are left out.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    digests = shared.stored(payload_digests(chunk_table(source)), "digests")
    first = digests.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"))
    # a payload that very many pages have, such as an empty one, is left to the adaptive split
    facts = join_many_to_one(digests.distinct(), first, "payload_digest", bound=digests)
    revisit = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    facts = facts.select(
        F.col("page_id").alias("id"),
        F.col("payload_key").alias("fact_key"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
    )
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("payload_key") == F.col("fact_key"))
    known = chunk_table(source, "url").join(facts, same).where("record_type = 'response' or k = 0").drop("id", "fact_key", "payload_key")
    ordered = known.sortWithinPartitions("record", "k")  # a record's chunks come from one task, so they are together
    ordered.mapInArrow(archive_texts, "value string").write.option("lineSep", EOL + EOL).option("compression", "gzip").text(path)


def read_archives(spark, path: str) -> DataFrame:
    """Records of the archives below ``path``: each payload's bytes and digest as summed up over its chunks, type and reference.

    A file is read as rows that end where a record may end; a row whose block is shorter than its Content-Length is
    continued by the next, so payloads may hold any text. Chunks of a record are only counted and hashed, one after the other.
    """

    def records(rows: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict, bytes]]:
        """Header and block of each record of a file; a block may come in parts, all but the last without a header."""
        header, missing, file = {}, 0, None
        for name, line in rows:
            if name != file:
                assert missing == 0, f"{file} ends within a block"
                file = name
                line = line.removeprefix((VERSION + EOL).encode())
            if missing:
                block = BREAK.encode() + line
            else:
                head, _, block = line.partition(b"\r\n\r\n")
                header = dict(x.split(": ", 1) for x in head.decode().split(EOL) if ": " in x)
                missing = int(header["Content-Length"])
            if len(block) - missing == 4 and block.endswith(b"\r\n\r\n"):  # the last of the file
                block = block[:-4]
            missing -= len(block)
            assert missing >= 0, f"{file} has a block longer than announced"
            yield ({} if missing else header), block

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((n, v) for b in parts for n, v in zip(b.column("file").to_pylist(), b.column("value").to_pylist()))
        out, now, sha1, size, blocks = [], {}, hashlib.sha1(), 0, []

        def done() -> None:
            if not now:
                return
            digest, length = now["WARC-Payload-Digest"].removeprefix("sha1:"), int(now["X-Payload-Length"])
            kind, page, refers_to = now["WARC-Type"], now["X-Page-Id"], now.get("X-Refers-To")
            assert kind == "revisit" or (digest, length) == (_base32(sha1), size), f"page {page} has a wrong digest"
            out.append((None if page == "none" else int(page), length, digest, kind, refers_to and int(refers_to)))

        for header, block in records(rows):
            blocks.append(block)
            if not header:
                continue
            if header["WARC-Type"] != "continuation":
                done()
                now, sha1, size = header, hashlib.sha1(), 0
            for block in blocks:
                sha1.update(block)
                size += len(block)
            blocks = []
            if len(out) >= 1000:
                yield batch(out)
                out.clear()
        done()
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    lines = spark.read.option("lineSep", BREAK).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(run, RECORDS)


def op2_warc_chunks(spark, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    path = shared.folder(spark, "archives")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_archives(spark, path)
