"""WARC archives with revisit records.

Headers are shuffled by payload digest, records whose payload another record holds are joined to that
original response, and the deduplicated archives are written with fresh headers. Reading back joins
revisits to responses by record id.

Each record is a gzip member of its own, so tools can seek in an archive. Spark's own text writer makes
the files, so they go to any file system Spark can write, and a task that is run again leaves no part of a
file. The writer ends each value with a separator that can't be empty: a member ends with its length, whose
last byte is 0 below 16 MB, so that byte is the separator; a longer record is followed by an empty member.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelmetrics.llm.common import cut, text_or_empty
from duelmetrics.sources.scratch import scratch_dir

VERSION = "WARC/1.1"
#: A gzip member without content.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: Bytes of one archive file, or one record if that is longer; a reader holds one file at a time.
FILE_BYTES = 64 << 20
#: Parts over which the records of one payload are spread in joins.
SPREAD = 64
#: Rows of one batch of read or written records.
BATCH_ROWS = 500
#: Bytes that unpacking takes in and gives out at a time.
IN_BYTES, OUT_BYTES = 8 << 10, 1 << 20


def record_id(page_id, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{copy}')}>"


def base32(hexadecimal: str) -> str:
    """The bare base32 form of a SHA-1."""
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def spread_join(rows: DataFrame, lookup: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Left join of rows with lookup (one row per key), where one key may hold most of the rows.

    Rows of a key are spread by a hash of column `by`; lookup rows are repeated for the parts that occur.
    """
    part = F.pmod(F.xxhash64(by), F.lit(SPREAD)).alias("part")
    rows = rows.select("*", part)
    parts = rows.select(*keys, "part").distinct().join(lookup, keys)
    return rows.join(parts, [*keys, "part"], "left").drop("part")


def page_headers(rows: DataFrame) -> DataFrame:
    """page_id, url, and SHA-1, length and a second digest of the payload; key names page and payload."""
    payload = F.col("html").cast("binary")
    return rows.select(
        "page_id", "url", F.sha1(payload).alias("sha1"), F.octet_length("html").cast("long").alias("bytes"),
        F.xxhash64("html").alias("check"),
    ).withColumn("key", F.concat_ws(":", "sha1", "check", F.col("page_id").cast("string")))


def resolve(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Which page keeps each payload: key, original (page_id, url), records with the payload, is_original.

    Of equal payloads of at least `least_bytes` bytes the largest page_id is the original; without any
    page_id in the group it is the group's only key. Smaller payloads count one record.
    """
    payload = ["sha1", "bytes", "check"]
    pages = headers.groupBy("key", "page_id", *payload).agg(
        F.count("*").alias("copies"), F.min("url").alias("url")
    )
    named = F.struct(F.col("page_id").isNotNull().alias("named"), "page_id", "url", "key")
    originals = pages.filter(F.col("bytes") >= least_bytes).groupBy(*payload).agg(
        F.max(named).alias("original"), F.sum("copies").alias("records")
    )
    small = F.col("original").isNull()
    return spread_join(pages, originals, payload, by="key").select(
        F.col("key").alias("of_key"),
        F.when(small, F.lit(1)).otherwise(F.col("records")).alias("records"),
        (small | (F.col("key") == F.col("original.key"))).alias("is_original"),
        F.col("original.page_id").alias("original_id"),
        F.col("original.url").alias("original_url"),
    )


def _member(record: bytes) -> bytes:
    """The record as a gzip member, less the last byte, which is 0."""
    member = gzip.compress(record, 6, mtime=0)
    return (member if member[-1] == 0 else member + EMPTY_MEMBER)[:-1]


def _record(r: dict) -> bytes:
    payload = r["html"].encode()
    digest = base32(r["sha1"])
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{END}".encode()
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if r['revisit'] else 'response'}",
        f"WARC-Record-ID: {record_id(r['page_id'], digest, r['copy'])}",
        f"WARC-Date: {_line(r['date'])}",
        f"WARC-Target-URI: {_line(r['url'])}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {'' if r['page_id'] is None else r['page_id']}",
    ]
    if r["revisit"]:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(r['original_id'], digest, 0)}",
            f"WARC-Refers-To-Target-URI: {_line(r['original_url'])}",
        ]
    block = http if r["revisit"] else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END.encode() + block + END.encode()


def _members(file_bytes: int):
    """Records as gzip members, and the number of the task's file that each goes to."""

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, file = 0, 0
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                members, files = [], []
                for r in batch.slice(begin, BATCH_ROWS).to_pylist():
                    members.append(_member(_record(r)))
                    size = len(members[-1]) + 1
                    if held and held + size > file_bytes:
                        held, file = 0, file + 1
                    held += size
                    files.append(file)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(members, pa.binary()), pa.array(files, pa.int32())], names=["member", "file"]
                )

    return render


def _line(text: str | None) -> str:
    """A header value: line breaks and other control characters percent-encoded."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in text or "")


def write_archives(
    pages: DataFrame,
    path: str,
    least_bytes: int = 0,
    date: str | Column = "2025-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write a record per row of pages (page_id, url, html) to gzip archives in the folder `path`.

    Null html is an empty payload, a null url an empty target. Payloads are UTF-8. Rows that repeat a
    page_id with the same payload are copies of it, of which one can be the response. date: of the records,
    a text or a column of pages. The payloads are shuffled once, over as many partitions as the session
    sets; a task starts another file when one holds `file_bytes`. An empty table writes no archive.
    """
    rows = pages.select(
        "page_id",
        F.col("url").cast("string").alias("url"),
        text_or_empty("html").alias("html"),
        (F.lit(date) if isinstance(date, str) else date).cast("string").alias("date"),
    )
    decided = resolve(cut(page_headers(rows)), least_bytes)
    payload = F.col("html").cast("binary")
    keyed = rows.withColumn("sha1", F.sha1(payload)).withColumn(
        "key", F.concat_ws(":", "sha1", F.xxhash64("html"), F.col("page_id").cast("string"))
    )
    copies = Window.partitionBy("key").orderBy(F.col("url").asc_nulls_last())
    revisit = (F.col("records") > 1) & ~(F.col("is_original") & (F.col("copy") == 0))
    # one shuffle of the payloads: the join and the numbering of copies share it
    joined = (
        keyed.repartition("key")
        .join(decided.repartition("of_key"), F.col("key") == F.col("of_key"))
        .withColumn("copy", F.row_number().over(copies) - 1)
        .select(
            "page_id", "url", "html", "date", "sha1", "copy", "original_id", "original_url",
            revisit.alias("revisit"),
        )
    )
    (
        joined.mapInArrow(_members(file_bytes), "member binary, file int")
        .select(F.col("member").cast("string").alias("value"), "file")
        .write.option("lineSep", "\0")
        .partitionBy("file")
        .text(path)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record_id, page_id, url, date, record_type, payload_digest, payload_bytes,
    refers_to (the record id that a revisit names), payload (null for a revisit).

    The payload of a response is checked against its length and digest. Each file is read in one piece,
    which FILE_BYTES bounds, and unpacked in pieces. A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    ).option("recursiveFileLookup", True).load(path).filter("length > 0").select("content")
    return files.mapInArrow(
        _parse,
        "record_id string, page_id string, url string, date string, record_type string, "
        "payload_digest string, payload_bytes long, refers_to string, payload string",
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Each record with original_id and original_url: page_id and url of the response it refers to.

    records: as read_archives gives them. Null for responses. A revisit whose response is missing, or has
    another digest or length, ends the job. Payloads don't take part, nor do they come back.
    """
    narrow = records.drop("payload")
    responses = narrow.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.struct("page_id", "url", "payload_digest", "payload_bytes").alias("original"),
    )
    revisits = spread_join(
        narrow.filter("record_type = 'revisit'"), responses, ["refers_to"], by="record_id"
    )
    fits = F.coalesce(
        (F.col("original.payload_digest") == F.col("payload_digest"))
        & (F.col("original.payload_bytes") == F.col("payload_bytes")),
        F.lit(False),
    )
    broken = F.raise_error(
        F.concat(F.lit("no response with the payload of revisit "), F.coalesce("record_id", F.lit("without id")))
    )
    found = revisits.select(
        *narrow.columns,
        F.when(fits, F.col("original.page_id")).otherwise(broken.cast("string")).alias("original_id"),
        F.when(fits, F.col("original.url")).alias("original_url"),
    )
    none = F.lit(None).cast("string")
    return narrow.filter("record_type <> 'revisit'").select(
        "*", none.alias("original_id"), none.alias("original_url")
    ).unionByName(found)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for head, block in _split(content.as_py()):
                rows.append(_row(head, block))
                if len(rows) == BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, _ROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ROW)


_ROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.string()),
        ("url", pa.string()),
        ("date", pa.string()),
        ("record_type", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("refers_to", pa.string()),
        ("payload", pa.string()),
    ]
)


def _unpacked(content: bytes) -> Iterator[bytes]:
    """The unpacked bytes of all gzip members, piece by piece.

    Input goes in by small pieces, because what follows a member's end is copied each time.
    """
    data, at, rest, member = memoryview(content), 0, b"", None
    while True:
        if not rest:
            rest = data[at : at + IN_BYTES]
            at += len(rest)
        if member is None:
            if not rest:
                return
            member = zlib.decompressobj(wbits=31)
        ended = not rest
        piece = member.decompress(rest, OUT_BYTES)
        if member.eof:
            rest, member = member.unused_data, None
        else:
            rest = member.unconsumed_tail
            if ended and not piece:
                raise ValueError("an archive ends within a gzip member")
        if piece:
            yield piece


def _split(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields and block of each record."""
    held = bytearray()
    pieces = _unpacked(content)
    done = False

    def more() -> bool:
        nonlocal done
        piece = next(pieces, None)
        done = piece is None
        held.extend(piece or b"")
        return not done

    end = END.encode()
    while True:
        while (stop := held.find(end)) < 0 and more():
            pass
        if stop < 0:
            if held:
                raise ValueError("an archive ends within a record")
            return
        lines = held[:stop].decode("utf-8").split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"not a record: {lines[0][:40]}")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        begin = stop + len(end)
        finish = begin + int(head["Content-Length"])
        while len(held) < finish + len(end) and more():
            pass
        if held[finish : finish + len(end)] != end:
            raise ValueError("a record doesn't end where its length says")
        yield head, bytes(held[begin:finish])
        del held[: finish + len(end)]


def _row(head: dict, block: bytes) -> dict:
    http, payload = block.split(END.encode(), 1)
    length = int(http.rpartition(b"Content-Length: ")[2])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = head["WARC-Type"] == "revisit"
    if not revisit and (
        length != len(payload) or base32(hashlib.sha1(payload).hexdigest()) != digest
    ):
        raise ValueError(f"record {head['WARC-Record-ID']} doesn't match its digest")
    return {
        "record_id": head["WARC-Record-ID"],
        "page_id": head.get("X-Page-ID") or None,
        "url": head.get("WARC-Target-URI", ""),
        "date": head.get("WARC-Date"),
        "record_type": head["WARC-Type"],
        "payload_digest": digest,
        "payload_bytes": length,
        "refers_to": head.get("WARC-Refers-To"),
        "payload": None if revisit else payload.decode("utf-8"),
    }


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write pages as archives into a shared scratch folder, read them back, remove them.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to.
    """
    spark = pages.sparkSession
    id_type = pages.schema["page_id"].dataType
    path = scratch_dir(spark, "warc")
    try:
        write_archives(pages, path)
        records = cut(read_archives(spark, path).drop("payload"))
        return cut(
            resolve_revisits(records).select(
                F.col("page_id").cast(id_type).alias("page_id"),
                "payload_bytes",
                "payload_digest",
                "record_type",
                F.col("original_id").cast(id_type).alias("refers_to"),
            )
        )
    finally:
        remove(spark, path)
