"""WARC archives with resolved revisits.

Headers (not payloads) are shuffled by payload digest to find, for every set of equal payloads, the
record that keeps the payload; the others become revisit records that name it. Archives are text
files written by Spark's own writer, so they are committed by task and land in any shared store.
Reading back frames records by Content-Length, so a payload may hold anything, and joins revisits to
their responses.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_RECORDS = 10_000        # records that one archive file holds at most
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
READ = 1 << 20

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("page_key", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_id", T.StringType()),
    T.StructField("payload", T.BinaryType()),
])


def base32_sha1(binary: Column) -> Column:
    """Upper-case base32 of the SHA-1: its 40 hexadecimal digits are four groups of ten, and five
    bits of a group at a time are one letter."""
    digits = F.sha1(binary)
    letters = []
    for group in range(4):
        number = F.conv(F.substring(digits, 10 * group + 1, 10), 16, 10).cast("bigint")
        for k in range(8):
            at = F.shiftright(number, 35 - 5 * k).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), at.cast("int"), F.lit(1)))
    return F.concat(*letters)


def header_value(text: Column) -> Column:
    """A field in one line: control characters become percent escapes, as does the escape itself."""
    out = F.replace(text, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record_id(key: Column) -> Column:
    digits = F.md5(F.concat(F.lit("page "), key))
    part = lambda start, size: F.substring(digits, start, size)
    return F.concat(F.lit("urn:uuid:"), F.concat_ws(
        "-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)))


def resolve(pages: DataFrame, key: str = "page_id", min_bytes: int = 0) -> DataFrame:
    """`digest`, `bytes` and `original`: the largest key of every payload of at least `min_bytes`.

    `pages` has `key`, `digest` and `bytes`. Equal digests and sizes are equal payloads. The
    maximum combines before the shuffle, so a payload with a third of all rows is no hot group.
    Payloads that occur once need no entry.
    """
    return pages.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(
        F.max(key).alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


def record(kind: Column) -> Column:
    """The text of one WARC record without its last line end, which the writer adds."""
    payload = F.when(kind == "revisit", "").otherwise(F.col("payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.concat(line("WARC-Refers-To", F.concat(
        F.lit("<"), record_id(F.col("original").cast("string")), F.lit(">"))),
        F.lit(f"WARC-Profile: {PROFILE}\r\n"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<"), record_id(
            F.coalesce(F.col("key").cast("string"), F.lit("null"))), F.lit(">"))),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        line("WARC-Target-URI", header_value(F.coalesce("url", F.lit("")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("key").isNotNull(), line("X-Page", F.col("key").cast("string"))).otherwise(""),
        F.when(kind == "revisit", revisit).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.octet_length(payload).cast("string")),
        F.lit("\r\n"), payload, F.lit("\r\n"))


def apart(name: Column) -> Column:
    """A key of the same rows that no aggregate on `name` is dealt out by. A join on it has shuffles
    of its own on both sides, which Spark can split where one key has many rows; a join on `name`
    would take over the aggregate's shuffle, which it cannot."""
    return F.reverse(name)


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url",
          html: str = "html", min_bytes: int = 0, file_records: int = FILE_RECORDS,
          compression: str = "gzip") -> None:
    """Writes one record per row to deduplicated archives under `path`.

    A null payload is empty. Of equal payloads the row with the largest key is the response; where
    several rows carry that key all of them are. Rows without a key are responses. A task
    writes archives of at most `file_records` records; they are gzip files (as a whole, not by
    record) unless `compression` is "none".
    """
    body = F.coalesce(pages[f"`{html}`"], F.lit(""))
    rows = pages.select(pages[f"`{key}`"].alias("key"), pages[f"`{url}`"].alias("url"),
                        body.alias("payload"))
    heads = rows.select("key", base32_sha1(F.col("payload").cast("binary")).alias("digest"),
                        F.octet_length("payload").cast("bigint").alias("bytes"))
    originals = resolve(heads, "key", min_bytes).select(
        F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes"), "original")
    named = rows.withColumns({
        "digest": base32_sha1(F.col("payload").cast("binary")),
        "bytes": F.octet_length("payload").cast("bigint")})
    # originals are one row per payload; a payload with many rows is split by the adaptive skew join
    joined = named.join(originals, (apart(named["digest"]) == apart(originals["_digest"]))
                        & (named["bytes"] == originals["_bytes"]), "left")
    kind = F.when(F.col("key") < F.col("original"), "revisit").otherwise("response")
    joined.select(record(kind).alias("value")).write.option("lineSep", "\r\n").option(
        "compression", compression).option("maxRecordsPerFile", file_records).text(path)


def pieces(content: bytes) -> Iterator[bytes]:
    """The bytes of an archive in parts; a gzip file is inflated as it is read, member by member."""
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(content), READ):
            yield content[at:at + READ]
        return
    rest = content
    while rest:
        inflate = zlib.decompressobj(31)
        part = inflate.decompress(rest, READ)
        while part:
            yield part
            part = inflate.decompress(inflate.unconsumed_tail, READ)
        if not inflate.eof:
            raise ValueError("the archive is cut off")
        rest = inflate.unused_data.lstrip(b"\0")


def unescape(value: str) -> str:
    return re.sub("%(25|0D|0A)", lambda m: chr(int(m[1], 16)), value)


def parse(content: bytes) -> Iterator[dict]:
    """The records of an archive, framed by Content-Length; a broken frame is an error."""
    held, more = bytearray(), pieces(content)

    def fill(enough) -> bool:
        while not enough():
            part = next(more, None)
            if part is None:
                return False
            held.extend(part)
        return True

    while fill(lambda: len(held) > 0):
        if not fill(lambda: b"\r\n\r\n" in held):
            raise ValueError("a header does not end")
        end = held.index(b"\r\n\r\n")
        first, *lines = held[:end].decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines)
        size = int(fields["Content-Length"])
        stop = end + 4 + size
        if not fill(lambda: len(held) >= stop + 4) or held[stop:stop + 4] != b"\r\n\r\n" or (
                not first.startswith("WARC/")):
            raise ValueError("a record does not end where its length says")
        yield {
            "record_id": fields["WARC-Record-ID"].strip("<>"), "record_type": fields["WARC-Type"],
            "page_key": fields.get("X-Page"), "url": unescape(fields["WARC-Target-URI"]),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "refers_id": fields.get("WARC-Refers-To", "").strip("<>") or None,
            "payload": bytes(held[end + 4:stop]),
        }
        del held[:stop + 4]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under `path` (see `RECORD`). An archive file is one task's
    input and is inflated in parts, so a task holds a compressed file and its largest record."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.name, pa.binary() if f.name == "payload" else pa.string())
                            for f in RECORD.fields])
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for row in parse(content.as_py()):
                    held.append(row)
                    size += len(row["payload"]) + 400
                    if size > READ:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return files.mapInArrow(run, RECORD)


def join_revisits(records: DataFrame) -> DataFrame:
    """Records with `payload_bytes` and `original_key`, those of the response a revisit refers to
    (its own size for a response). Only headers and sizes are joined; a response with very many
    revisits is split by the adaptive skew join. A revisit without its response keeps nulls."""
    heads = records.withColumn("bytes", F.octet_length("payload").cast("bigint")).drop("payload")
    responses = heads.where("record_type = 'response'").groupBy("record_id").agg(
        F.max("page_key").alias("original_key"), F.max("bytes").alias("original_bytes"))
    asked = F.when(F.col("record_type") == "revisit", F.col("refers_id"))
    joined = heads.withColumn("_asked", asked).join(
        responses.withColumnRenamed("record_id", "_response"),
        apart(F.col("_asked")) == apart(F.col("_response")), "left")
    revisit = F.col("record_type") == "revisit"
    return joined.withColumn("payload_bytes", F.when(revisit, F.col("original_bytes")).otherwise(
        F.col("bytes"))).drop("_asked", "_response", "bytes", "original_bytes")
