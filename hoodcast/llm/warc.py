"""Content-addressed web archive.

``write_archive`` turns rows into WARC records and stores them as two tables
under one folder: ``payloads`` holds each distinct payload once, addressed by
its SHA-256, and ``headers`` the exact header bytes of every record with that
address. ``read_archive`` joins the two back into the original records and
checks every payload against its address. ``export_warc`` / ``read_warc`` write
and parse plain WARC files.

Of records with equal payloads (of at least ``min_bytes`` bytes) the one with the
smallest id is ``response``, the others are ``revisit`` and name it.

Edge cases: a null payload is empty; a null id is never the smallest (rows that
all lack one stay responses); rows repeating the smallest id are all responses,
their payload is stored once; a null address leaves its header field out; control
characters in an address are percent-escaped. An empty table gives an empty archive.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoodcast.llm.registry import query, table
from hoodcast.session import ensure_checkpoint_dir

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records per plain WARC file at most.
RECORDS_PER_FILE = 5_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: every five hexadecimal digits are four base32 ones."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_archive(rows: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row. A revisit's length field is the full payload's."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    r = rows.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")) \
        .withColumn("sha256", F.sha2("payload", 256))
    light = r.select("id", "url", "sha256", F.octet_length("payload").cast("long").alias("n"),
                     base32_sha1(F.col("payload")).alias("sha1"))
    # One exchange of payload bytes: copies collapse in their tasks before it. Equal addresses must mean
    # equal payloads: a second digest and the length have to agree.
    stored = r.select("id", "sha256", "payload", F.octet_length("payload").alias("n"), F.sha1("payload").alias("sha1")) \
        .groupBy("sha256").agg(
            F.min("id").alias("owner"), F.first("payload").alias("payload"),
            ((F.min("n") == F.max("n")) & (F.min("sha1") == F.max("sha1"))).alias("verified"))
    verified = F.when(F.col("verified"), True).otherwise(
        F.raise_error(F.concat(F.lit("payloads differ under one address: "), "sha256")).cast("boolean"))
    stored = _stage(stored.where(verified).select("sha256", "owner", "payload"), f"{path}/payloads")
    mine = stored.select(F.col("sha256").alias("o_sha256"), "owner")
    j = light.join(mine, light.sha256 == mine.o_sha256)
    j = j.withColumn("revisit", F.coalesce(
        (F.col("n") >= min_bytes) & F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner")), F.lit(False)))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:record:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("id"))),
        F.coalesce(line("WARC-Target-URI", target), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                                          line("WARC-Refers-To", urn(F.col("owner"))))).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.col("n").cast("string")), F.lit("\r\n"))
    j.select(head.cast("binary").alias("header"), "sha256").write.parquet(f"{path}/headers")


def field(header: Column, name: str) -> Column:
    """A header field's value, null when absent or empty."""
    return F.nullif(F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload): the original records, each payload verified against its
    address, its length and digest fields."""
    heads, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads").drop("owner")
    j = heads.join(payloads.withColumnRenamed("sha256", "address"), F.col("sha256") == F.col("address"))
    text = F.col("header").cast("string")
    good = (F.sha2("payload", 256) == F.col("address")) \
        & (field(text, "Content-Length") == F.octet_length("payload").cast("string")) \
        & (field(text, "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))))
    checked = F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("address"))).cast("binary"))
    return j.select("header", checked.alias("payload"))


def describe(records: DataFrame, id_type: str = "long") -> DataFrame:
    """Fields of records as columns, digest and size taken from the payload itself."""
    text = F.col("header").cast("string")
    urn = lambda name: F.regexp_extract(field(text, name), r"^<urn:record:(.*)>$", 1)
    number = lambda c: F.nullif(c, F.lit("")).cast(id_type)
    return records.select(
        number(urn("WARC-Record-ID")).alias("id"), field(text, "WARC-Target-URI").alias("url"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        field(text, "WARC-Type").alias("record_type"), number(urn("WARC-Refers-To")).alias("refers_to"))


def export_warc(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Plain WARC files: header, payload, blank line. Revisits carry their payload too."""
    both = F.concat("header", "payload").cast("string")
    records.select(both.alias("value")).write.option("lineSep", "\r\n\r\n") \
        .option("maxRecordsPerFile", records_per_file).text(path)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for content in b.column("content"):
            data, at, heads, payloads = memoryview(content.as_buffer()), 0, [], []
            raw = content.as_py()
            while at < len(data):
                end = raw.index(b"\r\n\r\n", at) + 4
                size = next(int(x[15:]) for x in raw[at:end].split(b"\r\n") if x.lower().startswith(b"content-length:"))
                heads.append(raw[at:end])
                payloads.append(raw[end:end + size])
                if raw[end + size:end + size + 4] != b"\r\n\r\n":
                    raise ValueError("a record does not end where its length says")
                at = end + size + 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads, pa.binary()), pa.array(payloads, pa.binary())], ["header", "payload"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload) of plain WARC files; a file, bounded at export, is parsed by one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_parse, "header binary, payload binary")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
g AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS hex, b, min(page_id) OVER (PARTITION BY b) AS o
      FROM p),
digits AS (SELECT page_id, list_transform(range(8), lambda k: CAST('0x' || substr(hex, 5 * k + 1, 5) AS BIGINT)) AS v
           FROM g)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(v, lambda x: list_aggregate(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((x >> s) & 31) + 1)::INT, 1)), 'string_agg', '')),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = o THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> o THEN o END AS refers_to
FROM g JOIN digits USING (page_id)"""


@query("op5_web_archive", ORACLE)
def op5(spark, sf_dir):
    path = os.path.join(ensure_checkpoint_dir(spark), "warc", uuid.uuid4().hex)
    write_archive(table(spark, sf_dir, "pages"), path)
    return describe(read_archive(spark, path)).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
