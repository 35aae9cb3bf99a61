"""Content-addressed WARC archive.

An archive is two tables: ``payloads`` holds the bytes of each different payload once, under their SHA-256;
``headers`` holds the exact header block of every record. A record is its header block, an empty line, its
payload and two line ends; it is put together again by joining the tables on the digest. Digests are counted
again from the bytes that are read back. A record whose payload is lost, or fails that test, stays in the result with
a null payload, record and payload digest; ``lost`` lists such records.

Payloads of at least 100 bytes that are equal share one ``response`` record, that with the smallest page_id;
the others are ``revisit`` records which refer to it. Shorter ones are all responses.

Defined results: null html is the empty payload; rows that repeat the smallest page_id are responses too;
a null page_id counts as larger than any other, and where all are null, all are responses; a null url is left
out of the header. Extra columns are not stored. An empty table gives empty archives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outorga.llm.common import stored
from outorga.session import new_folder

SHARED_FROM = 100
END = "\r\n"
EMPTY_DATE = "1970-01-01T00:00:00Z"


def _body(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def firsts(pages: DataFrame, shared_from: int = SHARED_FROM) -> DataFrame:
    """Per digest of a payload that records may share: the page_id of its response and its number of
    records. Rows are added up before they move, so many copies of one payload don't meet in a task."""
    rows = pages.select("page_id", F.sha2(_body(F.col("html")), 256).alias("digest"), F.octet_length(_body(F.col("html"))).alias("bytes"))
    return rows.filter(F.col("bytes") >= shared_from).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))


def records(pages: DataFrame, shared_from: int = SHARED_FROM, date: str = EMPTY_DATE) -> DataFrame:
    """(page_id, digest, header): the header block of every record, without payloads."""
    rows = pages.select(
        "page_id", "url", F.sha2(_body(F.col("html")), 256).alias("digest"), F.octet_length(_body(F.col("html"))).cast("long").alias("bytes"))
    many = stored(firsts(pages, shared_from).filter(F.col("n") > 1)).select(F.col("digest").alias("_d"), "first")
    rows = rows.join(many, F.col("digest") == F.col("_d"), "left")
    kind = F.when(F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first")), "response").otherwise("revisit")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END))
    record_id = lambda page: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))  # they would end the header line
    header = F.concat(
        F.lit(f"WARC/1.1{END}"), line("WARC-Type", kind), line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(kind == "revisit", F.concat(
            line("WARC-Refers-To", record_id(F.col("first"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.col("bytes")))
    return rows.select("page_id", "digest", header.alias("header"))


def write(pages: DataFrame, path: str, shared_from: int = SHARED_FROM) -> None:
    """Write both tables below ``path``."""
    records(pages, shared_from).write.mode("overwrite").parquet(f"{path}/headers")
    body = _body(F.col("html"))
    pages.select(F.sha2(body, 256).alias("digest"), body.alias("payload")).dropDuplicates(["digest"]).write.mode(
        "overwrite").parquet(f"{path}/payloads")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads with what their bytes say: (digest, payload, payload_bytes, verified)."""
    table = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    return table.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "verified", F.sha2("payload", 256) == F.col("digest"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive, each put together from its header and its payload, with what its header says.

    Columns: record (bytes), page_id, payload, payload_bytes, payload_digest (these four but page_id null where the
    payload is lost or its bytes don't have the digest they are stored under), record_type, refers_to.
    """
    headers = spark.read.schema("page_id long, digest string, header string").parquet(f"{path}/headers")
    field = lambda name: F.nullif(F.regexp_extract("header", rf"(?m)^{name}: (.*)$", 1), F.lit(""))
    page = lambda name: F.expr(f"try_cast(regexp_extract({name}, '<urn:page:(-?[0-9]+)>', 1) as long)")
    said = headers.select(
        "header", field("WARC-Record-ID").alias("_id"), field("WARC-Type").alias("record_type"), field("WARC-Refers-To").alias("_to"),
        field("Content-Length").cast("long").alias("_length"), F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "").alias("_digest"))
    whole = said.join(payloads(spark, path), F.col("_digest") == F.col("digest"), "left")
    end = F.encode(F.lit(END), "UTF-8")
    right = F.col("verified") & (F.col("payload_bytes") == F.col("_length"))
    record = F.concat(F.encode("header", "UTF-8"), end, F.col("payload"), end, end)
    return whole.select(
        F.when(right, record).alias("record"), page("_id").alias("page_id"), F.when(right, F.col("payload")).alias("payload"),
        F.when(right, F.col("payload_bytes")).alias("payload_bytes"), F.when(right, F.col("digest")).alias("payload_digest"),
        "record_type", page("_to").alias("refers_to"))


def lost(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type) of the records whose payload is gone or is not what its digest says."""
    return read(spark, path).filter(F.col("payload_digest").isNull()).select("page_id", "record_type")


def export(spark: SparkSession, path: str, target: str) -> None:
    """The archive as gzipped ``.warc`` text files of whole records, payloads of revisits included."""
    read(spark, path).select(F.decode(F.expr("substring(record, 1, length(record) - 4)"), "UTF-8").alias("value")).write.mode(
        "overwrite").option("lineSep", END * 2).option("compression", "gzip").text(target)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages in a new folder and read them back."""
    path = new_folder(pages.sparkSession)
    write(pages, path)
    return read(pages.sparkSession, path)
