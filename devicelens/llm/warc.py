"""A content-addressed WARC archive: payload bytes once, record headers apart, records rebuilt by joins.

The archive is two tables below one path. ``payloads`` has each distinct payload once, under its SHA-256.
``headers`` has the exact header block of every record and the key of its payload. A record whose payload
another record holds is a ``revisit`` and names the holder in ``WARC-Refers-To``. Reading joins the tables,
checks the joined bytes against the digest that the header states, and gives the records as captured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Digits of Spark's base 32 and of RFC 4648 base 32.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: A page has no capture time, so all records of an archive state the same one unless told otherwise.
DATE = "2026-01-01T00:00:00Z"


def base32_of_sha1(payload: Column) -> Column:
    """Bare upper-case base 32 of the SHA-1: 160 bits in groups of 60, 60 and 40."""
    text = F.sha1(payload)
    parts = [(1, 15, 12), (16, 15, 12), (31, 10, 8)]
    digits = [F.lpad(F.conv(F.substring(text, at, n), 16, 32), width, "0") for at, n, width in parts]
    return F.translate(F.concat(*digits), DIGITS, BASE32)


def write_archive(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", min_bytes: int = 0, date: str = DATE) -> None:
    """Write one record per row below ``path``.

    Payloads are the UTF-8 bytes of the column, null the empty payload. Of rows with equal payloads of at
    least ``min_bytes`` the one with the largest id is the response, all others revisit it; smaller payloads
    are responses all. Rows repeated with that largest id are responses too. A null id is below all others: its
    record refers to the largest id, or is a response if no row of its payload has one. Only the three named
    columns are read; an empty table gives an empty archive; a null URL leaves out ``WARC-Target-URI``, and line ends in a URL are
    percent-encoded, so that it cannot add header lines.

    The payload crosses the network once. Copies are dropped before that shuffle, task by task, so a page
    that a third of all rows share is sent once per task.
    """
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(payload_column), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("key", F.sha2("payload", 256))
    rows.select("key", "payload").dropDuplicates(["key"]).write.option("compression", "zstd").parquet(f"{path}/payloads")

    narrow = rows.select("id", "url", "key", F.length("payload").cast("long").alias("bytes"), base32_of_sha1(F.col("payload")).alias("digest"))
    holders = narrow.where(F.col("bytes") >= min_bytes).groupBy("key").agg(F.max("id").alias("holder"))
    named = narrow.join(holders, "key", "left")
    revisit = F.col("holder").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("holder")))
    name = lambda column: F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("holder")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("bytes")).cast("string")),
    ]
    header = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))
    named.select("id", header.cast("binary").alias("header"), "key").write.option("compression", "zstd").parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records as captured: ``id``, ``header``, ``payload``, the parsed ``record_type``, ``refers_to``, ``digest``, and ``verified``.

    ``verified`` is whether the bytes that the join found have the digest of the header and that they are stored under; ``record`` of a
    verified row is the header followed by its block (none for a revisit) and the two line ends that close it.
    """
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    text = F.col("header").cast("string")
    # Lines end at CR LF alone; other line ends of Unicode may stand in a URL. The first line of a name counts, and none comes from a URL.
    field = lambda name: F.nullif(F.regexp_extract(text, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1), F.lit(""))
    joined = headers.join(payloads, "key")
    return joined.select(
        "id",
        "header",
        "payload",
        field("WARC-Type").alias("record_type"),
        F.nullif(F.regexp_extract(field("WARC-Refers-To"), r"\A<urn:page:([^>]*)>\z", 1), F.lit("")).alias("refers_to"),
        F.regexp_extract(field("WARC-Payload-Digest"), r"\Asha1:([A-Z2-7]+)\z", 1).alias("digest"),
        ((F.concat(F.lit("sha1:"), base32_of_sha1(F.col("payload"))) == field("WARC-Payload-Digest")) & (F.sha2("payload", 256) == F.col("key"))).alias("verified"),
        F.when(field("WARC-Type") == "response", F.concat("header", "payload", F.lit("\r\n\r\n").cast("binary"))).otherwise(F.concat("header", F.lit("\r\n\r\n").cast("binary"))).alias("record"),
    )
