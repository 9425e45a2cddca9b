"""A content-addressed archive of WARC records, kept in two tables.

``payloads`` holds each distinct payload once, under its SHA-256, in buckets by
this address. ``records`` holds the exact header bytes of every record and the
address of its payload. A record is rebuilt byte for byte by a join on the address,
and reading parses these bytes and verifies the payload found in them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import quoted
from corpusloom.session import materialize, shared_folder

#: Record layout.
VERSION = "WARC/1.1"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 bits, eight digits, at a time."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), _BASE32_HEX, _BASE32)


def _plain(value: Column) -> Column:
    """A header value on one line: control characters and % as %XX, null as empty."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    escaped = F.replace(text, F.lit("%"), F.lit("%25"))
    for code in (*range(32), 127):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(text.rlike(r"[\x00-\x1f\x7f%]"), escaped).otherwise(text)


def record_id(page_id: Column) -> Column:
    """A record id that depends only on the page."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("null"))))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archive(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    date: str = "2024-01-01T00:00:00Z", revisit_from: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """(payloads, records), written to the shared folder and read back.

    payloads: (sha256, payload), each payload once. records: (rid, sha256,
    header, block_head), one per page. Of equal payloads of at least
    ``revisit_from`` bytes the record with the largest id is a response, the
    others revisit it; shorter payloads are all responses. Null html is the
    empty payload, a null id comes before all others, a null url is an empty
    field. Pages that repeat an id are separate records; between them the row
    number decides. Other columns are not read.
    """
    rows = pages.select(
        quoted(id_col).cast("long").alias("_id"), _plain(quoted(url_col)).alias("url"),
        F.coalesce(quoted(html_col), F.lit("")).cast("binary").alias("payload"),
    )
    keys = rows.select(
        "_id", "url", F.sha2("payload", 256).alias("sha256"), base32_sha1(F.col("payload")).alias("sha1"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    keys = materialize(keys.withColumn("rid", F.monotonically_increasing_id()), "warc-keys")
    order = "struct(_id is not null as has, coalesce(_id, 0L) as id, rid)"
    tops = keys.groupBy("sha256").agg(F.max(F.expr(order)).alias("top"))
    placed = keys.join(tops, "sha256").withColumn("first", (F.col("rid") == F.col("top.rid")) | (F.col("bytes") < revisit_from))

    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    target = F.when(F.col("top.has"), F.col("top.id"))
    size = F.lit(len(HTTP_HEAD)) + F.when(F.col("first"), F.col("bytes")).otherwise(0)
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(F.col("first"), F.lit("response")).otherwise(F.lit("revisit"))),
        line("WARC-Record-ID", record_id(F.col("_id"))),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("WARC-Page-ID", F.coalesce(F.col("_id").cast("string"), F.lit(""))),
        F.when(F.col("first"), F.lit("")).otherwise(
            F.concat(
                line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                line("WARC-Refers-To", record_id(target)),
                line("WARC-Refers-To-Page-ID", F.coalesce(target.cast("string"), F.lit(""))),
            )
        ),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", size.cast("string")),
        F.lit("\r\n"),
    )
    records = placed.select("rid", "sha256", header.cast("binary").alias("header"), F.lit(HTTP_HEAD).cast("binary").alias("block_head"))
    records = materialize(records, "warc-records")
    content = rows.select(F.sha2("payload", 256).alias("sha256"), "payload")
    return by_address(content, "warc-payloads"), records


def by_address(content: DataFrame, name: str) -> DataFrame:
    """(sha256, payload), each address once, stored in buckets by address.

    Repeats are dropped inside each task first, so a frequent payload moves at most
    once a task; then payloads move once, to the bucket of their address. Joins on
    the address read the buckets as they are, and only the other side moves.
    """
    spark = content.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    content.dropDuplicates(["sha256"]).write.bucketBy(buckets, "sha256").option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table)
    return spark.table(table)


def rebuild(payloads: DataFrame, records: DataFrame) -> DataFrame:
    """(rid, sha256, record): the original bytes of every record, by a join on the address."""
    joined = records.withColumn("_first", _field(F.col("header").cast("string"), "WARC-Type") == "response").join(payloads, "sha256", "left")
    body = F.when(F.col("_first"), F.col("payload")).otherwise(F.lit(b""))
    return joined.select("rid", "sha256", F.concat("header", "block_head", body, F.lit(b"\r\n\r\n")).alias("record"))


def _field(header: Column, name: str) -> Column:
    value = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def parse_records(records: DataFrame) -> DataFrame:
    """(rid, sha256, header, bytes, sha1, sound) of whole records (rid, sha256, record).

    The header ends at the first empty line, the block has Content-Length bytes and
    is followed by two line ends, and the payload begins after the HTTP header in
    the block. ``sound``: the record has this form. A record that
    was lost (null) is not sound.
    """
    # One character a byte, so that places in the text are places in the record.
    text = records.select("rid", "sha256", F.decode("record", "ISO-8859-1").alias("t"))
    text = text.withColumn("at", F.expr(r"locate('\r\n\r\n', t)"))
    text = text.withColumn("header", F.decode(F.encode(F.expr("substring(t, 1, at + 1)"), "ISO-8859-1"), "UTF-8"))
    text = text.withColumn("size", F.expr("try_cast(" + "regexp_extract(header, 'Content-Length: ([0-9]+)', 1)" + " as int)"))
    text = text.withColumn("block", F.expr("substring(t, at + 4, size)")).withColumn("tail", F.expr("substring(t, at + 4 + size)"))
    text = text.withColumn("body", F.expr(r"locate('\r\n\r\n', block)"))
    payload = F.encode(F.expr("substring(block, body + 4)"), "ISO-8859-1")
    sound = (F.col("at") > 0) & (F.length("block") == F.col("size")) & (F.col("tail") == "\r\n\r\n") & (F.col("body") > 0)
    return text.select(
        "rid", "sha256", "header", F.octet_length(payload).cast("long").alias("bytes"), base32_sha1(payload).alias("sha1"),
        F.coalesce(sound, F.lit(False)).alias("sound"), F.sha2(payload, 256).alias("found"),
    )


def read_archive(payloads: DataFrame, records: DataFrame, strict: bool = False) -> DataFrame:
    """(page_id, record_type, payload_digest, payload_bytes, refers_to, url, verified) of each record.

    Every record is rebuilt and read from its bytes alone. Digest and length are
    those of the payload found in a response, for a revisit those of the response
    that holds its address. ``verified`` tells whether that payload has the
    digest in the record's header and the address it is stored under; with
    ``strict`` a record that is not verified fails the job.
    """
    parsed = materialize(parse_records(rebuild(payloads, records)), "warc-parsed")
    h = F.col("header")
    parsed = parsed.select(
        "sha256", _field(h, "WARC-Page-ID").cast("long").alias("page_id"), _field(h, "WARC-Type").alias("record_type"),
        _field(h, "WARC-Refers-To-Page-ID").cast("long").alias("refers_to"), _field(h, "WARC-Target-URI").alias("url"),
        _field(h, "WARC-Payload-Digest").alias("digest"), "bytes", "sha1", "sound", (F.col("found") == F.col("sha256")).alias("stored"),
    )
    responses = parsed.where("record_type = 'response'")
    facts = responses.groupBy("sha256").agg(
        F.max("bytes").alias("_bytes"), F.max("sha1").alias("_sha1"), F.min(F.col("sound") & F.col("stored")).alias("_sound")
    )
    joined = parsed.join(facts, "sha256", "left")
    verified = F.coalesce(F.col("_sound") & F.col("sound") & (F.concat(F.lit("sha1:"), F.col("_sha1")) == F.col("digest")), F.lit(False))
    failed = F.raise_error(F.concat(F.lit("unsound record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))).cast("long")
    size = F.when(verified, F.col("_bytes")).otherwise(failed) if strict else F.col("_bytes")
    return joined.select(
        "page_id", "record_type", F.col("_sha1").alias("payload_digest"), size.alias("payload_bytes"), "refers_to", "url", verified.alias("verified")
    )
