"""WARC archives: pages written as records, long ones in segments, and read back whole.

Archives are files of Spark's text writer whose line separator is the blank line
that ends a WARC record, so they are committed like any table and can lie on any
file system that Spark writes to.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import written

EOL = "\r\n"
HTTP_HEAD = EOL.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Transfer-Encoding: chunked", "", ""])
# Fixed value: the profile of revisit records with an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits make four letters."""
    digits = F.sha1(payload)
    fours = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _text(b: Column) -> Column:
    return b.cast("string")  # the bytes stay as they are


def _chunked(payload: Column, size: int) -> Column:
    """payload in chunks of `size` bytes, as HTTP's chunked transfer coding."""
    length = F.octet_length(payload)
    part = lambda i: F.substring(payload, i * size + 1, F.lit(size))
    chunk = lambda i: F.concat(F.lower(F.hex(F.octet_length(part(i)))), F.lit(EOL), _text(part(i)), F.lit(EOL))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((length - 1) / size).cast("int")), chunk)
    return F.concat(F.when(length > 0, F.array_join(chunks, "")).otherwise(""), F.lit("0" + EOL * 2))


def duplicates(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(id, digest, refers_to, n) of pages(id, payload, digest): n rows have this id and payload, which a row with the larger id refers_to has.

    refers_to is null for the largest id, and under min_bytes.  Only what has a
    refers_to or an n over 1 is in the result; null ids aren't.
    """
    light = written(pages.where("id is not null").groupBy("id", "digest").agg(F.count("*").alias("n"), F.max(F.octet_length("payload")).alias("size")))
    keeper = light.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    refers_to = F.when((F.col("size") >= min_bytes) & (F.col("id") != F.col("refers_to")), F.col("refers_to"))
    return light.join(keeper, "digest", "left").select("id", "digest", refers_to.alias("refers_to"), "n").where("refers_to is not null or n > 1")


def numbered(body: DataFrame, repeats: bool) -> DataFrame:
    """body(id, digest, n, ...), where n is over 1 only with repeats, with the column own, unique to each row: one of the rows of an id and digest has these two alone, all others a row number too.

    A null id always has a row number.  It needn't be fixed there, as no other
    record refers to it; rows whose id and payload repeat are written with theirs.
    """
    text = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), "digest")
    row = F.monotonically_increasing_id()
    out = body.where("n is null or n = 1").withColumn("own", F.when(F.col("id").isNull(), F.concat_ws(":", text, row)).otherwise(text))
    if not repeats:
        return out
    again = written(body.where("n > 1").withColumn("_row", row))
    first = again.groupBy("id", "digest").agg(F.min("_row").alias("_first"))
    return out.unionByName(again.join(first, ["id", "digest"]).withColumn("own", F.when(F.col("_row") == F.col("_first"), text).otherwise(F.concat_ws(":", text, "_row"))).drop("_row", "_first"))


def write(pages: DataFrame, path: str, min_bytes: int = 0, segment: int = 1 << 16, chunk: int = 1 << 13, records_a_file: int = 1024, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes each row as a record: a response, or a revisit of the equal payload of at least min_bytes with the largest id.

    Blocks of more than `segment` bytes go on in continuation records.  A null
    payload counts as empty.  Rows with a null id are responses.  Each record has
    an id of its own, also where ids repeat or are null; the page's name, made of
    its id alone, stands in WARC-Page and WARC-Refers-To-Page.
    records_a_file * segment bounds a file's size.
    """
    raw = F.col(payload_col).cast("string").cast("binary")
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(raw, F.lit(b"")).alias("payload")).withColumn("digest", base32_sha1(F.col("payload")))
    dup = written(duplicates(base, min_bytes))  # Spark broadcasts it only if it is small
    name = lambda *c: F.concat(F.lit("<urn:page:"), F.coalesce(F.concat_ws(":", *(x.cast("string") for x in c)), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(key + ": "), value, F.lit(EOL))
    first = F.col("refers_to").isNull()
    body = numbered(base.join(dup, ["id", "digest"], "left"), not dup.where("n > 1").isEmpty()).withColumn("block", F.when(first, F.concat(F.lit(HTTP_HEAD), _chunked(F.col("payload"), chunk))).otherwise("").cast("binary"))
    total = F.octet_length("block")
    parts = F.greatest(F.lit(1), F.ceil(total / segment)).cast("int")
    each = body.withColumn("parts", parts).withColumn("number", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    part = F.substring("block", (F.col("number") - 1) * segment + 1, F.lit(segment))
    begins, ends, cut = F.col("number") == 1, F.col("number") == F.col("parts"), F.col("parts") > 1
    record = F.concat(
        F.lit("WARC/1.1" + EOL),
        line("WARC-Type", F.when(~begins, "continuation").when(first, "response").otherwise("revisit")),
        F.when(begins, line("WARC-Record-ID", name(F.col("own")))).otherwise(line("WARC-Record-ID", F.concat(F.lit("<urn:segment:"), F.col("own"), F.lit(":"), F.col("number"), F.lit(">")))),
        F.when(begins, line("WARC-Page", name(F.col("id")))).otherwise(""),
        line("WARC-Date", F.lit(date)),
        F.when(begins & F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", ""))).otherwise(""),
        F.when(begins, line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))).otherwise(""),
        F.when(begins & ~first, F.concat(line("WARC-Refers-To", name(F.col("refers_to"), F.col("digest"))), line("WARC-Refers-To-Page", name(F.col("refers_to"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        F.when(cut, line("WARC-Segment-Number", F.col("number"))).otherwise(""),
        F.when(~begins, line("WARC-Segment-Origin-ID", name(F.col("own")))).otherwise(""),
        F.when(cut & ends, line("WARC-Segment-Total-Length", total)).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(part)),
        F.lit(EOL),
        _text(part),
    )
    each.select(record.alias("value")).write.option("lineSep", EOL * 2).option("maxRecordsPerFile", records_a_file).text(path)


def dechunked(body: bytes) -> bytes | None:
    """The payload of a body in chunked transfer coding, or None if the framing is broken.  Extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].partition(b";")[0].strip() or b"x", 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        at = end + 2
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes | None:
    """The payload of an HTTP response, out of its transfer coding; None without a whole header or with broken framing."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    coding = [line.partition(b":")[2].strip().lower() for line in head.split(b"\r\n")[1:] if line.lower().startswith(b"transfer-encoding:")]
    return dechunked(body) if any(b"chunked" in c for c in coding) else body


FIELDS = [("record_id", "warc-record-id"), ("type", "warc-type"), ("url", "warc-target-uri"), ("refers_to", "warc-refers-to"), ("digest", "warc-payload-digest"), ("origin_id", "warc-segment-origin-id"), ("number", "warc-segment-number"), ("total", "warc-segment-total-length"), ("page", "warc-page"), ("refers_to_page", "warc-refers-to-page")]
RECORD = "record_id string, type string, url string, refers_to string, digest string, origin_id string, number int, total bigint, page string, refers_to_page string, block binary, payload binary"
_KINDS = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary()]


def parsed(content: bytes) -> Iterator[tuple]:
    """The records of one archive; unsegmented responses come with their payload in place of the block.

    Stops at what is no record, or has no whole number as its length.  A segment
    number or total length that is no whole number counts as 0, which no whole
    record has.
    """
    whole_number = lambda x, other: int(x) if x.isascii() and x.isdigit() and len(x) < 16 else other
    at = 0
    while content.startswith(b"WARC/", at):
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            return
        head = {}
        for line in content[at:end].split(b"\r\n")[1:]:
            key, _, value = line.partition(b":")
            head[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        size = whole_number(head.get("content-length", "0"), None)
        if size is None:
            return
        block = content[end + 4 : end + 4 + size]
        at = end + 4 + size + 4
        row = [head.get(key) for _, key in FIELDS]
        row[6:8] = (None if x is None else min(whole_number(x, 0), most) for x, most in zip(row[6:8], ((1 << 31) - 1, 1 << 62), strict=True))
        whole = row[6] is None and row[1] == "response"
        yield (*row, None if whole else block, http_payload(block) if whole else None)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives in a folder, as RECORD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f for f, _ in FIELDS] + ["block", "payload"]
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in parsed(content.as_py()):
                    rows.append(row)
                    size += len(row[-1] or row[-2] or b"") + 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def reassembled(found: DataFrame) -> DataFrame:
    """(record_id, type, url, refers_to, digest, own_id, own_refers_to, payload, complete): segments joined by origin, in the order of their numbers.

    own_id and own_refers_to are the ids in the archive; record_id and refers_to
    are the names of pages, which records may share, if the archive has them.
    complete is false, and payload null, if a segment is missing or comes twice,
    the total length isn't that announced, or the transfer framing is broken.
    """
    columns = ["record_id", "type", "url", "refers_to", "digest", "own_id", "own_refers_to"]
    origin = F.coalesce("origin_id", "record_id")
    named = {"own_id": F.col("record_id"), "own_refers_to": F.col("refers_to"), "record_id": F.coalesce("page", "record_id"), "refers_to": F.coalesce("refers_to_page", "refers_to")}
    found = found.withColumns({"origin": origin, **named})
    whole = found.where("number is null").select(*columns, "payload", ((F.col("type") != "response") | F.col("payload").isNotNull()).alias("complete"))
    parts = found.where("number is not null").groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"), F.max("total").alias("total"), *(F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in columns)
    )
    joined = F.array_join(F.transform("parts", lambda p: _text(p["block"])), "").cast("binary")
    in_order = F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1), F.size("parts"))
    checked = parts.withColumn("block", joined).withColumn("block", F.when(in_order & (F.octet_length("block") == F.col("total")), F.col("block")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload = [None if x is None else http_payload(x) for x in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(payload, pa.binary()), pa.array([x is not None for x in payload])], [*columns, "payload", "complete"])

    decoded = checked.select(*columns, "block").mapInArrow(run, ", ".join(f"{c} string" for c in columns) + ", payload binary, complete boolean")
    return whole.unionByName(decoded)
