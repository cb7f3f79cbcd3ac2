"""Derived WARC records: metadata and plain-text conversions of responses.

Every response gives a metadata record (application/warc-fields: title, links, and
the response's status, headers and digests), and a conversion record (text/plain) if it
is a successful page of html. Both refer to the response by WARC-Refers-To, keep its
target and date, and carry digests of their own blocks; the metadata record names the
conversion by WARC-Concurrent-To. Ids are name-based, from the source's id and the
record's type, so a repeated run, or a retried task, makes the same records.

Records are rows: warc_type, record_id, refers_to, concurrent_to, target_uri, date,
content_type, content_length (bytes), block_digest, payload_digest, headers (the
source's header lines), block. ``records_to_text`` and ``read_records`` go to WARC/1.0
files and back; reading splits files at record starts and goes by Content-Length, so one
large file is read by many tasks only if it is not compressed.

Definitions: null html, url or other parts count as empty; a source without a record id
gets one from its target, date and block. A response whose block has
no empty line has headers only. Header names are compared without case. Repeated rows
give repeated records, of the same ids. An empty table gives an empty result. Extra
columns of the source are not carried: a record has the columns above.
"""

from __future__ import annotations

import hashlib
import uuid
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .exchange import slices
from .markup import plain_text

RECORD = T.StructType()
for _name in ("warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date", "content_type"):
    RECORD.add(_name, "string")
RECORD.add("content_length", "long")
for _name in ("block_digest", "payload_digest", "headers", "block"):
    RECORD.add(_name, "string")
# fixed values: the names of a record's header lines, in the order in which they are written
LINES = {
    "warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To", "concurrent_to": "WARC-Concurrent-To", "target_uri": "WARC-Target-URI",
    "date": "WARC-Date", "content_type": "Content-Type", "block_digest": "WARC-Block-Digest", "payload_digest": "WARC-Payload-Digest",
}
# one such line for each header line of the source
SOURCE_LINE = "X-Source-Header"
START = "WARC/1.0\r\n"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def digest(data: bytes) -> str:
    return "sha1:" + b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def _table(rows: list[dict]) -> pa.RecordBatch:
    types = [pa.int64() if f.name == "content_length" else pa.string() for f in RECORD.fields]
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], t) for f, t in zip(RECORD.fields, types)], names=RECORD.names)


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Fetched pages as response records of status 200."""
    rows = pages.select(F.col(id_col).cast("string"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

    def make(batches):
        for batch in slices(batches, 2):
            out = []
            for number, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                body = (html or "").encode()
                block = head.format(len(body)).encode() + body
                out.append({
                    "warc_type": "response", "record_id": record_id("response", url or "", number or "", date), "target_uri": url or "", "date": date,
                    "content_type": "application/http; msgtype=response", "content_length": len(block), "block_digest": digest(block),
                    "payload_digest": digest(body), "block": block.decode(),
                })
            yield _table(out)

    return rows.mapInArrow(make, RECORD)


def _derive(source: dict) -> list[dict]:
    block = source["block"] or ""
    top, _, body = block.partition("\r\n\r\n")
    status, *lines = top.split("\r\n")
    headers = "\r\n".join(lines)
    kinds = [line.partition(":")[2].strip().lower() for line in lines if line.partition(":")[0].strip().lower() == "content-type"]
    code = (status.split(" ") + ["", ""])[1]
    is_page = code == "200" and any(k.startswith(("text/html", "application/xhtml+xml")) for k in kinds)
    uri, date = source["target_uri"] or "", source["date"] or ""
    payload = source["payload_digest"] or digest(body.encode())
    # a source without an id is named by what it holds
    own = source["record_id"] or record_id("response", uri, date, digest(block.encode()))
    link = {"refers_to": own, "target_uri": uri, "date": date, "payload_digest": payload, "headers": headers}
    metadata, conversion = record_id("metadata", own), record_id("conversion", own)
    fields = [f"source-status: {code}", *[f"source-header: {line}" for line in lines if line], f"source-block-digest: {source['block_digest'] or digest(block.encode())}", f"source-payload-digest: {payload}"]
    out = []
    if is_page:
        title, text, links = plain_text(body)
        fields += [f"title: {title}"] * bool(title) + [f"outlink: {' '.join(target.split())}" for target in links]
        data = text.encode()
        out.append({**link, "warc_type": "conversion", "record_id": conversion, "concurrent_to": metadata, "content_type": "text/plain; charset=utf-8", "content_length": len(data), "block_digest": digest(data), "block": text})
    made = "".join(f"{field}\r\n" for field in fields)
    data = made.encode()
    return [{**link, "warc_type": "metadata", "record_id": metadata, "concurrent_to": conversion if is_page else None, "content_type": "application/warc-fields", "content_length": len(data), "block_digest": digest(data), "block": made}, *out]


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of all response records; others give none."""
    names = ("record_id", "target_uri", "date", "block_digest", "payload_digest", "block")

    def make(batches):
        for batch in slices(batches, names.index("block")):
            rows = zip(*(c.to_pylist() for c in batch.columns))
            yield _table([new for row in rows for new in _derive(dict(zip(names, row)))])

    return records.where("warc_type = 'response'").select(*names).mapInArrow(make, RECORD)


def records_to_text(records: DataFrame) -> DataFrame:
    """One string per record, to be written by ``write.option("lineSep", "\\r\\n\\r\\n").text(path)``."""
    lines = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}: "), c, F.lit("\r\n"))).otherwise("") for c, name in LINES.items()]
    own = F.transform(F.split("headers", "\r\n"), lambda line: F.concat(F.lit(f"{SOURCE_LINE}: "), line, F.lit("\r\n")))
    lines.append(F.coalesce(F.array_join(own, ""), F.lit("")))
    size: Column = F.octet_length(F.coalesce("block", F.lit("")))
    return records.select(F.concat(F.lit(START), *lines, F.lit("Content-Length: "), size.cast("string"), F.lit("\r\n\r\n"), F.coalesce("block", F.lit(""))).alias("value"))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between record starts: file, offset in bytes, and where the record that may begin there says it ends."""
    split = ["_file", "_begin"]
    read = spark.read.option("lineSep", START).text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_begin"), F.monotonically_increasing_id().alias("_id")
    )
    size = F.octet_length("value") + len(START)
    before = Window.partitionBy(*split).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = read.withColumn("_size", size).withColumn("_in", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    # one row for each split of a file
    sizes = placed.groupBy(*split).agg(F.sum("_size").alias("_n"))
    whole = Window.partitionBy("_file")
    base = F.coalesce(F.sum("_n").over(whole.orderBy("_begin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*split, base.alias("_base"), F.sum("_n").over(whole).alias("_total"))
    rows = placed.join(sizes, split).withColumn("_at", F.col("_base") + F.col("_in"))
    end = F.col("_at") + F.col("_size") - len(START)
    head = F.locate("\r\n\r\n", "value")
    length = F.regexp_extract(F.substring_index("value", "\r\n\r\n", 1), r"(?im)^Content-Length:[ \t]*([0-9]{1,15})[ \t]*\r?$", 1).try_cast("long")
    said = F.col("_at") + F.octet_length(F.substring_index("value", "\r\n\r\n", 1)) + 4 + length
    # what comes before a file's first start is no record; a length beyond the file counts for nothing
    usable = (F.col("_at") > 0) & (head > 0) & (said <= F.col("_total"))
    rows = rows.withColumns({"_end": end, "_until": F.when(usable, F.coalesce(said, end)).otherwise(end), "_length": F.when(usable, length)})
    # the furthest end that any earlier piece of the file claims, from its split or one before
    most = rows.groupBy(*split).agg(F.max("_until").alias("_most"))
    carried = most.select(*split, F.max("_most").over(whole.orderBy("_begin").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    covered = F.greatest(F.max("_until").over(before), F.col("_carried"))
    return rows.join(carried, split).withColumn("_sure", F.coalesce(covered, F.lit(0)) <= F.col("_at") - len(START)).select(*split, "_id", "value", "_at", "_end", "_until", "_length", "_sure")


def _records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records (value, _length): pieces that stand in another record's block are put back into it."""
    pieces = _pieces(spark, path)
    up_to = Window.partitionBy("_file", "_begin").orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a stretch goes from a piece that is a record for sure to the next one; nearly all are one piece
    last = pieces.groupBy("_file", "_begin").agg(F.max(F.when(F.col("_sure"), F.col("_at"))).alias("_last"))
    over = Window.partitionBy("_file").orderBy("_begin").rowsBetween(Window.unboundedPreceding, -1)
    open_ = last.select("_file", "_begin", F.max("_last").over(over).alias("_open"))
    alone = F.col("_sure") & (F.col("_until") <= F.col("_end"))
    owned = pieces.withColumn("_own", F.max(F.when(F.col("_sure"), F.col("_at"))).over(up_to)).join(open_, ["_file", "_begin"])
    parts = owned.withColumn("_stretch", F.coalesce("_own", "_open")).where(~alone & (F.col("_at") > 0))
    entry = F.struct("_at", "_until", "_length", "value")
    stretches = parts.groupBy("_file", "_stretch").agg(F.sort_array(F.collect_list(entry)).alias("_parts"))
    none = F.struct(F.lit(0).cast("long").alias("until"), F.array().cast("array<bigint>").alias("heads"))
    # from record to record: the next one begins behind the end of the one before
    walk = F.aggregate(
        "_parts", none,
        lambda found, p: F.when(
            p["_at"] - len(START) >= found["until"], found.withField("until", p["_until"]).withField("heads", F.concat(found["heads"], F.array(p["_at"])))
        ).otherwise(found),
    )["heads"]
    parted = stretches.select("_file", walk.alias("_heads"), F.explode("_parts").alias("_p"))
    head = F.array_max(F.filter("_heads", lambda h: h <= F.col("_p._at")))
    joined = parted.groupBy("_file", head.alias("_head")).agg(F.sort_array(F.collect_list("_p")).alias("_all")).select(
        F.array_join(F.transform("_all", lambda p: p["value"]), START).alias("value"), F.get("_all", F.lit(0))["_length"].alias("_length")
    )
    return pieces.where(alone & (F.col("_at") > 0)).select("value", "_length").unionByName(joined)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC/1.0 files whose blocks are UTF-8, by their Content-Length.

    A record start inside a block belongs to the block. Files are read in splits; only pieces
    of a block that holds record starts are brought together. A record without a length, or
    with one beyond its file, ends at the next start, less two empty lines. What comes before
    a file's first start is left out; empty files have no records.
    """
    raw = _records(spark, path)
    top = F.substring_index("value", "\r\n\r\n", 1)
    rest = F.expr("substring(value, locate('\r\n\r\n', value) + 4)")
    lines = F.split(top, "\r\n")

    def own(name: str) -> Column:
        chosen = F.filter(lines, lambda x: F.lower(x).startswith(name.lower() + ":"))
        return F.transform(chosen, lambda x: F.trim(F.regexp_replace(x, r"\A[^:]*:", "")))

    by_length = F.substring(rest.cast("binary"), F.lit(1), F.col("_length").cast("int")).cast("string")
    block = F.when(F.col("_length").isNotNull(), by_length).otherwise(F.regexp_replace(rest, "\r\n\r\n\\z", ""))
    source = own(SOURCE_LINE)
    made = {name: F.get(own(line), F.lit(0)) for name, line in LINES.items()} | {
        "content_length": F.get(own("Content-Length"), F.lit(0)).try_cast("long"),
        "headers": F.when(F.size(source) > 0, F.array_join(source, "\r\n")),
        "block": F.when(F.locate("\r\n\r\n", "value") > 0, block).otherwise(""),
    }
    return raw.select(*[made[name].alias(name) for name in RECORD.names])
