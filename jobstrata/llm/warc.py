"""WARC derivatives: metadata and plain-text conversion records of response records.

Records are rows: warc_type, record_id, target_uri, warc_date, content_type, headers (all named fields of the record as
a map) and block (bytes). ``derive`` makes two records of each response, a metadata record (HTTP status and headers,
title, language, links) and a conversion record (the text of the page). Both refer to the response by its identifier, carry its
target, date and other source headers over, and keep its block and payload digests beside their own.

Files are read and written by Spark's text source, split at record boundaries, so a large file is read by many tasks.
``complete`` tells whether a record has the bytes its header announces; the last one of a file that was cut off has not.

Records that are no responses give nothing. A null or empty block, a missing HTTP head or charset, unclosed tags and empty
tables are handled: what cannot be read counts as empty. Repeated rows give records with equal identifiers. Identifiers
follow from the source's, so a rerun task gives the same. Blocks are held one at a time and may be of any length.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobstrata.llm.common import materialize
from jobstrata.operators.joins import attach_lookup

VERSION = "WARC/1.0"
RECORD = "warc_type string, record_id string, target_uri string, warc_date string, content_type string, headers map<string,string>, block binary"
# Named fields that describe a record itself and are not carried over to a derived one.
OWN_FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Block-Digest", "WARC-Payload-Digest", "Content-Type", "Content-Length", "WARC-Truncated")

_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BLOCKS = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre"
    r"|section|table|td|th|title|tr|ul)\b[^>]*>",
    re.I,
)
_TAGS = re.compile(r"</?[a-zA-Z!?](?:[^>\"']|\"[^\"]*\"|'[^']*')*>")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
_LANGUAGE = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def without_hidden(page: str) -> str:
    """An HTML page without scripts, styles and comments."""
    return _DROPPED.sub(" ", page)


def plain_text(shown: str) -> str:
    """The text of an HTML page that is already ``without_hidden``: a line per block element, white space collapsed."""
    text = _TAGS.sub("", _BLOCKS.sub("\n", shown))
    lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, header fields and payload of an HTTP response; without a head everything is payload."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, body = block.partition(b"\r\n\r\n")
    first, *rest = head.decode("latin-1").split("\r\n")
    pairs = (line.partition(":") for line in rest)
    return first, [(name.strip(), value.strip()) for name, colon, value in pairs if colon], body


def decode(body: bytes, content_type: str) -> str:
    """The payload as text, by the announced or declared charset, else UTF-8."""
    found = _CHARSET.search(content_type) or _CHARSET.search(body[:1024].decode("latin-1"))
    try:
        return body.decode(found[1] if found else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _identifier(kind: str, source: str) -> str:
    h = hashlib.sha256(f"{kind} {source}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def _one_line(text: str) -> str:
    return " ".join(text.split())


def derived(record_id: str, target: str, date: str, headers: dict[str, str], block: bytes) -> list[dict]:
    """The metadata and the conversion record of one response."""
    status, fields, body = split_http(block)
    content_type = next((v for k, v in fields if k.lower() == "content-type"), "")
    page = decode(body, content_type)
    title, language, shown = _TITLE.search(page), _LANGUAGE.search(page), without_hidden(page)
    links = [html.unescape(a or b or c) for a, b, c in _LINK.findall(shown)]
    lines = [f"http-status: {status}"] if status else []
    lines += [f"http-header: {k}: {v}" for k, v in fields]
    lines += [f"title: {_one_line(html.unescape(title[1]))}"] if title else []
    lines += [f"language: {language[1]}"] if language else []
    lines += [f"outlink: {_one_line(x)}" for x in links]
    carried = {k: v for k, v in headers.items() if k not in OWN_FIELDS}
    carried |= {"WARC-Refers-To": record_id, "WARC-Refers-To-Target-URI": target, "WARC-Refers-To-Date": date}
    carried |= {"Source-Block-Digest": headers.get("WARC-Block-Digest") or digest(block), "Source-Payload-Digest": headers.get("WARC-Payload-Digest") or digest(body)}
    out = []
    for kind, mime, text in (
        ("metadata", "application/warc-fields", "".join(f"{x}\r\n" for x in lines)),
        ("conversion", "text/plain; charset=utf-8", plain_text(shown)),
    ):
        data = text.encode("utf-8", "replace")
        own = {"WARC-Type": kind, "WARC-Record-ID": _identifier(kind, record_id), "WARC-Block-Digest": digest(data), "Content-Type": mime, "Content-Length": str(len(data))}
        out.append({"warc_type": kind, "record_id": own["WARC-Record-ID"], "target_uri": target, "warc_date": date, "content_type": mime, "headers": carried | own, "block": data})
    return out


_ARROW = pa.schema(
    [(x, pa.string()) for x in ("warc_type", "record_id", "target_uri", "warc_date", "content_type")]
    + [("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary())]
)


def derive(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Two records per response; ``keep`` names further columns to carry along."""
    keep = keep or []
    rows = records.filter(F.col("warc_type") == "response").select(*keep, "record_id", "target_uri", "warc_date", "headers", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few rows at a time, so that what is made stays small whatever a batch holds.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out, place = [], []
                for k, (key, target, date, headers, block) in enumerate(zip(*[part.column(x).to_pylist() for x in ("record_id", "target_uri", "warc_date", "headers", "block")])):
                    out += derived(key or "", target or "", date or "", dict(headers or ()), block or b"")
                    place += [k, k]
                table = pa.RecordBatch.from_pylist([x | {"headers": list(x["headers"].items())} for x in out], _ARROW)
                kept = [part.column(x).take(pa.array(place, pa.int64())) for x in keep]
                yield pa.RecordBatch.from_arrays([*kept, *table.columns], [*keep, *_ARROW.names])

    fields = "".join(f"`{x}` {t}, " for x, t in rows.dtypes if x in keep)
    return rows.mapInArrow(run, fields + RECORD)


def responses(pages: DataFrame, date: str, keep: list[str] | None = None) -> DataFrame:
    """Response records of crawled pages (page_id, url, html), as a crawler writes them at ``date``."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(F.encode(head, "UTF-8"), body)
    md5 = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), "url").cast("binary"))
    cut = [F.substring(md5, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    key = F.concat(F.lit("<urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-3"), cut[2], F.lit("-8"), cut[3], F.lit("-"), cut[4], F.lit(">"))
    target = F.coalesce("url", F.lit(""))
    named = {"WARC-Type": F.lit("response"), "WARC-Record-ID": key, "WARC-Target-URI": target, "WARC-Date": F.lit(date), "Content-Type": F.lit("application/http; msgtype=response"), "Content-Length": F.octet_length(block).cast("string")}
    return pages.select(
        *(keep or []),
        F.lit("response").alias("warc_type"), key.alias("record_id"), target.alias("target_uri"), F.lit(date).alias("warc_date"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        F.create_map(*[x for name, value in named.items() for x in (F.lit(name), value)]).alias("headers"),
        block.alias("block"),
    )


# Files.


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as WARC files, one per partition."""
    named = F.array_join(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\r\n")
    whole = F.concat(F.encode(F.concat(F.lit(VERSION + "\r\n"), named, F.lit("\r\n\r\n")), "UTF-8"), F.coalesce("block", F.lit(b"")))
    records.select(whole.cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


# Any version's line begins so. Between records it follows two line ends.
_MARK = "WARC/1."
_BETWEEN = "\r\n\r\n" + _MARK
_HEAD = 1 << 16


def _framed(pieces: DataFrame) -> DataFrame:
    """Pieces (data begins behind the mark) with head, skip (bytes in front of the block) and length (of the block)."""
    # As Latin-1 every byte is a character, whatever the head's encoding.
    head = lambda data: F.substring_index(F.decode(data, "ISO-8859-1"), "\r\n\r\n", 1)
    short = head(F.substring("data", 1, _HEAD))
    size = F.when(F.length(short) < _HEAD - 4, F.length(short)).otherwise(F.length(head(F.col("data"))))
    rows = pieces.withColumn("skip", size + 4).withColumn("head", F.expr("substring(data, 1, skip - 4)").cast("string"))
    entries = F.transform(F.split("head", "\r\n"), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)), F.trim(F.regexp_replace(x, r"^[^:]*:", ""))))
    rows = rows.withColumn("headers", _field_map(F.filter(entries, lambda e: e["col2"] != e["col1"])))
    return rows.withColumn("length", F.expr("try_cast(headers['Content-Length'] AS bigint)"))


def _pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Files cut at whatever looks like the begin of a record: file, place (which orders the pieces of a file) and data."""
    parts = spark.read.option("lineSep", _BETWEEN).text(paths)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    parts = parts.select(F.col("_metadata.file_path").alias("file"), place.alias("place"), F.col("value").cast("binary").alias("data"))
    # The first record of a file still has its mark.
    starts = (F.col("place.block") == 0) & (F.substring("data", 1, len(_MARK)) == F.lit(_MARK.encode()))
    return parts.withColumn("data", F.when(starts, F.expr(f"substring(data, {len(_MARK) + 1})")).otherwise(F.col("data")))


def _rejoined(pieces: DataFrame) -> DataFrame:
    """Pieces of files in which a block was cut, put together by the lengths that the heads announce."""
    gap = len(_BETWEEN)
    in_file = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.octet_length("data") + gap).over(in_file), F.lit(0))
    placed = materialize(pieces.withColumn("begin", begin), "pieces")
    known = _framed(placed).withColumn("end", F.col("begin") + F.col("skip") + F.col("length"))
    open_ones = known.filter(F.col("end") > F.col("begin") + F.octet_length("data"))
    claims = open_ones.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("claims"))
    # What begins inside a block is part of it, so its own claim does not count.
    spans = F.aggregate("claims", F.array().cast("array<struct<begin:bigint,end:bigint>>"), lambda kept, x: F.when(
        F.exists(kept, lambda k: (k["begin"] < x["begin"]) & (x["begin"] < k["end"])), kept
    ).otherwise(F.concat(kept, F.array(x))))
    owned = attach_lookup(placed, claims.select("file", spans.alias("spans")), ["file"], ["spans"])
    cover = F.filter("spans", lambda k: (k["begin"] < F.col("begin")) & (F.col("begin") < k["end"]))
    owned = owned.withColumn("record", F.coalesce(F.get(cover, 0)["begin"], F.col("begin")))
    whole = owned.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("begin", "data"))).alias("run"))
    mark = F.lit(_BETWEEN.encode())
    data = F.aggregate(F.slice("run", 2, F.size("run")), F.get("run", 0)["data"], lambda acc, x: F.concat(acc, mark, x["data"]))
    return whole.select("file", data.alias("data"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files of versions 1.0 and 1.1, with ``complete``: the block has the bytes its head announces.

    Blocks are cut by ``Content-Length`` and may hold anything. Files are split at what looks like the begin of a record; where a
    block holds that itself, its file is put together again by lengths, at the cost of a shuffle of such files alone.
    """
    pieces = _pieces(spark, path)
    framed = _framed(pieces)
    size = F.octet_length("data")
    slim = framed.select("file", "place", (F.col("skip") + F.col("length") > size).alias("open"))
    last = F.max("place").alias("last")
    cut = slim.groupBy("file").agg(last, F.min(F.when(F.col("open"), F.col("place"))).alias("first_open")).filter("first_open < last")
    # Files with a record that ends too early though others follow. A last record that ends too early is a cut-off file.
    files = [row["file"] for row in cut.select("file").collect()]
    if files:
        again = _rejoined(_pieces(spark, [unquote(x) for x in files]))
        framed = framed.filter(~F.col("file").isin(files)).select("data", "skip", "headers", "length").unionByName(
            _framed(again).select("data", "skip", "headers", "length")
        )
    rows = framed.filter(F.size("headers") > 0)
    block = F.expr("substring(data, skip + 1, cast(coalesce(length, 2147483647) as int))")
    named = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date", "content_type": "Content-Type"}
    out = rows.select(*[F.col("headers")[v].alias(k) for k, v in named.items()], "headers", block.alias("block"), "length")
    return out.withColumn("complete", F.coalesce(F.octet_length("block") == F.col("length"), F.lit(False))).drop("length")


def _field_map(entries: Column) -> Column:
    """A map of header fields; of a repeated name the first counts."""
    names = F.transform(entries, lambda e: e["col1"])
    firsts = F.filter(entries, lambda e, i: F.array_position(names, e["col1"]) == i + 1)
    return F.map_from_entries(firsts)
