"""WARC archives: written with revisit records, read back by boundary-chain verification.

Reading cuts the files at every ``WARC/1.0`` line, inside payloads too, in splits of any
size.  Each cut is a candidate that names the offset where its successor must begin.
Pointer jumping from the file start keeps the candidates that are reached: within a span
of a file in one task, between spans by rounds that double the stride.  Payloads that hold
the magic line are joined again from the pieces between a record and its successor.

Defined results: a null html counts as empty; a null key is read back as null and a record
of it refers to a keyed one where there is one; rows that repeat the largest key of a
payload are all responses; other columns than key, url and html do not take part.  A file
whose chain breaks gives the records before the break.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.session import materialise, shared_folder

MAGIC, CRLF, END = "WARC/1.0\r\n", "\r\n", "\r\n\r\n"
HTTP = "application/http; msgtype=response"
UNCHANGED = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Bytes of a file whose candidates one task chains.
SPAN = 1 << 26
#: Repeated payloads, some 80 bytes each, that are broadcast at most; beyond, they are joined.
BROADCAST_PAYLOADS = 250_000


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: eight groups of twenty bits."""
    places = F.array(*[F.lit(1 + 5 * i) for i in range(8)])

    def letters(digits):
        groups = F.transform(places, lambda i: F.lpad(F.conv(F.substring(digits, i, F.lit(5)), 16, 32), 4, "0"))
        return F.translate(
            F.array_join(groups, ""), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
        )

    # a list of one, so that the digest is computed once
    return F.transform(F.array(F.sha1(payload)), letters)[0]


def write_archive(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Writes one record per row to files below ``path``.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the largest
    key is a response, the others are revisits of it.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("html")), "n": F.octet_length("html")})
    kept = rows.groupBy("digest", "n").agg(F.max("key").alias("first"), F.count("*").alias("copies"))
    kept = materialise(kept.filter("copies > 1").drop("copies"), "repeated")
    # only repeated payloads are looked up; few of them spare the payloads a shuffle
    few = kept.count() <= BROADCAST_PAYLOADS
    rows = rows.join(F.broadcast(kept) if few else kept, ["digest", "n"], "left")
    revisit = (F.col("n") >= min_bytes) & F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))

    def name(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(F.col(c).cast("string")), F.lit("")), F.lit(">"))

    def line(field, value):
        return F.coalesce(F.concat(F.lit(f"{field}: "), value, F.lit(CRLF)), F.lit(""))

    status = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(END))
    block = F.concat(status, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name("key")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(revisit, name("first"))),
        line("WARC-Profile", F.when(revisit, F.lit(UNCHANGED))),
        line("Content-Type", F.lit(HTTP)),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """Every piece between magic lines with the file and the piece's number in its split."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        "value",
        F.octet_length("value").cast("long").alias("size"),
    )


def _placed(segments: DataFrame) -> DataFrame:
    """Adds the offset in the file of the magic line before each piece.

    Sizes are summed within each split, then over the splits of a file.
    """
    before = Window.partitionBy("file", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    splits = segments.groupBy("file", "split").agg(F.sum("size").alias("bytes"), F.count("*").alias("pieces"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.select(
        "file",
        "split",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("pieces_before"),
    )
    placed = segments.withColumns(
        {
            "in_split": F.coalesce(F.sum("size").over(before), F.lit(0)),
            "rank": F.coalesce(F.count("*").over(before), F.lit(0)),
        }
    ).join(bases, ["file", "split"])
    pieces = F.col("pieces_before") + F.col("rank")
    offset = F.col("bytes_before") + F.col("in_split") + len(MAGIC) * (pieces - 1)
    return placed.withColumn("offset", offset).filter(pieces > 0).drop(
        "split", "row", "in_split", "rank", "bytes_before", "pieces_before"
    )


def _parsed(pieces: DataFrame) -> DataFrame:
    """Header fields, size that the header states, and what the payload gives if it is whole."""
    head = F.substring_index("value", END, 1)

    def field(name, pattern="([^\r\n]*)"):
        found = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*{pattern}", 1)
        return F.when(found != "", found)

    out = pieces.withColumn("head", head).withColumn("head_bytes", F.octet_length("head") + len(END))
    out = out.withColumn("content", field("Content-Length", r"(\d+)").cast("long"))
    stated = F.col("head_bytes") + F.col("content") + len(END)
    whole = (F.col("size") == stated) & (F.col("content") < (1 << 31) - 1)
    block = F.substring(F.col("value").cast("binary"), F.col("head_bytes") + 1, F.col("content").cast("int"))
    out = out.withColumns(
        {"stated": stated, "whole": F.coalesce(whole, F.lit(False)), "block": F.when(whole, block)}
    )
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), END, 1)) + len(END)
    payload = F.when(
        field("Content-Type").startswith("application/http"),
        F.substring(F.col("block"), http + 1, F.octet_length("block")),
    ).otherwise(F.col("block"))
    return out.withColumn("payload", payload).select(
        *[c for c in pieces.columns if c != "value"],
        "stated",
        "whole",
        field("WARC-Type").alias("type"),
        field("WARC-Record-ID", "<urn:page:([^>]*)>").alias("id"),
        field("WARC-Refers-To", "<urn:page:([^>]*)>").alias("refers_to"),
        field("WARC-Payload-Digest", "sha1:(\\S*)").alias("stated_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("digest"),
        "payload",
    )


def _follow(offsets: np.ndarray, next_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each successor in the sorted offsets, itself where it is none."""
    at = np.searchsorted(offsets, next_)
    inside = (at < len(offsets)) & (offsets[np.minimum(at, len(offsets) - 1)] == next_)
    return np.where(inside, at, np.arange(len(offsets))), inside


def _sorted_group(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    offsets, next_ = table["offset"].to_numpy(), table["next"].to_numpy()
    order = np.argsort(offsets)
    return offsets[order], next_[order]


def _leave(key, table):
    """Where the chain from each candidate of a span leaves the span."""
    offsets, next_ = _sorted_group(table)
    jump, _ = _follow(offsets, next_)
    while True:
        farther = jump[jump]
        if (farther == jump).all():
            break
        jump = farther
    n = len(offsets)
    return pa.table({"file": pa.array([key[0].as_py()] * n, pa.string()), "offset": offsets, "next": next_[jump]})


def _mark(key, nodes, entries):
    """The candidates of a span that its reached entries lead to."""
    offsets, next_ = _sorted_group(nodes)
    jump, _ = _follow(offsets, next_)
    reached = np.isin(offsets, entries["offset"].to_numpy())
    for _ in range(max(1, len(offsets)).bit_length()):
        reached[jump[reached]] = True
        jump = jump[jump]
    found = offsets[reached]
    return pa.table({"file": pa.array([key[0].as_py()] * len(found), pa.string()), "offset": found})


def reachable(nodes: DataFrame, span: int = SPAN) -> DataFrame:
    """Of ``(file, offset, next)`` the ``(file, offset)`` on the chain from offset 0."""
    spans = F.floor(F.col("offset") / span).cast("long")
    nodes = nodes.select("file", "offset", "next", spans.alias("span"))
    shape = "file string, offset long"
    exits = materialise(nodes.groupBy("file", "span").applyInArrow(_leave, f"{shape}, next long"), "exits")
    heads = nodes.filter(F.col("offset") == 0).select("file", "offset")
    # a chain enters a span at offset 0 or where a chain leaves another span
    targets = exits.select("file", F.col("next").alias("offset")).distinct().union(heads).distinct()
    jumps = materialise(exits.join(targets, ["file", "offset"]), "jumps")
    reached = materialise(heads, "reached")
    while True:
        ahead = reached.join(jumps, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        ahead = ahead.join(jumps.select("file", "offset"), ["file", "offset"])
        grown = materialise(reached.union(ahead).distinct(), "reached")
        onward = jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("beyond"))
        longer = jumps.join(onward, ["file", "next"]).select("file", "offset", F.col("beyond").alias("next"))
        longer = materialise(longer, "jumps")
        reached = grown
        if longer.isEmpty():
            break
        jumps = materialise(
            jumps.join(longer.select("file", "offset"), ["file", "offset"], "left_anti").select(
                "file", "offset", F.lit(-1).cast("long").alias("next")
            ).union(longer), "jumps"
        )
    entries = reached.withColumn("span", spans)
    return nodes.groupBy("file", "span").cogroup(entries.groupBy("file", "span")).applyInArrow(_mark, shape)


def _joined(spark: SparkSession, path: str, broken: DataFrame, bin_: int = 1 << 20) -> DataFrame:
    """Records whose payload holds the magic line, from all their pieces in order."""
    wanted = broken.select("file", F.col("offset").alias("record"), "next").withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col("record") / bin_), F.floor((F.col("next") - 1) / bin_)))
    )
    files = broken.select("file").distinct()
    pieces = _placed(_segments(spark, path).join(files, "file", "left_semi"))
    pieces = pieces.withColumn("bin", F.floor(F.col("offset") / bin_))
    own = pieces.join(wanted, ["file", "bin"]).filter(
        (F.col("offset") >= F.col("record")) & (F.col("offset") < F.col("next"))
    )
    whole = own.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("parts")
    )
    value = F.array_join(F.transform("parts", lambda x: x["value"]), MAGIC)
    return whole.select("file", F.col("record").alias("offset"), value.alias("value")).withColumn(
        "size", F.octet_length("value").cast("long")
    )


def read_archive(
    spark: SparkSession, path: str, key_type: str = "long", span: int = SPAN, with_payload: bool = False
) -> DataFrame:
    """One row per record that the chain of its file reaches.

    ``payload_bytes`` and ``payload_digest`` belong to the full payload; those of a revisit
    are those of the response it refers to.  ``intact`` tells whether a response has the
    digest that its header states.
    """
    parsed = _parsed(_segments(spark, path))  # before any shuffle, so that no payload is moved
    placed = _placed(parsed if with_payload else parsed.drop("payload")).drop("size")
    candidates = materialise(placed, "candidates")
    stated = candidates.filter(F.col("stated").isNotNull())
    nodes = stated.select("file", "offset", (F.col("offset") + len(MAGIC) + F.col("stated")).alias("next"))
    found = materialise(reachable(nodes, span), "reached")
    records = candidates.join(found, ["file", "offset"])
    broken = nodes.join(records.filter(~F.col("whole")).select("file", "offset"), ["file", "offset"])
    broken = materialise(broken, "broken")
    if not broken.isEmpty():
        joined = _parsed(_joined(spark, path, broken)).select(records.columns)
        records = records.filter("whole").union(joined.filter("whole"))

    def key(c):
        return F.url_decode(F.col(c)).cast(key_type)

    response = F.col("type") == "response"
    sizes = records.filter(response).groupBy("digest").agg(F.max("payload_bytes").alias("full_bytes"))
    records = records.withColumn("digest", F.when(response, F.col("digest")).otherwise(F.col("stated_digest")))
    return records.join(sizes, "digest", "left").select(
        key("id").alias("page_id"),
        F.when(response, F.col("payload_bytes")).otherwise(F.col("full_bytes")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        key("refers_to").alias("refers_to"),
        F.when(response, F.col("digest") == F.col("stated_digest")).alias("intact"),
        "file",
        "offset",
        *(["payload"] if with_payload else []),
    )


def archive_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
