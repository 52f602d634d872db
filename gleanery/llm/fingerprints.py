"""Document fingerprints from closed syncmers, in DataFrame expressions only.

A text is read as tokens: white-space words cut at 32 characters, and single characters
of scripts written without spaces.  A run of ``k`` tokens is an anchor when the smallest
hash among its inner runs of ``s`` tokens lies at its first or last place.  Whether a run
is an anchor depends on its own tokens alone, so equal passages give equal anchors
wherever they stand.  An element of a fingerprint is an anchor's hash with the distance
to the next anchor, which matches anchors together with their relative positions.

Defined results: a null text counts as empty; texts without tokens have the empty
fingerprint, alike to each other (1) and unlike any other (0).  Keys may be of any type that
can be ordered; null keys come after all others and equal keys follow their texts.  A text
of any length is read whole, within its row; an empty table gives no rows.  Columns other
than key and text do not take part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

UNSPACED = r"฀-໿぀-ヿ㐀-鿿\x{20000}-\x{3FFFF}"
TOKENS = rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]{{1,32}}"


@dataclass(frozen=True)
class Syncmers:
    """Length ``k`` of a run and ``s`` of its inner runs, ``pad`` empty tokens at each end
    so that texts below ``k`` tokens have anchors too; runs with a leading empty token
    are always anchors, which tells short texts apart that share their beginning."""

    k: int = 6
    s: int = 2
    pad: int = 4


def with_elements(df: DataFrame, text: str, out: str, syncmers: Syncmers = Syncmers()) -> DataFrame:
    """Adds the fingerprint of ``text`` as an array of longs in text order."""
    k, s, pad = syncmers.k, syncmers.s, syncmers.pad
    inner = k - s  # the last inner run starts here
    empty = F.array(*[F.lit("")] * pad)
    tokens = F.regexp_extract_all(F.col(text), F.lit(TOKENS), F.lit(0))
    t, h, at = F.col("_tokens"), F.col("_inner"), F.col("_at")
    n = F.size(t)

    def inner_hash(i):
        return F.xxhash64(*[F.get(t, i + d) for d in range(s)])

    def is_anchor(i):
        between = [F.get(h, i + d) for d in range(1, inner)]
        edges = F.least(F.get(h, i), F.get(h, i + inner))
        return (i < pad) | (edges <= (F.least(*between) if len(between) > 1 else between[0]))

    def element(i, place):
        parts = [F.get(h, i + d) for d in sorted({*range(0, inner, s), inner})]
        gap = F.least(F.lit(15), F.coalesce(F.get(at, place + 1) - i, F.lit(0)))
        return F.xxhash64(*parts).bitwiseAND(F.lit(0xFFFFFFFF)) * 16 + gap

    return (
        df.withColumn("_tokens", tokens)
        .withColumn("_tokens", F.when(n > 0, F.concat(empty, t, empty)).otherwise(F.array().cast("array<string>")))
        .withColumn("_inner", F.when(n >= k, F.transform(F.sequence(F.lit(0), n - s), inner_hash)))
        .withColumn("_at", F.when(n >= k, F.filter(F.sequence(F.lit(0), n - k), is_anchor)))
        .withColumn(out, F.coalesce(F.transform(at, element), F.array().cast("array<bigint>")))
        .drop("_tokens", "_inner", "_at")
    )


def as_text(elements: Column) -> Column:
    """Nine hexadecimal digits an element: eight of the anchor, one of the distance."""
    return F.array_join(F.transform(elements, lambda x: F.lpad(F.hex(x), 9, "0")), "")


def from_text(fingerprint: Column) -> Column:
    digits = F.regexp_extract_all(fingerprint, F.lit(".{9}"), F.lit(0))
    return F.transform(digits, lambda x: F.conv(x, 16, 10).cast("long"))


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared elements over all distinct elements of both, 0 to 1."""
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * shared / total)


def _borders(docs: DataFrame, key: str, n_rows: int, n_ranges: int) -> list:
    """Up to ``n_ranges`` keys in ascending order that part the rows about evenly; the last
    one is the largest of all."""
    if isinstance(docs.schema[key].dataType, NumericType):
        shares = [i / n_ranges for i in range(1, n_ranges + 1)]
        found = docs.agg(F.percentile_approx(key, shares, 10 * max(1000, n_ranges)).alias("b")).first()["b"]
        return sorted(set(found or []))
    one_in = max(1, n_rows // (16 * n_ranges))
    keys = docs.select(F.col(key).alias("k")).filter("k is not null")
    sample = keys.filter(F.pmod(F.xxhash64("k"), F.lit(one_in)) == 0).distinct()
    place = F.ntile(n_ranges).over(Window.orderBy("k"))
    parted = sample.withColumn("part", place).groupBy("part").agg(F.max("k").alias("k"))
    largest = keys.agg(F.max("k").alias("k")).filter("k is not null")
    return [r["k"] for r in parted.select("k").union(largest).distinct().orderBy("k").collect()]


def with_neighbours(
    docs: DataFrame, key: str, text: str, n_rows: int, rows_per_range: int = 256, max_ranges: int = 65536
) -> tuple[DataFrame, Column]:
    """Deals rows out by ranges of ``key`` in descending order, and what gives the next row.

    The borders of the ranges are keys that occur: approximate quantiles of numbers, for keys
    of another type those of a sample by hash; a bounded list either way.
    The row that holds a border is also dealt, as a guest, to the range above, whose last
    row it follows; the row of the largest key is the guest of the lowest range.  So every
    row finds its follower within its range and no range is gathered whole by the driver.
    Equal keys are ordered by text; null keys come last.  Returns the rows and the window.
    """
    n_ranges = max(1, min(max_ranges, n_rows // rows_per_range))
    borders = _borders(docs, key, n_rows, n_ranges)
    kind = docs.schema[key].dataType
    steps, bounds = [1 << b for b in reversed(range(len(borders).bit_length()))], F.array(F.lit(None).cast(kind))
    if borders:
        bounds = F.lit(borders) if isinstance(kind, NumericType) else F.array(*[F.lit(b).cast(kind) for b in borders])
    id_ = F.col(key)
    # how many borders lie below the key, by halving steps
    place = F.aggregate(
        F.lit(steps), F.lit(0), lambda lo, step: F.when(F.get(bounds, lo + step - 1) < id_, lo + step).otherwise(lo)
    )
    place = F.when(id_.isNull() | F.lit(not borders), F.lit(0)).otherwise(place)
    home = F.struct(F.col("_range"), F.lit(False).alias("guest"))
    away = F.struct(((F.col("_range") + 1) % max(1, len(borders))).alias("_range"), F.lit(True).alias("guest"))
    border = F.get(bounds, F.col("_range")) == id_ if borders else F.lit(False)
    dealt = (
        docs.withColumn("_range", place)
        .withColumn("_to", F.explode(F.when(border, F.array(home, away)).otherwise(F.array(home))))
        .withColumns({"_range": F.col("_to._range"), "_guest": F.col("_to.guest")})
        .drop("_to")
        .repartition("_range")
    )
    return dealt, Window.partitionBy("_range").orderBy("_guest", F.desc_nulls_last(key), text)


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likenesses.

    The edited form replaces the last third of the code points by as many first ones of
    the next document.  Further columns of ``docs`` do not take part.
    """
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    dealt, order = with_neighbours(rows, key, "_text", rows.count())
    dealt = with_elements(dealt, "_text", "_own")

    def following(c):
        return F.coalesce(F.lead(c).over(order), F.first(c).over(order))

    n = F.char_length("_text")
    third = F.floor(n / 3).cast("int")
    paired = dealt.select(
        key, "_text", "_own", "_guest", following("_text").alias("_next_text"), following("_own").alias("_next")
    ).filter(~F.col("_guest"))
    paired = paired.withColumn(
        "_edited_text",
        F.concat(F.substring("_text", F.lit(1), n - third), F.substring("_next_text", F.lit(1), third)),
    )
    return with_elements(paired, "_edited_text", "_edited").select(
        key,
        n.cast("long").alias("n_chars"),
        F.sha2(F.encode("_edited_text", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )
