"""N-gram Jaccard join by grouped prefixes: which documents share enough word shingles.

1. A document's set holds the 64-bit hashes of its distinct shingles.  Similar sets share
   a part of their heads, the smallest hashes: documents whose head shares too little with
   all others end here.  Documents of equal sets go on as one node.
2. Of the nodes' whole sets, ordered by document frequency, the rarest shingles are the
   prefix; shingles that occur once link nothing and only use up its length.
3. Nodes of equal size and prefix are one group.  In every posting list of a prefix
   shingle, groups are compared with the list's most connected one, and members with the
   representative of their own: as many pairs as postings, never all pairs of a list.
4. Of what is still in different components, pairs of groups that share a posting list
   are filtered by size, by the place of the first common shingle in both orders, behind
   which enough must be left, by the triangle inequality of the Jaccard distance with
   the distances that step 3 measured, and by parity: each set is also known by 512 bits,
   which a shingle flips one of, and sets differ in as many shingles as bits at least.
   All this is settled before a pair leaves the join; the rest is expanded and verified,
   so no link is lost.

Defined results: a text without words, or null, has an empty set and a component of its
own; a null key is no candidate for a component's name (a component without any has null);
rows of equal keys are documents of their own; other columns do not take part.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.tables import Scratch, components
from gleanery.llm.words import Words, mix, parts, runs

#: Ids that are broadcast at most, eight bytes each; beyond, the join is a shuffle.
BROADCAST_IDS = 500_000
#: Further hubs of a posting list that are tried before its groups are paired.
MORE_HUBS, MORE_PICKS = 3, 8
#: Words of 64 parity bits that stand for a set.
PARITY_WORDS = 8
_BITS = [f"b{i}" for i in range(PARITY_WORDS)]


def _least_overlap(n, percent: int):
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-percent * n // 100)


def _support(n):
    """Head shingles that similar sets of n have in common at least."""
    return -(-n // 10)


def _head(n: int, percent: int) -> int:
    return min(n, n - _least_overlap(n, percent) + _support(n))


def _sets(texts: pa.Array, shingle: int):
    """For each text its sorted distinct shingle hashes; a shorter text is one shingle."""
    for part in parts(texts):
        words = Words(part, lower=True)
        hashes = words.hashes()
        all_runs = runs(hashes, shingle)
        for a, b in zip(words.first, words.first[1:]):
            if b - a >= shingle:
                yield np.unique(all_runs[a : b - shingle + 1])
            elif b > a:
                yield runs(hashes[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def _signature(hashes: np.ndarray) -> bytes:
    """128 bits that are equal for equal sets."""
    one, two = mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), mix(hashes + np.uint64(0x5851F42D4C957F2D))
    return np.array([one.sum(dtype=np.uint64), two.sum(dtype=np.uint64) ^ np.uint64(len(hashes))]).tobytes()


def _parity(hashes: np.ndarray) -> np.ndarray:
    """Of the shingles that fall on each bit, whether their number is odd."""
    bits = 64 * PARITY_WORDS
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def shingle_heads(docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """``(rid, doc_id, n, sig, head)`` per row; of equal sets in a batch one has the head."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i in range(0, len(batch), 2048):
                rows = batch.slice(i, 2048)
                n, sigs, heads, seen = [], [], [], set()
                for hashes in _sets(rows.column(1), shingle):
                    sig = _signature(hashes) if len(hashes) else None
                    n.append(len(hashes))
                    heads.append(hashes[: 0 if sig in seen else _head(len(hashes), percent)])
                    sigs.append(sig)
                    seen.add(sig)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rid, rid + len(n))), rows.column(0), pa.array(n, pa.int64()),
                     pa.array(sigs, pa.binary()), _lists(heads)],
                    ["rid", "doc_id", "n", "sig", "head"],
                )
                rid += len(n)

    return docs.select(key, text).mapInArrow(
        run, f"rid long, doc_id {kind}, n long, sig binary, head array<long>"
    )


def full_sets(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``(sig, members, n, bits)``: whole sets, their sizes and their parity bits."""

    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), 256):
                sets = list(_sets(batch.column(0).slice(i, 256), shingle))
                bits = np.array([_parity(s) for s in sets], np.int64).reshape(-1, PARITY_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signature(s) for s in sets], pa.binary()), _lists(sets),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.StructArray.from_arrays([pa.array(b) for b in np.ascontiguousarray(bits.T)], _BITS)],
                    ["sig", "members", "n", "bits"],
                )

    bits = ", ".join(f"{b}: long" for b in _BITS)
    return docs.select(text).mapInArrow(run, f"sig binary, members array<long>, n long, bits struct<{bits}>")


def _sharing(scratch: Scratch, heads: DataFrame, percent: int) -> DataFrame:
    """``(rid, sig, n)`` of the rows whose head shares enough with other heads."""
    rows = heads.select(F.explode("head").alias("h"), "rid")
    counts = rows.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1").select("h")
    # written down, so that both sides of the join are shuffled and a hot shingle can be split
    counts = scratch.write(counts, "counts")
    shared = rows.join(counts, "h").groupBy("rid").agg(F.count("*").alias("shared"))
    least = F.floor((F.floor((F.col("n") * percent + 99) / 100) + 9) / 10)
    return heads.select("rid", "sig", "n").join(shared, "rid").filter(F.col("shared") >= least).drop("shared")


def _with_prefixes(scratch: Scratch, sets: DataFrame, percent: int) -> DataFrame:
    """``(node, n, r, prefix)`` of the nodes whose prefix holds a shingle of another node.

    ``r`` of the n shingles occur in another set.  The others come first in the order and
    use up the prefix without a posting.
    """
    rows = sets.select(F.explode("members").alias("h"), "node", F.size("members").cast("long").alias("n"))
    counts = scratch.write(rows.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "counts")
    shared = rows.join(counts, "h").groupBy("node").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "h"))).alias("shared")
    )
    r = F.size("shared").cast("long")
    room = r - F.floor((F.col("n") * percent + 99) / 100) + 1
    first = F.slice("shared", F.lit(1), room.cast("int"))
    return shared.filter(room > 0).select("node", "n", r.alias("r"), F.transform(first, lambda x: x["h"]).alias("prefix"))


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact distance of every pair (a, b), and whether it links."""

    def side(c):
        return sets.select(F.col("node").alias(c), F.col("members").alias(f"set_{c}"))

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    united = F.size("set_a") + F.size("set_b") - F.col("common")
    return both.withColumn("common", common).select(
        *pairs.columns,
        (1 - F.col("common") / united).alias("distance"),
        (100 * F.col("common").cast("long") >= percent * united.cast("long")).alias("linked"),
    )


def _may_link(n1: Column, r1: Column, n2: Column, r2: Column, percent: int) -> Column:
    """Sizes fit, and what both sets share at most is enough.

    At a posting ``r`` is what is left from its place on: shingles before the first common
    one are not shared.  A pair fails at its later postings at worst, never at its first.
    """
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (
        (100 + percent) * F.least(r1, r2) >= percent * (n1 + n2)
    )


def _near_enough(n1: Column, n2: Column, all1: str, any1: str, all2: str, any2: str, percent: int) -> Column:
    """Whether the parity bits allow two sets, or any two of two lots of sets, to link.

    Given are the bits that all sets of a lot have, and those that any has.  A bit that all
    of one and none of the other have takes a shingle that is in one set only.
    """
    def bit(column, b):
        return F.col(f"{column}.{b}")

    apart = reduce(Column.__add__, [
        F.bit_count(
            bit(all1, b).bitwiseAND(F.bitwise_not(bit(any2, b))).bitwiseOR(
                bit(all2, b).bitwiseAND(F.bitwise_not(bit(any1, b)))
            )
        )
        for b in _BITS
    ])
    return (100 + percent) * apart <= (100 - percent) * (n1 + n2)


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``."""
    scratch = Scratch(docs.sparkSession, "similar")
    heads = scratch.write(shingle_heads(docs, key, text, shingle, percent), "heads")
    nodes = _sharing(scratch, heads, percent).groupBy("sig").agg(F.min("rid").alias("node"))
    nodes = scratch.write(nodes, "nodes")
    rows = scratch.write(heads.drop("head"), "rows")
    scratch.release(heads)

    sets = scratch.write(_member_sets(docs, rows, nodes, key, text, shingle), "sets")
    members = _with_prefixes(scratch, sets, percent)
    same = [F.xxhash64("n", "prefix").alias("p"), F.xxhash64("prefix", "n").alias("q")]
    members = scratch.write(members.select("*", *same, (1000 * (F.col("n") - F.col("r")) / F.col("n")).cast("int").alias("alone")), "members")
    scratch.release()
    groups = members.groupBy("p", "q").agg(F.min(F.struct("alone", "node"))["node"].alias("gid"))
    members = scratch.write(members.join(groups, ["p", "q"]).drop("p", "q"), "members")

    reps = members.filter("node = gid")
    postings = scratch.write(reps.select("gid", "n", "r", "alone", F.posexplode("prefix").alias("place", "h")), "postings")
    postings = postings.withColumn("rest", F.col("r") - F.col("place"))
    hubs = postings.groupBy("h").agg(
        F.count("*").alias("groups"),
        *[
            F.min(F.struct(order, "gid", "n", "rest")).alias(f"hub{i}")
            for i, order in enumerate([(1000 * (F.col("n") - F.col("rest")) / F.col("n")).cast("int").alias("o"), *[F.xxhash64("gid", F.lit(i)).alias("o") for i in range(MORE_HUBS)]])
        ],
    )
    hubs = scratch.write(hubs.filter("groups > 1"), "hubs")

    def near(i):
        """Groups against the lists' hubs of number i, as far as they may link."""
        hub = hubs.select("h", F.col(f"hub{i}.gid").alias("hub"), F.col(f"hub{i}.n").alias("hub_n"), F.col(f"hub{i}.rest").alias("hub_rest"))
        fits = _may_link(F.col("n"), F.col("rest"), F.col("hub_n"), F.col("hub_rest"), percent)
        pairs = postings.join(hub, "h").filter((F.col("gid") != F.col("hub")) & fits)
        return pairs.select(F.col("gid").alias("a"), F.col("hub").alias("b"))

    own = members.filter("node != gid").select(F.col("node").alias("a"), F.col("gid").alias("b"))
    first = scratch.write(_compared(near(0).distinct().union(own), sets, percent), "compared")
    scratch.release()
    found = scratch.write(components(scratch, first.filter("linked").select("a", "b")), "components")

    # groups that did not meet their component in the first hub try a few others, and
    # members that are unlike their representative try some of their own group
    picks = members.groupBy("gid").agg(
        F.array_distinct(F.array(*[F.min(F.struct(F.xxhash64("node", F.lit(i)), "node"))["node"] for i in range(MORE_PICKS)])).alias("picks")
    )
    astray = members.filter("node != gid").select("node", "gid").join(
        first.filter("not linked").select(F.col("a").alias("node"), F.col("b").alias("gid")), ["node", "gid"], "left_semi"
    )
    within = astray.join(picks, "gid").select(F.col("node").alias("a"), F.explode("picks").alias("b")).filter("a != b")
    others = reduce(DataFrame.union, [near(1 + i) for i in range(MORE_HUBS)]).union(within).distinct()
    for side in "ab":
        of = found.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
        others = others.join(of, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
        others = others.join(sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
    others = others.filter(
        (F.col("of_a") != F.col("of_b"))
        & _near_enough(F.col("n_a"), F.col("n_b"), "bits_a", "bits_a", "bits_b", "bits_b", percent)
    ).select("a", "b")
    found, links = _grown(scratch, found, first.filter("linked").select("a", "b"), _compared(others, sets, percent))

    hubs = hubs.select("h", F.col("hub0.gid").alias("hub"))
    more = scratch.write(_across(members.join(sets.select("node", "bits"), "node"), hubs, first, found, percent), "across")
    scratch.release()
    if not more.isEmpty():
        found, _ = _grown(scratch, found, links, _compared(more, sets, percent))
    return _named(rows, nodes, found)


def _grown(scratch: Scratch, found: DataFrame, links: DataFrame, compared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components and links after further comparisons, those before if none links."""
    new = scratch.write(compared.filter("linked").select("a", "b"), "links")
    if new.isEmpty():
        return found, links
    links = links.union(new)
    return scratch.write(components(scratch, links), "components"), links


def _member_sets(docs, rows, nodes, key, text, shingle) -> DataFrame:
    """``(node, members, n, bits)``: the whole sets of the nodes, from a second look at their texts."""
    wanted = rows.join(nodes.select(F.col("node").alias("rid")), "rid").select("doc_id")
    few = wanted.count() <= BROADCAST_IDS
    wanted = F.broadcast(wanted) if few else wanted
    texts = docs.join(wanted, docs[key].eqNullSafe(wanted["doc_id"]), "left_semi")
    sets = full_sets(texts, text, shingle).join(nodes.select("sig", "node"), "sig")
    return sets.dropDuplicates(["node"]).select("node", "members", "n", "bits")


def _across(members: DataFrame, hubs: DataFrame, compared: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes that may link and lie in different components, each once.

    The unit is the part of a group that lies in one component.  In a posting list the
    units of the commonest component are not paired with each other.
    """
    limit = 1 - percent / 100 + 1e-9
    placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    measured = compared.select(F.col("a").alias("x"), F.col("b").alias("y"), "distance")
    inner = measured.select(F.col("x").alias("node"), F.col("y").alias("gid"), F.col("distance").alias("inner"))
    placed = placed.join(inner, ["node", "gid"], "left").withColumn(
        "inner", F.when(F.col("node") == F.col("gid"), F.lit(0.0)).otherwise(F.coalesce("inner", F.lit(1.0)))
    )
    units = placed.groupBy("gid", "component").agg(
        F.first("n").alias("n"), F.max("r").alias("r"), F.max("inner").alias("spread"), F.first("prefix").alias("prefix"),
        F.struct(*[F.bit_and(f"bits.{b}").alias(b) for b in _BITS]).alias("all"),
        F.struct(*[F.bit_or(f"bits.{b}").alias(b) for b in _BITS]).alias("any"),
    )
    listed = units.select("gid", "component", "n", "r", "spread", "all", "any", F.posexplode("prefix").alias("place", "h"))
    listed = listed.withColumn("rest", F.col("r") - F.col("place"))
    sizes = listed.groupBy("h", "component").agg(F.count("*").alias("units"))
    mixed = sizes.groupBy("h").agg(F.max_by("component", F.struct("units", "component")).alias("main"), F.count("*").alias("k"))
    listed = listed.join(mixed.filter("k > 1").select("h", "main"), "h").join(hubs.select("h", "hub"), "h", "left")
    listed = listed.join(
        measured.select(F.col("x").alias("gid"), F.col("y").alias("hub"), F.col("distance").alias("away")),
        ["gid", "hub"],
        "left",
    ).withColumn("away", F.when(F.col("gid") == F.col("hub"), F.lit(0.0)).otherwise(F.col("away")))
    left = listed.filter(F.col("component") != F.col("main")).alias("l")
    right = listed.alias("r")
    gap = F.coalesce(F.abs(F.col("l.away") - F.col("r.away")), F.lit(0.0))
    units = left.join(
        right,
        (F.col("l.h") == F.col("r.h"))
        & (F.col("l.component") != F.col("r.component"))
        & _may_link(F.col("l.n"), F.col("l.rest"), F.col("r.n"), F.col("r.rest"), percent)
        & (gap - F.col("l.spread") - F.col("r.spread") <= limit)
        & _near_enough(F.col("l.n"), F.col("r.n"), "l.all", "l.any", "r.all", "r.any", percent),
    ).groupBy(
        F.col("l.gid").alias("gid"), F.col("l.component").alias("component"),
        F.col("r.gid").alias("gid2"), F.col("r.component").alias("component2"),
    ).agg(F.max(gap).alias("gap"))
    one = placed.select("gid", "component", F.col("node").alias("x"), F.col("inner").alias("dx"), F.col("n").alias("n1"), F.col("r").alias("r1"), F.col("bits").alias("bits1"))
    two = placed.select(
        F.col("gid").alias("gid2"), F.col("component").alias("component2"), F.col("node").alias("y"),
        F.col("inner").alias("dy"), F.col("n").alias("n2"), F.col("r").alias("r2"), F.col("bits").alias("bits2"),
    )
    pairs = units.join(one, ["gid", "component"]).join(two, ["gid2", "component2"])
    pairs = pairs.filter(
        (F.col("gap") - F.col("dx") - F.col("dy") <= limit)
        & _may_link(F.col("n1"), F.col("r1"), F.col("n2"), F.col("r2"), percent)
        & _near_enough(F.col("n1"), F.col("n2"), "bits1", "bits1", "bits2", "bits2", percent)
    )
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _named(rows: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Every row with the smallest key of its component."""
    sets = rows.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    sets = sets.join(nodes.join(found, "node").select("sig", "component"), "sig", "left")
    named = sets.groupBy("component").agg(F.min("least").alias("smallest")).filter("component is not null")
    sets = sets.join(named, "component", "left").select("sig", F.coalesce("smallest", "least").alias("name"))
    return rows.join(sets, "sig", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("name")).alias("component_id"),
    )
