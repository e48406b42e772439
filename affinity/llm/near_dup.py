"""Near duplicates by circulant MinHash.

Two fixed permutations of the 64-bit ring make every signature coordinate: the
first scatters a shingle, the second is read at the scattered place shifted by
k for coordinate k.  Bands of coordinates give candidate buckets, exact Jaccard
similarity of the full shingle sets confirms links, and documents linked by a
chain form a component.

Documents with equal sets are one node, so copies cost nothing.  A bucket
compares its nodes with one leader only, that which meets most other nodes.  Two nodes of a bucket that are both
linked to the leader are in one component already; any other pair is found by
its edits, that is by what tells its sets from the leader's.  If one of the two
is not linked to the leader, a link between them takes more shared edits than
pairs that changed the leader by themselves have: the prefixes of both edit
lists, rarest in the star first, must meet, and bitmaps of the edits must not
differ in more bits than linked sets may in members; only such pairs are
compared.  So no link of a bucket is missed, and a large group of near copies
does not pair all with all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import hashes, map_slices, mix, tokenise, written

#: 32 bands of 4 coordinates: a pair of similarity 0.8 shares none once in 20 million.
BANDS, ROWS = 32, 4
#: Nodes up to which their ids are broadcast to filter the texts (16 bytes each).
BROADCAST_NODES = 1_000_000
#: 64-bit words of the bitmaps of edits (a power of two).
BIT_WORDS = 8
_SHINGLE = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shingles(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word shingles of each text, sorted, and their offsets.

    A text of fewer words than ``width`` has its whole sequence as one shingle; one without words none.
    """
    codes, offsets, words = tokenise(text, lower=True)
    h = mix(hashes(words))[codes]
    out, counts = [], []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        n = min(width, b - a)
        if not n:
            counts.append(0)
            continue
        s = np.full(b - a - n + 1, n, np.uint64)
        for k in range(n):
            s = (s ^ h[a + k:b - n + 1 + k]) * _SHINGLE
            s ^= s >> np.uint64(29)
        out.append(np.unique(s))
        counts.append(len(out[-1]))
    flat = np.concatenate(out) if out else np.empty(0, np.uint64)
    return flat, np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def signature(flat: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """``size`` circulant MinHash coordinates of each (non-empty) set."""
    place = mix(flat)  # the first permutation
    out = np.empty((len(starts), size), np.uint64)
    z, t = np.empty_like(place), np.empty_like(place)
    for k in range(size):
        np.add(place, np.uint64(k), out=z)  # the second one, shifted by k around the ring
        for shift, factor in ((31, _MIX_A), (29, _MIX_B)):
            np.right_shift(z, np.uint64(shift), out=t)
            np.bitwise_xor(z, t, out=z)
            np.multiply(z, factor, out=z)
        np.right_shift(z, np.uint64(32), out=t)
        np.bitwise_xor(z, t, out=z)
        out[:, k] = np.minimum.reduceat(z, starts)
    return out


def _bands(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(signatures), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(signatures), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            h = mix((h * _SHINGLE) ^ signatures[:, k])
        out[:, b] = h
    return out


def _node_ids(flat: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """128-bit ids of sets: two sums of differently mixed members."""
    a = np.add.reduceat(mix(flat ^ _MIX_A), starts)
    b = np.add.reduceat(mix(flat ^ _MIX_B), starts)
    return [x.tobytes() for x in np.stack([a, b], axis=1)]


def _signed(df: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = shingles(batch.column("text"), width)
        counts = np.diff(offsets)
        full = np.flatnonzero(counts)
        nodes: list = [None] * len(counts)
        values: list = [None] * len(counts)
        if len(full):
            starts = offsets[:-1][full]
            keys = _bands(signature(flat, starts, bands * rows), bands, rows).view(np.int64)
            for i, node, key in zip(full.tolist(), _node_ids(flat, starts), keys, strict=True):
                nodes[i], values[i] = node, key
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
             pa.array(values, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "node", "bands"])

    return df.mapInArrow(lambda batches: _run(batches, run), f"doc_id {dict(df.dtypes)['doc_id']}, "
                         "n_shingles long, node binary, bands array<long>")


def _run(batches, fn, limit: int = 1 << 19):
    from affinity.llm.common import slices

    for batch in batches:
        for part in slices(batch, "text", limit):
            yield fn(part)


def _sets(df: DataFrame, width: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        flat, offsets = shingles(batch.column("text"), width)
        full = np.flatnonzero(np.diff(offsets))
        if not len(full):
            return None
        nodes = _node_ids(flat, offsets[:-1][full])
        lists = pa.ListArray.from_arrays(np.concatenate((offsets[:-1][full], offsets[-1:])).astype(np.int32),
                                         pa.array(flat.view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), lists], ["node", "members"])

    return map_slices(df, run, "node binary, members array<long>")


def _stars(nodes: DataFrame) -> DataFrame:
    """(a, b): the nodes that meet in a bucket with the leader b of it.

    A bucket's leader is its node that meets most nodes over all of its buckets.
    In a group of near copies that is one with few edits, which most others
    share a bucket with: one star with short edits, many of its nodes linked,
    where a far node as leader would have long ones and few links.
    """
    buckets = nodes.select("uid", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = written(buckets.join(sizes, "bucket"), "buckets")
    meets = buckets.groupBy("uid").agg(F.sum("size").alias("meets"))
    leaders = buckets.join(meets, "uid").groupBy("bucket").agg(
        F.max(F.struct("meets", (-F.col("uid")).alias("uid"))).alias("first"))
    leaders = leaders.select("bucket", (-F.col("first.uid")).alias("b"))
    return buckets.join(leaders, "bucket").where("uid != b").select(F.col("uid").alias("a"), "b").distinct()


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) with their sets ma and mb."""
    left = sets.select(F.col("uid").alias("a"), F.col("members").alias("ma"))
    right = sets.select(F.col("uid").alias("b"), F.col("members").alias("mb"))
    return pairs.join(left, "a").join(right, "b")


def _similar(differ: Column, sizes: Column, percent: int) -> Column:
    """Whether sets of so many members in sum, so many of them in one only, share ``percent`` of their union."""
    return differ * (100 + percent) <= sizes * (100 - percent)


def _compare_with_leader(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, n, differ, linked, edits, probe, index, bits): nodes against their leader b.

    A link of a and another node y of b's star, one of them not linked to b,
    takes at least (differ_a + differ_y - limit) / 2 shared edits, limit being
    the most that similar sets of their sizes differ by.  ``probe`` is the
    prefix of a's edits that must meet y's if a is not linked, ``index`` the one
    that must meet those of any y that is not.  The edits of a and y that are
    not shared are what a and y differ by; ``bits`` maps edits to bits, so two
    maps differ in no more bits than that.
    """
    rows = _with_sets(stars, sets).select(
        "a", "b", F.size("ma").alias("n"), F.size("mb").alias("nb"),
        F.array_sort(F.array_except("ma", "mb")).alias("added"), F.array_sort(F.array_except("mb", "ma")).alias("gone"))
    rows = rows.select("a", "b", "n", "nb", F.concat("added", "gone").alias("edits"))
    rows = rows.withColumn("differ", F.size("edits"))
    rows = rows.withColumn("linked", _similar(F.col("differ"), F.col("n") + F.col("nb"), percent))
    keep, both = 100 - percent, 100 + percent
    probe = F.expr(f"if(linked, 0, differ - greatest(1, differ - cast(floor(n * {keep} / {percent}) as int)) + 1)")
    index = F.expr(f"differ - greatest(1, cast(ceil((differ * {both} + (nb - n) * {keep}) / {2 * both}) as int)) + 1")
    rows = rows.withColumn("probe", probe).withColumn("index", F.greatest(F.lit(0), index))
    bits = F.array(*[F.expr(f"aggregate(edits, 0L, (x, e) -> x | if((e & {BIT_WORDS - 1}) = {k}, "
                            "shiftleft(1L, cast(shiftright(e, 32) & 63 as int)), 0L))") for k in range(BIT_WORDS)])
    # Of linked nodes whose whole star is, no edit is read; the others' are ordered in _between_edits.
    return rows.select("a", "b", "n", "differ", "linked", "probe", "index", bits.alias("bits"), "edits")


def _between_edits(compared: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components, around one leader, whose edits' prefixes meet.

    The edits of a star are ordered by how many of its nodes have them, rarest
    first.  Edits of one node only fill prefixes but meet nothing, so no row is
    made of them; what is common to the star, as are the leader's own words,
    comes last.  A meeting counts only if the edits after it leave room for as
    many shared ones as a link takes.  Bitmaps are looked up for the pairs that
    met, not carried by every edit.
    """
    rows = compared.join(roots.select(F.col("uid").alias("a"), "root"), "a", "left").withColumn(
        "root", F.coalesce("root", "a"))
    # Leaders whose star, the leader included, is one component already have no pair to find.
    lead = roots.select(F.col("uid").alias("b"), F.col("root").alias("own"))
    mixed = rows.groupBy("b").agg(F.min("root").alias("low"), F.max("root").alias("high")).join(lead, "b", "left")
    own = F.coalesce("own", "b")
    # Written, so that its size is known before the rows of a large star are dealt by it.
    mixed = written(mixed.where((F.col("low") != own) | (F.col("high") != own)).select("b"), "mixed-leaders")
    rows = written(rows.join(mixed, "b", "left_semi").where("probe > 0 or index > 0"), "mixed")

    edits = rows.select("a", "b", "n", "differ", "root", "probe", "index", F.explode("edits").alias("e"))
    often = edits.groupBy("b", "e").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = edits.join(often, ["b", "e"])
    node = Window.partitionBy("a", "b")
    # Edits of one node come first: a shared one's place is after them.
    at = F.col("differ") - F.count(F.lit(1)).over(node) + F.row_number().over(node.orderBy("f", "e")) - 1
    shared = shared.withColumn("at", at.cast("int")).withColumn("before", F.lag("e").over(node.orderBy("f", "e")))
    shared = shared.where(F.col("at") < F.greatest("probe", "index"))
    shared = written(shared.select("b", "e", "a", "n", "differ", "root", "probe", "index", "at", "before"), "prefixes")

    x, y = shared.where("at < probe").alias("x"), shared.where("at < index").alias("y")
    sizes = F.col("x.n") + F.col("y.n")
    most = F.least(F.col("x.differ") - F.col("x.at"), F.col("y.differ") - F.col("y.at"))
    # Two nodes that neither is linked meet one way round, and nodes that met at the edit before do not meet again.
    once = (F.col("y.probe") == 0) | (F.col("x.a") < F.col("y.a"))
    again = F.coalesce(F.col("x.before") == F.col("y.before"), F.lit(False))
    found = x.join(y, (F.col("x.b") == F.col("y.b")) & (F.col("x.e") == F.col("y.e")) & once & ~again
                   & (F.col("x.root") != F.col("y.root")) & _close(F.col("x.n"), F.col("y.n"), percent)
                   & _similar(F.col("x.differ") + F.col("y.differ") - 2 * most, sizes, percent))
    met = written(found.select("x.b", F.col("x.a").alias("p"), F.col("y.a").alias("q"), sizes.alias("sizes")).distinct(),
                  "met")
    maps = rows.select("b", "a", "bits")
    met = met.join(maps.toDF("b", "p", "left_bits"), ["b", "p"]).join(maps.toDF("b", "q", "right_bits"), ["b", "q"])
    unlike = sum((F.bit_count(F.get("left_bits", F.lit(k)).bitwiseXOR(F.get("right_bits", F.lit(k))))
                  for k in range(1, BIT_WORDS)),
                 F.bit_count(F.get("left_bits", F.lit(0)).bitwiseXOR(F.get("right_bits", F.lit(0)))))
    met = met.where(_similar(unlike, F.col("sizes"), percent))
    return met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of (a, b) whose full sets are similar enough."""
    rows = _with_sets(pairs, sets)
    sizes = F.size("ma") + F.size("mb")
    return rows.where(_similar(sizes - 2 * F.size(F.array_intersect("ma", "mb")), sizes, percent)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(uid, root): the smallest node that each node of the edges (a, b) reaches.

    Alternating steps link each node's larger and smaller neighbours to its
    smallest one until nothing changes; only two sums reach the driver a round.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
                    .distinct(), "links")
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select("u", F.col("m").alias("v")).unionAll(
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        edges = written(small, "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("uid"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("uid"), F.col("v").alias("root")).distinct())


def _close(n: Column, m: Column, percent: int) -> Column:
    """Set sizes that a similarity of ``percent`` allows."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id it reaches), kept (it is that one).

    Two documents are linked if their sets of lower-cased (A-Z) ``width``-word
    shingles share ``percent`` of 100 of their union.  Null and empty texts
    have no shingle, are linked with nothing and kept.  Repeated rows are one
    document; rows of one id with different texts are judged each by its text.
    A null id is no component's smallest unless all are null.  Ids are numbers
    or structs of them.
    """
    ids = F.col(id_col) if dict(docs.dtypes)[id_col].startswith("struct") else F.col(id_col).cast("long")
    texts = docs.select(ids.alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = written(_signed(texts, width, bands, rows), "signatures")
    nodes = signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    nodes = written(nodes.withColumn("uid", F.monotonically_increasing_id()), "nodes")

    stars = written(_stars(nodes), "stars")

    live = stars.select(F.col("a").alias("uid")).unionAll(stars.select(F.col("b").alias("uid"))).distinct()
    live = written(nodes.select("uid", "node", "first").join(live, "uid", "left_semi"), "live")
    ids = live.select(F.col("first").alias("live_id")).distinct()
    if live.limit(broadcast_nodes + 1).count() <= broadcast_nodes:
        ids = F.broadcast(ids)
    some = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("live_id")), "left_semi").select("text")
    sets = _sets(some, width).join(live.select("node", "uid"), "node").select("uid", "members")
    sets = written(sets.dropDuplicates(["uid"]), "sets")

    compared = written(_compare_with_leader(stars, sets, percent), "compared")
    links = compared.where("linked").select("a", "b")
    roots = written(components(links), "roots")
    more = _confirm(_between_edits(compared, roots, percent), sets, percent)
    merged = components(links.unionAll(more))

    groups = nodes.select("node", "uid", "first").join(merged, "uid", "left").select(
        "node", "first", F.coalesce("root", "uid").alias("root"))
    lowest = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    lowest = groups.select("node", "root").join(lowest, "root").select("node", "component_id")
    out = signed.select("doc_id", "n_shingles", "node").join(lowest, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
