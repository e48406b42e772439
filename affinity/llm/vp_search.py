"""Approximate nearest neighbours by vantage-point trees, one per shard.

Nearness is the largest inner product.  A further coordinate, sqrt(M^2 - |x|^2)
for a row and 0 for a query (M: the longest row), turns it into the smallest
Euclidean distance, which keeps the triangle inequality that the trees prune by.

A small tree fitted on a bounded sample routes every row to a region, and a
region of many rows is cut by a hash into shards of about ``shard_rows``; each
shard gets a tree of its own.  A search goes to the shards of the query's own
region first; the distance of its k-th neighbour there then rules out regions,
and leaves inside shards, whose least possible distance, times ``factor``, is
above it.  Factor 1 rules out nothing that could matter: the search is exact.
A larger factor rules out more.

Equal vectors are one point: the k + 1 smallest ids answer for all of them (ties
go to the smaller id and a query leaves out its own row only), so a vector that
a third of the rows share costs no more than another, and equal queries are
searched once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import written

#: Rows a shard holds, about; rows of the sample that the regions are fitted on; rows a leaf holds, about.
SHARD_ROWS, SAMPLE_ROWS, LEAF_ROWS = 8192, 4096, 256
#: Levels of the tree of regions at most (2 ** 9 regions; larger ones are cut into more shards).
MAX_DEPTH = 9
#: Queries that meet a shard at once in a task, and in one matrix product.
GROUP_QUERIES, BLOCK_QUERIES = 65_536, 1024
#: What sums in another order may differ by, relative to the longest row.
SLACK = 1e-9


class VpTree:
    """A balanced vantage-point tree: node i has the children 2 i + 1 (near) and 2 i + 2 (far)."""

    def __init__(self, vantage: np.ndarray, radius: np.ndarray):
        self.vantage, self.radius = vantage, radius
        self.depth = (len(radius) + 1).bit_length() - 1

    @staticmethod
    def fit(points: np.ndarray, depth: int) -> "VpTree":
        """Split at the median distance from a member of each node."""
        nodes = 2**depth - 1
        tree = VpTree(np.zeros((nodes, points.shape[1])), np.full(nodes, np.inf))
        members = {0: np.arange(len(points))}
        for node in range(nodes):
            own = members.pop(node, np.empty(0, np.int64))
            if len(own):
                # The member farthest from another one: a rim splits better than the middle.
                rim = own[np.argmax(_distance(points[own], points[own[:1]])[:, 0])]
                tree.vantage[node] = points[rim]
                far = _distance(points[own], points[rim:rim + 1])[:, 0]
                tree.radius[node] = np.median(far)
                members[2 * node + 1], members[2 * node + 2] = own[far <= tree.radius[node]], own[far > tree.radius[node]]
        return tree

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Distances to every vantage point."""
        return _distance(points, self.vantage)

    def route(self, distances: np.ndarray) -> np.ndarray:
        """The leaf of each point, from its ``distances``."""
        node, row = np.zeros(len(distances), np.int64), np.arange(len(distances))
        for _ in range(self.depth):
            node = 2 * node + 1 + (distances[row, node] > self.radius[node])
        return node - len(self.radius)

    def bounds(self, distances: np.ndarray) -> np.ndarray:
        """The least distance that a point of each leaf can have."""
        low = np.zeros((len(distances), 1))
        for level in range(self.depth):
            at = slice(2**level - 1, 2**(level + 1) - 1)
            gap = distances[:, at] - self.radius[at]
            low = np.maximum(np.repeat(low, 2, axis=1), np.stack([gap, -gap], axis=2).reshape(len(low), -1))
        return low


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)
    return np.sqrt(np.maximum(square, 0))


def _matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows in double precision."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))
    return np.hstack([x, rest[:, None]])


def _query(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.zeros((len(x), 1))])


def _dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, each summed from the first component to the last."""
    out = np.zeros(len(x))
    for k in range(x.shape[1]):
        out += x[:, k] * y[:, k]
    return out


@dataclass
class VpIndex:
    """``shards``: one row per shard; ``regions``: dim -> (tree of regions, shards of each)."""
    shards: DataFrame
    regions: dict[int, tuple[VpTree, np.ndarray]]
    longest: float
    max_k: int
    vector_type: str


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, embedding) of the rows whose vector has finite components, not all zero; repeats once."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad & some).distinct()


def build_index(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", max_k: int = 20,
                shard_rows: int = SHARD_ROWS, sample_rows: int = SAMPLE_ROWS) -> VpIndex:
    """Index every row; the regions are fitted on the ``sample_rows`` rows of the smallest hash.

    Rows without an id, or whose vector is null, zero or holds a null or
    non-finite component, take no part; vectors of different lengths never
    meet.  An empty table gives an index that finds nothing.
    """
    same = Window.partitionBy("embedding").orderBy("vec_id")
    rows = valid_vectors(vectors, id_col, vector_col).withColumn("_n", F.row_number().over(same))
    rows = written(rows.where(F.col("_n") <= max_k + 1).drop("_n"), "vectors")
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest, n = rows.agg(F.coalesce(F.max(square), F.lit(0.0)), F.count(F.lit(1))).first()
    sample = rows.select("embedding").orderBy(F.xxhash64("embedding")).limit(sample_rows).toArrow().column(0)
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(n, 1) / shard_rows)))))
    lengths = np.array([len(x) for x in sample])
    trees = {int(d): VpTree.fit(_lifted(_matrix(sample.filter(pa.array(lengths == d))), longest), depth)
             for d in np.unique(lengths)}

    def route(batches):
        for batch in batches:
            sizes = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
            region = np.zeros(len(sizes), np.int64)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                if d in trees:
                    tree = trees[d]
                    region[at] = tree.route(tree.distances(_lifted(_matrix(batch.column("embedding").take(at)), longest)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("embedding"), pa.array(sizes, pa.int32()),
                 pa.array(region, pa.int32())], ["vec_id", "embedding", "dim", "region"])

    kind = dict(rows.dtypes)["embedding"]
    routed = written(rows.mapInArrow(route, f"vec_id long, embedding {kind}, dim int, region int"), "routed")
    regions = _region_counts(routed, trees, depth, shard_rows)
    dims = F.create_map(*[F.lit(x) for d, (_, cuts) in regions.items() for x in (d, cuts.tolist())]) \
        if regions else F.create_map(F.lit(0), F.array(F.lit(1)))
    cuts = F.get(F.element_at(dims, F.col("dim")), F.col("region"))
    routed = routed.withColumn("part", F.pmod(F.xxhash64("vec_id", "embedding"), cuts).cast("int"))

    def build(key, table):
        points = _matrix(table.column("embedding"))
        lifted = _lifted(points, longest)
        tree = VpTree.fit(lifted, max(0, int(np.ceil(np.log2(len(points) / LEAF_ROWS)))))
        leaf = tree.route(tree.distances(lifted))
        order = np.argsort(leaf, kind="stable")
        starts = np.searchsorted(leaf[order], np.arange(2**tree.depth + 1))
        out = [[x] for x in (key[0].as_py(), key[1].as_py(), key[2].as_py())]
        out += [[x.tobytes()] for x in (table.column("vec_id").to_numpy()[order], points[order], starts.astype(np.int64),
                                        tree.vantage, tree.radius)]
        return pa.table(out, schema=pa.schema([(x, pa.int32()) for x in ("dim", "region", "part")] + [
            (x, pa.binary()) for x in ("ids", "points", "starts", "vantage", "radius")]))

    shards = routed.groupBy("dim", "region", "part").applyInArrow(
        build, "dim int, region int, part int, ids binary, points binary, starts binary, vantage binary, radius binary")
    return VpIndex(written(shards, "shards"), regions, longest, max_k, kind)


def _region_counts(routed: DataFrame, trees: dict, depth: int, shard_rows: int) -> dict:
    """dim -> (tree, shards of each region); a length that the sample lacks is one region."""
    out: dict = {}
    for dim, region, n in routed.groupBy("dim", "region").agg(F.count(F.lit(1))).collect():
        tree, cuts = out.setdefault(dim, (trees.get(dim) or VpTree.fit(np.zeros((1, dim + 1)), 0),
                                          np.ones(2**depth if dim in trees else 1, np.int64)))
        cuts[region] = -(-n // shard_rows)
    return out


def _visits(index: VpIndex, queries: DataFrame, first: bool, factor: float) -> DataFrame:
    """A row per query and shard: the shards of its own region, or those of the others that may hold neighbours."""
    regions, longest = index.regions, index.longest

    def run(batches):
        for batch in batches:
            sizes = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes):
                if d not in regions:
                    continue
                tree, cuts = regions[d]
                at = np.flatnonzero(sizes == d)
                x = _query(_matrix(batch.column("embedding").take(at)))
                far = tree.distances(x)
                own = np.zeros((len(at), len(cuts)), bool)
                own[np.arange(len(at)), tree.route(far)] = True
                kth = batch.column("kth").to_numpy(zero_copy_only=False)[at]
                limit = _reach(x, kth, longest)
                go = own if first else ~own & ~(tree.bounds(far) * factor > limit[:, None])
                q, region = np.nonzero(go)
                times = cuts[region]
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                rows = batch.take(pa.array(at[np.repeat(q, times)]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(np.full(len(part), d), pa.int32()),
                     pa.array(np.repeat(region, times), pa.int32()), pa.array(part, pa.int32())],
                    [*rows.schema.names, "dim", "region", "part"])

    schema = f"query long, embedding {index.vector_type}, kth double, dim int, region int, part int"
    return queries.select("query", "embedding", "kth").mapInArrow(run, schema)


def _reach(x: np.ndarray, kth: np.ndarray, longest: float) -> np.ndarray:
    """The distance of a point whose inner product with the query is ``kth`` (and a little more)."""
    square = (x * x).sum(axis=1) + longest * (1 + SLACK) - 2 * kth
    return np.sqrt(np.maximum(square, 0)) + SLACK * np.sqrt(longest)


def search_shard(shard: dict, x: np.ndarray, kth: np.ndarray, k: int, factor: float,
                 longest: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, id, inner product) of the ``k`` best points of a shard for each query, best first."""
    d = x.shape[1]
    points = np.frombuffer(shard["points"]).reshape(-1, d)
    ids, starts = np.frombuffer(shard["ids"], np.int64), np.frombuffer(shard["starts"], np.int64)
    tree = VpTree(np.frombuffer(shard["vantage"]).reshape(-1, d + 1), np.frombuffer(shard["radius"]))
    lifted = _query(x)
    far = tree.distances(lifted)
    home, low = tree.route(far), tree.bounds(far) * factor
    kth = kth.copy()
    none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    best = none

    def meet(best, leaf, who):
        a, b = starts[leaf], starts[leaf + 1]
        if a == b or not len(who):
            return best
        rough = x[who] @ points[a:b].T
        q, p = np.nonzero(~(rough < kth[who][:, None] - SLACK * longest))
        q, p = who[q], p + a
        return tuple(np.concatenate(pair) for pair in zip(best, (q, ids[p], _dot(x[q], points[p])), strict=True))

    def cut(best):
        q, i, s = best
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        last = rank == k - 1
        kth[q[last]] = np.maximum(kth[q[last]], s[last])
        keep = rank < k
        return q[keep], i[keep], s[keep]

    for leaf in np.unique(home):
        best = meet(best, leaf, np.flatnonzero(home == leaf))
    best = cut(best)
    held = 0
    for leaf in range(len(starts) - 1):
        reach = _reach(lifted, kth, longest)
        best = meet(best, leaf, np.flatnonzero((home != leaf) & ~(low[:, leaf] > reach)))
        if len(best[0]) > 2 * held + 4 * k * len(x) or leaf == len(starts) - 2:
            best = cut(best)
            held = len(best[0])
    return best


def _meet(index: VpIndex, visits: DataFrame, groups: int, k: int, factor: float) -> DataFrame:
    """(query, vec_id, score): the best of every shard a query visits."""
    longest = index.longest
    keys = ["dim", "region", "part", "lot"]
    visits = written(visits.withColumn("lot", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int")), "visits")
    asked = visits.select(*keys).distinct().toDF(*keys)
    shards = index.shards.join(asked, ["dim", "region", "part"])

    def run(key, left, right):
        out = []
        if left.num_rows and right.num_rows:
            shard = left.slice(0, 1).to_pylist()[0]
            for a in range(0, right.num_rows, BLOCK_QUERIES):
                block = right.slice(a, BLOCK_QUERIES)
                q, ids, scores = search_shard(shard, _matrix(block.column("embedding")),
                                              block.column("kth").to_numpy(), k, factor, longest)
                out.append(pa.table([block.column("query").to_numpy()[q], ids, scores], names=["query", "vec_id", "score"]))
        schema = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        return pa.concat_tables(out).cast(schema) if out else schema.empty_table()

    return shards.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(
        run, "query long, vec_id long, score double")


def search(index: VpIndex, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
           factor: float = 1.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query, its own row left out.

    ``score`` is the inner product in double precision, summed in the order of
    the components; ties go to the smaller id.  Queries without a usable vector
    give no row, and one with fewer than ``k`` candidates gives them all.
    ``factor`` 1 is exact; a larger one skips regions and leaves whose least
    distance, times it, is above the distance of the k-th neighbour so far.
    Repeated rows of one id and vector are one row; another vector of the same
    id is another row.
    """
    if k > index.max_k or factor < 1:
        raise ValueError("k is at most the index's max_k, factor at least 1")
    asked = written(valid_vectors(queries, id_col, vector_col).withColumnRenamed("vec_id", "query_id"), "asked")
    points = written(asked.groupBy("embedding").agg(F.count(F.lit(1)).alias("n"))
                     .withColumn("query", F.monotonically_increasing_id()), "queries")
    groups = -(-max(1, points.count()) // GROUP_QUERIES)
    first = _meet(index, _visits(index, points.withColumn("kth", F.lit(float("-inf"))), True, factor), groups, k + 1, factor)
    first = written(first, "near")
    by_rank = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("at", F.row_number().over(by_rank)).where(F.col("at") <= k + 1)

    kth = best(first).where(F.col("at") == k + 1).select("query", F.col("score").alias("kth"))
    # The k + 1 best leave k after a query's own row.
    left = points.join(kth, "query", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
    more = _meet(index, _visits(index, left, False, factor), groups, k + 1, factor)
    found = best(first.unionAll(more)).groupBy("query").agg(F.array_sort(F.collect_list(
        F.struct("at", "vec_id", "score"))).alias("found"))
    # An id is left out of its own answers; another row that holds it, with another vector, is a candidate.
    own = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    out = asked.join(points.select("query", "embedding"), "embedding").join(found, "query")
    kept = F.filter("found", lambda x: (x["vec_id"] != F.col("query_id")) | (x["score"] != F.col("own")))
    out = out.withColumn("own", own).select("query_id", F.posexplode(F.slice(kept, 1, k)).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                      F.col("hit.score").alias("score"))


def nearest(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            factor: float = 1.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``search`` in a new index of ``vectors``."""
    index = build_index(vectors, id_col=id_col, vector_col=vector_col, max_k=k, shard_rows=shard_rows)
    return search(index, queries, id_col=id_col, vector_col=vector_col, k=k, factor=factor)
