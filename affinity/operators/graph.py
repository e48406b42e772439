"""Click-graph operators: merge, adjacency, candidate search.

Edges are ``(item1, item2, click)``: a click from item1 to item2. The
*reverse* graph maps an item to its sources; candidate search walks it.

Candidate rule (the source snapshot lacks the worker that implements it; this
rule is ours): level 1 = direct sources of the target; level k+1 = sources of
level-k items; a source is kept only if its catalog is related to the target's
catalog; only kept items are expanded; the target itself is excluded; one row
per (target, item): lowest level, then highest click, then highest rating,
then lowest catalog. All targets are searched in one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.skew import block_count, checked_broadcast, chunked_lists, task_count
from affinity.operators.stats import reverse_adjacency_rows, source_records
from affinity.session import bucketed, materialize

# Fixed value: depth of the candidate search.
MAX_LEVEL = 2


def item_attributes(catalogs: DataFrame, item_ratings: DataFrame) -> DataFrame:
    """(item, catalog, rating): both per-item lookups in one table."""
    c = catalogs.select("item", "catalog")
    r = item_ratings.select(F.col("itemid").alias("item"), "rating")
    return c.join(r, "item", "full_outer")


def merge_edges(edges: DataFrame, catalogs: DataFrame, item_ratings: DataFrame, both: bool = True) -> DataFrame:
    """(item1, catalog1, rating1, item2, catalog2, rating2, click), NULL where missing.

    Without ``both`` the columns of item2 are left out, which the reverse graph
    does not read (``stats.source_records``): one join less.

    The two lookups are combined into one item table first, so the edge table
    goes through two left joins instead of four (each a broadcast when the
    item table is small, by the planner's size check).
    """
    # Read twice (both ends): written once; its real size then lets the
    # planner broadcast it when small.
    attrs = materialize(item_attributes(catalogs, item_ratings), "item_attributes")
    a1 = attrs.select(F.col("item").alias("item1"), F.col("catalog").alias("catalog1"),
                      F.col("rating").alias("rating1"))
    if not both:
        return edges.join(a1, "item1", "left").select("item1", "catalog1", "rating1", "item2", "click")
    a2 = attrs.select(F.col("item").alias("item2"), F.col("catalog").alias("catalog2"),
                      F.col("rating").alias("rating2"))
    return (edges.join(a1, "item1", "left").join(a2, "item2", "left")
            .select("item1", "catalog1", "rating1", "item2", "catalog2", "rating2", "click"))


def adjacency_out(merged: DataFrame, chunk_size: int = 4096) -> DataFrame:
    """(item1, chunk, n, neighbours ARRAY<item2>): forward lists, big lists chunked."""
    pairs = merged.select("item1", "item2").distinct()
    return chunked_lists(pairs, "item1", "item2", F.col("item2"), chunk_size, out="neighbours")


def adjacency_in(merged: DataFrame, chunk_size: int = 4096) -> DataFrame:
    """(item2, chunk, n, sources ARRAY<STRUCT<id, rating, catalog, click>>): reverse lists."""
    rows = reverse_adjacency_rows(merged)
    entry = F.struct("id", "rating", "catalog", "click")
    return chunked_lists(rows, "item2", "id", entry, chunk_size, out="sources")


def target_catalogs(targets: DataFrame, catalogs: DataFrame) -> DataFrame:
    """(item, catalog) of targets that have a catalog."""
    known = catalogs.select("item", "catalog").where(F.col("catalog").isNotNull())
    return targets.select("item").join(known, "item")


def related_catalogs(tcat: DataFrame, brothers: DataFrame) -> DataFrame:
    """(target, catalog): catalogs related to each target's catalog."""
    b = brothers.select(F.col("catalog").alias("tcatalog"),
                        F.explode("brothers").alias("catalog"))
    return (tcat.select(F.col("item").alias("target"), F.col("catalog").alias("tcatalog"))
            .join(b, "tcatalog").select("target", "catalog").distinct())


@dataclass
class Adjacency:
    """The reverse graph laid out for the search: lists in blocks, a block's rows in one file."""
    rows: DataFrame   # (item2, part, id, rating, catalog, click), bucketed by (item2, part)
    parts: DataFrame  # (item2, parts): blocks of each list


def lay_out(rev: DataFrame, block: int = 4096, buckets: int | None = None) -> Adjacency:
    """Rows (item2, id, rating, catalog, click), repeats once, as an ``Adjacency``.

    A list of n sources is cut by the source's hash into ceil(n / ``block``)
    parts, and (item2, part) is the key of the layout: an item clicked from
    everywhere is spread over many keys. The table is shuffled once, here; the
    joins of every level read it in place.
    """
    spark = rev.sparkSession
    rev = rev.select("item2", "id", "rating", "catalog", "click")
    parts = rev.groupBy("item2").agg(block_count(F.count(F.lit(1)), block).alias("parts"))
    parts = materialize(parts, "adjacency_parts")
    # Only the long lists are looked up by every row, at most one in ``block`` rows has one.
    long = checked_broadcast(parts.where("parts > 1").select("item2", F.col("parts").alias("_n")))
    buckets = buckets or task_count(spark, rev.count())
    part = F.pmod(F.xxhash64("id"), F.coalesce("_n", F.lit(1))).cast("int")
    rows = rev.join(long, "item2", "left").withColumn("part", part).drop("_n")
    return Adjacency(bucketed(rows, "reverse_adjacency", ["item2", "part"], buckets), parts)


def _sources(frontier: DataFrame, adjacency: Adjacency, allowed: DataFrame, level: int) -> DataFrame:
    """Kept sources of the frontier items: (target, item, rating, catalog, click, level)."""
    asked = (frontier.select("target", F.col("item").alias("item2")).join(adjacency.parts, "item2")
             .select("target", "item2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    step = (adjacency.rows.join(asked, ["item2", "part"])
            .select("target", F.col("id").alias("item"), "rating", "catalog", "click"))
    return (step.join(allowed, ["target", "catalog"], "left_semi")
            .where(F.col("item") != F.col("target"))
            .withColumn("level", F.lit(level)))


def reverse_rows(adjacency: DataFrame) -> DataFrame:
    """(item2, id, rating, catalog, click) of a persisted reverse adjacency, a row an edge whatever the lists' sizes."""
    return adjacency.select("item2", F.explode("sources").alias("s")).select("item2", "s.*")


def walkable(merged: DataFrame, tcat: DataFrame, brothers: DataFrame) -> DataFrame:
    """The merged edges (with ``catalog2``) that some target's search can walk; an edge's columns stay as they are.

    An edge into an item other than the target is walked only if that item was
    kept, so both ends are of catalogs related to one target's catalog. Target
    catalogs of equal relations are one group, and a catalog has the groups
    that it is in: as many as there are overlapping relations, one in a taxonomy.
    """
    own = tcat.select(F.col("catalog").alias("tcatalog")).distinct()
    related = brothers.select(F.col("catalog").alias("tcatalog"), F.explode("brothers").alias("catalog")).join(own, "tcatalog")
    sets = related.groupBy("tcatalog").agg(F.sort_array(F.collect_set("catalog")).alias("related"))
    groups = sets.groupBy("related").agg(F.min("tcatalog").alias("g")).select("g", F.explode("related").alias("catalog"))
    # Read for both ends: written once, and its real size is known.
    groups = materialize(groups.groupBy("catalog").agg(F.collect_set("g").alias("groups")), "catalog_groups")
    ends = [groups.select(F.col("catalog").alias(f"_c{k}"), F.col("groups").alias(f"_g{k}")) for k in (1, 2)]
    targets = tcat.select(F.col("item").alias("item2"), F.lit(True).alias("_target")).distinct()
    # A missing catalog is 0 in the records that the search compares.
    rows = merged.withColumn("_c1", F.coalesce("catalog1", F.lit(0))).withColumn("_c2", F.coalesce("catalog2", F.lit(0)))
    rows = rows.join(checked_broadcast(ends[0]), "_c1").join(checked_broadcast(ends[1]), "_c2", "left")
    rows = rows.join(checked_broadcast(targets), "item2", "left")
    return rows.where(F.coalesce("_target", F.arrays_overlap("_g1", "_g2"), F.lit(False))).select(*merged.columns)


def candidates(merged: DataFrame, tcat: DataFrame, brothers: DataFrame,
               max_level: int = MAX_LEVEL, rev: DataFrame | None = None) -> DataFrame:
    """(target, item, rating, catalog, click, level) for every target at once.

    ``rev`` is the reverse adjacency as rows, if it is persisted already
    (``reverse_rows``). It is laid out once (``lay_out``), so no level shuffles
    it again. Every level is reduced to one record per (target, item) and
    written before the next begins, so the plan grows by one read of the
    adjacency a level. Of merged edges with both ends' catalogs only those that
    a search can walk are laid out (``walkable``).
    """
    if rev is None:
        if max_level > 1 and "catalog2" in merged.columns:
            merged = walkable(merged, tcat, brothers)
        rev = source_records(merged)
        if max_level == 1:
            # One level reads the lists of the targets only.
            rev = rev.join(tcat.select(F.col("item").alias("item2")).distinct(), "item2", "left_semi")
        rev = materialize(rev, "source_records")
    adjacency = lay_out(rev)
    allowed = related_catalogs(tcat, brothers)
    frontier = tcat.select(F.col("item").alias("target"), F.col("item"))
    # Best record per (target, item) as an aggregate (partial, skew-safe):
    # highest click, highest rating, lowest catalog; levels come in order.
    best = F.min(F.struct((-F.col("click")).alias("nclick"), (-F.col("rating")).alias("nrating"),
                          F.col("catalog")))
    found = None
    for level in range(1, max_level + 1):
        step = _sources(frontier, adjacency, allowed, level).groupBy("target", "item", "level").agg(best.alias("b"))
        step = step.select("target", "item", (-F.col("b.nrating")).alias("rating"),
                           F.col("b.catalog").alias("catalog"), (-F.col("b.nclick")).alias("click"), "level")
        if found is not None:
            step = step.join(found.select("target", "item"), ["target", "item"], "left_anti")
        if level < max_level:
            step = materialize(step, f"candidates_{level}")
            frontier = step.select("target", "item")
        found = step if found is None else found.unionByName(step)
    return found


def candidates_level1(merged: DataFrame, tcat: DataFrame, brothers: DataFrame) -> DataFrame:
    """(target, item, rating, catalog, click): direct kept sources of each target."""
    return candidates(merged, tcat, brothers, 1).drop("level")
