"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

Each source has a weight schedule over the training run, linear from its first
to its last weight.  Its integral, scaled to the source's target, is the
source's cumulative word demand.  Documents of a source stand in a fixed random
order; the words before a document, inverted through the demand, give its
training position between 0 and 1, and the mix is the documents range-sorted
by position.  Words before a document are two-level sums: over blocks of the
source, then within the block, so no task holds a whole source.  Rows of one id
share a place in that order; where they overfill a block, those of equal size,
which may stand in for each other, are dealt over slices of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import WORD, written
from affinity.operators.skew import checked_broadcast

#: Weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: First and last weight of the schedules, as multiples of the source's weight, repeating alike.
SCHEDULES = ((1.5, 0.5), (0.75, 1.25), (0.25, 1.75))


def text_size(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights=WEIGHTS, schedules=SCHEDULES, percent: int = 150,
            repeats: int = 2) -> DataFrame:
    """Per source of (source, size): source_size, n, target, first and last weight.

    Targets share ``percent`` of 100 of all words by weight; none exceeds
    ``repeats`` times its source's words, and what is above goes to the others
    by weight.  With sources in order of limit / weight, those up to the first
    place where the rest shares without excess stand at their limit.  One task
    orders the sources, a row each.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    # One row per source: these windows order sources, not documents.
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (rank % len(values) + 1).cast("int"))
    each = each.select("*", pick([float(w) for w in weights]).alias("weight"),
                       pick([float(a) for a, _ in schedules]).alias("first"),
                       pick([float(b) for _, b in schedules]).alias("last"),
                       rank.alias("rank"))
    each = each.withColumn("limit", (F.col("source_size") * repeats).cast("double"))
    ordered = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    each = each.withColumn("level", (F.sum("source_size").over(whole) * percent / 100
                                     - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                           / F.sum("weight").over(onward))
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    each = each.withColumn("level", F.first(F.when(fits, F.col("level")), ignorenulls=True).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    # No level: all stand at their limit.
    target = F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return each.select("source", "source_size", "n", target.alias("target"), "first", "last")


def _joined(rows: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which nulls are equal; the other side's keys go."""
    other = other.select(*[F.col(k).alias(f"other_{k}") if k in keys else k for k in other.columns])
    on = [F.col(k).eqNullSafe(F.col(f"other_{k}")) for k in keys]
    return rows.join(other, on, how).drop(*[f"other_{k}" for k in keys])


def _sliced(rows: DataFrame, block_rows: int) -> tuple[DataFrame, list[str]]:
    """``rows`` with the columns, in their order, of the slices that a source is summed by.

    A slice is a block, except that a block of over twice ``block_rows`` rows,
    which only repeated (or null) ids make, is cut by its place, id and size; and a
    group of these, whose rows differ in nothing that counts, into slices of about
    ``block_rows`` rows each.
    """
    n = F.count(F.lit(1))
    full = written(rows.groupBy("source", "block").agg(n.alias("n")).where(F.col("n") > 2 * block_rows)
                   .drop("n"), "mix-full-blocks")
    if full.isEmpty():
        return rows, ["block"]
    group = ["source", "block", "at", "doc_id", "size"]
    groups = _joined(rows, checked_broadcast(full), ["source", "block"]).groupBy(*group).agg(
        F.ceil(n / block_rows).alias("parts"))
    rows = _joined(rows, checked_broadcast(written(groups, "mix-groups")), group, "left")
    cut = F.col("parts").isNotNull()
    deal = F.expr("shiftrightunsigned(xxhash64(deal), 11) / 9007199254740992D")
    rows = rows.select("*", F.when(cut, F.col("at")).alias("cut_at"), F.when(cut, F.col("doc_id")).alias("cut_id"),
                       F.when(cut, F.col("size")).alias("cut_size"),
                       F.floor(deal * F.col("parts")).alias("part")).drop("parts")
    return rows, ["block", "cut_at", "cut_id", "cut_size", "part"]


def plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=WEIGHTS, schedules=SCHEDULES, percent: int = 150, repeats: int = 2, block_rows: int = 4096,
         keep=()) -> DataFrame:
    """Per document: size, source_size, target, positions (of each time the mix takes it, from 0 to 1), taken.

    A pass takes a document if its middle lies before the source's target, so a
    source's words miss the target by half a document at most, and no document
    is taken more than ``repeats`` times.  The order within a source hangs on a
    hash of the id (ties: id, size), so reruns agree.  Sizes are words, 0 for
    null and empty texts, which are never taken words but may have positions.
    Texts of any length count whole.  A null source is a source.  Repeated rows
    count each.  ``keep`` names further columns to return, which are written
    beside the sizes.  An empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_size(F.col(text_col)).alias("size"),
                       F.col(source_col).alias("source"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    spread = F.expr("shiftrightunsigned(xxhash64(doc_id), 11) / 9007199254740992D")
    rows = written(rows.withColumns({"at": spread, "deal": F.monotonically_increasing_id()}), "mix-sizes")
    goals = targets(rows.select("source", "size"), weights=weights, schedules=schedules, percent=percent,
                    repeats=repeats)
    blocks = F.ceil(F.col("n") / block_rows)
    rows = rows.join(goals.withColumnRenamed("source", "goal"), F.col("source").eqNullSafe(F.col("goal"))).drop("goal")
    rows = rows.withColumn("block", F.floor(F.col("at") * blocks).cast("long"))
    rows, slices = _sliced(rows, block_rows)
    sums = rows.groupBy("source", *slices).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    rows = _joined(rows, sums, ["source", *slices])
    inner = Window.partitionBy("source", *slices).orderBy("at", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("middle", F.col("base") + F.coalesce(F.sum("size").over(inner), F.lit(0))
                           + F.col("size") / 2)
    # Cumulative demand: target * (first * t + (last - first) * t^2 / 2) / mean, inverted for t.
    mean, slope = (F.col("first") + F.col("last")) / 2, F.col("last") - F.col("first")

    def position(words: Column) -> Column:
        share = words / F.col("target") * mean
        return F.when(slope == 0, share / F.col("first")).otherwise(
            (F.sqrt(F.greatest(F.col("first") * F.col("first") + 2 * slope * share, F.lit(0.0))) - F.col("first"))
            / slope)

    passes = [F.when(F.col("middle") + F.col("source_size") * k < F.col("target"),
                     position(F.col("middle") + F.col("source_size") * k)) for k in range(repeats)]
    rows = rows.withColumn("positions", F.array_compact(F.array(*passes)))
    return rows.select("doc_id", "size", "source_size", "target", "positions",
                       (F.col("size") * F.size("positions")).alias("taken"), *[f"keep_{c}" for c in keep])


def range_sort(rows: DataFrame, position: str, *ties: str) -> DataFrame:
    """Rows in training order: range-partitioned by position, sorted within."""
    order = [F.col(position).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **options) -> DataFrame:
    """The documents as often as the mix takes them, all columns, in training order.

    Rows are planned by number, without their texts, which are then shuffled
    for the join and for the sort only.  ``docs`` is read twice and must give
    its rows in the same partitions each time, as a table does.
    """
    number = F.monotonically_increasing_id()
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(source_col).alias("source"), number.alias("row"))
    planned = written(plan(slim, keep=["row"], **options).where(F.size("positions") > 0).select(
        F.col("keep_row").alias("row"), "positions"), "mix-plan")
    whole = docs.select(number.alias("row"), F.struct(*docs.columns).alias("document"))
    rows = whole.join(planned, "row").select(F.explode("positions").alias("position"), "document", "row")
    return range_sort(rows, "position", "row").select("document.*")
