"""Skew-safe building blocks shared by the operators.

Any key may hold a large share of all rows (one user who rated most items, one
item clicked from everywhere). These helpers keep the work of such a key spread
over many tasks instead of one:

* ``salted_pairs`` - all ordered member pairs within each group, with big
  groups cut into hash blocks so one task sees at most about ``block**2``
  pairs of one group;
* ``chunked_lists`` - per-key lists whose big keys are split into chunks of
  about ``chunk_size`` entries;
* ``order_statistics`` - exact order statistics without a sort of the values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.session import materialize

# Lehmer (MINSTD) multiplier and modulus used to spread ids over
# chunks with integer arithmetic that any SQL engine reproduces.
_MINSTD_MULT = 48271
_MINSTD_MOD = 2147483647


#: Rows that one task aggregates or joins at most, on average: beyond, there are more tasks, not larger ones.
TASK_ROWS = 2_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def block_count(size, block: int) -> Column:
    """Number of blocks for a group of ``size`` members (at least 1)."""
    return F.greatest(F.lit(1), F.ceil(_c(size) / F.lit(block))).cast("int")


def task_count(spark: SparkSession, rows: int | None, task_rows: int = TASK_ROWS) -> int:
    """The session's shuffle partitions, or more if ``rows`` rows would give each of them over ``task_rows``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(rows or 0) // task_rows))


def pair_tasks(rows: DataFrame, group_size: str) -> int:
    """Tasks for the pairs of ``rows`` with all members of their groups (one pass over ``rows``)."""
    return task_count(rows.sparkSession, rows.agg(F.sum(F.col(group_size).cast("double"))).first()[0])


def distinct_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct rows, dealt by ``keys`` over tasks whose number grows with the rows; ``rows`` are read twice.

    No task groups what it happened to read before the shuffle: where few rows
    repeat, that would hold nearly all of them in memory.
    """
    return rows.repartition(task_count(rows.sparkSession, rows.count()), *keys).distinct()


def salted_pairs(rows: DataFrame, group: str, member: str, payload: Sequence[str],
                 group_size: str, block: int = 4096,
                 right: DataFrame | None = None, unordered: bool = False,
                 parts: int | None = None) -> DataFrame:
    """Ordered pairs of distinct members sharing a group.

    ``rows`` (left side) and ``right`` (default: ``rows``) have one row per
    (group, member) and a column ``group_size`` holding the group's full size
    (equal on both sides). Each side carries ``member`` and ``payload`` with
    suffix ``_1`` / ``_2``. With ``unordered`` each unordered pair comes once
    (member_1 < member_2).

    Every group is cut into ceil(n / block) hash blocks (one for most groups)
    before anything is shuffled, and (group, block, other block) is the join
    key: a big group's n**2 pairs are spread over ceil(n / block)**2 keys, and a
    side's rows are dealt by that key, never by the group alone. Each side is
    read once.

    The join makes many more rows than it reads, which AQE does not foresee when
    it sizes partitions by input bytes; so both sides are dealt over ``parts``
    partitions, by default as many as the number of pairs asks for
    (``pair_tasks``). The join needs that layout anyway.
    """
    right = rows if right is None else right
    parts = parts or pair_tasks(rows, group_size)
    nb = block_count(group_size, block)
    own = F.pmod(F.xxhash64(F.col(member)), nb).cast("int")
    every = F.explode(F.sequence(F.lit(0), nb - 1))

    def side(df: DataFrame, suffix: str, mine: str, other: str) -> DataFrame:
        cols = [F.col(c).alias(c + suffix) for c in [member, *payload]]
        return (df.select(F.col(group), *cols, own.alias(mine), every.alias(other))
                .repartition(parts, group, "_b1", "_b2"))

    m1, m2 = F.col(f"{member}_1"), F.col(f"{member}_2")
    return (side(rows, "_1", "_b1", "_b2").join(side(right, "_2", "_b2", "_b1"), [group, "_b1", "_b2"])
            .where(m1 < m2 if unordered else m1 != m2).drop("_b1", "_b2"))


def checked_broadcast(df: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """Broadcast hint for ``df`` only after counting it: at most ``max_rows``
    rows are broadcast; a bigger side is returned as is and joins by shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def spread(x, n) -> Column:
    """Deterministic integer spread of a non-negative id over ``n`` slots.

    ``((x mod M) * A mod M) mod n`` with the MINSTD constants; plain integer
    arithmetic, so the SQL oracle computes the same slot.
    """
    return F.pmod(F.pmod(F.pmod(_c(x), F.lit(_MINSTD_MOD)) * F.lit(_MINSTD_MULT),
                         F.lit(_MINSTD_MOD)), _c(n))


def chunked_lists(rows: DataFrame, key: str, order_id: str, entry: Column,
                  chunk_size: int = 4096, out: str = "entries") -> DataFrame:
    """Collect ``entry`` per key into sorted lists of about ``chunk_size``.

    Returns (key, chunk, n, out) where n is the key's total entry count. A key
    with d entries gets ceil(d / chunk_size) chunks, chosen by ``spread`` of
    ``order_id``; so no single list (or task) holds a hot key whole. The degree
    is a partial aggregate joined back on the key.
    """
    # Degrees and lists both read the rows, which may be a whole ranking or graph: written once.
    rows = materialize(rows.select(F.col(key), F.col(order_id).alias("_id"), entry.alias("_entry")), "list_entries")
    degree = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    tagged = rows.join(degree, key).withColumn("_chunk", spread("_id", block_count("_n", chunk_size)))
    return (tagged.groupBy(key, "_chunk", "_n")
            .agg(F.sort_array(F.collect_list("_entry")).alias(out))
            .select(F.col(key), F.col("_chunk").alias("chunk"),
                    F.col("_n").alias("n"), F.col(out)))


def order_statistics(values: DataFrame, wanted: dict[str, tuple[str, float]], accuracy: int = 100_000) -> DataFrame:
    """Exact order statistics of several value lists at once: one row, a column per name.

    ``values`` has rows (kind, value DOUBLE, NULL ignored); ``wanted`` maps a name
    to (kind, share), share 0.5 or 0.75: sorted(value)[n / 2] or [n / 2 + n / 4]
    with whole divisions, 0-based.

    Sketches of fixed size give bounds around each wanted place first (their
    rank error is at most n / ``accuracy``); one histogram then counts exactly:
    the values below the bounds as a single entry, those inside by value. So no
    list is sorted, and what one task orders is a ten-thousandth of the values.
    NULL for an empty list.
    """
    margin = 10 / accuracy
    v = values.where(F.col("value").isNotNull())
    n = F.count(F.lit(1))
    places = {0.5: F.floor(n / 2), 0.75: F.floor(n / 2) + F.floor(n / 4)}
    entries = []
    for name, (kind, share) in wanted.items():
        ends = [F.percentile_approx("value", max(0.0, min(1.0, share + side * margin)), F.lit(accuracy))
                for side in (-1, 1)]
        few = n < accuracy  # a share of few values may be off by whole places
        entries.append(F.struct(F.lit(name).alias("name"), F.lit(kind).alias("of"), places[share].alias("place"),
                                F.when(few, F.min("value")).otherwise(ends[0]).alias("low"),
                                F.when(few, F.max("value")).otherwise(ends[1]).alias("high")))
    bounds = v.groupBy("kind").agg(F.array(*entries).alias("e")).select("kind", F.explode("e").alias("e"))
    bounds = bounds.where(F.col("e.of") == F.col("kind")).select("kind", "e.name", "e.place", "e.low", "e.high")
    # A row per name: a broadcast of proven size.
    inside = F.when(F.col("value") >= F.col("low"), F.col("value"))
    counted = (v.join(F.broadcast(bounds), "kind").where(F.col("value") <= F.col("high"))
               .groupBy("name", "place", inside.alias("value")).agg(F.count(F.lit(1)).alias("_k")))
    upto = Window.partitionBy("name").orderBy(F.asc_nulls_first("value")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = counted.withColumn("_upto", F.sum("_k").over(upto)).where(F.col("_upto") > F.col("place"))
    return found.agg(*[F.min(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in wanted])


def rank_within(df: DataFrame, group: str, order: Sequence[Column],
                partitions: int | None = None, out: str = "rank") -> DataFrame:
    """Dense row numbers per group (1, 2, ...) in ``order``, without one task per group.

    A window partitioned by the group would sort a hot group in one task.
    Here rows are range-partitioned on (group, order) - Spark samples the
    bounds - so a big group spans many ordered partitions; each row gets its
    row number inside its (group, partition) slice plus the row count of the
    group's earlier partitions (a window over at most ``partitions`` rows per
    group). The slice assignment is written once to the shared folder.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The slice id is written with the rows: both reads below (row numbers and
    # slice counts) then see the same assignment, whether or not the range
    # shuffle is reused or re-sampled.
    keyed = materialize(df.repartitionByRange(n, F.col(group), *order)
                        .withColumn("_pid", F.spark_partition_id()), "ranked_slices")
    local = Window.partitionBy(group, "_pid").orderBy(*order)
    counts = keyed.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_k"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_pid", F.coalesce(F.sum("_k").over(before), F.lit(0))
                            .alias("_off"))
    return (keyed.withColumn("_local", F.row_number().over(local))
            .join(offsets, [group, "_pid"])
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_pid", "_local", "_off"))
