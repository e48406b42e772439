"""Bindings: the driver's test tables shaped as the recommender's inputs.

Every binding is a Spark plan over whole tables of ``sf_dir``; the SQL oracle
derives the same tables (``affinity.plans.oracle``). Shapes:

* ``ratings(user_id, item_id, rating)``  one row per (customer, part), 1..5
* ``edges(item1, item2, click)``         directed part-to-part clicks within orders
* ``catalogs(item, catalog)``            NULL for about 6% of parts
* ``brothers(catalog, brothers)``        catalogs of the same part type
* ``item_ratings(itemid, rating)``       NULL for about 6% of parts
* ``targets(item)``                      items to recommend for: every 20th id
* ``items(itemid, parent_id, attr1..)``  wide attribute table
* document forms of the same for the long-text ranking
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.content import rare_term_candidates
from affinity.operators.skew import checked_broadcast, salted_pairs, task_count
from affinity.session import materialize

# Fixed values of the binding: part types in catalog order, and the values that
# are NULL (every row stays).
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
LARGEST_CATALOGUED = 47  # parts of a larger p_size have no catalog
NO_RATING_MOD = 17       # item_id % 17 = 0 has no item rating
TARGET_MOD = 20          # a search asks for the ids that it divides, against all rows
TARGET_USER = 7
LOOKUP_ITEM = 7
BLOCK = 4096             # parts of an order that one task pairs with as many


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating): customer x part, rating from the largest quantity."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("item_id"), "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy("user_id", "item_id")
            .agg((F.lit(1) + F.floor((F.max("l_quantity") - F.lit(1)) / F.lit(10)))
                 .cast("int").alias("rating")))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id): a cell per customer and per part, some of unrated customers, some of items that are none."""
    c = table(spark, sf_dir, "customer")
    p = table(spark, sf_dir, "part")
    key = F.col("c_custkey").cast("bigint")
    return (c.select(key.alias("user_id"), key.alias("item_id"))
            .unionAll(c.select(key, -F.col("c_nationkey").cast("bigint")))
            .unionAll(p.select(F.col("p_size").cast("bigint"), F.col("p_partkey").cast("bigint"))))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item1, item2, click): item1 precedes item2 in an order; click = item2's quantity."""
    li = table(spark, sf_dir, "lineitem")
    lines = (li.groupBy(F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("p"))
             .agg(F.min("l_linenumber").alias("ln"), F.sum("l_quantity").alias("q")))
    # An order has at most as many parts as lines; only orders of several blocks are looked up by their lines.
    sizes = li.groupBy(F.col("l_orderkey").alias("o")).agg(F.count(F.lit(1)).alias("n"))
    several, most = sizes.agg(F.count_if(F.col("n") > BLOCK), F.sum(F.col("n").cast("double") ** 2)).first()
    n = F.lit(1).cast("bigint")
    if several:
        lines = lines.join(checked_broadcast(sizes.where(F.col("n") > BLOCK)), "o", "left")
        n = F.coalesce("n", n)
    # Both sides of the self-join read the order lines:
    # written once with their order size (1: no more than a block).
    sized = materialize(lines.select("o", "p", "ln", "q", n.alias("n")), "order_lines")
    # Few pairs of parts meet in two orders, so they are dealt before they are summed, not held by every task.
    tasks = task_count(spark, most)
    pairs = salted_pairs(sized, "o", "p", ["ln", "q"], "n", BLOCK, parts=tasks)
    return (pairs.where(F.col("ln_1") < F.col("ln_2")).select("p_1", "p_2", "q_2").repartition(tasks, "p_1", "p_2")
            .groupBy(F.col("p_1").alias("item1"), F.col("p_2").alias("item2"))
            .agg(F.sum("q_2").cast("bigint").alias("click")))


def catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, catalog): catalog = 10 * brand number + type position."""
    p = table(spark, sf_dir, "part")
    types = F.array(*[F.lit(t) for t in PART_TYPES])
    cat = (F.lit(10) * F.substring("p_brand", 7, 100).cast("int")
           + F.array_position(types, F.col("p_type")).cast("int"))
    return p.select(F.col("p_partkey").alias("item"),
                    F.when(F.col("p_size") <= LARGEST_CATALOGUED, cat).cast("int").alias("catalog"))


def brothers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(catalog, brothers ARRAY<INT>): all catalogs with the same type position.

    The catalog taxonomy is a dimension (its size does not grow with the
    click or rating volume), and the source format is one array per catalog,
    so the family list is collected per family.
    """
    c = catalogs(spark, sf_dir).select("catalog").where(F.col("catalog").isNotNull()).distinct()
    fam = F.pmod("catalog", F.lit(10))
    members = c.groupBy(fam.alias("fam")).agg(F.collect_set("catalog").alias("brothers"))
    return c.withColumn("fam", fam).join(members, "fam").select(
        "catalog", F.sort_array("brothers").alias("brothers"))


def item_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(itemid, rating DOUBLE): mean rating of the item, NULL for some."""
    means = ratings(spark, sf_dir).groupBy(F.col("item_id").alias("itemid")).agg(F.avg("rating").alias("rating"))
    return means.select("itemid", F.when(F.pmod("itemid", F.lit(NO_RATING_MOD)) != 0, F.round("rating", 6)).alias("rating"))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item): target items."""
    p = table(spark, sf_dir, "part")
    return p.where(F.pmod("p_partkey", F.lit(TARGET_MOD)) == 0).select(F.col("p_partkey").alias("item"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide item table: itemid STRING, parent_id BIGINT (NULL for some), attr1..attr5."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.cast("string").alias("itemid"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.lit(None)).otherwise(F.floor(k / 5))
        .cast("bigint").alias("parent_id"),
        F.col("p_name").alias("attr1"),
        F.col("p_brand").alias("attr2"),
        F.col("p_type").alias("attr3"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("attr4"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(None)).otherwise(
            F.concat(F.lit(" Price "), F.floor("p_retailprice").cast("int").cast("string")))
        .alias("attr5"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as wide items: itemid, parent_id = source number, attr1..3 = source, lang, text."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("itemid"),
        F.regexp_extract("source", r"(\d+)$", 1).try_cast("bigint").alias("parent_id"),
        F.col("source").alias("attr1"), F.col("lang").alias("attr2"), F.col("text").alias("attr3"))


def document_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item): target documents."""
    d = table(spark, sf_dir, "documents")
    return d.where(F.pmod("doc_id", F.lit(TARGET_MOD)) == 0).select(F.col("doc_id").alias("item"))


def document_candidates(spark: SparkSession, sf_dir: str, docs: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(target, item, rating, catalog, click, level): the documents that share a rare term with a target.

    ``docs`` are the documents as items (``content.item_documents``), ``words``
    their words if they are written already. Defaults of a candidate without
    graph data: level 1, click 0, rating 0.0.
    """
    found = rare_term_candidates(docs, document_targets(spark, sf_dir), words=words)
    return found.select("target", "item", F.lit(0.0).alias("rating"), F.lit(0).alias("catalog"),
                        F.lit(0).cast("bigint").alias("click"), F.lit(1).alias("level"))
