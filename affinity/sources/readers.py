"""Readers for the recommenders' input formats.

Schemas are fixed (no inference pass over the data).  Numbers are read as text
and converted one by one with ``try_cast``, so a bad value never takes its
neighbours or its line along; what cannot be used is returned by the
``rejected_*`` readers instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The field names of the input formats.
TRAIN_SCHEMA = T.StructType([
    T.StructField("item", T.StringType()),
    T.StructField("true_recoms", T.MapType(T.StringType(), T.StringType())),
])

TEST_SCHEMA = T.StructType([
    T.StructField("item", T.StringType()),
    T.StructField("recoms", T.IntegerType()),
])

CATALOGS_SCHEMA = T.StructType([
    T.StructField("itemid", T.StringType()),
    T.StructField("catalogid", T.StringType()),
])

CATALOG_PATH_SCHEMA = T.StructType([
    T.StructField("catalogid", T.StringType()),
    T.StructField("catalogpath", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])

ITEM_RATINGS_SCHEMA = T.StructType([
    T.StructField("itemid", T.StringType()),
    T.StructField("rating", T.StringType()),
])


def _id(c) -> F.Column:
    return F.col(c).try_cast("bigint")


def _rating_lines(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """(line, user_id, item_id, rating, timestamp) of every line; NULL for what is missing or no number."""
    names = ("user_id", "item_id", "rating", "timestamp")
    lines = (spark.read.option("header", str(header).lower()).option("sep", "\n").option("quote", "")
             .schema("line string").csv(path))
    f = F.split("line", "\t")
    kinds = ("bigint", "bigint", "double", "bigint")
    return lines.where(F.col("line").isNotNull()).select(
        "line", *[F.get(f, F.lit(k)).try_cast(t).alias(n) for k, (n, t) in enumerate(zip(names, kinds, strict=True))])


def _usable() -> F.Column:
    return F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("rating").isNotNull()


def read_ratings_tsv(spark: SparkSession, path: str, header: bool = False,
                     dedupe: bool = True) -> DataFrame:
    """Tab-separated (user, item, rating[, timestamp]) -> ratings(user_id, item_id, rating DOUBLE).

    The timestamp may be missing and ratings may be fractions.  A line without
    a numeric user, item and rating is left to ``rejected_ratings``.  With
    ``dedupe`` one row per (user, item) is kept (the latest timestamp, then the
    highest rating).
    """
    df = _rating_lines(spark, path, header).where(_usable())
    if dedupe:
        best = F.max(F.struct(F.coalesce("timestamp", F.lit(-(2 ** 62))).alias("t"),
                              F.col("rating").alias("r")))
        df = df.groupBy("user_id", "item_id").agg(best.alias("_b")).select(
            "user_id", "item_id", F.col("_b.r").alias("rating"))
    return df.select("user_id", "item_id", "rating")


def rejected_ratings(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """(line): the lines that ``read_ratings_tsv`` cannot use."""
    return _rating_lines(spark, path, header).where(~_usable()).select("line")


def _json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(line, the schema's fields, corrupt): every line of a JSON file; ``corrupt`` where it is no JSON object."""
    full = T.StructType([*schema.fields, T.StructField("corrupt", T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    return (spark.read.text(path).where(F.btrim("value") != "")
            .select(F.col("value").alias("line"), parsed.alias("r")).select("line", "r.*"))


def _number(c, kind: str) -> F.Column:
    """Whether a field, if the line has it, is a number."""
    return F.col(c).isNull() | F.col(c).try_cast(kind).isNotNull()


def _rejects(lines: DataFrame, source: str, good: F.Column) -> DataFrame:
    """(source, line, reason) of the lines that are not ``good``."""
    reason = F.when(F.col("corrupt").isNotNull(), F.lit("no JSON object")).otherwise(F.lit("no usable value"))
    return lines.where(~F.coalesce(good, F.lit(False)) | F.col("corrupt").isNotNull()).select(
        F.lit(source).alias("source"), "line", reason.alias("reason"))


def _edge_entries(spark: SparkSession, path: str) -> DataFrame:
    raw = _json_lines(spark, path, TRAIN_SCHEMA).where(F.col("corrupt").isNull())
    return raw.where(F.col("item") != "").select("item", F.explode("true_recoms").alias("k", "v"))


def _usable_entry() -> F.Column:
    return _id("item").isNotNull() & _id("k").isNotNull() & _id("v").isNotNull()


def read_train_edges(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines {"item": id, "true_recoms": {id: clicks}} -> edges(item1, item2, click BIGINT).

    Rows with an empty item are dropped before the cast; each map entry becomes
    one edge.  Entries with a bad id or click are left to ``rejected_edges``.
    """
    return _edge_entries(spark, path).where(_usable_entry()).select(
        _id("item").alias("item1"), _id("k").alias("item2"), _id("v").alias("click"))


def rejected_edges(spark: SparkSession, path: str) -> DataFrame:
    """(item, k, v): map entries that ``read_train_edges`` cannot use."""
    return _edge_entries(spark, path).where(~_usable_entry())


def _usable_catalog() -> F.Column:
    return _id("itemid").isNotNull() & _number("catalogid", "int")


def read_catalogs(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines {"itemid": "1", "catalogid": "11"} -> (item BIGINT, catalog INT, NULL where the line has none)."""
    return _json_lines(spark, path, CATALOGS_SCHEMA).where(_usable_catalog() & F.col("corrupt").isNull()).select(
        _id("itemid").alias("item"), F.col("catalogid").try_cast("int").alias("catalog"))


def _path_keys() -> F.Column:
    return F.flatten(F.transform(F.coalesce("catalogpath", F.array()), lambda m: F.map_keys(m)))


def read_catalog_path(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines {"catalogid": "11", "catalogpath": [{"11": ..}, {"21": ..}]}
    -> (catalog INT, brothers ARRAY<INT>): the keys of every map, in order.

    A line with a key that is no number keeps the others and is among the rejects.
    """
    ints = F.filter(F.transform(_path_keys(), lambda k: k.try_cast("int")), lambda k: k.isNotNull())
    raw = _json_lines(spark, path, CATALOG_PATH_SCHEMA).where(F.col("corrupt").isNull())
    return raw.select(F.col("catalogid").try_cast("int").alias("catalog"), ints.alias("brothers")).where(
        F.col("catalog").isNotNull())


def _usable_rating() -> F.Column:
    return _id("itemid").isNotNull() & _number("rating", "double")


def read_item_ratings(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines {"itemid": 1 or "1", "rating": 4.5} -> (itemid BIGINT, rating DOUBLE, NULL where the line has none)."""
    return _json_lines(spark, path, ITEM_RATINGS_SCHEMA).where(_usable_rating() & F.col("corrupt").isNull()).select(
        _id("itemid").alias("itemid"), F.col("rating").try_cast("double").alias("rating"))


def read_test_items(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines {"item": "1", "recoms": n} -> (item BIGINT); ``recoms`` is not used."""
    raw = _json_lines(spark, path, TEST_SCHEMA).where(F.col("corrupt").isNull())
    return raw.select(_id("item").alias("item")).where(F.col("item").isNotNull())


def rejected(spark: SparkSession, source: str, path: str) -> DataFrame:
    """(source, line, reason): what the reader of ``source`` cannot use.

    ``source`` is train, catalogs, catalog_path, item_ratings, test_items or
    ratings.  Of click edges, single bad map entries come back as the entry;
    lines with an empty item are dropped by definition and are no rejects.
    """
    if source == "ratings":
        return rejected_ratings(spark, path).select(F.lit(source).alias("source"), "line",
                                                    F.lit("no usable value").alias("reason"))
    if source == "train":
        lines = _rejects(_json_lines(spark, path, TRAIN_SCHEMA), source, F.col("item").isNotNull())
        entries = rejected_edges(spark, path).select(
            F.lit(source).alias("source"), F.to_json(F.struct("item", "k", "v")).alias("line"),
            F.lit("no usable entry").alias("reason"))
        return lines.unionByName(entries)
    schema, good = {
        "catalogs": (CATALOGS_SCHEMA, _usable_catalog()),
        "catalog_path": (CATALOG_PATH_SCHEMA, F.col("catalogid").try_cast("int").isNotNull()
                         & F.forall(_path_keys(), lambda k: k.try_cast("int").isNotNull())),
        "item_ratings": (ITEM_RATINGS_SCHEMA, _usable_rating()),
        "test_items": (TEST_SCHEMA, _id("item").isNotNull()),
    }[source]
    return _rejects(_json_lines(spark, path, schema), source, good)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Parquet wide items (attr1..attrN, itemid, parent_id); schema from the footer."""
    return spark.read.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Any intermediate written by ``affinity.sources.sinks``."""
    return spark.read.parquet(path)
