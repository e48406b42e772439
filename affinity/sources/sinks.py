"""Sinks: Parquet intermediates, JSON result documents, persisted lookups, and
writers of the reference's input formats (used to round-trip the readers).

Every writer takes a path; on a cluster pick it under the shared folder
(``affinity.session.scratch_path``), never a machine-local one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Intermediate table (merged edges, residuals, similarities, ...)."""
    df.write.mode(mode).parquet(path)
    return path


def write_if_absent(df: DataFrame, path: str) -> str:
    """Persisted lookup table written only when the path is still empty."""
    df.write.mode("ignore").parquet(path)
    return path


def save_table_if_absent(df: DataFrame, name: str) -> bool:
    """Managed table created and loaded only when it does not exist yet.

    Returns True when the table was written by this call.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        return False
    df.write.mode("ignore").saveAsTable(name)
    return True


def write_report(report: DataFrame, path: str) -> str:
    """One-row report as a single JSON document."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_documents(docs: DataFrame, path: str) -> str:
    """One JSON line per target: {"item": "...", "recoms": {"id": score}}."""
    docs.write.mode("overwrite").json(path)
    return path


# -- input formats of the reference, produced from DataFrames -----------------

def write_ratings_tsv(ratings: DataFrame, path: str, header: bool = False) -> str:
    stamp = F.col("timestamp") if "timestamp" in ratings.columns else F.lit(None).cast("bigint")
    out = ratings.select("user_id", "item_id", "rating", stamp.alias("timestamp"))
    out.write.mode("overwrite").option("sep", "\t").option("header", str(header).lower()).csv(path)
    return path


def write_train_json(edges: DataFrame, path: str, chunk_size: int = 4096) -> str:
    """edges -> {"item": "i", "true_recoms": {"j": click}} lines.

    A source item with very many edges is written as several lines of about
    ``chunk_size`` entries (the reader takes the union of an item's lines), so
    no single map holds a hot item whole.
    """
    from affinity.operators.skew import chunked_lists

    entry = F.struct(F.col("item2").cast("string").alias("k"), F.col("click").cast("bigint").alias("v"))
    lists = chunked_lists(edges, "item1", "item2", entry, chunk_size, out="entries")
    nested = lists.select(F.col("item1").cast("string").alias("item"),
                          F.map_from_entries("entries").alias("true_recoms"))
    nested.write.mode("overwrite").json(path)
    return path


def write_catalogs_json(catalogs: DataFrame, path: str) -> str:
    catalogs.select(F.col("item").cast("string").alias("itemid"),
                    F.col("catalog").cast("string").alias("catalogid")
                    ).write.mode("overwrite").json(path)
    return path


def write_catalog_path_json(brothers: DataFrame, path: str) -> str:
    """(catalog, brothers) -> {"catalogid": "c", "catalogpath": [{"b": "name"}, ...]}."""
    path_col = F.transform("brothers", lambda b: F.create_map(
        b.cast("string"), F.concat(F.lit("catalog "), b.cast("string"))))
    brothers.select(F.col("catalog").cast("string").alias("catalogid"),
                    path_col.alias("catalogpath")).write.mode("overwrite").json(path)
    return path


def write_item_ratings_json(item_ratings: DataFrame, path: str) -> str:
    item_ratings.select("itemid", "rating").write.mode("overwrite").json(path)
    return path


def write_test_items_json(targets: DataFrame, path: str) -> str:
    targets.select(F.col("item").cast("string").alias("item"),
                   F.lit(0).alias("recoms")).write.mode("overwrite").json(path)
    return path
