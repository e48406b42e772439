"""End-to-end jobs over the source formats, one per program of the original
recommenders: input files in, result files out.

* ``rating_report_job``: TSV ratings -> the eight-field report as one JSON document
* ``graph_ingest_job``: JSON click edges, catalogs, item ratings -> merged edges (Parquet),
  the reverse adjacency and catalog relations as persisted lookups, parents with siblings
* ``recommend_job``: merged edges, lookups, items, test items -> one JSON document per
  target with the count ranking and one with the TF-IDF ranking

All targets are handled in one job; nothing is collected to the driver. Tables
that a job wrote for itself are removed when it ends (``session.scope``).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from affinity.operators import content, graph, report, stats
from affinity.session import materialize, scope
from affinity.sources import readers, sinks


@scope
def rating_report_job(spark: SparkSession, ratings_path: str, target: int, out_path: str,
                      header: bool = False) -> DataFrame:
    # Read by many steps: parsed once.
    ratings = materialize(readers.read_ratings_tsv(spark, ratings_path, header=header), "ratings")
    rep = report.cf_report(ratings, target)
    sinks.write_report(rep, out_path)
    return spark.read.json(out_path)


@scope
def graph_ingest_job(spark: SparkSession, train_path: str, catalogs_path: str,
                     item_ratings_path: str, catalog_path_path: str, items_path: str,
                     out_dir: str) -> dict[str, str]:
    """Every ingest writes a version folder of its own, so lookups never belong to other edges."""
    out = f"{out_dir.rstrip('/')}/{uuid.uuid4().hex}"
    edges = readers.read_train_edges(spark, train_path)
    catalogs = readers.read_catalogs(spark, catalogs_path)
    item_ratings = readers.read_item_ratings(spark, item_ratings_path)
    merged_path = sinks.write_parquet(graph.merge_edges(edges, catalogs, item_ratings),
                                      f"{out}/merged")
    merged = readers.read_parquet(spark, merged_path)
    brothers_path = sinks.write_parquet(readers.read_catalog_path(spark, catalog_path_path),
                                        f"{out}/catalog_brothers")
    adjacency_path = sinks.write_parquet(graph.adjacency_in(merged), f"{out}/adjacency_in")
    parents_path = sinks.write_parquet(
        stats.parents_with_siblings(readers.read_items(spark, items_path)), f"{out}/parents")
    # One table of whatever no reader could use.
    sources = {"train": train_path, "catalogs": catalogs_path, "catalog_path": catalog_path_path,
               "item_ratings": item_ratings_path}
    parts = [readers.rejected(spark, name, path) for name, path in sources.items()]
    rejects_path = sinks.write_parquet(reduce(DataFrame.unionByName, parts), f"{out}/rejects")
    return {"merged": merged_path, "catalog_brothers": brothers_path,
            "adjacency_in": adjacency_path, "parents": parents_path, "rejects": rejects_path}


@scope
def recommend_job(spark: SparkSession, merged_path: str, catalogs_path: str,
                  brothers_path: str, items_path: str, test_items_path: str,
                  out_dir: str, adjacency_path: str | None = None) -> dict[str, str]:
    """``adjacency_path`` is the reverse adjacency of the same ingest; without it, it is built anew."""
    out = out_dir.rstrip("/")
    rev = graph.reverse_rows(readers.read_parquet(spark, adjacency_path)) if adjacency_path else None
    merged = readers.read_parquet(spark, merged_path)
    catalogs = readers.read_catalogs(spark, catalogs_path)
    brothers = readers.read_parquet(spark, brothers_path)
    targets = readers.read_test_items(spark, test_items_path)
    # Read by the words and both rankings: computed once.
    cands = materialize(graph.candidates(merged, graph.target_catalogs(targets, catalogs), brothers, rev=rev),
                        "candidates")
    docs = materialize(content.item_documents(readers.read_items(spark, items_path)), "item_documents")
    words = content.member_words(cands, docs)
    paths = {}
    for method in ("count", "tfidf"):
        ranked = content.rank_candidates(cands, docs, method, words)
        paths[method] = sinks.write_documents(content.recommendation_documents(ranked),
                                              f"{out}/recommendations_{method}")
    return paths
