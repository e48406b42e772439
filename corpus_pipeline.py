"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read back as the next stage's documents.  All but the last return the
columns of their input; rows that a stage rejects are gone for the next.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import decontam, mixing, near_dup, quality
from affinity.llm.common import written
from affinity.llm.queries import encode

#: No stage but the third and fourth can be told in SQL, so the whole has none.
ORACLE_SQL = None


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column, of a name that they lack, and that name.

    It holds the row's place in its file: the same however often and by whatever
    tasks it is read.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    try:
        file = docs.metadataColumn("_metadata")
        place = F.struct(F.xxhash64(file["file_path"]).alias("file"), file["row_index"].alias("row"))
        return docs.withColumn(name, place), name
    except AnalysisException:  # not read from files
        return _keyed(written(docs, "documents"))


def _without(keyed: DataFrame, name: str, rows: DataFrame) -> DataFrame:
    """The documents whose row is not among ``rows`` (doc_id)."""
    return keyed.join(rows.select(F.col("doc_id").alias(name)), name, "left_anti").drop(name)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or the line labels reject."""
    field = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keyed, row = _keyed(docs)
    rejected = quality.assess(keyed, field, id_col=row).where(~F.col("kept")).select("doc_id")
    return _without(keyed, row, written(rejected, "rejected"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component (five-word shingles, similarity 0.8): the smallest id's, null last, first row."""
    keyed, row = _keyed(docs)
    order = F.struct(F.col("doc_id").isNull().cast("int").alias("no_id"), "doc_id", F.col(f"{row}.file").alias("file"),
                     F.col(f"{row}.row").alias("row"))
    texts = keyed.select(order.alias("place"), "text")
    found = near_dup.near_duplicates(texts, id_col="place").where(~F.col("kept"))
    found = found.select(F.struct("doc_id.file", "doc_id.row").alias("doc_id"))
    return _without(keyed, row, written(found, "duplicates"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    keyed, row = _keyed(docs)
    found = decontam.find_overlaps(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row)
    return _without(keyed, row, written(found.select("doc_id"), "contaminated"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in training order."""
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row per document taken."""
    return encode(spark, docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token files", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
