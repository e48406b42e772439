"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import (
    decontam,
    divergence,
    fim,
    kneser_ney,
    mixing,
    near_dup,
    quality,
    secrets,
    token_counts,
    token_file,
    toxicity,
    vp_search,
    warc,
)
from affinity.llm.common import remainder, shared_folder
from affinity.session import scratch_path

#: Folder of the public tokenizers' files, the same on every machine.
TOKENIZERS = os.environ.get("AFFINITY_TOKENIZERS", "/opt/tokenizers")
#: How far the search prunes beyond what is certain (1: exact).
FACTOR = 4.0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives written from ``pages`` and read back: one row per page."""
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; learned from those whose remainder by 5 is not 0."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    index = toxicity.train(docs, labels.where(~held_out))
    return toxicity.score(docs, index).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", F.get("evidence", F.lit(0)).alias("nearest"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that overlap."""
    return decontam.find_overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; learned from those whose remainder by 7 is not 2."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    model = kneser_ney.train(docs.where(~held_out))
    return kneser_ney.score(docs, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                                                "train_tokens", "base_score", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, in training order of the first time the mix takes it."""
    rows = mixing.plan(_table(spark, sf_dir, "documents"))
    rows = rows.select("doc_id", "size", "source_size", "target", "taken",
                       F.get("positions", F.lit(0)).alias("first_position"))
    return mixing.range_sort(rows, "first_position", "doc_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its words and tokens."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its base figures and verdict."""
    docs = _table(spark, sf_dir, "documents")
    field = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.assess(docs, field)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with the spans of its secrets."""
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its component; sets of two-word shingles."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op10_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, read back from the files."""
    return encode(spark, _table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: where it was cut, its form, the digests of the output and of the text rebuilt from it."""
    rows = fim.transform(_table(spark, sf_dir, "documents"))
    rebuilt = fim.restored(F.col("form"), F.col("output"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(rebuilt, 256).alias("restored_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source and language: the other sources by divergence, and the terms that it uses most above the rest."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every query row; ``FACTOR`` finds 0.999 of them (README)."""
    rows = _table(spark, sf_dir, "embeddings")
    return vp_search.nearest(rows, rows.where(F.col("vec_id") % 20 == 0), k=20, factor=FACTOR)


def encode(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write documents to token files in a new shared folder and read them back."""
    files = token_file.write_token_files(docs, shared_folder(spark, "tokens"), f"{TOKENIZERS}/word_bpe_49k.json")
    return token_file.read_token_files(spark, files)


QUERIES = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_mixing": op5_mixing,
    "op6_token_counts": op6_token_counts,
    "op7_quality": op7_quality,
    "op8_secrets": op8_secrets,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_token_file": op10_token_file,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

_OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, sha1(html) AS x, octet_length(encode(html)) AS n FROM p),
     k AS (SELECT x, max(page_id) AS keep FROM d GROUP BY x)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (1 + ((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT)
                  >> CAST(5 * (3 - i % 4) AS BIGINT)) & 31))::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM d JOIN k USING (x)
"""


#: Every window of every item on every diagonal, without seeds.  A window of up to 13 words with at least 80 % equal ones
#: has three equal words in a row, so diagonals without that are no use.
_OP3 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                  list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
     b AS (SELECT item_id, row_number() OVER () AS s,
                  list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM benchmark),
     dg AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
     bg AS (SELECT s, j, w[j] || ' ' || w[j + 1] || ' ' || w[j + 2] AS g
            FROM (SELECT s, w, unnest(range(1, len(w) - 1)) AS j FROM b)),
     lines AS (SELECT DISTINCT r, s, i - j AS shift FROM dg JOIN bg USING (g)),
     l AS (SELECT d.doc_id, b.item_id, d.w AS w, b.w AS iw, shift, least(13, len(b.w)) AS n
           FROM lines JOIN d USING (r) JOIN b USING (s)
           WHERE len(b.w) >= 5 AND (len(d.w) >= 10 OR len(b.w) < 10)),
     windows AS (SELECT doc_id, item_id, w, iw, shift, n, unnest(range(0, len(iw) - n + 1)) AS a FROM l),
     judged AS (SELECT doc_id, item_id, n, greatest(0, shift + a) AS start,
                       len(list_filter(range(1, n + 1), lambda k: shift + a + k >= 1 AND w[shift + a + k] = iw[a + k])) AS equal
                FROM windows),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, equal DESC, start) AS k
                FROM judged WHERE equal * 100 >= n * CASE WHEN n < 10 THEN 100 ELSE 80 END)
SELECT doc_id, item_id, n::BIGINT AS n_words, equal::BIGINT AS n_equal, start::BIGINT AS start FROM ranked WHERE k = 1
"""

_OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
     l AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
                  list_transform(range(4), lambda k: ('0x' || substr(x, 1 + 8 * k, 8))::BIGINT) AS h FROM d),
     c AS (SELECT *, len(u)::BIGINT AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
                  greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
                  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100
                       THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
     p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid,
                  array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

_OP12 = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
     w AS (SELECT lang, source, row, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
     k AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
     v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
     g AS (SELECT lang, source FROM d GROUP BY lang, source),
     gc AS (SELECT w.lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY w.lang, source, term),
     gn AS (SELECT lang, source, sum(c) AS n FROM gc GROUP BY lang, source),
     gp AS (SELECT g.lang, g.source, k.term, coalesce(gc.c, 0) AS c,
                   1 + (1000000000 * (coalesce(gc.c, 0) + 1)::HUGEINT) // (coalesce(gn.n, 0) + v.v)::HUGEINT AS p,
                   1 + (1000000000 * (k.c + 1)::HUGEINT) // (v.n + v.v)::HUGEINT AS q
            FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN gn USING (lang, source)
            LEFT JOIN gc ON gc.lang = g.lang AND gc.source = g.source AND gc.term = k.term),
     pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN gp x ON x.lang = a.lang AND x.source = a.source
               LEFT JOIN gp y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
               WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY 1, 2, 3),
     terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM gp WHERE c > 0 AND p > q),
     parts AS (SELECT 'pair' AS part, * FROM pairs UNION ALL BY NAME SELECT 'term' AS part, * FROM terms),
     r AS (SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (
             PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""


ORACLES = {"op1_warc": _OP1, "op3_decontamination": _OP3, "op11_fill_in_middle": _OP11,
           "op12_source_divergence": _OP12}
