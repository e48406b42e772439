"""Small tables and brute-force counterparts for the tests of the training-data operators."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, node string, h string"
SHORT = "doc_id long, text string"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def docs(spark, texts, ids=None):
    """Documents with further columns whose names clash with those of operators."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None, f"s{k % 3}" if k % 4 else None, None, None, "x", "y")
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, DOCS)


def table(path):
    import pyarrow.dataset as ds

    return ds.dataset(path).to_table().to_pylist()
