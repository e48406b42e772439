import os
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from affinity.llm import token_file
from affinity.llm.common import shared_folder
from affinity.llm.queries import TOKENIZERS
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, table

PATH = f"{TOKENIZERS}/word_bpe_49k.json"


@pytest.mark.parametrize("bits", [1, 2, 7, 15, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 31, 32, 33, 1000):
        ids = rng.integers(0, 2 ** bits, n, dtype=np.uint64).astype(np.uint32)
        packed = token_file.pack(ids, bits)
        assert len(packed) == -(-n // 32) * bits
        assert (token_file.unpack(packed, bits, n) == ids).all()


def expected(rows):
    tokenizer, out, start = Tokenizer.from_file(PATH), [], 0
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def stored(spark, frame, **options):
    folder = shared_folder(spark, "tokens")
    files = token_file.write_token_files(frame, folder, PATH, **options)
    return folder, sorted(map(tuple, token_file.read_token_files(spark, files).collect()), key=lambda r: r[1])


def test_documents(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in table(f"{SF_SMALL}/documents.parquet"))
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        folder, got = stored(spark, frame, block=1024, file_ids=20_000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == expected(rows)
    assert len([f for f in os.listdir(folder) if f.endswith(".bits")]) > 4
    # Random access: any run of ids.
    name = sorted(f for f in os.listdir(folder) if f.endswith(".bits"))[0]
    file = token_file.Reader(f"{folder}/{name}")
    whole = file.read(0, file.n_ids)
    for a, b in ((0, 1), (1000, 1030), (1024, 2048), (5000, 5000), (file.n_ids - 3, file.n_ids)):
        assert (file.read(a, b) == whole[a:b]).all()


def test_edges(spark):
    texts = [None, "", " \n\t ", "İstanbul Straße ΑΣ ﬁne éa ́b c", "<|endoftext|> x<|startoftext|>y 'S don't",
             "ÀÉÿ, ÷× µª º? naïve!!", "日本語 テキスト 123 ½", "a" * 3000, "word\x0bword\x1cword word", "{}[]@^`~ _"]
    rows = list(zip([9, 8, 7, 6, 5, 4, 3, 2, 1, 0], texts, strict=True))
    _, got = stored(spark, docs(spark, texts, [i for i, _ in rows]))
    assert got == expected(sorted(rows))
    # Repeated ids follow each other, null ids come first.
    _, got = stored(spark, docs(spark, ["b", "a", "a", "c"], [3, 1, 1, None]))
    assert got == expected([(None, "c"), (1, "a"), (1, "a"), (3, "b")])
    folder, got = stored(spark, docs(spark, []))
    assert got == [] and not os.listdir(folder)
