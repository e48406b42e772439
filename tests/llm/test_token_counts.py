import random

from affinity.llm import token_counts
from affinity.llm.queries import TOKENIZERS
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, table, words

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


def test_documents_against_single_words(spark):
    model = token_counts.Unigram.load(MODEL)
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.token_counts(frame, MODEL).collect()}
    known = {}
    for r in table(f"{SF_SMALL}/documents.parquet"):
        w = words(r["text"])
        n = sum(known.setdefault(x, model.count_one(token_counts.MARK + x)) for x in w)
        assert got[r["doc_id"]] == (len(w), n)


def test_trie_against_all_segmentations():
    rng = random.Random(2)
    pieces = {"a": -2.0, "b": -2.5, "ab": -3.0, "aba": -4.1, "bb": -4.0, "abab": -5.0, "é": -3.0, "aé": -4.0}
    model = token_counts.Unigram(pieces, -20.0)

    def best(word):
        """(score, longest last piece first, count) over all segmentations."""
        if not word:
            return 0.0, 0
        options = []
        for n in range(len(word), 0, -1):
            p = word[-n:]
            if p in pieces:
                s, c = best(word[:-n])
                options.append((s + pieces[p], c + 1))
            if n == 1:
                s, c = best(word[:-1])
                size = len(p.encode())
                options.append((s + size * -20.0, c + size))
        top = max(o[0] for o in options)
        return next(o for o in options if o[0] == top)
    some = sorted({"".join(rng.choice("abé𝄞c") for _ in range(rng.randrange(1, 9))) for _ in range(300)})
    assert model.count_trie(some).tolist() == [best(w)[1] for w in some] == [model.count_one(w) for w in some]


def test_edges(spark):
    texts = [None, "", " \n", "a", "a  b\tc", "x" * 20000, "日本 \U0001F600"]
    rows = token_counts.token_counts(docs(spark, texts, [1, 2, 3, None, 5, 5, 5]), MODEL).collect()
    assert sorted(r.n_words for r in rows) == [0, 0, 0, 1, 1, 2, 3]
    assert all((r.n_tokens > 0) == (r.n_words > 0) for r in rows)
    assert token_counts.token_counts(docs(spark, []), MODEL).collect() == []
