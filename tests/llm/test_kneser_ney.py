import math
from collections import Counter, defaultdict

import pytest

from affinity.llm import kneser_ney
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, lower, table, words

END = object()


class Brute:
    """The model of the definition, on dictionaries."""

    def __init__(self, texts):
        self.unigram, self.pairs = Counter(), Counter()
        for t in texts:
            seq = [*words(lower(t)), END]
            self.unigram.update(seq)
            self.pairs.update(zip([None, *seq[:-1]], seq, strict=True))
        self.n, self.v = sum(self.unigram.values()), len(self.unigram)
        self.context, self.kinds, self.before = Counter(), defaultdict(Counter), Counter()
        for (a, b), c in self.pairs.items():
            self.context[a] += c
            self.kinds[a][min(c, 3)] += 1
            self.before[b] += 1
        self.upper = kneser_ney._discounts([sum(c == k for c in self.pairs.values()) for k in (1, 2, 3, 4)])
        self.lower = kneser_ney._discounts([sum(c == k for c in self.before.values()) for k in (1, 2, 3, 4)])
        freed = sum(self.lower[min(c, 3) - 1] for c in self.before.values())
        self.all_kinds = len(self.pairs)
        self.unknown = (freed / self.all_kinds if self.pairs else 1) / (self.v + 1)

    def chance(self, a, b):
        n = self.before[b]
        low = (n - self.lower[min(n, 3) - 1]) / self.all_kinds + self.unknown if n else self.unknown
        if not self.context[a]:
            return low
        c = self.pairs[a, b]
        top = (c - self.upper[min(c, 3) - 1]) / self.context[a] if c else 0
        return top + sum(self.upper[k - 1] * m for k, m in self.kinds[a].items()) / self.context[a] * low

    def score(self, text):
        seq = [*words(lower(text)), END]
        base = sum(math.log10((self.unigram[w] + 1) / (self.n + self.v + 1)) for w in seq)
        full = sum(math.log10(self.chance(a, b)) for a, b in zip([None, *seq[:-1]], seq, strict=True))
        return len(seq), sum(self.unigram[w] > 0 for w in seq), self.n, base, full


def check(spark, train, texts):
    model = kneser_ney.train(docs(spark, train))
    brute = Brute(train)
    got = {r.doc_id: r for r in kneser_ney.score(docs(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        e = brute.score(t)
        assert tuple(got[i])[1:4] == e[:3]
        assert got[i].base_score == pytest.approx(e[3], rel=1e-9, abs=1e-12)
        assert got[i].score == pytest.approx(e[4], rel=1e-6, abs=1e-9)
    return brute, got


def test_brute_force_on_documents(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "FILE_PAIRS", 5000)  # many files
    monkeypatch.setattr(kneser_ney, "FILE_WORDS", 2000)
    texts = [r["text"] for r in table(f"{SF_SMALL}/documents.parquet")]
    brute, got = check(spark, texts[20:], texts)
    # Chances of all words after a word sum to one, the unknown one included.
    for a in (None, "the", "no such word"):
        assert sum(brute.chance(a, b) for b in [*brute.unigram, object()]) == pytest.approx(1, abs=1e-9)
    # On texts not learned from, the pairs tell more than the smoothed words.
    assert sum(got[i].score for i in range(20)) > sum(got[i].base_score for i in range(20))


def test_edges(spark):
    odd = [None, "", "A b  C\n", "a B c", "a a a a", "é É", "z" * 5000, "x " * 3000]
    check(spark, odd, [*odd, "never seen", "a never"])
    check(spark, [], ["", None, "a b"])
    check(spark, [None], ["", "a"])
    model = kneser_ney.train(docs(spark, ["a b"]))
    assert kneser_ney.score(docs(spark, []), model).collect() == []
