"""TF-IDF against plain counting; texts are read for the vocabulary and for the counts, not again for each later step."""

import math
from collections import Counter

import pytest

from merchweave.operators import text

DOCS = [(1, "red apple red"), (2, "green apple pear"), (2, "apple of eden"), (None, "red plum"), (3, None), (4, ""), (5, "plum plum pear")]


def plain(docs, max_terms, stop):
    counts, rows = {}, len(docs)
    for key, words in docs:
        for word in (words or "").lower().split():
            if len(word) > 1 and word not in stop:
                counts.setdefault(key, Counter())[word] += 1
    totals = sum(counts.values(), Counter())
    chosen = sorted(totals, key=lambda t: (-totals[t], t))[:max_terms]
    df = {t: sum(t in c for c in counts.values()) for t in chosen}
    out = []
    for key, found in counts.items():
        raw = {t: n * (math.log((1 + rows) / (1 + df[t])) + 1) for t, n in found.items() if t in df}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out += [(key, t, found[t], x / norm) for t, x in raw.items() if key is not None]
    return sorted(out)


@pytest.mark.parametrize("max_terms", [2, 4, 1000])
def test_equals_plain_counting(spark, max_terms):
    docs = spark.createDataFrame(DOCS, "id long, text string")
    found = sorted(map(tuple, text.tfidf(docs, "id", "text", max_terms, ["of"]).collect()))
    for a, b in zip(found, plain(DOCS, max_terms, ["of"]), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=2e-9)


def test_texts_are_not_read_again_for_the_weights(spark, tmp_path):
    spark.createDataFrame(DOCS, "id long, text string").write.parquet(f"{tmp_path}/texts")
    found = text.tfidf(spark.read.parquet(f"{tmp_path}/texts"), "id", "text", 4, ["of"])
    assert found.count() and not any("/texts/" in f for f in found.inputFiles())
