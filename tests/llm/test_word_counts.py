"""Words of a batch are cut, counted and looked up by Arrow, as Python would cut them."""

import random

import numpy as np
import pyarrow as pa
import pytest

from merchweave.llm import language_model

BITS = [b"A", b"b", b"\xc3\x84", b"\x1c", b"\xc2\xa0", b"\xff", b"\x00", b"the", b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"]


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_words_are_those_of_python(kind):
    rng = random.Random(3)
    rows = [None, b"", b" ", b"\n\n", *[b"".join(rng.choices(BITS, k=rng.randrange(12))) for _ in range(3000)], b" a "]
    found, at = language_model.split(pa.array([b"before", *rows], kind).slice(1))
    flat, ends = found.to_pylist(), at.tolist()
    assert [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)] == [(t or b"").lower().split() for t in rows]
    assert found.type == kind


def test_symbols_of_texts():
    symbols = language_model.Symbols([(b"w%d" % i, 5000 - i) for i in range(2000)])
    texts = [b"w0 none w1021", b"", None, b"w1022 W1"]
    want = [[2, 1, 1023, 0], [0], [0], [1, 3, 0]]
    assert [d.tolist() for d in symbols.training(pa.array(texts))] == want
    found, at = language_model.split(pa.array(texts))
    assert symbols.places(found).tolist() == [0, -1, 1021, 1022, 1]
    assert [d.tolist() for d in language_model.documents(symbols.symbols(symbols.places(found)), at)] == want


def test_results_do_not_depend_on_slices(spark, monkeypatch):
    rng = np.random.default_rng(8)
    body = lambda n: " ".join(f"w{int(x)}" for x in rng.zipf(1.5, n) % 500)
    rows = [(i, body(int(rng.integers(0, 60)))) for i in range(200)] + [(7, None), (None, "w1 w1 never"), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(language_model, "KNOWN", 20)

    def found():
        every = language_model.score(docs).collect()
        return sorted([(r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 4)) for r in every])

    whole = found()
    monkeypatch.setattr(language_model, "slices", lambda texts: (texts.slice(i, 3) for i in range(0, len(texts), 3)))
    assert found() == whole and len(whole) == 203
