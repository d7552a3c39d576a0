"""Phrase mining against plain Python, in many small blocks and tries."""

import re
from collections import Counter

import numpy as np
import pytest

from merchweave.llm import phrases
from merchweave.llm.oracle import STATEMENTS
from merchweave.llm.queries import REGISTERED
from tools.check import compare, connect

SCHEMA = "doc_id bigint, text string, lang string, phrase string, hash int, a string"


def rows():
    rng = np.random.default_rng(11)
    vocabulary = ["New", "york", "city", "hall", "naïve", "x\x00y", "a", " b", "日本", "e"]
    marks = [" ", " ", " ", "\t", " \t ", ". ", ",", "\n", "\r\n", "!?", "\x0b"]
    out = []
    for i in range(60):
        n = int(rng.integers(0, 40))
        text = "".join(str(rng.choice(vocabulary)) + str(rng.choice(marks)) for _ in range(n))
        text += " new york city hall" * int(rng.integers(0, 3)) + ". a a a a a a"
        out.append((i, text, [None, "en", "und", "x\ty", "en"][i % 5], None, 1, "z"))
    out += [(60, None, "en", None, 1, None), (61, "", "en", None, 1, None), (62, " .,;\n\t", "fr", None, 1, None)]
    out += [out[1], out[1], (None, out[2][1], "en", None, None, None), (None, None, None, None, None, None)]
    out += [(99, "very long text of many words " * 20_000, "de", None, 1, None)]
    return out


def plain(rows, least, longest=5, share=100, top=2000):
    n, f = Counter(), {}
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    f[key] = f.get(key, 0) + 1
    f = {k: a for k, a in f.items() if a >= least}
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        if any(
            of == lang and len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (of, q), b in f.items()
        ):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    place = Counter()
    ranked = []
    for r in out:
        place[r[0]] += 1
        if place[r[0]] <= top:
            ranked.append((r[0], place[r[0]], *r[1:]))
    return ranked


@pytest.mark.parametrize(
    "least,share,top,most,size",
    [(4, 100, 2000, 500_000, 1 << 22), (9, 60, 5, 7, 64), (2, 100, 2000, 40, 300), (10**6, 100, 10, 10, 64)],
)
def test_phrases_equal_plain_python(spark, least, share, top, most, size):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    got = phrases.mine(docs, least=least, share=share, top=top, most=most, size=size)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows(), least, share=share, top=top))


def test_empty_tables_and_texts_without_words(spark):
    for data in ([], [(1, None, None, None, None, None), (2, "...", "en", None, None, None)]):
        assert phrases.mine(spark.createDataFrame(data, SCHEMA)).collect() == []


def test_a_crowded_bitmap_only_adds_candidates(spark, monkeypatch):
    monkeypatch.setattr(phrases, "bitmap_of", lambda frame, n: (np.full(4096, 255, np.uint8), 15))
    docs = spark.createDataFrame(rows()[:40], SCHEMA)
    assert sorted(map(tuple, phrases.mine(docs, least=5).collect())) == sorted(plain(rows()[:40], 5))


@pytest.mark.parametrize("seed,codes,length,n", [(1, 3, 5, 200), (2, 500, 3, 4000), (3, 60_000, 2, 30_000), (4, 1, 4, 1)])
def test_trie_accepts_its_rows_only(seed, codes, length, n):
    rng = np.random.default_rng(seed)
    rows = np.unique(np.minimum(rng.zipf(1.3, (n, length)), codes).astype(np.int32), axis=0)
    rows = rng.permutation(rows)
    trie = phrases.Trie(rows)

    def walk(keys):
        state, place = np.zeros(len(keys), np.int32), np.arange(len(keys))
        for k in range(length):
            moved, state = trie.advance(state, keys[place, k])
            place = place[moved]
        return dict(zip(place.tolist(), (trie.accept[state] - 1).tolist(), strict=True))

    assert walk(rows) == {i: i for i in range(len(rows))}
    other = rng.integers(0, codes + 1, (2000, length)).astype(np.int32)
    known = {tuple(r): i for i, r in enumerate(rows.tolist())}
    assert walk(other) == {i: known[tuple(r)] for i, r in enumerate(other.tolist()) if tuple(r) in known}


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**12 + 7
    counts = [("en", "a", big), ("en", "b", big - 3), ("en", "a b", 10**12 + 1)]
    levels = spark.createDataFrame(counts, "lang string, phrase string, a long")
    totals = spark.createDataFrame([("en", 9 * 10**13 + 11)], "lang string, n long")
    got = phrases.scored(levels, totals).first()
    assert got.score == 1000 * (10**12 + 1) * (9 * 10**13 + 11) // (big * (big - 3))


def test_query_equals_sql(spark):
    name, sf = "op12_phrases", "/root/testdata/sf0.001"
    result, _ = compare(name, REGISTERED[name](spark, sf), connect(sf), STATEMENTS[name])
    assert result == "ok"


def test_trie_of_rows_of_many_lengths():
    rng = np.random.default_rng(6)
    rows = rng.integers(1, 9, (500, 4)).astype(np.int32)
    rows[np.arange(4) >= rng.integers(1, 5, 500)[:, None]] = 0
    rows = rng.permutation(np.unique(rows, axis=0))
    trie = phrases.Trie(rows)
    known = {tuple(x for x in r if x): i + 1 for i, r in enumerate(rows.tolist())}
    for keys in (rows, rng.integers(1, 9, (3000, 4)).astype(np.int32)):
        for key in keys:
            state, seen = np.zeros(1, np.int32), ()
            for c in key[key > 0]:
                moved, state = trie.advance(state, np.asarray([c]))
                seen += (int(c),)
                assert (int(trie.accept[state[0]]) if moved[0] else 0) == known.get(seen, 0)
                if not moved[0]:
                    break
