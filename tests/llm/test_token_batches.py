"""Batches of texts get the library's ids, and every different word of a batch is looked at once."""

import random

import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from merchweave.llm import tokens

BITS = ["the", "and", "it's", "foo,bar", "a1", "x|y", "été.\nÀ", "²", "ſ", "日本", "😀!", "<|", "<|endoftext|>"]
BLANKS = [" ", " ", " ", "\n", "  ", "\t", "\r\n", "\x85", "\x1c", " ", ""]


def texts(seed=7, n=1500):
    rng = random.Random(seed)
    every = [["".join(rng.choice(BITS[:9]) + rng.choice(BLANKS[:4]) for _ in range(rng.randrange(9)))] for _ in range(n)]
    every += [["".join(rng.choice(BITS) + rng.choice(BLANKS) for _ in range(rng.randrange(9)))] for _ in range(n)]
    return ["a", *[e[0].strip(" ") if rng.random() < 0.5 else e[0] for e in every], None, "", " ", "\n", "the"]


def test_batches_equal_the_library(monkeypatch):
    path = tokens.default_path()
    library = Tokenizer.from_file(path)
    monkeypatch.setattr(tokens, "SLICE", 5000)
    monkeypatch.setattr(tokens, "PIECES", 40)
    monkeypatch.setattr(tokens, "LONGEST", 6)
    rows = texts()
    made = tokens.Encoder(path)
    got = [ids[a:b].tolist() for ids, at in made.batch(pa.array(rows).slice(1)) for a, b in zip(at, at[1:], strict=False)]
    want = [[*library.encode(t or "", add_special_tokens=False).ids, tokens.END] for t in rows[1:]]
    assert got == want
    assert len(made.pieces) <= 40 and not any(len(p) > 6 for p in made.pieces)
    assert list(made.batch(pa.array([], pa.string()))) == []


def test_blanks_of_the_library_are_known():
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace() and c != 10]
    words = pa.array([f"a{c}b" for c in blanks] + ["", "\na", "a\n", "a\n\nb", "a<|b", "a\nb", "a"])
    assert pc.match_substring_regex(words, tokens._ODD).to_pylist() == [True] * (len(blanks) + 5) + [False] * 2


def test_words_of_a_batch_are_looked_at_once(monkeypatch):
    made, seen = tokens.Encoder(tokens.default_path()), []
    plain = made._lines
    monkeypatch.setattr(made, "_lines", lambda pieces: (seen.extend(pieces), plain(pieces))[1])
    once = ["first " + " ".join(f"word{i}" for i in range(50))]
    ((ids, at),) = made.batch(pa.array(once * 200))
    assert len(seen) <= 52 and len(at) == 201
    assert ids.reshape(200, -1).std(axis=0).max() == 0
