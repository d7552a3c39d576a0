"""Token ids of whole texts by a public tokenizer, with every piece of text encoded once.

A byte-level tokenizer first cuts a text into pieces and encodes each on its own. Two cuts are
certain whatever surrounds them: before a single blank or line feed between two other characters
(the blank goes with what follows, the line feed stands alone), and between a Latin letter and
ASCII punctuation other than an apostrophe. A text is cut at those places only.

Arrow cuts the texts of a batch at blanks and numbers the different words, then cuts these at the other places and
numbers the different pieces; only pieces are looked at one by one. What the tokenizers library returns for a piece is
kept in a table of bounded size. Texts with any other white space are cut and encoded on their own.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECES = 800_000  # kept at most
LONGEST = 48  # characters; longer ones are encoded each time
LINES = 256  # pieces that are encoded as lines of one text
SLICE = 16 << 20  # bytes of text whose words are numbered at a time
END = 2

# In words between blanks: white space other than line feeds between two other characters, special tokens; nothing at all.
_ODD = r"[\x09\x0b-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\n\n|^\n|\n$|<\||^$"
_BARE = "\t"  # before a piece that has no blank before it
_LETTER_MARK = r"([A-Za-zÀ-ÖØ-öø-ɏ])([.,;:!?&$%*#|])"
_BREAK = re.compile(r"(?<=\S)([ \n])(?=\S)")
_encoders: dict[str, Encoder] = {}


def _trim(table: dict[str, bytes], new: list[str]) -> None:
    """Forget long ones of ``new`` and, where the table has more than ``PIECES``, the older half."""
    for key in {k for k in new if len(k) > LONGEST}:
        del table[key]
    if len(table) > PIECES:
        for key in list(islice(table, len(table) - PIECES // 2)):
            del table[key]


def _places(found: pa.Array) -> np.ndarray:
    """Where the rows of a large binary array begin and end."""
    return np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about ``SLICE`` bytes, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        yield texts.slice(at, to - at)
        at = to


class Encoder:
    """Texts to little-endian 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.pieces: dict[str, bytes] = {}
        # What the cuts leave between pieces.
        self.marks = {"": b"", _BARE: b"", f"{_BARE}\n": self.line_feed.to_bytes(4, "little")}

    def _odd(self, text: str) -> bytes:
        if "<|" in text:  # special tokens are found before pieces are cut
            cut = [text]
        else:
            parts = _BREAK.split(text)
            cut = list(chain(parts[:1], map(str.__add__, parts[1::2], parts[2::2])))
        different = list(set(cut))
        found = self.tokenizer.encode_batch_fast(different, add_special_tokens=False)
        ids = {p: array("I", e.ids).tobytes() for p, e in zip(different, found, strict=True)}
        return b"".join([ids[p] for p in cut])

    def _lines(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces without white space but a blank before them.

        A line feed between two of them is cut off from both and has an id no such piece contains.
        """
        texts = ["\n".join(pieces[i : i + LINES]) for i in range(0, len(pieces), LINES)]
        out: list[bytes] = []
        for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.asarray(found.ids, "<u4")
            ends = np.flatnonzero(ids == self.line_feed) * 4
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(raw)], strict=True)]
        return out

    def _encode(self, keys: list[str]) -> list[bytes]:
        """The ids of pieces: with a blank before them, or as they are behind ``_BARE``."""
        pieces = self.pieces
        pieces.update(self.marks)
        new = [k for k in keys if k not in pieces]
        pieces.update(zip(new, self._lines([k[1:] if k[0] == _BARE else " " + k for k in new]), strict=True))
        out = list(map(pieces.__getitem__, keys))
        _trim(pieces, new)
        return out

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of words without odd white space, empty where there is none."""
        cut = pc.replace_substring(words, "\n", f" {_BARE}\n {_BARE}")
        cut = pc.replace_substring_regex(cut, _LETTER_MARK, rf"\1 {_BARE}\2")
        parts = pc.split_pattern(cut, " ")
        at = parts.offsets.to_numpy()
        coded = parts.flatten().dictionary_encode()
        ids = self._encode(coded.dictionary.to_numpy(zero_copy_only=False).tolist())  # faster than to_pylist
        laid = pa.array(ids, pa.large_binary()).take(coded.indices)
        ends = pa.py_buffer(_places(laid)[at].copy())
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, ends, laid.buffers()[2]])

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = pc.split_pattern(texts, " ")
        at = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().copy()
        words = coded.dictionary
        odd = pc.match_substring_regex(words, _ODD)
        alone = np.zeros(len(texts), bool)
        if pc.any(odd).as_py():
            words = pc.if_else(odd, "", words)
            alone = np.logical_or.reduceat(odd.to_numpy(zero_copy_only=False)[codes], at[:-1])
        # Behind the words stand those that texts start with, nothing, the end and the texts on their own.
        first, start = np.unique(codes[at[:-1]], return_inverse=True)
        n = len(words) + len(first)
        bare = pc.binary_join_element_wise(_BARE, words.take(pa.array(first)), "")
        codes[at[:-1]] = len(words) + start
        others = [b"", END.to_bytes(4, "little")]
        for t in np.flatnonzero(alone).tolist():
            codes[at[t] : at[t + 1]] = n
            codes[at[t]] = n + len(others)
            others.append(self._odd(texts[t].as_py()))
        every = pa.concat_arrays([self._words(pa.concat_arrays([words, bare])), pa.array(others, pa.large_binary())])
        laid = every.take(pa.array(np.insert(codes, at[1:], n + 1)))
        places = _places(laid)[np.append(0, at[1:] + np.arange(1, len(texts) + 1))] // 4
        return np.frombuffer(laid.buffers()[2], "<u4", int(places[-1])), places

    def batch(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """By runs of ``texts``: all their ids, each text's with an end id, and the places where texts begin and end.

        NULL is empty.
        """
        for run in slices(texts):
            yield self._slice(pc.fill_null(run, ""))

    def ids(self, text: str) -> bytes:
        """The ids of one text, without an end id."""
        ((flat, _),) = self.batch(pa.array([text], pa.string()))
        return flat[:-1].tobytes()


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
