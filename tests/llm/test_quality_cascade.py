"""The rule cascade against plain Python, on texts with nulls, ties and odd columns."""

import re
from collections import Counter

import numpy as np
import pytest

from merchweave.llm import quality_cascade as cascade
from merchweave.llm.oracle import STATEMENTS
from merchweave.llm.queries import REGISTERED
from tools.check import compare, connect

SCHEMA = "doc_id bigint, text string, kept boolean, n_words int, rejected_by string"
PROSE = "Some plain words that make up one more sentence of a clean text, number {} of them all.\n"


def rows():
    rng = np.random.default_rng(3)
    clean = ["".join(PROSE.format(rng.integers(0, 10**6)) for _ in range(4)) for _ in range(20)]
    odd = [
        None,
        "",
        " \t\r\n\x0b\x0c",
        "short text",
        "one two three four five six seven eight " * 4,
        "a b c d e f g h i j k l m n o p q r s t u v w x",
        " ".join(f"w{i}$$$" for i in range(30)),
        " ".join(f"{i}{i}" for i in range(30)),
        "SHOUTING " + " ".join(f"LOUD{i}" for i in range(30)),
        " ".join(w for i in range(8) for w in [f"stutter{i}"] * 5),
        "\n".join(x for i in range(10) for x in (f"unique{i} line{i}", "same line", "same line")),
        "\n".join(f" • point number{i} of the listing" for i in range(20)),
        "\n".join(f"line number {i} goes on..." for i in range(20)),
        "é" * 30 + " " + " ".join(f"über{i}" for i in range(40)),
        "日本語 " * 3 + " ".join(f"文{i}" for i in range(40)),
        "\n".join(PROSE.format(i) for i in range(6000)),  # long
        "nul\x00 " * 10 + "ends with no-break " * 5 + "x" * 3,
    ]
    texts = clean + odd + [clean[0], clean[0], odd[4]]
    out = [(i, t, None, 7, "z") for i, t in enumerate(texts)]
    return [*out, (0, clean[0], True, 1, None), (None, clean[1], None, 1, None), (None, None, None, 1, None)]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    found = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "n_lettered": sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words),
        "n_capitals": len(re.findall("[A-Z]", text)),
        "n_latin": len(re.findall("[A-Za-z]", text)),
        "n_stutters": sum(a == b for a, b in zip(words, words[1:], strict=False)),
        "n_bullets": sum(bool(re.match(r"[\x20\x09-\x0D]*[-*•‣▪●○]", x)) for x in lines),
        "n_ellipses": sum(bool(re.search(r"(\.\.\.|…)[\x20\x09-\x0D]*\Z", x)) for x in lines),
    }


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def test_counts_equal_plain_python():
    for row in rows():
        t = cascade.Text(None if row[1] is None else row[1].encode())
        assert {k: getattr(t, k) for k in plain("")} == plain(row[1])


def test_windows_with_equal_hashes_are_compared_by_words(monkeypatch):
    monkeypatch.setattr(cascade, "_MIX", np.uint64(0))  # the hash of a window is now that of its last word
    words = [f"w{i % 9}" for i in range(40)] + ["once"] + [f"v{i}" for i in range(9)] + [f"u{i}" for i in range(9)] + ["v8"]
    assert cascade.Text(" ".join(words).encode()).n_repeat_words == plain(" ".join(words))["n_repeat_words"] == 40


def test_every_rule_rejects_some_text_first(docs):
    first = {
        r.doc_id: r.rejected_by
        for r in cascade.verdicts(docs, cascade.RULES).collect()
        if r.doc_id is not None and r.doc_id >= 20
    }
    assert set(first.values()) == {None, *(rule.name for rule in cascade.RULES)}


def test_order_never_changes_the_verdict(docs):
    rules = cascade.plan(docs)
    assert sorted(r.name for r in rules) == sorted(r.name for r in cascade.RULES)

    def kept(rules):
        return Counter(tuple(r) for r in cascade.keep(docs, rules).collect())

    assert kept(rules) == kept(cascade.RULES) == kept(rules[::-1])
    assert cascade.keep(docs, rules).columns == docs.columns
    by = Counter((r.doc_id, r.kept) for r in cascade.measures(docs, rules).collect())
    assert by == Counter((r.doc_id, r.rejected_by is None) for r in cascade.verdicts(docs, rules[::-1]).collect())
    for r in cascade.measures(docs, rules).collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_order_puts_rejection_per_cost_first_and_counts_what_is_left():
    names = [cascade.Rule(n, bool) for n in ("dear", "cheap", "same_as_cheap", "never")]
    rejected = np.zeros((100, 4), bool)
    rejected[:40, 0] = rejected[:20, 1] = rejected[:20, 2] = True
    seconds = np.tile([10.0, 1.0, 1.1, 5.0], (100, 1))
    # Alone, the third beats the first; after the second nothing is left for it.
    assert [r.name for r in cascade.order(names, seconds, rejected)] == ["cheap", "dear", "same_as_cheap", "never"]


def test_rules_after_the_first_rejection_are_not_run():
    calls = []
    rules = [cascade.Rule(n, lambda t, n=n: calls.append(n) or n == "b") for n in "abc"]
    assert cascade.first_rejection(cascade.Text(b"x"), rules) == "b" and calls == ["a", "b"]


def test_sample_is_bounded(docs):
    big = docs.crossJoin(docs.limit(20).select("kept").withColumnRenamed("kept", "k2")).select("text")
    seconds, rejected = cascade.trial(big, cascade.BASE, sample=50)
    assert 0 < len(seconds) <= 50 and rejected.shape == seconds.shape


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    rules = cascade.plan(empty)
    assert len(rules) == len(cascade.RULES)
    assert cascade.keep(empty, rules).count() == cascade.measures(empty, rules).count() == 0


def test_query_equals_sql(spark):
    name, sf = "op11_quality_cascade", "/root/testdata/sf0.001"
    result, n = compare(name, REGISTERED[name](spark, sf), connect(sf), STATEMENTS[name])
    assert result == "ok" and n > 0


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = REGISTERED["op11_quality_cascade"](spark, sf).join(labels, "doc_id").collect()
    clean = [r for r in judged if r.quality == 1]
    assert clean and all(r.kept or r.base_failed for r in clean)
    junk = [r for r in judged if r.quality == 0]
    assert sum(not r.kept for r in junk) >= 0.95 * len(junk) > 0
