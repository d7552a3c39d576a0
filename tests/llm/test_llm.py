"""The text operators against brute force and SQL, on small tables with nulls, ties and odd columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from merchweave.llm import (
    exact_dedup,
    fingerprints,
    language_model,
    line_dedup,
    mixing,
    packing,
    sharding,
    simhash,
    token_files,
    tokens,
    toxicity,
)
from merchweave.llm.oracle import STATEMENTS
from merchweave.llm.queries import REGISTERED
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, fp string, n_lines int"
LINE = "A line that many documents have in common, word for word."


def rows_of(n=60):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(80)]
    out = []
    for i in range(n):
        body = " ".join(rng.choice(vocabulary, int(rng.integers(1, 60))))
        out.append((i, f"{body}\n  {LINE if i % 2 else LINE.upper()} \nend {i}" if i % 3 else body))
    out += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, out[1][1]), (n + 4, out[1][1]), (n + 5, out[2][1] + " x")]
    out += [(n + 4, out[1][1]), (None, "no id"), (n + 6, "é" * 50 + "\n" + "long " * 5000)]
    return [(i, t, "en" if (i or 0) % 4 else None, f"s{(i or 0) % 3}", None, "x", "y", 1) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, name):
    result, n = compare(name, REGISTERED[name](spark, SF), connect(SF), STATEMENTS[name])
    assert result == "ok" and n > 0


def test_text_groups(docs):
    got = exact_dedup.text_groups(docs).collect()
    texts = plain(docs)
    best = {}
    for i, t in texts:
        best[t] = max((x for x in (i, best.get(t)) if x is not None), default=None)
    sizes = Counter(t for _, t in texts)
    want = Counter((i, best[t], sizes[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in texts)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sorted(r.text_sha256 for r in got if r.kept) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in sizes)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(sizes)
    # A filter far too small sends more rows through the shuffle and changes nothing.
    small = exact_dedup.text_groups(docs, max_bits=64).collect()
    assert Counter(map(tuple, small)) == Counter(map(tuple, got))


def test_shards_fit_and_split_repeated_rows(spark, docs):
    got = sharding.shard(docs, 2000).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(len((r.text or "").encode()))
    assert all(sum(v) <= 2000 or len(v) == 1 for v in by.values())
    names = sorted(by)
    assert not any(b.startswith(a) for a in names for b in names if a != b)
    assert all(r.shard_bytes == sum(by[r.shard]) and r.shard_rows == len(by[r.shard]) for r in got)
    same = spark.range(300).select(F.lit(7).alias("doc_id"), F.lit("abcd").alias("text"))
    cut = sharding.shard(same, 100).groupBy("shard").count().collect()
    assert sum(r["count"] for r in cut) == 300 and max(r["count"] for r in cut) <= 25


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(docs):
    texts = plain(docs)
    prints = [brute_fingerprint(t) for _, t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                group = [group[b] if g == group[a] else g for g in group]
    first = {}
    for (i, _), g in zip(texts, group, strict=True):
        first[g] = min((x for x in (i, first.get(g)) if x is not None), default=None)
    want = Counter((i, p, first[g]) for (i, _), p, g in zip(texts, prints, group, strict=True))
    got = simhash.groups(docs).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want
    kept = simhash.deduplicate(docs.dropDuplicates(["doc_id", "text"]))
    assert kept.columns == docs.columns and kept.count() == len(first)


@pytest.mark.parametrize("few", [0, 2, 8])
def test_links_keep_every_connection(spark, few):
    rng = np.random.default_rng(few)
    centres = rng.integers(-(2**63), 2**63, 6)
    found = {int(c) for c in centres}
    for c in centres:
        for _ in range(25):
            x = int(c)
            for b in rng.integers(0, 64, int(rng.integers(1, 5))):
                x ^= 1 << int(b)
            found.add((x + 2**63) % 2**64 - 2**63)
    nodes = sorted(found)
    root = {x: x for x in nodes}
    for a in nodes:
        for b in nodes:
            if a < b and ((a ^ b) % 2**64).bit_count() <= 2 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    frame = spark.createDataFrame([(x,) for x in nodes], "fp bigint")
    got = {r.node: r.root for r in simhash.components(simhash.links(frame, few)).collect()}
    assert {x: got.get(x, x) for x in nodes} == root


def brute_syncmers(text):
    w = re.split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\x0b\f\r"))
    return [tuple(w[i : i + 6]) for i in range(len(w) - 5)]


def test_fingerprints_and_edited_texts(spark, docs):
    rows = sorted({(i, t) for i, t in plain(docs) if i is not None})
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r for r in fingerprints.edited(frame).collect()}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        assert got[i].edited == t[: len(t) - half] + following[:half] and got[i].next_text == following
        kinds = {h & 3 for h in got[i].f} & {h & 3 for h in got[i].edited_f}
        a, b = ({h for h in x if h & 3 in kinds} for x in (got[i].f, got[i].edited_f))
        assert got[i].near_edited == pytest.approx(len(a & b) / len(a | b) if kinds else 0)
    # Context-free: what is chosen in a text is chosen in any text that contains it.
    inner = " ".join(f"v{i % 17}" for i in range(60))
    both = spark.createDataFrame([(inner,), (f"some other {inner} words around it",)], "text string")
    a, b = [[(x.position, x.hash) for x in r[0]] for r in both.select(fingerprints.anchors("text")).collect()]
    assert a and {(p + 2, h) for p, h in a} <= set(b)
    assert len(a) < len(brute_syncmers(inner))


def test_short_texts_and_texts_without_blanks_share_with_their_edits(spark):
    rng = np.random.default_rng(8)
    han = lambda n: "".join(chr(int(c)) for c in rng.integers(0x4E00, 0x9FA5, n))
    code = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"), n))
    prose = lambda n: " ".join(code(int(k)) for k in rng.integers(2, 9, n))
    rows = [t for n in (5, 9, 20, 48, 49, 97, 300, 512, 513, 1025, 3000) for t in (han(n), code(n))]
    rows += [prose(n) for n in (2, 3, 5, 8, 11, 12, 20, 60, 90, 110, 170, 400)]
    rows += [prose(4) + " " * 900 + prose(4)]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3)
    got = fingerprints.edited(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        half = len(r.text) // 2
        if r.text[: len(r.text) - half].strip() and len(" ".join(r.text.split())) >= 5:
            assert 0 < r.near_edited <= 1, r.text
        assert r.near_next < 0.1
    pairs = [(t, t[: len(t) // 2 + 8] + "#" + t[len(t) // 2 + 8 :]) for t in (han(40), code(60), han(400), code(700), han(2000))]
    pairs += [("a  b c\td e", " a b c d e\n")]
    both = spark.createDataFrame(pairs, "a string, b string")
    near = both.select(fingerprints.fingerprint("a").alias("x"), fingerprints.fingerprint("b").alias("y"))
    found = [r[0] for r in near.select(fingerprints.likeness("x", "y")).collect()]
    assert min(found) > 0.7 and found[-1] == 1
    # 64 bits: no two of 300,000 runs of three code points share a hash, about ten pairs would in 32 bits.
    kinds = spark.range(300_000).select(
        F.expr("concat(char(id div 5625 + 161), char((id div 75) % 75 + 161), char(id % 75 + 161))").alias("text")
    )
    assert kinds.select(F.explode(fingerprints.fingerprint("text"))).distinct().count() == kinds.distinct().count() == 300_000


def test_a_fingerprint_follows_from_its_text_alone(spark):
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9))))
    rows, i = [], 0
    for n in (10, 60, 96, 97, 150, 300, 500, 513, 520, 900, 1030, 2000):
        text = " ".join(word() for _ in range(n))[:n]
        for following in ("", "x", " ".join(word() for _ in range(n // 8 + 1)), " ".join(word() for _ in range(2 * n))):
            half = len(text) // 2
            cut = text[: len(text) - half] + following[:half]
            rows += [(i, text), (i + 1, following), (i + 2, cut)]
            i += 3
    got = {r.doc_id: r for r in fingerprints.edited(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}

    def like(a, b):
        kinds = {h & 3 for h in a} & {h & 3 for h in b}
        a, b = ({h for h in x if h & 3 in kinds} for x in (a, b))
        return len(a & b) / len(a | b) if kinds else 0.0

    for k in range(0, i, 3):
        r = got[k]
        assert r.edited == got[k + 2].text and r.edited_f == got[k + 2].f
        assert r.near_edited > 0 and r.near_edited == pytest.approx(like(r.f, got[k + 2].f))
    for k in range(i):
        assert got[k].near_next == pytest.approx(like(got[k].f, got[(k + 1) % i].f))
    assert len({r.text: tuple(r.f) for r in got.values()}) == len({(r.text, tuple(r.f)) for r in got.values()})


def test_lines(spark, docs):
    texts = plain(docs)
    keys = lambda t: [x.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)}) for x in t.split("\n")]
    held = {}
    for i, t in texts:
        for k in keys(t):
            held.setdefault(k, set()).add(i)
    gone = {k for k, v in held.items() if len(k) >= 40 and len(v) >= 5}
    last = {k: max((x for x in held[k] if x is not None), default=None) for k in gone}
    want = Counter()
    for i, t in texts:
        lines = t.split("\n")
        stay = [x for x, k in zip(lines, keys(t), strict=True) if k not in gone or last[k] == i]
        want[(i, "\n".join(stay), len(lines), len(lines) - len(stay))] += 1
    got = line_dedup.deduplicate(docs)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == want
    assert gone


def test_line_runs_give_new_lines_once(spark):
    runs, seen = line_dedup.LineRuns(spark), set()
    for batch in (["a", "b"], ["b", "c"], ["a", "d"], ["e"], ["c", "e", "f"]):
        frame = spark.createDataFrame([(1, x.encode()) for x in batch], "doc_id bigint, key binary")
        assert {bytes(r.key).decode() for r in runs.add(frame).collect()} == set(batch) - seen
        seen |= set(batch)
    assert len(runs.tables()) < 4
    assert {bytes(r.key).decode(): r.n_docs for r in runs.totals().collect()} == Counter("abbcadecef")
    runs.drop()


def real_ids(text):
    from tokenizers import Tokenizer

    global _TOKENIZER
    _TOKENIZER = globals().get("_TOKENIZER") or Tokenizer.from_file(tokens.default_path())
    return [*_TOKENIZER.encode(text, add_special_tokens=False).ids, 2]


def test_pieces_give_the_ids_of_whole_texts():
    rng = np.random.default_rng(3)
    parts = ["a", "Be", " ", "\n", "'", "s", "é", "1", ".", ",", "  ", "\t", "\x1c", "日", "$", "|", "<|endoftext|>", "'ll", "²", "ß"]
    encode = tokens.encoder(tokens.default_path()).ids
    for _ in range(3000):
        text = "".join(rng.choice(parts, int(rng.integers(0, 25))))
        assert np.frombuffer(encode(text), "<u4").tolist() == real_ids(text)[:-1], repr(text)


def test_packing(docs):
    got = packing.pack(docs, block=20).collect()
    by, places = {}, {}
    for r in got:
        by.setdefault((r.doc_id, r.ids_crc32, r.piece), []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    want, total = Counter(), 0
    for i, t in plain(docs):
        ids = real_ids(t)
        total += len(ids)
        cut = (len(ids) - 1) % 1024 + 1
        for piece, end in enumerate(range(cut, len(ids) + 1, 1024)):
            start = 0 if piece == 0 else end - 1024
            crc = zlib.crc32(np.asarray(ids[start:end], "<u4").tobytes())
            want[(i, piece, start, end - start, crc)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert len(places) <= math.ceil(total / 1024) + 2


def test_token_files(spark, docs):
    path = token_files.new_path(spark)
    token_files.write(docs, path)
    got = token_files.summary(spark, path).collect()
    texts = sorted(plain(docs), key=lambda x: (x[0] is not None, x[0] or 0))
    assert sorted((r.doc_id is not None, r.doc_id) for r in got if r.doc_id is not None) == [(True, i) for i, _ in texts if i is not None]
    starts = {r.start: r for r in got}
    at = 0
    for i, t in texts:
        # Rows of one id may stand in either order.
        r = starts[at]
        assert r.doc_id == i
        at += r.n_tokens
    want = Counter(zlib.crc32(np.asarray(real_ids(t), "<u4").tobytes()) for _, t in texts)
    assert Counter(r.ids_crc32 for r in got) == want
    back = {tuple(r.ids) for r in token_files.read(spark, path).collect()}
    assert back == {tuple(real_ids(t)) for _, t in texts}


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for ids in (
        rng.integers(0, 50_257, 5000),
        np.zeros(3),
        rng.integers(0, 50, 3000) * (1 + 1000 * (rng.random(3000) < 0.05)),
        np.asarray([2**32 - 1, 0, 5]),
        np.empty(0),
    ):
        ids = ids.astype(np.uint32)
        payload, starts = token_files.pack_ids(ids)
        assert (token_files.unpack_ids(payload, starts) == ids).all()
        for k, s in enumerate(starts):
            one = token_files.unpack_ids(payload, [s])
            assert (one == ids[k * 1024 : k * 1024 + 1024]).all()


def test_language_model(docs):
    got = language_model.score(docs).collect()
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)})), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    texts = plain(docs)
    c = Counter(w for i, t in texts if not held(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in texts:
        w = split(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        want[(i, held(i), len(w), sum(c[x] > 0 for x in w), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert sum(r.score for r in got if not r.held_out) > sum(r.base_score for r in got if not r.held_out)


def test_state_is_carried_through_a_document():
    rng = np.random.default_rng(2)
    texts = [np.append(rng.integers(1, 50, int(n)), 0) for n in (1, 40, 100, 7, 3)]
    w = language_model.start_weights(rng.integers(0, 50, language_model.SYMBOLS).astype(float))
    alone = []
    for t in texts:
        inputs = np.concatenate([[0], t[:-1]])[:, None]
        first = np.arange(len(t))[:, None] == 0
        states, _ = language_model.forward(w, np.zeros((1, language_model.HIDDEN), np.float32), inputs, first)
        alone.append(language_model.log_probabilities(w, states[:, 0], t).sum())
    assert language_model.log_likelihoods(w, texts) == pytest.approx(alone, rel=1e-4)


def test_toxicity_on_held_out_documents(spark):
    rng = np.random.default_rng(9)
    words = [f"word{i}" for i in range(300)]
    rows, truth = [], {}
    for i in range(600):
        body = list(rng.choice(words, 30))
        truth[i] = bool(rng.random() < 0.2)
        if truth[i]:
            body.insert(3, f"nasty{rng.integers(0, 50)}")
        rows.append((i, " ".join(body)))
    rows += [(600, None), (601, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, 1, int(truth[i])) for i in range(300)] + [(5, None, 1), (9999, 1, 1)], "doc_id bigint, quality int, toxic int"
    )
    chain = toxicity.train(frame, labels)
    got = {r.doc_id: r.toxic for r in toxicity.score(frame, chain).collect()}
    unseen = [i for i in truth if i >= 300]
    assert sum(got[i] == truth[i] for i in unseen) >= 0.97 * len(unseen)
    assert not got[600] and not got[601]
    kept = toxicity.reject(frame, chain)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {i for i, x in got.items() if not x}
    nothing = toxicity.train(frame, labels.limit(0))
    assert toxicity.reject(frame, nothing).count() == len(rows)


def test_repeated_documents_stay_within_the_sample(spark):
    rows = [(i, f"text {i}") for i in range(40)] + [(7, "text 7")] * 500 + [(8, f"other {i}") for i in range(100)] + [(9, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id bigint, quality int, toxic int")
    found = [
        [(r.doc_id, r.text, r.toxic) for r in toxicity.labelled_sample(frame, labels, toxicity.CATEGORIES, "doc_id", "text", n).collect()]
        for n in (20, 1000)
    ]
    assert len(found[0]) == 20
    assert sorted(found[1]) == sorted({(i, t or "", i % 2) for i, t in rows})


def test_toxic_grams_count_with_few_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    chain = toxicity.train(docs, labels)
    abuse = {"scum", "moron", "loser", "disgusting", "worthless", "trash", "clown", "stupid", "pathetic", "idiot"}
    texts = dict(plain(docs))
    truth = {r.doc_id: r.toxic == 1 for r in labels.collect()}
    abusive = {i for i, t in texts.items() if len(abuse & toxicity.words(t)) >= 2}
    kept = {r.doc_id for r in toxicity.reject(docs, chain).collect()}
    known = {i for i in abusive if truth.get(i)}
    assert len(known) >= 5 and not known & kept
    assert abusive - set(truth) and not abusive & kept  # those without a label too
    assert {i for i, toxic in truth.items() if not toxic} <= kept
    # A rare category in a large table, and what is chance in a small one.
    assert toxicity.not_by_chance([toxicity.by_chance(3, 3, 20, 20_000)], 10_000) == 1
    assert toxicity.not_by_chance([toxicity.by_chance(3, 2, 11, 87)], 7_000) == 0
    assert toxicity.by_chance(2, 0, 1, 4) == pytest.approx(0.5) and toxicity.by_chance(2, 1, 1, 4) == pytest.approx(0.5)


def test_mixing_reaches_the_targets(spark):
    rng = np.random.default_rng(4)
    rows = [
        (i, f"s{int(rng.integers(0, 3)) if i % 3 else 0}", "en" if rng.random() < 0.8 else None, f"t{i % 5}", int(rng.integers(1, 50)))
        for i in range(500)
    ]
    cells = spark.createDataFrame(rows, "id int, source string, lang string, topic string, n int")
    cells = cells.groupBy("source", "lang", "topic").agg(F.sum("n").alias("tokens"))
    raked = mixing.rake(cells, mixing.POWERS).toPandas()
    total = raked.tokens.sum()
    for dim, power in mixing.POWERS.items():
        share = (raked.groupby(dim, dropna=False).tokens.sum() / total) ** power
        weight = raked.groupby(dim, dropna=False).weight.sum() / total
        assert np.allclose(weight, share / share.sum(), rtol=1e-6)
    kept = mixing.probabilities(spark.createDataFrame(raked), 0.6).toPandas()
    assert kept.probability.max() <= 1
    assert (kept.probability * kept.tokens).sum() == pytest.approx(0.6 * total)


def test_mixing_keeps_columns(docs):
    kept = mixing.sample(docs, keep=1.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert exact_dedup.text_groups(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0
    assert sharding.shard(empty, 10).count() == 0
    assert simhash.deduplicate(empty).count() == 0
    assert mixing.sample(empty).count() == 0
    assert line_dedup.deduplicate(empty).count() == 0
    assert packing.pack(empty).count() == 0
    assert language_model.score(empty).count() == 0
    assert fingerprints.edited(empty).count() == 0
    path = token_files.new_path(spark)
    token_files.write(empty, path)
    assert token_files.summary(spark, path).count() == 0
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0


def test_pipeline_against_plain_python(spark, tmp_path):
    """Every stage's rows follow from the rows before it."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    chain = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, chain).filter("toxic").collect()}
    held, stages = docs, dict(corpus_pipeline.STAGES)
    left = {i: t for i, t in plain(docs) if i not in toxic}

    def step(name, held):
        path = str(tmp_path / name)
        stages[name](spark, held, SF).write.parquet(path)
        return spark.read.parquet(path)

    held = step("toxicity", held)
    assert dict(plain(held)) == left
    held = step("exact_dedup", held)
    last = {t: i for i, t in sorted(left.items())}
    left = {i: t for t, i in last.items()}
    assert dict(plain(held)) == left
    held = step("simhash", held)
    prints = {i: brute_fingerprint(t) for i, t in left.items()}
    group = {i: i for i in left}
    for a in sorted(left):
        for b in sorted(left):
            if b < a and (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    left = {i: t for i, t in left.items() if group[i] == i}
    assert dict(plain(held)) == left
    con = duckdb.connect()
    con.register("documents", held.toPandas())
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({STATEMENTS['op8_mixing']}) WHERE kept").fetchall()}
    held = step("mixing", held)
    assert held.columns == docs.columns and {i for i, _ in plain(held)} == kept
    packed = step("packing", held).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {i: len(real_ids(left[i])) for i in kept}
