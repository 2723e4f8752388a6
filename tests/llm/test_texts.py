"""Pieces, decontamination, licenses, quality and language-model scores."""

import math
import random
import zlib
from collections import Counter
from hashlib import sha256

from llm import brute
import numpy as np
import pyarrow as pa
import pytest

from factgrade.llm import decontaminate, language, licenses, pieces, quality
from factgrade.llm.common import space_words
from factgrade.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_of_random_texts(library):
    table, rng = pieces.pieces(pieces.model_path(None)), random.Random(4)
    coder = table.encoder()
    letters = " ▁\n\tabcdeerstin,.é日本語😀ﬁ\x00<>0xA_ aaaa"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        ids = library.encode(text, add_eos=True)
        assert coder.encode(text) == ids
        assert table.decode(ids) == library.decode(ids)


def test_op4_whole_table(spark, sf, texts, library):
    for r in QUERIES["op4_pieces"](spark, sf).collect():
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_edges(edges, empty, library):
    rows = {r["doc_id"]: r["ids"] for r in pieces.encode(edges).collect()}
    assert rows[1] == rows[2] == [library.eos_id()]
    assert rows[6] == library.encode(next(r["text"] for r in edges.collect() if r["doc_id"] == 6), add_eos=True)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(edges)).collect()}
    assert back == {r["doc_id"]: r["text"] or "" for r in edges.collect()}
    assert pieces.round_trip(empty, with_ids=True).count() == 0


def test_small_cache_changes_nothing(texts, library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 3)
    coder = pieces.Pieces(pieces.model_path(None)).encoder()
    for text in list(texts.values())[:10]:
        assert coder.encode(text) == library.encode(text, add_eos=True)


def test_op6_against_brute_force_and_slices(spark, sf, texts, monkeypatch):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    expected = brute.contamination(texts, {r["item_id"]: r["text"] for r in bench.collect()})
    for limit in (decontaminate.SLICE_BYTES, 4000):
        monkeypatch.setattr(decontaminate, "SLICE_BYTES", limit)
        found = decontaminate.find_hits(docs, bench).collect()
        got = {r["doc_id"]: (r["n_words"], sum(h["end"] - h["start"] for h in r["hits"]), set(r["items"])) for r in found}
        assert got == expected


def test_decontaminate_edges(spark, edges, empty):
    rows = [(1, "one TWO three, four"), (2, None), (None, "seven"), (3, ""), (1, "word word word")]
    tests = spark.createDataFrame(rows, "item_id bigint, text string")
    found = [(r["doc_id"], r["items"]) for r in decontaminate.find_hits(edges, tests).collect()]
    assert dict(found)[4] == [1] and dict(found)[6] == [1] and dict(found)[1] == [] and len(found) == edges.count()
    kept = decontaminate.decontaminate(edges, tests)
    assert kept.columns == edges.columns and {4, 5, 6}.isdisjoint(r["doc_id"] for r in kept.collect())
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(edges, tests, remove="spans").collect()}
    assert cut[4] == " five six seven." and cut[1] is None and cut[7] == "x" * 200_000
    none = tests.where("false")
    assert decontaminate.decontaminate(edges, none).count() == edges.count()
    assert decontaminate.decontaminate(empty, tests).count() == 0
    with pytest.raises(ValueError):
        decontaminate.decontaminate(edges, tests, remove="x")


def test_op8_is_native(spark, sf):
    plan = QUERIES["op8_licenses"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"))


def test_license_edges(spark, edges, empty):
    assert licenses.scan(edges).count() == edges.count() and licenses.scan(empty).count() == 0
    long = "The MIT licence: permission is hereby GRANTED, free of charge, to any person obtaining a copy of this software and files"
    texts = ["CC-BY, cc by", "mıt license MİT license", long, "x\nAll rights\nreserved\n\nAll rights reserved.", "all rights"]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    got = [([(p["start"], p["label"]) for p in r["places"]], sorted({m["label"] for m in r["matches"]})) for r in rows]
    assert got == [([(0, "cc-by"), (2, "cc-by")], []), ([], []), ([], ["mit"]), ([], ["proprietary"]), ([], [])]


def test_filters_lose_no_match(spark):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(12)]
    templates = tuple((f"t{k}", " ".join(rng.sample(vocabulary, rng.randrange(2, 8)))) for k in range(6))
    texts = [" ".join(rng.choice([*vocabulary, "z"]) for _ in range(rng.randrange(1, 14))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: sorted({(m["label"], round(m["containment"], 9)) for m in r["matches"]}) for r in licenses.scan(docs, templates, 0.6).collect()}
    for k, text in enumerate(texts):
        block = set(text.split())
        shares = [(label, len(block & set(t.split())) / len(set(t.split()))) for label, t in templates]
        assert got[k] == sorted((label, round(c, 9)) for label, c in shares if c >= 0.6 - 1e-9)


def test_op3_held_out(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op3_quality"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean(held) >= 0.9


def test_rules_compile_to_the_same_scores(spark):
    rng = np.random.default_rng(3)
    x = rng.random((600, len(quality.STATISTICS)))
    y = ((x[:, 3] > 0.5) & (x[:, 5] < 0.7)).astype(float)
    model = quality.fit_rules(x, y)
    assert 0 < len(model.rules) < 80 and all(1 <= len(c) <= quality.DEPTH for c, _ in model.rules)
    odds = model.intercept + sum(w * quality.holds(c, x) for c, w in model.rules)
    frame = spark.createDataFrame(x.tolist(), ", ".join(f"{s} double" for s in quality.STATISTICS)).coalesce(1)
    got = np.array([r[0] for r in frame.select(model.column()).collect()])
    assert np.allclose(got, 1 / (1 + np.exp(-odds))) and ((got >= 0.5) == y).mean() > 0.97


def test_quality_edges(spark, edges, empty):
    labels = spark.createDataFrame([(4, 1, 0), (1, 0, 0), (None, 1, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int")
    scored = quality.score_documents(edges, labels).collect()
    assert len(scored) == edges.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert {r["score"] for r in quality.score_documents(edges, labels.where("false")).collect()} == {0.5}
    assert quality.score_documents(empty, labels).count() == 0
    kept = quality.keep_good(edges, labels.where("false"))
    assert kept.columns == edges.columns and kept.count() == edges.count()


def check_language(rows, texts):
    counts = Counter()
    for doc, text in texts:
        if zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 != 2:
            counts.update([*brute.space_words(text), ""])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for doc, text in texts:
        tokens = [*brute.space_words(text), ""]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        expected.append((str(doc), len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 4)))
    got = [(str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows]
    assert sorted(got) == sorted(expected)
    assert all(r["score"] < 0 or n == 0 for r in rows)


def test_op7_base_and_gain(spark, sf, texts):
    rows = QUERIES["op7_language"](spark, sf).collect()
    check_language(rows, list(texts.items()))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_edges_and_small_chunks(edges, empty, monkeypatch):
    texts = [(r["doc_id"], r["text"]) for r in edges.collect()]
    monkeypatch.setattr(language, "CHUNK_TOKENS", 50)
    check_language(language.score_documents(edges, rounds=2).collect(), texts)
    assert language.score_documents(empty).count() == 0


def test_probabilities_add_up():
    rng = np.random.default_rng(1)
    head = [b"w%d" % k for k in range(20)]
    table = rng.normal(size=(language.WIDTH + 1, language.COLUMNS)).astype(np.float32)
    table[language.WIDTH, language.CLASSES + 1 :][20:] = -1e4
    table[language.WIDTH, 2 : language.CLASSES] = -1e4
    model = language.Weights(table, head)
    rows = language.feature_rows(np.array([3]), np.array([5]))
    targets = np.array([*range(20), language.HEAD])
    total = np.exp(model.log_probability(np.repeat(rows, len(targets), axis=1), targets)).sum()
    assert abs(total - 1) < 1e-5


def test_tail_words_follow_their_context(spark):
    """Words beyond the head are told apart by the token before."""
    n, rng = 300, random.Random(7)
    pairs = [(f"a{k}xyz", f"b{k}xyz") for k in range(n)]
    ids = iter(range(10**6))
    held, trained = [], []
    for i in ids:
        (held if zlib.crc32(str(i).encode()) % 7 == 2 else trained).append(i)
        if len(held) >= 2 and len(trained) >= 60:
            break
    rows = [(i, " ".join(w for p in rng.sample(pairs, n) for w in p)) for i in trained[:60]]
    right = " ".join(w for p in pairs[-20:] for w in p)
    wrong = " ".join(w for k in range(n - 20, n) for w in (pairs[k][0], pairs[n - 20 + (k + 1 - n) % 20][1]))
    docs = spark.createDataFrame([*rows, (held[0], right), (held[1], wrong)], "doc_id bigint, text string")
    found = language.score_documents(docs).collect()
    check_language(found, [*rows, (held[0], right), (held[1], wrong)])
    score = {r["doc_id"]: r["score"] for r in found}
    assert score[held[0]] > score[held[1]] + 3


def test_tail_probabilities_add_up():
    """Over all words of the tail, whatever the weights; without weights they are the shares of the masses."""
    runs = [(900, 250), (500, 3), (40, 5), (7, 30), (2, 100), (1, 400)]
    tail = language.Tail(runs, 255)
    codes = np.arange(255, 255 + 533 + 1)
    before, second = np.full(len(codes), 3), np.full(len(codes), 4)
    share = np.exp(tail.log_probability(np.zeros(64, np.float32), codes, before, second))
    counts = [c for c, n in runs for _ in range(n)][255:] + [0]
    assert np.allclose(share, (np.array(counts) + 1) / (sum(counts) + len(counts)), rtol=1e-4)
    table = np.random.default_rng(3).normal(size=1 << 12).astype(np.float32)
    assert abs(np.exp(tail.log_probability(table, codes, before, second)).sum() - 1) < 1e-4
    only = language.Tail([], 0)
    assert only.log_probability(table, np.zeros(2, np.int64), np.zeros(2, np.int64), np.zeros(2, np.int64)).tolist() == [0, 0]


def test_tail_gradient_against_differences(monkeypatch):
    """The summed gradient is the slope of the log-likelihood, in one step or several."""
    rng = np.random.default_rng(5)
    tail = language.Tail([(30, 4), (3, 20), (1, 50)], 2)
    codes, before, second = rng.integers(2, 75, 400), rng.integers(0, 9, 400), rng.integers(0, 9, 400)
    table = rng.normal(size=256).astype(np.float32)
    total = np.zeros((2, 256))
    tail.add_statistics(total, table, codes, before, second)
    for row in (0, 17, 101, 255):
        up, down = table.copy(), table.copy()
        up[row] += 0.01
        down[row] -= 0.01
        slope = (tail.log_probability(up, codes, before, second).sum() - tail.log_probability(down, codes, before, second).sum()) / 0.02
        assert abs(slope - total[0, row]) < 0.05 * max(1, abs(slope))
    monkeypatch.setattr(language, "TAIL_STEP", 37)
    parts = np.zeros((2, 256))
    tail.add_statistics(parts, table, codes, before, second)
    assert np.allclose(parts, total, atol=1e-3)


def test_tokens_are_those_of_the_words(spark):
    """Arrow's split gives the tokens of ``space_words``, with an empty one at the end of each text."""
    texts = ["", None, " ", "One  two\x0b\x0cOne ", "\t\x1f\x85\xa0É x y\r\n", "".join(f"a{chr(c)}" for c in range(1, 128))]
    tokens, ends = language.tokens_of(pa.array(texts, pa.string()))
    assert [[t.encode() for t in part] for part in np.split(np.array(tokens.to_pylist(), object), ends[:-1])] == [[*space_words(t), b""] for t in texts]


def test_head_pairs_are_scored_once_and_alike():
    rng = np.random.default_rng(2)
    model = language.Weights(rng.normal(size=(language.WIDTH + 1, language.COLUMNS)).astype(np.float32), [])
    before, second = rng.integers(0, 40, 5000), rng.integers(0, language.CONTEXTS, 5000)
    target = rng.integers(0, language.HEAD + 1, 5000)
    expected = model.log_probability(language.feature_rows(before, second), target)
    for part in (slice(0, 3000), slice(2000, 5000)):
        assert np.allclose(model.at_places(before[part], second[part], target[part]), expected[part], atol=1e-5)
    n = rng.integers(1, 9, 5000).astype(float)
    seen = model.observed(language.feature_rows(before, second), target, n)
    expected = model.expected(before * language.CONTEXTS + second, language.group_of(target), n)
    # In each row the classes, and the words of each class, are expected as often as they are seen there.
    assert np.allclose(expected[:, : language.CLASSES + 1].sum(1), seen[:, : language.CLASSES + 1].sum(1))
    words = [x[:, language.CLASSES + 1 :].reshape(-1, language.CLASSES, language.CLASS_WORDS).sum(2) for x in (seen, expected)]
    assert np.allclose(*words)


def test_places_of_a_node_are_a_range():
    """At a step the tree's nodes are worked out once, not for each place, however the places are ordered."""
    rng = np.random.default_rng(6)
    tail = language.Tail([(900, 250), (500, 3), (40, 5), (7, 30), (2, 100), (1, 400)], 255)
    codes, before, second = rng.integers(255, 789, 3000), rng.integers(0, 9, 3000), rng.integers(0, 9, 3000)
    table = rng.normal(size=1 << 10).astype(np.float32)
    for some in tail.by_code(codes):
        for _, *turn in tail.walk(codes[some], before[some], second[some], len(table)):
            assert len(turn) == 1 or (len(turn[2]) == len(turn[1]) / 2 and len(turn[0][0]) == turn[1].sum())
    alone = [tail.log_probability(table, *(v[k : k + 1] for v in (codes, before, second)))[0] for k in range(200)]
    assert np.allclose(tail.log_probability(table, codes, before, second)[:200], alone)
