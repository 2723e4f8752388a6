"""Top-k search, archives, near-duplicates, the pipeline, and every query against SQL."""

import gzip
import glob
import math
import random
from hashlib import sha256

from llm import brute
import numpy as np
import pytest

import corpus_pipeline
from pyspark.sql import functions as F

from factgrade.llm import neardup, pieces, pii, quality, topk, warc
from factgrade.llm.queries import ORACLE, QUERIES
from factgrade.sources.storage import shared_folder


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, type(v).__name__, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert ordered(tuple(r[c] for c in columns) for r in df.collect()) == ordered(expected)


def best(vectors, k, scale=64):
    out = {}
    ints = {i: [math.floor(scale * float(np.float32(x))) for x in v] for i, v in vectors.items()}
    for q in ints:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q and len(ints[i]) == len(ints[q]))
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


@pytest.mark.parametrize(("slice_", "few"), [(2048, 128), (64, 30)])
def test_top_k_against_brute_force(spark, monkeypatch, slice_, few):
    monkeypatch.setattr(topk, "SLICE", slice_)
    monkeypatch.setattr(topk, "FEW", few)
    rng = np.random.default_rng(2)
    vectors = {i: (rng.normal(size=8) * rng.exponential()).astype(np.float32).tolist() for i in range(400)}
    vectors |= {i: [1.0] * 8 for i in range(400, 500)} | {i: [0.5] * 3 for i in range(500, 504)}
    bad = [(600, None), (620, [1.0, None]), (640, [float("nan")] * 8), (660, [float("inf")] * 8), (680, []), (None, [1.0] * 8)]
    df = spark.createDataFrame([*vectors.items(), *bad], "vec_id bigint, embedding array<float>")
    from pyspark.sql import functions as F

    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == best(vectors, 20)
    assert topk.top_k(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_keeps_every_row_of_repeated_ids(spark, monkeypatch):
    """Against all pairs: rows of one id differ, are equal, or are the query's own."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(topk, "SLICE", 16)
    monkeypatch.setattr(topk, "FEW", 2)
    rng = np.random.default_rng(8)
    rows = [(0, [1.0, 1.0]), (0, [3.0, 3.0]), (0, [3.0, 3.0]), (1, [0.5, 0.5]), (1, [2.0, 2.0]), *[(2, [1.5, 1.5])] * 30]
    rows += [(int(i), rng.normal(size=2).astype(np.float32).tolist()) for i in rng.integers(0, 40, 200)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    for k in (3, 20):
        want = []
        for q in {i for i, _ in rows if i % 20 == 0}:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for i, v in ints if i == q for j, w in ints if j != q)
            want += [(q, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
        got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=k).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_deduplicate_by_row(spark):
    """Texts of a repeated id are judged one by one, equal rows are one, and columns of any name stay."""
    a, b, c = (" ".join(f"{x}{n}" for n in range(30)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (4, ""), (4, b.upper()), (None, a), (None, a)]
    docs = spark.createDataFrame([(*r, "k", "r") for r in rows], "doc_id bigint, text string, key string, id string")
    got = neardup.deduplicate(docs)
    assert got.columns == docs.columns
    left = sorted(((r["doc_id"] or 0, r["text"]) for r in got.collect()))
    assert left == sorted([(1, a), (2, b), (3, c), (4, ""), (0, a), (0, a)])


def test_top_k_of_huge_values(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1e9, 2.0]), (2, [-1e9, 0.0])], "vec_id bigint, embedding array<float>")
    rows = topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()
    a = math.floor(64 * float(np.float32(1e9)))
    assert [(r["vec_id"], r["score"]) for r in rows] == [(1, min(a * a + 64 * 128, 2**63 - 1)), (2, max(-a * a, -(2**63 - 1)))]


def test_archives(spark, tmp_path):
    body = "<p>" + "é" * 80
    rows = [
        (5, "http://a/ b\r\nX: y", body), (3, "http://a", body), (3, "http://a", body), (9, None, body), (None, "http://n", body),
        (6, "http://c", "short"), (7, "http://d", "short"), (8, "http://e", None), (10, "http://f", "WARC/1.1\r\n\r\n\r\nWARC-Type: x\r\n" * 9),
    ]
    pages = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id bigint, url string, html string, n long, digest string")
    folder = str(tmp_path / "out")
    warc.write(pages, folder)
    records = warc.read(spark, folder)
    assert records.count() == 3 * len(rows)
    got = warc.assemble(records).collect()
    assert len(got) == len(rows) and all(r["request"] is not None for r in got)
    facts = [dict(r["metadata"]["fields"]) for r in got]
    by = {(f.get("page-id"), r["type"], f.get("refers-to-page-id"), r["payload_bytes"], r["payload_digest"]) for f, r in zip(facts, got)}
    n, d = len(body.encode()), sha256(body.encode()).hexdigest()
    assert {("5", "revisit", "3", n, d), ("3", "response", None, n, d), ("9", "revisit", "3", n, d), (None, "response", None, n, d)} <= by
    assert sum(r["type"] == "response" for r in got) == 7
    payloads = {f.get("page-id"): r["payload"] for f, r in zip(facts, got) if r["type"] == "response"}
    assert bytes(payloads["10"]).decode() == rows[-1][2] and bytes(payloads["8"]) == b""
    ids = {r["record_id"] for r in got}
    assert len(ids) == len(rows) and all(r["refers_to"] in ids for r in got if r["type"] == "revisit")
    for name in glob.glob(f"{folder}/*.gz"):
        with gzip.open(name) as stream:
            for headers, block in warc.parse(stream):
                assert len(block) == int(headers["content-length"])


def test_captures_and_what_is_concurrent_to_them(spark):
    """Links of either side, several ids, both sides naming each other, repeats, unknown and null ids: a row per capture."""
    rows = [
        ("response", "a", None), ("request", "q1", "a"), ("request", "q2", "a"), ("metadata", "m1", "a"),
        ("response", "b", "q3 m2"), ("request", "q3", None), ("metadata", "m2", "b"),
        ("revisit", "c", None), ("metadata", "m3", "a  c"), ("request", "q4", "nowhere"), ("request", None, "c"),
        ("response", "d", None), ("response", "d", None), ("request", "q5", "d"), ("response", None, "q1"), ("warcinfo", "w", "a"),
    ]
    schema = warc.RECORD + ", requests string, url_note string"
    records = spark.createDataFrame([(t, i, "now", "u", c, None, "x", {"k": i or ""}, 1, "0", None, "e", "n") for t, i, c in rows], schema)
    got = warc.assemble(records).collect()
    found = sorted((r["record_id"] or "", [x["record_id"] for x in r["requests"]], [x["record_id"] for x in r["metadata_records"]]) for r in got)
    assert got[0]["url_note"] == "n" and found == [("", [], []), ("a", ["q1", "q2"], ["m1", "m3"]), ("b", ["q3"], ["m2"]), ("c", [None], ["m3"]), ("d", ["q5"], []), ("d", ["q5"], [])]
    first = {r["record_id"]: (r["request"], r["metadata"]) for r in got}
    assert first["a"][0]["fields"] == {"k": "q1"} and first["d"][1] is None and first[None] == (None, None)
    assert warc.fields(iter([b"WARC-Concurrent-To: <x>\r\n", b"warc-concurrent-to: <y>\r\n", b"\r\n"])) == {"warc-concurrent-to": "<x> <y>"}


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    warc.write(pages, str(tmp_path / "none"))
    assert warc.assemble(warc.read(spark, str(tmp_path / "none"))).count() == 0


def test_op10_against_brute_force(spark, sf, texts):
    component, sizes = brute.components(texts)
    for r in QUERIES["op10_neardup"](spark, sf).collect():
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (sizes[i], component[i], component[i] == i)


def family(rng, n, changes, length=120):
    base = [f"t{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(changes + 1)):
            words[rng.randrange(length)] = f"u{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [192, 3])
def test_near_copies_in_groups(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(block)
    many = [t for n, c in ((30, 2), (30, 5), (20, 9), (2, 1), (2, 1), (2, 3)) for t in family(rng, n, c)]
    many += many[:25] + ["a b", "A  b", "c d", None, "", "a b c d e"]
    texts = dict(enumerate(many))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    component, sizes = brute.components(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: (sizes[i], component[i]) for i in texts}


def test_near_duplicate_edges(edges, empty):
    rows = neardup.near_duplicates(edges).collect()
    assert len(rows) == edges.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_shingles"] == 0 and by[1]["kept"] and by[None]["component_id"] is None and by[None]["kept"]
    assert by[5]["component_id"] == 4 and not by[5]["kept"]
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.deduplicate(edges)
    assert kept.columns == edges.columns and kept.count() == edges.count() - 2


def test_bayesian_bounds():
    table = neardup.least_agreement(0.85)
    assert list(table) == [32, 64, 96, 128, 160] and all(0 < k < m for m, k in table.items())
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**31, (4000, 160), dtype=np.uint32)
    near = np.where(rng.random(a.shape) < 0.85, a, a + 1)
    far = np.where(rng.random(a.shape) < 0.5, a, a + 1)
    assert len(neardup.plausible(a, near, table)) >= 3999 and len(neardup.plausible(a, far, table)) <= 1


def test_long_chains_become_one_component(spark):
    edges = [(bytes([0, k]), bytes([0, k + 1])) for k in range(60)] + [(b"\x01\x00", b"\x01\x01")]
    found = {bytes(r["node"]): bytes(r["root"]) for r in neardup.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert set(found.values()) == {b"\x00\x00", b"\x01\x00"} and len(found) == 61


def test_pipeline_against_plain_python(spark, sf, texts):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    good = {r["doc_id"] for r in QUERIES["op3_quality"](spark, sf).collect() if r["predicted"]}
    left = {i: t for i, t in texts.items() if i in good}
    component, _ = brute.components(left)
    left = {i: t for i, t in left.items() if component[i] == i}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    hits = brute.contamination(left, items)
    left = {i: t for i, t in left.items() if not (hits[i][1] > 0 and 20 * hits[i][1] >= hits[i][0])}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in rows} == set(left) and len(rows) == len(left)
    for r in rows:
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
        text = model.decode(r["ids"])
        assert model.encode(text, add_eos=True) == r["ids"] and sha256(text.encode()).hexdigest() == r["decoded_sha256"]
        assert not brute.pii(text)
        if not brute.pii(left[r["doc_id"]]) and "[" not in text:
            assert text == left[r["doc_id"]]


def test_stages_keep_columns_and_edges(spark, sf, edges):
    docs = edges
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == edges.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
    assert quality.STATISTICS and pii.KINDS and pieces.MARK and shared_folder


def test_short_payloads_and_null_ids_are_cut(spark, tmp_path):
    """Digests that have no owner are spread like those that have one, and captures keep ids of their own."""
    long = "x" * 200
    rows = [(i, f"u{i}", "short") for i in range(600)] + [(None, f"v{i}", long) for i in range(600)] + [(i, f"u{i}", long) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    plan = warc.plan_captures(pages)
    pieces = {r["payload"]: r["n"] for r in plan.groupBy("payload").agg(F.countDistinct("_piece").alias("n")).collect()}
    assert pieces["short"] > 1 and pieces[long] > 1
    warc.write(pages, str(tmp_path / "warc"))
    got = warc.assemble(warc.read(spark, str(tmp_path / "warc"))).collect()
    assert len(got) == len({r["record_id"] for r in got}) == len(rows)
    assert sum(r["type"] == "revisit" for r in got) == 4
