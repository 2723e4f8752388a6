"""Collocations, the audit of filters, and sharding."""

import math
import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from llm import brute
from pyspark.sql import functions as F

from factgrade.llm import collocations, filteraudit, sharding
from factgrade.llm.automata import Automaton
from factgrade.llm.queries import op13_sharding


def phrases(rows, best=2000, least=30):
    """The contract of the collocations in plain Python."""
    counts = defaultdict(Counter)
    for text, lang in rows:
        low = brute.re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in brute.re.split("[.,;:!?\x0a-\x0d]", low):
            w = brute.re.findall("[^\x20\x09]+", piece)
            for n in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = defaultdict(int)
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    covered[p[i : i + m]] = max(covered[p[i : i + m]], a)
        rows = []
        for p, a in candidates.items():
            if 100 * covered[p] < 80 * a:
                s, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-s, -a, " ".join(p).encode(), l, r))
        total = sum(n for p, n in f.items() if len(p) == 1)
        out += [(lang, i, p.decode(), -a, l, r, total, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:best], 1)]
    return sorted(out)


def found(df, **how):
    return sorted(tuple(r) for r in collocations.best_phrases(df, **how).collect())


def test_collocations_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 700)
    rng = random.Random(5)
    vocabulary = ["the", "of", "Ärger", "日本", "x\x00y", "a-b", "'", "\x85", "ZEBRA", "new", "york", "city"]
    rows = []
    for i in range(250):
        words = rng.choices(vocabulary, [30, 20, 5, 5, 3, 3, 3, 2, 2, 9, 9, 9], k=rng.randrange(60))
        gaps = rng.choices([" ", "  ", "\t", ", ", "\n", ".", ";"], [20, 2, 2, 1, 1, 1, 1], k=len(words))
        rows.append(("".join(w + g for w, g in zip(words, gaps)), rng.choice(["en", "en", "de", None, "und", ""])))
    rows += [(None, "en"), ("", None), ("new york city " * 400, "en"), ("one " * 5000, "xx")]
    df = spark.createDataFrame([(i % 7, t, g, [1]) for i, (t, g) in enumerate(rows)], "doc_id bigint, text string, lang string, phrase array<int>")
    expected = phrases(rows)
    assert len(expected) > 40
    assert found(df) == expected
    assert found(df, best=3) == [r for r in expected if r[1] <= 3]


def test_table_of_cells_never_rules_out_what_counts(spark, monkeypatch):
    """With so few cells that all are full, the results are the same."""
    monkeypatch.setattr(collocations, "RANGE_CELLS", 8)
    monkeypatch.setattr(collocations, "LEAST_BITS", 4)
    monkeypatch.setattr(collocations, "MOST_BITS", 4)
    rows = [(f"alpha beta gamma w{i % 40} delta", "en") for i in range(300)]
    assert found(spark.createDataFrame(rows, "text string, lang string")) == phrases(rows)


def test_collocations_of_edge_cases(edges, empty):
    rows = [(t, "en") for _, t in [(r["doc_id"], r["text"]) for r in edges.collect()]]
    assert found(edges) == phrases(rows)
    assert found(empty) == []


def test_automata():
    rng = random.Random(1)
    shards = [Counter(tuple(rng.choices([b"a", b"b", b"c", b"\x00"], k=rng.randrange(1, 5))) for _ in range(200)) for _ in range(5)]
    built = [Automaton.build(sorted(s.items())) for s in shards]
    for shard, automaton in zip(shards, built):
        assert list(automaton.phrases()) == sorted(shard.items())
        assert list(Automaton.load(automaton.dump()).phrases()) == sorted(shard.items())
        assert len(set(automaton.arcs)) == len(automaton.arcs)  # equal states are one
    total = sum(shards, Counter())
    assert list(Automaton.union(built).phrases()) == sorted(total.items())
    kept = {p: n for p, n in total.items() if n >= 9}
    assert {p: n for p, n in Automaton.union(built, 9).phrases() if n >= 9} == kept
    asked = sorted({*rng.sample(sorted(total), 20), (b"zz",), (b"a", b"zz")})
    requests = Automaton.build((p, 1) for p in asked)
    assert list(Automaton.union(built).compose(requests)) == [(p, total.get(p, 0)) for p in asked]
    assert list(Automaton.build([]).phrases()) == []


def audited(rows, labels):
    """The audit by running every order over every document."""
    lowest = defaultdict(list)
    for i, text, _ in rows:
        if i is not None:
            lowest[text or ""].append(i)
    docs = []
    for i, text, lang in rows:
        text = text or ""
        w = brute.re.findall("[^\x20\x09-\x0d]+", text)
        failing = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(brute.re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(brute.re.search("[#$%&*|]", text)),
            "E": i is not None and i > min(lowest[text]),
        }
        mine = [(q, t) for j, q, t in labels if j == i and i is not None]
        docs.append((lang or "", {f for f in failing if failing[f]}, any(q == 1 for q, _ in mine), any(t == 1 for _, t in mine)))
    out = []
    for part in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == part]
        shapley, rows = Counter(), []
        for order in permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                gone = [d for d in here if f in d[1] and d not in removed and d[1] & set(order[: step - 1])]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(removed)
                only = sum(d[1] == {f} for d in here)
                rows.append((part, "".join(order), step, len(left), len(removed), len(gone), only, sum(d[2] for d in removed), sum(d[3] for d in removed)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


def test_audit_against_every_order(spark):
    rng = random.Random(3)
    texts = [None, "", "a " * 250, "One two", "x # y", " ".join(f"w{i}" for i in range(300)), " ".join(f"W{i}" for i in range(250)), "\x85 é\x0b b"]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(60)]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (5, 1, 1), (5, 1, 1), (9, 1, 1)]
    docs = spark.createDataFrame([(*r, 0.5, [1]) for r in rows], "doc_id bigint, text string, lang string, failed double, part array<int>")
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    sets = filteraudit.failed_sets(docs, table)
    assert sorted(tuple(r) for r in filteraudit.audit(sets).collect()) == audited(rows, labels)
    assert filteraudit.audit(filteraudit.failed_sets(docs.where("false"), table)).count() == 0
    assert filteraudit.failed_sets(docs, table.where("false")).agg(F.sum("good")).first()[0] == 0


def test_paths_through_the_lattice():
    for k in (1, 3, 5):
        reaching, leaving = filteraudit.path_counts(k)
        for state in range(2**k):
            size = state.bit_count()
            assert (reaching[state], leaving[state]) == (math.factorial(size), math.factorial(k - size))
    with pytest.raises(ValueError):
        filteraudit.audit(None, "ABCDEFGH")


def test_audit_of_other_filters(spark):
    sets = spark.createDataFrame([("p", 1, 4, 1, 0), ("p", 3, 2, 0, 1), ("p", 0, 5, 0, 0), ("p", 1, 1, 0, 0)], "part string, failed int, n bigint, good bigint, toxic bigint")
    got = {(r["filter_order"], r["step"]): tuple(r)[3:] for r in filteraudit.audit(sets, "XY").collect()}
    assert got[("XY", 1)] == (5, 7, 0, 5, 1, 1, 12)
    assert got[("YX", 1)] == (10, 2, 0, 0, 0, 1, 2)
    assert got[("XY", 2)] == (5, 0, 2, 0, 0, 0, 2)
    assert got[("YX", 2)] == (5, 5, 2, 5, 1, 0, 12)


@pytest.mark.parametrize(("good", "total", "n"), [(3, 10, 4), (50, 200, 120), (1, 1, 1), (0, 5, 3), (5, 5, 3), (900, 16000, 8000), (7, 100, 0)])
def test_hypergeometric_draw(spark, good, total, n):
    """Over an even grid of u every count comes up as often as its probability says."""
    grid = 5000
    args = [F.lit(x).cast("bigint") for x in (good, total, n)]
    drawn = spark.range(grid).select(sharding.hypergeometric(*args, (F.col("id") + 0.5) / grid).alias("x"))
    counts = Counter(r["x"] for r in drawn.collect())
    assert set(counts) <= set(range(max(0, n + good - total), min(n, good) + 1))
    for k in range(good + 1):
        share = math.comb(good, k) * math.comb(total - good, n - k) / math.comb(total, n) if n >= k else 0
        assert abs(counts[k] / grid - share) < 2.5 / grid


def test_matrix_has_its_margins(spark):
    sizes = [5, 0, 17, 1, 300, 2, 40]
    parts = spark.createDataFrame([(i * 3, n) for i, n in enumerate(sizes) if n], "part bigint, n bigint")
    rows = {r["part"]: r["counts"] for r in sharding.communication_matrix(parts, 4, 9).collect()}
    assert {p: sum(c) for p, c in rows.items()} == {i * 3: n for i, n in enumerate(sizes) if n}
    columns = [sum(c) for c in zip(*rows.values())]
    assert sum(columns) == sum(sizes) and max(columns) - min(columns) <= 1


def check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("bucket", [65_536, 4])
def test_shards_are_exact(spark, edges, empty, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    many = edges.withColumn("Shard", F.lit("old")).unionByName(edges.withColumn("Shard", F.lit("x"))).unionByName(edges.withColumn("Shard", F.lit("y")))
    got = sharding.shuffle(many, 4, seed=2)
    assert got.columns == [*edges.columns, "shard", "slot"]
    rows = got.collect()
    check_shards(rows, 4)
    assert sorted(str(tuple(r)[:-2]) for r in rows) == sorted(str(tuple(r)) for r in many.drop("Shard").collect())
    assert sharding.shuffle(empty, 4).collect() == []
    check_shards(sharding.shuffle(edges, 100).collect(), 100)


def test_shuffle_is_uniform(spark):
    """Where a row lands doesn't depend on where it stood: 600 rows in unequal parts, five seeds."""
    df = spark.range(0, 400, 1, 1).union(spark.range(400, 600, 1, 3))
    shards, slots = np.zeros((12, 3)), np.zeros((12, 4))
    for seed in range(5):
        for r in sharding.shuffle(df, 3, seed).collect():
            shards[r["id"] // 50, r["shard"]] += 1
            slots[r["id"] // 50, r["slot"] // 50] += 1
    # Degrees of freedom with fixed margins, and five standard deviations.
    for seen in (shards, slots):
        expected = 250 / seen.shape[1]
        chi, free = ((seen - expected) ** 2 / expected).sum(), 11 * (seen.shape[1] - 1)
        assert chi < free + 5 * math.sqrt(2 * free)
        assert chi > free / 4  # nor is it evened out


def test_sharding_query(spark, sf, texts):
    import zlib

    rows = op13_sharding(spark, sf).collect()
    check_shards(rows, 16)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)


def test_written_shards_keep_their_order(spark, tmp_path):
    path = sharding.write_shards(sharding.shuffle(spark.range(200), 3), str(tmp_path / "shards"))
    check_shards(spark.read.parquet(path).collect(), 3)
