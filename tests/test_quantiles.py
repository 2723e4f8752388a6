"""Quantiles by selection, the confidence band, and reports from a state."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factgrade.operators import bootstrap, quantiles, report

PLACES = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def columns():
    rng = random.Random(4)
    return {
        "even": [rng.random() for _ in range(3000)],
        "hot": [rng.choice([1.0, 1.0, 1.0, rng.random()]) for _ in range(6000)],
        "steep": [math.exp(rng.uniform(-700, 700)) * rng.choice([-1, 1]) for _ in range(500)],
        "ends": [-1.7e308, 1.7e308, 0.0, -0.0, 5e-324, 1e-300, 1.7e308],
        "same": [2.5] * 900,
        "one": [7.0],
        "two": [1.0, 4.0],
        None: [float(i % 97) for i in range(800)],
    }


@pytest.mark.parametrize(("pivots", "few"), [(quantiles.PIVOTS, quantiles.FEW), (7, 2), (1, 300)])
def test_quantiles_against_numpy(spark, pivots, few):
    rows = [(g, v) for g, vs in columns().items() for v in [*vs, None, float("nan"), float("inf")]] + [("empty", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r for r in quantiles.exact_quantiles(df, "v", PLACES, ["g"], pivots=pivots, few=few).collect()}
    assert set(got) == set(columns())
    for g, values in columns().items():
        assert got[g]["n"] == len(values)
        if g != "ends":
            assert got[g]["quantiles"] == pytest.approx(list(np.quantile(np.array(values), PLACES)), rel=1e-12)
    assert got["ends"]["quantiles"][0] == -1.7e308 and got["ends"]["quantiles"][3] == sorted(columns()["ends"])[3]


def test_counted_values_are_repeated_ones(spark):
    counts = spark.createDataFrame([(float(v), n) for v, n in [(3, 5), (1, 2), (9, 1), (2, 0), (4, 40)]], "v double, n int")
    whole = [3.0] * 5 + [1.0] * 2 + [9.0] + [4.0] * 40
    got = quantiles.exact_quantiles(counts, "v", PLACES, count="n", pivots=1, few=1).first()
    assert got["n"] == 48 and got["quantiles"] == pytest.approx(list(np.quantile(whole, PLACES)))
    assert quantiles.exact_quantiles(counts.where("false"), "v", PLACES).count() == 0


def test_reports_of_many_values(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["m", "n", None]), "d", rng.choice([True, False, None]), rng.gauss(0, 1), 3, 2) for _ in range(500)]
    df = spark.createDataFrame(rows, "model string, domain string, is_abstained boolean, score double, afg_k_gen int, afg_k_gt int")

    def plain(frame):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in frame.collect()), key=str)

    for by in (None, ["model"], ["model", "domain"]):
        assert plain(report.summary(df, by, many=True)) == plain(report.summary(df, by))
    assert plain(report.boxplot(df.where("model is not null"), many=True)) == plain(report.boxplot(df.where("model is not null")))
    assert plain(report.outliers(df.where("model is not null"), many=True)) == plain(report.outliers(df.where("model is not null")))


def test_state_of_parts_gives_the_reports_of_the_whole(spark):
    rng = random.Random(8)
    kinds = ["refusal", "other", None]
    rows = []
    for _ in range(400):
        flag = rng.choice([True, False, False, None])
        facts = (None, None) if flag is None else (rng.choice([1, 2, 5]), rng.choice([0, 3, 4]))
        score = rng.choice([None, *[i / 8 for i in range(9)]])
        rows.append((rng.choice(["m", "n"]), rng.choice(["d", "e", None]), flag, rng.choice(kinds), score, *facts))
    schema = "model string, domain string, is_abstained boolean, abstention_type string, score double, afg_k_gen int, afg_k_gt int"
    parts = [spark.createDataFrame(rows[i : i + 90], schema) for i in range(0, 400, 90)]
    whole = spark.createDataFrame(rows, schema)
    states = report.report_state(parts[0])
    for part in parts[1:]:
        states = states.unionByName(report.report_state(part))

    def plain(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)

    expected = {
        "summary": report.summary(whole, ["model"]),
        "refusals": report.refusal_breakdown(whole),
        "domain_model_mean": report.domain_model_mean(whole),
        "boxplot": report.boxplot(whole),
        "outliers": report.outliers(whole),
        "regression": report.regression(whole),
    }
    got = report.reports_of_state(states)
    assert set(got) == set(expected)
    for name, df in expected.items():
        assert got[name].columns == df.columns
        assert plain(got[name]) == plain(df), name


def weights(key, replicates):
    out = []
    for b in range(-(-replicates // 4)):
        digest = hashlib.md5(f"{key}:{b}".encode()).hexdigest()
        for i in range(4):
            u, total, k, chance = int(digest[i * 8 : i * 8 + 8], 16) / 2**32, 0.0, 0, math.exp(-1)
            while True:
                total += chance
                if u < total or 1 - total < 2**-32:
                    break
                k += 1
                chance /= k
            out.append(k)
    return out[:replicates]


def test_band_against_plain_python(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(6), rng.randrange(6), rng.random()) for i in range(80)] + [(90, None, 1, 0.5), (91, 1, 1, None)]
    df = spark.createDataFrame(rows, "row_id int, afg_k_gen int, afg_k_gt int, score double")
    sums = np.zeros((30, 5))
    for i, a, b, y in rows[:80]:
        x = a - b
        sums += np.outer(weights(i, 30), [1, x, y, x * x, x * y])
    n, sx, sy, sxx, sxy = sums.T
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    intercept = (sy - slope * sx) / n
    xs = [a - b for _, a, b, _ in rows[:80]]
    a, b = np.polyfit(xs, [r[3] for r in rows[:80]], 1)
    got = bootstrap.regression_band(df, replicates=30, points=5, level=0.9).orderBy("delta_k").collect()
    assert [r["delta_k"] for r in got] == pytest.approx(list(np.linspace(min(xs), max(xs), 5)))
    for r in got:
        at = intercept + slope * r["delta_k"]
        assert r["fitted"] == pytest.approx(b + a * r["delta_k"])
        assert (r["low"], r["high"]) == pytest.approx((np.quantile(at, 0.05), np.quantile(at, 0.95)))
        assert r["low"] < r["fitted"] < r["high"]
    assert sum(sum(weights(i, 100)) for i in range(500)) / 50_000 == pytest.approx(1, abs=0.02)


def test_no_line_no_band(spark):
    df = spark.createDataFrame([(1, 2, 1, 0.5), (2, 3, 2, 0.7)], "row_id int, afg_k_gen int, afg_k_gt int, score double")
    assert bootstrap.regression_band(df).count() == 0
    assert bootstrap.regression_band(df.where("false")).count() == 0
    assert bootstrap.replicate_lines(df, F.lit(1), F.col("score"), "row_id").count() == 0
