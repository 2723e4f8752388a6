"""Reports against values worked out by hand."""

import statistics

import pytest

from factgrade.operators import report, rows, stitch, verify

SCORES = [0.1, 0.25, 0.4, 0.8, 1.0, 0.0, 0.33]
SCHEMA = "model string, domain string, is_abstained boolean, score double, afg_k_gen int, afg_k_gt int"


@pytest.fixture(scope="module")
def results(spark):
    data = [("m", "d", False, s, 4, 2) for s in SCORES]
    data += [("m", None, True, 0.0, 0, 3), ("n", "d", None, 0.0, None, None), ("n", "e", False, 0.5, 1, 3)]
    return spark.createDataFrame(data, SCHEMA)


def test_summary(results):
    got = report.summary(results.where("model = 'm'")).first()
    assert (got["total"], got["refused"], got["answered"]) == (8, 1, 7)
    assert got["refusal_percent"] == 12.5
    assert got["mean_answered"] == pytest.approx(statistics.mean(SCORES))
    assert got["mean_all"] == pytest.approx(sum(SCORES) / 8)
    assert got["median_score"] == pytest.approx(0.33)
    assert (got["q1_score"], got["q3_score"], got["iqr_score"]) == pytest.approx((0.175, 0.6, 0.425))
    assert got["sd_score"] == pytest.approx(0.364345, abs=1e-6)
    assert (got["mean_delta_k"], got["mean_k_gen"], got["mean_k_gt"]) == (2.0, 4.0, 2.0)


def test_failed_rows_are_neither_refused_nor_answered(results):
    got = report.summary(results, ["model"]).where("model = 'n'").first()
    assert (got["total"], got["refused"], got["answered"]) == (2, 0, 1)
    assert got["mean_all"] == 0.25
    assert got["sd_score"] is None


def test_summary_of_nothing(results):
    got = report.summary(results.limit(0)).first()
    assert (got["total"], got["refused"], got["answered"]) == (0, 0, 0)
    assert got["mean_all"] is None
    assert "Rows: 0" in report.render(got)


def test_equal_scores_have_no_spread(spark):
    df = spark.createDataFrame([("m", "d", False, 1 / 3, 1, 1)] * 50, SCHEMA)
    assert report.summary(df).first()["sd_score"] == pytest.approx(0.0, abs=1e-7)


def test_boxplot_and_outliers(spark):
    scores = [0.0, 0.4, 0.5, 0.5, 0.6, 0.6, 0.7, 0.95, 0.95]
    df = spark.createDataFrame([("m", "d", False, s, 1, 1) for s in scores], SCHEMA)
    box = report.boxplot(df).first()
    assert (box["q1"], box["median"], box["q3"], box["n_rows"]) == (0.5, 0.6, 0.7, 9)
    assert (box["whisker_low"], box["whisker_high"], box["n_outliers"]) == (0.4, 0.95, 1)
    assert [(r["score"], r["n_rows"]) for r in report.outliers(df).collect()] == [(0.0, 1)]


def test_regression(spark):
    data = [("m", "d", False, s, d + 5, 5) for d, s in [(1, 0.2), (2, 0.3), (0, 0.5), (-1, 0.9)]]
    got = report.regression(spark.createDataFrame(data, SCHEMA)).first()
    assert (got["slope"], got["intercept"], got["n_rows"]) == (pytest.approx(-0.21), pytest.approx(0.58), 4)


def test_matrix(results):
    named = report.domain_model_matrix(results, ["m", "n"])
    found = report.domain_model_matrix(results)
    assert named.columns == found.columns == ["domain", "m", "n"]
    got = {r["domain"]: (r["m"], r["n"]) for r in named.collect()}
    assert got == {"d": (pytest.approx(statistics.mean(SCORES)), 0.0), "e": (None, 0.5)}


def test_first_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id AS row_id", "if(id % 3 = 0, 'big', concat('f', id % 5)) AS source_file")
    first = rows.first_per_group(df, "source_file", "row_id", 4)
    assert first.where("source_file = 'big'").count() == 4
    assert first.count() == 24
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("p", 0.5, True)], "prompt string, score double, is_abstained boolean")
    b = spark.createDataFrame([("q", "failed", 0.0)], "prompt string, error string, score double")
    assert [tuple(r) for r in rows.union_all([a, b]).orderBy("prompt").collect()] == [
        ("p", 0.5, True, None),
        ("q", 0.0, None, "failed"),
    ]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_stitch(spark, limit):
    answers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "row_id int, prompt string")
    facts = [(9, "a", ["x"], 1), (5, "a", ["y", "z"], 2), (6, "a", ["x"], 1), (7, None, ["n"], 1)]
    reference = spark.createDataFrame(facts, "row_id int, prompt string, response_facts array<string>, response_facts_count int")

    def found(**options):
        df = stitch.stitch(answers, reference, limit=limit, **options)
        assert df.columns == ["prompt", "row_id", "response_facts", "response_facts_count"]
        return sorted((r["row_id"], r["response_facts"] or [], r["response_facts_count"]) for r in df.collect())

    assert found() == [(1, ["y", "z"], 2), (2, [], None), (3, ["y", "z"], 2), (4, [], None)]
    three = [(["x"], 1), (["x"], 1), (["y", "z"], 2)]
    assert found(keep_duplicates=True) == [
        *[(1, *f) for f in three],
        (2, [], None),
        *[(3, *f) for f in three],
        (4, [], None),
    ]
    ready = stitch.stitch(answers, reference, limit=limit)
    assert stitch.stitch(ready, reference) is ready


def test_match_reference_strategies_agree(spark):
    docs = [(i, ["common", f"s{i % 7}", f"own {i}"] if i % 2 else [f"own {i}"]) for i in range(60)]
    answers = spark.createDataFrame(docs, "doc_id int, gen_facts array<string>")
    items = [(i, ["common", f"s{i}"]) for i in range(3, 7)] + [(2, ["s3", "s5"])]
    references = spark.createDataFrame(items, "item_id int, gt_facts array<string>")

    def found(limit):
        df = verify.match_reference(answers, references, limit=limit)
        return sorted((r["doc_id"], r["item_id"], tuple(sorted(r["quoted"]))) for r in df.collect())

    broadcast = found(1 << 20)
    assert broadcast == found(0)
    for (doc, item, quoted), (_, facts) in zip(broadcast, docs):
        shared = [i for i, gt in items if set(gt) & set(facts)]
        assert item == (min(shared) if shared else None)
        assert set(quoted) == {f for f in facts if any(f in gt for _, gt in items)}
