"""The same results when nothing may be broadcast and hot keys are spread."""

import pytest
from test_oracle import ORACLE, QUERIES, canonical, duck  # noqa: F401

from factgrade.operators import retrieve, skew

NAMES = ["stitch_facts", "stitch_duplicates", "bm25_top3", "prompt_dedupe", "verify_exact", "evaluate_offline"]


@pytest.fixture
def large(monkeypatch, spark):
    """Pretend every table is large, look at all rows for hot keys and call keys hot early."""
    salted, weights, found = skew.salted_join, retrieve.term_weights, []

    def hot_keys(*args, original=skew.hot_keys, **kwargs):
        hot = original(*args, **kwargs)
        found.append(hot is not None)
        return hot

    monkeypatch.setattr(skew, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(skew, "MIN_SAMPLED", 2)
    monkeypatch.setattr(skew, "HOT_FACTOR", 0.1)
    monkeypatch.setattr(skew, "hot_keys", hot_keys)
    monkeypatch.setattr(skew, "salted_join", lambda a, b, k, how="left": salted(a, b, k, how, fraction=1.0))
    monkeypatch.setattr(
        retrieve, "term_weights", lambda *a, **k: retrieve.Weights(weights(*a, **k).table, small=False)
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield found
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_large_path(spark, sf, duck, large, name):  # noqa: F811
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    order = [[d[0] for d in result.description].index(c) for c in columns]
    expected = canonical([[r[i] for i in order] for r in result.fetchall()])
    assert canonical([[r[c] for c in columns] for r in df.collect()]) == expected
    assert large


def test_hot_keys_occur(spark, sf, large):
    assert QUERIES["bm25_top3"](spark, sf).count() > 0
    assert any(large)
