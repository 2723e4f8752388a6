"""The bucketed reply store: layout, compaction, what a run reads."""

import os

import pytest
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions.prompts import message
from factgrade.operators import replies, replystore
from factgrade.plans.generate import generate


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def prompts(spark):
    df = spark.range(60).select(F.array(message("user", F.concat(F.lit("p"), F.col("id").cast("string")))).alias("messages"))
    return replies.distinct_prompts(df)


def echo():
    """A backend maker as a nested function, which travels to the executors by value."""
    return lambda: lambda batch: ["ERROR: 503" if m[-1]["content"].endswith("7") else m[-1]["content"] for m in batch]


def test_layout_and_reading(spark, prompts, tmp_path):
    path = str(tmp_path / "store")
    replies.ask_pending(prompts, path, echo(), commits=3)
    layout = replystore.current(spark, path)
    assert (layout.version, layout.shares, layout.buckets) == (0, 3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [replystore.read_share(spark, layout, s) for s in range(3)]
    assert sum(df.count() for df in shares) == 60
    for s, df in enumerate(shares):
        assert df.where(layout.share_of() != s).count() == 0
        assert all(f"/share={s}/" in f for f in df.inputFiles())


def test_pending_shuffles_no_store_row(spark, prompts, tmp_path):
    path = str(tmp_path / "store")
    replies.ask_pending(prompts, path, echo(), commits=1)
    layout = replystore.compact(spark, path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = replystore.read_share(spark, layout, 0)
        left = replies.pending(prompts, store)
        plan = left._jdf.queryExecution().executedPlan().toString()
        # The one exchange is that of the prompts; the store's side is a bucketed scan.
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") == prompts._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert plan.index("Exchange") < plan.index("Bucketed: true")
        assert left.count() == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_compaction_keeps_the_best_and_one_file_a_bucket(spark, prompts, tmp_path):
    path = str(tmp_path / "store")
    for _ in range(3):
        replies.ask_pending(prompts, path, echo(), commits=2)
    assert replies.read_store(spark, path).count() == 60 + 2 * 6
    best = rows_of(replies.best_replies(replies.read_store(spark, path)))
    layout = replystore.compact(spark, path)
    assert rows_of(replies.read_store(spark, path)) == best
    assert not os.path.exists(f"{path}/v0")
    assert len(replystore.read_share(spark, layout, 0).inputFiles()) <= layout.buckets
    other = replystore.compact(spark, path, shares=5, buckets=3)
    assert (other.version, other.shares, other.buckets) == (2, 5, 3)
    assert rows_of(replies.read_store(spark, path)) == best


def test_stopped_compaction_leaves_the_old_store(spark, prompts, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    replies.ask_pending(prompts, path, echo(), commits=2)
    best = rows_of(replies.best_replies(replies.read_store(spark, path)))

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(replystore, "declare", stop)
    with pytest.raises(KeyboardInterrupt):
        replystore.compact(spark, path)
    monkeypatch.undo()
    assert os.path.exists(f"{path}/v1") and replystore.current(spark, path).version == 0
    assert rows_of(replies.best_replies(replies.read_store(spark, path))) == best
    replystore.compact(spark, path)
    assert rows_of(replies.read_store(spark, path)) == best


def test_plain_files_are_taken_in(spark, prompts, tmp_path):
    path = str(tmp_path / "store")
    replies.mock_replies(prompts).write.parquet(path)
    store = replies.ask_pending(prompts, path, lambda: 1 / 0)  # never called: all is there
    assert store.count() == 60 and replystore.current(spark, path).version == 0


def test_many_files_are_compacted_by_themselves(spark, prompts, tmp_path, monkeypatch):
    monkeypatch.setattr(replystore, "FILES_PER_BUCKET", 1)
    path = str(tmp_path / "store")
    for _ in range(2):
        replies.ask_pending(prompts, path, echo(), commits=1)
    assert replystore.current(spark, path).version >= 1
    assert replies.read_store(spark, path).count() == 60


def test_no_store(spark, tmp_path):
    path = str(tmp_path / "none")
    assert replies.read_store(spark, path).count() == 0
    assert replystore.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        replystore.compact(spark, path)


def test_generation_asks_again_in_one_run(spark, tmp_path):
    """Every call fails once; with two rounds a single run ends with all answers."""
    log = str(tmp_path)

    def make():
        def run(batch):
            out = []
            for messages in batch:
                seen = f"{log}/{abs(hash(messages[-1]['content']))}"
                out.append("fine" if os.path.exists(seen) else "ERROR: 429 slow down")
                open(seen, "w").close()
            return out

        return run

    row = {c: c for c in fixed.PERSONA_COLUMNS}
    df = spark.createDataFrame([row | {"prompt": "one"}, row | {"prompt": "two"}])
    once = generate(df, str(tmp_path / "once"), make, rounds=1).collect()
    assert {r["reply_status"] for r in once} == {"temporary"}
    os.mkdir(f"{log}/again")
    log = f"{log}/again"
    twice = generate(df, str(tmp_path / "twice"), make, rounds=2).collect()
    assert [(r["reply_status"], r["generated_response"]) for r in twice] == [("ok", "fine")] * 2
