"""The reply table: failures are data, nothing is asked twice."""

import uuid

import pytest
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions.prompts import message
from factgrade.operators import replies


@pytest.fixture
def asked(spark):
    texts = ["a", "b", "c", "a", "a", "down", "bad", None]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string").where("text IS NOT NULL")
    return replies.with_prompt_hash(df.select("row_id", F.array(message("user", F.col("text"))).alias("messages")))


def backend(log, down=True):
    """Writes every prompt it gets to a folder, so that the test can count calls."""

    def make():
        def run(batch):
            out = []
            for messages in batch:
                content = messages[-1]["content"]
                with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                    f.write(content)
                if content == "down" and down:
                    raise RuntimeError("503 overloaded")
                if content == "bad":
                    raise RuntimeError("no such key")
                out.append(content.upper() if content != "c" else None)
            return out

        return run

    return make


def calls(log):
    return sorted(p.read_text() for p in log.iterdir())


def test_run_and_resume(spark, asked, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()
    prompts = replies.distinct_prompts(asked)
    assert prompts.count() == 5

    replies.ask_pending(prompts, store, backend(log), batch=1)
    assert calls(log) == ["a", "b", "bad", "c", "down"]
    back = {r["row_id"]: (r["reply"], r["status"]) for r in replies.join_replies(asked, replies.read_store(spark, store)).collect()}
    assert back[0] == back[3] == back[4] == ("A", "ok")
    assert back[2] == ("", "missing")
    assert back[5] == ("ERROR: 503 overloaded", "temporary")
    assert back[6] == ("ERROR: no such key", "permanent")

    replies.ask_pending(prompts, store, backend(log, down=False), batch=1, commits=3)
    assert calls(log).count("down") == 2
    assert calls(log).count("a") == 1
    assert calls(log).count("bad") == 1
    assert calls(log).count("c") == 2
    best = {r["reply"] for r in replies.best_replies(replies.read_store(spark, store)).collect()}
    assert "DOWN" in best

    n = len(calls(log))
    replies.ask_pending(prompts.where("element_at(messages, 1).content <> 'c'"), store, backend(log), batch=1)
    assert len(calls(log)) == n


def test_wrong_number_of_replies_is_a_failure(spark, asked):
    got = replies.ask(replies.distinct_prompts(asked), lambda: lambda batch: ["x"] * (len(batch) + 1)).collect()
    assert {r["status"] for r in got} == {"temporary"}


def test_one_bad_prompt_leaves_its_batch_alone(spark, asked, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    got = replies.ask(replies.distinct_prompts(asked).coalesce(1), backend(log), batch=16).collect()
    assert sorted(r["status"] for r in got) == ["missing", "ok", "ok", "permanent", "temporary"]


def test_rounds_ask_again_what_failed_for_the_moment(spark, asked, tmp_path):
    log = str(tmp_path)

    def make():
        def run(batch):
            import os

            for messages in batch:
                content, seen = messages[-1]["content"], f"{log}/{messages[-1]['content']}"
                if content == "down" and not os.path.exists(seen):
                    if len(batch) == 1:
                        open(seen, "w").close()
                    raise RuntimeError("503 overloaded")
            return ["fine"] * len(batch)

        return run

    prompts = replies.distinct_prompts(asked)
    store = replies.ask_pending(prompts, str(tmp_path / "store"), make, rounds=3)
    assert {r["status"] for r in replies.best_replies(store).collect()} == {"ok"}
    assert store.count() == prompts.count() + 1


def test_long_text_is_seen_whole(spark):
    texts = ["a" * 9000 + " no way", "a" * 4090 + " no way", "b" * 9000]
    df = spark.createDataFrame([(x,) for x in texts], "generated_response string").coalesce(1)

    def make():
        return lambda found: [("LABEL_0", 0.99) if "no way" in x else ("LABEL_5", 0.9) for x in found]

    assert [r["classified"]["label"] for r in replies.classify(df, make).collect()] == ["LABEL_0", "LABEL_0", "LABEL_5"]


def test_backend_that_cannot_start_fails_the_job(spark, asked):
    def make():
        raise RuntimeError("timed out")

    with pytest.raises(Exception, match="timed out"):
        replies.ask(replies.distinct_prompts(asked), make).collect()


def test_rows_without_reply_are_missing(spark, asked, tmp_path):
    store = replies.read_store(spark, str(tmp_path / "none"))
    got = replies.join_replies(asked, store).collect()
    assert len(got) == 7
    assert {r["status"] for r in got} == {"missing"}


def test_mock(spark, asked):
    assert {r["reply"] for r in replies.mock_replies(replies.distinct_prompts(asked)).collect()} == {fixed.MOCK_REPLY}


def test_classifier_sees_bounded_text_in_batches(spark):
    df = spark.createDataFrame([("x" * 5000,), (None,), ("ab",)], "generated_response string").coalesce(1)

    def make():
        def run(texts):
            assert len(texts) <= 2
            return [(f"LABEL_{len(t) % 6}", float(len(t))) for t in texts]

        return run

    got = [r["classified"] for r in replies.classify(df, make, batch=2).collect()]
    assert [(g["label"], g["score"]) for g in got] == [("LABEL_4", 4096.0), ("LABEL_0", 0.0), ("LABEL_2", 2.0)]


def test_classify_long_reads_whole_documents(spark, sf, monkeypatch):
    """The texts given to the classifier are the documents themselves, not prefixes of them."""
    from pyspark.sql import functions as F

    from factgrade.catalogue import cases

    seen = []
    classify = cases.replies.classify
    monkeypatch.setattr(cases.replies, "classify", lambda df, make: seen.append(df) or classify(df, make))
    cases.classify_long(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("length(text) > 5000 and doc_id % 3 = 0")
    both = docs.join(seen[0], "doc_id")
    assert both.count() > 0 and both.where(~F.col("generated_response").startswith(F.col("text"))).count() == 0
