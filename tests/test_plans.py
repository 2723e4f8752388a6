"""Whole runs: properties that hold whatever the data."""

import pytest
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.operators import replies
from factgrade.plans import evaluate, generate, prepare
from factgrade.streaming.folder import grade_folder

ROWS = [
    (1, "p1", "Cats purr. Dogs bark.", "Cats purr. Dogs bark."),
    (2, "p2", "Rain is wet.", "Stones are hard. Rain is wet."),
    (3, "p3", "Ice is cold.", "I cannot say."),
    (4, "p2", "Rain is wet.", "Nothing of the kind."),
]
SCHEMA = "row_id bigint, prompt string, response string, generated_response string"


@pytest.fixture
def dataset(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def classifier():
    return lambda: lambda texts: [("LABEL_0", 0.99) if "cannot" in t else ("LABEL_5", 0.99) for t in texts]


def by_row(df):
    return {r["row_id"]: r for r in df.collect()}


def test_answer_equal_to_truth_scores_one(dataset):
    got = evaluate.evaluate(dataset.drop("generated_response"))
    assert {r["score"] for r in got.collect()} == {1.0}


def test_offline_run(spark, dataset):
    reference = prepare.prepare(dataset.where("row_id IN (1, 2)"), store="unused")
    got = by_row(evaluate.evaluate(dataset, reference, make_classifier=classifier()))
    assert got[1]["score"] == 1.0
    assert (got[2]["supported_claims"], got[2]["afg_k_gen"], got[2]["afg_k_gt"]) == (1, 2, 1)
    assert got[2]["score"] == pytest.approx(2 / 3)
    assert (got[3]["is_abstained"], got[3]["status"], got[3]["score"]) == (True, "refused", 0.0)
    assert got[3]["abstention_type"] == fixed.LABEL_MEANINGS[0]
    assert got[4]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_refusals_by_phrase(dataset):
    got = by_row(evaluate.evaluate(dataset, refusal_phrases=True))
    assert {i for i, r in got.items() if r["is_abstained"]} == {3}
    assert got[3]["status"] == "refused"


def test_prompts_without_reference_have_a_status(dataset):
    reference = prepare.prepare(dataset.where("row_id = 1"), store="unused")
    got = by_row(evaluate.evaluate(dataset, reference))
    assert {i: r["status"] for i, r in got.items()} == {1: "ok", 2: "no_reference", 3: "no_reference", 4: "no_reference"}
    assert got[2]["score"] == 0.0 and got[2]["error"]


def test_score_does_not_depend_on_the_layout(dataset):
    def scores(df):
        return {i: r["score"] for i, r in by_row(evaluate.evaluate(df)).items()}

    assert scores(dataset) == scores(dataset.repartition(7)) == scores(dataset.orderBy(F.desc("row_id")))


def splitter(broken=()):
    lead = len(fixed.SPLIT_USER.format(sentence=""))

    def make():
        def run(batch):
            if any(messages[-1]["content"][lead:] in broken for messages in batch):
                raise RuntimeError("overloaded")
            return ["- " + messages[-1]["content"][lead:] for messages in batch]

        return run

    return make


def yes_to_all(log=None):
    def make():
        def run(batch):
            if log:
                with open(log, "a") as f:
                    f.write("x" * len(batch))
            return [
                "Yes." if "Answer only" in m[-1]["content"] else '{"decisions": ["YES"]}' for m in batch
            ]

        return run

    return make


@pytest.mark.parametrize("one_call", [True, False])
def test_run_with_replies_is_resumed(spark, dataset, tmp_path, one_call):
    log = tmp_path / "calls"
    log.write_text("")
    options = dict(
        store=str(tmp_path / "store"),
        split_backend=splitter(),
        check_backend=yes_to_all(str(log)),
        make_classifier=classifier(),
        one_call=one_call,
    )
    first = by_row(evaluate.evaluate(dataset, **options))
    assert first[1]["supported_claims"] == (1 if one_call else 2)
    assert first[3]["gen_facts"] == []
    asked = log.read_text()
    assert len(asked) == (3 if one_call else 5)
    again = by_row(evaluate.evaluate(dataset, **options))
    assert log.read_text() == asked
    assert {i: r["score"] for i, r in first.items()} == {i: r["score"] for i, r in again.items()}


def test_failed_calls_do_not_support_and_are_counted(dataset, tmp_path):
    def failing():
        def run(batch):
            raise RuntimeError("429")

        return run

    got = by_row(
        evaluate.evaluate(dataset, store=str(tmp_path / "s"), split_backend=splitter(), check_backend=lambda: failing())
    )
    assert {r["score"] for r in got.values()} == {0.0}
    assert {r["status"] for r in got.values()} == {"call_failed"}
    assert {r["failed_calls"] for r in got.values()} == {1}


def test_failed_split_loses_only_its_sentence(dataset, tmp_path):
    derived = prepare.derive_facts(
        dataset.select("row_id", "response"), "response", str(tmp_path / "s"), splitter(broken=("Dogs bark.",))
    )
    got = {r["row_id"]: (r["facts"], r["failed_calls"]) for r in derived.collect()}
    assert sum(n for _, n in got.values()) >= 1
    assert "Dogs bark." not in got[1][0]


def test_facts_keep_their_order(spark, tmp_path):
    text = " ".join(f"Fact {i}." for i in range(30))
    df = spark.createDataFrame([(1, text), (2, text)], "row_id bigint, response string")
    got = prepare.prepare(df, str(tmp_path / "s"), splitter())
    for r in got.collect():
        assert r["response_facts"] == [f"Fact {i}." for i in range(30)]
        assert r["response_facts_count"] == 30


def test_mock_run_scores_zero(dataset, tmp_path):
    mock = replies.mock_backend()
    got = evaluate.evaluate(dataset, store=str(tmp_path / "s"), split_backend=mock, check_backend=mock).collect()
    assert len(got) == len(ROWS)
    assert {r["score"] for r in got} == {0.0}


def test_generate_keeps_columns_and_hides_failures(spark, tmp_path):
    values = [tuple([f"q{i}"] + ["x"] * 7 + [f"r{i}"]) for i in range(3)]
    schema = ", ".join(f"{c} string" for c in [*fixed.PERSONA_COLUMNS, "response"])
    df = spark.createDataFrame(values, schema)

    def make():
        def run(batch):
            if "q1" in batch[0][-1]["content"]:
                raise RuntimeError("bad key")
            return ["fine"]

        return run

    stored = replies.with_prompt_hash(generate.persona_prompts(df))
    replies.ask_pending(replies.distinct_prompts(stored), str(tmp_path / "s"), lambda: make(), batch=1)
    got = generate.generate(df, str(tmp_path / "s"), replies.mock_backend()).orderBy("prompt").collect()
    assert [r["generated_response"] for r in got] == ["fine", None, "fine"]
    assert [r["reply_status"] for r in got] == ["ok", "permanent", "ok"]
    assert [r["response"] for r in got] == ["r0", "r1", "r2"]


def test_tasks_write_one_table_each(spark, tmp_path):
    schema = ", ".join(f"{c} string" for c in fixed.PERSONA_COLUMNS)
    df = spark.createDataFrame([tuple(f"{c} {i}" for c in fixed.PERSONA_COLUMNS) for i in range(3)], schema)
    solved = df.limit(1).withColumn("response", F.lit("solved"))

    def backend_for(model):
        return lambda: lambda batch: [f"{model}: {len(messages)}" for messages in batch]

    tasks = [("host/a", "zero"), ("host/a", "few"), ("b", "zero")]
    written = generate.run_tasks(df, tasks, str(tmp_path / "store"), backend_for, str(tmp_path / "out"), solved)
    assert list(written) == tasks
    assert written["host/a", "few"].startswith(f"{tmp_path}/out/host%2Fa_few_generated_responses_")
    replies_ = {k: {r["generated_response"] for r in spark.read.parquet(p).collect()} for k, p in written.items()}
    assert replies_ == {tasks[0]: {"host/a: 2"}, tasks[1]: {"host/a: 4"}, tasks[2]: {"b: 2"}}
    with pytest.raises(ValueError, match="unknown context"):
        generate.run_tasks(df, [("b", "many")], "s", backend_for, "o")


def test_stream_grades_each_file_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()

    def run():
        grade_folder(
            spark,
            str(inbox),
            "prompt string, response string",
            lambda b: b.select("prompt", "source_file", F.length("response").alias("n")),
            str(tmp_path / "out"),
            str(tmp_path / "state"),
            files_per_batch=1,
        )
        return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("prompt", "source_file", "n").collect())

    (inbox / "a.csv").write_text('prompt,response\np,"x\ny"\nq,NA\n')
    (inbox / "b.CSV").write_text("prompt,response\nr,abc\n")
    first = run()
    assert first == [("p", "a.csv", 3), ("q", "a.csv", None), ("r", "b.CSV", 3)]
    assert run() == first
    (inbox / "c.csv").write_text("prompt,response\ns,abcd\n")
    assert run() == first + [("s", "c.csv", 4)]
