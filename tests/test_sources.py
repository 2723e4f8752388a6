"""Files in, files out."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.operators import clean
from factgrade.sources import examples, storage, tables

CSV = (
    'prompt,response,confidence\n'
    '"Who, me?","He said ""no"".\nThen left.",0.5\n'
    'NA,"N/A",1\n'
    '"plain",None,\n'
)


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "one.CSV"
    path.write_text(CSV)
    return str(path)


def test_csv(spark, csv_file):
    df = tables.read_dataset(spark, csv_file)
    assert dict(df.dtypes)["confidence"] == "double"
    assert [tuple(r) for r in df.collect()] == [
        ("Who, me?", 'He said "no".\nThen left.', 0.5),
        (None, None, 1.0),
        ("plain", None, None),
    ]


def test_cleaning_drops_incomplete_rows(spark, csv_file):
    got = clean.clean_evaluation(tables.read_dataset(spark, csv_file)).collect()
    assert len(got) == 1
    assert got[0]["generated_response"] == got[0]["response"]


def test_json_lines_and_array(spark, tmp_path):
    records = [{"prompt": "p", "response": "r", "response_facts": ["a", "b"]}, {"prompt": "q", "response": "s", "response_facts": []}]
    lines, array = tmp_path / "a.jsonl", tmp_path / "a.json"
    lines.write_text("\n".join(json.dumps(r) for r in records))
    array.write_text(json.dumps(records, indent=2))
    for path in (lines, array):
        got = clean.clean_evaluation(tables.read_dataset(spark, str(path))).orderBy("prompt").collect()
        assert [r["response_facts"] for r in got] == [["a", "b"], []]


def test_column_json_is_rejected(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps({"prompt": {"0": "p", "1": "q"}, "response": {"0": "r", "1": "s"}}))
    with pytest.raises(ValueError, match="by column"):
        tables.read_dataset(spark, str(path))


def test_bad_paths(spark, tmp_path):
    with pytest.raises(ValueError, match="no reader"):
        tables.read_dataset(spark, str(tmp_path / "a.xlsx"))
    with pytest.raises(FileNotFoundError):
        tables.read_dataset(spark, str(tmp_path / "a.csv"))


def test_required_columns(spark):
    with pytest.raises(ValueError, match="no column response"):
        clean.require_columns(spark.createDataFrame([("p",)], "prompt string"))
    with pytest.raises(ValueError, match="geoRegion"):
        clean.persona_only(spark.createDataFrame([("p",)], "prompt string"))


def test_folder(spark, tmp_path):
    (tmp_path / "eval_results_a.csv").write_text('prompt,response\n"x\ny",1\nz,2\n')
    (tmp_path / "eval_results_b.CSV").write_text("prompt,response\nw,3\n")
    (tmp_path / "notes.txt").write_text("not a table")
    df = tables.with_source_id(tables.read_folder(spark, str(tmp_path)))
    got = df.orderBy("source_file", "row_id").collect()
    assert [(r["prompt"], r["model"]) for r in got] == [("x\ny", "a"), ("z", "a"), ("w", "b.CSV")]
    assert len({r["row_id"] for r in got}) == 3


def test_examples(spark, tmp_path):
    path = tmp_path / "demos.json"
    path.write_text(json.dumps({"First one.": ["a", "b"], "Second é.": ["c"]}, indent=1))
    got = examples.read_demos(spark, str(path)).orderBy("example_id").collect()
    assert [tuple(r) for r in got] == [(0, "First one.", ["a", "b"]), (1, "Second é.", ["c"])]


def test_few_shot(spark, tmp_path):
    row = {c: f"{c} value" for c in fixed.PERSONA_COLUMNS} | {"response": "answer", "extra": 1}
    path = tmp_path / "few.json"
    path.write_text(json.dumps([row, row | {"prompt": "second"}]))
    shown = examples.shown_messages(examples.read_few_shot(spark, str(path))).first()["shown"]
    assert [m["role"] for m in shown] == ["user", "assistant"] * 2
    assert shown[0]["content"].startswith("prompt: prompt value\ntargetAgeGroup: ")
    assert shown[1]["content"] == "response: answer\n"
    assert shown[2]["content"].startswith("prompt: second\n")


def test_csv_round_trip_keeps_text(spark, tmp_path):
    rows = [(1, ' lead "q", \n\n tail ', ["a", 'b "c"']), (2, "", []), (3, None, None)]
    df = spark.createDataFrame(rows, "row_id int, text string, facts array<string>")
    path = storage.write_table(df, str(tmp_path / "t.csv"), "csv")
    back = tables.read_csv(spark, path, "row_id int, text string, facts string")
    got = clean.read_fact_column(back, "facts").orderBy("row_id").collect()
    assert [tuple(r) for r in got] == [(1, rows[0][1], rows[0][2]), (2, None, []), (3, None, [])]


def test_results_and_summary(spark, tmp_path):
    rows = [(True, "kind", 0.0, 0, 2), (False, None, 0.5, 3, 2), (None, None, 0.0, None, None)]
    df = spark.createDataFrame(rows, "is_abstained boolean, abstention_type string, score double, afg_k_gen int, afg_k_gt int")
    when = datetime(2020, 1, 2, 3, 4, 5)
    path = storage.write_results(df, str(tmp_path / "r"), when=when)
    assert path.endswith("r_20200102_030405")
    text = "\n".join(r["value"] for r in spark.read.text(path + "_summary").collect())
    assert "Rows: 3" in text and "Refused: 1 (33.33%)" in text and "kind: 1" in text and "Answered: 1" in text
    assert storage.write_results(df.limit(0), str(tmp_path / "none"), when=when) is None
    assert not (tmp_path / "none_20200102_030405").exists()


def test_ready_files(spark, tmp_path):
    df = spark.createDataFrame([("a.csv", 1), ("b.csv", 2)], "source_file string, v int")
    storage.write_ready(df, str(tmp_path / "ready"))
    assert sorted(p.name for p in (tmp_path / "ready").glob("ready_file=*")) == [
        "ready_file=a_ready.csv",
        "ready_file=b_ready.csv",
    ]
    assert storage.reference_path("x/a.csv") == "x/a_reference.csv"


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_folder(spark, "t").startswith(f"{base}/t-")
    assert storage.shared_folder(spark, "t") != storage.shared_folder(spark, "t")
    stored = storage.materialise(spark.range(3).select(F.col("id")), "ids")
    assert stored.inputFiles()[0].startswith(f"file://{base}/ids-")
