"""Queries that write files, call a model function or run a stream.

Model functions here are deterministic stand-ins, so that results can be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.catalogue import tables as t
from factgrade.functions import facts as fx
from factgrade.functions import prompts as px
from factgrade.operators import clean, replies, verify
from factgrade.plans import evaluate as ev
from factgrade.plans import generate as gen
from factgrade.plans import prepare as prep
from factgrade.sources import examples, storage
from factgrade.sources import tables as src
from factgrade.streaming.folder import grade_folder


def _listed(df: DataFrame, column: str, name: str = "facts"):
    return F.array_join(column, " | ").alias(name)


def _long(c):
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


# Files


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared pairs written as CSV, lists as JSON text, and read back."""
    df = clean.add_facts(t.pairs(spark, sf), fx.sentence_facts("response"))
    path = storage.write_table(df, storage.shared_folder(spark, "pairs") + ".csv", "csv")
    back = clean.clean_evaluation(src.read_dataset(spark, path))
    return back.select(
        _long("row_id").alias("row_id"),
        "prompt",
        "response",
        "generated_response",
        _listed(back, "response_facts"),
        _long("response_facts_count").alias("n_facts"),
    )


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared pairs written as JSON Lines and read back; lists stay lists."""
    df = clean.add_facts(t.pairs(spark, sf), fx.sentence_facts("response"))
    path = storage.write_table(df, storage.shared_folder(spark, "pairs") + ".jsonl", "json")
    back = clean.clean_evaluation(src.read_dataset(spark, path))
    return back.select(
        "row_id",
        "prompt",
        "response",
        "generated_response",
        _listed(back, "response_facts"),
        _long("response_facts_count").alias("n_facts"),
    )


def _text_files(df: DataFrame, key: str, value: Column, name: str, per_file: int = 5000) -> str:
    """One text file per ``per_file`` rows or so; ``value`` aggregates the rows of a file to its text."""
    files = 1 + df.count() // per_file
    grouped = df.groupBy(F.pmod(F.xxhash64(key), F.lit(files)).alias("file")).agg(value.alias("value"))
    path = storage.shared_folder(df.sparkSession, name)
    grouped.write.partitionBy("file").text(path + ".json")
    return path + ".json"


def json_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Files that each hold a JSON array of records, read as one table; lists stay lists."""
    df = t.pairs(spark, sf).select("row_id", "prompt", "response", fx.sentence_facts("response").alias("response_facts"))
    path = _text_files(df, "row_id", F.to_json(F.collect_list(F.struct(*df.columns))), "arrays")
    back = clean.clean_evaluation(src.read_dataset(spark, path))
    return back.select("row_id", "prompt", "response", "generated_response", _listed(back, "response_facts"))


def few_shot_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the form {sentence: [facts]} read as the example table."""
    df = t.examples(spark, sf)
    pairs = F.map_from_entries(F.collect_list(F.struct("sentence", "facts")))
    back = examples.read_demos(spark, _text_files(df, "example_id", F.to_json(pairs), "examples"))
    return back.select("sentence", _listed(back, "facts"), _long(F.size("facts")).alias("n_facts"))


def folder_read(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files of one folder with different columns in different orders, numbers among words for "no value"."""
    df = t.pairs(spark, sf).select(F.col("row_id").alias("id"), "prompt", "response")
    score = F.when(F.col("id") % 7 == 0, "NA").otherwise((F.col("id") % 7 / 10).cast("string"))
    path = storage.shared_folder(spark, "folder")
    storage.write_table(df.where("id % 2 = 0"), path, "csv", mode="append")
    other = df.where("id % 2 = 1").select("response", score.alias("score"), "id", "prompt")
    storage.write_table(other, path, "csv", mode="append")
    back = src.read_folder(spark, path)
    return back.select("id", "prompt", "response", F.round(F.col("score") + 0.25, 6).alias("score"))


def results_written(spark: SparkSession, sf: str) -> DataFrame:
    """Results under a time-stamped name, with their summary text."""
    path = storage.write_results(t.results(spark, sf), storage.shared_folder(spark, "results"))
    return spark.read.parquet(path).select(
        "doc_id", "domain", "model", "is_abstained", F.round("score", 6).alias("score")
    )


def partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    """One stitched output per input file."""
    df = t.results(spark, sf).select("doc_id", "source_file", "supported_claims")
    path = storage.write_ready(df, storage.shared_folder(spark, "ready"))
    back = spark.read.parquet(path)
    return back.groupBy("ready_file").agg(
        F.count("*").alias("n_rows"), _long(F.sum("supported_claims")).alias("supported_claims")
    )


# Model stages


# Each of these returns a nested function, which Spark sends to the executors by value.


def _length_backend(patient: bool = False):
    """Replies with the length of the last message; unless patient, some lengths fail for now, some for good."""

    def make():
        def backend(batch):
            found = []
            for messages in batch:
                n = len(messages[-1]["content"])
                if n % 11 == 0 and not patient:
                    raise RuntimeError("503 overloaded")
                if n % 13 == 0 and not patient:
                    raise RuntimeError("bad key")
                found.append(f"- {n} characters")
            return found

        return backend

    return make


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    asked = t.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array(px.message("user", F.col("text"))).alias("messages")
    )
    return replies.with_prompt_hash(asked)


def reply_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct prompts through a model function that fails on some of them."""
    asked = _questions(spark, sf)
    got = storage.materialise(replies.ask(replies.distinct_prompts(asked), _length_backend(), parallel=4), "got")
    back = replies.join_replies(asked.select("conv_id", "turn", "prompt_hash"), got)
    return back.select("conv_id", "turn", "reply", "status")


def resume_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs on one reply store: the second asks only what failed for the moment."""
    asked = storage.materialise(_questions(spark, sf), "asked")
    prompts = replies.distinct_prompts(asked)
    path = storage.shared_folder(spark, "replies")
    replies.ask_pending(prompts, path, _length_backend(), parallel=4, commits=2)
    store = replies.ask_pending(prompts, path, _length_backend(patient=True), parallel=4)
    attempts = store.groupBy("prompt_hash").agg(F.count("*").alias("attempts"))
    best = replies.best_replies(store).join(attempts, "prompt_hash")
    content = prompts.select("prompt_hash", F.md5(F.element_at("messages", 1)["content"]).alias("content_digest"))
    return content.join(best, "prompt_hash", "left").drop("prompt_hash")


def _length_classifier():
    def make():
        return lambda texts: [(f"LABEL_{len(x) % 6}", 0.90 + (len(x) % 10) / 100) for x in texts]

    return make


def classify_stage(spark: SparkSession, sf: str) -> DataFrame:
    df = replies.classify(t.pairs(spark, sf), _length_classifier())
    flagged = verify.flag_refusals(
        df.select("row_id", F.col("classified.label").alias("label"), F.col("classified.score").alias("label_score"))
    )
    return flagged.select("row_id", "label", F.round("label_score", 6).alias("label_score"), "is_abstained")


# Whole runs


def prepare_offline(spark: SparkSession, sf: str) -> DataFrame:
    """Ground truths with their facts; the stand-in makes every sentence a fact."""
    df = prep.prepare(t.pairs_raw(spark, sf), storage.shared_folder(spark, "replies"))
    return df.select("row_id", "prompt", _listed(df, "response_facts"), _long("response_facts_count").alias("n_facts"))


def _outcome(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id",
        "is_abstained",
        "status",
        _long("supported_claims").alias("supported_claims"),
        _long("afg_k_gen").alias("k_gen"),
        _long("afg_k_gt").alias("k_gt"),
        F.round("score", 6).alias("score"),
    )


def evaluate_offline(spark: SparkSession, sf: str) -> DataFrame:
    """Answers graded against prepared facts without a model."""
    return _outcome(ev.evaluate(t.pairs(spark, sf), t.stored_prepared(spark, sf), make_classifier=_length_classifier()))


def _splitter():
    """Lists the sentence to split as its only fact."""
    lead = len(fixed.SPLIT_USER.format(sentence=""))

    def make():
        return lambda batch: ["- " + " ".join(messages[-1]["content"][lead:].split()) for messages in batch]

    return make


def _judge():
    """Says YES to every claim with an even number of characters."""

    def make():
        def backend(batch):
            found = []
            for messages in batch:
                part = messages[-1]["content"].split("Claims to Verify:\n    ")[1].split("\n\n    Return a JSON")[0]
                claims = [line.split(". ", 1)[1] for line in part.split("\n")]
                verdicts = ", ".join('"YES"' if len(c) % 2 == 0 else '"NO"' for c in claims)
                found.append(f'{{"decisions": [{verdicts}]}}')
            return found

        return backend

    return make


def evaluate_with_replies(spark: SparkSession, sf: str) -> DataFrame:
    """The whole grading run with examples, split and check replies and a reply store."""
    df = ev.evaluate(
        t.pairs(spark, sf),
        split_backend=_splitter(),
        check_backend=_judge(),
        make_classifier=_length_classifier(),
        examples=t.examples(spark, sf),
        parallel=4,
    )
    return _outcome(df)


def generate_mock(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of the mock backend for every persona row."""
    df = gen.generate(
        t.personas(spark, sf), storage.shared_folder(spark, "replies"), replies.mock_backend(), parallel=4
    )
    return df.select("row_id", "prompt", "response", "generated_response", "reply_status")


# Stream


def folder_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Result files graded as they arrive: two batches of files, then a run with nothing new."""
    work = storage.shared_folder(spark, "stream")
    schema = "row_id bigint, prompt string, response string, generated_response string"

    def grade(batch: DataFrame) -> DataFrame:
        done = ev.evaluate(batch)
        return done.select("row_id", _long("supported_claims").alias("supported"), F.round("score", 6).alias("score"))

    def run() -> None:
        grade_folder(spark, f"{work}/in", schema, grade, f"{work}/out", f"{work}/state", files_per_batch=3)

    rows = t.pairs(spark, sf).select("row_id", "prompt", "response", "generated_response")
    swapped = rows.select("generated_response", F.lit(0.9).alias("confidence"), "response", "row_id", "prompt")
    for half, df in enumerate((rows, swapped)):
        storage.write_table(df.where(F.col("row_id") % 2 == half), f"{work}/in", "csv", mode="append")
        run()
    run()
    return spark.read.parquet(f"{work}/out").select("row_id", "supported", "score")
