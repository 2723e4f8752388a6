"""Queries whose inputs hold the cases that are easily got wrong, with their SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.catalogue import stages
from factgrade.catalogue import tables as t
from factgrade.catalogue.oracle import ORACLE as PLAIN, PAIRS, PAIRS_RAW, f1, joined, sents, summary, with_
from factgrade.functions import budget
from factgrade.functions import facts as fx
from factgrade.operators import replies, report, verify
from factgrade.plans import evaluate as ev
from factgrade.plans import generate as gen
from factgrade.plans import prepare as prep
from factgrade.plans.report import read_results, report_tables
from factgrade.sources import examples, storage
from factgrade.sources import tables as src

PIECE_TOKENS = 120
WHEN = datetime(2020, 1, 2, 3, 4, 5)


def long(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def classify_long(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, some of which end in a refusal far beyond the classifier's window."""

    def make():
        return lambda texts: [("LABEL_0", 0.99) if "I cannot help." in x else ("LABEL_5", 0.98) for x in texts]

    late = F.concat("text", F.repeat(F.lit(" x"), 2500), F.lit(" I cannot help."))
    df = t.table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, late).otherwise(F.col("text")).alias("generated_response"))
    found = replies.classify(df, make).select("doc_id", F.col("classified.label").alias("label"), F.col("classified.score").alias("label_score"))
    return verify.flag_refusals(found).select("doc_id", "label", "is_abstained")


def breakdown_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The refusal lines of a summary with more types than the classifier has."""
    df = t.table(spark, sf, "documents").select(F.lit(True).alias("is_abstained"), F.col("source").alias("abstention_type"))
    return report.breakdown_text(df)


def two_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two answer files with equal row ids graded in one run."""
    df = t.pairs(spark, sf).select("row_id", "prompt", "response", "generated_response")
    own = df.withColumn("generated_response", F.col("response")).withColumn("source_file", F.lit("b.csv"))
    both = df.withColumn("source_file", F.lit("a.csv")).unionByName(own)
    got = ev.evaluate(both, split_backend=stages._splitter(), check_backend=stages._judge(), parallel=4)
    return got.select(
        "row_id", "source_file", long("supported_claims").alias("supported"), long("afg_k_gen").alias("k_gen"), F.round("score", 6).alias("score")
    )


def two_models(spark: SparkSession, sf: str) -> DataFrame:
    """Two models of the same short name answer the same questions; each answer is written and read back."""

    def named(model: str):
        return lambda: lambda batch: [model] * len(batch)

    work = storage.shared_folder(spark, "models")
    tasks = [("x/m", "zero"), ("y/m", "zero")]
    paths = gen.run_tasks(t.personas(spark, sf), tasks, f"{work}/store", named, f"{work}/out", parallel=4)
    parts = [spark.read.parquet(p).select("row_id", F.lit(m).alias("model"), "generated_response") for (m, _), p in paths.items()]
    return parts[0].unionByName(parts[1])


def report_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """Results of several models, each written by its own run, read back and summarised per model."""
    results = storage.materialise(t.results(spark, sf).withColumn("model", F.col("domain")), "results")
    folder = storage.shared_folder(spark, "runs")
    for r in results.select("model").distinct().collect():
        mine = results.where(F.col("model") == r["model"]).drop("model")
        storage.write_results(mine, f"{folder}/{fixed.RESULTS_PREFIX}{r['model']}", when=WHEN)
    table = report_tables(read_results(spark, folder))["summary"]
    return table.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in table.dtypes])


def prepared_written(spark: SparkSession, sf: str) -> DataFrame:
    """The prepared table written under its default name and read back."""
    df = prep.prepare(t.pairs_raw(spark, sf).select("row_id", "prompt", "response"), "")
    path = storage.write_prepared(df, storage.shared_folder(spark, "truth") + ".csv", form="csv")
    back = src.read_dataset(spark, path)
    return back.select(
        long("row_id").alias("row_id"), joined_list(fx.parse_facts("response_facts")).alias("facts"), long("response_facts_count").alias("n_facts")
    )


def joined_list(c) -> Column:
    return F.array_join(c, " | ")


def no_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Ground truths split by a model that is shown an empty example table."""
    none = t.examples(spark, sf).where("false")
    df = prep.prepare(t.pairs_raw(spark, sf), storage.shared_folder(spark, "replies"), stages._splitter(), none, parallel=4)
    return df.select("row_id", long("response_facts_count").alias("n_facts"))


def mock_check(spark: SparkSession, sf: str) -> DataFrame:
    """Claim-by-claim checking with the mock: every claim of an answer with reference facts is supported."""
    got = ev.evaluate(t.pairs(spark, sf), check_backend=replies.mock_yes(), one_call=False, parallel=4)
    return got.select("row_id", long("supported_claims").alias("supported"), long("afg_k_gen").alias("k_gen"))


def few_shot_file(spark: SparkSession, sf: str) -> DataFrame:
    """Solved persona rows written as JSON arrays and read as the few-shot table."""
    df = t.personas(spark, sf).select("row_id", *fixed.PERSONA_COLUMNS, "response")
    path = stages._text_files(df, "row_id", F.to_json(F.collect_list(F.struct(*[c for c in df.columns if c != "row_id"]))), "solved")
    back = examples.read_few_shot(spark, path)
    return back.select(*[F.col(c).alias(c) for c in ("prompt", "targetAgeGroup", "response")])


def fact_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Stored fact lists with text after the list, which makes them no lists."""
    text = F.to_json(F.array("text"))
    raw = F.when(F.col("item_id") % 3 == 0, text).when(F.col("item_id") % 3 == 1, F.concat(text, F.lit("] x"))).otherwise(F.concat(text, F.lit(" y")))
    return t.table(spark, sf, "benchmark").select("item_id", long(F.size(fx.parse_facts(raw))).alias("n_facts"))


def claim_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Where the sentences of each document are cut so that a prompt holds 120 tokens of them."""
    listed = t.documents(spark, sf).select("doc_id", fx.sentence_facts("text").alias("claims"))
    places = budget.cut_places(budget.line_tokens("claims"), PIECE_TOKENS)
    cut = listed.select("doc_id", F.posexplode(places).alias("piece", "place"))
    return cut.select(
        "doc_id", long("piece").alias("piece"), long("place.start").alias("first_claim"), long("place.n").alias("n_claims"), "place.tokens"
    )


def evaluate_in_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """The run with replies when no prompt may hold more than 200 tokens or two claims: counts are those of whole prompts."""
    df = ev.evaluate(
        t.pairs(spark, sf),
        split_backend=stages._splitter(),
        check_backend=stages._judge(),
        make_classifier=stages._length_classifier(),
        examples=t.examples(spark, sf),
        parallel=4,
        prompt_tokens=200,
        most_claims=2,
    )
    return stages._outcome(df)


QUERIES = {
    f.__name__: f
    for f in (
        classify_long, breakdown_lines, two_files, two_models, report_from_files, prepared_written, no_examples, mock_check, few_shot_file, fact_edges,
        claim_pieces, evaluate_in_pieces,
    )
}

_LISTS = f"""lists AS (
  SELECT row_id, 'a.csv' AS source_file, {sents('generated_response')} AS gen_facts, {sents('response')} AS gt_facts FROM pairs
  UNION ALL SELECT row_id, 'b.csv', {sents('response')}, {sents('response')} FROM pairs)"""
_YES = r"""CASE WHEN len(gt_facts) = 0 THEN 0 ELSE len(list_filter(gen_facts,
    lambda c: length(regexp_replace(c, '[\s\x0b]+', ' ', 'g')) % 2 = 0)) END"""

ORACLE = {
    "claim_pieces": f"""WITH RECURSIVE d AS (SELECT doc_id, unnest({sents('text')}) AS claim, generate_subscripts({sents('text')}, 1) AS i FROM documents),
s AS (SELECT doc_id, i, sum((octet_length(encode(claim)) + len(i::VARCHAR) + 3 + 3) // 4) OVER (PARTITION BY doc_id ORDER BY i) AS total FROM d),
p AS (SELECT doc_id, list(total::BIGINT ORDER BY i) AS totals FROM s GROUP BY doc_id),
r AS (SELECT doc_id, totals, 0 AS piece, 0 AS a, greatest(1, len([x for x in totals if x <= {PIECE_TOKENS}])) AS b FROM p
  UNION ALL SELECT doc_id, totals, piece + 1, b, greatest(b + 1, len([x for x in totals if x <= totals[b] + {PIECE_TOKENS}])) FROM r WHERE b < len(totals))
SELECT doc_id, piece::BIGINT AS piece, a::BIGINT AS first_claim, (b - a)::BIGINT AS n_claims, totals[b] - coalesce(totals[a], 0) AS tokens FROM r""",
    "evaluate_in_pieces": PLAIN["evaluate_with_replies"],
    "classify_long": """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'LABEL_0' ELSE 'LABEL_5' END AS label, doc_id % 3 = 0 AS is_abstained
FROM documents""",
    "breakdown_lines": """SELECT string_agg('  ' || source || ': ' || n, chr(10) ORDER BY n DESC, source) AS text
FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)""",
    "two_files": with_(PAIRS_RAW, PAIRS, _LISTS)
    + f"""SELECT row_id, source_file, s::BIGINT AS supported, k::BIGINT AS k_gen, round({f1('s', 'k', 'g')}, 6) AS score
FROM (SELECT row_id, source_file, {_YES} AS s, len(gen_facts) AS k, len(gt_facts) AS g FROM lists)""",
    "two_models": with_(PAIRS_RAW)
    + "SELECT row_id, model, model AS generated_response FROM pairs_raw, (VALUES ('x/m'), ('y/m')) v(model)",
    "report_from_files": summary("domain", "model"),
    "prepared_written": with_(PAIRS_RAW)
    + f"SELECT row_id, {joined(sents('response'))} AS facts, len({sents('response')}) AS n_facts FROM pairs_raw",
    "no_examples": with_(PAIRS_RAW) + f"SELECT row_id, len({sents('response')}) AS n_facts FROM pairs_raw",
    "mock_check": with_(PAIRS_RAW, PAIRS)
    + f"""SELECT row_id, CASE WHEN len({sents('response')}) > 0 THEN len({sents('generated_response')}) ELSE 0 END AS supported,
  len({sents('generated_response')}) AS k_gen FROM pairs""",
    "few_shot_file": with_(PAIRS_RAW, "p AS (SELECT * FROM pairs_raw)")
    + """SELECT prompt, (ARRAY['Under 18', '18-25', '26-45', '46-65', 'Over 65'])[conv_id % 5 + 1] AS "targetAgeGroup", response FROM p""",
    "fact_edges": "SELECT item_id, CASE WHEN item_id % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS n_facts FROM benchmark",
}
