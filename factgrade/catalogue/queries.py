"""The named queries.  Each takes (spark, folder of the shared tables) and returns a DataFrame.

Lists are returned as text with `` | `` between the entries, long texts as their digest, and computed
floating-point values rounded to six places, so that results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.catalogue import stages
from factgrade.catalogue import tables as t
from factgrade.functions import facts as fx
from factgrade.functions import prompts as px
from factgrade.functions import replies as rx
from factgrade.functions import scoring, text
from factgrade.operators import clean, replies, report, retrieve, rows, skew, stitch, verify
from factgrade.plans import generate as gen
from factgrade.sources import storage
from factgrade.sources.tables import with_source_id


def joined(values: Column | str) -> Column:
    return F.array_join(values, " | ")


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def six(c: Column | str) -> Column:
    return F.round(c, 6)


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    """Doubles to six places, whole numbers to bigint."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            six(c).alias(c) if kinds[c] == "double" and c not in keep
            else long(c).alias(c) if kinds[c] in ("int", "bigint") else F.col(c)
            for c in df.columns
        ]
    )


# Cleaning and parsing


def clean_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Null words, incomplete rows, text keys."""
    words = F.array(*[F.lit(w) for w in ["NA", "None", "", "ok", "n/a", "fine"]])
    raw = t.pairs_raw(spark, sf).withColumn("note", F.element_at(words, (F.pmod("conv_id", F.lit(6)) + 1).cast("int")))
    return clean.clean_evaluation(raw, text_nulls=True).select(
        "row_id", "prompt", "response", "generated_response", "note"
    )


def default_answer(spark: SparkSession, sf: str) -> DataFrame:
    """A dataset without answers is graded against itself."""
    df = clean.clean_evaluation(t.pairs_raw(spark, sf).drop("generated_response"))
    return df.select("row_id", "response", "generated_response")


def persona_columns(spark: SparkSession, sf: str) -> DataFrame:
    return clean.persona_only(t.personas(spark, sf))


def parse_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Stored fact lists, some of them damaged, read both ways."""
    listed = fx.sentence_facts("response")
    variant = F.pmod("row_id", F.lit(5))
    raw = (
        F.when(variant == 0, fx.facts_json(listed))
        .when(variant == 1, F.replace(fx.facts_json(listed), F.lit('"'), F.lit("'")))
        .when(variant == 2, F.concat(fx.facts_json(listed), F.lit(" and more")))
        .when(variant == 3, F.concat(F.lit("\n  "), F.array_join(listed, " \n\n ")))
    )
    return t.pairs_raw(spark, sf).select("row_id", raw.alias("raw")).select(
        "row_id",
        long(F.size(fx.parse_facts("raw"))).alias("n_strict"),
        joined(fx.parse_facts("raw")).alias("strict"),
        long(F.size(fx.parse_facts_or_lines("raw"))).alias("n_lenient"),
        joined(fx.parse_facts_or_lines("raw")).alias("lenient"),
    )


def truncate_text(spark: SparkSession, sf: str) -> DataFrame:
    """What the classifier sees of a text."""
    cut = text.head("text")
    return t.documents(spark, sf).select(
        "doc_id",
        F.md5(cut).alias("head_digest"),
        long(F.length(cut)).alias("head_chars"),
        long(F.length("text")).alias("text_chars"),
        long(F.size(clean.facts_for("text", text.sentences("text")))).alias("n_facts"),
    )


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    listed = t.documents(spark, sf).select(
        "doc_id", F.posexplode(text.sentences("text")).alias("sentence_no", "sentence")
    )
    return listed.withColumn("sentence_no", long("sentence_no"))


def atomise(spark: SparkSession, sf: str) -> DataFrame:
    """Answer -> sentences -> listed model output -> facts."""
    listed = text.sentences("generated_response")
    output = F.array_join(F.transform(listed, lambda s: F.concat(F.lit(" * "), s)), "\nnoise\n")
    df = clean.add_facts(t.pairs(spark, sf), fx.listed_facts(output), "facts")
    return df.select(
        "row_id",
        long(F.size(listed)).alias("n_sentences"),
        long("facts_count").alias("n_facts"),
        joined("facts").alias("facts"),
    )


def reuse_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Stored facts stay, missing ones are derived."""
    stored = F.when(F.pmod("row_id", F.lit(3)) != 0, F.array(F.lit("stored"), F.col("prompt")))
    df = t.pairs(spark, sf).withColumn("response_facts", F.coalesce(stored, fx.no_facts()))
    df = clean.reuse_facts(df, fx.sentence_facts("response"))
    return df.select("row_id", joined("response_facts").alias("facts"))


# Joins


def _stitched(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id",
        "prompt",
        joined("response_facts").alias("facts"),
        long("response_facts_count").alias("n_facts"),
    )


def stitch_facts(spark: SparkSession, sf: str) -> DataFrame:
    """One fact list per prompt: rows in = rows out."""
    return _stitched(stitch.stitch(t.pairs(spark, sf), t.stored_prepared(spark, sf)))


def stitch_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Answers repeated for every reference row of their prompt."""
    return _stitched(stitch.stitch(t.pairs(spark, sf), t.stored_prepared(spark, sf), keep_duplicates=True))


def bm25_stats(spark: SparkSession, sf: str) -> DataFrame:
    found = retrieve.term_stats(t.examples(spark, sf))
    return found.select("term", long("df").alias("df"), six("idf").alias("idf"))


def bm25_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(retrieve.corpus_stats(t.examples(spark, sf)).select("n_examples", "avg_len"))


def _asked_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "conversations").select(F.explode(text.sentences("text")).alias("sentence"))


def bm25_top3(spark: SparkSession, sf: str) -> DataFrame:
    """The three most similar examples of every distinct sentence."""
    best = retrieve.top_examples(_asked_sentences(spark, sf), t.examples(spark, sf))
    return best.select("sentence", long("rank").alias("rank"), long("example_id").alias("example_id"), "score")


def atomise_prompt(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt that asks for the facts of a sentence, with its best examples."""
    found = retrieve.with_examples(_asked_sentences(spark, sf), t.examples(spark, sf))
    prompt = px.flatten_messages(px.split_messages("sentence", F.col("examples")))
    return found.select(
        "sentence", F.md5(prompt).alias("prompt_digest"), long(F.length(prompt)).alias("prompt_chars")
    )


def _prompt(messages: Column) -> list[Column]:
    flat = px.flatten_messages(messages)
    return [F.md5(flat).alias("prompt_digest"), long(F.length(flat)).alias("prompt_chars")]


def persona_prompt_zero(spark: SparkSession, sf: str) -> DataFrame:
    return gen.persona_prompts(t.personas(spark, sf)).select("row_id", *_prompt(F.col("messages")))


def persona_prompt_few(spark: SparkSession, sf: str) -> DataFrame:
    """The three solved rows shown first are the first three of the table."""
    shown = rows.first_rows(t.personas(spark, sf), "row_id", fixed.EXAMPLES_SHOWN)
    return gen.persona_prompts(t.personas(spark, sf), shown, "row_id").select("row_id", *_prompt(F.col("messages")))


def generation_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Every question once per model and context."""
    tasks = [("host/model-a", "zero"), ("host/model-a", "few"), ("model-b", "zero")]
    return gen.with_tasks(t.personas(spark, sf), tasks).select(
        "row_id", text.short_model_name("model").alias("model"), "context"
    )


def claim_prompt(spark: SparkSession, sf: str) -> DataFrame:
    """One prompt per claim."""
    df = t.pairs(spark, sf).select(
        "row_id",
        fx.sentence_facts("response").alias("refs"),
        F.posexplode(fx.sentence_facts("generated_response")).alias("claim_no", "claim"),
    )
    return df.select("row_id", long("claim_no").alias("claim_no"), *_prompt(px.claim_messages("claim", "refs")))


def answer_prompt(spark: SparkSession, sf: str) -> DataFrame:
    """One prompt per answer."""
    claims, refs = fx.sentence_facts("generated_response"), fx.sentence_facts("response")
    return t.pairs(spark, sf).select("row_id", *_prompt(px.check_all_messages(claims, refs)))


# Replies


def option_match(spark: SparkSession, sf: str) -> DataFrame:
    said = t.table(spark, sf, "conversations").where(F.col("role") == "assistant")
    reply = F.when(F.col("turn") % 4 == 1, F.col("text")).when(F.col("conv_id") % 3 == 0, " yes ").when(
        F.col("conv_id") % 3 == 1, ""
    ).otherwise("maybe")
    option = rx.match_option(reply, ["YES", "NO"])
    return said.select("conv_id", "turn", option.alias("option"), rx.says_yes(option).alias("supported"))


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Decision objects, one entry per sentence, some of them damaged."""
    listed = F.transform(
        text.sentences("text"),
        lambda s: F.when(F.length(s) % 3 == 0, "YES").when(F.length(s) % 3 == 1, "no").otherwise("Yes"),
    )
    whole = F.to_json(F.struct(listed.alias("decisions")))
    bare = F.to_json(listed)
    variant = F.pmod("doc_id", F.lit(7))
    reply = (
        F.when(variant == 0, whole)
        .when(variant == 1, F.concat(F.lit(" "), whole, F.lit("\n")))
        .when(variant == 2, bare)
        .when(variant == 3, F.concat(whole, F.lit(" so")))
        .when(variant == 4, F.replace(whole, F.lit("decisions"), F.lit("verdicts")))
        .when(variant == 5, F.lit('{"decisions": null}'))
    )
    replied = t.documents(spark, sf).select("doc_id", reply.alias("reply"))
    return replied.select("doc_id", long(rx.count_yes("reply")).alias("n_yes"))


def refusals(spark: SparkSession, sf: str) -> DataFrame:
    flagged = verify.flag_refusals(t.classified(spark, sf))
    return flagged.select(
        "doc_id", long("label_id").alias("label_id"), six("label_score").alias("label_score"), "is_abstained", "abstention_type"
    )


def _status_reply() -> Column:
    variant = F.pmod("doc_id", F.lit(8))
    return (
        F.when(variant == 0, "ERROR: 429 too many requests")
        .when(variant == 1, "ERROR: Service Unavailable")
        .when(variant == 2, "ERROR: bad key")
        .when(variant == 3, "")
        .when(variant == 4, F.lit(None))
        .when(variant == 5, "ERROR: request timed out")
        .otherwise(F.col("text"))
    )


def keyword_refusals(spark: SparkSession, sf: str) -> DataFrame:
    """Answers that refuse in words; the shared texts hold no such phrase, so some get one."""
    said = t.table(spark, sf, "conversations").where(F.col("role") == "assistant")
    phrase = F.when(F.col("conv_id") % 4 == 0, "I'm sorry, but no. ").when(F.col("conv_id") % 4 == 1, "Was an aide. ")
    df = said.select("conv_id", "turn", F.concat(F.coalesce(phrase, F.lit("")), "text").alias("generated_response"))
    return verify.flag_by_keywords(df).select("conv_id", "turn", "is_abstained", "abstention_type")


def reply_status(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "documents").select("doc_id", rx.reply_status(_status_reply()).alias("status"))


def _document_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """One prompt per document, keyed by the digest of its text; copies share a prompt."""
    messages = px.split_messages("text")
    return t.table(spark, sf, "documents").select("doc_id", "source", F.md5("text").alias("prompt_hash"), messages.alias("messages"))


def prompt_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Each prompt once, answered by the mock backend, the reply back on every row that asked."""
    asked = _document_prompts(spark, sf)
    store = storage.materialise(replies.mock_replies(replies.distinct_prompts(asked)), "replies")
    answered = replies.join_replies(asked.select("doc_id", "prompt_hash"), store)
    return answered.select("doc_id", "prompt_hash", "reply", "status")


def pending(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts still to ask after a first run: those with a finished reply are left out."""
    store = (
        t.table(spark, sf, "documents")
        .select(F.md5("text").alias("prompt_hash"), _status_reply().alias("reply"))
        .withColumn("status", rx.reply_status("reply"))
    )
    left = replies.pending(replies.distinct_prompts(_document_prompts(spark, sf)), store)
    return left.select("prompt_hash", long(F.length(F.element_at("messages", -1)["content"])).alias("content_chars"))


def reassemble(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes finished in any order, back on their rows."""
    outcomes = t.pairs(spark, sf).orderBy(F.md5("generated_response")).select(
        "row_id", F.md5("generated_response").alias("outcome")
    )
    return rows.reassemble(t.pairs(spark, sf).select("row_id", "prompt"), outcomes)


# Verification and scores


def verify_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that quote a benchmark item word for word."""
    return t.matched(spark, sf).select(
        "doc_id",
        long(F.coalesce("item_id", F.lit(-1))).alias("item_id"),
        long("k_gen").alias("k_gen"),
        long(F.coalesce(F.size("gt_facts"), F.lit(0))).alias("k_gt"),
        long(F.coalesce(F.size(scoring.exact_claims("quoted", "gt_facts")), F.lit(0))).alias("supported"),
    )


def _token_claims(spark: SparkSession, sf: str) -> DataFrame:
    return t.pairs(spark, sf).select(
        "row_id",
        "prompt",
        "generated_response",
        fx.sentence_facts("generated_response").alias("gen_facts"),
        fx.sentence_facts("response").alias("gt_facts"),
    )


def verify_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Claims whose words mostly occur in the ground truth of their row."""
    checked = _token_claims(spark, sf).select(
        "row_id",
        long(F.size("gen_facts")).alias("k_gen"),
        long(F.size("gt_facts")).alias("k_gt"),
        long(F.size(scoring.overlapping_claims("gen_facts", "gt_facts"))).alias("supported"),
    )
    return checked.withColumn("score", six(scoring.f1_at_k("supported", "k_gen", "k_gt")))


def supported_claims(spark: SparkSession, sf: str) -> DataFrame:
    """Supported claims per row, counted from one reply per claim."""
    claims = _token_claims(spark, sf).select("row_id", F.explode("gen_facts").alias("claim"))
    reply = F.when(F.length("claim") % 2 == 0, "Yes, it is").otherwise("no")
    flagged = claims.withColumn("supported", rx.says_yes(rx.match_option(reply, ["YES", "NO"])))
    counted = verify.supported_per_row(flagged)
    return counted.select("row_id", long("supported_claims").alias("supported_claims"))


def score_f1(spark: SparkSession, sf: str) -> DataFrame:
    df = t.results(spark, sf)
    return df.select(
        "doc_id",
        long("supported_claims").alias("supported_claims"),
        long("afg_k_gen").alias("k_gen"),
        long("afg_k_gt").alias("k_gt"),
        six(scoring.precision_at_k("supported_claims", "afg_k_gen")).alias("precision"),
        six(scoring.recall_at_k("supported_claims", "afg_k_gt")).alias("recall"),
        six("score").alias("score"),
    )


# Reports


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.summary(t.results(spark, sf)))


def summary_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.summary(t.results(spark, sf), ["domain"])).withColumnRenamed("domain", "lang")


def refusal_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.refusal_breakdown(verify.flag_refusals(t.classified(spark, sf))))


def derived_metrics(spark: SparkSession, sf: str) -> DataFrame:
    df = with_source_id(t.results(spark, sf).drop("model"))
    return df.select(
        "doc_id",
        "model",
        text.renamed_output("source_file", fixed.READY_SUFFIX).alias("ready_file"),
        text.renamed_output("source_file", fixed.REFERENCE_SUFFIX).alias("reference_file"),
        long(text.delta_k("afg_k_gen", "afg_k_gt")).alias("delta_k"),
        long("char_count").alias("char_count"),
        six(text.claim_density("char_count", "afg_k_gen")).alias("claim_density"),
    )


def domain_model_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.domain_model_mean(t.results(spark, sf)))


def domain_model_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """One column per model that the results hold."""
    return rounded(report.domain_model_matrix(t.results(spark, sf)))


def boxplot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.boxplot(t.results(spark, sf)))


def outliers(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.outliers(t.results(spark, sf)))


def regression(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.regression(t.results(spark, sf)))


def first_n_per_source(spark: SparkSession, sf: str) -> DataFrame:
    docs = t.table(spark, sf, "documents").select("doc_id", "source", "lang")
    return rows.first_per_group(docs, "source", "doc_id")


def first_n(spark: SparkSession, sf: str) -> DataFrame:
    return rows.first_rows(t.table(spark, sf, "documents").select("doc_id", "source", "n_chars"), "doc_id", 100)


def rows_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.rows_per_source(t.table(spark, sf, "documents"), "source"))


def union_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results and failed rows, which lack most columns; a failed row is neither refused nor answered."""
    graded = t.results(spark, sf).select("doc_id", "is_abstained", "score", "afg_k_gen", "afg_k_gt")
    broken = t.table(spark, sf, "labels").where(F.col("quality") == 0).select(
        "doc_id", F.lit("call failed").alias("error"), F.lit(0.0).alias("score")
    )
    return rounded(rows.union_all([graded, broken]))


def outcome_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Refused, answered and failed rows of such a union."""
    both = clean.with_outcome(union_results(spark, sf))
    return rounded(both.groupBy("outcome").agg(F.count("*").alias("n_rows"), F.avg("score").alias("mean_score")))


def hot_prompt_join(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts of the documents' languages joined with hot keys spread out: most rows share a key.

    With a factor of 1 a key is hot as soon as it has more than an average partition's rows.
    """
    asked = t.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("prompt_hash"))
    store = (
        t.table(spark, sf, "documents")
        .groupBy(F.col("lang").alias("prompt_hash"))
        .agg(F.concat(F.lit("reply "), F.max("doc_id").cast("string")).alias("reply"))
    )
    return skew.salted_join(asked, store, ["prompt_hash"], fraction=1.0, factor=1).select("doc_id", "prompt_hash", "reply")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        clean_dataset,
        default_answer,
        persona_columns,
        parse_facts,
        truncate_text,
        sentences,
        atomise,
        reuse_facts,
        stitch_facts,
        stitch_duplicates,
        bm25_corpus,
        bm25_stats,
        bm25_top3,
        atomise_prompt,
        persona_prompt_zero,
        persona_prompt_few,
        generation_tasks,
        claim_prompt,
        answer_prompt,
        option_match,
        decisions,
        refusals,
        keyword_refusals,
        reply_status,
        prompt_dedupe,
        pending,
        reassemble,
        verify_exact,
        verify_tokens,
        supported_claims,
        score_f1,
        summary,
        summary_by_lang,
        refusal_breakdown,
        derived_metrics,
        domain_model_mean,
        domain_model_matrix,
        boxplot,
        outliers,
        regression,
        first_n_per_source,
        first_n,
        rows_per_source,
        union_results,
        outcome_groups,
        hot_prompt_join,
        stages.csv_roundtrip,
        stages.json_roundtrip,
        stages.json_arrays,
        stages.few_shot_tables,
        stages.folder_read,
        stages.results_written,
        stages.partitioned_write,
        stages.reply_stage,
        stages.classify_stage,
        stages.resume_replies,
        stages.prepare_offline,
        stages.evaluate_offline,
        stages.evaluate_with_replies,
        stages.generate_mock,
        stages.folder_stream,
    ]
}
