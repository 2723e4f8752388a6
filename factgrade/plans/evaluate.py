"""Grade generated answers against ground-truth facts."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgrade.functions import facts as fx
from factgrade.functions import budget, scoring
from factgrade.functions.prompts import check_all_messages, claim_messages
from factgrade.functions.replies import count_yes, match_option, says_yes
from factgrade.operators import clean, replies, rows, stitch, verify
from factgrade.operators.boundaries import Boundaries
from factgrade.plans.prepare import derive_facts, with_facts
from factgrade.sources import storage
from factgrade.sources.tables import with_row_id

RESULT_COLUMNS = [
    "row_id",
    "prompt",
    "domain",
    "generated_response",
    "is_abstained",
    "abstention_type",
    "score",
    "supported_claims",
    "afg_k_gen",
    "afg_k_gt",
    "gen_facts",
    "gt_facts",
    "status",
    "error",
    "failed_calls",
]


def check_in_one_call(
    df: DataFrame,
    store: str,
    make_backend: Callable,
    parallel: int | None = None,
    commits: int = replies.COMMITS,
    rounds: int = 1,
    prompt_tokens: int | None = None,
    most_claims: int | None = None,
) -> DataFrame:
    """(row_id, supported, failed_calls): the claims of an answer in as few prompts as fit.

    Without limits that is one prompt.  With ``prompt_tokens`` the claims are cut into consecutive pieces, each in a
    prompt of at most so many estimated tokens together with all reference facts, and of at most ``most_claims``
    claims (the reply grows with them); supported claims and failed calls are summed over the pieces.  Where the
    references leave no room, each claim has a prompt of its own.
    """
    claims = df.where((F.size("gen_facts") > 0) & (F.size("gt_facts") > 0))
    cut = prompt_tokens is not None or most_claims is not None
    if cut:
        room = F.lit(2**62)
        if prompt_tokens is not None:
            frame = F.octet_length(check_all_messages(fx.no_facts(), "gt_facts")[0]["content"])
            room = F.lit(prompt_tokens) - budget.token_estimate(frame)
        places = budget.cut_places(budget.line_tokens("gen_facts"), room, most_claims)
        claims = claims.select("row_id", "gen_facts", "gt_facts", F.explode(places).alias("place"))
        claims = claims.withColumn("gen_facts", budget.piece_of("gen_facts", F.col("place")))
    asked = replies.with_prompt_hash(claims.select("row_id", check_all_messages("gen_facts", "gt_facts").alias("messages")))
    asked = storage.materialise(asked, "checks")
    stored = replies.ask_pending(replies.distinct_prompts(asked), store, make_backend, parallel, commits=commits, rounds=rounds)
    answered = replies.join_replies(asked.select("row_id", "prompt_hash"), stored)
    ok = F.col("status") == "ok"
    counted = answered.select(
        "row_id",
        F.when(ok, count_yes("reply")).otherwise(0).alias("supported"),
        (~ok).cast("int").alias("failed_calls"),
    )
    if not cut:
        return counted
    return counted.groupBy("row_id").agg(*[F.sum(c).cast("int").alias(c) for c in ("supported", "failed_calls")])


def check_claim_by_claim(
    df: DataFrame, store: str, make_backend: Callable, parallel: int | None = None, commits: int = replies.COMMITS, rounds: int = 1
) -> DataFrame:
    """(row_id, supported, failed_calls): one prompt per claim, answered with an option."""
    claims = df.where(F.size("gt_facts") > 0).select("row_id", "gt_facts", F.explode("gen_facts").alias("claim"))
    asked = replies.with_prompt_hash(claims.select("row_id", claim_messages("claim", "gt_facts").alias("messages")))
    asked = storage.materialise(asked, "claim-checks")
    stored = replies.ask_pending(replies.distinct_prompts(asked), store, make_backend, parallel, commits=commits, rounds=rounds)
    answered = replies.join_replies(asked.select("row_id", "prompt_hash"), stored)
    ok = F.col("status") == "ok"
    return answered.groupBy("row_id").agg(
        F.count_if(ok & says_yes(match_option("reply", ["YES", "NO"]))).cast("int").alias("supported"),
        F.count_if(~ok).cast("int").alias("failed_calls"),
    )


def _text(df: DataFrame, side: str, column: str) -> DataFrame:
    return df.select("row_id", F.lit(side).alias("side"), F.col(column).alias("text"))


def _not_refused() -> Column:
    return ~F.coalesce(F.col("is_abstained"), F.lit(False))


def _facts_in_row(base: DataFrame, truth_from_text: bool, learned: Boundaries | None) -> DataFrame:
    """Fact lists without a model: both come from the row itself, so nothing is shuffled."""
    if truth_from_text:
        base = with_facts(base, "response", learned, "_truth")
        base = clean.reuse_facts(base, F.col("_truth")).drop("_truth")
    base = with_facts(base, "generated_response", learned, "gen_facts")
    gen = F.when(_not_refused(), F.col("gen_facts")).otherwise(fx.no_facts())
    return base.withColumn("gen_facts", gen).withColumn("split_failed", F.lit(0))


def _facts_from_replies(
    base: DataFrame,
    truth_from_text: bool,
    store: str,
    backend: Callable,
    examples: DataFrame | None,
    parallel: int | None,
    commits: int,
    rounds: int,
    learned: Boundaries | None,
) -> DataFrame:
    """Fact lists from a splitting model.

    Ground truths without facts and the answers that were not refused are split in one go.  Only keys, flags
    and fact lists are joined here; the texts of the dataset stay where they are.
    """
    has_facts = "response_facts" in base.columns
    parts = [_text(base.where(_not_refused()), "answer", "generated_response")]
    if truth_from_text:
        missing = base.where(F.coalesce(F.size("response_facts"), F.lit(0)) <= 0) if has_facts else base
        parts.append(_text(missing, "truth", "response"))
    split = derive_facts(rows.union_all(parts), "text", store, backend, examples, ("row_id", "side"), parallel, commits, rounds, learned)
    split = storage.materialise(split, "split")
    slim = base.select("row_id", "is_abstained", *(["response_facts"] if has_facts else []))
    found = split.where(F.col("side") == "answer").select(
        "row_id", F.col("facts").alias("gen_facts"), F.col("failed_calls").alias("split_failed")
    )
    slim = rows.reassemble(slim, found)
    if truth_from_text:
        truth = split.where(F.col("side") == "truth").select("row_id", F.col("facts").alias("derived"))
        slim = clean.reuse_facts(rows.reassemble(slim, truth), F.coalesce("derived", fx.no_facts())).drop("derived")
    return slim.withColumn("gen_facts", F.coalesce("gen_facts", fx.no_facts()))


def evaluate(
    df: DataFrame,
    reference: DataFrame | None = None,
    store: str | None = None,
    split_backend: Callable | None = None,
    check_backend: Callable | None = None,
    make_classifier: Callable | None = None,
    refusal_phrases: bool = False,
    examples: DataFrame | None = None,
    one_call: bool = True,
    parallel: int | None = None,
    commits: int = replies.COMMITS,
    rounds: int = 1,
    learned: Boundaries | None = None,
    prompt_tokens: int | None = None,
    most_claims: int | None = None,
) -> DataFrame:
    """Score every answer of a dataset.

    ``store`` is the folder of finished replies; give each model its own.  Calls that fail for the moment are made again
    in up to ``rounds`` rounds.  ``learned`` are sentence boundaries from ``boundaries.learn``; without them every
    period before white space ends a sentence.  ``prompt_tokens`` and ``most_claims`` bound the prompts that check the
    claims of an answer in one call; longer lists are cut.

    Rows of several files may be graded in one run: ``source_file`` and ``model`` stay on their rows where they are
    given, and equal ``row_id``s of two files are told apart.

    Order of work: clean, attach ground-truth facts, flag refusals, split the remaining answers into claims,
    check the claims, score.  Refused answers are filtered out before any prompt is built.  Each stage that
    calls a model is written before its rows are used again.  Without backends the offline stand-ins
    (sentence = fact, word overlap = support) are used; their scores are not those of a model.  Without a classifier nothing is
    a refusal, unless ``refusal_phrases`` asks for the keyword check.
    """
    spark = df.sparkSession
    store = store or storage.shared_folder(spark, "replies")
    base = clean.clean_evaluation(df)
    if reference is not None:
        base = stitch.stitch(base, clean.read_fact_column(reference, lines=True))
    if make_classifier is not None:
        base = replies.classify(base, make_classifier)
        base = verify.flag_refusals(
            base.withColumn("label", F.col("classified.label")).withColumn("label_score", F.col("classified.score"))
        ).drop("classified")
    elif refusal_phrases:
        base = verify.flag_by_keywords(base)
    else:
        base = base.withColumns({"is_abstained": F.lit(False), "abstention_type": F.lit(None).cast("string")})
    given = [c for c in ("source_file", "model") if c in base.columns]
    used = ["prompt", "response", "generated_response", "serviceDomain", "response_facts", "is_abstained", "abstention_type"]
    # Ids of several files may be equal, so rows are numbered anew here; the given ids return at the end.
    if "row_id" in base.columns:
        base = base.withColumnRenamed("row_id", "given_id")
        given.append("given_id")
    base = with_row_id(base.select(*[c for c in used if c in base.columns], *given))
    base = storage.materialise(base, "flagged")

    texts = ["prompt", "domain", "generated_response", "abstention_type", *given]
    domain = F.col("serviceDomain") if "serviceDomain" in base.columns else F.lit(None)
    base = base.withColumn("domain", domain.cast("string"))
    if split_backend is None:
        # With a checking model rows are joined later, so their texts are left out until the end.
        listed = _facts_in_row(base, reference is None, learned)
        listed = listed if check_backend is None else listed.drop(*texts)
    else:
        listed = _facts_from_replies(
            base, reference is None, f"{store}/split", split_backend, examples, parallel, commits, rounds, learned
        )
    graded = listed.withColumn("no_reference", F.col("response_facts").isNull()).withColumn(
        "gt_facts", F.coalesce("response_facts", fx.no_facts())
    )
    if check_backend is None:
        graded = graded.withColumn("check_failed", F.lit(0))
        scored = verify.score_rows(graded, F.size(scoring.overlapping_claims("gen_facts", "gt_facts")))
    else:
        graded = storage.materialise(
            graded.select("row_id", "is_abstained", "gen_facts", "gt_facts", "no_reference", "split_failed"), "claims"
        )
        in_one = partial(check_in_one_call, prompt_tokens=prompt_tokens, most_claims=most_claims)
        check = in_one if one_call else check_claim_by_claim
        outcome = check(graded.where(_not_refused()), f"{store}/check", check_backend, parallel, commits, rounds)
        joined = rows.reassemble(graded, outcome.withColumnRenamed("failed_calls", "check_failed"))
        scored = verify.score_rows(joined, F.col("supported"))
    failed_calls = F.coalesce("split_failed", F.lit(0)) + F.coalesce("check_failed", F.lit(0))
    if "prompt" not in scored.columns:
        scored = rows.reassemble(base.select("row_id", *texts), scored)
    if "given_id" in given:
        scored = scored.drop("row_id").withColumnRenamed("given_id", "row_id")
        given.remove("given_id")
    return (
        scored.withColumn("failed_calls", failed_calls)
        .withColumn(
            "status",
            F.when(F.col("is_abstained"), "refused")
            .when(F.col("no_reference"), "no_reference")
            .when(F.col("failed_calls") > 0, "call_failed")
            .otherwise("ok"),
        )
        .withColumn("error", F.when(F.col("no_reference"), F.lit("no reference facts for this prompt")))
        .select(*RESULT_COLUMNS, *given)
    )
