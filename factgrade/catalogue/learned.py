"""Queries of what is learned from, or kept about, the data itself, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade.catalogue import stages
from factgrade.catalogue import tables as t
from factgrade.catalogue.oracle import ALL_RESULTS, ORACLE as PLAIN, summary, with_
from factgrade.operators import bootstrap, boundaries, quantiles, replies, replystore, report
from factgrade.sources import storage
from factgrade.streaming.folder import grade_folder, read_state

# Titles, shortened words and initials among the invented prose, by the place of other words.
PLANTED = [(" and ", " and Dr. Smith of approx. five "), (" he ", " e.g. J. he "), (" in ", " at no. 3 in ")]


def _prose(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    for old, new in PLANTED:
        text = F.replace(text, F.lit(old), F.lit(new))
    return t.documents(spark, sf).select("doc_id", text.alias("text"))


def word_periods(spark: SparkSession, sf: str) -> DataFrame:
    """How often each word has a period, and how much that speaks for an abbreviation."""
    counts = storage.materialise(boundaries.word_counts(_prose(spark, sf)), "words")
    found = boundaries.abbreviation_scores(counts)
    return found.select("word", "n_period", "n_bare", F.round("score", 6).alias("score"))


def sentence_starters(spark: SparkSession, sf: str) -> DataFrame:
    """Words after sure sentence ends."""
    _, found = boundaries.scored_words(_prose(spark, sf))
    return found.select("word", "n_after", "n", F.round("score", 4).alias("score"))


def learned_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences that don't break after abbreviations and initials; white space inside shown as one blank."""
    texts = _prose(spark, sf)
    split = boundaries.add_sentences(texts, boundaries.learn(texts))
    listed = split.select("doc_id", F.posexplode("sentences").alias("sentence_no", "sentence"))
    return listed.withColumn("sentence", F.regexp_replace("sentence", f"[{boundaries.SPACE}]+", " "))


def compacted_store(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs on one reply store, which is compacted before, between (into other shares and buckets) and after them."""
    asked = storage.materialise(stages._questions(spark, sf), "asked")
    prompts = replies.distinct_prompts(asked)
    path = storage.shared_folder(spark, "replies")
    replies.ask_pending(prompts.where("false"), path, stages._length_backend(), parallel=4, commits=2)
    replystore.compact(spark, path)
    replies.ask_pending(prompts, path, stages._length_backend(), parallel=4)
    replystore.compact(spark, path, shares=3, buckets=5)
    store = replies.ask_pending(prompts, path, stages._length_backend(patient=True), parallel=4)
    attempts = store.groupBy("prompt_hash").agg(F.count("*").alias("attempts"))
    replystore.compact(spark, path, keep_old=True)
    best = replies.read_store(spark, path).join(attempts, "prompt_hash")
    content = prompts.select("prompt_hash", F.md5(F.element_at("messages", 1)["content"]).alias("content_digest"))
    return content.join(best, "prompt_hash", "left").drop("prompt_hash")


def length_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of the documents' lengths per source, one of which holds a third of the rows."""
    docs = t.table(spark, sf, "documents")
    found = quantiles.exact_quantiles(docs, "n_chars", [0.01, 0.25, 0.5, 0.75, 0.99], ["source"], pivots=15, few=8)
    places = [F.round(F.col("quantiles")[i], 6).alias(f"q{i}") for i in range(5)]
    return found.select("source", "n", *places)


def _by_length(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "documents").select(F.col("source").alias("model"), (F.length("text") / 7).alias("score"))


def length_boxplot(spark: SparkSession, sf: str) -> DataFrame:
    """A box plot over a column of many distinct values."""
    found = report.boxplot(_by_length(spark, sf), many=True)
    return found.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in found.dtypes])


def summary_many(spark: SparkSession, sf: str) -> DataFrame:
    """The summary per language with quartiles by selection."""
    found = report.summary(t.results(spark, sf), ["domain"], many=True)
    return found.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in found.dtypes])


def regression_band(spark: SparkSession, sf: str) -> DataFrame:
    """The regression line at 21 points with its confidence band."""
    found = bootstrap.regression_band(t.results(spark, sf), "doc_id")
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


def stream_report(spark: SparkSession, sf: str) -> DataFrame:
    """Result files that arrive in three runs, one of them empty; the summary is made from the state alone."""
    work = storage.shared_folder(spark, "stream")
    schema = "model string, domain string, is_abstained boolean, abstention_type string, score double, afg_k_gen int, afg_k_gt int"
    columns = [c.split()[0] for c in schema.split(", ")]
    rows = storage.materialise(t.results(spark, sf).select("doc_id", *columns), "results")
    for part in (0, 1, 2):
        if part < 2:
            mine = rows.where(F.col("doc_id") % 2 == part).drop("doc_id")
            storage.write_table(mine, f"{work}/in", "csv", mode="append")
        grade_folder(spark, f"{work}/in", schema, lambda df: df, f"{work}/out", f"{work}/seen", files_per_batch=3, state=f"{work}/state")
    found = report.reports_of_state(read_state(spark, f"{work}/state"))["summary"]
    return found.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in found.dtypes])


QUERIES = {
    f.__name__: f
    for f in (
        word_periods, sentence_starters, learned_sentences, compacted_store, length_quartiles, length_boxplot, summary_many,
        regression_band, stream_report,
    )
}

_TEXT = "text"
for _old, _new in PLANTED:
    _TEXT = f"replace({_TEXT}, '{_old}', '{_new}')"
_SPACE = r" \t\n\x0B\f\r"
_CLOSERS = r"""["'')\]]"""
_WORD = r"regexp_replace(lower({}), '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')"
_TOKENS = rf"""d AS (SELECT doc_id, regexp_extract_all({_TEXT}, '[^{_SPACE}]+') AS tokens FROM documents),
tok AS (SELECT doc_id, i, tokens[i] AS token, tokens[i + 1] AS next_token FROM (SELECT *, unnest(range(1, len(tokens) + 1)) AS i FROM d)),
w AS (SELECT *, {_WORD.format('token')} AS word, regexp_matches(token, '[\p{{L}}\p{{N}}]\.[^\p{{L}}\p{{N}}]*$') AS period FROM tok),
counts AS (SELECT word, count(*) FILTER (period) AS n_period, count(*) FILTER (NOT period) AS n_bare FROM w WHERE word <> '' GROUP BY word),
total AS (SELECT sum(n_period) / sum(n_period + n_bare) AS p, sum(n_period + n_bare) AS n FROM counts),
score AS (SELECT word, n_period, n_bare, CASE WHEN regexp_matches(word, '\p{{L}}') THEN
    2 * (n_period * ln(0.99 / p) + n_bare * ln((1 - 0.99) / (1 - p))) * exp(-length(replace(word, '.', '')))
    * (length(word) - length(replace(word, '.', '')) + 1) * pow(length(replace(word, '.', ''))::DOUBLE, -n_bare::DOUBLE) ELSE 0 END AS score
  FROM counts, total),
short AS (SELECT word FROM score WHERE score >= 0.3),
cand AS (SELECT *, {_WORD.format('next_token')} AS next_word FROM w WHERE next_token IS NOT NULL AND regexp_matches(token, '[.!?]{_CLOSERS}{{0,2}}$')),
aft AS (SELECT next_word AS word, count(*) AS n_after FROM cand WHERE next_word <> '' AND word NOT IN (SELECT word FROM short)
  AND NOT regexp_matches(word, '^\p{{L}}$') GROUP BY next_word),
st AS (SELECT aft.word, n_after, n_period + n_bare AS n, sum(n_after) OVER () AS b FROM aft JOIN counts USING (word)),
lik AS (SELECT st.word, n_after, st.n, n_after / b AS s, st.n / total.n AS g, (st.n - n_after) / (total.n - b) AS o, b AS inside, total.n - b AS outside,
  st.n - n_after AS alone FROM st, total),
starter AS (SELECT word, n_after, n, CASE WHEN s > g THEN 2 * (
    CASE WHEN n_after > 0 THEN n_after * ln(s) ELSE 0 END + CASE WHEN inside > n_after THEN (inside - n_after) * ln(1 - s) ELSE 0 END
  + CASE WHEN alone > 0 THEN alone * ln(o) ELSE 0 END + CASE WHEN outside > alone THEN (outside - alone) * ln(1 - o) ELSE 0 END
  - CASE WHEN n_after > 0 THEN n_after * ln(g) ELSE 0 END - CASE WHEN inside > n_after THEN (inside - n_after) * ln(1 - g) ELSE 0 END
  - CASE WHEN alone > 0 THEN alone * ln(g) ELSE 0 END - CASE WHEN outside > alone THEN (outside - alone) * ln(1 - g) ELSE 0 END) ELSE 0 END AS score FROM lik)"""

_STEPS = " + ".join(f"(u >= {step!r})::INT" for step in bootstrap.poisson_steps())
_Q = "quantile_cont(score, {})"
ORACLE = {
    "compacted_store": PLAIN["resume_replies"],
    "length_quartiles": "SELECT source, count(*) AS n, "
    + ", ".join(f"round(quantile_cont(n_chars::DOUBLE, {p}), 6) AS q{i}" for i, p in enumerate((0.01, 0.25, 0.5, 0.75, 0.99)))
    + " FROM documents GROUP BY source",
    "length_boxplot": f"""WITH r AS (SELECT source AS model, length(text) / 7 AS score FROM documents),
q AS (SELECT model, {_Q.format(0.25)} AS q1, {_Q.format(0.5)} AS median, {_Q.format(0.75)} AS q3 FROM r GROUP BY model),
f AS (SELECT *, score BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS ok FROM r JOIN q USING (model))
SELECT model, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, count(score) AS n_rows, round(min(score) FILTER (ok), 6) AS whisker_low,
  round(max(score) FILTER (ok), 6) AS whisker_high, count(*) FILTER (NOT ok) AS n_outliers FROM f GROUP BY model, q1, median, q3""",
    "summary_many": summary("domain", "domain"),
    "regression_band": with_(
        *ALL_RESULTS,
        "xy AS (SELECT doc_id, (afg_k_gen - afg_k_gt)::DOUBLE AS x, score AS y FROM results)",
        f"u AS (SELECT doc_id, x, y, b * 4 + i AS replicate, ('0x' || substr(md5(doc_id || ':' || b), (i * 8 + 1)::INT, 8))::BIGINT / 4294967296 AS u FROM xy, "
        f"(SELECT unnest(range({bootstrap.REPLICATES // 4})) AS b), (SELECT unnest(range(4)) AS i))",
        f"w AS (SELECT x, y, replicate, {_STEPS} AS w FROM u)",
        "s AS (SELECT replicate, sum(w)::DOUBLE AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM w GROUP BY replicate)",
        "l AS (SELECT (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope, sx, sy, n FROM s WHERE n * sxx - sx * sx > 0)",
        "line AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b, min(x) AS x0, max(x) AS x1 FROM xy WHERE y IS NOT NULL)",
        "p AS (SELECT a, b, x0 + i * (x1 - x0) / 20 AS x FROM line, (SELECT unnest(range(21)) AS i))",
    )
    + """SELECT round(x, 6) AS delta_k, round(any_value(b + a * x), 6) AS fitted,
  round(quantile_cont((sy - slope * sx) / n + slope * x, 0.025), 6) AS low, round(quantile_cont((sy - slope * sx) / n + slope * x, 0.975), 6) AS high
FROM p, l GROUP BY x""",
    "stream_report": summary("source", "model").replace("GROUP BY source", "GROUP BY model").replace("source AS model, count(*)", "model, count(*)"),
    "word_periods": f"WITH {_TOKENS} SELECT word, n_period, n_bare, round(score, 6) + 0 AS score FROM score",
    "sentence_starters": f"WITH {_TOKENS} SELECT word, n_after::BIGINT AS n_after, n::BIGINT AS n, round(score, 4) + 0 AS score FROM starter",
    "learned_sentences": rf"""WITH {_TOKENS},
ends AS (SELECT doc_id, i FROM cand WHERE CASE
    WHEN regexp_matches(token, '[!?]{_CLOSERS}{{0,2}}$') THEN true
    WHEN word = '' THEN NOT regexp_matches(next_token, '^[^\p{{L}}\p{{N}}]*\p{{Ll}}')
    WHEN word IN (SELECT word FROM short) OR regexp_matches(word, '^\p{{L}}$')
      THEN regexp_matches(next_token, '^[^\p{{L}}\p{{N}}]*\p{{Lu}}') AND next_word IN (SELECT word FROM starter WHERE score >= 30)
    WHEN regexp_matches(word, '^\p{{N}}+$') THEN NOT regexp_matches(next_token, '^[^\p{{L}}\p{{N}}]*\p{{Ll}}')
    ELSE true END),
numbered AS (SELECT tok.doc_id, tok.i, tok.token, count(ends.i) OVER (PARTITION BY tok.doc_id ORDER BY tok.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS no
  FROM tok LEFT JOIN ends ON ends.doc_id = tok.doc_id AND ends.i = tok.i)
SELECT doc_id, no::INTEGER AS sentence_no, string_agg(token, ' ' ORDER BY i) AS sentence FROM numbered GROUP BY doc_id, no""",
}
