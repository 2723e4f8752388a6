"""Aggregations over result tables.

Scores are fractions of small whole numbers, so results are first reduced to one row per distinct score
(``score_counts``).  Quantiles, moments and outliers are then taken from that table: a model or domain that
holds a third of all rows costs no more than any other.  Where a column has many distinct values, ``many`` has the
quantiles found by ``quantiles.exact_quantiles``, so that no task gathers them.

``report_state`` is such a table with all that the reports need.  States of parts of the results add up, so a report can
be kept up to date from them (``merged``) without the results themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgrade.functions import text
from factgrade.operators.quantiles import exact_quantiles, group_key

QUARTILES = [0.25, 0.5, 0.75]


def score_counts(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., is_abstained, score) -> rows and sums of the fact counts."""
    return results.groupBy(*(by or []), "is_abstained", "score").agg(
        F.count("*").alias("n"),
        F.sum("afg_k_gen").alias("sum_k_gen"),
        F.sum("afg_k_gt").alias("sum_k_gt"),
    )


def _quantiles(value: Column, n: Column) -> Column:
    return F.percentile(value, QUARTILES, n)


def _with_quantiles(grouped: DataFrame, counts: DataFrame, value: Column, n: Column, by: list[str]) -> DataFrame:
    """``grouped`` with the quartiles of its groups in ``_q``."""
    found = exact_quantiles(counts.select(*by, value.alias("_v"), n.alias("_n")), "_v", QUARTILES, by, "_n")
    keyed = found.select(group_key(by).alias("_g"), F.col("quantiles").alias("_q"))
    return grouped.withColumn("_g", group_key(by)).join(keyed, "_g", "left").drop("_g")


def _deviation(value: Column, n: Column) -> Column:
    """Sample standard deviation of values that occur n times; null for a single value."""
    count, total, squares = F.sum(n), F.sum(value * n), F.sum(value * value * n)
    spread = F.greatest(F.lit(0.0), (squares - total * total / count) / (count - 1))
    return F.when(count > 1, F.sqrt(spread))


def summary(results: DataFrame, by: list[str] | None = None, many: bool = False) -> DataFrame:
    """Totals, refusals, verbosity and score distribution; one row, or one per group.

    ``mean_all`` covers every row with a score, refused and failed ones included; the other score figures
    cover answered rows.
    """
    return summary_of_counts(score_counts(results, by), by, many)


def summary_of_counts(counts: DataFrame, by: list[str] | None = None, many: bool = False) -> DataFrame:
    """The summary from a table of ``score_counts`` or a ``report_state``."""
    answered = ~F.col("is_abstained")
    n_answered = F.when(answered, F.col("n"))
    score = F.when(answered, F.col("score"))
    columns = [
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("is_abstained"), F.col("n"))), F.lit(0)).alias("refused"),
        F.coalesce(F.sum(n_answered), F.lit(0)).alias("answered"),
        (F.sum(F.col("score") * F.col("n")) / F.sum(F.when(F.col("score").isNotNull(), F.col("n")))).alias("mean_all"),
        (F.sum(score * F.col("n")) / F.sum(n_answered)).alias("mean_answered"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        _deviation(score, n_answered).alias("sd_score"),
        *([] if many else [_quantiles(score, F.coalesce(n_answered, F.lit(0))).alias("_q")]),
        (F.sum(F.when(answered, F.col("sum_k_gen") - F.col("sum_k_gt"))) / F.sum(n_answered)).alias("mean_delta_k"),
        (F.sum(F.when(answered, F.col("sum_k_gen"))) / F.sum(n_answered)).alias("mean_k_gen"),
        (F.sum(F.when(answered, F.col("sum_k_gt"))) / F.sum(n_answered)).alias("mean_k_gt"),
    ]
    grouped = counts.groupBy(*by).agg(*columns) if by else counts.agg(*columns)
    if many:
        grouped = _with_quantiles(grouped, counts, score, F.coalesce(n_answered, F.lit(0)), by or [])
    return grouped.select(
        *(by or []),
        "total",
        "refused",
        F.when(F.col("total") > 0, 100.0 * F.col("refused") / F.col("total")).alias("refusal_percent"),
        "answered",
        "mean_all",
        "mean_answered",
        F.col("_q")[1].alias("median_score"),
        "min_score",
        "max_score",
        "sd_score",
        F.col("_q")[0].alias("q1_score"),
        F.col("_q")[2].alias("q3_score"),
        (F.col("_q")[2] - F.col("_q")[0]).alias("iqr_score"),
        "mean_delta_k",
        "mean_k_gen",
        "mean_k_gt",
    )


def render(row, breakdown: str = "") -> str:
    """The summary row as text; ``breakdown`` holds the lines of ``breakdown_text``."""

    def number(value, form: str) -> str:
        return "n/a" if value is None else format(value, form)

    lines = [
        "Evaluation summary",
        f"Rows: {row['total']}",
        f"Refused: {row['refused']} ({number(row['refusal_percent'], '.2f')}%)",
        *([breakdown] if breakdown else []),
        f"Answered: {row['answered']}",
        f"Mean score, all rows: {number(row['mean_all'], '.4f')}",
        f"Score of answered rows: mean {number(row['mean_answered'], '.4f')}, median {number(row['median_score'], '.4f')}, "
        f"min {number(row['min_score'], '.4f')}, max {number(row['max_score'], '.4f')}, sd {number(row['sd_score'], '.4f')}",
        f"Interquartile range: {number(row['iqr_score'], '.4f')} "
        f"({number(row['q1_score'], '.4f')} to {number(row['q3_score'], '.4f')})",
        f"Facts per answer: {number(row['mean_k_gen'], '.2f')}, per ground truth: {number(row['mean_k_gt'], '.2f')}, "
        f"mean difference: {number(row['mean_delta_k'], '+.4f')}",
    ]
    return "\n".join(lines)


def refusal_breakdown(results: DataFrame) -> DataFrame:
    """Refused rows per type, most frequent first."""
    return (
        results.where(F.col("is_abstained") & F.col("abstention_type").isNotNull())
        .groupBy("abstention_type")
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), "abstention_type")
    )


def breakdown_text(results: DataFrame) -> DataFrame:
    """One row: a line for every type of refusal, the most frequent first."""
    entry = F.struct((-F.col("n_rows")).alias("order"), "abstention_type", "n_rows")
    listed = refusal_breakdown(results).agg(F.array_sort(F.collect_list(entry)).alias("kinds"))
    line = F.transform("kinds", lambda k: F.concat(F.lit("  "), k["abstention_type"], F.lit(": "), k["n_rows"].cast("string")))
    return listed.select(F.array_join(line, "\n").alias("text"))


def derived_metrics(results: DataFrame, answer: str = "generated_response") -> DataFrame:
    """Add delta_k, char_count and claim_density."""
    return (
        results.withColumn("delta_k", text.delta_k("afg_k_gen", "afg_k_gt"))
        .withColumn("char_count", F.length(answer))
        .withColumn("claim_density", text.claim_density("char_count", "afg_k_gen"))
    )


def domain_model_mean(results: DataFrame) -> DataFrame:
    """Mean score per domain and model."""
    return results.groupBy("domain", "model").agg(F.avg("score").alias("mean_score"), F.count("score").alias("n_rows"))


def domain_model_matrix(results: DataFrame, models: list[str] | None = None) -> DataFrame:
    """Mean score with domains as rows and models as columns.

    The rows are averaged first, so the pivot runs over one row per domain and model.  Name the models to
    save the pass that finds them.
    """
    means = domain_model_mean(results.where(F.col("domain").isNotNull()))
    return means.groupBy("domain").pivot("model", models).agg(F.first("mean_score"))


def _scored(results: DataFrame, by: str) -> DataFrame:
    return results.where(F.col("score").isNotNull()).groupBy(by, "score").agg(F.count("*").alias("n"))


def _fenced(counts: DataFrame, by: str, many: bool) -> DataFrame:
    """Distinct scores with the quartiles and fences of their group."""
    if many:
        found = exact_quantiles(counts, "score", QUARTILES, [by], "n").withColumnRenamed("quantiles", "_q")
    else:
        found = counts.groupBy(by).agg(_quantiles(F.col("score"), F.col("n")).alias("_q"))
    q = found.select(by, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return counts.join(q, by).withColumn("_inside", F.col("score").between(F.col("q1") - reach, F.col("q3") + reach))


def boxplot(results: DataFrame, by: str = "model", many: bool = False) -> DataFrame:
    """Quartiles, whiskers (furthest scores within 1.5 interquartile ranges) and number of outliers."""
    return boxplot_of_counts(_scored(results, by), by, many)


def boxplot_of_counts(counts: DataFrame, by: str = "model", many: bool = False) -> DataFrame:
    """The same from (``by``, score, n), each score once per group."""
    inside = F.when(F.col("_inside"), F.col("score"))
    return (
        _fenced(counts, by, many)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.sum("n").alias("n_rows"),
            F.min(inside).alias("whisker_low"),
            F.max(inside).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~F.col("_inside"), F.col("n"))), F.lit(0)).alias("n_outliers"),
        )
    )


def outliers(results: DataFrame, by: str = "model", many: bool = False) -> DataFrame:
    """Scores outside the fences and how many rows have them."""
    return outliers_of_counts(_scored(results, by), by, many)


def outliers_of_counts(counts: DataFrame, by: str = "model", many: bool = False) -> DataFrame:
    return _fenced(counts, by, many).where(~F.col("_inside")).select(by, "score", F.col("n").alias("n_rows"))


def regression(results: DataFrame) -> DataFrame:
    """Straight line of score over delta_k."""
    x = text.delta_k("afg_k_gen", "afg_k_gt").cast("double")
    y = F.col("score")
    return results.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n_rows"),
    )


def rows_per_source(df: DataFrame, source: str = "source_file") -> DataFrame:
    return df.groupBy(source).agg(F.count("*").alias("n_rows"))


STATE_KEYS = ["model", "domain", "is_abstained", "abstention_type", "score"]
STATE_SUMS = ["n", "sum_k_gen", "sum_k_gt", "n_line", "sum_x", "sum_xx"]


def report_state(results: DataFrame) -> DataFrame:
    """What the reports need of results: one row per model, domain, kind of refusal and distinct score."""
    x = text.delta_k("afg_k_gen", "afg_k_gt").cast("bigint")
    paired = F.when(F.col("score").isNotNull(), x)
    found = results.groupBy(*STATE_KEYS).agg(
        F.count("*").alias("n"),
        F.sum(F.col("afg_k_gen").cast("bigint")).alias("sum_k_gen"),
        F.sum(F.col("afg_k_gt").cast("bigint")).alias("sum_k_gt"),
        F.count(paired).alias("n_line"),
        F.coalesce(F.sum(paired), F.lit(0)).alias("sum_x"),
        F.coalesce(F.sum(paired * paired), F.lit(0)).alias("sum_xx"),
    )
    return found.select(*STATE_KEYS, *STATE_SUMS)


def merged(state: DataFrame) -> DataFrame:
    """The state of all results, from the states of their parts."""
    return state.groupBy(*STATE_KEYS).agg(*[F.sum(c).alias(c) for c in STATE_SUMS])


def regression_of_state(state: DataFrame) -> DataFrame:
    """The line of ``regression`` from sums; a score is the same in all rows of a group of the state."""
    y, n = F.col("score"), F.col("n_line")
    sums = state.where("n_line > 0").agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.sum("sum_x").alias("x"), F.sum(y * n).alias("y"),
        F.sum("sum_xx").alias("xx"), F.sum(y * F.col("sum_x")).alias("xy"), F.sum(y * y * n).alias("yy"),
    )
    sxx = F.col("n") * F.col("xx").cast("double") - F.col("x").cast("double") * F.col("x")
    sxy = F.col("n") * F.col("xy") - F.col("x") * F.col("y")
    syy = F.col("n") * F.col("yy") - F.col("y") * F.col("y")
    slope = F.when(sxx > 0, sxy / sxx)
    fit = F.when(sxx > 0, F.when(syy > 0, sxy * sxy / (sxx * syy)).otherwise(1.0))
    return sums.select(
        slope.alias("slope"), ((F.col("y") - slope * F.col("x")) / F.col("n")).alias("intercept"), fit.alias("r2"), F.col("n").alias("n_rows")
    )


def reports_of_state(state: DataFrame) -> dict[str, DataFrame]:
    """The tables of a report from a state, merged or not."""
    state = merged(state)
    per_model = state.where(F.col("score").isNotNull()).groupBy("model", "score").agg(F.sum("n").alias("n"))
    kinds = state.where(F.col("is_abstained") & F.col("abstention_type").isNotNull()).groupBy("abstention_type")
    scored = F.when(F.col("score").isNotNull(), F.col("n"))
    means = state.groupBy("domain", "model").agg(
        (F.sum(F.col("score") * F.col("n")) / F.sum(scored)).alias("mean_score"), F.coalesce(F.sum(scored), F.lit(0)).alias("n_rows")
    )
    return {
        "summary": summary_of_counts(state, ["model"]),
        "refusals": kinds.agg(F.sum("n").alias("n_rows")).orderBy(F.desc("n_rows"), "abstention_type"),
        "domain_model_mean": means,
        "boxplot": boxplot_of_counts(per_model),
        "outliers": outliers_of_counts(per_model),
        "regression": regression_of_state(state),
    }
