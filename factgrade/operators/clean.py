"""Checking and cleaning input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factgrade import fixed
from factgrade.functions.facts import no_facts, parse_facts, parse_facts_or_lines


def require_columns(df: DataFrame, required: list[str] = fixed.EVALUATION_COLUMNS) -> DataFrame:
    """The table itself, or an error that names the columns it lacks."""
    there = set(df.columns)
    if there.issuperset(required):
        return df
    raise ValueError("the table has no column " + ", ".join(c for c in required if c not in there))


def ensure_answer(df: DataFrame) -> DataFrame:
    """Tables without model answers are graded against themselves."""
    if "generated_response" in df.columns:
        return df
    return df.withColumn("generated_response", F.col("response"))


def null_words(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Words that mean "no value" become null in string columns."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = [c for c in strings if columns is None or c in columns]
    return df.withColumns({c: F.when(~F.col(c).isin(fixed.NULL_WORDS), F.col(c)) for c in chosen})


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def key_as_text(df: DataFrame, key: str = "prompt") -> DataFrame:
    return df.withColumn(key, F.col(key).cast("string"))


def persona_only(df: DataFrame) -> DataFrame:
    """Only the persona columns, rows without nulls."""
    return require_columns(df, fixed.PERSONA_COLUMNS).select(*fixed.PERSONA_COLUMNS).na.drop()


def read_fact_column(df: DataFrame, column: str = "response_facts", lines: bool = False) -> DataFrame:
    """A fact column as an array, whatever it is stored as; tables without it stay as they are."""
    if column not in df.columns or isinstance(df.schema[column].dataType, T.ArrayType):
        return df
    parse = parse_facts_or_lines if lines else parse_facts
    return df.withColumn(column, parse(column))


def clean_evaluation(df: DataFrame, text_nulls: bool = False) -> DataFrame:
    """Everything an evaluation input goes through; set ``text_nulls`` for tables read from CSV."""
    df = ensure_answer(require_columns(df))
    if text_nulls:
        df = null_words(df)
    df = drop_incomplete(df, [*fixed.EVALUATION_COLUMNS, "generated_response"])
    return read_fact_column(key_as_text(df))


def add_facts(df: DataFrame, facts: Column, column: str = "response_facts") -> DataFrame:
    """Append a fact list and its length, keeping all columns."""
    return df.withColumn(column, F.coalesce(facts, no_facts())).withColumn(f"{column}_count", F.size(column))


def reuse_facts(df: DataFrame, derived: Column, column: str = "response_facts") -> DataFrame:
    """Keep facts that are there, take ``derived`` where the list is empty or absent."""
    if column not in df.columns:
        return df.withColumn(column, derived)
    return df.withColumn(column, F.when(F.size(column) > 0, F.col(column)).otherwise(derived))


def facts_for(text: Column | str, facts: Column) -> Column:
    """No text, no facts."""
    return F.when(F.length(text) > 0, facts).otherwise(no_facts())


def with_outcome(df: DataFrame) -> DataFrame:
    """Add ``outcome``: refused, answered or, where the flag is null, failed."""
    flag = F.col("is_abstained")
    return df.withColumn("outcome", F.when(flag.isNull(), "failed").when(flag, "refused").otherwise("answered"))


def refused(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_abstained"))


def answered(df: DataFrame) -> DataFrame:
    """Rows known to be answers; failed rows, whose flag is null, are in neither group."""
    return df.where(~F.col("is_abstained"))


def failed(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_abstained").isNull())
