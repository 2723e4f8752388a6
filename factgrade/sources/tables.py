"""Input tables: CSV, JSON Lines, JSON arrays and parquet, single files or folders."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factgrade.functions.text import source_id
from factgrade.operators.clean import null_words
from factgrade.operators.rows import union_all

CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "quote": '"'}


INTEGER = r"^\s*[+-]?[0-9]{1,18}\s*$"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
BOOLEAN = r"^(true|false|True|False|TRUE|FALSE)$"


def infer_types(df: DataFrame) -> DataFrame:
    """String columns whose values are all whole numbers, numbers or booleans as that type, in one pass.

    Nulls do not count, so words for "no value" should be null by then; a column of nulls stays text.
    """
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != "source_file"]
    if not strings:
        return df
    kinds = (("bigint", INTEGER), ("double", NUMBER), ("boolean", BOOLEAN))
    tests = [F.count_if(~F.col(f"`{c}`").rlike(p)).alias(f"{i}_{kind}") for i, c in enumerate(strings) for kind, p in kinds]
    seen = [F.count(f"`{c}`").alias(f"{i}_seen") for i, c in enumerate(strings)]
    found = df.agg(*tests, *seen).first()
    types = {
        c: next((kind for kind, _ in kinds if found[f"{i}_seen"] and not found[f"{i}_{kind}"]), None) for i, c in enumerate(strings)
    }
    return df.withColumns({c: F.trim(f"`{c}`").cast(kind) for c, kind in types.items() if kind}) if any(types.values()) else df


def shaped(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Columns by name in the types of ``schema``: values that do not fit and absent columns are null."""
    if isinstance(schema, str):
        schema = df.sparkSession.createDataFrame([], schema).schema
    there = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ],
        *[c for c in ("source_file",) if c in there and c not in schema.names],
    )


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header and quoted multi-line fields; words for "no value" are null, columns go by their names.

    A multi-line file is read by one task, so large inputs should come as many files.  Give a schema to save
    the pass that infers types, which comes after the words for "no value" are gone.
    """
    df = null_words(spark.read.options(**CSV_OPTIONS).csv(path))
    return shaped(df, schema) if schema else infer_types(df)


def read_files(spark: SparkSession, paths: list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV files with headers of their own as one table, columns by name, with ``source_file``.

    Files are grouped by their header, and each group is read with it; columns that a file lacks are null.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect()
    if not groups:
        raise FileNotFoundError("no CSV file with a header")
    parts = [
        spark.read.options(**CSV_OPTIONS).csv([unquote(p) for p in g["paths"]]).withColumn("source_file", F.col("_metadata.file_name")) for g in groups
    ]
    df = null_words(union_all(parts))
    return shaped(df, schema) if schema else infer_types(df)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON array of records; lists inside the records stay arrays."""
    reader = spark.read.option("multiLine", True)
    if schema:
        return reader.schema(schema).json(path)
    df = reader.json(path)
    fields = df.schema.fields
    by_column = [f for f in fields if isinstance(f.dataType, T.StructType) and all(n.isdigit() for n in f.dataType.names)]
    if fields and len(by_column) == len(fields):
        raise ValueError(f"{path} is organised by column; an array of records is needed")
    return df


READERS = {".csv": read_csv, ".jsonl": read_jsonl, ".json": read_json}


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A table by its extension, in any letter case."""
    extension = next((e for e in (".jsonl", ".json", ".csv", ".parquet") if path.lower().rstrip("/").endswith(e)), None)
    if extension is None:
        raise ValueError(f"no reader for {path}: the name must end in .csv, .json, .jsonl or .parquet")
    try:
        if extension == ".parquet":
            return spark.read.parquet(path)
        return READERS[extension](spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"File not found: {path}") from error
        raise


def read_folder(
    spark: SparkSession, folder: str, glob: str = "*.[cC][sS][vV]", schema: T.StructType | str | None = None
) -> DataFrame:
    """All CSV files of a folder as one table with ``source_file`` and a ``row_id`` that rises within each file.

    Columns go by their names: files may have different ones, in any order.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path")
    paths = [unquote(r["path"]) for r in listed.collect()]
    if not paths:
        raise FileNotFoundError(f"no file like {glob} in {folder}")
    return with_row_id(read_files(spark, paths, schema))


def with_row_id(df: DataFrame) -> DataFrame:
    """Number the rows of a table that was just read.

    Ids are unique and follow the order within each file.  Write the table before using the ids in several
    queries (``storage.materialise``), so that all of them see the same numbers.
    """
    return df if "row_id" in df.columns else df.withColumn("row_id", F.monotonically_increasing_id())


def with_source_id(df: DataFrame, file_name: str = "source_file", column: str = "model") -> DataFrame:
    """Model name taken from the name of the result file."""
    return df.withColumn(column, source_id(file_name))
