"""What the operators of this folder share: reading the tables, word rules and mapping over texts."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from factgrade.sources.storage import materialise

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
NOT_A_WORD = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: One step from UTF-8 bytes to lower-cased letters, digits and bytes of other scripts, with spaces between.
WORD_TABLE = bytes.maketrans(UPPER.encode() + NOT_A_WORD, LOWER.encode() + b" " * len(NOT_A_WORD))

__all__ = ["materialise"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def words(text: str | None) -> list[bytes]:
    """Words of letters, digits and other scripts; only A-Z is lower-cased."""
    return utf8(text).translate(WORD_TABLE).split()


def space_words(text: str | None) -> list[bytes]:
    """Words between white space (the six ASCII characters); only A-Z is lower-cased."""
    return utf8(text).lower().split()


def remainder(key: Column | str, divisor: int) -> Column:
    """CRC-32 of the key as text, modulo the divisor; a null key counts as the empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % divisor


def map_rows(
    df: DataFrame, columns: list[str], make: Callable[[], Callable[..., list[tuple]]], added: str, keep: list[str] | None = None
) -> DataFrame:
    """Columns computed by Python from the values of ``columns``, a batch of rows at a time.

    ``make`` is called once per task and returns a function from lists of values (one list per column) to one
    tuple per row; a column may be a field of a struct (``row.text``).  The columns of ``keep`` pass through untouched.
    """
    keep = [] if keep is None else keep
    paths = [c.partition(".")[::2] for c in columns]
    need = list(dict.fromkeys([*keep, *[outer for outer, _ in paths]]))
    spark = df.sparkSession
    kept = df.select(*keep).schema if keep else None
    empty = spark.createDataFrame([], added).schema
    schema = reduce(lambda s, f: s.add(f), empty.fields, _copy(kept))
    arrow = to_arrow_schema(schema)
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                whole = [(part.column(need.index(outer)), inner) for outer, inner in paths]
                values = [(c.field(inner) if inner else c).to_pylist() for c, inner in whole]
                rows = call(*values)
                made = list(zip(*rows)) if rows else [()] * (len(arrow) - n_keep)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).cast(arrow.field(i).type) for i in range(n_keep)]
                    + [pa.array(list(m), arrow.field(n_keep + i).type) for i, m in enumerate(made)],
                    schema=arrow,
                )
        # Workers are used again: what this task cached and what Arrow holds for it goes.
        del call
        pa.default_memory_pool().release_unused()

    return df.select(*need).mapInArrow(run, schema)


def _copy(schema: Any) -> Any:
    from pyspark.sql.types import StructType

    return StructType(list(schema.fields) if schema is not None else [])


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


#: A key with more than this share of all rows is hot, so at most 500 keys are.
HOT_SHARE = 0.002
PIECE_ROWS = 64


def counted_join(left: DataFrame, right: DataFrame, key: str, salt: list[Column], how: str = "left", piece: bool = False) -> DataFrame:
    """``left`` joined to ``right``, which has one row per key and in ``n`` how many rows of ``left`` have it.

    Keys with more than ``HOT_SHARE`` of the rows, of which there are at most ``1 / HOT_SHARE``, are cut into pieces
    by the hash of ``salt``: as many as the hottest needs.  The pieces depend on row contents only: a task that is
    run again puts its rows where they were.  With ``piece`` the result keeps that column, so that a later grouping
    by key, piece and salt needs no further shuffle.
    """
    total = max(right.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], 1)
    hot = right.where((F.col("n") > HOT_SHARE * total) & (F.col("n") > PIECE_ROWS)).select(key, "n").collect()
    if hot:
        most = max(r["n"] for r in hot)
        pieces = max(2, min(-(-most // PIECE_ROWS), math.ceil(most / (HOT_SHARE * total))))
        is_hot = F.col(key).isin([r[key] for r in hot])
        left = left.withColumn("_piece", F.when(is_hot, F.pmod(F.xxhash64(*salt), F.lit(pieces)).cast("int")).otherwise(0))
        last = F.when(is_hot, pieces - 1).otherwise(0)
        right = right.withColumn("_piece", F.explode(F.sequence(F.lit(0), last)))
        joined = left.join(right.drop("n"), [key, "_piece"], how)
        return joined if piece else joined.drop("_piece")
    joined = left.join(right.drop("n"), key, how)
    return joined.withColumn("_piece", F.lit(0)) if piece else joined
