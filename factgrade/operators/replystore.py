"""The folder of finished replies: shares in buckets, compacted under a manifest.

A store is cut twice by the hash of the prompt.  A share is a folder of its own, and a run that works on a share reads no
other.  Inside, replies lie in Spark's buckets, so the prompts still to ask are found by shuffling the prompts alone:
the store's rows are read where they lie.  Every run appends files; ``compact`` writes the best reply of each prompt
into a new version, one file per bucket, and the line that it then adds to the manifest makes that version the store.
Until then, and if it stops before, readers use the old one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade.sources import shared

REPLY_SCHEMA = "prompt_hash string, reply string, status string"
FINISHED = ["ok", "permanent"]
#: Files that a bucket may have on average before a run compacts the store.
FILES_PER_BUCKET = 16


@dataclass(frozen=True)
class Layout:
    path: str
    version: int
    shares: int
    buckets: int

    @property
    def folder(self) -> str:
        return f"{self.path}/v{self.version}"

    def share_of(self, prompt_hash: str = "prompt_hash") -> Column:
        return F.pmod(F.xxhash64(prompt_hash), F.lit(self.shares)).cast("int")


def none(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast("string").alias(c) for c in ("prompt_hash", "reply", "status")])


def read_or(spark: SparkSession, form: str, schema: str, path: str) -> DataFrame | None:
    """A table, or nothing where there is no such folder yet."""
    try:
        return spark.read.format(form).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current(spark: SparkSession, path: str) -> Layout | None:
    """The layout that the manifest names last; nothing for a folder that is no store (yet)."""
    lines = read_or(spark, "json", "version int, shares int, buckets int", f"{path}/manifest")
    last = lines.orderBy(F.desc("version")).first() if lines is not None else None
    return Layout(path, *last) if last else None


def declare(spark: SparkSession, layout: Layout) -> Layout:
    """Add a line to the manifest: a file of its own, which is there as a whole or not at all."""
    line = spark.range(1).select(*[F.lit(n).alias(c) for c, n in (("version", layout.version), ("shares", layout.shares), ("buckets", layout.buckets))])
    line.coalesce(1).write.mode("append").json(f"{layout.path}/manifest")
    return layout


def open_store(spark: SparkSession, path: str, shares: int, buckets: int | None = None) -> Layout:
    """The store at ``path``, made if need be.

    An existing store keeps its layout until it is compacted.  Buckets are as many as the session has shuffle
    partitions, with which prompts meet them one to one.
    """
    there = current(spark, path)
    if there:
        return there
    return declare(spark, Layout(path, 0, shares, buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _table(spark: SparkSession, layout: Layout, share: int) -> str:
    """The name under which this session knows a share of the store; the data stay in the store's folder."""
    name = f"replies_{hashlib.md5(layout.path.encode()).hexdigest()}_{layout.version}_{share}"
    folder = f"{layout.folder}/share={share}".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({REPLY_SCHEMA}) USING parquet "
        f"CLUSTERED BY (prompt_hash) SORTED BY (prompt_hash) INTO {layout.buckets} BUCKETS LOCATION '{folder}'"
    )
    spark.catalog.refreshTable(name)
    return name


def read_share(spark: SparkSession, layout: Layout, share: int) -> DataFrame:
    return spark.table(_table(spark, layout, share))


def append(layout: Layout, share: int, replies: DataFrame, dealt: bool = False) -> None:
    """Add replies to a share, one file for each bucket that gets any; ``dealt`` if they lie in its buckets already."""
    rows = replies.select("prompt_hash", "reply", "status")
    rows = rows if dealt else rows.repartition(layout.buckets, "prompt_hash")
    rows.write.insertInto(_table(replies.sparkSession, layout, share))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All replies of a store, or of a folder with plain files of them; empty when there are none."""
    layout = current(spark, path)
    found = read_or(spark, "parquet", REPLY_SCHEMA, layout.folder if layout else path)
    return none(spark) if found is None else found.select("prompt_hash", "reply", "status")


def best_replies(store: DataFrame) -> DataFrame:
    """One reply per prompt: a finished one if there is any."""
    order = F.when(F.col("status") == "ok", 0).when(F.col("status") == "permanent", 1).otherwise(2)
    kept = F.min(F.struct(order.alias("order"), "status", "reply"))
    return store.groupBy("prompt_hash").agg(kept.alias("_r")).select("prompt_hash", "_r.reply", "_r.status")


def adopt_plain_files(spark: SparkSession, layout: Layout) -> None:
    """Take the replies of a folder that was a store without a layout before; its files stay where they are."""
    plain = read_or(spark, "parquet", REPLY_SCHEMA, f"{layout.path}/*.parquet")
    if plain is not None:
        for share in range(layout.shares):
            append(layout, share, plain.where(layout.share_of() == share))


def compact(spark: SparkSession, path: str, shares: int | None = None, buckets: int | None = None, keep_old: bool = False) -> Layout:
    """The best reply of every prompt in a new version, possibly cut otherwise; then the old files go.

    With the same cut a share is rewritten bucket by bucket, without a shuffle.  No run may append meanwhile.
    """
    old = current(spark, path)
    if old is None:
        raise FileNotFoundError(f"no reply store at {path}")
    new = Layout(path, old.version + 1, shares or old.shares, buckets or old.buckets)
    # What a run that was stopped here left behind is no part of any version.
    shared.remove(spark, new.folder)
    same = (new.shares, new.buckets) == (old.shares, old.buckets)
    if same:
        for share in range(old.shares):
            append(new, share, best_replies(read_share(spark, old, share)), dealt=True)
    else:
        best = shared.materialise(best_replies(read_store(spark, path)).withColumn("share", new.share_of()), "best")
        for share in range(new.shares):
            append(new, share, best.where(F.col("share") == share))
    declare(spark, new)
    if not keep_old:
        for share in range(old.shares):
            spark.sql(f"DROP TABLE IF EXISTS {_table(spark, old, share)}")
        shared.remove(spark, old.folder)
    return new


def tidy(spark: SparkSession, layout: Layout) -> Layout:
    """Compact a store that has grown too many files."""
    there = read_or(spark, "parquet", REPLY_SCHEMA, layout.folder)
    files = 0 if there is None else len(there.inputFiles())
    return compact(spark, layout.path) if files > FILES_PER_BUCKET * layout.shares * layout.buckets else layout
