"""Model replies as a table.

Equal prompts are asked once.  Finished replies live in a store (``replystore``), so a run that was stopped asks
only what is still open, and a replan of a query never repeats a call.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factgrade import fixed
from factgrade.functions.prompts import prompt_hash
from factgrade.functions.replies import reply_status
from factgrade.operators import replystore, skew
from factgrade.operators.replystore import FINISHED, best_replies, read_store
from factgrade.sources import storage

#: Shares in which a run is committed unless told otherwise.
COMMITS = 4

Backend = Callable[[list[list[dict]]], list[str]]


def with_prompt_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("prompt_hash", prompt_hash("messages"))


def distinct_prompts(df: DataFrame) -> DataFrame:
    """(prompt_hash, messages), each prompt once.

    Repeats are dropped by their hash, before the shuffle as well; joins on the hash need no further one.
    """
    if "prompt_hash" not in df.columns:
        df = with_prompt_hash(df)
    return df.select("prompt_hash", "messages").dropDuplicates(["prompt_hash"])


def pending(prompts: DataFrame, store: DataFrame) -> DataFrame:
    """Prompts without a finished reply: never asked, or failed for the moment."""
    return prompts.join(store.where(F.col("status").isin(FINISHED)).select("prompt_hash"), "prompt_hash", "left_anti")


def join_replies(df: DataFrame, store: DataFrame, small: bool | None = None) -> DataFrame:
    """Give every row that asked a prompt its reply and status; a prompt may be asked by any share of the rows."""
    small = skew.fits_broadcast(store) if small is None else small
    joined = skew.lookup_join(df, best_replies(store), ["prompt_hash"], small=small)
    return joined.withColumn("status", F.coalesce("status", F.lit("missing")))


def ask(
    prompts: DataFrame, make_backend: Callable[[], Backend], parallel: int | None = None, batch: int = 16
) -> DataFrame:
    """Send prompts to a model and return (prompt_hash, reply, status).

    ``make_backend`` is called once per partition and returns a function from a list of message lists
    to a list of replies; if it raises, the job fails.  When a batch raises or returns another number of replies,
    its prompts are asked one by one: a prompt that raises alone becomes an ``ERROR: ...`` reply, one without
    exactly one reply a temporary failure, and the others are not touched by it.
    ``parallel`` bounds the number of simultaneous callers.
    """

    prefix = fixed.FAILURE_PREFIX  # tasks get plain values, so executors need no copy of this package
    unclear = f"{prefix} {fixed.TEMPORARY_FAILURES[0]}: not one reply for one prompt"

    def one(backend: Backend, prompt: list[dict]) -> str:
        try:
            got = list(backend([prompt]))
        except Exception as error:  # noqa: BLE001 - a failed call is data, not a failed job
            return f"{prefix} {error}"
        return unclear if len(got) != 1 else "" if got[0] is None else str(got[0])

    def several(backend: Backend, prompts: list[list[dict]]) -> list[str]:
        if len(prompts) > 1:
            try:
                got = list(backend(prompts))
                if len(got) == len(prompts):
                    return ["" if r is None else str(r) for r in got]
            except Exception:  # noqa: BLE001 - which prompt failed shows when each is asked alone
                pass
        return [one(backend, p) for p in prompts]

    def listed(column: pa.ListArray) -> list[list[dict]]:
        """The messages of each prompt; field by field, for value by value takes several times as long."""
        flat = column.flatten()
        if column.null_count or flat.null_count:
            return column.to_pylist()
        names = [field.name for field in flat.type]
        found = [dict(zip(names, values)) for values in zip(*(part.to_pylist() for part in flat.flatten()))]
        offsets = column.offsets.to_pylist()
        return [found[a - offsets[0] : b - offsets[0]] for a, b in itertools.pairwise(offsets)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = None
        for rows in batches:
            hashes = rows.column("prompt_hash").to_pylist()
            messages = listed(rows.column("messages"))
            replies: list[str] = []
            for start in range(0, len(messages), batch):
                backend = backend or make_backend()
                replies.extend(several(backend, messages[start : start + batch]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.string()), pa.array(replies, pa.string())], names=["prompt_hash", "reply"]
            )

    if parallel:
        prompts = prompts.repartition(parallel, "prompt_hash")
    raw = prompts.select("prompt_hash", "messages").mapInArrow(run, "prompt_hash string, reply string")
    return raw.withColumn("status", reply_status("reply"))


def mock_replies(prompts: DataFrame, reply: str = fixed.MOCK_REPLY) -> DataFrame:
    """Replies of the mock backend: the same text for every prompt."""
    return prompts.select("prompt_hash", F.lit(reply).alias("reply"), F.lit("ok").alias("status"))


def mock_yes() -> Callable[[], Backend]:
    """The mock of claim-by-claim checking: every claim is supported."""
    return mock_backend(fixed.MOCK_OPTION)


def mock_backend(reply: str = fixed.MOCK_REPLY) -> Callable[[], Backend]:
    return lambda: lambda batch: [reply] * len(batch)


def ask_pending(
    prompts: DataFrame,
    path: str,
    make_backend: Callable[[], Backend],
    parallel: int | None = None,
    batch: int = 16,
    commits: int = COMMITS,
    rounds: int = 1,
) -> DataFrame:
    """Ask what the store at ``path`` does not answer yet, add the replies, return the store.

    The work is committed share by share of the prompt space, so a stopped run loses at most the share it was
    working on; a new store has ``commits`` shares.  Of the store a share reads its own folder only, and the store's rows
    are not shuffled.  What fails for the moment is asked again in up to ``rounds`` rounds; waiting between calls is
    the backend's affair.  A store that has grown many files is compacted at the end.
    """
    spark = prompts.sparkSession
    before = replystore.current(spark, path)
    layout = before or replystore.open_store(spark, path, commits)
    if before is None:
        replystore.adopt_plain_files(spark, layout)
    folder = storage.shared_folder(spark, "prompts")
    prompts.select("prompt_hash", "messages", layout.share_of().alias("share")).write.partitionBy("share").parquet(folder)
    schema = T.StructType([prompts.schema["prompt_hash"], prompts.schema["messages"], T.StructField("share", T.IntegerType())])
    prompts = spark.read.schema(schema).parquet(folder)
    for number in range(rounds):
        if number and pending(prompts, read_store(spark, path)).isEmpty():
            break
        for share in range(layout.shares):
            left = pending(prompts.where(F.col("share") == share), replystore.read_share(spark, layout, share))
            replystore.append(layout, share, ask(left, make_backend, parallel, batch))
    replystore.tidy(spark, layout)
    return read_store(spark, path)


WINDOW_OVERLAP = 256


def classify(
    df: DataFrame,
    make_classifier: Callable[[], Callable[[list[str]], list[tuple[str, float]]]],
    text: str = "generated_response",
    batch: int = fixed.CLASSIFIER_BATCH,
) -> DataFrame:
    """Add ``classified`` (label, score) to every row; the classifier is built once per task.

    It sees every text whole: one longer than ``CLASSIFIER_CHARS`` goes in as overlapping windows.  A text is what its
    first window is, unless some window is a refusal: then it is the refusing window with the highest score.
    """
    size, step = fixed.CLASSIFIER_CHARS, fixed.CLASSIFIER_CHARS - WINDOW_OVERLAP
    passing, threshold = set(fixed.PASSING_LABELS), fixed.REFUSAL_THRESHOLD

    def windows(value: str | None) -> list[str]:
        value = value or ""
        return [value[i : i + size] for i in range(0, max(1, len(value) - WINDOW_OVERLAP), step)]

    def combined(found: list[tuple[str, float]]) -> tuple[str, float]:
        refusing = [f for f in found if int(str(f[0]).rsplit("_", 1)[-1]) not in passing and f[1] >= threshold]
        return max(refusing, key=lambda f: f[1]) if refusing else found[0]

    @F.pandas_udf("label string, score double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classifier = make_classifier()
        for series in texts:
            parts = [windows(v) for v in series]
            values = [w for part in parts for w in part]
            found = [pair for i in range(0, len(values), batch) for pair in classifier(values[i : i + batch])]
            ends = list(itertools.accumulate(map(len, parts)))
            rows = [combined(found[end - len(part) : end]) for part, end in zip(parts, ends)]
            yield pd.DataFrame(rows, columns=["label", "score"])

    return df.withColumn("classified", run(F.col(text)))
