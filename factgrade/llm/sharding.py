"""Uniform random shards of exact size, by a hypergeometric communication matrix, in DataFrame functions alone.

The rows stand in parts (the partitions they were read in).  How many rows each part sends to each shard is drawn
first: the matrix of a uniformly random permutation has fixed row sums (part sizes) and column sums (shard sizes) and
is a chain of hypergeometric draws.  Then every part is permuted by itself and cut at the drawn counts, the pieces are
exchanged, and every shard is permuted again.  Together that is a uniform shuffle, and every shard has its exact size.

All randomness is a hash of a seed and of stable numbers, and rows are numbered in a written table, so a task that is
run again draws the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factgrade.llm.common import materialise

#: ``monotonically_increasing_id`` keeps the row's place in its partition in this many bits.
PLACE_BITS = 33
#: Rows of a shard that one task puts in order.
BUCKET_ROWS = 65_536
#: Half-width of the searched range in roots of the smallest margin.  What lies beyond is less than 2 exp(-2 * 6 ** 2) of the
#: whole by Hoeffding's bound, which changes no sum of doubles.
REACH = 6
#: Tree nodes from which on the matrix is drawn by several tasks.
SPREAD_LEVEL = 6


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) with 53 random bits, fixed by its keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") * 2.0**-53


def hypergeometric(good: Column, total: Column, n: Column, u: Column) -> Column:
    """How many of ``n`` rows drawn from ``total`` are among ``good`` of them: the inverse of ``u``.

    The weights of all counts are taken from the mode outwards by the ratio of neighbours, so no factorial is needed;
    the first pass sums them, the second finds the count at which the running sum passes ``u`` of it.
    """

    def steps(length: Column) -> Column:
        return F.when(length > 0, F.sequence(F.lit(0).cast("bigint"), length - 1)).otherwise(F.array().cast("array<bigint>"))

    def draw(v: Column) -> Column:
        good, total, n, mode = v["good"], v["total"], v["n"], v["mode"]
        bad = total - good

        def up(k: Column) -> Column:
            return ((good - k) * 1.0) * (n - k) / ((k + 1) * 1.0) / (bad - n + k + 1)

        def down(k: Column) -> Column:
            return (k * 1.0) * (bad - n + k) / ((good - k + 1) * 1.0) / (n - k + 1)

        def start(w: Column, **more: Column) -> Column:
            return F.struct(w.cast("double").alias("w"), F.lit(0.0).alias("s"), *[c.alias(k) for k, c in more.items()])

        above, below = steps(v["above"]), steps(v["below"])
        first_down = down(mode)

        def sums(a: Column, ratio: Callable[[Column], Column]) -> Column:
            return F.struct((a["w"] * ratio).alias("w"), (a["s"] + a["w"]).alias("s"))

        upper = F.aggregate(above, start(F.lit(1.0)), lambda a, i: sums(a, up(mode + i)), lambda a: a["s"])
        lower = F.aggregate(below, start(first_down), lambda a, i: sums(a, down(mode - 1 - i)), lambda a: a["s"])

        def search(t: Column, places: Column, first: Column, ratio: Callable[[Column], Column]) -> Column:
            def step(a: Column, i: Column) -> Column:
                s = a["s"] + a["w"]
                return F.struct((a["w"] * ratio(i)).alias("w"), s.alias("s"), (a["at"] + (s <= t).cast("bigint")).alias("at"))

            found = F.aggregate(places, start(first, at=F.lit(0).cast("bigint")), step, lambda a: a["at"])
            return F.least(found, F.size(places) - 1)

        def place(s: Column) -> Column:
            t = v["u"] * (s["up"] + s["down"])
            higher = mode + search(t, above, F.lit(1.0), lambda i: up(mode + i))
            lower_ = mode - 1 - search(t - s["up"], below, first_down, lambda i: down(mode - 1 - i))
            return F.when((t < s["up"]) | (F.size(below) == 0), higher).otherwise(lower_)

        return bind(F.struct(upper.alias("up"), lower.alias("down")), place).cast("bigint")

    low, high = F.greatest(F.lit(0), n - (total - good)), F.least(n, good)
    guess = F.floor((n + 1.0) * (good + 1.0) / (total + 2.0))
    mode = F.greatest(low, F.least(high, guess))
    reach = F.ceil(REACH * F.sqrt(F.greatest(F.lit(0), F.least(n, good, total - n, total - good)).cast("double"))) + 1
    ranges = F.struct(
        good.alias("good"),
        total.alias("total"),
        n.alias("n"),
        u.alias("u"),
        mode.alias("mode"),
        (F.least(high - mode, reach) + 1).alias("above"),
        F.least(mode - low, reach).alias("below"),
    )
    return bind(ranges, draw)


def draw_counts(sizes: Column, n: Column, key: Column, seed: int) -> Column:
    """How many of ``n`` rows go to each shard when the shards have ``sizes`` places left, all of which get filled."""
    total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x)
    start = F.struct(n.cast("bigint").alias("n"), total.alias("total"), F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, size: Column) -> Column:
        u = uniform(F.lit(seed), key, F.size(a["out"]))
        return bind(
            hypergeometric(size, a["total"], a["n"], u),
            lambda x: F.struct((a["n"] - x).alias("n"), (a["total"] - size).alias("total"), F.concat(a["out"], F.array(x)).alias("out")),
        )

    return F.aggregate(sizes, start, step, lambda a: a["out"])


def communication_matrix(parts: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, counts): how many rows each part sends to each shard, from (part, n).

    The parts are halved again and again, and the places of a node's shards are dealt to its halves by hypergeometric
    draws; nodes are rows.  The list of part sizes is one row at the root: 16 bytes for a partition of the input.
    """
    figures = parts.agg(F.count("*").alias("parts"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    each, more = divmod(figures["rows"], shards)
    sizes = F.array(*[F.lit(each + (s < more)).cast("bigint") for s in range(shards)])
    cell = F.struct("part", F.col("n").cast("bigint").alias("n"))
    nodes = parts.agg(F.sort_array(F.collect_list(cell)).alias("cells")).where(F.size("cells") > 0)
    nodes = nodes.select("cells", sizes.alias("sizes"), F.lit(1).cast("bigint").alias("node"))
    half = F.floor(F.size("cells") / 2).cast("int")

    def child(cells: Column, sizes: Column, node: Column) -> Column:
        return F.struct(cells.alias("cells"), sizes.alias("sizes"), node.alias("node"))

    for level in range(max(figures["parts"] - 1, 0).bit_length()):
        left = F.slice("cells", F.lit(1), half)
        right = F.slice("cells", half + 1, F.size("cells"))
        n = F.aggregate(left, F.lit(0).cast("bigint"), lambda a, c: a + c["n"])
        split = bind(
            draw_counts(F.col("sizes"), n, F.col("node"), seed),
            lambda given: F.array(
                child(left, given, F.col("node") * 2),
                child(right, F.zip_with("sizes", given, lambda a, b: a - b), F.col("node") * 2 + 1),
            ),
        )
        whole = F.array(child(F.col("cells"), F.col("sizes"), F.col("node") * 2))
        nodes = nodes.select(F.inline(F.when(F.size("cells") > 1, split).otherwise(whole)))
        if level == SPREAD_LEVEL:
            nodes = nodes.repartition(2 ** (SPREAD_LEVEL + 1), "node")
    return nodes.select(F.col("cells")[0]["part"].alias("part"), F.col("sizes").alias("counts"))


def shuffle(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1, sizes at most one apart) and ``slot`` (0, 1, ... within the shard).

    Every assignment of rows to places is equally likely.  Rows are what counts: repeated rows, null ids and null texts
    are rows like others, and equal texts are not kept together.  An empty table stays empty.  Columns of ``docs`` named
    ``shard`` or ``slot`` give way to the new ones; all others come back as they are.

    Only row numbers are permuted; the rows themselves move once, when their places are joined to them.  No task holds
    more than a partition of the input or ``BUCKET_ROWS`` numbers of a shard, on average.
    """
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("_"))
    numbered = materialise(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("at")), "numbered")
    rows = numbered.select("at", F.shiftright("at", PLACE_BITS).alias("part"))
    matrix = materialise(communication_matrix(rows.groupBy("part").agg(F.count("*").alias("n")), shards, seed), "matrix")

    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("local"), "at"), "at")
    upto = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda s: F.aggregate(F.slice("counts", 1, s), F.lit(0).cast("bigint"), lambda a, x: a + x))
    ends = matrix.select("part", upto.alias("ends"))
    sent = rows.withColumn("rank", F.row_number().over(local) - 1).join(ends, "part")
    shard = F.size(F.filter("ends", lambda end: end <= F.col("rank")))
    sent = materialise(sent.select("at", shard.alias("shard")), "sent")

    places = permuted_within(sent, shards, seed)
    chosen = [F.col(f"row.`{c}`").alias(c) for c in kept]
    return numbered.join(places, "at").select(*chosen, "shard", "slot")


def permuted_within(sent: DataFrame, shards: int, seed: int) -> DataFrame:
    """(at, shard, slot): rows of each shard in random order.

    A random key orders them.  Its leading bits are a bucket, so the place is the number of rows in lower buckets plus
    the place within the bucket, and no task sees a whole shard.
    """
    total = sent.count()
    bits = max(-(-total // (shards * BUCKET_ROWS)) - 1, 0).bit_length()
    key = F.xxhash64(F.lit(seed), F.lit("shard"), "at")
    bucket = F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("bigint")
    keyed = sent.select("at", "shard", key.alias("key"), bucket.alias("bucket"))
    counts = keyed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "at")
    ranked = keyed.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(starts, ["shard", "bucket"]).select("at", "shard", (F.col("start") + F.col("rank")).alias("slot"))


def write_shards(shuffled: DataFrame, folder: str, form: str = "parquet") -> str:
    """One folder per shard, its files and their rows in the order of the slots."""
    ordered = shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").format(form).save(folder)
    return folder
