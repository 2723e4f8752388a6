"""Near-duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification, components.

Equal word sequences form a class, and only its smallest document takes part in the search.  In each band every
member of a bucket is compared with the bucket's pivot first.  The links found there give components, which join most
of a large group of copies at the cost of one pair per member.  What is left are buckets with members of several
components: those are compared block against block inside tasks, which give out verified links only.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgrade.llm.common import counted_join, map_rows, materialise, space_words
from factgrade.operators.skew import fits_broadcast

WIDTH = 5
PERCENT = 85
#: 32 bands of 5: a pair at 0.85 shares no bucket with probability 7e-9.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BATCH = 32
#: A pair is given up once the probability that it reaches the threshold is below this.
MISS = 1e-6
#: Members of a bucket that are packed into one block.
BLOCK = 192
CACHE = 400_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_RNG = np.random.default_rng(10)
_FACTOR = (_RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_SHIFT = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)[:, None]


class Shingler:
    """Sets of hashed word shingles and their MinHash signatures; word hashes are kept in a bounded cache."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        known, out = self.known, []
        if len(known) > CACHE:
            known.clear()
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = int.from_bytes(blake2b(w, digest_size=8).digest(), "little")
            out.append(h)
        return np.array(out, dtype=np.uint64)

    def shingles(self, words: list[bytes], width: int = WIDTH) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles; fewer words than ``width`` make one shingle."""
        if not words:
            return np.empty(0, dtype=np.uint64)
        ids = self.word_hashes(words)
        size = min(width, len(ids))
        n = len(ids) - size + 1
        h = np.full(n, size, dtype=np.uint64)
        for j in range(size):
            h = (h ^ ids[j : j + n]) * _MIX[j % 5]
            h ^= h >> np.uint64(29)
        return np.unique(h)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
        for a in range(0, len(shingles), 2048):
            x = _FACTOR * shingles[None, a : a + 2048]
            x += _SHIFT
            np.minimum(best, x.min(1), out=best)
        return (best >> np.uint64(32)).astype(np.uint32)


def sequence_key(words: list[bytes]) -> bytes:
    return blake2b(b" ".join(words), digest_size=16).digest()


def features(docs: DataFrame) -> DataFrame:
    """doc_id, key of the word sequence, number of distinct shingles and signature."""

    def make():
        shingler = Shingler()

        def rows(texts):
            out = []
            for text in texts:
                words = space_words(text)
                if not words:
                    out.append((None, 0, None))
                    continue
                found = shingler.shingles(words)
                out.append((sequence_key(words), len(found), shingler.signature(found).tobytes()))
            return out

        return rows

    return map_rows(docs, ["text"], make, "key binary, n_shingles bigint, sig binary", ["doc_id"])


def shingle_sets(docs: DataFrame) -> DataFrame:
    """key and the sorted shingle hashes as bytes."""

    def make():
        shingler = Shingler()

        def rows(texts):
            found = [space_words(t) for t in texts]
            return [(sequence_key(w), shingler.shingles(w).tobytes()) for w in found]

        return rows

    return map_rows(docs, ["text"], make, "key binary, members binary", [])


def least_agreement(threshold: float, miss: float = MISS) -> dict[int, int]:
    """After so many compared hashes, the agreements from which P(similarity >= threshold) is at least ``miss``.

    The prior is uniform; the posterior after k agreements of m is a Beta(k + 1, m - k + 1).
    """
    grid = (np.arange(4000) + 0.5) / 4000
    out = {}
    for m in range(BATCH, HASHES + 1, BATCH):
        for k in range(m + 1):
            p = k * np.log(grid) + (m - k) * np.log1p(-grid)
            p = np.exp(p - p.max())
            if p[grid >= threshold].sum() / p.sum() >= miss:
                break
        out[m] = k
    return out


def plausible(a: np.ndarray, b: np.ndarray, table: dict[int, int]) -> np.ndarray:
    """Which rows of two signature tables stay plausible, comparing a batch of hashes at a time."""
    alive = np.arange(len(a))
    agreed = np.zeros(len(a), dtype=np.int64)
    for m, least in table.items():
        agreed[alive] += (a[alive, m - BATCH : m] == b[alive, m - BATCH : m]).sum(1)
        alive = alive[agreed[alive] >= least]
        if not len(alive):
            break
    return alive


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    inside = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inside >= percent * (len(a) + len(b) - inside)


def arrow_map(df: DataFrame, run, schema: str) -> DataFrame:
    return df.mapInArrow(run, schema)


def edge_batch(edges: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([e[0] for e in edges], pa.binary()), "b": pa.array([e[1] for e in edges], pa.binary())})


def prune(pairs: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs (a, b with sig_a, sig_b) that the sequential test leaves."""
    table = least_agreement(percent / 100, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=np.uint32).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
                alive = pa.array(plausible(a, b, table))
                yield pa.RecordBatch.from_arrays([part.column("a").take(alive), part.column("b").take(alive)], ["a", "b"])

    return arrow_map(pairs, run, "a binary, b binary")


def verify(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b with set_a, set_b) whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = []
            for a, b, x, y in zip(*(batch.column(c) for c in ("a", "b", "set_a", "set_b"))):
                if linked(np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64), percent):
                    edges.append((a.as_py(), b.as_py()))
            yield edge_batch(edges)

    return arrow_map(pairs, run, "a binary, b binary")


def compare_blocks(pairs: DataFrame, percent: int, miss: float) -> DataFrame:
    """Verified links between members of different components in two blocks of a bucket.

    A pair that shares several buckets is tested in the first of them only.  Links between two components that the
    same two blocks have already joined are left out; components stay the same without them.
    """
    table = least_agreement(percent / 100, miss)

    def unpack(members: list[dict]) -> tuple:
        return (
            [m["key"] for m in members],
            [m["root"] for m in members],
            np.array([m["n"] for m in members]),
            np.frombuffer(b"".join(m["sig"] for m in members), dtype=np.uint32).reshape(-1, HASHES),
            [np.frombuffer(m["members"], dtype=np.uint64) for m in members],
        )

    def links(left: list[dict], right: list[dict], same: bool, band: int) -> list[tuple[bytes, bytes]]:
        ka, ra, na, sa, ma = unpack(left)
        kb, rb, nb, sb, mb = unpack(right)
        number: dict[bytes, int] = {}
        ca, cb = (np.array([number.setdefault(r, len(number)) for r in roots]) for roots in (ra, rb))
        low, high = np.minimum(na[:, None], nb[None]), np.maximum(na[:, None], nb[None])
        open_ = (ca[:, None] != cb[None]) & (100 * low >= percent * high)
        if same:
            open_ &= np.arange(len(ka))[:, None] < np.arange(len(kb))[None]
        i, j = np.nonzero(open_)
        for earlier in range(band):
            if not len(i):
                return []
            cut = slice(earlier * ROWS, (earlier + 1) * ROWS)
            apart = (sa[i, cut] != sb[j, cut]).any(1)
            i, j = i[apart], j[apart]
        alive = []
        for start in range(0, len(i), 8192):
            x, y = i[start : start + 8192], j[start : start + 8192]
            keep = plausible(sa[x], sb[y], table)
            alive += zip(x[keep].tolist(), y[keep].tolist())
        parent = list(range(len(number)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for x, y in alive:
            p, q = find(int(ca[x])), find(int(cb[y]))
            if p != q and linked(ma[x], mb[y], percent):
                parent[p] = q
                out.append((ka[x], kb[y]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                i, j, band = (batch.column(c)[k].as_py() for c in ("i", "j", "band"))
                left = batch.column("left")[k].as_py()
                right = left if i == j else batch.column("right")[k].as_py()
                # No member may have been dealt to the other block.
                found = links(left, right, i == j, band) if right else []
                if found:
                    yield edge_batch(found)

    return arrow_map(pairs, run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node of the edges (a, b) but the roots.

    Large-star and small-star steps in turn until nothing changes; each step is a grouped minimum and a join in
    which hot nodes are cut into pieces.
    """
    edges = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        large = counted_join(both, least, "u", [F.col("v")], "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u != v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        joined = counted_join(large, least, "u", [F.col("v")], "inner")
        small = joined.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(
            F.col("e.v").alias("u"), F.col("e.m").alias("v")
        )
        edges = materialise(small.where("u != v").distinct(), "edges")
        mark = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == last:
            break
        last = mark
    return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")


def only(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed; the list is broadcast only when it is measured to be small."""
    return df.join(F.broadcast(keys) if fits_broadcast(keys) else keys, key, "left_semi")


def with_roots(df: DataFrame, roots: DataFrame) -> DataFrame:
    """Adds the component of ``key``; a class without links is its own component."""
    found = df.join(roots.select(F.col("node").alias("key"), F.col("root")), "key", "left")
    return found.withColumn("root", F.coalesce("root", "key"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when their sets of 5-word shingles have a Jaccard similarity of at least ``percent`` / 100;
    ``component_id`` is the smallest doc_id reachable over links.  Sets hold 64-bit hashes; a candidate pair is
    missed with a probability below ``miss`` plus 7e-9.  A text without words is linked with nothing.  A null doc_id
    takes no part: its component is null and it is kept.  Repeated rows get a row each; rows with equal ids and
    different texts are searched as different texts.  An empty table gives an empty one.
    """
    return classified(docs, percent, miss).select("doc_id", "n_shingles", "component_id", "kept")


def classified(docs: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """The rows of ``near_duplicates`` with the ``key`` of the row's word sequence, null without words."""
    rows = materialise(features(docs), "features")
    grouped = rows.where("key is not null and doc_id is not null").groupBy("key")
    classes = materialise(
        grouped.agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("first"), F.count("*").alias("copies")).select(
            "key", F.col("first.doc_id").alias("rep"), F.col("first.n_shingles").alias("n"), F.col("first.sig").alias("sig"), "copies"
        ),
        "classes",
    )
    band = F.struct(
        F.col("b").cast("int").alias("band"), F.xxhash64("b", F.expr(f"substring(sig, b * {4 * ROWS} + 1, {4 * ROWS})")).alias("bucket")
    )
    banded = classes.select("key", "n", "sig", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("b")).select("key", "n", band.alias("at"))
    banded = banded.select("key", "n", "at.band", F.col("at.bucket").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("key").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    shared = materialise(shared.withColumn("size", F.col("n")), "buckets")
    members = materialise(counted_join(banded.withColumnRenamed("n", "shingles"), shared, "bucket", [F.col("key")], "inner"), "members")

    keys = materialise(members.select("key").distinct(), "keys")
    active = only(classes, keys, "key")
    ids = materialise(active.select(F.col("rep").alias("doc_id")).distinct(), "ids")
    sets = only(shingle_sets(only(docs.select("doc_id", "text"), ids, "doc_id")), keys, "key").dropDuplicates(["key"])
    active = materialise(active.select("key", "n", "sig").join(sets, "key"), "active")

    pairs = members.where("key != pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs = with_both(materialise(pairs, "pairs"), active, ["n", "sig"])
    pairs = pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    pairs = materialise(prune(pairs.select("a", "b", "sig_a", "sig_b"), percent, miss), "plausible")
    links = with_both(pairs, active.withColumnRenamed("members", "set"), ["set"])
    links = materialise(verify(links, percent), "links")
    roots = materialise(components(links), "roots")

    placed = materialise(with_roots(members.where("size > 2").select("bucket", "band", "key", "size"), roots), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n")).where("x != y")
    blocks = counted_join(placed, mixed.select("bucket", "n"), "bucket", [F.col("key")], "inner")
    blocks = blocks.withColumn("count", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("i", F.pmod(F.xxhash64("key"), F.col("count")).cast("int"))
    each = F.struct("key", "root", "n", "sig", "members")
    blocks = blocks.join(active, "key").groupBy("bucket", "band", "count", "i").agg(F.collect_list(each).alias("left"))
    blocks = materialise(blocks, "blocks")
    first = blocks.withColumn("j", F.explode(F.expr("sequence(i, count - 1)")))
    second = blocks.where("i > 0").select("bucket", F.col("left").alias("right"), F.col("i").alias("j"), F.explode(F.expr("sequence(0, i - 1)")).alias("i"))
    more = compare_blocks(first.join(second, ["bucket", "i", "j"], "left").select("band", "i", "j", "left", "right"), percent, miss)
    more = materialise(more, "more")
    if not more.isEmpty():
        roots = materialise(components(links.unionByName(more)), "roots")

    labelled = materialise(with_roots(classes.select("key", "rep", "copies"), roots), "labelled")
    found = labelled.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("n"))
    labelled = counted_join(labelled, found, "root", [F.col("key")], "inner").select("key", "component_id", F.col("copies").alias("n"))
    out = counted_join(rows.select("doc_id", "key", "n_shingles"), materialise(labelled, "components"), "key", [F.col("doc_id")])
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "key", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def with_both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of both ends of pairs (a, b); many pairs may share their b, which is cut into pieces then."""
    a = table.select(F.col("key").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = table.select(F.col("key").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    counted = pairs.groupBy("b").agg(F.count("*").alias("n")).join(b, "b")
    return counted_join(pairs.join(a, "a"), counted, "b", [F.col("a")], "inner")


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents of ``docs`` that ``near_duplicates`` keeps, all columns as they are.

    Rows with a null id stay.  Of rows with equal ids those go whose own words ``near_duplicates`` doesn't keep, and
    one stays of those with the same words.
    """
    found = materialise(classified(docs, percent).where("doc_id is not null").select("doc_id", "key", "kept"), "found")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("dropped"))
    ids = materialise(ids.where("n > 1 or dropped > 0"), "decided")
    named = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"))
    single = without(named, ids.select(F.col("doc_id").alias("id"))).select("row.*")
    # Rows of repeated ids are told apart by their words.
    several = only(named, ids.where("n > 1 and dropped < n").select(F.col("doc_id").alias("id")), "id")
    several = map_rows(several, ["row.text"], sequence_keys, "key binary", ["row", "id"]).dropDuplicates(["id", "key"])
    bad = found.where(~F.col("kept")).select(F.col("doc_id").alias("id"), F.col("key").alias("bad")).distinct()
    several = several.join(bad, (several["id"] == bad["id"]) & several["key"].eqNullSafe(bad["bad"]), "left_anti")
    return single.unionByName(several.select("row.*")).select(*docs.columns)


def without(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose ``id`` isn't listed; the list is broadcast only when it is measured to be small."""
    return df.join(F.broadcast(keys) if fits_broadcast(keys) else keys, "id", "left_anti")


def sequence_keys():
    return lambda texts: [(sequence_key(words) if (words := space_words(text)) else None,) for text in texts]
