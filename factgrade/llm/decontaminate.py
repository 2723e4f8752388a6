"""Benchmark decontamination with a broadcast set of test n-grams."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgrade.llm.common import map_rows, words

WINDOW = 13
SHARE = 20
#: Text of one slice of the benchmark that is sent to every executor.
SLICE_BYTES = 32 * 1024 * 1024
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
STEP = np.uint64(0x9E3779B97F4A7C15)


class Windows:
    """The windows of some benchmark items, looked up by rolling hash and verified word by word."""

    def __init__(self, items: list[tuple[int, str]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                self.items[tuple(ids[i : i + size])].add(item)
        rng = np.random.default_rng(13)
        self.codes = rng.integers(1, 2**63, len(self.vocabulary) + 1, dtype=np.uint64)
        by_size = defaultdict(list)
        for key in self.items:
            by_size[len(key)].append(key)
        self.hashes = {n: np.unique(self.hash(np.array(keys).T)) for n, keys in by_size.items()}

    def hash(self, columns: np.ndarray) -> np.ndarray:
        total = np.zeros(columns.shape[1], dtype=np.uint64)
        for column in columns:
            total = total * STEP + self.codes[column]
        return total

    def find(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Word ranges [start, end) inside occurrences, and the items that occur."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in found), dtype=np.int64, count=len(found))
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        ranges, items = [], set()
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            at = at[np.isin(self.hash(np.stack([ids[at + j] for j in range(size)])), hashes)]
            for i in at.tolist():
                there = self.items.get(tuple(ids[i : i + size].tolist()))
                if there:
                    ranges.append((i, i + size))
                    items |= there
        return ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None, text: str = "text"
) -> DataFrame:
    """Words of documents inside occurrences of benchmark windows.

    Adds ``n_words``, ``hits`` (disjoint word ranges, end exclusive) and ``items`` (sorted ids of the items with
    occurring windows) to the columns of ``keep``.  An item of fewer than ``window`` words is one window; items
    without words or without id take no part.  Null and empty texts have no words and no hits; repeated
    documents each get their row; with an empty benchmark nothing is hit.

    The windows of at most ``SLICE_BYTES`` of benchmark text are held by each worker.  A larger benchmark is cut
    into slices that are scanned for one after the other, in the same pass over the documents.
    """
    keep = ["doc_id"] if keep is None else keep
    tests = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id is not null and text is not null")
    total = tests.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    slices = max(1, -(-total // SLICE_BYTES))
    out = docs.withColumns({"_words": F.lit(0).cast("bigint"), "_hits": F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"), "_items": F.expr("cast(array() as array<bigint>)")})
    with_text = list(dict.fromkeys([*keep, text.partition(".")[0]]))
    out = out.select(*with_text, "_words", "_hits", "_items")
    for k in range(slices):
        share = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k) if slices > 1 else tests
        sent = docs.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in share.toLocalIterator()])

        def make(sent=sent):
            tests = Windows(sent.value, window)

            def scan(texts, hits, items):
                rows = []
                for text, old, ids in zip(texts, hits, items):
                    found = words(text)
                    ranges, there = tests.find(found)
                    ranges += [(h["start"], h["end"]) for h in old]
                    rows.append((len(found), [{"start": a, "end": b} for a, b in merged(ranges)], sorted(there.union(ids))))
                return rows

            return scan

        through = with_text if k < slices - 1 else keep
        out = map_rows(
            out, [text, "_hits", "_items"], make,
            "_words bigint, _hits array<struct<start:bigint,end:bigint>>, _items array<bigint>", through,
        )
    return out.withColumnsRenamed({"_words": "n_words", "_hits": "hits", "_items": "items"})


def hit_words() -> Column:
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["start"])


def is_contaminated(share: int = SHARE) -> Column:
    """At least one in ``share`` words lies in an occurrence."""
    return (hit_words() > 0) & (share * hit_words() >= F.col("n_words"))


def cut(text: str | None, hits: list) -> str | None:
    """The text without the words of the hits and what stands between them."""
    if not hits:
        return text
    spans = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for h in hits:
        out.append(text[at : spans[h["start"]][0]])
        at = spans[h["end"] - 1][1]
    return "".join([*out, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """Documents without contaminated ones (``remove="documents"``) or without hit spans (``"spans"``).

    All columns stay, whatever their names; null texts stay.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    found = find_hits(docs.select(F.struct(*docs.columns).alias("_row")), benchmark, window, ["_row"], "_row.text")
    if remove == "documents":
        return found.where(~is_contaminated(share)).select("_row.*")

    def make():
        return lambda texts, hits: [(cut(t, h),) for t, h in zip(texts, hits)]

    rows = map_rows(found, ["_row.text", "hits"], make, "_text string", ["_row"])
    return rows.select(F.col("_row").withField("text", F.col("_text")).alias("_row")).select("_row.*")
