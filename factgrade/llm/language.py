"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

Counts of all training tokens come first and rank them.  The most frequent tokens, the head, are words of a softmax in
classes of equal size.  All others, the tail, are reached from a further class through a tree that parts the words
into two classes of equal mass again and again, with a softmax over the two at each node, down to classes of rare words.  Features of a place are
hashed: a bias, the token before, the one before that (a skip), and both (an n-gram); in the tail they are whole tokens
together with the node.  Weights of both parts follow gradients that are summed over tasks: the head's over counted
events, the tail's over the training places, where they stand.  The weight tables are broadcast and texts are scored
where they are.  A chunk's own vocabulary is joined to the ranks, so that no task holds the vocabulary of the corpus.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgrade.llm.common import materialise, remainder
from factgrade.sources.storage import remove, shared_folder

FOLDS, HELD_OUT = 7, 2
#: Tokens of a chunk; a longer document is a chunk by itself.
CHUNK_TOKENS = 3_000_000
CLASSES, CLASS_WORDS = 16, 16
HEAD = CLASSES * CLASS_WORDS - 1
TAIL_BUCKETS = 64
START = HEAD + TAIL_BUCKETS
CONTEXTS = START + 1
#: Rows of the weight table that features are hashed to; one more row is the bias.
WIDTH = 2048
WORDS_WIDTH = CLASSES * CLASS_WORDS
COLUMNS = CLASSES + 1 + WORDS_WIDTH
ROUNDS, RATE, SMOOTHING = 8, 0.5, 4.0
SHARDS = 16
#: Rows of the tail's weight table: one for so many training tokens, between these powers of two (16 MB at most).
ROW_TOKENS, LEAST_ROWS, MOST_ROWS = 256, 16, 22
TAIL_ROUNDS, TAIL_SMOOTHING = 2, 1.0
#: Training tokens under which a class of tail words isn't parted further; in it each word has its share.
CLASS_MASS = 64
#: Tokens of texts that are laid end to end, and places of these whose way through the tree is worked out at a time.
TEXT_STEP, TAIL_STEP = 500_000, 32_768
#: Events that are summed, and pairs of contexts whose probabilities are worked out, at a time.
EVENT_STEP, PAIR_STEP = 1_000_000, 4096


def is_held_out():
    return remainder("doc_id", FOLDS) == HELD_OUT


def pressed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, first all lowest bytes, compressed; the first four bytes hold how many they are."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T)
    return len(numbers).to_bytes(4, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def restored(blobs: list[bytes], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of some ``pressed`` arrays, laid end to end, and how many each has."""
    sizes, width = np.array([int.from_bytes(x[:4], "little") for x in blobs], dtype=np.int64), np.dtype(kind).itemsize
    planes = [np.frombuffer(pa.decompress(x[4:], n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n) for x, n in zip(blobs, sizes.tolist())]
    numbers = np.empty((sizes.sum(), width), dtype=np.uint8)
    for k, plane in enumerate(np.concatenate(planes, axis=1)):
        numbers[:, k] = plane
    return numbers.view(kind).ravel(), sizes


# ---- counting


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts, and where those of each text end; an empty token is the end of a text, no word is empty."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # A space at the end of a text leaves an empty word after it, as the empty text has by itself.
    lists = pc.ascii_split_whitespace(pc.if_else(pc.equal(trimmed, ""), "", pc.binary_join_element_wise(trimmed, "", " ")))
    return lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy())


def chunked(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents as ids of their chunk's vocabulary, and the vocabularies with counts over training texts.

    Both are written to ``folder`` in one pass: (chunk, doc_id, held_out, ids) and (chunk, at, token, n).
    """
    schema = "kind string, chunk bigint, doc_id bigint, held_out boolean, ids binary, at int, token binary, n bigint"
    arrow = pa.schema(
        [("kind", pa.string()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("ids", pa.binary()), ("at", pa.int32()), ("token", pa.binary()), ("n", pa.int64())]
    )

    def packed(kind: str, chunk: int, rows: int, **columns: list | np.ndarray | pa.Array) -> pa.RecordBatch:
        given = {"kind": [kind] * rows, "chunk": [chunk] * rows, **columns}
        return pa.RecordBatch.from_arrays([pa.array(given[f.name], f.type) if f.name in given else pa.nulls(rows, f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        rows: list[pa.RecordBatch] = []
        tokens: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        size = 0

        def chunk() -> Iterator[pa.RecordBatch]:
            coded = pa.chunked_array(tokens).combine_chunks().dictionary_encode()
            numbers, known = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())
            trained = np.repeat([not h for part in rows for h in part.column("held_out").to_pylist()], np.concatenate(sizes))
            counts = np.bincount(numbers[trained], minlength=len(known))
            ends = np.cumsum(np.concatenate(sizes))
            for part in rows:
                mine, ends = ends[: part.num_rows], ends[part.num_rows :]
                ids = [pressed(x) for x in np.split(numbers[: mine[-1]], mine[:-1])]
                numbers, ends = numbers[mine[-1] :], ends - mine[-1]
                yield packed("texts", number, part.num_rows, doc_id=part.column("doc_id"), held_out=part.column("held_out"), ids=ids)
            for a in range(0, len(known), 50_000):
                some = known.slice(a, 50_000)
                yield packed("words", number, len(some), at=np.arange(a, a + len(some), dtype=np.int32), token=some, n=counts[a : a + len(some)])

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                words, ends = tokens_of(part.column("text"))
                part, first, begin = part.select(["doc_id", "held_out"]), 0, 0
                while first < part.num_rows:
                    # Up to the text that fills the chunk, or all that are left.
                    last = min(int(np.searchsorted(ends, begin + CHUNK_TOKENS - size)) + 1, part.num_rows)
                    rows.append(part.slice(first, last - first))
                    tokens.append(words.slice(begin, ends[last - 1] - begin))
                    sizes.append(np.diff(ends[first:last], prepend=begin))
                    size += int(ends[last - 1]) - begin
                    first, begin = last, int(ends[last - 1])
                    if size >= CHUNK_TOKENS:
                        yield from chunk()
                        number, size, rows, tokens, sizes = number + 1, 0, [], [], []
        if rows:
            yield from chunk()

    flat = docs.select("doc_id", is_held_out().alias("held_out"), "text").mapInArrow(run, schema)
    flat.write.partitionBy("kind").option("compression", "zstd").parquet(folder)

    def stored(kind: str, *columns: str) -> DataFrame:
        return docs.sparkSession.read.schema(schema).parquet(folder).where(F.col("kind") == kind).select(*columns)

    return stored("texts", "chunk", "doc_id", "held_out", "ids"), stored("words", "chunk", "at", "token", "n")


# ---- the model


def contexts_of(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Head tokens stand for themselves, others for a bucket of their last letters."""
    return np.where(codes < HEAD, codes, HEAD + letters.astype(np.int64))


def feature_rows(before: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Rows of the weight table for each place: bias, token before, skip, and both."""

    def hashed(kind: int, value: np.ndarray) -> np.ndarray:
        h = (value.astype(np.uint64) + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.int64) % WIDTH

    bias = np.full(len(before), WIDTH, dtype=np.int64)
    return np.stack([bias, hashed(1, before), hashed(2, second), hashed(3, before * CONTEXTS + second)])


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def group_of(target: np.ndarray) -> np.ndarray:
    """Classes of words; the tail is a class by itself."""
    return np.where(target >= HEAD, CLASSES, target // CLASS_WORDS)


def row_sums(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = table.take(rows[0], 0)
    for r in rows[1:]:
        total += table.take(r, 0)
    return total


def unknown(known: np.ndarray, keys: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct keys that aren't known yet, ``PAIR_STEP`` at a time; they are known from now on."""
    here = np.zeros(len(known), dtype=bool)
    here[keys] = True
    new = np.flatnonzero(here & ~known)
    known[new] = True
    return (new[a : a + PAIR_STEP] for a in range(0, len(new), PAIR_STEP))


class Weights:
    """One row per feature: columns for the classes, then for the words of each class."""

    def __init__(self, table: np.ndarray, head: list[bytes]) -> None:
        self.table, self.head = table, head
        self.rank = {t: k for k, t in enumerate(head)}
        self.rows = None

    def split(self) -> tuple[np.ndarray, np.ndarray]:
        classes = np.ascontiguousarray(self.table[:, : CLASSES + 1])
        return classes, np.ascontiguousarray(self.table[:, CLASSES + 1 :]).reshape(-1, CLASS_WORDS)

    def log_probability(self, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of words, for tails that of their class."""
        classes, words = self.split()
        group = group_of(target)
        out = log_softmax(row_sums(classes, rows))[np.arange(len(target)), group].astype(np.float64)
        inside = np.flatnonzero(group < CLASSES)
        if len(inside):
            total = row_sums(words, rows[:, inside] * CLASSES + group[inside])
            out[inside] += log_softmax(total)[np.arange(len(inside)), target[inside] % CLASS_WORDS]
        return out

    def at_places(self, before: np.ndarray, second: np.ndarray, target: np.ndarray) -> np.ndarray:
        """``log_probability`` of words after pairs of contexts; what depends on the pair alone is worked out once for each."""
        if self.rows is None:
            pairs = CONTEXTS * CONTEXTS
            self.rows = feature_rows(*np.divmod(np.arange(pairs), CONTEXTS)).astype(np.int32)
            self.classes, self.words = self.split()
            self.known, self.known_inside = np.zeros(pairs, dtype=bool), np.zeros(pairs * CLASSES, dtype=bool)
            self.log_class = np.empty((pairs, CLASSES + 1), dtype=np.float32)
            self.most, self.log_sum = (np.empty(pairs * CLASSES, dtype=np.float32) for _ in range(2))
        pair, group = before * CONTEXTS + second, group_of(target)
        for some in unknown(self.known, pair):
            self.log_class[some] = log_softmax(row_sums(self.classes, self.rows[:, some]))
        out = self.log_class.ravel().take(pair * (CLASSES + 1) + group).astype(np.float64)
        inside = np.flatnonzero(group < CLASSES)
        pair, target = pair[inside], target[inside]
        at = pair * CLASSES + group[inside]
        for some in unknown(self.known_inside, at):
            total = row_sums(self.words, self.rows[:, some // CLASSES] * np.int64(CLASSES) + some % CLASSES)
            self.most[some] = total.max(1)
            self.log_sum[some] = np.log(np.exp(total - self.most[some][:, None]).sum(1))
        total = row_sums(self.words.ravel(), self.rows[:, pair] * np.int64(WORDS_WIDTH) + target)
        out[inside] += total - self.most[at] - self.log_sum[at]
        return out

    def observed(self, rows: np.ndarray, target: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Counts of (feature, column) over events that occur ``n`` times."""
        seen = np.zeros_like(self.table, dtype=np.float64)
        group = group_of(target)
        inside = np.flatnonzero(group < CLASSES)
        for r in rows:
            seen += np.bincount(r * COLUMNS + group, n, seen.size).reshape(seen.shape)
            seen += np.bincount(r[inside] * COLUMNS + CLASSES + 1 + target[inside], n[inside], seen.size).reshape(seen.shape)
        return seen

    def expected(self, pair: np.ndarray, group: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What the model expects of ``observed`` where a word of the class ``group`` follows a pair of contexts ``n`` times."""
        classes, words = self.split()
        wide = CLASSES + 1
        out, size = np.zeros_like(self.table, dtype=np.float64), len(self.table)
        inside = np.flatnonzero(group < CLASSES)
        rows = feature_rows(*np.divmod(pair[inside], CONTEXTS)) * CLASSES + group[inside]
        q = np.exp(log_softmax(row_sums(words, rows))) * n[inside, None]
        for r in rows:
            flat = (r[:, None] * CLASS_WORDS + np.arange(CLASS_WORDS)).ravel()
            out[:, wide:] += np.bincount(flat, q.ravel(), size * WORDS_WIDTH).reshape(size, WORDS_WIDTH)
        n = np.bincount(pair, n, CONTEXTS * CONTEXTS)
        pair = np.flatnonzero(n)
        rows = feature_rows(*np.divmod(pair, CONTEXTS))
        p = np.exp(log_softmax(row_sums(classes, rows))) * n[pair, None]
        for r in rows:
            flat = (r[:, None] * wide + np.arange(wide)).ravel()
            out[:, :wide] += np.bincount(flat, p.ravel(), size * wide).reshape(size, wide)
        return out


def places(contexts: np.ndarray, starts: np.ndarray, none: int = START) -> tuple[np.ndarray, np.ndarray]:
    """The contexts before each token of texts laid end to end; ``starts`` are the first tokens of the texts."""
    before = np.concatenate([[none], contexts[:-1]])
    before[starts] = none
    second = np.concatenate([[none], before[:-1]])
    second[starts] = none
    return before, second


# ---- the tail


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Tail:
    """The tree over the words beyond the head, in order of falling count; the last code is that of all unseen words.

    A node covers a range of codes and parts it into two classes of nearly equal mass, so that a word's depth follows
    its frequency.  The masses come from ``runs``, how many words have each count: at most sqrt(2 N) rows for N
    training tokens.  No node is stored anywhere, a task works out those on the way to its own words.
    """

    def __init__(self, runs: list[tuple[int, int]], begin: int) -> None:
        counts, sizes = (np.array(x, dtype=np.int64) for x in zip(*runs, (0, 1)))
        self.counts, self.ends = counts, np.cumsum(sizes)
        sizes = np.minimum(sizes, np.maximum(self.ends - begin, 0))
        each, sizes = counts[sizes > 0] + 1.0, sizes[sizes > 0]
        self.begin, self.each = begin, each
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.mass = np.concatenate([[0.0], np.cumsum(sizes * each)])

    def count(self, codes: np.ndarray) -> np.ndarray:
        """How often words stand in the training texts."""
        return self.counts[np.searchsorted(self.ends, codes, "right")]

    def below(self, place: np.ndarray) -> np.ndarray:
        """The mass of the words before a place."""
        run = np.clip(np.searchsorted(self.first, place, "right") - 1, 0, len(self.each) - 1)
        return self.mass[run] + (place - self.first[run]) * self.each[run]

    def nearest(self, mass: np.ndarray) -> np.ndarray:
        """The place with about so much mass before it."""
        run = np.clip(np.searchsorted(self.mass, mass, "right") - 1, 0, len(self.each) - 1)
        return np.rint(self.first[run] + (mass - self.mass[run]) / self.each[run]).astype(np.int64)

    def walk(self, codes: np.ndarray, before: np.ndarray, second: np.ndarray, size: int) -> Iterator[tuple]:
        """From the root down: the places still on their way, their rows of a table of ``size``, the nodes' turns and bias.

        ``codes`` ascend, so that the places at a node are a range, and turns are how many of them go left and right.
        The features of a node are the token before, the skip and both; the bias is the logarithm of the masses' ratio.
        At the end it yields the places' shares of their last classes.
        """
        place = codes.astype(np.int64) - self.begin
        x, y = before.astype(np.uint64), second.astype(np.uint64)
        features = [mixed(v).astype(np.uint32) for v in (x + np.uint64(1 << 40), y + np.uint64(2 << 40), mixed(x) + y)]
        shift = np.uint32(33 - size.bit_length())
        at: np.ndarray | slice = slice(None)
        last = np.zeros(len(codes))
        # Nodes that are reached here: their ranges of codes, and how many places each has.
        low, high, own = np.array([0]), self.first[-1:], np.array([len(codes)])
        while True:
            light, heavy = self.below(low), self.below(high)
            open_ = (high - low > 1) & (heavy - light > CLASS_MASS)
            if not open_.all():
                stay = np.repeat(open_, own)
                at = np.arange(len(codes))[at]
                last[at[~stay]] = np.repeat((heavy - light)[~open_], own[~open_])
                more = np.flatnonzero(stay)
                at, place, features = at[more], place[more], [f[more] for f in features]
                low, high, light, heavy, own = (v[open_] for v in (low, high, light, heavy, own))
            if not len(place):
                break
            cut = np.minimum(np.maximum(self.nearest((light + heavy) / 2), low + 1), high - 1)
            middle = self.below(cut)
            bias = np.log(np.maximum(heavy - middle, 1e-9) / np.maximum(middle - light, 1e-9)).astype(np.float32)
            node = np.repeat(mixed(mixed(low.astype(np.uint64)) + high.astype(np.uint64)).astype(np.uint32), own)
            left = np.searchsorted(place, cut) - np.cumsum(own) + own
            turns = np.stack([left, own - left], 1).ravel()
            rows = []
            for f in features:
                h = f ^ node
                h *= np.uint32(0x9E3779B1)
                rows.append(np.right_shift(h, shift, out=np.empty(len(h), dtype=np.int64), casting="unsafe"))
            yield at, rows, turns, bias
            used = turns > 0
            low, high, own = np.stack([low, cut], 1).ravel()[used], np.stack([cut, high], 1).ravel()[used], turns[used]
        yield slice(None), last

    @staticmethod
    def by_code(codes: np.ndarray) -> Iterator[np.ndarray]:
        """Places in order of their codes, ``TAIL_STEP`` at a time: those of a step share most of their nodes."""
        order = np.argsort(codes)
        return (order[a : a + TAIL_STEP] for a in range(0, len(order), TAIL_STEP))

    @staticmethod
    def rightward(turns: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(turns)) % 2 == 1, turns)

    @staticmethod
    def logits(table: np.ndarray, rows: list[np.ndarray], turns: np.ndarray, bias: np.ndarray) -> np.ndarray:
        x = np.repeat(bias, turns[::2] + turns[1::2])
        for r in rows:
            x += table.take(r, mode="clip")
        return x

    def log_probability(self, table: np.ndarray, codes: np.ndarray, before: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of words given that they are of the tail."""
        out = np.zeros(len(codes))
        for some in self.by_code(codes):
            own = codes[some]
            part = np.zeros(len(some))
            for at, *turn in self.walk(own, before[some], second[some], len(table)):
                if len(turn) == 1:
                    part += np.log((self.count(own) + 1) / turn[0])
                    continue
                rows, turns, bias = turn
                against = self.logits(table, rows, turns, bias)
                np.negative(against, out=against, where=self.rightward(turns))
                small = np.abs(against)
                np.log1p(np.exp(np.negative(small, out=small), out=small), out=small)
                part[at] -= np.add(np.maximum(against, 0, out=against), small, out=small)
            out[some] = part
        return out

    def add_statistics(self, total: np.ndarray, table: np.ndarray, codes: np.ndarray, before: np.ndarray, second: np.ndarray) -> None:
        """Adds the gradient and the curvature of the places to the two rows of ``total``."""
        known = table.any()
        # Both go to the same row, so they are the two parts of one number: half the memory that is reached at random.
        sums = np.zeros(len(table), dtype=np.complex64)
        for some in self.by_code(codes):
            for _, *turn in self.walk(codes[some], before[some], second[some], len(table)):
                if len(turn) > 1:
                    rows, turns, bias = turn
                    # Without weights the places of a node have one probability.
                    p = 1 / (1 + np.exp(-(self.logits(table, rows, turns, bias) if known else np.repeat(bias, 2))))
                    both = np.empty(len(p), dtype=np.complex64)
                    both.real = (self.rightward(turns) if known else np.arange(len(turns)) % 2 == 1) - p
                    both.imag = p * (1 - p)
                    both = both if known else np.repeat(both, turns)
                    for r in rows:
                        np.add.at(sums, r, both)
        total[0] += sums.real
        total[1] += sums.imag


def table_size(tokens: int) -> int:
    """Rows of the tail's weight table, in proportion to the training tokens as far as a broadcast allows."""
    return 1 << min(MOST_ROWS, max(LEAST_ROWS, (tokens // ROW_TOKENS).bit_length()))


def tail_places(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Code, token before and skip of the tail words in some texts, the latter two as whole tokens."""
    for _, codes, starts in laid_out(batch):
        before, second = places(codes.astype(np.int64) + 1, starts, 0)
        there = np.flatnonzero(codes >= HEAD)
        yield codes[there], before[there], second[there]


def train_tail(coded: DataFrame, tail: Tail, tokens: int, rounds: int) -> np.ndarray:
    """The tail's weights after ``rounds`` gradient updates, each summed over the training places of all tasks."""
    table = np.zeros(table_size(tokens), dtype=np.float32)
    chosen = coded.where(~F.col("held_out")).select("n_tokens", "codes")
    for _ in range(rounds):
        sent = coded.sparkSession.sparkContext.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, len(sent.value)))
            for batch in batches:
                for some in tail_places(batch):
                    tail.add_statistics(total, sent.value, *some)
            if total[1].any():
                yield shards(total)

        total = summed(chosen.mapInArrow(run, "shard int, part binary"), (2, len(table)))
        sent.unpersist()
        gradient, curvature = total
        table += (RATE * gradient / (curvature + np.abs(gradient) + TAIL_SMOOTHING)).astype(np.float32)
    return table


def ranked(counts: DataFrame, folder: str) -> tuple[DataFrame, Tail, int, int]:
    """Tokens with their ``code``, the rank by falling count; the tail's tree; how many distinct tokens, and tokens, there are."""
    counts.orderBy(F.desc("c"), "token").withColumn("id", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(folder)
    stored = counts.sparkSession.read.parquet(folder)
    parts = stored.groupBy(F.shiftright("id", 33).alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()
    runs = stored.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).collect()
    first = dict(zip([r["p"] for r in parts], itertools.accumulate([0, *[r["n"] for r in parts]])))
    distinct = sum(r["n"] for r in parts)
    offset = F.lit(0).cast("bigint")
    if first:
        offset = F.element_at(F.create_map(*[F.lit(x).cast("bigint") for item in first.items() for x in item]), F.shiftright("id", 33))
    coded = stored.select("token", (offset + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).cast("int").alias("code"))
    return coded, Tail([(r["c"], r["n"]) for r in runs], min(HEAD, distinct)), distinct, sum(r["c"] * r["n"] for r in runs)


# ---- events and weights of the head


def count_events(coded: DataFrame) -> DataFrame:
    """How often each (token before, one before that, word of the head or tail as a whole) stands in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

        for batch in batches:
            for rows, codes, starts in laid_out(batch):
                contexts = contexts_at(batch, rows, codes)
                before, second = places(contexts, starts)
                keys.append((before * CONTEXTS + second) * (HEAD + 1) + np.minimum(contexts, HEAD))
                size += len(contexts)
                if size > 4_000_000:
                    yield out()
                    keys, size = [], 0
        if keys:
            yield out()

    chosen = coded.where(~F.col("held_out")).select("n_tokens", "codes", "letters")
    return chosen.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def shards(total: np.ndarray) -> pa.RecordBatch:
    parts = np.array_split(total.astype(np.float32).ravel(), SHARDS)
    return pa.RecordBatch.from_arrays([pa.array(range(SHARDS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["shard", "part"])


def summed(partial: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the tasks' ``shards``; each of them is summed by itself."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in pdf["part"])
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "part": [total.astype(np.float32).tobytes()]})

    rows = partial.groupBy("shard").applyInPandas(add, "shard int, part binary").collect()
    if not rows:
        return np.zeros(shape)
    return np.concatenate([np.frombuffer(r["part"], np.float32) for r in sorted(rows, key=lambda r: r["shard"])]).astype(np.float64).reshape(shape)


def by_class(events: DataFrame) -> DataFrame:
    """Events with the same contexts and the same class of words taken together: all that the expected counts depend on."""
    pair = F.floor(F.col("key") / (HEAD + 1)).cast("bigint")
    group = F.floor((F.col("key") % (HEAD + 1)) / CLASS_WORDS)
    group = F.when(F.col("key") % (HEAD + 1) >= HEAD, CLASSES).otherwise(group).cast("bigint")
    return events.groupBy((pair * (CLASSES + 1) + group).alias("key")).agg(F.sum("n").alias("n"))


def summed_statistics(events: DataFrame, weights: Weights, observed: bool) -> np.ndarray:
    """Observed counts over all events, or expected ones over those ``by_class``: tasks sum theirs, then each of ``SHARDS`` parts is summed."""
    shape = weights.table.shape
    sent = events.sparkSession.sparkContext.broadcast((weights.table, weights.head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Weights(*sent.value)
        total = np.zeros(shape)

        def add(some: list[pa.RecordBatch]) -> None:
            key, n = (np.concatenate([b.column(c).to_numpy() for b in some]) for c in (0, 1))
            pair, which = np.divmod(key, HEAD + 1 if observed else CLASSES + 1)
            n = n.astype(np.float64)
            if observed:
                total[:] += model.observed(feature_rows(*np.divmod(pair, CONTEXTS)), which, n)
            else:
                total[:] += model.expected(pair, which, n)

        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                size += batch.num_rows
            if size >= EVENT_STEP:
                add(waiting)
                waiting, size = [], 0
        if waiting:
            add(waiting)
        if total.any():
            yield shards(total)

    out = summed(events.mapInArrow(run, "shard int, part binary"), shape)
    sent.unpersist()
    return out


def train(events: DataFrame, head: list[bytes], rounds: int = ROUNDS) -> Weights:
    """Weights after ``rounds`` gradient updates, each over all events and scaled by the counts of the features."""
    weights = Weights(np.zeros((WIDTH + 1, COLUMNS), dtype=np.float32), head)
    # Words and classes that stand for nothing are as good as impossible.
    empty = np.arange(CLASSES * CLASS_WORDS) >= len(head)
    weights.table[WIDTH, CLASSES + 1 :][empty] = -30
    weights.table[WIDTH, :CLASSES][empty.reshape(CLASSES, CLASS_WORDS).all(1)] = -30
    seen = summed_statistics(events, weights, True) if rounds else np.zeros(weights.table.shape)
    if not seen.any():
        return weights
    # The bias starts at the frequencies themselves, as the first of the rounds.
    start = np.log(seen[WIDTH] + 0.1)
    start[CLASSES + 1 :][empty] = -30
    start[: CLASSES + 1][seen[WIDTH, : CLASSES + 1] == 0] = -30
    weights.table[WIDTH] = start
    grouped = materialise(by_class(events), "classes") if rounds > 1 else events
    for _ in range(rounds - 1):
        expected = summed_statistics(grouped, weights, False)
        step = RATE * (seen - expected) / (np.maximum(seen, expected) + SMOOTHING)
        step[WIDTH, CLASSES + 1 :][empty] = 0
        weights.table += step.astype(np.float32)
    return weights


# ---- scoring


def encode(texts: DataFrame, words: DataFrame, coded: DataFrame, tail: Tail, base_mass: float, unseen: int) -> DataFrame:
    """Texts as codes of their tokens and buckets of their last letters, with what the base model needs of them."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        value = np.empty(len(right), dtype=np.int64)
        value[right["at"].to_numpy()] = right["value"].to_numpy()
        code, letters = (value // TAIL_BUCKETS).astype(np.int32), (value % TAIL_BUCKETS).astype(np.uint8)
        letters[code < HEAD] = 0
        c = tail.count(code)
        base = np.log10(c + 1.0) - np.log10(base_mass)
        rows = []
        for x in left["ids"]:
            x = restored([x], np.int32)[0]
            rows.append((len(x), int((c[x] > 0).sum()), float(base[x].sum()), pressed(code[x]), pressed(letters[x])))
        found = pd.DataFrame(rows, columns=["n_tokens", "n_known", "base_score", "codes", "letters"])
        found.insert(0, "doc_id", left["doc_id"].to_numpy())
        found.insert(1, "held_out", left["held_out"].to_numpy())
        return found

    letters = F.crc32(F.substring("token", -3, 3)) % TAIL_BUCKETS
    known = words.join(coded, "token", "left")
    known = known.select("chunk", "at", (F.coalesce("code", F.lit(unseen)).cast("bigint") * TAIL_BUCKETS + letters).alias("value"))
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, codes binary, letters binary"
    return texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(run, schema)


def laid_out(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Some texts at a time, laid end to end: which rows, their codes, and where texts start."""
    done = batch.column("n_tokens").to_numpy().cumsum()
    for at in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(done // TEXT_STEP)) + 1):
        if len(at):
            rows = slice(int(at[0]), int(at[-1]) + 1)
            codes, sizes = restored(batch.column("codes")[rows].to_pylist(), np.int32)
            yield rows, codes, np.cumsum(sizes) - sizes


def contexts_at(batch: pa.RecordBatch, rows: slice, codes: np.ndarray) -> np.ndarray:
    """The contexts of some texts, as ``laid_out`` gives them."""
    return contexts_of(codes, restored(batch.column("letters")[rows].to_pylist(), np.uint8)[0])


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document.

    Tokens are words between white space and one end, A-Z lower-cased.  The base is the add-one unigram model, the
    score the log10 probability under the maximum-entropy model; both learn only from texts outside the held-out
    fold, and an unseen token counts once.  Null and empty texts are their end only; repeated rows get a row each and
    count each; a null doc_id is trained on.  An empty table gives an empty one.
    """
    spark = docs.sparkSession
    chunks, ranks, stored = (shared_folder(spark, name) for name in ("chunks", "ranked", "coded"))
    texts, words = chunked(docs, chunks)
    coded, tail, distinct, total = ranked(words.where("n > 0").groupBy("token").agg(F.sum("n").alias("c")), ranks)
    head = [bytes(r["token"]) for r in coded.where(F.col("code") < HEAD).orderBy("code").collect()]
    table = encode(texts, words, coded, tail, float(total + distinct + 1), distinct)
    table.write.option("compression", "zstd").parquet(stored)
    table = spark.read.schema(table.schema).parquet(stored)
    # Nothing after this reads the chunks or the ranks.
    for folder in (chunks, ranks):
        remove(spark, folder)
    weights = train(materialise(count_events(table), "events"), head, rounds)
    sent = spark.sparkContext.broadcast((weights.table, head, train_tail(table, tail, total, min(rounds, TAIL_ROUNDS))))
    plain = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, head, tail_table = sent.value
        model = Weights(weights, head)
        for batch in batches:
            for rows, codes, starts in laid_out(batch):
                contexts = contexts_at(batch, rows, codes)
                before, second = places(contexts, starts)
                target = np.minimum(contexts, HEAD)
                log_p = model.at_places(before, second, target)
                there = np.flatnonzero(codes >= HEAD)
                before, second = places(codes.astype(np.int64) + 1, starts, 0)
                log_p[there] += tail.log_probability(tail_table, codes[there], before[there], second[there])
                part = batch.slice(rows.start, len(starts))
                trained = pa.array(np.full(len(starts), total, dtype=np.int64))
                columns = [*[part.column(c) for c in plain[:4]], trained, part.column("base_score"), pa.array(np.add.reduceat(log_p, starts) / np.log(10))]
                yield pa.RecordBatch.from_arrays(columns, [*plain[:4], "train_tokens", "base_score", "score"])

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return table.select(*plain, "codes", "letters").mapInArrow(score, schema)
