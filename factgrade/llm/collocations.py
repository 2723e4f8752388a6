"""Collocations: phrases of two to four words that occur more often together than their parts lead to expect.

Every chunk of texts counts its word sequences, builds an acyclic automaton with counts from them in sorted order, one
for each prefix range, and sends these to the ranges.  A range unites what it gets, summing counts, and keeps what is
frequent.  The phrases are read from the united automata, and the counts of their parts are looked up by composing an
automaton of the parts asked for with the range that holds them.

Sequences that can't be frequent never enter an automaton: a first pass adds up the occurrences of all words, pairs
and triples in a table of cells chosen by a hash.  A cell is at least as high as each count in it, so a triple in a low
cell is rare, and with it every sequence that holds it.  There is a cell for every four bytes of text, but no more than
2^30, of which one bit each is broadcast (128 MB); where that is too few the table rules out less and the automata get
longer, but the counts are the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factgrade.llm.automata import Automaton
from factgrade.llm.common import LOWER, UPPER, materialise
from factgrade.operators.skew import salted_join, shuffle_partitions

LONGEST, LEAST, COVERED_PERCENT, BEST = 4, 30, 80, 2000
NO_LANGUAGE = "und"
#: A byte that UTF-8 never has stands between pieces.
GAP = b"\xff"
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
TO_PIECES = bytes.maketrans(UPPER.encode() + SEPARATORS, LOWER.encode() + GAP * len(SEPARATORS))
#: Bytes of text that a task counts at a time; a single piece may be longer.
CHUNK_BYTES = 8 * 2**20
CELL_BYTES, LEAST_BITS, MOST_BITS = 4, 23, 30
#: Cells that one range of the table holds.
RANGE_CELLS = 2**19
#: Automata that are united in one go.
UNITED = 16
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Chunk:
    """The words of one language in some texts: ``vocabulary``, and ``codes`` of the running words.

    Code 0 stands for a gap; there is one before the first and after the last word.
    """

    def __init__(self, lang: str, data: bytes) -> None:
        self.lang = lang
        tokens = (GAP + data + GAP).replace(GAP, b" " + GAP + b" ").split()
        encoded = pa.array(tokens, pa.binary()).dictionary_encode()
        del tokens
        self.vocabulary = words = encoded.dictionary.to_pylist()
        self.codes = encoded.indices.to_numpy().astype(np.int64)
        seed = xxhash.xxh64_intdigest(lang.encode())
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
        self.word_keys = mixed(hashes)
        self.hashes = hashes
        #: Where a word is followed by another one, or by two.
        follows = (self.codes[:-1] > 0) & (self.codes[1:] > 0)
        self.pairs = np.flatnonzero(follows)
        self.triples = np.flatnonzero(follows[:-1] & follows[1:])
        self.counts = np.bincount(self.codes, minlength=len(words))
        self.counts[0] = 0

    def sequence_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the pairs and of the triples; a triple's comes from those of its two pairs."""
        at = np.zeros(len(self.codes), np.uint64)
        at[self.pairs] = pair_key(self.hashes[self.codes[self.pairs]], self.hashes[self.codes[self.pairs + 1]])
        return at[self.pairs], pair_key(at[self.triples], at[self.triples + 1])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    return x ^ (x >> np.uint64(32))


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * MIX[2] + mixed(second))


def prefix_key(lang: str, words: tuple[bytes, ...]) -> int:
    """What decides the prefix range of a phrase: its first word, or its first two."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in words[:2]], np.uint64)
    return int(mixed(hashes)[0] if len(words) == 1 else pair_key(hashes[:1], hashes[1:2])[0])


def cells(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int32)


def cell_bits(texts: DataFrame) -> int:
    """How many bits number a cell, by the size of the texts."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    return min(max((size // CELL_BYTES).bit_length(), LEAST_BITS), MOST_BITS)


def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[Chunk]:
    """Batches of (text, lang) by language, ``CHUNK_BYTES`` at a time; a long text is cut between pieces."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        texts = batch.column(0).cast(pa.binary())
        for i, lang in enumerate(batch.column(1).to_pylist()):
            data = (texts[i].as_py() or b"").translate(TO_PIECES)
            while data:
                cut = len(data)
                if cut > CHUNK_BYTES:
                    cut = data.rfind(GAP, 0, CHUNK_BYTES)
                    cut = data.find(GAP, CHUNK_BYTES) if cut < 0 else cut
                    cut = len(data) if cut < 0 else cut + 1
                held.setdefault(lang, []).append(data[:cut])
                size += cut
                data = data[cut:]
                if size >= CHUNK_BYTES:
                    yield from (Chunk(k, GAP.join(v)) for k, v in held.items())
                    held, size = {}, 0
    yield from (Chunk(k, GAP.join(v)) for k, v in held.items())


def rows_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def frequent_cells(texts: DataFrame, least: int) -> bytes:
    """One bit for each cell: whether what is in it occurs at least ``least`` times in all.

    Chunks send the occupied cells of a range as differences; the sums of a range take 4 MB wherever they are made.
    The driver gets the bits alone.
    """
    sent = pa.schema([("range", pa.int32()), ("cells", pa.binary())])
    told = pa.schema([("range", pa.int32()), ("bits", pa.binary())])
    bits = cell_bits(texts)
    ranges = 2**bits // RANGE_CELLS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            there = np.flatnonzero(chunk.counts)
            pairs, triples = chunk.sequence_keys()
            found, n = np.unique(np.concatenate([cells(k, bits) for k in (pairs, triples)]), return_counts=True)
            places = np.concatenate([found, cells(chunk.word_keys[there], bits)])
            order = np.argsort(places, kind="stable")
            places, counts = places[order], np.concatenate([n, chunk.counts[there]])[order]
            counts = np.minimum(counts, 2**32 - 1).astype(np.uint32)
            ends = np.searchsorted(places, np.arange(1, ranges + 1) * RANGE_CELLS)
            rows, start = [], 0
            for r, end in enumerate(ends.tolist()):
                if end > start:
                    steps = np.diff(places[start:end], prepend=np.int32(r * RANGE_CELLS)).astype(np.uint32)
                    rows.append((r, zstandard.compress(steps.tobytes() + counts[start:end].tobytes(), 1)))
                start = end
            yield rows_of(rows, sent)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums = None, np.zeros(RANGE_CELLS, np.int64)

        def result() -> pa.RecordBatch:
            return rows_of([(current, zstandard.compress(np.packbits(sums >= least).tobytes(), 1))], told)

        for batch in batches:
            for r, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if r != current:
                    if current is not None:
                        yield result()
                    current = r
                    sums[:] = 0
                steps, n = np.frombuffer(zstandard.decompress(data.as_py()), np.uint32).reshape(2, -1)
                np.add.at(sums, np.cumsum(steps, dtype=np.int64), n)
        if current is not None:
            yield result()

    counted = texts.mapInArrow(count, "range int, cells binary")
    dealt = counted.repartition("range").sortWithinPartitions("range")
    table = np.zeros((ranges, RANGE_CELLS // 8), np.uint8)
    for row in dealt.mapInArrow(add, "range int, bits binary").collect():
        table[row["range"]] = np.frombuffer(zstandard.decompress(bytes(row["bits"])), np.uint8)
    return table.tobytes()


def is_set(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = cells(keys, (8 * len(table)).bit_length() - 1)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def sequences(chunk: Chunk, table: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts): the distinct word sequences that may be frequent; unused places hold -1."""
    size = len(chunk.codes)
    words = np.flatnonzero((chunk.counts > 0) & is_set(table, chunk.word_keys))
    found = [np.full((len(words), longest), -1, np.int64)]
    found[0][:, 0] = words
    counts = [chunk.counts[words]]
    pairs, triples = chunk.sequence_keys()
    in_pair, in_triple = np.zeros(size, bool), np.zeros(size, bool)
    in_pair[chunk.pairs[is_set(table, pairs)]] = True
    in_triple[chunk.triples[is_set(table, triples)]] = True
    begins, number, distinct = in_pair, chunk.codes, None
    for n in range(2, longest + 1):
        if n > 2:
            # Every triple inside has to be frequent.
            begins[: size - n + 3] &= in_triple[n - 3 :]
            begins[size - n + 3 :] = False
        at = np.flatnonzero(begins)
        if not len(at):
            break
        keys, place, total = np.unique(number[at] * len(chunk.vocabulary) + chunk.codes[at + n - 1], return_inverse=True, return_counts=True)
        head, last = np.divmod(keys, len(chunk.vocabulary))
        rows = np.full((len(keys), longest), -1, np.int64)
        rows[:, : n - 1] = head[:, None] if n == 2 else distinct[head, : n - 1]
        rows[:, n - 1] = last
        found.append(rows)
        counts.append(total)
        number = np.full(size, -1, np.int64)
        number[at] = place
        distinct = rows
    return np.concatenate(found), np.concatenate(counts)


def shard_automata(chunk: Chunk, table: np.ndarray, longest: int, ranges: int) -> Iterator[tuple[int, bytes]]:
    """(range, automaton) of a chunk, built from its sequences in sorted order."""
    codes, counts = sequences(chunk, table, longest)
    keys = chunk.word_keys[codes[:, 0]].copy()
    longer = np.flatnonzero(codes[:, 1] >= 0)
    keys[longer] = pair_key(chunk.hashes[codes[longer, 0]], chunk.hashes[codes[longer, 1]])
    dealt = (keys % np.uint64(ranges)).astype(np.int64)
    vocabulary, start = chunk.vocabulary, 0
    used = sorted(np.unique(codes[codes > 0]).tolist(), key=vocabulary.__getitem__)
    rank = np.full(len(vocabulary) + 1, -1, np.int64)
    rank[used] = np.arange(len(used))
    order = np.lexsort([*rank[codes].T[::-1], dealt])
    ends = np.searchsorted(dealt[order], np.arange(ranges), side="right").tolist()
    for r, end in enumerate(ends):
        if end > start:
            mine = order[start:end]
            rows = zip(codes[mine].tolist(), counts[mine].tolist())
            yield r, Automaton.build((tuple(vocabulary[c] for c in row if c >= 0), n) for row, n in rows).dump()
        start = end


def count_automata(texts: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, range, automaton, n): the frequent sequences of every prefix range, and in range -1 the words of a language.

    Ranges are as many as the session has shuffle partitions.  A task unites what its ranges get bit by bit, so it
    holds the sum and a few more, not all that were sent.
    """
    spark = texts.sparkSession
    ranges = shuffle_partitions(texts)
    shared = spark.sparkContext.broadcast(frequent_cells(texts, least))
    schema = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("automaton", pa.binary()), ("n", pa.int64())])
    columns = "lang string, range int, automaton binary, n bigint"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint8)
        for chunk in chunks(batches):
            rows = [(chunk.lang, -1, None, int(chunk.counts.sum()))]
            rows += [(chunk.lang, r, data, None) for r, data in shard_automata(chunk, table, longest, ranges)]
            yield rows_of(rows, schema)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, words = None, [], 0

        def result() -> pa.RecordBatch:
            data = Automaton.union(held, least).dump() if held else None
            return rows_of([(*current, data, words)], schema)

        for batch in batches:
            for lang, r, data, n in zip(*[c.to_pylist() for c in batch.columns]):
                if (lang, r) != current:
                    if current is not None:
                        yield result()
                    current, held, words = (lang, r), [], 0
                words += n or 0
                if data is not None:
                    held.append(Automaton.load(data))
                if len(held) == UNITED:
                    held = [Automaton.union(held)]
        if current is not None:
            yield result()

    built = texts.mapInArrow(build, columns).repartition("lang", "range").sortWithinPartitions("lang", "range")
    return materialise(built.mapInArrow(unite, columns), "automata")


def phrases_of(automata: DataFrame, ranges: int) -> DataFrame:
    """(lang, phrase, a, parts): the phrases of two words and more; a part is (cut, side, text, range it is counted in)."""
    parts = pa.list_(pa.struct([("cut", pa.int32()), ("side", pa.int32()), ("part", pa.string()), ("range", pa.int32())]))
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("parts", parts)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for words, n in Automaton.load(data.as_py()).phrases():
                    if len(words) > 1:
                        cuts = [(k, s, p) for k in range(1, len(words)) for s, p in enumerate((words[:k], words[k:]))]
                        told = [
                            {"cut": k, "side": s, "part": b" ".join(p).decode(), "range": prefix_key(lang, p) % ranges} for k, s, p in cuts
                        ]
                        rows.append((lang, b" ".join(words).decode(), n, told))
                    if len(rows) == 4096:
                        yield rows_of(rows, schema)
                        rows = []
                yield rows_of(rows, schema)

    columns = "lang string, phrase string, a bigint, parts array<struct<cut:int,side:int,part:string,range:int>>"
    return automata.where("range >= 0").select("lang", "automaton").mapInArrow(read, columns)


def part_counts(automata: DataFrame, asked: DataFrame) -> DataFrame:
    """(lang, part, f) for distinct (lang, range, part): each range composes what it is asked with what it holds."""
    schema = pa.schema([("lang", pa.string()), ("part", pa.string()), ("f", pa.int64())])

    def compose(held: pa.Table, wanted: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if held.num_rows and wanted.num_rows:
            lang = wanted.column("lang")[0].as_py()
            parts = sorted(tuple(p.encode().split(b" ")) for p in wanted.column("part").to_pylist())
            requests = Automaton.build((p, 1) for p in parts)
            counts = Automaton.load(held.column("automaton")[0].as_py())
            rows = [(lang, b" ".join(words).decode(), n) for words, n in counts.compose(requests)]
        return pa.Table.from_batches([rows_of(rows, schema)])

    ranges = automata.where("range >= 0").select("lang", "range", "automaton").groupBy("lang", "range")
    return ranges.cogroup(asked.groupBy("lang", "range")).applyInArrow(compose, "lang string, part string, f bigint")


def exact(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) by the cut with the lowest score, the first of several."""
    asked = phrases.select("lang", "phrase", "a", F.explode("parts").alias("p")).select("lang", "phrase", "a", "p.cut", "p.side", "p.part")
    found = salted_join(asked, counts, ["lang", "part"], "inner")
    side = [F.max(F.when(F.col("side") == s, F.col("f"))) for s in (0, 1)]
    cuts = found.groupBy("lang", "phrase", "a", "cut").agg(side[0].alias("l"), side[1].alias("r"))
    score = F.expr("(cast(a AS decimal(25,0)) * 2000000) div (cast(l AS decimal(25,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def covering(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longer): for phrases inside longer ones, the highest count of these."""
    words = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size(words) - 1),
            lambda m: F.transform(F.sequence(F.lit(1), F.size(words) - m + 1), lambda i: F.array_join(F.slice(words, i, m), " ")),
        )
    )
    long = phrases.where(F.size(words) > 2).select("lang", F.explode(inner).alias("phrase"), "a")
    return long.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def best_phrases(
    docs: DataFrame, best: int = BEST, least: int = LEAST, longest: int = LONGEST, covered_percent: int = COVERED_PERCENT
) -> DataFrame:
    """The ``best`` phrases of every language by score: (lang, rank, phrase, a, l, r, n, score).

    ``docs`` has text and lang; other columns, ids among them, are not read, so repeated rows count again.  A null text
    is empty, a null language ``und``.  A phrase occurs ``a`` times (``least`` or more) among the ``n`` words of its
    language; cut in two, its parts occur ``l`` and ``r`` times, and the score is floor(2,000,000 a / (l + r)) at the cut
    where that is lowest, the first of several.  Phrases that stand inside a longer frequent one with at least
    ``covered_percent`` of their count are left out.  Equal scores are ordered by count, then by the bytes of the phrase.
    An empty table, or one without frequent phrases, gives no rows.  All counts are exact.
    """
    texts = docs.select("text", F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"))
    ranges = shuffle_partitions(texts)
    automata = count_automata(texts, least, longest)
    phrases = materialise(phrases_of(automata, ranges), "phrases")
    asked = phrases.select("lang", F.explode("parts").alias("p")).select("lang", "p.range", "p.part").distinct()
    counts = materialise(part_counts(automata, asked), "parts")
    kept = scored(phrases, counts).join(covering(phrases), ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (100 * exact(F.col("longer")) < covered_percent * exact(F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    words = automata.where("range = -1").groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
