"""Byte-pair pieces of a SentencePiece model: exact encoding by a prefix table, and decoding.

In a merge-type model a sequence of pieces is the encoding of its text exactly if every neighbouring pair is the
encoding of its own two pieces, since merges act locally and ties go to the left.  So each prefix of a text has one
last piece: among the pieces that end there (found by an automaton), the one that is compatible with the last piece
of the prefix before it.  The table of last pieces is filled from left to right and the ids are read off backwards.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from factgrade.llm.common import map_rows

#: Entries of the caches of a worker; a full cache is emptied, which changes no result.
CACHE = 600_000
#: Longer chunks are not cached.
CACHED_LENGTH = 48
MARK = "▁"


class Pieces:
    """The pieces of a merge-type model whose normalisation changes nothing but spaces."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = model.eos_id()
        self.names = [model.id_to_piece(i) for i in range(len(model))]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(len(model))]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.names) if model.is_byte(i)}
        if len(self.bytes) != 256 or model.normalize("ﬁ Ａ  x\n") != f"{MARK}ﬁ{MARK}Ａ{MARK}{MARK}x\n":
            raise ValueError("the model must have byte pieces, a leading space and no normalisation")
        plain = {p: i for i, p in enumerate(self.names) if not special[i] and not model.is_byte(i)}
        self.score = {p: model.get_score(i) for p, i in plain.items()}
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("pieces must not hold a space after another character")
        self.size = [len(p) for p in self.names]
        self.automaton = ahocorasick.Automaton()
        for piece, i in plain.items():
            if len(piece) < 2 or self.merge(piece) == [piece]:
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.split = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if "\n" not in "".join(plain) else f"{MARK}*[^{MARK}]+|{MARK}+")
        control = [model.is_control(i) for i in range(len(model))]
        values = {i: v for v, i in self.bytes.items()}
        self.raw = [
            bytes([values[i]]) if i in values else b"" if control[i] else " ⁇ ".encode() if special[i] else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.names)
        ]
        self.text = [str(i) for i in range(len(self.names))]

    def merge(self, text: str) -> list[str]:
        """Merges one by one: the best score first, the leftmost of equals."""
        parts, score = list(text), self.score.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def encoder(self) -> Encoder:
        return Encoder(self)

    def decode(self, ids: list[int]) -> str:
        """Text of ids; control ids stand for nothing, the space before the first piece goes."""
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") and self.names[next(i for i in ids if raw[i])].startswith(MARK) else text


class Encoder:
    """Encodes with the pieces of a model; its caches last as long as it, which is a task."""

    def __init__(self, model: Pieces) -> None:
        self.model = model
        self.names, self.size, self.automaton, self.bytes = model.names, model.size, model.automaton, model.bytes
        self.pairs: dict[int, bool] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            x, y = self.names[a], self.names[b]
            found = self.model.merge(x + y) == [x, y]
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            self.pairs[key] = found
        return found

    def encode_chunk(self, chunk: str) -> list[int]:
        last = [-1] * (len(chunk) + 1)
        size, pairs, compatible = self.size, self.pairs.get, self.compatible
        for end, piece in self.automaton.iter(chunk):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size[piece]
            before = last[start]  # -1: the text starts here, or a character without a piece stands before
            if before < 0:
                last[end] = piece
            else:
                good = pairs(before << 32 | piece)
                if compatible(before, piece) if good is None else good:
                    last[end] = piece
        ids, at = [], len(chunk)
        while at:
            piece = last[at]
            if piece < 0:
                ids.extend(self.bytes[b] for b in reversed(chunk[at - 1].encode("utf-8", "surrogatepass")))
                at -= 1
            else:
                ids.append(piece)
                at -= size[piece]
        ids.reverse()
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of the whole text and the end id."""
        ids: list[int] = []
        if text:
            get, chunks = self.chunks.get, self.chunks
            for chunk in self.model.split.findall(MARK + text.replace(" ", MARK)):
                found = get(chunk)
                if found is None:
                    found = self.encode_chunk(chunk)
                    if len(chunk) <= CACHED_LENGTH:
                        if len(chunks) >= CACHE:
                            chunks.clear()
                        found = chunks[chunk] = tuple(found)
                ids += found
        ids.append(self.model.end)
        return ids


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def model_path(path: str | None) -> str:
    """The given file, or the 32k merge-type model among the installed public tokenizers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return path


def encode(docs: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids`` (array of int, end id included) of the whole ``text``; null and empty texts have the end id only.

    Each row stands for itself: repeated rows and ids are kept, and an empty table gives an empty one.  The model
    file must be at ``path`` on every executor.
    """
    file = model_path(path)

    def make():
        coder = pieces(file).encoder()
        return lambda texts: [(coder.encode(t),) for t in texts]

    return map_rows(docs, ["text"], make, "ids array<int>", ["doc_id"] if keep is None else keep)


def decode(tokens: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds ``text`` decoded from ``ids``; null or empty lists give the empty text."""
    file = model_path(path)

    def make():
        table = pieces(file)
        return lambda lists: [(table.decode(x or []),) for x in lists]

    return map_rows(tokens, ["ids"], make, "text string", ["doc_id"] if keep is None else keep)


def round_trip(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Digests of ids and of the text decoded from them, in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``with_ids`` adds the ids themselves.
    """
    from hashlib import sha256

    file = model_path(path)

    def make():
        table = pieces(file)
        coder = table.encoder()

        def digests(texts):
            rows = []
            for text in texts:
                ids = coder.encode(text)
                names = table.text
                row = (
                    len(ids),
                    sha256(" ".join([names[i] for i in ids]).encode()).hexdigest(),
                    sha256(table.decode(ids).encode("utf-8", "surrogatepass")).hexdigest(),
                )
                rows.append((*row, ids) if with_ids else row)
            return rows

        return digests

    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_rows(docs, ["text"], make, added, ["doc_id"])
