"""Lists of claims cut into prompts that fit a model's context."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: So many bytes of UTF-8 are taken for a token; models differ, so give a smaller number to be safe.
BYTES_PER_TOKEN = 4


def token_estimate(size: Column, per_token: int = BYTES_PER_TOKEN) -> Column:
    """Tokens of so many bytes, rounded up."""
    return F.ceil(size / per_token).cast("bigint")


def line_tokens(items: Column | str, per_token: int = BYTES_PER_TOKEN) -> Column:
    """Tokens of each item as a numbered line of its own; a null item counts as an empty one."""
    return F.transform(
        items,
        lambda item, i: token_estimate(
            F.coalesce(F.octet_length(item), F.lit(0)) + F.length((i + 1).cast("string")) + 3, per_token
        ),
    )


def cut_places(tokens: Column | str, room: Column | int, most: int | None = None) -> Column:
    """``array<struct<start:int, n:int, tokens:bigint>>``: consecutive pieces, each as long as ``room`` allows.

    An item that doesn't fit by itself is a piece alone; ``most`` bounds the items of a piece.  Only the places are
    gathered, so the work grows with the items.  No items give no pieces.
    """
    room = F.lit(room) if isinstance(room, int) else room
    kind = "struct<start:int,n:int,tokens:bigint>"
    start = F.struct(
        F.array().cast(f"array<{kind}>").alias("done"),
        F.lit(0).alias("start"),
        F.lit(0).alias("at"),
        F.lit(0).cast("bigint").alias("used"),
    )

    def closed(acc: Column) -> Column:
        piece = F.struct(acc["start"].alias("start"), (acc["at"] - acc["start"]).alias("n"), acc["used"].alias("tokens"))
        return F.array_append(acc["done"], piece.cast(kind))

    def step(acc: Column, cost: Column) -> Column:
        held = acc["at"] - acc["start"]
        full = acc["used"] + cost > room if most is None else (acc["used"] + cost > room) | (held >= most)
        cut = (held > 0) & full
        return F.struct(
            F.when(cut, closed(acc)).otherwise(acc["done"]).alias("done"),
            F.when(cut, acc["at"]).otherwise(acc["start"]).alias("start"),
            (acc["at"] + 1).alias("at"),
            F.when(cut, cost).otherwise(acc["used"] + cost).alias("used"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["at"] > acc["start"], closed(acc)).otherwise(acc["done"])

    return F.coalesce(F.aggregate(tokens, start, step, finish), F.array().cast(f"array<{kind}>"))


def piece_of(items: Column | str, place: Column) -> Column:
    """The items of one piece."""
    return F.slice(items, place["start"] + 1, place["n"])
