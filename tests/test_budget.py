"""Claim lists cut into prompts, against a plain loop, and whole checks with and without limits."""

import random

import pytest
from pyspark.sql import functions as F

from factgrade.functions import budget
from factgrade.operators.replystore import read_store
from factgrade.plans import evaluate


def plain(items, room, most=None):
    pieces = []
    for i, item in enumerate(items or []):
        cost = -(-(len((item or "").encode()) + len(str(i + 1)) + 3) // 4)
        if pieces and pieces[-1][2] + cost <= room and (most is None or pieces[-1][1] < most):
            pieces[-1] = (pieces[-1][0], pieces[-1][1] + 1, pieces[-1][2] + cost)
        else:
            pieces.append((i, 1, cost))
    return pieces


@pytest.mark.parametrize("most", [None, 1, 3])
def test_places_against_a_plain_loop(spark, most):
    rng = random.Random(most)
    lists = [None, [], [None], ["x" * 500, None, "y"]]
    lists += [["é" * rng.randrange(40) for _ in range(rng.randrange(60))] for _ in range(60)]
    rooms = [-5, 0, 3, 25, 10**6]
    df = spark.createDataFrame([(i, r, x) for i, x in enumerate(lists) for r in rooms], "i int, room int, items array<string>")
    got = df.select("i", "room", "items", budget.cut_places(budget.line_tokens("items"), F.col("room"), most).alias("places"))
    for r in got.collect():
        assert [tuple(p) for p in r["places"]] == plain(r["items"], r["room"], most)


def test_many_claims_take_work_in_proportion(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda i: F.concat(F.lit("claim "), i.cast("string"))).alias("c"))
    places = df.select(F.explode(budget.cut_places(budget.line_tokens("c"), 1000)).alias("p"))
    row = places.agg(F.sum("p.n").alias("n"), F.max("p.tokens").alias("most")).first()
    assert row["n"] == 200_000 and row["most"] <= 1000


def graded(spark, tmp_path, name, **limits):
    """500 claims of which every third is supported; prompts and their sizes come back beside the counts."""
    rows = [
        (1, [f"claim number {i}" for i in range(500)], ["a fact", "another"]),
        (2, ["claim number 0"], ["a fact"]),
        (3, [], ["a fact"]),
        (4, ["claim number 1", "claim number 3"], []),
        (5, ["claim number 3", "claim number 6"], ["f" * 4000]),
    ]
    df = spark.createDataFrame(rows, "row_id bigint, gen_facts array<string>, gt_facts array<string>")

    def make():
        def backend(batch):
            out = []
            for messages in batch:
                lines = messages[-1]["content"].split("Claims to Verify:\n    ")[1].split("\n\n")[0].split("\n")
                yes = [int(line.rsplit(" ", 1)[1]) % 3 == 0 for line in lines]
                out.append('{"decisions": [%s]}' % ", ".join('"YES"' if y else '"NO"' for y in yes))
            return out

        return backend

    store = str(tmp_path / name)
    counts = {r["row_id"]: (r["supported"], r["failed_calls"]) for r in evaluate.check_in_one_call(df, store, make, 2, 1, **limits).collect()}
    return counts, read_store(spark, store).count()


def test_pieces_are_summed_back(spark, tmp_path):
    whole, n_whole = graded(spark, tmp_path, "whole")
    assert whole == {1: (167, 0), 2: (1, 0), 5: (2, 0)} and n_whole == 3
    cut, n_cut = graded(spark, tmp_path, "cut", prompt_tokens=300)
    assert cut == whole and n_cut > 12
    few, n_few = graded(spark, tmp_path, "few", most_claims=100)
    assert few == whole and n_few == 5 + 1 + 1


def test_a_failed_piece_is_counted(spark, tmp_path):
    df = spark.createDataFrame([(1, ["good", "bad", "good too"], ["f"])], "row_id bigint, gen_facts array<string>, gt_facts array<string>")

    def make():
        def backend(batch):
            if any("bad" in m[-1]["content"] for m in batch):
                raise ValueError("no")
            return ['{"decisions": ["YES"]}' for _ in batch]

        return backend

    found = evaluate.check_in_one_call(df, str(tmp_path / "s"), make, 1, 1, most_claims=1).collect()
    assert [tuple(r) for r in found] == [(1, 2, 1)]
