"""State machines over ordered requests: which state each request meets, however many requests one key has.

A request is a move: the next state for each state, as an array.  Moves compose, and composing is associative.  So runs of neighbouring
requests are folded into one move each, those again into one, until a key has a single run; then the states are handed down again.
A task holds `width` moves of a key at a time.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import dealt_join, written


def table(states: int, change) -> Column:
    """The move that change(state) describes."""
    return F.array(*(F.lit(change(s)) for s in range(states)))


def _runs(moves: DataFrame, key: str, width: int) -> DataFrame:
    run = F.floor(F.col("n") / width).alias("run")
    return moves.groupBy(key, run).agg(F.array_sort(F.collect_list(F.struct("n", "move"))).alias("xs"))


def states_before(moves: DataFrame, start: DataFrame, key: str, width: int = 256) -> DataFrame:
    """(key, n, before): the state in which request n of its key finds it.

    moves (key, n, move): n are different whole numbers from 0 on, in the order of the requests.  start (key, state): a key that it lacks begins in state 0.
    The jobs grow with the logarithm of the largest n.
    """
    runs = written(_runs(moves, key, width))
    last = runs.agg(F.max("run")).first()[0]
    if last is None or last < 1:
        heads = runs.select(key, "run").join(start.select(key, F.col("state").alias("before")), key, "left")
    else:
        same = F.transform(F.get("xs", F.lit(0))["move"], lambda _, i: i.cast("int"))
        folded = F.aggregate("xs", same, lambda done, x: F.transform(done, lambda s: F.get(x["move"], s)))
        heads = states_before(runs.select(key, F.col("run").alias("n"), folded.alias("move")), start, key, width).withColumnRenamed("n", "run")
    met = runs.join(heads, [key, "run"])
    walk = F.aggregate(
        "xs", F.struct(F.coalesce("before", F.lit(0)).cast("int").alias("s"), F.array().cast("array<int>").alias("seen")),
        lambda at, x: F.struct(F.get(x["move"], at["s"]).alias("s"), F.concat(at["seen"], F.array(at["s"])).alias("seen")),
    )["seen"]
    return met.select(key, F.explode(F.arrays_zip(F.col("xs.n").alias("n"), walk.alias("before"))).alias("x")).select(key, "x.n", "x.before")


def walked(moves: DataFrame, start: DataFrame, key: str, width: int = 256) -> DataFrame:
    """The moves' rows with `before` and `after`, the states around each."""
    kept = written(moves)
    both = dealt_join(kept, states_before(kept.select(key, "n", "move"), start, key, width), [key, "n"])
    return both.withColumn("after", F.get("move", F.col("before")))
