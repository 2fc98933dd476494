"""Sequences of events per key, with time limits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from evstream.functions.time import epoch_us, micros
from evstream.operators.timeline import adjacent, nearest, timeline

MATCH, TIMEOUT = "match", "timeout"


@dataclass(frozen=True)
class Step:
    """One event of a sequence. ``strict`` steps must directly follow the step before; others
    may come later, the first one that fits counting."""

    name: str
    when: Column
    strict: bool = False


def match_sequence(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], steps: Sequence[Step], within: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every row that fits the first step, with the rows that complete the sequence.

    The order's first column is the event time; rows without one take no part. Result: the keys, one struct per step (order and
    ``keep`` columns), ``matched`` (steps reached in time) and ``tag``: ``match`` when all steps
    came less than ``within`` after the first, else ``timeout``.

    Steps are resolved from the last to the first: a row that fits step k holds its own columns
    and, nested, the chain of the nearest later row that fits step k + 1. One scan per step.
    """
    if len(steps) < 2:
        raise ValueError("a sequence has at least two steps")
    cols = [*order, *[c for c in keep if c not in order]]
    flagged = df.where(F.col(order[0]).isNotNull()).withColumns({f"_is{i}": s.when for i, s in enumerate(steps)})
    if not any(s.strict for s in steps):
        # Rows that fit no step cannot stand between two: leave them out before the shuffle.
        flagged = flagged.where(reduce(lambda a, b: a | b, [s.when for s in steps]))
    rows = timeline(flagged, keys, order)
    here = F.struct(*cols)
    last = len(steps) - 1
    end = F.when(F.col(f"_is{last}"), F.struct(here.alias("row")))
    rows = rows.changed(lambda r: r.withColumn(f"_at{last}", end))
    for i in range(last - 1, -1, -1):
        follow = adjacent if steps[i + 1].strict else nearest
        rows = rows.backward(include_current=False, _next=follow(f"_at{i + 1}"))
        chain = F.struct(here.alias("row"), F.col("_next").alias("next"))
        held = {f"_at{i}": F.when(F.col(f"_is{i}"), chain)}
        rows = rows.changed(lambda r, held=held: r.withColumns(held).drop("_next"))
    found = rows.done().where(F.col("_is0")).select(*keys, F.col("_at0").alias("_c"))

    path, structs, in_time = "_c", [], []
    begin = epoch_us(F.col(f"_c.row.{order[0]}"))
    for i, step in enumerate(steps):
        structs.append(F.col(f"{path}.row").alias(step.name))
        if i:
            in_time.append((epoch_us(F.col(f"{path}.row.{order[0]}")) - begin) < micros(within))
        path += ".next"
    reached, so_far = F.lit(1), F.lit(True)
    for ok in in_time:
        so_far = so_far & F.coalesce(ok, F.lit(False))
        reached = reached + so_far.cast("int")
    out = found.select(*keys, *structs, reached.alias("matched"))
    return out.withColumn("tag", F.when(F.col("matched") == len(steps), MATCH).otherwise(TIMEOUT))
