"""Running aggregates over groups of any size.

Rows are numbered in a total order first (session.numbered); a chunk is CHUNK
consecutive numbers. Within a group's part of a chunk a window does the work, and
what the chunks before hold is one row each: so a group of a third of all rows
is many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.session import Stage, numbered

CHUNK = 4096
RANK, _AT = "_rank", "_chunk"
_MERGE: dict[str, tuple[Callable, Callable]] = {"sum": (F.sum, lambda a, b: a + b), "min": (F.min, F.least), "max": (F.max, F.greatest)}


def largest(rows: DataFrame, group: Sequence[str]) -> int:
    return rows.groupBy(*group).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def ranked(stage: Stage, rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str, chunk: int | None = CHUNK) -> DataFrame:
    """The rows with RANK, consecutive within a group, for ``before``; no ``chunk`` for groups that are all small enough for one."""
    if chunk is None:
        return rows.withColumn(RANK, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).withColumn(_AT, F.lit(0))
    out = numbered(stage, rows, [F.col(c) for c in (*group, *order)], RANK, name)
    return out.withColumn(_AT, F.floor(F.col(RANK) / chunk).cast("long"))


def before(rows: DataFrame, group: Sequence[str], values: Mapping[str, tuple[str, Column]], chunk: int | None = CHUNK) -> DataFrame:
    """The rows with running aggregates over the group's earlier ranks: name to (sum, min or max, column); null where there are none."""
    if chunk is None:
        all_before = Window.partitionBy(*group).orderBy(RANK).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns({n: _MERGE[how][0](value).over(all_before) for n, (how, value) in values.items()})
    inner = Window.partitionBy(*group, _AT).orderBy(RANK).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumns({f"_in_{n}": _MERGE[how][0](value).over(inner) for n, (how, value) in values.items()})
    held = rows.groupBy(*group, _AT).agg(*(_MERGE[how][0](value).alias(f"_up_{n}") for n, (how, value) in values.items()))
    held = held.withColumns({f"_up_{n}": _MERGE[how][0](f"_up_{n}").over(outer) for n, (how, _) in values.items()})
    out = within.join(held, [*group, _AT], "left")
    both = lambda n, merge: F.when(F.col(f"_in_{n}").isNull(), F.col(f"_up_{n}")).when(F.col(f"_up_{n}").isNull(), F.col(f"_in_{n}")).otherwise(merge(F.col(f"_in_{n}"), F.col(f"_up_{n}")))
    return out.withColumns({n: both(n, _MERGE[how][1]) for n, (how, _) in values.items()}).drop(*(f"{x}{n}" for n in values for x in ("_in_", "_up_")))
