"""Merging candidates into several tables of immutable rows, parents before children: what becomes of every row, from one plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERTED, UNCHANGED = "INSERTED", "UNCHANGED"
#: Why a merge cannot be published, in the order in which that is found.
REFUSED = ("NULL_KEY", "DUPLICATE_CONFLICT", "CONFLICT", "MISSING_PARENT")


@dataclass(frozen=True)
class Table:
    """name; key and fields: columns; parents: a column of the table -> the table whose (single) key column it names."""

    name: str
    key: tuple[str, ...]
    fields: tuple[str, ...]
    parents: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.key, *self.fields]


def merged(tables: Sequence[Table], existing: dict[str, DataFrame], candidates: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(table_name, key, rows and outcome of every candidate key; the rows of each table that are new).

    tables stand in the order of their dependencies. Of one key, equal candidates count once and differing ones are
    a DUPLICATE_CONFLICT; a key that is there with other fields is a CONFLICT, with the same ones UNCHANGED. A child's
    parent must be there or be INSERTED by the same merge; a null parent is none. key is the key's JSON."""
    fresh: dict[str, DataFrame] = {}
    parts, known = [], {}
    for t in tables:
        there = existing[t.name].select(*t.columns)
        known[t.name] = there.select(F.col(t.key[0]).alias("_parent"))
        if t.name not in candidates:
            continue
        row = F.struct(*t.fields)
        one = candidates[t.name].groupBy(*t.key).agg(F.count(F.lit(1)).alias("_rows"), F.min(row).alias("_min"), F.max(row).alias("_max"))
        held = there.select(*t.key, row.alias("_held"))
        both = one.join(held, list(t.key), "left")
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in t.key])
        missing = F.lit(False)
        for i, (column, parent) in enumerate(t.parents.items()):
            keys = known[parent].dropna().distinct().withColumn(f"_there{i}", F.lit(True))
            value = F.col(column) if column in t.key else F.col(f"_min.{column}")
            both = both.withColumn(f"_of{i}", value).join(keys.withColumnRenamed("_parent", f"_of{i}"), f"_of{i}", "left")
            missing = missing | (F.col(f"_of{i}").isNotNull() & F.col(f"_there{i}").isNull())
        outcome = (
            F.when(no_key, REFUSED[0]).when(~F.col("_min").eqNullSafe(F.col("_max")), REFUSED[1]).when(F.col("_held").isNotNull() & ~F.col("_held").eqNullSafe(F.col("_min")), REFUSED[2])
            .when(F.col("_held").isNotNull(), UNCHANGED).when(missing, REFUSED[3]).otherwise(INSERTED)
        )
        judged = both.withColumn("_outcome", outcome)
        fresh[t.name] = judged.where(F.col("_outcome") == INSERTED).select(*t.key, *[F.col(f"_min.{f}").alias(f) for f in t.fields])
        known[t.name] = known[t.name].unionByName(fresh[t.name].select(F.col(t.key[0]).alias("_parent")))
        parts.append(judged.select(F.lit(t.name).alias("table_name"), F.to_json(F.struct(*t.key)).alias("key"), F.col("_rows").alias("rows"), F.col("_outcome").alias("outcome")))
    return reduce(lambda a, b: a.unionByName(b), parts), fresh
