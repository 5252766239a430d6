"""Declared keys and references of tables, checked as queries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Constraints:
    """What a table promises: columns that are never null, keys without repeats, references (column, table, column)."""

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = field(default=())


def violations(tables: dict[str, DataFrame], constraints: dict[str, Constraints]) -> DataFrame:
    """Number of rows (for unique keys: of repeated keys) that break each promise: ``table_name``, ``constraint_name``, ``n``.

    Null references refer to nothing and break no promise; keys with a null are compared like others. Promises
    that hold are listed with 0. An empty table breaks none.
    """
    parts = []
    for name, c in constraints.items():
        df = tables[name]
        line = lambda label, n: n.select(F.lit(name).alias("table_name"), F.lit(label).alias("constraint_name"), F.col("n"))  # noqa: B023, E731
        for col in c.not_null:
            parts.append(line(f"not null {col}", df.agg(F.count_if(F.col(col).isNull()).alias("n"))))
        for key in c.unique:
            parts.append(line("unique " + ", ".join(key), df.groupBy(*key).agg(F.count(F.lit(1)).alias("k")).agg(F.count_if(F.col("k") > 1).alias("n"))))
        for col, other, other_col in c.references:
            held = tables[other].select(F.col(other_col).alias("__held")).distinct()
            lost = df.where(F.col(col).isNotNull()).join(held, F.col(col) == F.col("__held"), "left_anti")
            parts.append(line(f"{col} references {other}.{other_col}", lost.agg(F.count(F.lit(1)).alias("n"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
