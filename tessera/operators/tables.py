"""Relational building blocks: upserts, global numbering, picks with a total order, aggregation into lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut


def keep_first(existing: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Existing rows, and new rows with other keys, one for each key: the first by ``order``. Rows with a null key never conflict with existing ones."""
    fresh = first_by(new.join(existing.select(*keys).distinct(), keys, "left_anti"), keys, order)
    return existing.unionByName(fresh)


def last_wins(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key of both sides: of the new rows the last by ``order``, else the existing one likewise."""
    both = existing.withColumn("__batch", F.lit(0)).unionByName(new.withColumn("__batch", F.lit(1)))
    return last_by(both, keys, ["__batch", *order]).drop("__batch")


def last_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` for each key, by an aggregation that combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__r"))
    return best.select(*keys, *(F.col(f"__r.{c}").alias(c) for c in [*order, *rest])).select(*df.columns)


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row for each key; ``order`` should be a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def merge_columns(existing: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Existing rows with ``columns`` replaced by the new row's values where it has any, and the new rows whose key none has.

    ``keys`` need not be the table's own key; ``new`` holds one row for each of them. Columns of an inserted row that
    ``new`` does not have are null.
    """
    n = new.select(*(F.col(c).alias(f"__{c}") for c in new.columns), F.lit(True).alias("__new"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    j = existing.withColumn("__old", F.lit(True)).join(n, on, "full")
    held = F.col("__old").isNotNull()
    out = []
    for c in existing.columns:
        given = F.col(f"__{c}") if c in new.columns else F.lit(None)
        out.append((F.coalesce(given, F.col(c)) if c in columns else F.when(held, F.col(c)).otherwise(given)).alias(c))
    return j.select(*out)


def with_sequence(df: DataFrame, order: list[str], name: str = "sequence", start: int = 1) -> DataFrame:
    """Rows numbered through in a total order, without gathering them in one task.

    Rows are range-partitioned and sorted; each partition's numbers are shifted by the row counts of the
    partitions before it, which is one number for each partition. The sorted rows are written down first,
    so that both uses see the same borders.
    """
    ids = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33).alias("__part")
    counts = ids.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    numbered = ids.withColumn("__part", part).join(F.broadcast(before), "__part")  # one row for each partition
    return numbered.withColumn(name, F.col("__before") + F.col("__id") % (1 << 33) + start).drop("__id", "__part", "__before")


def distinct_list(c: Column, separator: str = ",") -> Column:
    """Sorted distinct values joined, null if there are none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(c)), separator), F.lit(""))


def deterministic_sample(df: DataFrame, key: str, percent: float) -> DataFrame:
    """The ``percent`` of rows with the smallest digests of their key: the same rows in every run, at least one.

    The digests' first four digits are counted, which tells the range that the border lies in; only the rows of that
    range, about one in 65,536, are put in order.
    """
    digest = df.withColumn("__digest", F.md5(F.col(key).cast("string"))).withColumn("__range", F.coalesce(F.conv(F.substring("__digest", 1, 4), 16, 10).cast("int"), F.lit(-1)))
    counts = sorted((r["__range"], r["n"]) for r in digest.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect())  # 65,537 rows at most
    left = max(1, int(sum(n for _, n in counts) * percent / 100))
    for border, n in counts:
        if n >= left:
            part = digest.where(F.col("__range") == border).orderBy("__digest", key).limit(left)
            return digest.where(F.col("__range") < border).unionByName(part).drop("__digest", "__range")
        left -= n
    return df


def parents(df: DataFrame, child: str, parent: str) -> DataFrame:
    """Children with more than one parent, and how many (``n_parents``)."""
    return df.groupBy(child).agg(F.count_distinct(parent).alias("n_parents")).where("n_parents > 1")


def add_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column, if it has none of that name yet."""
    return df if name in df.columns else df.withColumn(name, value)


def running_count(df: DataFrame, keys: list[str], order: list[str], name: str = "nth") -> DataFrame:
    """Rows with their place among those of equal keys, from 1; ``order`` should be a total order within them."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def count_distinct_with_null(c: Column) -> Column:
    """Different values, null being one of them."""
    return F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))


def columns_of(tables: dict[str, DataFrame]) -> list[tuple[str, int, str, str]]:
    """What a catalogue tells of tables: (table, place of the column, its name, its type)."""
    return [(t, i, f.name, f.dataType.simpleString()) for t, df in tables.items() for i, f in enumerate(df.schema, 1)]


def check_input(df: DataFrame, required: list[str]) -> dict[str, int]:
    """Null counts of the required columns, which are only a warning; an empty table or a missing column raises ``ValueError``."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    got = df.agg(F.count(F.lit(1)).alias("__n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in required)).first()
    if not got["__n"]:
        raise ValueError("no rows")
    return {c: got[c] for c in required}


def verify_counts(expected: dict[str, DataFrame], got: dict[str, DataFrame], tolerance: dict[str, int], default: int = 1) -> DataFrame:
    """Row counts of tables of two stores: ``table_name``, ``n_expected``, ``n_got``, ``passed`` (they differ by no more than allowed)."""
    out = None
    for name, df in expected.items():
        one = df.agg(F.count(F.lit(1)).alias("n_expected")).join(F.broadcast(got[name].agg(F.count(F.lit(1)).alias("n_got"))))  # one row
        one = one.select(F.lit(name).alias("table_name"), "n_expected", "n_got", (F.abs(F.col("n_expected") - F.col("n_got")) <= tolerance.get(name, default)).alias("passed"))
        out = one if out is None else out.unionByName(one)
    return out


def orphans_of(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is not null and names no parent row."""
    p = parent.select(F.col(parent_key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(p, key, "left_anti")


def differences(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of two versions that differ: key, ``status`` (only_left, only_right, changed) and the changed columns' names.

    Keys are compared null-safe; both sides hold one row for each key.
    """
    left = a.select(*(F.col(k).alias(f"a_{k}") for k in keys), *(F.col(c).alias(f"a_{c}") for c in columns), F.lit(True).alias("in_a"))
    right = b.select(*(F.col(k).alias(f"b_{k}") for k in keys), *(F.col(c).alias(f"b_{c}") for c in columns), F.lit(True).alias("in_b"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}"))
    joined = left.join(right, on, "full")
    changed = F.array_compact(F.array(*(F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in columns)))
    status = F.when(F.col("in_b").isNull(), "only_left").when(F.col("in_a").isNull(), "only_right").when(F.size(changed) > 0, "changed")
    return joined.withColumn("status", status).where("status IS NOT NULL").select(
        *(F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys), "status", F.when(F.col("status") == "changed", F.array_join(changed, ",")).alias("changed"))


def messages(rules: dict[str, Column]) -> Column:
    """Messages of the rules that fail for a row, joined; empty if all hold. A rule that gives null fails."""
    return F.array_join(F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(m)) for m, ok in rules.items()))), "; ")
