"""General table operators: ordered picks, null-safe joins, reshaping, change tests.

Spark rows have no order, so every order-dependent operator takes its ordering as a parameter.
Joins here treat null keys as equal, and sorts put nulls last, in both directions.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordering(*keys: str) -> list[Column]:
    """'-points' for descending, 'name' for ascending; nulls last either way."""
    return [F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys]


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which null matches null; keys appear once (coalesced in a full join)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    joined = left.join(r, reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("full", "right"):
        for k in keys:
            joined = joined.withColumn(k, F.coalesce(F.col(k), F.col(f"_r_{k}")))
    return joined.drop(*[f"_r_{k}" for k in keys])


def lookup_join(rows: DataFrame, dimension: DataFrame, keys: list[str], how: str = "left", most_bytes: int = 8 << 20) -> DataFrame:
    """Join with a dimension that is broadcast only if its counted size is within ``most_bytes``."""
    size = dimension.agg(F.sum(F.length(F.to_json(F.struct(*dimension.columns))))).first()[0] or 0
    return rows.join(F.broadcast(dimension) if size <= most_bytes else dimension, keys, how)


def first_rows(df: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")


def numbered(df: DataFrame, by: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    """Ties share the lowest place."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*by).orderBy(*order)))


def unique_or_null(c: str) -> Column:
    """Aggregate: the value if the group has one distinct value, else null."""
    return F.when(F.min(c) == F.max(c), F.min(c))


def stints(df: DataFrame, by: list[str], at: str, tie: str, gap: Column, name: str = "stint") -> DataFrame:
    """Number runs of rows; a run ends where ``gap`` (an expression over at and _previous) is true. Null gaps do not end one."""
    w = Window.partitionBy(*by).orderBy(F.col(at).asc_nulls_last(), F.col(tie))
    flagged = df.withColumn("_previous", F.lag(at).over(w)).withColumn("_new", F.coalesce(gap, F.lit(False)).cast("int"))
    return flagged.withColumn(name, (F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1).cast("int")).drop("_previous", "_new")


def until_failures(df: DataFrame, by: list[str], order: str, failed: Column, limit: int) -> DataFrame:
    """Rows up to and including the ``limit``-th consecutive failure of their group (early exit of a polling loop)."""
    w = Window.partitionBy(*by).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("_bad", F.coalesce(failed, F.lit(False)).cast("int"))
    rows = rows.withColumn("_island", F.sum(1 - F.col("_bad")).over(upto))
    run = Window.partitionBy(*by, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("consecutive", F.sum("_bad").over(run).cast("int"))
    stopped = F.coalesce(F.max((F.col("consecutive") >= limit).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_stopped", stopped).filter("_stopped = 0").drop("_bad", "_island", "_stopped")


def zip_join(left: DataFrame, right: DataFrame, by: list[str], left_order: list[Column], right_order: list[Column]) -> DataFrame:
    """k-th row with k-th row of each group, only where both sides have as many rows."""

    def with_place(df: DataFrame, order: list[Column]) -> DataFrame:
        w = Window.partitionBy(*by)
        return df.withColumn("_k", F.row_number().over(w.orderBy(*order))).withColumn("_n", F.count("*").over(w))

    return with_place(left, left_order).join(with_place(right, right_order), [*by, "_k", "_n"]).drop("_n").withColumnRenamed("_k", "k")


def argmax_column(columns: list[str]) -> Column:
    """Name of the column with the largest value; the first on ties, null if all are null."""
    top = F.greatest(*columns) if len(columns) > 1 else F.col(columns[0])
    return F.coalesce(*[F.when(F.col(c) == top, F.lit(c)) for c in columns])


def with_missing(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """Add absent columns: {name: (type, default)}."""
    return df.withColumns({c: F.lit(v).cast(t) for c, (t, v) in columns.items() if c not in df.columns})


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows the same number of times."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def snapshot_diff(current: DataFrame, previous: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(key, change): 'new', 'deleted' or 'modified' between two snapshots unique on ``key``."""
    cur = current.select(key, F.struct(*values).alias("_now"))
    old = previous.select(key, F.struct(*values).alias("_then"))
    change = F.when(F.col("_then").isNull(), "new").when(F.col("_now").isNull(), "deleted").when(~F.col("_now").eqNullSafe(F.col("_then")), "modified")
    return cur.join(old, key, "full").select(key, change.alias("change")).filter("change is not null")


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def missing_numbers(df: DataFrame, by: list[str], number: str, low: Column, high: Column) -> DataFrame:
    """Numbers of [low, high] (aggregates over the group) that a group lacks."""
    spans = df.groupBy(*by).agg(F.explode(F.sequence(low.cast("int"), high.cast("int"))).alias(number))
    return spans.join(df.select(*by, F.col(number).cast("int").alias(number)).distinct(), [*by, number], "left_anti")


def json_rows(df: DataFrame, by: list[str], order: list[str], fields: list[str], name: str) -> DataFrame:
    """One JSON array of ordered objects per group (a page's embedded model)."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("_o")))), lambda r: r["_o"])
    return df.groupBy(*by).agg(F.to_json(rows, {"ignoreNullFields": "false"}).alias(name))


def common_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that both tables hold; null equals null."""
    return a.intersect(b)


def latest_of(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """(by, column): the largest value of a group, such as its latest round."""
    return df.groupBy(*by).agg(F.max(column).alias(column))
