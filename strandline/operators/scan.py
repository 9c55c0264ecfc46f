"""Running sums and maxima over ordered rows, where one key may hold most of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one stretch of the order.
STRETCH_ROWS = 1_000_000
Save = Callable[[DataFrame, str], DataFrame]


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, name: str, how: str = "sum", own: bool = True, save: Save | None = None, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """df with name: the sum or maximum of value over the rows of the same keys up to this one (own: itself included), in order.

    The order is cut into stretches of about stretch_rows rows by its first column.  A window runs inside each stretch of each key, and
    one number for a key and stretch is carried on, so no task has all rows of a key; rows that are alike in the first column share a stretch.
    With one stretch it is a plain window.  Null (nothing before) only for a maximum, or a sum with own=False, of a key's first row.
    """
    value = F.col(value) if isinstance(value, str) else value
    fold = {"sum": F.sum, "max": F.max}[how]
    rows = df.withColumn("__value", value)
    stretches = -(-rows.count() // stretch_rows)
    upto = 0 if own else -1
    if stretches <= 1:
        over = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
        return rows.withColumn(name, fold("__value").over(over)).drop("__value")
    rows = save(rows, "rows") if save else rows
    place = rows.select(F.col(order[0]).cast("double").alias("at"))
    bounds = sorted(set(place.approxQuantile("at", [i / stretches for i in range(1, stretches)], 0.2 / stretches)))
    stretch = F.size(F.filter(F.array(*[F.lit(x) for x in bounds]), lambda x: x <= F.col(order[0]).cast("double")))
    rows = rows.withColumn("__stretch", stretch)
    inside = Window.partitionBy(*keys, "__stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
    across = Window.partitionBy(*keys or [F.lit(0)]).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*keys, "__stretch").agg(fold("__value").alias("__whole"))  # one row for a key and stretch
    carried = carried.select(*keys, "__stretch", fold("__whole").over(across).alias("__carried"))
    carried = carried.withColumnsRenamed({k: f"__of_{k}" for k in [*keys, "__stretch"]})
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in [*keys, "__stretch"]]
    rows = rows.withColumn("__inside", fold("__value").over(inside)).join(carried, same).drop(*[f"__of_{k}" for k in [*keys, "__stretch"]])
    both = F.greatest("__inside", "__carried") if how == "max" else F.coalesce(F.col("__inside") + F.col("__carried"), "__inside", "__carried")
    return rows.withColumn(name, both).drop("__value", "__stretch", "__inside", "__carried")
