"""Running values over long groups: blocks are scanned side by side, what each leaves behind is carried into the next.

A window over a whole group sorts it in one task. Here a group is cut into blocks of bounded size; each block's own
running values and, as one row, what it hands on are computed by as many tasks as there are blocks; the rows handed on are
combined in order, and added to the blocks. Only that small table (a row for each block) has a window over the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from confluo.operators.order import number

#: Rows of a block.
BLOCK = 50_000


def running(df: DataFrame, group: list[str], block: str, order: str, values: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add running values of each row's group up to it.

    block: a column that rises with the order within a group. values: new columns by name, each (kind, value), kind being
    last or first (of the values that are not null; null if there is none), before (last, without the row itself) or sum
    (nulls count as 0).
    """
    keys = [*group, block]
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    here, leaves, both = [], [], []
    for name, (kind, value) in values.items():
        own, at = f"_own_{name}", F.when(value.isNotNull(), F.col(order))
        if kind == "sum":
            here.append(F.sum(value).over(upto).alias(own))
            leaves.append(F.sum(value).alias(f"_out_{name}"))
            zero = F.lit(0).cast("long")
            both.append((F.coalesce(F.col(f"_in_{name}"), zero) + F.coalesce(F.col(own), zero)).alias(name))
        elif kind == "first":
            here.append(F.first(value, ignorenulls=True).over(upto).alias(own))
            leaves.append(F.min_by(value, at).alias(f"_out_{name}"))
            both.append(F.coalesce(f"_in_{name}", own).alias(name))
        elif kind in ("last", "before"):
            here.append(F.last(value, ignorenulls=True).over(upto if kind == "last" else upto.rowsBetween(Window.unboundedPreceding, -1)).alias(own))
            leaves.append(F.max_by(value, at).alias(f"_out_{name}"))
            both.append(F.coalesce(own, f"_in_{name}").alias(name))
        else:
            raise ValueError(f"no such kind: {kind}")
    handed = df.groupBy(*keys).agg(*leaves).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(F.col(f"_out_{n}") for n in values))
    earlier = Window.partitionBy(*(f"_k{i}" for i in range(len(group)))).orderBy(f"_k{len(group)}").rowsBetween(Window.unboundedPreceding, -1)
    handed = handed.select(*(f"_k{i}" for i in range(len(keys))), *(_over(v[0], F.col(f"_out_{n}"), earlier).alias(f"_in_{n}") for n, v in values.items()))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.select("*", *here).join(handed, on, "left").select(*df.columns, *both)


def _over(kind: str, out: Column, w: Window) -> Column:
    return F.sum(out).over(w) if kind == "sum" else (F.first if kind == "first" else F.last)(out, ignorenulls=True).over(w)


def blocks(df: DataFrame, group: list[str], order: list[str], size: int = BLOCK) -> DataFrame:
    """df with _n, dense numbers in the order of group and order, and _block, for running(); rows that tie stay apart in any
    order. A group of any size is sorted by many tasks."""
    return number(df, [F.col(c) for c in (*group, *order)], "_n").withColumn("_block", F.expr(f"_n div {size}"))
