"""Incremental loading: high-water mark filter and keyed replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_dt(df: DataFrame, column: str = "dt") -> DataFrame:
    return df.agg(F.max(column).alias(f"max_{column}"))


def incremental_filter(batch: DataFrame, target: DataFrame, column: str = "dt", *, inclusive: bool = False) -> DataFrame:
    """Batch rows above the target's high-water mark, compared as text; everything when the target is empty.

    The mark is a scalar subquery: it stays in the plan, is computed once, and prunes partitions of the batch
    when ``column`` partitions it.
    """
    mark = max_dt(target, column).scalar()
    newer = F.col(column) >= mark if inclusive else F.col(column) > mark
    return batch.where(mark.isNull() | newer)


def upsert_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the batch, plus the whole batch.

    The key list is made distinct first, so a key repeated in the batch does not pile up in one task.
    """
    replaced = batch.select(key).distinct()
    return target.join(replaced, on=key, how="left_anti").select(*target.columns).unionByName(batch)
