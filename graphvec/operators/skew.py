"""Joins in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphvec.storage import materialize

MOST = 10_000


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", most: int = MOST) -> DataFrame:
    """`left` joined with `right`, which has one row a key at most; `left` is read three times, so
    it should be a written table.  A key with over one in `most` of left's rows is heavy: there are fewer than
    `most` of these, so they meet a broadcast, and their rows stay where they are.  All other
    keys meet in a shuffle, where none holds more than that share."""
    rows = left.count()
    heavy = materialize(left.groupBy(*on).count().where(F.col("count") * most > rows).select(*on), "heavy-keys")
    listed = F.broadcast(heavy)  # fewer than `most` rows
    few = F.broadcast(right.join(listed, on, "left_semi"))  # one row for each of them at most
    apart = left.join(listed, on, "left_anti").join(right, on, how)
    return left.join(listed, on, "left_semi").join(few, on, how).unionByName(apart)
