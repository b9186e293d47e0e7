"""Joins whose hot keys are dealt out to many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: list[str],
                how: str = "left", salts: int = 16, hot: DataFrame | None = None) -> DataFrame:
    """``left`` joined to ``right``, which has one row per ``key``.

    Rows of one key on the left go to ``salts`` places, told apart by the
    columns ``spread``; the right side is repeated as often. A key that holds
    a third of all rows then costs a task a third of 1/``salts`` of them. With
    ``hot``, a table of the frequent keys that is small enough to be broadcast,
    only these are dealt out and repeated.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    places = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        marks = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
        left, right = left.join(marks, key, "left"), right.join(marks, key, "left")
        salt = F.when(F.col("_hot"), salt).otherwise(0)
        places = F.when(F.col("_hot"), places).otherwise(F.array(F.lit(0)))
    dealt = left.withColumn("_salt", salt).drop("_hot")
    copies = right.withColumn("_salt", F.explode(places)).drop("_hot")
    return dealt.join(copies, [key, "_salt"], how).drop("_salt")
