"""Joining rows to one fact about their group, however many rows a group has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups that are broadcast, at most; groups of fewer rows than LEAST never are.
HOT_GROUPS, LEAST = 50_000, 1_000


def joined_to_groups(rows: DataFrame, facts: DataFrame, key: str, many: str = "many") -> DataFrame:
    """rows joined with facts, which has one row a key and in column many the number of rows that have it.

    A group above 1/HOT_GROUPS of all rows (and LEAST) is hot. Its fact is broadcast, so that its rows stay where they
    are; as the counts sum to the rows, fewer than HOT_GROUPS groups can be hot. All others meet their fact by a shuffle, of
    which no key is hot any more. Both tables are read twice, so they should be written ones.
    """
    seen = facts.agg(F.coalesce(F.sum(many), F.lit(0)).alias("total"), F.coalesce(F.max(many), F.lit(0)).alias("most")).first()
    limit = max(LEAST, seen.total // HOT_GROUPS)
    if seen.most <= limit:
        return rows.join(facts, key)
    above = F.col(many) > limit
    hot = facts.where(above)
    first = rows.join(F.broadcast(hot), key)
    return first.unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(facts.where(~above), key))
