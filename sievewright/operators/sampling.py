"""Fair samples for human labels, blind to what the judge said."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import hash_order, stripped
from .workspace import Workspace, partitions

# What a labeller may write, and what it means.
LABELS = {"safe": "non_violation", "s": "non_violation", "unsafe": "violation", "u": "violation"}


class LabelError(ValueError):
    pass


def stratified(rows: DataFrame, n: int, seed: int = 42, strata: tuple[str, ...] = ("violated_policy", "stratum"), key: str = "id") -> DataFrame:
    """n rows, one of each stratum in turn, in a hashed order within; the turn goes by the strata's values.

    Only the n first of each stratum can be taken, which the rank's limit tells Spark before the rows are sorted.
    """
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy(hash_order(seed, F.col(key)), F.col(key)))
    return rows.withColumn("__turn", rank).where(F.col("__turn") <= n).orderBy("__turn", *strata).limit(n).drop("__turn")


def numbered(rows: DataFrame, order: list[Column], work: Workspace) -> DataFrame:
    """rows with row, their number from 1 in an order: sorted in ranges, with each range's offset from the ranges' counts."""
    names = [f"__order{k}" for k in range(len(order))]
    held = rows.withColumns(dict(zip(names, order)))
    sorted_rows = held.repartitionByRange(partitions(rows.sparkSession), *names).sortWithinPartitions(*names).drop(*names)
    held = work.save(sorted_rows.withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__at", 33)
    base, bases = 0, []
    for r in held.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():  # as many as partitions
        bases.append((r.part, base))
        base += r.n
    offsets = F.broadcast(rows.sparkSession.createDataFrame(bases, "__part long, __base long"))
    return held.join(offsets, part == F.col("__part")).withColumn("row", F.col("__base") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__at", "__part", "__base")


def blind_sheet(rows: DataFrame, seed: int = 42, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """A sheet (row, prompt) in a hashed order that tells nothing, and the key (row, id, policy, severity) kept apart."""
    made = numbered(rows, [hash_order(seed, F.col(key)), F.col(key)], Workspace(rows.sparkSession, "blind-sheet"))
    return made.select("row", "prompt"), made.select("row", key, "violated_policy", "severity")


def read_labels(sheet: DataFrame, column: str = "label") -> DataFrame:
    """sheet with gold_verdict; a blank label is null, any other that isn't known is an error and never a verdict."""
    word = F.lower(stripped(F.coalesce(F.col(column), F.lit(""))))
    known = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    out = sheet.withColumn("gold_verdict", F.try_element_at(known, word))
    wrong = out.where(F.col("gold_verdict").isNull() & (word != "")).select(column).distinct().orderBy(column).limit(5).collect()
    if wrong:
        raise LabelError(f"labels that are neither safe nor unsafe: {[r[0] for r in wrong]}")
    return out
