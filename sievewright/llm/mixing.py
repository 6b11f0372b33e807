r"""Mixing sources to target weights, in DataFrame functions only.

Sources by code point, null last, weigh 1, 2, 3 and so on again, and share all words. A target stops at LIMIT times its
source's words; the excess goes to the others by weight until none is above. That is the level at which
sum(min(cap, level * weight)) is the total: with sources in order of cap / weight, those before the first whose share of
the rest fits are capped. A document is emitted floor(rate) times, and once more if a hash of its doc_id and the seed,
read as a number from 0 to 1, is below the fraction of the rate.

Null texts and texts without words have size 0 and are emitted at their source's rate (a source without words: never);
equal doc_ids draw alike; an empty table gives an empty mix. The table of sources has a row for each source; it is broadcast
if it is counted to have at most SMALL rows, else joined by shuffle, where Spark splits a hot source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .workspace import Workspace, documents

LIMIT, SEED, SMALL = 3, 20_240_501, 10_000
WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sized: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from rows of source and size."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sums.select("source", "source_size", (F.col("source_size") * limit).alias("cap"), ((F.row_number().over(order) - 1) % 3 + 1).cast("long").alias("w"))
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = weighed.withColumns({
        "rest": F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "rest_w": F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)),
    })
    fits = F.when(F.col("rest") * F.col("w") <= F.col("cap") * F.col("rest_w"), F.struct(-F.col("rest_w"), "rest", "rest_w"))
    level = F.min(fits).over(every)
    return left.select("source", "source_size", F.when(F.col("rest_w") > level["rest_w"], F.col("cap").cast("double")).otherwise(level["rest"].cast("double") * F.col("w") / level["rest_w"]).alias("target"))


def _rated(rows: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """rows, which have source, size and doc_id, with source_size, target and copies."""
    if targets.count() <= SMALL:
        targets = F.broadcast(targets)
    joined = rows.join(targets.withColumnRenamed("source", "__of"), F.col("source").eqNullSafe(F.col("__of"))).drop("__of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    return joined.withColumn("copies", (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("long"))


def mix(docs: DataFrame, limit: int = LIMIT, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of each document."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size")
    sized = docs.select("doc_id", "source", size)
    targets = Workspace(docs.sparkSession, "mixing").save(source_targets(sized.select("source", "size"), limit), "targets")
    return _rated(sized, targets, seed)


def mixed(docs: DataFrame, limit: int = LIMIT, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of docs, each as often as it is taken."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size")
    targets = Workspace(docs.sparkSession, "mixing").save(source_targets(docs.select("source", size), limit), "targets")
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), docs["doc_id"], docs["source"])
    return _rated(held, targets, seed).where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL = rf"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORDS}')), 0)::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT source, source_size, {LIMIT} * source_size AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sums),
laid AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::BIGINT AS rest, (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::BIGINT AS rest_w
  FROM weighed WINDOW before AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rest AS at_rest, rest_w AS at_w FROM laid WHERE rest * w <= cap * rest_w ORDER BY rest_w DESC LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN rest_w > at_w THEN cap::DOUBLE ELSE at_rest::DOUBLE * w / at_w END AS target FROM laid, level),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {1 << 52}::DOUBLE AS drawn
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rated
"""
