"""From parsed replies to records: each call's quota, filled from what it returned, without what is kept already."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import blank, content_id

_TOLD = "policy_id string, call_idx long, pos int, id string, kept boolean"


def _named(entries: DataFrame) -> DataFrame:
    named = entries.withColumn("id", content_id(F.col("policy_id"), F.col("prompt")))
    if "problems" in entries.columns:
        return named.withColumn("ok", F.size("problems") == 0)
    return named.where(~blank(F.col("prompt"))).withColumn("ok", F.lit(True))


def _told(named: DataFrame, *more: str) -> DataFrame:
    """`quota_told` of named entries, with more columns (integers) taken along."""
    place = [F.col("policy_id"), F.col("call_idx").cast("long"), F.col("pos").cast("int"), F.col("id")]
    others = [F.col(c).cast("int") for c in more]
    slim = named.select(*place, "quota", "ok", *others)
    of_id, call = Window.partitionBy("policy_id", "id"), Window.partitionBy("policy_id", "call_idx")
    counted = slim.withColumn("again", F.sum(F.col("ok").cast("int")).over(of_id) > 1).withColumn("mixed", F.max(F.col("again") & F.col("ok")).over(call))
    before = F.coalesce(F.sum(F.col("ok").cast("int")).over(call.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lone = counted.where("NOT mixed").withColumn("before", before).where("before < quota").select("policy_id", "call_idx", "pos", "id", F.col("ok").alias("kept"), *more)
    rest = counted.where("mixed").drop("mixed")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        policy = call = object()
        seen: set[str] = set()
        left = 0
        for batch in batches:
            told, kept = [], []
            for p, c, q, i, ok, again in zip(batch.policy_id, batch.call_idx, batch.quota, batch.id, batch.ok, batch.again):
                if p != policy:
                    policy, call, seen = p, object(), set()
                if c != call:
                    call, left = c, q
                take = left > 0 and ok and i not in seen
                told.append(take or left > 0 and not ok)
                kept.append(take)
                if take:
                    left -= 1
                    if again:
                        seen.add(i)
            yield batch.assign(kept=kept).loc[told, ["policy_id", "call_idx", "pos", "id", "kept", *more]]

    schema = ", ".join([_TOLD, *(f"{c} int" for c in more)])
    return lone.unionByName(rest.repartition("policy_id").sortWithinPartitions("policy_id", "call_idx", "pos").mapInPandas(fold, schema))


def quota_told(entries: DataFrame) -> DataFrame:
    """(policy_id, call_idx, pos, id, kept) of (policy_id, call_idx, pos, quota, prompt) and, if there, problems.

    Calls go in order of call_idx. An entry that has problems isn't kept and doesn't count, and is among the rows if its
    call's quota wasn't full when its turn came; one whose id was kept before is skipped; either way the next may take its
    place. Entries beyond a full quota are neither kept nor remembered. Without problems, blank prompts are dropped.

    Ids contain the policy, so policies are independent; and so is a call none of whose ids comes again in its policy,
    which a window over the call settles. Only the other calls of a policy are folded in order, in a task that streams
    through them and remembers ids that come again. Prompts stay behind: ids stand for them.
    """
    return _told(_named(entries))


def quota_folded(entries: DataFrame) -> DataFrame:
    """(policy_id, call_idx, pos, id, prompt, kept): `quota_told` with each row's prompt, which it meets again by a join."""
    key = ["policy_id", "call_idx", "pos", "id"]
    # rows that share all of the key are told apart by their number
    named = _named(entries).withColumn("copy", F.row_number().over(Window.partitionBy(*key).orderBy("prompt", "ok", "quota")))
    prompts = named.select(*[F.col(c).alias(f"_{c}") for c in (*key, "copy")], "prompt")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*key, "copy")]
    return _told(named, "copy").join(prompts, same).select(*key, "prompt", "kept")


def quota_trimmed(entries: DataFrame) -> DataFrame:
    """(policy_id, call_idx, pos, id, prompt) of the entries that `quota_folded` keeps."""
    return quota_folded(entries).where("kept").drop("kept")


def generation_counts(records: DataFrame) -> DataFrame:
    """Counts by severity, policy and model in one pass: (kind, value, n)."""
    held = F.grouping_id()
    sets = records.groupingSets([["severity"], ["violated_policy"], ["model"]], "severity", "violated_policy", "model").agg(F.count("*").alias("n"), held.alias("g"))
    kind = F.when(F.col("g") == 3, "severity").when(F.col("g") == 5, "policy").otherwise("model")
    return sets.select(kind.alias("kind"), F.coalesce("severity", "violated_policy", "model").alias("value"), "n")
