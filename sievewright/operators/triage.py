"""Checking verdicts against claims, and sending every record to one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import LEVELS, blank

REQUIRED = ("id", "prompt", "violated_policy", "severity", "domain", "generation_rationale")
BLAMES = ("generator_wrong", "both_wrong", "judge_wrong", "severity_disagreement", "both_right")


def record_problems(required: tuple[str, ...] = REQUIRED) -> Column:
    """What is wrong with a record; an empty array if nothing."""
    missing = [F.when(blank(F.col(c)), F.lit(f"missing {c}")) for c in required]
    level = [F.when(~blank(F.col("severity")) & ~F.col("severity").isin(*LEVELS), F.lit("severity out of range"))] if "severity" in required else []
    return F.array_compact(F.array(*missing, *level))


def audited(judged: DataFrame, severity_gate: bool = False) -> DataFrame:
    """Adds policy_match, severity_match and accepted, never null."""
    claim = F.col("matched_policy_id").eqNullSafe(F.col("violated_policy"))
    match = (F.coalesce(F.col("verdict") == "violation", F.lit(False)) & claim).alias("policy_match")
    same = (F.col("judged_severity").isNotNull() & F.col("judged_severity").eqNullSafe(F.col("severity"))).alias("severity_match")
    out = judged.withColumn("policy_match", match).withColumn("severity_match", same)
    fine = F.col("policy_match") & ~F.coalesce(F.col("requires_external_context"), F.lit(False))
    return out.withColumn("accepted", fine & F.col("severity_match") if severity_gate else fine)


def routed(checked: DataFrame) -> DataFrame:
    """Adds destination: failed judgments are reviewed, accepted ones kept, non-violations rejected, the rest reviewed."""
    return checked.withColumn("destination", F.when(F.col("judge_error").isNotNull(), "review").when(F.col("accepted"), "accepted").when(F.col("verdict") == "non_violation", "rejected").otherwise("review"))


def failures(api: DataFrame, parse: DataFrame, validate: DataFrame) -> DataFrame:
    """The three kinds of failures in one table; columns that a kind lacks are null."""
    out = None
    for stage, df in (("api", api), ("parse", parse), ("validate", validate)):
        df = df.withColumn("stage", F.lit(stage))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def blame(gold_verdict: str = "gold_verdict", gold_severity: str = "gold_severity") -> Column:
    """Who was wrong, by a human's label: the generator's claim, the judge, both, their severity, or nobody."""
    human = F.col(gold_verdict) == "violation"
    judge = F.coalesce(F.col("verdict") == "violation", F.lit(False))
    differs = F.coalesce(F.col(gold_severity) != F.col("judged_severity"), F.lit(False))
    return F.when(~human, F.when(judge, "both_wrong").otherwise("generator_wrong")).when(~judge, "judge_wrong").when(differs, "severity_disagreement").otherwise("both_right")


def relabelled(records: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds relabelled_severity from (id, relabelled_severity), and whether that is ok; nothing is filled in."""
    good = labels.where(F.col("relabelled_severity").isin(*LEVELS))
    return records.join(good, "id", "left").withColumn("severity_relabel_status", F.when(F.col("relabelled_severity").isNull(), "failed").otherwise("ok"))


def allowed_from_review(rejected: DataFrame, labels: DataFrame) -> DataFrame:
    """(policy_id, allowed_examples): rejected prompts that a human confirms, each once, in order."""
    sure = rejected.join(labels.where("gold_verdict = 'non_violation'").select("id").distinct(), "id", "left_semi")
    return sure.groupBy(F.col("violated_policy").alias("policy_id")).agg(F.array_sort(F.collect_set("prompt")).alias("allowed_examples"))
