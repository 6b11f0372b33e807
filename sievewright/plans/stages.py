"""The stages of a run. Requests leave as a table, completions come back as one; the model itself is outside."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import blank, content_id, stripped
from ..operators import metrics, parsing, planning, records, rendering, sampling, similarity, triage
from ..operators.workspace import Workspace, ship
from ..sources import files
from ..sources.config import Run
from ..sources.policies import PolicyError, load_policies, select_policies, text_sha256

# Fixed value: what a record says whose reply gave no reason.
NO_REASON = "(not provided by model)"


def context_of(spark: SparkSession, run: Run) -> str:
    """The block of the run's auxiliary documents, if it has any."""
    if not run.aux_documents:
        return ""
    block = rendering.context_block(files.load_documents(spark, run.aux_documents), run.aux_char_budget).first()
    return block.block if block and block.n_documents else ""


def policies_of(spark: SparkSession, run: Run) -> DataFrame:
    return select_policies(load_policies(spark, run.policy_file), run.policy_ids)


def models_of(run: Run, model: str | None = None) -> list[tuple[str, float]]:
    """(model, share) of the run's generators, or of a named model alone; without either, of the run's model."""
    weights = [] if model else [(g.model, g.weight) for g in run.generators]
    return planning.shares(weights or [((model or run.model).strip(), 1.0)])


def requests(spark: SparkSession, run: Run, model: str | None = None) -> DataFrame:
    """(call_idx, policy_id, severity, model, chunk, count, user): what a dry run shows and a connector sends."""
    policies, context = policies_of(spark, run), context_of(spark, run)
    known = policies.select("policy_id", "ordinal")
    if run.stage == "calibration":
        cells = planning.pilot_cells(known, run.pilot_per_cell)
    else:
        cells = planning.plan_cells(known, run.total, run.severity_ratio or None)
    plan = planning.plan_chunks(planning.plan_models(cells, models_of(run, model)), run.max_prompts_per_call)
    made = rendering.rendered(plan, policies, run.domain, context)
    order = F.struct("ordinal", "level", "place", "chunk")
    # a plan has as many rows as calls to a paid endpoint, so that numbering them in one window is no burden
    from pyspark.sql import Window

    return made.select((F.row_number().over(Window.orderBy(order)) - 1).cast("long").alias("call_idx"), "policy_id", "severity", "model", "chunk", "count", "user")


def build_records(completions: DataFrame, run: Run, asked: DataFrame | None = None, policies: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, failures) of (call_idx, policy_id, severity, model, count, content, ok, error, finish_reason).

    With asked, the requests, and policies, meta tells which texts a record goes back to; else these members are null.
    """
    ship(completions.sparkSession)
    ok = completions.where("ok").withColumn("p", parsing.parse_reply("content"))
    api = completions.where("NOT coalesce(ok, false)").select("policy_id", "severity", F.col("count").alias("requested"), "error")
    parse = ok.where("p.strategy = 'none'").select("policy_id", "severity", F.col("count").alias("requested"), F.col("p.error").alias("error"), "finish_reason", F.length("content").alias("response_chars"))
    entries = ok.select("policy_id", "call_idx", F.col("count").cast("int").alias("quota"), "severity", "model", F.col("p.strategy").alias("parse_strategy"), F.posexplode("p.prompts").alias("pos", "e")).select("*", F.col("e.prompt").alias("prompt"), F.col("e.generation_rationale").alias("generation_rationale")).drop("e")
    reason = F.coalesce(F.nullif(stripped(F.col("generation_rationale")), F.lit("")), F.lit(NO_REASON))
    whole = entries.withColumn("violated_policy", F.col("policy_id")).withColumn("domain", F.lit(run.domain or "general")).withColumn("generation_rationale", reason)
    whole = whole.withColumn("id", content_id(F.col("policy_id"), F.col("prompt"))).withColumn("problems", triage.record_problems())
    # parsed once, and read by the fold and by what takes its answer
    whole = Workspace(completions.sparkSession, "records").save(whole, "entries")
    folded = records.quota_told(whole.select("policy_id", "call_idx", "pos", "quota", "prompt", "problems")).select("policy_id", "call_idx", "pos", "kept")
    checked = whole.join(folded, ["policy_id", "call_idx", "pos"])
    wrong = checked.where("NOT kept").select("policy_id", "severity", F.array_join("problems", "; ").alias("error"))
    fine = checked.where("kept")
    none = F.lit(None).cast("string")
    if policies is None:
        fine = fine.withColumns({"policy_statement": none, "policy_sha256": none, "policy_version": none})
    else:
        fine = fine.join(F.broadcast(policies.select("policy_id", F.col("statement").alias("policy_statement"), F.col("sha256").alias("policy_sha256"), F.col("effective_version").alias("policy_version"))), "policy_id", "left")
    if asked is None:
        fine = fine.withColumn("generation_user_sha256", none)
    else:
        fine = fine.join(asked.select("call_idx", F.sha2("user", 256).alias("generation_user_sha256")), "call_idx", "left")
    system = F.lit(text_sha256(rendering.system_message(run.domain, run.language)))
    meta = F.struct(
        F.col("model").alias("generator_model"), "model", "parse_strategy", "policy_statement", "policy_sha256", "policy_version",
        system.alias("generation_system_sha256"), "generation_user_sha256", F.lit(run.run_id or None).cast("string").alias("run_id"),
    )
    return fine.select("id", "prompt", "violated_policy", "severity", "domain", "generation_rationale", meta.alias("meta")), triage.failures(api, parse, wrong)


def sources(spark: SparkSession, run: Run) -> dict[str, Any]:
    """For manifests: digests of the files that a run reads, and versions of its policies."""
    versions = {r.policy_id: {"version": r.effective_version, "sha256": r.sha256} for r in policies_of(spark, run).select("policy_id", "effective_version", "sha256").collect()}
    return {"policy_file_sha256": files.file_digest(spark, run.policy_file), "aux_document_sha256": {p: files.file_digest(spark, p) for p in run.aux_documents}, "policies": versions}


def check_policies(rows: DataFrame, policies: DataFrame) -> None:
    """Raises, with their names, if rows claim policies that the catalog lacks."""
    lost = rows.select(F.col("violated_policy").alias("policy_id")).distinct().join(F.broadcast(policies.select("policy_id")), "policy_id", "left_anti").orderBy("policy_id").limit(20).collect()
    if lost:
        raise PolicyError(f"records claim unknown policies: {[r.policy_id for r in lost]}")


def judge_requests(rows: DataFrame, policies: DataFrame, context: str = "") -> DataFrame:
    """(id, system, judge_user): what a connector sends to the judge."""
    check_policies(rows, policies)
    return rendering.judge_requests(rows, policies, context).select("id", F.lit(rendering.JUDGE_SYSTEM).alias("system"), "judge_user")


def judge(rows: DataFrame, answers: DataFrame, gate: bool = False, policies: DataFrame | None = None, model: str = "", context: str = "") -> DataFrame:
    """rows with (id, content, ok, error) answered by the judge, checked and sent to a destination.

    With policies, which must have all that rows claim, columns judge_* tell the model and the texts that it was shown.
    """
    ship(rows.sparkSession)
    said = rows.join(answers.select("id", "content", "ok", F.col("error").alias("__error")), "id", "left").withColumn("j", parsing.parse_judgment("content", "violated_policy"))
    answered = F.coalesce("ok", F.lit(False))
    failed = F.when(~answered, F.concat(F.lit("api: "), F.coalesce("__error", F.lit("no answer")))).otherwise(F.concat(F.lit("parse: "), F.col("j.judge_error")))
    fields = [F.when(answered, F.col(f"j.{c}")).alias(c) for c in ("verdict", "matched_policy_id", "judged_severity", "requires_external_context", "decision_summary")]
    named = said.select(*[F.col(c) for c in rows.columns], *fields, failed.alias("judge_error"))
    out = triage.routed(triage.audited(named, gate))
    if policies is None:
        return out
    check_policies(rows, policies)
    compiled = policies.select(F.col("policy_id").alias("violated_policy"), F.col("sha256").alias("judge_policy_sha256"), F.col("effective_version").alias("judge_policy_version"), F.sha2(rendering.judge_policy(), 256).alias("judge_compiled_policy_sha256"))
    shown = rendering.judge_requests(rows, policies, context).select("id", F.sha2("judge_user", 256).alias("judge_user_sha256"))
    told = out.join(F.broadcast(compiled), "violated_policy", "left").join(shown, "id", "left").withColumn("judge_model", F.lit(model or None).cast("string"))
    return told.select(*out.columns, "judge_model", "judge_policy_sha256", "judge_policy_version", "judge_compiled_policy_sha256", "judge_user_sha256")


def counted(rows: DataFrame, *columns: str) -> dict[str, dict[str, int]]:
    """For manifests: how many rows have each value of a few columns of few values; nulls aren't counted."""
    if not columns:
        return {}
    names = [f"__{k}" for k in range(len(columns))]
    held = rows.select(*[F.col(c).cast("string").alias(n) for c, n in zip(columns, names)])
    sets = held.groupingSets([[n] for n in names], *names).agg(F.count("*").alias("n"))
    out: dict[str, dict[str, int]] = {c: {} for c in columns}
    for r in sets.collect():
        for c, n in zip(columns, names):
            if r[n] is not None:
                out[c][r[n]] = r.n
    return out


def dedup(rows: DataFrame, vectors: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(retained, duplicates, cross-policy pairs) by (id, vector); ids of records are numbered for the join."""
    work = Workspace(rows.sparkSession, "stage-dedup")
    similarity.check_vectors(vectors)
    bare = rows.select("id").join(vectors.select("id"), "id", "left_anti").limit(5).collect()
    if bare:
        raise similarity.VectorError(f"records without a vector: {[r.id for r in bare]}")
    score = F.col("score") if "score" in rows.columns else F.lit(None).cast("double")
    numbered = work.save(rows.select("id", "prompt", F.col("violated_policy").alias("policy"), score.alias("score")).join(vectors, "id").withColumn("text_id", F.col("id")).orderBy("id").withColumn("id", F.monotonically_increasing_id()), "numbered")
    vectored = numbered.select("id", "policy", "vector")
    members = work.save(similarity.policy_clusters(vectored, threshold, work).join(numbered.select("id", "prompt", "score"), "id"), "members")
    names = numbered.select("id", "text_id", "policy")
    gone = work.save(similarity.duplicates(members).join(names, "id").select("representative_id", F.col("text_id").alias("duplicate"), "policy"), "gone")
    pairs = work.save(similarity.similar_pairs(vectored, threshold, across=True), "pairs")
    told = gone.join(names.select(F.col("id").alias("representative_id"), F.col("text_id").alias("representative")), "representative_id").groupBy("representative", "policy").agg(F.array_sort(F.collect_list("duplicate")).alias("duplicate_ids"))
    crossing = similarity.cross_policy(pairs).join(names.select(F.col("id").alias("a"), F.col("text_id").alias("a_id")), "a").join(names.select(F.col("id").alias("b"), F.col("text_id").alias("b_id")), "b").select("a_id", "b_id", "policies", "similarity")
    return rows.join(gone.select(F.col("duplicate").alias("id")), "id", "left_anti"), told, crossing


def worksheet(judged: DataFrame, n: int = 50, seed: int = 42) -> DataFrame:
    """A blind sheet for labels: nothing of the judge's answer is on it."""
    rows = judged.withColumn("stratum", F.coalesce("verdict", F.lit("unjudged")))
    chosen = sampling.stratified(rows, n, seed)
    return chosen.select("id", F.col("violated_policy").alias("policy_id"), "prompt", F.lit(None).cast("string").alias("gold_verdict"), F.lit(None).cast("string").alias("gold_severity"), F.lit("").alias("note")).orderBy("id")


def review(labels: DataFrame, judged: DataFrame) -> dict[str, Any]:
    """Blame counts and agreement of labelled rows; unlabelled ones are told, unknown labels are an error."""
    known = labels.where(~blank(F.col("gold_verdict")))
    if not known.where("gold_verdict NOT IN ('violation', 'non_violation')").isEmpty():
        raise ValueError("labels are violation or non_violation")
    if not known.join(judged.select("id"), "id", "left_anti").isEmpty():
        raise ValueError("labels for records without a judgment")
    pairs = metrics.scored(known, judged)
    blamed = {r.blame: r.n for r in pairs.withColumn("blame", triage.blame()).groupBy("blame").agg(F.count("*").alias("n")).collect()}
    row = metrics.evaluation(pairs).first()
    kappa = metrics.weighted_kappa(pairs.withColumn("all", F.lit(1)), "gold_severity", "judged_severity", ["all"]).first()
    return {"labelled": known.count(), "unlabelled": labels.count() - known.count(), "blame": {b: blamed.get(b, 0) for b in triage.BLAMES}, "metrics": row.asDict(), "kappa": kappa.kappa if kappa else None}


def report(result: dict[str, Any]) -> str:
    """A review in lines of text."""
    show = lambda x: "undefined" if x is None else f"{x:.3f}" if isinstance(x, float) else str(x)
    lines = [f"{result['labelled']} labelled, {result['unlabelled']} not", *(f"  {k}: {v}" for k, v in result["blame"].items()), *(f"  {k}: {show(v)}" for k, v in result["metrics"].items()), f"  kappa: {show(result['kappa'])}"]
    return "\n".join(lines)


def manifest(run: Run, counts: dict[str, Any]) -> str:
    """What a run did, without keys."""
    now = datetime.now(timezone.utc)
    return json.dumps({"run_id": run.run_id or now.strftime("%Y%m%d_%H%M%S_") + uuid.uuid4().hex[:6], "generated_at": now.isoformat(timespec="seconds"), "config": run.shown(), "counts": counts}, ensure_ascii=False, indent=2, sort_keys=True)


def with_ids(rows: DataFrame) -> DataFrame:
    """Records' ids from their policies and prompts."""
    return rows.withColumn("id", content_id(F.col("violated_policy"), F.col("prompt")))
