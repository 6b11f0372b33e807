"""python -m sievewright: the stages as commands over files of JSON lines."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import metrics, parsing, rendering, triage
from .plans import stages
from .sources import config, endpoints, files

RECORDS = "id string, prompt string, violated_policy string, severity string, domain string, generation_rationale string"
CALLS = "call_idx long, policy_id string, severity string, model string, count int, content string, ok boolean, error string, finish_reason string"
JUDGED = "id string, prompt string, violated_policy string, severity string, verdict string, matched_policy_id string, judged_severity string, requires_external_context boolean, judge_error string"


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sievewright")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, options in {
        "plan": ("config", "output"), "records": ("config", "input", "output"), "ask": ("config", "input", "output"), "judge": ("config", "input", "answers", "output"),
        "dedup": ("config", "input", "vectors", "output"), "call": ("config", "input", "output"), "embed": ("config", "input", "output"),
        "evaluate": ("gold", "predictions"), "sample": ("input", "output"), "score": ("labels", "predictions"),
    }.items():
        command = sub.add_parser(name)
        for option in options:
            command.add_argument(f"--{option}", required=True)
        if name == "sample":
            command.add_argument("--n", type=int, default=50)
            command.add_argument("--seed", type=int, default=42)
        if name == "call":
            command.add_argument("--judge", action="store_true", help="the input is what `ask` wrote, not `plan`")
        if "config" in options:
            command.add_argument("--model", help="in place of the settings' one")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("sievewright").getOrCreate()
    run = config.load(args.config) if getattr(args, "config", None) else None
    if args.command == "plan":
        asked = stages.requests(spark, run, args.model)
        digest = files.write_records(asked, args.output)
        sums = asked.agg(F.count("*").alias("calls"), F.sum("count").alias("requested")).first()
        system = rendering.system_message(run.domain, run.language)
        print(stages.manifest(run, {"digest": digest, "system": system, "api_calls": sums.calls, "requested": sums.requested or 0, **stages.sources(spark, run)}))
    elif args.command == "records":
        calls = files.read_records(spark, args.input, CALLS, "call_idx")
        made, failed = stages.build_records(calls, run, stages.requests(spark, run, args.model), stages.policies_of(spark, run))
        digest = files.write_records(made, f"{args.output}/records")
        made = spark.read.schema(made.schema).json(f"{args.output}/records")  # as it was written, so that counts don't parse again
        counts = {"digest": digest, "api_calls": calls.count(), "produced": made.count(), "failures": failed.count(), **stages.counted(made, "severity", "violated_policy", "meta.generator_model")}
        strategies = calls.where("ok").select(parsing.parse_reply("content").strategy.alias("parse_strategy"))
        counts |= stages.counted(strategies, "parse_strategy")
        counts |= stages.sources(spark, run)
        if counts["failures"]:
            files.write_records(failed, f"{args.output}/failures")
        print(stages.manifest(run, counts))
    elif args.command == "ask":
        rows = files.read_records(spark, args.input, RECORDS, required=triage.REQUIRED)
        print(stages.manifest(run, {"digest": files.write_records(stages.judge_requests(rows, stages.policies_of(spark, run), stages.context_of(spark, run)), args.output)}))
    elif args.command == "judge":
        rows = files.read_records(spark, args.input, RECORDS, required=triage.REQUIRED)
        answers = files.read_records(spark, args.answers, "id string, content string, ok boolean, error string")
        done = stages.judge(rows, answers, run.judge.require_severity_match, stages.policies_of(spark, run), args.model or run.judge.model or run.model, stages.context_of(spark, run))
        done.write.mode("overwrite").partitionBy("destination").json(args.output)
        done = spark.read.schema(done.schema).json(args.output)
        print(stages.manifest(run, {"failures": done.where("judge_error IS NOT NULL").count(), **stages.counted(done, "destination", "verdict", "judged_severity")}))
    elif args.command == "dedup":
        rows = files.read_records(spark, args.input, "id string, prompt string, violated_policy string, severity string, domain string, generation_rationale string, score double", required=("id", "prompt", "violated_policy"))
        vectors = files.read_records(spark, args.vectors, "id string, vector array<double>")
        kept, told, crossing = stages.dedup(rows, vectors, run.semantic_dedup.threshold)
        digests = {name: files.write_records(df, f"{args.output}/{name}") for name, df in (("retained", kept), ("duplicates", told), ("cross_policy", crossing))}
        print(stages.manifest(run, {"output_sha256": digests, "threshold": run.semantic_dedup.threshold, "source_records": rows.count(), "retained": kept.count(), "clusters": told.count(), "cross_policy_candidates": crossing.count(), **stages.counted(kept, "violated_policy")}))
    elif args.command == "call":
        if args.judge:
            asked = files.read_records(spark, args.input, "id string, system string, judge_user string").withColumn("model", F.lit(args.model or run.judge.model or run.model))
        else:
            asked = files.read_records(spark, args.input, "call_idx long, policy_id string, severity string, model string, count int, user string", "call_idx").withColumn("system", F.lit(rendering.system_message(run.domain, run.language)))
        done = endpoints.completed(asked, endpoints.Endpoint.of(run, args.judge), run.judge.concurrency if args.judge else run.concurrency, "judge_user" if args.judge else "user")
        digest = files.write_records(done.drop("system", "user", "judge_user"), args.output)
        print(stages.manifest(run, {"digest": digest, **stages.counted(done, "ok", "finish_reason")}))
    elif args.command == "embed":
        rows = files.read_records(spark, args.input, RECORDS, required=("id", "prompt"))
        made = endpoints.embedded(rows, endpoints.sentence_encoder(run.semantic_dedup.model, run.semantic_dedup.batch_size), run.semantic_dedup.batch_size)
        print(stages.manifest(run, {"digest": files.write_records(made, args.output), "vectors": made.count()}))
    elif args.command == "evaluate":
        gold = files.read_records(spark, args.gold, "id string, policy_id string, gold_verdict string, gold_severity string")
        row = metrics.evaluation(metrics.scored(gold, files.read_records(spark, args.predictions, JUDGED))).first()
        print(json.dumps(row.asDict(), sort_keys=True, indent=2))
    elif args.command == "sample":
        files.write_records(stages.worksheet(files.read_records(spark, args.input, JUDGED), args.n, args.seed), args.output)
    else:
        labels = files.read_records(spark, args.labels, "id string, policy_id string, gold_verdict string, gold_severity string")
        print(stages.report(stages.review(labels, files.read_records(spark, args.predictions, JUDGED))))


if __name__ == "__main__":
    main()
