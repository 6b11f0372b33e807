import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sievewright.__main__ import CALLS, main
from sievewright.operators import sampling
from sievewright.plans import stages
from sievewright.sources import config, endpoints, files
from sievewright.sources.policies import PolicyError, load_policies, parsed_lines, select_policies

POLICIES = [
    {"policy_id": "A", "policy": "Rule a", "policy_zh_TW": "甲", "severity": {"minor": "x"}, "example_prompts": {"L3": ["h"], "low": "l"}},
    {"policy_id": "B", "policy": "Rule b", "example_prompt": "e", "definitions": {"k": "v"}, "policy_version": "7"},
]


@pytest.fixture
def policy_file(tmp_path):
    path = tmp_path / "p.jsonl"
    path.write_text("# note\n\n" + "\n".join(json.dumps(p, ensure_ascii=False) for p in POLICIES), encoding="utf-8")
    return str(path)


def test_policies(spark, policy_file):
    rows = {r.policy_id: r for r in load_policies(spark, policy_file).collect()}
    assert rows["A"].statement == "甲" and rows["A"].example_prompts == ["l", "h"] and rows["A"].examples_by_severity == {"high": ["h"], "low": ["l"]}
    assert rows["B"].effective_version == "7" and rows["A"].effective_version.startswith("sha256:")
    assert [r.policy_id for r in select_policies(load_policies(spark, policy_file), ["B", "A"]).collect()] == ["A", "B"]
    with pytest.raises(PolicyError, match="unknown"):
        select_policies(load_policies(spark, policy_file), ["C"])


@pytest.mark.parametrize("lines, said", [(["{"], "line 1"), (["", "[]"], "line 2"), (['{"policy_id":"a","policy":"x"}'] * 2, "line 2"), ([], "no policy"), (['{"policy_id":"a"}'], "policy"), (['{"policy_id":"a","policy":"x","severity":{"low":"a","minor":"b"}}'], "twice")])
def test_policy_errors(lines, said):
    with pytest.raises(PolicyError, match=said):
        parsed_lines(lines)


NEEDED = {"policy_file": "p.jsonl", "domain": "d"}
# Settings as users of the format have them.
FULL = {
    "policy_file": "policies/some.jsonl", "policy_ids": [], "domain": "support", "language": "Traditional Chinese (Taiwan)", "total": 90, "severity_ratio": {"low": 0.3, "medium": 0.4, "high": 0.3},
    "aux_documents": ["aux/overview.md"], "aux_char_budget": 6000, "model": "m", "base_url": "https://host/v1", "api_key_env": "KEY", "temperature": 1.0, "max_tokens": 8192, "max_prompts_per_call": 5,
    "concurrency": 4, "max_retries": 3, "timeout": 300, "generators": [], "output_dir": "../output", "run_id": None,
    "judge": {"enabled": False, "model": "j", "base_url": None, "api_key_env": None, "temperature": 0.0, "max_tokens": 4096, "concurrency": 2, "max_retries": 3, "timeout": 300, "reasoning_effort": "high", "require_severity_match": False, "include_aux_context": True},
    "semantic_dedup": {"enabled": False, "provider": "sentence_transformers", "model": "e", "threshold": 0.90, "batch_size": 16},
}


def test_settings(tmp_path):
    run = config.from_mapping(NEEDED | {"total": 5, "api_key_env": "K", "generators": ["m", {"model": "n", "weight": 3}], "policy_ids": "A"}, {"total": 9, "domain": None})
    assert run.total == 9 and run.policy_ids == ["A"] and run.judge.api_key_env == "K" and "api_key_env" not in json.dumps(run.shown()) and run.shown()["generators"][1] == {"model": "n", "weight": 3}
    assert stages.models_of(run) == [("m", 0.25), ("n", 0.75)] and stages.models_of(run, " x ") == [("x", 1.0)] and stages.models_of(config.from_mapping(NEEDED | {"model": "m"})) == [("m", 1.0)]
    for bad in (
        {"odd": 1}, {"total": 0}, {"total": 2.5}, {"max_prompts_per_call": 0.5}, {"max_retries": 1.5}, {"max_retries": -1}, {"temperature": 3}, {"timeout": 0}, {"policy_file": " "}, {"domain": ""}, {"judge": {"x": 1}}, {"judge": 3},
        {"judge": {"reasoning_effort": "max"}}, {"judge": {"max_tokens": True}}, {"semantic_dedup": {"threshold": float("nan")}}, {"semantic_dedup": {"provider": "other"}}, {"generators": ["m", "m"]}, {"generators": {"model": "m"}}, {"generators": [{"model": " "}]},
    ):
        with pytest.raises(config.ConfigError):
            config.from_mapping(NEEDED | bad)
    full = config.from_mapping(FULL)
    assert full.judge.base_url == full.base_url and full.judge.api_key_env == "KEY" and full.max_tokens == 8192 and full.semantic_dedup.model == "e"
    (tmp_path / "s.json").write_text(json.dumps(FULL))
    assert config.load(str(tmp_path / "s.json")).policy_file == str(tmp_path / "policies/some.jsonl")


def test_yaml_settings(tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "s.yaml").write_text(yaml.safe_dump(FULL))
    assert config.load(str(tmp_path / "s.yaml")) == config.from_mapping(FULL).resolved(tmp_path)


def test_policy_digests():
    """The digest of a policy's JSON: all of its fields, sorted by name, without spaces."""
    made = parsed_lines([json.dumps({"policy_id": "X", "policy": " r ", "severity": {"minor": "a", "L2": "b", "high": "c"}, "example_prompts": {"high": ["two"], "low": "one"}, "domain": " d ", "notes": "n", "policy_zh_TW": "甲"})])[0]
    text = '{"allowed_examples":[],"definitions":{},"domain":"d","example_prompts":["one","two"],"examples_by_severity":{"high":["two"],"low":["one"]},"notes":"n","policy":"r","policy_id":"X","policy_version":null,"policy_zh_tw":"甲","severity":{"high":"c","low":"a","medium":"b"}}'
    assert made["sha256"] == hashlib.sha256(text.encode()).hexdigest() and made["effective_version"] == "sha256:" + made["sha256"][:12]
    flat = parsed_lines([json.dumps({"policy_id": "X", "policy": "r", "severity": {"low": "a", "medium": "b", "high": "c"}, "example_prompts": ["one", "two"]})])[0]
    keyed = parsed_lines([json.dumps({"policy_id": "X", "policy": "r", "severity": {"low": "a", "medium": "b", "high": "c"}, "example_prompts": {"low": ["one"], "high": ["two"]}})])[0]
    assert flat["example_prompts"] == keyed["example_prompts"] and flat["sha256"] != keyed["sha256"]
    assert len({parsed_lines([json.dumps({"policy_id": "X", "policy": "r", **more})])[0]["sha256"] for more in ({}, {"domain": "d"}, {"notes": "n"}, {"severity": {"low": "x"}})}) == 4


def test_run_from_requests_to_review(spark, policy_file):
    run = config.from_mapping({"policy_file": policy_file, "total": 12, "domain": "banking", "model": "m", "severity_ratio": {"low": 1, "medium": 1, "high": 1}, "max_prompts_per_call": 3})
    calls = stages.requests(spark, run).orderBy("call_idx").collect()
    assert [(c.policy_id, c.severity, c["count"]) for c in calls] == [(p, s, 2) for p in "AB" for s in ("low", "medium", "high")] and calls[0].call_idx == 0
    assert "[Examples]" not in calls[1].user and "[Examples]" in calls[2].user  # no examples at that level
    replies = [(c.call_idx, c.policy_id, c.severity, "m", 2, json.dumps([f"same {c.policy_id}", *[f"{c.policy_id}{c.severity}{k}" for k in range(4)]]), True, None, "stop") for c in calls[:-1]]
    replies.append((5, "B", "high", "m", 2, None, False, "timeout", None))
    done, failed = stages.build_records(spark.createDataFrame(replies, CALLS), run)
    prompts = sorted(r.prompt for r in done.collect())
    assert {r.generation_rationale for r in done.collect()} == {stages.NO_REASON} and done.first().meta.generation_user_sha256 is None
    full, _ = stages.build_records(spark.createDataFrame(replies, CALLS), run, stages.requests(spark, run), stages.policies_of(spark, run))
    metas = {(r.violated_policy, r.severity): r.meta for r in full.collect()}
    users = {(c.policy_id, c.severity): hashlib.sha256(c.user.encode()).hexdigest() for c in calls}
    assert all(m.generation_user_sha256 == users[k] and m.generator_model == "m" and m.policy_statement == {"A": "甲", "B": "Rule b"}[k[0]] for k, m in metas.items())
    assert stages.counted(full, "severity", "violated_policy") == {"severity": {"low": 4, "medium": 4, "high": 2}, "violated_policy": {"A": 6, "B": 4}}
    assert len(prompts) == 10 and prompts.count("same A") == prompts.count("same B") == 1  # a repeated prompt is made up for
    assert [(r.stage, r.error) for r in failed.collect()] == [("api", "timeout")]
    said = [(r.id, json.dumps({"verdict": "violation", "matched_policy_id": r.violated_policy, "severity": "low", "requires_external_context": False, "decision_summary": "s"}), True, None) for r in done.collect()]
    said[0] = (said[0][0], "?", True, None)
    judged = stages.judge(done, spark.createDataFrame(said, "id string, content string, ok boolean, error string"))
    assert {r.destination: r["count"] for r in judged.groupBy("destination").count().collect()} == {"accepted": 9, "review": 1}
    shown = {r.id: r.judge_user for r in stages.judge_requests(done, stages.policies_of(spark, run)).collect()}
    told = stages.judge(done, spark.createDataFrame(said, "id string, content string, ok boolean, error string"), policies=stages.policies_of(spark, run), model="j").collect()
    assert len(told) == 10 and all(r.judge_model == "j" and r.judge_user_sha256 == hashlib.sha256(shown[r.id].encode()).hexdigest() for r in told)
    assert [r.judge_error for r in told if r.judge_error] == ["parse: the reply holds no object"]
    with pytest.raises(PolicyError, match=r"\['B'\]"):
        stages.judge_requests(done, select_policies(stages.policies_of(spark, run), ["A"]))
    sheet = stages.worksheet(judged, 4)
    assert sheet.count() == 4 and "verdict" not in sheet.columns
    labels = spark.createDataFrame([(said[0][0], "A", "violation", "low"), (said[1][0], "A", "non_violation", None), (said[2][0], "A", None, None)], "id string, policy_id string, gold_verdict string, gold_severity string")
    result = stages.review(labels, judged)
    assert result["blame"]["judge_wrong"] == 1 and result["blame"]["both_wrong"] == 1 and result["unlabelled"] == 1 and "undefined" in stages.report(result)
    vectors = spark.createDataFrame([(r.id, [1.0, 0.01 * k]) for k, r in enumerate(done.collect())], "id string, vector array<double>")
    retained, told, crossing = stages.dedup(done, vectors, 0.9)
    assert retained.count() == 2 and told.count() == 2 and crossing.count() == 6 * 4


def test_calibration_and_production(spark, policy_file):
    with pytest.raises(config.ConfigError, match="calibration_run_id"):
        config.from_mapping(NEEDED | {"stage": "production"})
    with pytest.raises(config.ConfigError, match="stage"):
        config.from_mapping(NEEDED | {"stage": "other"})
    run = config.from_mapping({"policy_file": policy_file, "domain": "d", "stage": "calibration", "pilot_per_cell": 2, "model": "m"})
    assert [(c.policy_id, c.severity, c["count"]) for c in stages.requests(spark, run).orderBy("call_idx").collect()] == [(p, s, 2) for p in "AB" for s in ("low", "medium", "high")]


def test_labels_are_read_or_refused(spark):
    rows = spark.createDataFrame([("a", " Safe"), ("b", "U"), ("c", None), ("d", " ")], "id string, label string")
    assert {r.id: r.gold_verdict for r in sampling.read_labels(rows).collect()} == {"a": "non_violation", "b": "violation", "c": None, "d": None}
    with pytest.raises(sampling.LabelError, match="unsaef"):
        sampling.read_labels(spark.createDataFrame([("a", "unsaef")], "id string, label string"))


def test_commands(spark, policy_file, tmp_path, capsys):
    def said(*words):
        capsys.readouterr()
        main([str(w) for w in words])
        return json.loads(capsys.readouterr().out)

    (tmp_path / "run.json").write_text(json.dumps({"policy_file": policy_file, "total": 6, "domain": "d", "model": "m", "max_prompts_per_call": 3, "run_id": "r1", "severity_ratio": {"low": 1, "high": 1}}))
    at = ("--config", tmp_path / "run.json")
    made = said("plan", *at, "--output", tmp_path / "asked")
    assert made["run_id"] == "r1" and made["counts"]["requested"] == 6
    with open(policy_file, "rb") as f:
        assert made["counts"]["policy_file_sha256"] == hashlib.sha256(f.read()).hexdigest() and made["counts"]["policies"]["B"]["version"] == "7"
    assert files.file_digest(spark, str(tmp_path / "none")) is None
    calls = [r.asDict() for r in spark.read.json(str(tmp_path / "asked")).collect()]
    (tmp_path / "calls.jsonl").write_text("\n".join(json.dumps({**{k: c[k] for k in ("call_idx", "policy_id", "severity", "model", "count")}, "ok": True, "content": json.dumps([f"{c['call_idx']}-{k}" for k in range(c["count"])])}) for c in calls))
    counts = said("records", *at, "--input", tmp_path / "calls.jsonl", "--output", tmp_path / "made")["counts"]
    assert counts["produced"] == 6 and counts["failures"] == 0 and counts["parse_strategy"] == {"json": len(calls)} and not (tmp_path / "made/failures").exists()
    said("ask", *at, "--input", tmp_path / "made/records", "--output", tmp_path / "shown")
    ids = sorted(r.id for r in spark.read.json(str(tmp_path / "shown")).collect())
    (tmp_path / "answers.jsonl").write_text("\n".join(json.dumps({"id": i, "ok": True, "content": json.dumps({"verdict": "non_violation", "matched_policy_id": None, "severity": None, "requires_external_context": False, "decision_summary": "s"})}) for i in ids))
    counts = said("judge", *at, "--input", tmp_path / "made/records", "--answers", tmp_path / "answers.jsonl", "--output", tmp_path / "judged")["counts"]
    assert counts == {"failures": 0, "destination": {"rejected": 6}, "verdict": {"non_violation": 6}, "judged_severity": {}}
    (tmp_path / "vectors.jsonl").write_text("\n".join(json.dumps({"id": i, "vector": [1.0, k % 2]}) for k, i in enumerate(ids)))
    counts = said("dedup", *at, "--input", tmp_path / "made/records", "--vectors", tmp_path / "vectors.jsonl", "--output", tmp_path / "kept")["counts"]
    assert counts["source_records"] == 6 and counts["retained"] + sum(len(r.duplicate_ids) for r in spark.read.json(str(tmp_path / "kept/duplicates")).collect()) == 6 and counts["clusters"] > 0


def test_records_files(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"id":"a","x":" "}\n\n{"id":"b"}\n', encoding="utf-8")
    rows = files.read_records(spark, str(tmp_path / "r.jsonl"), "id string, x string")
    one, two = files.write_records(rows, str(tmp_path / "o")), files.write_records(rows.repartition(3), str(tmp_path / "o2"))
    assert rows.count() == 2 and one == two
    for text in ("", '{"id":"a"}\n{"id":"a"}', "{"):
        (tmp_path / "bad.jsonl").write_text(text)
        with pytest.raises(files.SourceError):
            files.read_records(spark, str(tmp_path / "bad.jsonl"), "id string")
    (tmp_path / "d.jsonl").write_text('{"body":" t "}\nraw\n"s"\n{"z":1}')
    assert files.load_documents(spark, [str(tmp_path / "d.jsonl")]).first().text == 't\nraw\ns\n{"z": 1}'


def test_stream_counts_an_id_once(spark, tmp_path):
    from sievewright.streaming import ingest

    body = json.dumps({"verdict": "violation", "matched_policy_id": "p", "severity": "low", "requires_external_context": False, "decision_summary": "s"})
    schema = "id string, ts timestamp, violated_policy string, severity string, content string"
    spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS ts").selectExpr("explode(array('a', 'a', 'b')) AS id", "ts", "'p' AS violated_policy", "'low' AS severity", f"'{body}' AS content").write.parquet(str(tmp_path / "in"))
    stream = ingest.judged_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    assert sorted((r.id, r.destination) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", "accepted"), ("b", "accepted")]


class Answers:
    """A local endpoint that fails in a set order."""

    def __init__(self):
        import http.server
        import threading

        outer = self
        self.asked, self.codes = [], {}

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                outer.asked.append((self.path, self.headers["Authorization"], body))
                code, content = outer.codes.get(body["messages"][1]["content"], [(200, "said")]).pop(0)
                self.send_response(code)
                self.end_headers()
                self.wfile.write(json.dumps({"choices": [{"message": {"content": content}, "finish_reason": "stop"}], "usage": {"completion_tokens": 3}}).encode())

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/v1"


def test_completions_over_http(monkeypatch):
    monkeypatch.setenv("TEST_KEY", "k")
    at = Answers()
    ask = endpoints.Endpoint(at.url, "TEST_KEY", tries=3, pause=0.0, effort="high")
    at.codes = {"busy": [(429, ""), (500, ""), (200, " late ")], "bad": [(400, "")], "blank": [(200, " ")] * 3}
    assert ask("m", "s", "hi") == {"content": "said", "ok": True, "attempts": 1, "error": None, "finish_reason": "stop", "completion_tokens": 3}
    path, key, body = at.asked[0]
    assert path == "/v1/chat/completions" and key == "Bearer k" and body["model"] == "m" and body["reasoning_effort"] == "high" and [x["content"] for x in body["messages"]] == ["s", "hi"]
    got = [(r["ok"], r["attempts"], r["content"], r["error"]) for r in (ask("m", "s", x) for x in ("busy", "bad", "blank"))]
    assert got == [(True, 3, "late", None), (False, 1, "", "HTTP 400"), (False, 3, "", "the answer is blank")]
    at.server.shutdown()
    with pytest.raises(config.ConfigError, match="OTHER_KEY"):
        endpoints.Endpoint(at.url, "OTHER_KEY")("m", "s", "u")


def test_models_of_ones_own(spark, policy_file):
    run = config.from_mapping({"policy_file": policy_file, "total": 6, "domain": "d", "model": "m", "severity_ratio": {"low": 1}, "judge": {"temperature": 0.5}, "api_key_env": "K"})
    assert endpoints.Endpoint.of(run, judge=True) == endpoints.Endpoint("", "K", 0.5, 4096, 3, 300.0, "high")

    def complete(model, system, user):
        good = "Policy A" in user
        return {"content": json.dumps([f"{model} {k}" for k in range(5)]) if good else "", "ok": good, "attempts": 1, "error": None if good else "down", "finish_reason": None, "completion_tokens": 9 if good else None}

    asked = stages.requests(spark, run).withColumn("system", F.lit("s"))
    done = endpoints.completed(asked, complete, 2)
    assert sorted((r.policy_id, r.ok, r.completion_tokens) for r in done.collect()) == [("A", True, 9), ("B", False, None)]
    made, failed = stages.build_records(done.withColumn("count", F.col("count").cast("int")), run)
    assert made.count() == 3 and [r.error for r in failed.collect()] == ["down"]
    vectors = endpoints.embedded(made, lambda: lambda texts: [[len(t), 1] for t in texts], 2)
    assert {r.id: r.vector for r in vectors.collect()} == {r.id: [3.0, 1.0] for r in made.collect()}
    with pytest.raises(Exception, match="sentence-transformers"):
        endpoints.sentence_encoder("m")()


def test_a_failed_record_gives_its_place_to_the_next(spark, policy_file):
    run = config.from_mapping({"policy_file": policy_file, "domain": "d", "model": "m"})
    calls = [(0, "A", "odd", "m", 2, json.dumps(["a", "b"]), True, None, None), (1, "A", "low", "m", 2, json.dumps(["c", "c", "d", "e"]), True, None, None)]
    made, failed = stages.build_records(spark.createDataFrame(calls, CALLS), run)
    assert sorted(r.prompt for r in made.collect()) == ["c", "d"]
    assert [(r.stage, r.error) for r in failed.collect()] == [("validate", "severity out of range")] * 2
