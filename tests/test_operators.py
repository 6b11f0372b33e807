import json
import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewright.functions import scalars
from sievewright.operators import metrics, parsing, planning, sampling, similarity, triage
from sievewright.operators.graph import components
from sievewright.operators.workspace import Workspace


def apportioned(total, weights):
    """The rule by itself: floors, then one each by remainder, weight and order."""
    quota = [total * w for w in weights]
    out = [math.floor(q) for q in quota]
    order = sorted(range(len(weights)), key=lambda k: (-(quota[k] - out[k]), -weights[k], k))
    for k in order[: total - sum(out)]:
        out[k] += 1
    return out


def test_largest_remainder(spark):
    cases = [(t, w) for t in (1, 2, 3, 7, 10, 90, 91, 100, 999) for w in ((1 / 3,) * 3, (0.3, 0.4, 0.3), (0.7, 0.3), (0.2, 0.5, 0.3))]
    rows = [(i, k, t, x) for i, (t, w) in enumerate(cases) for k, x in enumerate(w)]
    df = spark.createDataFrame(rows, "case int, place int, total long, w double")
    got = planning.largest_remainder(df, F.col("total"), F.col("w"), ["case"], F.col("place")).orderBy("case", "place").collect()
    want = [n for t, w in cases for n in apportioned(t, w)]
    assert [r["count"] for r in got] == want
    assert all(sum(r["count"] for r in got if r.case == i) == t for i, (t, _) in enumerate(cases))


def test_plan_of_models_and_chunks(spark):
    cells = spark.createDataFrame([("a", 0, "low", 0, 7), ("b", 1, "low", 0, 3)], "policy_id string, ordinal int, severity string, level int, count long")
    plan = planning.plan_models(cells, [("x", 0.7), ("y", 0.3)])
    assert [(r.policy_id, r.model, r["count"]) for r in plan.orderBy("policy_id", "place").collect()] == [("a", "x", 5), ("a", "y", 2), ("b", "x", 2), ("b", "y", 1)]
    assert [r["count"] for r in planning.plan_chunks(plan.where("policy_id = 'a' AND model = 'x'"), 2).orderBy("chunk").collect()] == [2, 2, 1]


@pytest.mark.parametrize("bad", [{"low": -1}, {"low": float("nan")}, {"odd": 1}, {"low": 1, "minor": 1}, {"low": 0}, {"low": "1"}])
def test_bad_ratios(bad):
    with pytest.raises(planning.PlanError):
        planning.normalised_ratio(bad)
    assert planning.normalised_ratio({"Minor": 1, "L3": 3}) == {"low": 0.25, "medium": 0.0, "high": 0.75}


def test_strip_and_ids(spark):
    texts = ["　a \t", "\xa0b ", "", "\x1cc\x85", "d", "​ e"]
    got = [r.t for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", scalars.stripped(F.col("t")).alias("t")).orderBy("i").collect()]
    assert got == [t.strip() for t in texts]


@pytest.mark.parametrize(
    "raw, prompts, strategy",
    [
        ('{"prompts":[{"prompt":"a","reason":"r"},{"text":"b"}]}', ["a", "b"], "json"),
        ('["a"," ","b"]', ["a", "b"], "json"),
        ('x ```json\n{"prompt":"a"}\n``` y ```\n["b"]\n```', ["a"], "json_fence"),
        ('Sure {"問題":"甲"} ok', ["甲"], "json_embedded"),
        ('{"prompts":[{"prompt":"a"},{"prompt":"b","reason":"cut', ["a", "b"], "json_salvaged"),
        ('{"prompts":[{"prompt":"a"},{"prompt":"b cut', ["a"], "json_salvaged"),
        ("1. Prompt: a\nReason: r\n提問：b", ["a", "b"], "freeform"),
        ("[THINK]{}[/THINK] no", [], "none"),
        ("", [], "none"),
        (None, [], "none"),
        ('{"prompt": "a \\" } b"}', ['a " } b'], "json"),
        ("[" * 200_000, [], "none"),
        ('{"a":' * 3000 + '{"prompt":"deep"}', ["deep"], "json_salvaged"),
        ('{"prompt": "hi \\ud83d"}', ["hi \ufffd"], "json"),
        ('{"prompt": "hi \\ud83d\\ude00"}', ["hi \U0001f600"], "json"),
    ],
)
def test_replies(raw, prompts, strategy):
    entries, how, error = parsing.parsed_reply(raw)
    assert [p for p, _ in entries] == prompts and how == strategy and (error is None) == bool(prompts)


@given(st.lists(st.text(min_size=1).filter(lambda t: t.strip()), min_size=1, max_size=5), st.integers(0, 40))
def test_whole_objects_survive_a_cut(texts, cut):
    whole = "".join(json.dumps({"prompt": t}) + "," for t in texts)
    found = [p for p, _ in parsing.salvaged('{"prompts":[' + whole + '{"prompt":"' + "x" * cut)]
    assert found == list(dict.fromkeys(t.strip() for t in texts))


def test_objects_are_salvaged_from_within():
    found = parsing.salvaged('{"x":[{"prompt":"a"},{"y":{"prompt":"b"},"prompt":"c"}]} and {"prompt":"d"} {bad {"prompt":"e"} {"prompt":"a"}} {"z":{"prompt":"f"} {"text":"g')
    assert [p for p, _ in found] == ["a", "b", "c", "d", "e", "f"]


def test_one_odd_reply_fails_no_job(spark):
    raw = ["[" * 200_000, '{"prompt": "hi \\ud83d"}', "{" * 50_000 + "}" * 50_000, '["a"]', '{"verdict":"\\ud800"}', "\x00"]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    got = df.select(parsing.parse_reply("raw").alias("p"), parsing.parse_judgment("raw", F.lit("x")).alias("j")).collect()
    assert [len(r.p.prompts) for r in got] == [0, 1, 0, 1, 0, 0] and all(r.j.judge_error for r in got)


def test_judgments_are_strict():
    good = {"verdict": "violation", "matched_policy_id": "p", "severity": "low", "requires_external_context": False, "decision_summary": " s "}
    assert parsing.parsed_judgment(json.dumps(good), "p")["decision_summary"] == "s"
    for change in ({"verdict": "maybe"}, {"matched_policy_id": "q"}, {"severity": None}, {"requires_external_context": "false"}, {"decision_summary": " "}, {"verdict": "non_violation"}):
        assert set(parsing.parsed_judgment(json.dumps(good | change), "p")) == {"judge_error"}
    assert "judge_error" in parsing.parsed_judgment("<think>" + json.dumps(good), "q")


def test_metrics_by_hand(spark):
    gold = spark.createDataFrame([("a", "p", "violation", "low"), ("b", "p", "violation", "high"), ("c", "p", "non_violation", None), ("d", "p", "violation", "low")], "id string, policy_id string, gold_verdict string, gold_severity string")
    said = spark.createDataFrame([("a", "violation", "p", "low"), ("b", "non_violation", None, None), ("c", "violation", "p", "high")], "id string, verdict string, matched_policy_id string, judged_severity string")
    r = metrics.evaluation(metrics.scored(gold, said)).first()
    assert (r.coverage, r.missing, r.tp, r.fp, r.fn, r.tn, r.precision, r.recall, r.f1) == (0.75, 1, 1, 1, 1, 0, 0.5, 0.5, 0.5)
    assert metrics.evaluation(metrics.scored(gold.limit(0), said)).first().coverage is None
    pairs = lambda rows: metrics.weighted_kappa(spark.createDataFrame([(1, *r) for r in rows], "k int, x string, y string"), "x", "y", ["k"]).first().kappa
    assert pairs([("low", "low"), ("high", "high")]) == 1.0 and pairs([("low", "high"), ("high", "low")]) == -1.0 and pairs([("low", "low")]) is None


def test_every_record_goes_to_one_place(spark):
    rows = [(v, m, s, x, e) for v in ("violation", "non_violation", "ambiguous", None) for m in ("p", "q", None) for s in ("low", None) for x in (True, False, None) for e in ("api", None)]
    df = spark.createDataFrame([(i, "p", "low", *r) for i, r in enumerate(rows)], "id int, violated_policy string, severity string, verdict string, matched_policy_id string, judged_severity string, requires_external_context boolean, judge_error string")
    for r in triage.routed(triage.audited(df)).collect():
        want = "review" if r.judge_error else "accepted" if r.verdict == "violation" and r.matched_policy_id == "p" and not r.requires_external_context else "rejected" if r.verdict == "non_violation" else "review"
        assert r.destination == want and r.severity_match is not None


def test_clusters_and_cross_policy_pairs(spark):
    v = spark.createDataFrame([(1, "A", [1.0, 0.0]), (2, "A", [0.95, 0.05]), (3, "B", [1.0, 0.0])], "id long, policy string, vector array<double>")
    for tile in (1, 1024):
        pairs = similarity.similar_pairs(v, 0.9, tile)
        assert {(r.a, r.b) for r in pairs.collect()} == {(1, 2), (1, 3), (2, 3)}
        assert {(r.id, r.cluster) for r in similarity.policy_clusters(v, 0.9, Workspace(spark, "t"), tile).collect()} == {(1, 1), (2, 1)}
        assert {(r.a, r.b) for r in similarity.similar_pairs(v, 0.9, tile, across=True).collect()} == {(1, 3), (2, 3)}
    assert {(r.id, r.cluster) for r in similarity.clusters(pairs, Workspace(spark, "t")).collect()} == {(1, 1), (2, 1)}
    assert {(r.a, r.b) for r in similarity.cross_policy(pairs).collect()} == {(1, 3), (2, 3)}
    for bad in ([0.0, 0.0], [float("nan"), 1.0], [1.0], None):
        with pytest.raises(similarity.VectorError):
            similarity.check_vectors(v.unionByName(spark.createDataFrame([(4, "A", bad)], v.schema)))


def test_components_of_chains_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 100 + k) for k in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "t")).collect())
    assert got == {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "t")).count() == 0


def test_clusters_of_many_policies(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(k, f"p{k % 3}" if k % 3 else "big", (np.eye(8)[k % 8] + rng.normal(size=8) * 0.16).tolist()) for k in range(150)]
    v = spark.createDataFrame(rows, "id long, policy string, vector array<double>")
    want = {(r.id, r.cluster) for r in similarity.clusters(similarity.similar_pairs(v, 0.9), Workspace(spark, "t")).collect()}
    for tile in (7, 1024):
        assert {(r.id, r.cluster) for r in similarity.policy_clusters(v, 0.9, Workspace(spark, "t"), tile).collect()} == want
    assert len(want) > 50


def test_white_space_of_every_kind_is_cut(spark):
    from sievewright.operators import rendering

    docs = spark.createDataFrame([("n", "x" * 190 + " \t\n\u3000\u00a0" * 4 + "y" * 50, 0)], "name string, text string, ordinal int")
    assert rendering.context_sections(docs, 200).first().section == "--- n ---\n" + "x" * 190 + rendering.CUT


def test_levels_of_spellings():
    assert [scalars.level_word(x) for x in ("Low", "MODERATE", "Level_3", "level 2 / moderate", "  minor ", "critical/high", "unknown", "L-1", 3)] == ["low", "medium", "high", "medium", "low", "high", None, None, "high"]


def test_sample_is_fair(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") < 150, "p").otherwise("q").alias("violated_policy"), F.lit("v").alias("stratum"))
    got = [r.violated_policy for r in sampling.stratified(rows, 20).collect()]
    assert got.count("p") == got.count("q") == 10


def test_tiles_meet_without_a_shuffle(spark):
    rows = [(k, f"p{k % 2}", [1.0, k / 40]) for k in range(40)]
    v = spark.createDataFrame(rows, "id long, policy string, vector array<double>")
    for across in (False, True):
        pairs = similarity.similar_pairs(v, 0.999, tile=4, across=across)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Exchange" not in plan and "Generate" not in plan
        cosine = lambda x, y: (1 + x * y / 1600) / math.sqrt((1 + x * x / 1600) * (1 + y * y / 1600))
        want = {(a, b) for a in range(40) for b in range(a + 1, 40) if cosine(a, b) >= 0.999 and not (across and (b - a) % 2 == 0)}
        got = pairs.collect()
        assert {(r.a, r.b) for r in got} == want and len(got) == len(want)
        assert all((r.policy_a, r.policy_b) == (f"p{r.a % 2}", f"p{r.b % 2}") for r in got)


def test_packed_tiles_hold_each_row_once(spark):
    v = spark.range(300).select("id", F.lit("p").alias("policy"), F.array(F.lit(1.0), F.col("id") / 300).alias("vector"), F.lit(0).cast("long").alias("unit"), F.lit(30).alias("tiles"))
    tiles = similarity._tile_pairs(v, Workspace(spark, "t"), False).collect()
    assert 10 < len(tiles) <= 30 and sum(len(r.policies) for r in tiles) == 300 and all(r.ids2 is None for r in tiles)


def test_links_are_cut_to_a_forest():
    import numpy as np

    links = [np.array([[5, 9, 9, 7], [9, 5, 9, 100]]), np.array([[100, 3], [7, 4]])]
    assert sorted(zip(*similarity._forest(links).tolist())) == [(4, 3), (9, 5), (100, 7)]
    assert similarity._forest([]).shape == (2, 0)
