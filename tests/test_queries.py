"""Every registered query against its SQL, and the entry."""

import pytest
from conftest import DATA, plain

import __spark_entry__
from sievewright.operators import parsing, records
from sievewright.plans import registry, views


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, duck, name):
    assert plain(registry.QUERIES[name](spark, DATA).toPandas()) == plain(duck.execute(registry.SQL[name]).df())


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_quota_fold_matches_python(spark):
    rows = sorted((r.lang, r.doc_id // 7, r.doc_id % 7, r.text.strip(), r.n_chars >= 4000 and r.doc_id % 3 == 0) for r in spark.read.parquet(f"{DATA}/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL").collect())
    seen, left, want = set(), {}, set()
    for lang, call, pos, text, unfit in rows:
        if not left.setdefault((lang, call), 5):
            continue
        if unfit or not text:
            want.add((lang, call, pos, False))
        elif (lang, text) not in seen:
            seen.add((lang, text))
            left[lang, call] -= 1
            want.add((lang, call, pos, True))
    assert {(r.policy_id, r.call_idx, r.pos, r.kept) for r in registry.quota_trim_backfill(spark, DATA).collect()} == want


def test_quota_fold_of_many_repeats(spark):
    import random

    rng = random.Random(1)
    rows = [(rng.choice("pq"), call, pos, 3, rng.choice(["a", "b", "c", "d", f"x{rng.randrange(30)}", " "]), ["bad"] if rng.random() < 0.1 else []) for call in range(80) for pos in range(rng.randrange(7))]
    seen, left, want = set(), {}, set()
    for p, call, pos, quota, prompt, bad in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if left.setdefault((p, call), quota) and (bad or (p, prompt.strip()) not in seen):
            want.add((p, call, pos, not bad))
            if not bad:
                seen.add((p, prompt.strip()))
                left[p, call] -= 1
    df = spark.createDataFrame(rows, "policy_id string, call_idx long, pos int, quota int, prompt string, problems array<string>")
    got = records.quota_folded(df).collect()
    assert {(r.policy_id, r.call_idx, r.pos, r.kept) for r in got} == want and len(got) == len(want)
    assert all(r.prompt.strip() for r in records.quota_trimmed(df.drop("problems")).collect())


def test_labelled_replies_hold_whole_texts(spark):
    d = views.replies(spark, DATA).where("shape = 'freeform'").select("text", parsing.parse_reply("raw").alias("p")).collect()
    want = [("p" + r.text.replace("\r", " ").replace("\n", " ")).strip() for r in d]
    assert max(map(len, want)) > 10_000 and all(r.p.strategy == "freeform" for r in d)
    assert [[(e.prompt, e.generation_rationale) for e in r.p.prompts] for r in d] == [[(w, "why")] for w in want]


def odd_documents(tmp_path, texts):
    """A folder of documents in which every text comes with each number modulo 5, and with one below 0."""
    import duckdb

    rows = [(10 * k + s, t, "en", len(t or "")) for k, t in enumerate(texts) for s in (0, 1, 2, 3, 4, -1000)]
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?, ?)", rows)
    con.execute(f"COPY d TO '{tmp_path}/documents.parquet'")
    con.execute("ALTER TABLE d RENAME TO documents")
    return con


@pytest.mark.parametrize("name", ["parse_cascade", "parse_strategy_histogram"])
def test_replies_of_odd_texts_are_parsed(spark, tmp_path, name):
    con = odd_documents(tmp_path, ["", " \t", "　x\n y\x85", "```\nx\n``` y", ' "q" \\ {x} [1] }', "a [/THINK] b", None])
    assert plain(registry.QUERIES[name](spark, str(tmp_path)).toPandas()) == plain(con.execute(registry.SQL[name]).df())


MARKED = ['a {"prompt": "y"} b', 'see ["x", "y"]', '```json\n["x"]\n``` y', "a [THINK]b[/THINK] c", "[think]", 'cut {"text": "z", "q', r'\u005b \u005c \\ {\"prompt\": 1} \\[', "x \\", "Prompt: y\r\nReason: z"]


@pytest.mark.parametrize("name", ["parse_cascade", "parse_strategy_histogram"])
def test_replies_of_marked_texts_are_parsed(spark, tmp_path, name):
    con = odd_documents(tmp_path, MARKED)
    assert plain(registry.QUERIES[name](spark, str(tmp_path)).toPandas()) == plain(con.execute(registry.SQL[name]).df())


def test_marks_within_json_replies_stay(spark, tmp_path):
    odd_documents(tmp_path, ["a [THINK]b[/THINK] c", '```["x"]``` {"prompt": "y"}'])
    for r in views.replies(spark, str(tmp_path)).where("shape != 'freeform'").select("text", "shape", parsing.parse_reply("raw").alias("p")).collect():
        assert r.p.strategy == r.shape and [e.prompt for e in r.p.prompts] == ["p" + r.text]


def test_quota_fold_leaves_prompts_behind(spark):
    rows = [("p", call, pos, 2, f"{'long ' * 200}{(call + pos) % 4}", []) for call in range(9) for pos in range(4)]
    df = spark.createDataFrame(rows, "policy_id string, call_idx long, pos int, quota int, prompt string, problems array<string>")
    plan = records.quota_told(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line or "MapInPandas" in line or "RepartitionByExpression" in line]
    assert len(windows) >= 4 and not any("prompt" in line for line in windows)
    told = {(r.policy_id, r.call_idx, r.pos, r.id, r.kept) for r in records.quota_told(df).collect()}
    assert told == {(r.policy_id, r.call_idx, r.pos, r.id, r.kept) for r in records.quota_folded(df).collect()} and len(told) == 4


def test_quota_fold_of_rows_that_share_a_place(spark):
    rows = [("p", 0, 0, 5, "a", []), ("p", 0, 0, 5, "a", []), ("p", 0, 0, 5, " a", []), ("p", 0, 1, 5, None, ["x"]), ("p", 1, 0, 5, "b", []), ("p", 1, 0, 5, "b ", ["x"])]
    df = spark.createDataFrame(rows, "policy_id string, call_idx long, pos int, quota int, prompt string, problems array<string>")
    got = records.quota_folded(df).collect()
    assert sorted((r.call_idx, r.pos, r.kept) for r in got) == [(0, 0, True), (0, 1, False), (1, 0, False), (1, 0, True)]
    assert {r.prompt for r in got if r.call_idx == 1 and r.kept} == {"b"} and {r.prompt for r in got if r.call_idx == 1 and not r.kept} == {"b "}
