"""The registered queries, each over whole tables, and the SQL of those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ALIASES, blank, hash_order, severity_level, stripped
from ..operators import metrics, parsing, planning, records, rendering, sampling, similarity, triage
from ..operators.workspace import Workspace
from . import views

TOTAL, MODELS, CHUNK, SIMILAR = 1000, [("m1", 0.7), ("m2", 0.3)], 5, 0.35
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


_LABELS = ["Low", "MODERATE", "Level_3", "level 2 / moderate", "  minor ", "critical/high", "unknown", "L-1"]
_MEANT = ["low", "medium", "high", "medium", "low", "high", None, None]


@_query("SELECT p_partkey, CASE p_partkey % 8 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(_MEANT) if x) + " END AS level FROM part")
def severity_normalise(spark, sf):
    """Levels of labels in many spellings."""
    label = F.element_at(F.array(*map(F.lit, _LABELS)), (F.col("p_partkey") % 8 + 1).cast("int"))
    return views.table(spark, sf, "part").select("p_partkey", severity_level(label).alias("level"))


@_query(f"WITH {views.RECORDS} SELECT doc_id, id FROM records")
def stable_ids(spark, sf):
    """Content ids of all prompts."""
    return views.records(spark, sf).select("doc_id", "id")


@_query(f"WITH {views.RECORDS} SELECT id, min(doc_id) AS doc_id FROM records GROUP BY id")
def exact_dedup_first(spark, sf):
    """The first record of each content id."""
    return similarity.first_of_each(views.records(spark, sf).select("id", "doc_id"), "id", ["doc_id"])


_BLANK = f"coalesce({views.stripped_sql('text')}, '') = ''"


@_query(f"""SELECT doc_id, CAST({_BLANK} AS INT) + CAST(doc_id % 6 = 0 AS INT) + CAST(doc_id % 4 = 0 AS INT) AS n_problems,
  ({_BLANK} OR doc_id % 6 = 0 OR doc_id % 4 = 0) AS failed FROM documents""")
def record_validation(spark, sf):
    """Problems of records, of which some are given a blank field or an unknown level."""
    return _validated(spark, sf).select("doc_id", F.size("p").alias("n_problems"), (F.size("p") > 0).alias("failed"))


def _validated(spark, sf):
    d = views.table(spark, sf, "documents").select("doc_id", F.concat(F.lit("r"), "doc_id").alias("id"), F.col("text").alias("prompt"), F.coalesce("lang", F.lit("x")).alias("violated_policy"), F.when(F.col("doc_id") % 4 == 0, "extreme").otherwise("low").alias("severity"), F.when(F.col("doc_id") % 6 == 0, " \t").otherwise("d").alias("domain"), F.lit("why").alias("generation_rationale"))
    return d.withColumn("p", triage.record_problems())


_POLICIES = "policies AS (SELECT n_name AS policy_id, n_nationkey AS ordinal FROM nation)"


def _shared(parent: str, order: str, source: str, columns: str) -> str:
    """Largest remainder of total * w within parent, in SQL."""
    part = f"PARTITION BY {parent} " if parent else ""
    return f"""(SELECT {columns}, floor(q)::BIGINT + CASE WHEN row_number() OVER ({part}ORDER BY q - floor(q) DESC, w DESC, {order}) <= total - sum(floor(q)::BIGINT) OVER ({part.strip()}) THEN 1 ELSE 0 END AS n
  FROM (SELECT *, total::DOUBLE * w AS q FROM {source}))"""


_BY_POLICY = f"{_POLICIES}, weighed AS (SELECT *, {TOTAL}::BIGINT AS total, 1::DOUBLE / count(*) OVER () AS w FROM policies), by_policy AS {_shared('', 'ordinal', 'weighed', 'policy_id, ordinal')}"
_LEVELS = "levels(level, severity, w) AS (VALUES (0, 'low', 0.3::DOUBLE), (1, 'medium', 0.4::DOUBLE), (2, 'high', 0.3::DOUBLE))"
_CELLS = f"{_BY_POLICY}, {_LEVELS}, spread AS (SELECT policy_id, ordinal, n AS total, level, severity, w FROM by_policy, levels), cells AS (SELECT * FROM {_shared('policy_id', 'level', 'spread', 'policy_id, ordinal, level, severity')} WHERE n > 0)"
_BY_MODEL = f"{_CELLS}, models(place, model, w) AS (VALUES (0, 'm1', 0.7::DOUBLE), (1, 'm2', 0.3::DOUBLE)), mixed AS (SELECT policy_id, level, severity, n AS total, place, model, w FROM cells, models), by_model AS (SELECT * FROM {_shared('policy_id, severity', 'place', 'mixed', 'policy_id, severity, model')} WHERE n > 0)"


def _cells(spark, sf):
    return planning.plan_cells(views.policies(spark, sf).select("policy_id", "ordinal"), TOTAL)


@_query(f"WITH {_BY_POLICY} SELECT policy_id, n AS count FROM by_policy")
def plan_policies(spark, sf):
    """A total over policies."""
    return planning.plan_policies(views.policies(spark, sf).select("policy_id", "ordinal"), TOTAL).select("policy_id", "count")


@_query(f"WITH {_CELLS} SELECT policy_id, severity, n AS count FROM cells")
def plan_cells(spark, sf):
    """A total over policies and severities."""
    return _cells(spark, sf).select("policy_id", "severity", "count")


@_query(f"WITH {_BY_MODEL} SELECT policy_id, severity, model, n AS count FROM by_model")
def plan_models(spark, sf):
    """Each cell over models."""
    return planning.plan_models(_cells(spark, sf), MODELS).select("policy_id", "severity", "model", "count")


@_query(f"WITH {_BY_MODEL} SELECT policy_id, severity, model, k::INT AS chunk, least({CHUNK}, n - k * {CHUNK}) AS count FROM (SELECT *, unnest(range((n + {CHUNK - 1}) // {CHUNK})) AS k FROM by_model)")
def plan_chunks(spark, sf):
    """Requests of at most five prompts."""
    return planning.plan_chunks(planning.plan_models(_cells(spark, sf), MODELS), CHUNK).select("policy_id", "severity", "model", "chunk", "count")


@_query(f"""WITH {_CELLS} SELECT coalesce(policy_id, 'TOTAL') AS policy_id, sum(CASE WHEN severity = 'low' THEN n ELSE 0 END)::BIGINT AS low, sum(CASE WHEN severity = 'medium' THEN n ELSE 0 END)::BIGINT AS medium,
  sum(CASE WHEN severity = 'high' THEN n ELSE 0 END)::BIGINT AS high, sum(n)::BIGINT AS total FROM cells GROUP BY ROLLUP (policy_id)""")
def plan_summary(spark, sf):
    """The plan as a table of policies by severity, with totals."""
    return planning.plan_summary(_cells(spark, sf))


@_query("SELECT n_name AS policy_id, severity, 5::BIGINT AS count FROM nation, (VALUES ('low'), ('medium'), ('high')) AS v(severity)")
def pilot_plan(spark, sf):
    """Five prompts for every cell."""
    return planning.pilot_plan(views.policies(spark, sf))


@_query(rf"""WITH shared AS (SELECT item_id, text, greatest(200, 6000 // count(*) OVER ())::INT AS share FROM benchmark)
SELECT item_id, '--- b' || item_id || E' ---\n' || CASE WHEN length(text) > share THEN {views.right_stripped_sql('substr(text, 1, share)')} || E'\n…(truncated)' ELSE text END AS section FROM shared""")
def aux_context_sections(spark, sf):
    """Auxiliary texts cut to an even share of a budget."""
    b = views.table(spark, sf, "benchmark").select("item_id", F.concat(F.lit("b"), "item_id").alias("name"), "text", F.col("item_id").alias("ordinal"))
    return rendering.context_sections(b, 6000).select("item_id", "section")


@_query(rf"""WITH shared AS (SELECT item_id, text, greatest(200, 6000 // count(*) OVER ())::INT AS share FROM benchmark)
SELECT count(*)::INT AS n_documents, sha256(string_agg('--- b' || item_id || E' ---\n' || CASE WHEN length(text) > share THEN {views.right_stripped_sql('substr(text, 1, share)')} || E'\n…(truncated)' ELSE text END, E'\n\n' ORDER BY item_id)) AS digest FROM shared""")
def aux_context_block(spark, sf):
    """The block of all auxiliary texts, by its digest."""
    b = views.table(spark, sf, "benchmark").select(F.concat(F.lit("b"), "item_id").alias("name"), "text", F.col("item_id").alias("ordinal"))
    return rendering.context_block(b, 6000).select("n_documents", F.sha2("block", 256).alias("digest"))


@_query(rf"""WITH {_CELLS} SELECT policy_id, severity, '[Policy ' || policy_id || E']\nRule of ' || policy_id || E'\n' || E'\n[Severity ' || severity || E']\n' || severity || ' in ' || policy_id
  || E'\n\n[Scale]\n- low: low in ' || policy_id || E'\n- medium: medium in ' || policy_id || E'\n- high: high in ' || policy_id || E'\n'
  || CASE WHEN ordinal % 3 <> 0 OR severity = 'high' THEN E'\n[Examples]\n- ' || policy_id || E' one\n- ' || policy_id || E' two\n' ELSE '' END
  || CASE WHEN ordinal % 2 = 0 THEN E'\n[Not violations]\n- ' || policy_id || E' is fine\n' ELSE '' END || E'\nWrite ' || n || ' prompts for banking.' AS user_message FROM cells""")
def render_requests(spark, sf):
    """The request of each cell."""
    return rendering.rendered(_cells(spark, sf), views.policies(spark, sf), " banking ").select("policy_id", "severity", F.col("user").alias("user_message"))


@_query(r"""SELECT c_custkey, sha256(E'<policy>\nPOLICY ID\n' || n_name || E'\n\nPOLICY VERSION\nv' || n_nationkey || E'\n\nRULE\nRule of ' || n_name || E'\n\nDEFINITIONS\n' || CASE WHEN n_nationkey % 4 = 0 THEN E'- a: first\n- b: second' ELSE '- none' END
  || E'\n\nVIOLATIONS\n- ' || n_name || E' one\n- ' || n_name || E' two\n\nALLOWED\n' || CASE WHEN n_nationkey % 2 = 0 THEN '- ' || n_name || ' is fine' ELSE '- none' END
  || E'\n\nSEVERITY\n- low: low in ' || n_name || E'\n- medium: medium in ' || n_name || E'\n- high: high in ' || n_name || E'\n</policy>\n\n<candidate>\n' || c_name || E'\n</candidate>') AS digest
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def judge_messages(spark, sf):
    """What the judge is shown, by its digest."""
    names = views.table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("violated_policy"))
    c = views.table(spark, sf, "customer").join(F.broadcast(names), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("prompt"), "violated_policy")
    return rendering.judge_requests(c, views.policies(spark, sf)).select(F.col("id").alias("c_custkey"), F.sha2("judge_user", 256).alias("digest"))


_AUDIT = (
    views.JUDGED
    + """, audited AS (SELECT *, coalesce(verdict = 'violation', false) AND matched_policy_id IS NOT DISTINCT FROM violated_policy AS policy_match, coalesce(judged_severity = severity, false) AS severity_match FROM judged),
accepted AS (SELECT *, policy_match AND NOT coalesce(requires_external_context, false) AS accepted FROM audited),
routed AS (SELECT *, CASE WHEN judge_error IS NOT NULL THEN 'review' WHEN accepted THEN 'accepted' WHEN verdict = 'non_violation' THEN 'rejected' ELSE 'review' END AS destination FROM accepted)"""
)


def _routed(spark, sf):
    return triage.routed(triage.audited(views.judged(spark, sf)))


@_query(f"WITH {_AUDIT} SELECT doc_id, policy_match, severity_match, accepted FROM accepted")
def audit_flags(spark, sf):
    """Claims checked against verdicts."""
    return triage.audited(views.judged(spark, sf)).select("doc_id", "policy_match", "severity_match", "accepted")


@_query(f"WITH {_AUDIT} SELECT doc_id, policy_match AND severity_match AND NOT coalesce(requires_external_context, false) AS accepted FROM accepted")
def audit_severity_gate(spark, sf):
    """Acceptance with severities that must agree."""
    return triage.audited(views.judged(spark, sf), severity_gate=True).select("doc_id", "accepted")


@_query(f"WITH {_AUDIT} SELECT doc_id, destination FROM routed")
def triage_partition(spark, sf):
    """Where each record goes."""
    return _routed(spark, sf).select("doc_id", "destination")


@_query(f"WITH {_AUDIT} SELECT violated_policy, count(*) AS n, count(*) FILTER (destination = 'accepted') AS accepted, count(*) FILTER (destination = 'rejected') AS rejected, count(*) FILTER (destination = 'review') AS review, count(*) FILTER (destination = 'accepted')::DOUBLE / count(*) AS yield FROM routed GROUP BY 1")
def triage_yield(spark, sf):
    """Destinations by policy, and the share that is accepted."""
    sums = _routed(spark, sf).groupBy("violated_policy").agg(F.count("*").alias("n"), *[F.count_if(F.col("destination") == x).alias(x) for x in ("accepted", "rejected", "review")])
    return sums.withColumn("yield", F.col("accepted").cast("double") / F.col("n"))


@_query(f"WITH {views.JUDGED} SELECT verdict, judged_severity, count(*) AS n FROM judged WHERE judge_error IS NULL GROUP BY GROUPING SETS ((verdict), (judged_severity))")
def judge_histograms(spark, sf):
    """Readable answers by verdict, and by severity."""
    j = views.judged(spark, sf).where("judge_error IS NULL")
    return j.groupingSets([["verdict"], ["judged_severity"]], "verdict", "judged_severity").agg(F.count("*").alias("n")).select("verdict", "judged_severity", "n")


@_query(f"""WITH {views.RECORDS}, r AS (SELECT severity, coalesce(violated_policy, '-') AS p, coalesce(model, '-') AS m FROM records)
SELECT 'severity' AS kind, severity AS value, count(*) AS n FROM r GROUP BY severity UNION ALL SELECT 'policy', p, count(*) FROM r GROUP BY p UNION ALL SELECT 'model', m, count(*) FROM r GROUP BY m""")
def generation_counts(spark, sf):
    """Records by severity, policy and model, in one pass."""
    r = views.records(spark, sf).select("severity", F.coalesce("violated_policy", F.lit("-")).alias("violated_policy"), F.coalesce("model", F.lit("-")).alias("model"))
    return records.generation_counts(r)


@_query("""SELECT CASE doc_id % 5 WHEN 0 THEN 'json' WHEN 1 THEN 'json_fence' WHEN 2 THEN 'json_embedded' WHEN 3 THEN 'json_salvaged' ELSE 'freeform' END AS strategy, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1""")
def parse_strategy_histogram(spark, sf):
    """How many replies each strategy of the parser reads."""
    return views.replies(spark, sf).select(parsing.parse_reply("raw").strategy.alias("strategy")).groupBy("strategy").agg(F.count("*").alias("n"))


@_query(rf"""SELECT doc_id, 1 AS n_prompts, md5({views.stripped_sql("CASE WHEN doc_id % 5 = 4 THEN 'p' || regexp_replace(text, '[\r\n]', ' ', 'g') ELSE text END")}) AS digest FROM documents WHERE text IS NOT NULL""")
def parse_cascade(spark, sf):
    """Prompts that the parser recovers from untidy replies."""
    p = views.replies(spark, sf, rest="json").select("doc_id", "shape", parsing.parse_reply("raw").alias("p"))
    prompt = F.get("p.prompts", F.lit(0))["prompt"]
    text = F.when(F.col("shape") == "freeform", views.unescaped(prompt)).otherwise(stripped(F.substring(prompt, 2, 2**31 - 1)))  # without the p of replies
    return p.select("doc_id", F.size("p.prompts").alias("n_prompts"), F.md5(text).alias("digest"))


@_query("""SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN NULL WHEN doc_id % 4 = 0 THEN 'violation' WHEN doc_id % 4 = 1 THEN 'non_violation' ELSE 'ambiguous' END AS verdict,
  CASE WHEN doc_id % 4 = 0 THEN lang END AS matched_policy_id, doc_id % 4 = 3 AS failed FROM documents WHERE lang IS NOT NULL""")
def judge_parse(spark, sf):
    """Judges' replies read strictly; a text in place of a boolean is an error."""
    k = F.col("doc_id") % 4
    body = F.when(k == 0, F.concat(F.lit('<think>hm</think>{"verdict":"violation","matched_policy_id":"'), "lang", F.lit('","severity":"low","requires_external_context":false,"decision_summary":"s"}')))
    body = body.when(k == 1, '```json\n{"verdict":"non_violation","matched_policy_id":null,"severity":null,"requires_external_context":true,"decision_summary":"s"}\n```')
    body = body.when(k == 2, 'So: {"verdict":"ambiguous","requires_external_context":false,"decision_summary":"s"} done').otherwise('{"verdict":"ambiguous","requires_external_context":"false","decision_summary":"s"}')
    d = views.table(spark, sf, "documents").where("lang IS NOT NULL").select("doc_id", parsing.parse_judgment(body, F.col("lang")).alias("j"))
    return d.select("doc_id", "j.verdict", "j.matched_policy_id", F.col("j.judge_error").isNotNull().alias("failed"))


#: Each policy's entries one after the other: what is left of the call's quota, and the ids kept so far.
_QUOTA = f"""WITH RECURSIVE {views.RECORDS}, e AS (SELECT violated_policy AS policy_id, doc_id // 7 AS call_idx, (doc_id % 7)::INT AS pos, id, {_BLANK.replace('text', 'prompt')} OR severity = 'high' AND doc_id % 3 = 0 AS bad,
  row_number() OVER (PARTITION BY violated_policy ORDER BY doc_id // 7, doc_id % 7) AS rn FROM records WHERE prompt IS NOT NULL AND violated_policy IS NOT NULL),
fold AS (SELECT DISTINCT policy_id, 0::BIGINT AS rn, NULL::BIGINT AS call_idx, NULL::INT AS pos, NULL::VARCHAR AS id, 0 AS quota, false AS told, false AS kept, []::VARCHAR[] AS seen FROM e
  UNION ALL SELECT policy_id, rn, call_idx, pos, id, quota - kept::INT, told, kept, CASE WHEN kept THEN list_append(seen, id) ELSE seen END
  FROM (SELECT *, quota > 0 AND NOT bad AND NOT list_contains(seen, id) AS kept, quota > 0 AND (bad OR NOT list_contains(seen, id)) AS told
    FROM (SELECT e.*, f.seen, CASE WHEN e.call_idx = f.call_idx THEN f.quota ELSE 5 END AS quota FROM fold f JOIN e ON e.policy_id = f.policy_id AND e.rn = f.rn + 1)))"""


def _folded(spark, sf):
    r = views.records(spark, sf).where("prompt IS NOT NULL AND violated_policy IS NOT NULL")
    bad = F.array_compact(F.array(F.when(blank(F.col("prompt")), "missing prompt"), F.when((F.col("severity") == "high") & (F.col("doc_id") % 3 == 0), "unfit")))
    return records.quota_told(r.select(F.col("violated_policy").alias("policy_id"), F.floor(F.col("doc_id") / 7).alias("call_idx"), (F.col("doc_id") % 7).cast("int").alias("pos"), F.lit(5).alias("quota"), "prompt", bad.alias("problems")))


@_query(f"{_QUOTA} SELECT policy_id, call_idx, pos, id, kept FROM fold WHERE told")
def quota_trim_backfill(spark, sf):
    """Each call's quota of new prompts, and the unfit ones that it met; a fold in order of calls."""
    return _folded(spark, sf)


@_query(f"""WITH {views.JUDGED} SELECT 'api' AS stage, doc_id, violated_policy, NULL AS response_chars, NULL::VARCHAR AS problem FROM judged WHERE judge_error = 'api'
UNION ALL SELECT 'parse', j.doc_id, j.violated_policy, n_chars, NULL FROM judged j JOIN documents USING (doc_id) WHERE judge_error = 'parse'
UNION ALL SELECT 'validate', doc_id, coalesce(lang, 'x'), NULL, unnest([x FOR x IN [CASE WHEN {_BLANK} THEN 'missing prompt' END, CASE WHEN doc_id % 6 = 0 THEN 'missing domain' END, CASE WHEN doc_id % 4 = 0 THEN 'severity out of range' END] IF x IS NOT NULL]) FROM documents""")
def failure_union(spark, sf):
    """Failures of three stages in one table; those of validation are what is found in all records."""
    j = views.judged(spark, sf)
    sizes = views.table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("response_chars"))
    parse = j.where("judge_error = 'parse'").select("doc_id", "violated_policy").join(sizes, "doc_id")
    wrong = _validated(spark, sf).select("doc_id", "violated_policy", F.explode("p").alias("problem"))
    out = triage.failures(j.where("judge_error = 'api'").select("doc_id", "violated_policy"), parse, wrong)
    return out.select("stage", "doc_id", "violated_policy", "response_chars", "problem")


_PAIRS = f"{views.JUDGED}, {views.GOLD}, pairs AS (SELECT g.*, lang AS policy_id, verdict, matched_policy_id, judged_severity, verdict IS NOT NULL AS covered FROM gold g LEFT JOIN judged j USING (doc_id) LEFT JOIN (SELECT doc_id, lang FROM documents) USING (doc_id))"
_RATES = """count(*) AS n_gold, count(*) FILTER (covered) AS n_covered, count(*) FILTER (NOT covered) AS missing, count(*) FILTER (covered)::DOUBLE / count(*) AS coverage,
  count(*) FILTER (g AND v) AS tp, count(*) FILTER (NOT g AND v) AS fp, count(*) FILTER (covered AND g AND NOT v) AS fn, count(*) FILTER (covered AND NOT g AND NOT v) AS tn,
  count(*) FILTER (s) AS severity_pairs, count(*) FILTER (covered AND g AND matched_policy_id = policy_id)::DOUBLE / nullif(count(*) FILTER (covered AND g), 0) AS policy_match_accuracy,
  count(*) FILTER (s AND gold_severity = judged_severity)::DOUBLE / nullif(count(*) FILTER (s), 0) AS severity_exact_accuracy"""
_FLAGS = "flags AS (SELECT *, gold_verdict = 'violation' AS g, coalesce(verdict = 'violation', false) AS v, covered AND gold_verdict = 'violation' AND gold_severity IS NOT NULL AND judged_severity IS NOT NULL AS s FROM pairs)"
_F = "CASE WHEN precision + recall = 0 THEN 0 ELSE {b1} * precision * recall / ({b} * precision + recall) END"


def _pairs(spark, sf):
    names = views.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("policy_id"))
    return metrics.scored(views.gold(spark, sf), views.judged(spark, sf), "doc_id").join(names, "doc_id", "left")


_SCORES = f"WITH {_PAIRS}, {_FLAGS}, sums AS (SELECT {{by}}{_RATES} FROM flags{{group}}), rates AS (SELECT *, tp::DOUBLE / nullif(tp + fp, 0) AS precision, tp::DOUBLE / nullif(tp + fn, 0) AS recall FROM sums) SELECT *, {_F.format(b1='2.0', b='1.0')} AS f1, {_F.format(b1='5.0', b='4.0')} AS f2 FROM rates"


@_query(_SCORES.replace("{by}", "").replace("{group}", ""))
def evaluation_metrics(spark, sf):
    """Confusion counts, coverage, precision, recall, F1, F2 and agreement on policy and severity."""
    return metrics.evaluation(_pairs(spark, sf))


@_query(_SCORES.replace("{by}", "policy_id, ").replace("{group}", " GROUP BY policy_id"))
def evaluation_by_policy(spark, sf):
    """The same by policy."""
    return metrics.evaluation(_pairs(spark, sf), ["policy_id"])


_KAPPA = """, o AS (SELECT {p} AS p, CASE gold_severity WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS x, CASE judged_severity WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS y FROM pairs WHERE gold_severity IS NOT NULL AND judged_severity IS NOT NULL),
n AS (SELECT p, count(*) AS n, sum(abs(x - y))::DOUBLE / 2.0::DOUBLE / count(*) AS seen FROM o GROUP BY p), mx AS (SELECT p, x, count(*) AS c FROM o GROUP BY p, x), my AS (SELECT p, y, count(*) AS c FROM o GROUP BY p, y),
e AS (SELECT mx.p, sum(mx.c * my.c * abs(x - y))::DOUBLE / 2.0::DOUBLE AS e FROM mx JOIN my ON mx.p IS NOT DISTINCT FROM my.p GROUP BY mx.p)
SELECT n.p AS policy_id, n AS n_pairs, CASE WHEN n >= 2 AND e > 0 THEN 1 - seen / (e / (n * n)) END AS kappa FROM n JOIN e ON n.p IS NOT DISTINCT FROM e.p"""


@_query(f"WITH {_PAIRS}" + _KAPPA.format(p="policy_id"))
def kappa_by_policy(spark, sf):
    """Weighted agreement on severity by policy."""
    return metrics.weighted_kappa(_pairs(spark, sf), "gold_severity", "judged_severity", ["policy_id"])


@_query(f"WITH {_PAIRS}" + _KAPPA.format(p="'all'"))
def weighted_kappa(spark, sf):
    """Weighted agreement on severity."""
    return metrics.weighted_kappa(_pairs(spark, sf).withColumn("policy_id", F.lit("all")), "gold_severity", "judged_severity", ["policy_id"])


@_query(f"WITH {views.JUDGED} SELECT violated_policy, severity, " + ", ".join(f"count(*) FILTER (judged_severity = '{x}') AS judged_{x}" for x in ("low", "medium", "high")) + " FROM judged WHERE judged_severity IS NOT NULL GROUP BY 1, 2")
def severity_contingency(spark, sf):
    """Claimed by judged severities of each policy."""
    return metrics.contingency(views.judged(spark, sf), "severity", "judged_severity", "violated_policy")


_BLAMED = f"{_PAIRS}, blamed AS (SELECT policy_id, CASE WHEN gold_verdict <> 'violation' THEN CASE WHEN coalesce(verdict, '') = 'violation' THEN 'both_wrong' ELSE 'generator_wrong' END WHEN coalesce(verdict, '') <> 'violation' THEN 'judge_wrong' WHEN gold_severity <> judged_severity THEN 'severity_disagreement' ELSE 'both_right' END AS blame FROM pairs)"


@_query(f"WITH {_BLAMED} SELECT policy_id, " + ", ".join(f"count(*) FILTER (blame = '{x}') AS {x}" for x in triage.BLAMES) + " FROM blamed GROUP BY policy_id")
def blame_breakdown(spark, sf):
    """Who was wrong, by policy."""
    b = _pairs(spark, sf).withColumn("blame", triage.blame())
    return b.groupBy("policy_id").agg(*[F.count_if(F.col("blame") == x).alias(x) for x in triage.BLAMES])


_EDGES = f"""v AS (SELECT vec_id AS id, label::VARCHAR AS policy, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings),
edges AS (SELECT x.id AS a, y.id AS b, x.policy AS policy_a, y.policy AS policy_b, list_dot_product(x.e, y.e) / (x.n * y.n) AS similarity FROM v x JOIN v y ON x.id < y.id WHERE list_dot_product(x.e, y.e) / (x.n * y.n) >= {SIMILAR})"""
_REACH = f"""{_EDGES}, links AS (SELECT a, b FROM edges WHERE policy_a = policy_b UNION SELECT b, a FROM edges WHERE policy_a = policy_b),
reach(id, c) AS (SELECT a, a FROM links UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id), members AS (SELECT id, min(c) AS cluster FROM reach GROUP BY id)"""


def _edges(spark, sf):
    return similarity.similar_pairs(views.vectors(spark, sf), SIMILAR)


def _clusters(spark, sf):
    return similarity.policy_clusters(views.vectors(spark, sf), SIMILAR, Workspace(spark, "clusters"))


def _duplicates(spark, sf):
    scored = views.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.rpad(F.lit("x"), (F.col("vec_id") % 5 + 1).cast("int"), F.lit("x")).alias("prompt"), F.when(F.col("vec_id") % 3 != 0, (F.col("vec_id") % 4).cast("double")).alias("score"))
    return similarity.duplicates(_clusters(spark, sf).join(scored, "id"))


_CHOSEN = f"""{_REACH}, ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY CASE WHEN id % 3 <> 0 THEN id % 4 END DESC NULLS LAST, id % 5, id) AS r FROM members)"""


@_query(f"WITH {_EDGES} SELECT a, b, round(similarity, 6) AS similarity FROM edges")
def near_dup_edges(spark, sf):
    """All pairs of similar vectors."""
    return _edges(spark, sf).select("a", "b", F.round("similarity", 6).alias("similarity"))


@_query(f"WITH {_EDGES} SELECT a, b, array_to_string(list_sort([policy_a, policy_b]), ',') AS policies FROM edges WHERE policy_a <> policy_b")
def cross_policy_audit(spark, sf):
    """Similar pairs of different policies."""
    return similarity.cross_policy(similarity.similar_pairs(views.vectors(spark, sf), SIMILAR, across=True)).select("a", "b", F.array_join("policies", ",").alias("policies"))


@_query(f"WITH RECURSIVE {_REACH} SELECT id, cluster FROM members")
def dup_clusters(spark, sf):
    """Clusters of similar records within policies."""
    return _clusters(spark, sf)


@_query(f"WITH RECURSIVE {_CHOSEN} SELECT cluster, min(id) FILTER (r = 1) AS representative_id, string_agg(id::VARCHAR, ',' ORDER BY id) FILTER (r > 1) AS duplicates FROM ranked GROUP BY cluster")
def representatives(spark, sf):
    """Which record of each cluster stays."""
    return similarity.representatives(_duplicates(spark, sf)).select("cluster", "representative_id", F.array_join(F.col("duplicate_ids").cast("array<string>"), ",").alias("duplicates"))


@_query(f"WITH RECURSIVE {_CHOSEN} SELECT label::VARCHAR AS policy, count(*) AS n FROM embeddings WHERE vec_id NOT IN (SELECT id FROM ranked WHERE r > 1) GROUP BY 1")
def deduped(spark, sf):
    """Records by policy that remain."""
    return similarity.retained(views.vectors(spark, sf).select("id", "policy"), _duplicates(spark, sf)).groupBy("policy").agg(F.count("*").alias("n"))


@_query(f"""WITH {views.JUDGED}, s AS (SELECT doc_id, violated_policy, coalesce(verdict, 'unjudged') AS stratum FROM judged), r AS (SELECT *, row_number() OVER (PARTITION BY violated_policy, stratum ORDER BY md5('42:' || doc_id), doc_id) AS turn FROM s)
SELECT doc_id, violated_policy, stratum FROM (SELECT * FROM r ORDER BY turn, violated_policy, stratum LIMIT 50)""")
def stratified_sheet(spark, sf):
    """A sample of 50 for labelling, fair to policies and verdicts."""
    rows = views.judged(spark, sf).select("doc_id", "violated_policy", F.coalesce("verdict", F.lit("unjudged")).alias("stratum"))
    return sampling.stratified(rows, 50, 42, key="doc_id")


def _runs(spark, sf):
    """Three runs of a judge, of which the later sometimes change their mind."""
    j = views.judged(spark, sf).select("doc_id", "verdict")
    return j.withColumn("run", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn("verdict", F.when((F.col("run") > 0) & ((F.col("doc_id") + F.col("run")) % 7 == 0), "violation").otherwise(F.col("verdict")))


_RUNS = f"{views.JUDGED}, runs AS (SELECT doc_id, run, CASE WHEN run > 0 AND (doc_id + run) % 7 = 0 THEN 'violation' ELSE verdict END AS verdict FROM judged, (VALUES (0), (1), (2)) AS t(run))"


@_query(f"WITH {_RUNS} SELECT doc_id, count(*) AS n_runs, count(*) FILTER (verdict = 'violation') AS n_violation, 2 * count(*) FILTER (verdict = 'violation') > count(*) AS majority, count(*) FILTER (verdict = 'violation') > 0 AS any_of, count(DISTINCT coalesce(verdict, '')) = 1 AS stable FROM runs GROUP BY doc_id")
def verdict_votes(spark, sf):
    """Majority, any, and stability over runs."""
    return metrics.votes(_runs(spark, sf), "doc_id")


@_query(f"WITH {_RUNS}, v AS (SELECT count(DISTINCT coalesce(verdict, '')) > 1 AS u FROM runs GROUP BY doc_id) SELECT count(*) FILTER (u) AS unstable, count(*) AS n, count(*) FILTER (u)::DOUBLE / count(*) AS rate FROM v")
def verdict_instability(spark, sf):
    """How many records' verdicts change from run to run."""
    v = metrics.votes(_runs(spark, sf), "doc_id").agg(F.count_if(~F.col("stable")).alias("unstable"), F.count("*").alias("n"))
    return v.withColumn("rate", F.col("unstable").cast("double") / F.col("n"))


@_query(f"WITH {_RUNS}, p AS (SELECT doc_id, max(verdict) FILTER (run = 0) AS a, max(verdict) FILTER (run = 1) AS b FROM runs GROUP BY doc_id) SELECT count(*) FILTER (a = 'violation') AS first, count(*) FILTER (b = 'violation') AS second, count(*) FILTER (a = 'violation' AND b = 'violation') AS both, count(*) FILTER (a = 'violation' OR b = 'violation') AS either, count(*) FILTER (a IS NULL AND b = 'violation') AS settled FROM p")
def judge_cascade(spark, sf):
    """What two judges find, alone and together."""
    r = _runs(spark, sf)
    return metrics.cascade(r.where("run = 0"), r.where("run = 1"), "doc_id")


@_query("""WITH s AS (SELECT source, avg(quality::DOUBLE) AS share, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE source IS NOT NULL GROUP BY source), p AS (SELECT source, count(*) AS size FROM documents GROUP BY source)
SELECT sum(n)::BIGINT AS n_sample, sum(size)::BIGINT AS n_population, round(sum(share * size) / sum(size)::DOUBLE, 9) AS estimate FROM s JOIN p USING (source)""")
def stratified_estimate(spark, sf):
    """Share of good documents, from the labelled ones of each source."""
    d = views.table(spark, sf, "documents").select("doc_id", "source")
    out = metrics.weighted_estimate(d.join(views.table(spark, sf, "labels"), "doc_id").where("source IS NOT NULL"), d, "source", "quality")
    return out.withColumn("estimate", F.round("estimate", 9))


@_query(f"WITH {views.GOLD} SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY gold_verdict, gold_severity ORDER BY md5('7:' || doc_id)) % 2 = 1 THEN 'tune' ELSE 'confirm' END AS split FROM gold")
def tune_confirm_split(spark, sf):
    """Labels in two halves, by strata."""
    return metrics.tune_confirm(views.gold(spark, sf), ["gold_verdict", "gold_severity"], hash_order(7, F.col("doc_id"))).select("doc_id", "split")


_GATE = f"""{_AUDIT}, c AS (SELECT violated_policy AS policy_id, severity, count(*) AS produced, count(*) FILTER (judge_error = 'api') AS failed, count(*) FILTER (judge_error IS NOT NULL) AS judge_failed, count(*) FILTER (accepted) AS accepted FROM accepted GROUP BY 1, 2),
s AS (SELECT sum(produced) AS produced, sum(failed) AS failed, sum(judge_failed) AS judge_failed, sum(accepted) AS accepted FROM c),
g AS (SELECT concat_ws('/', policy_id, severity) AS scope, 'cell_yield' AS name, accepted::DOUBLE / produced AS value, accepted::DOUBLE / produced >= 0.25 AS passed FROM c
UNION ALL SELECT 'all', 'overall_yield', accepted::DOUBLE / produced, accepted::DOUBLE / produced >= 0.4 FROM s UNION ALL SELECT 'all', 'generation_failures', failed::DOUBLE / (produced + failed), failed::DOUBLE / (produced + failed) <= 0.1 FROM s
UNION ALL SELECT 'all', 'judge_failures', judge_failed::DOUBLE / produced, judge_failed::DOUBLE / produced <= 0.1 FROM s UNION ALL SELECT 'all', 'produced_share', produced::DOUBLE / (produced + failed), produced::DOUBLE / (produced + failed) >= 0.9 FROM s)"""


@_query(f"WITH {_GATE} SELECT scope, name, value, passed FROM g")
def yield_gate(spark, sf):
    """Whether a run's yields and failures pass."""
    cells = triage.audited(views.judged(spark, sf)).groupBy(F.col("violated_policy").alias("policy_id"), "severity").agg(F.count("*").alias("produced"), F.count_if(F.col("judge_error") == "api").alias("failed"), F.count_if(F.col("judge_error").isNotNull()).alias("judge_failed"), F.count_if("accepted").alias("accepted"))
    return metrics.yield_gate(cells.withColumn("requested", F.col("produced") + F.col("failed")).withColumn("judged", F.col("produced")))


@_query("""SELECT * FROM (SELECT n_name AS policy_id, unnest([CASE WHEN n_nationkey % 3 = 0 THEN 'cell low: no example' END, CASE WHEN n_nationkey % 3 = 0 THEN 'cell medium: no example' END, CASE WHEN n_nationkey % 3 <> 0 THEN 'cell low: under 3 examples' END,
  CASE WHEN n_nationkey % 3 <> 0 THEN 'cell medium: under 3 examples' END, 'cell high: under 3 examples', CASE WHEN n_nationkey % 2 <> 0 THEN 'no allowed examples' END, CASE WHEN n_nationkey % 4 <> 0 THEN 'no definitions' END]) AS finding FROM nation) WHERE finding IS NOT NULL""")
def policy_lint(spark, sf):
    """Findings of the catalog's check."""
    from ..operators.lint import lint

    return lint(views.policies(spark, sf)).select("policy_id", "finding")


@_query(f"WITH {views.RECORDS}, l AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'high' WHEN 2 THEN 'worst' END AS s FROM records WHERE doc_id % 3 <> 0) SELECT doc_id, CASE WHEN s IN ('low', 'high') THEN s END AS relabelled_severity, CASE WHEN s IN ('low', 'high') THEN 'ok' ELSE 'failed' END AS severity_relabel_status FROM records LEFT JOIN l USING (doc_id)")
def severity_relabel(spark, sf):
    """Severities given anew, where the answer is a level."""
    d = views.table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    k = F.col("id") % 4
    labels = d.where("id % 3 <> 0").withColumn("relabelled_severity", F.when(k == 0, "low").when(k == 1, "high").when(k == 2, "worst"))
    return triage.relabelled(d, labels).withColumnRenamed("id", "doc_id")


@_query(f"WITH {_AUDIT}, {views.GOLD}, ok AS (SELECT DISTINCT violated_policy, substr(md5(text), 1, 12) AS prompt FROM routed JOIN gold USING (doc_id) JOIN (SELECT doc_id, text FROM documents) USING (doc_id) WHERE destination = 'rejected' AND gold_verdict = 'non_violation') SELECT violated_policy AS policy_id, string_agg(prompt, ',' ORDER BY prompt) AS allowed FROM ok GROUP BY 1")
def allowed_feedback(spark, sf):
    """Rejected prompts that humans confirm, as allowed examples."""
    texts = views.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.substring(F.md5("text"), 1, 12).alias("prompt"))
    rejected = _routed(spark, sf).where("destination = 'rejected'").select(F.col("doc_id").alias("id"), "violated_policy").join(texts, "id")
    out = triage.allowed_from_review(rejected, views.gold(spark, sf).withColumnRenamed("doc_id", "id"))
    return out.select("policy_id", F.array_join("allowed_examples", ",").alias("allowed"))


@_query(f"""WITH {views.RECORDS} SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS row, violated_policy, severity, md5(prompt) AS digest FROM records SEMI JOIN labels USING (doc_id)""")
def blind_sheet(spark, sf):
    """A blind sheet of the labelled records and its key, joined again."""
    labelled = views.table(spark, sf, "labels").select("doc_id").distinct()
    rows = views.records(spark, sf).join(labelled, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "prompt", "violated_policy", "severity")
    sheet, key = sampling.blind_sheet(rows)
    return key.join(sheet, "row").select(F.col("id").alias("doc_id"), F.col("row").cast("long").alias("row"), "violated_policy", "severity", F.md5("prompt").alias("digest"))


@_query(f"""WITH {views.JUDGED}, plan AS (SELECT violated_policy AS policy_id, severity, count(*) AS requested FROM judged GROUP BY 1, 2),
made AS (SELECT violated_policy AS policy_id, severity, count(*) FILTER (judge_error IS NULL) AS produced, 3 * count(*) FILTER (judge_error = 'api') + count(*) FILTER (judge_error = 'parse') AS failed FROM judged GROUP BY 1, 2)
SELECT p.policy_id, p.severity, requested, produced, failed FROM plan p JOIN made m ON p.policy_id IS NOT DISTINCT FROM m.policy_id AND p.severity = m.severity""")
def cell_report(spark, sf):
    """What was asked for, made and lost in each cell; a lost call counts for the three prompts it asked for."""
    j = views.judged(spark, sf)
    plan = j.groupBy(F.col("violated_policy").alias("policy_id"), "severity").agg(F.count("*").alias("count"))
    lost = j.where("judge_error IS NOT NULL").select(F.col("violated_policy").alias("policy_id"), "severity", F.when(F.col("judge_error") == "api", 3).alias("requested"))
    return metrics.cell_report(plan, j.where("judge_error IS NULL"), lost)


@_query(f"WITH {views.RECORDS}, {views.GOLD}, t AS (SELECT violated_policy AS policy_id, severity, gold_verdict FROM gold JOIN records USING (doc_id)) SELECT policy_id, severity, count(*) AS n, count(*) FILTER (gold_verdict = 'violation') AS unsafe, count(*) FILTER (gold_verdict = 'violation')::DOUBLE / count(*) AS share FROM t GROUP BY 1, 2")
def calibration_shares(spark, sf):
    """Share of each cell that human labels, written in several ways, call unsafe."""
    g = views.gold(spark, sf).select("doc_id", F.when(F.col("gold_verdict") == "violation", F.when(F.col("doc_id") % 2 == 0, " Unsafe").otherwise("u")).otherwise(F.when(F.col("doc_id") % 2 == 0, "SAFE ").otherwise("s")).alias("label"))
    cells = views.records(spark, sf).select("doc_id", F.col("violated_policy").alias("policy_id"), "severity")
    return metrics.unsafe_share(sampling.read_labels(g).join(cells, "doc_id"), ["policy_id", "severity"])
