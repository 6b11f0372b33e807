"""Checks of a policy catalog: what is missing, thin or repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import LEVELS, blank
from .rendering import examples_for

LEAST, PARTS, ALIKE = 3, 3, 0.15


def _alike(examples: Column) -> Column:
    def twin(a: Column) -> Column:
        return F.size(F.filter(examples, lambda b: F.levenshtein(a, b) <= ALIKE * F.greatest(F.length(a), F.length(b)))) > 1

    return F.exists(examples, twin)


def lint(policies: DataFrame) -> DataFrame:
    """(policy_id, kind, finding) over all policies; a cell without examples is an error, thin ones are warnings.

    Sub-categories are what a rule lists between semicolons; examples of a cell are alike if few edits part them.
    """
    found = []
    for c in ("policy_id", "policy"):
        found.append(("error", blank(F.col(c)), f"no {c}"))
    for level in LEVELS:
        examples = examples_for(F.lit(level))
        few = F.size(examples)
        found += [("error", few == 0, f"cell {level}: no example"), ("warning", (few > 0) & (few < LEAST), f"cell {level}: under {LEAST} examples")]
        found.append(("warning", blank(F.col("severity_text")[level]), f"cell {level}: no wording"))
        found.append(("warning", _alike(examples), f"cell {level}: examples alike"))
    found += [("warning", F.size("allowed_examples") == 0, "no allowed examples"), ("warning", F.size("definitions") == 0, "no definitions"), ("warning", F.size(F.split("policy", ";")) > PARTS, f"over {PARTS} sub-categories")]
    made = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(kind).alias("kind"), F.lit(text).alias("finding"))) for kind, cond, text in found]))
    return policies.select("policy_id", F.explode(made).alias("f")).select("policy_id", "f.kind", "f.finding")
