"""Column functions on strings and numbers, all evaluated in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Python's str.strip removes.
SPACE = r"[\t-\r\x1c-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
LEVELS = ("low", "medium", "high")
# Spellings of the levels, in the order in which compound labels look for them.
ALIASES = {
    "low": "low", "minor": "low", "l1": "low", "level 1": "low", "1": "low",
    "medium": "medium", "moderate": "medium", "mid": "medium", "l2": "medium", "level 2": "medium", "2": "medium",
    "high": "high", "severe": "high", "critical": "high", "l3": "high", "level 3": "high", "3": "high",
}


def stripped(text: Column) -> Column:
    """Without white space at either end, as Unicode has it."""
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def right_stripped(text: Column) -> Column:
    """Without white space at the end."""
    return F.regexp_replace(text, rf"{SPACE}+\z", "")


def blank(text: Column) -> Column:
    """Null, empty or white space alone."""
    return F.coalesce(stripped(text.cast("string")), F.lit("")) == ""


def level_word(label: object) -> str | None:
    """The level that a spelling stands for, if it is a known one; parts between slashes count too."""
    words = re.sub(r"[\s_-]+", " ", str(label).lower()).strip()
    named = [words, *re.split(" / ", words), *words.split("/")]
    return ALIASES.get(words) or next((ALIASES[x] for x in ALIASES if x in named), None)


def severity_level(label: Column) -> Column:
    """low, medium or high for any known spelling, also as a part of a label cut at slashes; null for others."""
    key = F.regexp_replace(F.regexp_replace(F.lower(stripped(label)), "[_-]", " "), rf"{SPACE}+", " ")
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    parts = F.array_union(F.split(key, " / "), F.split(key, "/"))
    first = F.get(F.filter(F.array(*map(F.lit, ALIASES)), lambda a: F.array_contains(parts, a)), F.lit(0))
    return F.coalesce(F.try_element_at(known, key), F.try_element_at(known, first))


def severity_ordinal(level: Column) -> Column:
    return F.when(level == "low", 0).when(level == "medium", 1).when(level == "high", 2)


def content_id(policy: Column, prompt: Column) -> Column:
    """Stable id of a prompt under a policy."""
    return F.concat(F.lit("hp_"), F.substring(F.sha2(F.concat(policy, F.lit("\0"), stripped(prompt)), 256), 1, 16))


def ratio(part: Column, whole: Column) -> Column:
    """Null where there is nothing to divide by."""
    return F.try_divide(part.cast("double"), F.nullif(whole, F.lit(0)).cast("double"))


def f_score(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    """0 if both are 0, null if either is."""
    b = beta * beta
    return F.when(precision + recall == 0, F.lit(0.0)).otherwise((1 + b) * precision * recall / (b * precision + recall))


def hash_order(seed: int | str, *keys: Column) -> Column:
    """A portable random order: hexadecimal digest of the seed and the keys."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))
