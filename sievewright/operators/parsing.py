"""Recovering prompts and verdicts from untidy replies, as vectorised functions over Arrow batches.

Replies need a state machine for nested brackets and strings, and Python's own idea of JSON, which built-in functions
don't share; so these two run in Python, a batch at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks, labels and keys that replies use.
THINKING = re.compile(r"(?is)\[THINK\].*?\[/THINK\]")
JUDGE_THINKING = re.compile(r"(?is)<think>.*?</think>|\[THINK\].*?\[/THINK\]")
FENCED = re.compile(r"(?is)```(?:json)?\s*(.*?)```")
PROMPT_LINE = re.compile(r"(?im)^\s*(?:\d+[.、)]\s*)?(?:問題|提問|prompt|question)\s*[:：]\s*(.+)$")
REASON_LINE = re.compile(r"(?im)^\s*(?:理由|原因|說明|rationale|reason)\s*[:：]\s*(.+)$")
PROMPT_NAMES = ("prompt", "問題", "text", "content", "question")
REASON_NAMES = ("generation_rationale", "rationale", "reason", "理由", "說明")
WRAPPERS = ("prompts", "data", "results", "items", "output")
VERDICTS = ("violation", "non_violation", "ambiguous")
LEVELS = ("low", "medium", "high")

_EVENTS = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
Entry = tuple[str, str]


def _brackets(text: str, start: int = 0) -> Iterator[tuple[int, str]]:
    """Brackets outside strings, with their places; a backslash takes the character after it along."""
    quoted = False
    for m in _EVENTS.finditer(text, start):
        if m[0] == '"':
            quoted = not quoted
        elif not quoted and len(m[0]) == 1:
            yield m.start(), m[0]


def first_balanced(text: str, pair: str) -> str | None:
    """From the first opening bracket of the pair to where it closes."""
    start, open_now = text.find(pair[0]), 0
    if start < 0:
        return None
    for at, mark in _brackets(text, start):
        open_now += (mark == pair[0]) - (mark == pair[1])
        if mark == pair[1] and not open_now:
            return text[start : at + 1]
    return None


_LONE = re.compile("[\ud800-\udfff]")


def _whole(text: str) -> str:
    """Halves of surrogate pairs joined, lone ones replaced, as no column can hold them."""
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if _LONE.search(text) else text


def _loaded(text: str) -> Any:
    """The JSON value of a text; none if it isn't JSON or is nested deeper than Python reads."""
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def _named(item: dict, names: tuple[str, ...]) -> str:
    return _whole(next((v.strip() for v in map(item.get, names) if isinstance(v, str) and v.strip()), ""))


def as_entry(item: Any) -> Entry | None:
    """(prompt, rationale) of a string or an object; none without a prompt."""
    if isinstance(item, str):
        item = {"prompt": item}
    prompt = _named(item, PROMPT_NAMES) if isinstance(item, dict) else ""
    return (prompt, _named(item, REASON_NAMES)) if prompt else None


def as_entries(value: Any) -> list[Entry]:
    """Of a list, an object that wraps one, or a single object."""
    if isinstance(value, dict):
        value = next((v for v in map(value.get, WRAPPERS) if isinstance(v, list)), [value])
    return [e for e in map(as_entry, value) if e] if isinstance(value, list) else []


def _closed_objects(text: str, start: int, end: int) -> list[dict] | None:
    """All objects of the JSON value from start to end, in order of their closing brackets; none if it isn't one."""
    found: list[dict] = []

    def keep(pairs: list[tuple[str, Any]]) -> dict:
        found.append(dict(pairs))
        return found[-1]

    try:
        return found if json.JSONDecoder(object_pairs_hook=keep).raw_decode(text, start)[1] == end else None
    except (ValueError, RecursionError):
        return None


def salvaged(text: str) -> list[Entry]:
    """Of a reply that was cut off: objects that close, at any depth, and a whole prompt of the last open one.

    Spans are parsed from the outermost inwards, so that one that reads as a whole is read once.
    """
    opened: list[tuple[int, list]] = [(-1, [])]  # places of open brackets, each with the spans that closed within
    for at, mark in _brackets(text):
        if mark == "{":
            opened.append((at, []))
        elif mark == "}" and len(opened) > 1:
            start, within = opened.pop()
            opened[-1][1].append((start, at + 1, within))
    found: dict[str, Entry] = {}
    waiting = [span for _, within in reversed(opened) for span in reversed(within)]
    while waiting:
        start, end, within = waiting.pop()
        objects = _closed_objects(text, start, end)
        if objects is None:
            waiting += reversed(within)
        for entry in filter(None, map(as_entry, objects or ())):
            found.setdefault(entry[0], entry)
    if len(opened) > 1:
        cut = text[opened[-1][0] :]
        whole = (re.search(rf'"{name}"\s*:\s*("(?:[^"\\]|\\.)*")', cut) for name in PROMPT_NAMES)
        first = next((m for m in whole if m), None)
        if first and (entry := as_entry(_loaded(first[1]))):
            found.setdefault(entry[0], entry)
    return list(found.values())


def labelled(text: str) -> list[Entry]:
    """Of lines with labels; the n-th reason belongs to the n-th prompt."""
    reasons = [m[1].strip() for m in REASON_LINE.finditer(text)]
    prompts = [m[1].strip() for m in PROMPT_LINE.finditer(text)]
    return [(p, reasons[k] if k < len(reasons) else "") for k, p in enumerate(prompts) if p]


def parsed_reply(raw: str | None) -> tuple[list[Entry], str, str | None]:
    """(entries, strategy, error) of the first strategy that finds any."""
    if not (raw or "").strip():
        return [], "none", "the reply is blank"
    text = THINKING.sub("", raw)
    steps = [
        ("json", lambda: as_entries(_loaded(text))),
        ("json_fence", lambda: next(filter(None, (as_entries(_loaded(x.strip())) for x in FENCED.findall(text))), [])),
        ("json_embedded", lambda: next(filter(None, (as_entries(_loaded(span)) for pair in ("{}", "[]") if (span := first_balanced(text, pair)))), [])),
        ("json_salvaged", lambda: salvaged(text)),
        ("freeform", lambda: labelled(text)),
    ]
    for name, step in steps:
        if entries := step():
            return entries, name, None
    return [], "none", f"no strategy found a prompt in {len(text)} characters: {text[:120]!r}"


#: Findings on a judge's object, each with what must hold of it and of the policy that was judged.
RULES: list[tuple[str, Callable[[dict, str], bool]]] = [
    ("policy isn't the judged one", lambda got, policy: got.get("verdict") != "violation" or got.get("matched_policy_id") == policy),
    ("policy without a violation", lambda got, _: got.get("verdict") == "violation" or got.get("matched_policy_id") is None),
    ("severity isn't a level", lambda got, _: got.get("verdict") != "violation" or isinstance(got.get("severity"), str) and got["severity"] in LEVELS),
    ("severity without a violation", lambda got, _: got.get("verdict") == "violation" or got.get("severity") is None),
    ("context isn't a boolean", lambda got, _: isinstance(got.get("requires_external_context"), bool)),
    ("summary is blank", lambda got, _: isinstance(got.get("decision_summary"), str) and bool(got["decision_summary"].strip())),
    ("verdict is unknown", lambda got, _: isinstance(got.get("verdict"), str) and got["verdict"] in VERDICTS),
]


def parsed_judgment(raw: str | None, expected: str) -> dict[str, Any]:
    """The judge's object, or judge_error alone: all findings of RULES, or that there is no object."""
    text = JUDGE_THINKING.sub("", raw or "").strip()
    fence = FENCED.search(text)
    tries = (text, fence[1].strip() if fence else "", first_balanced(text, "{}") or "")
    got = next((v for v in map(_loaded, filter(None, tries)) if isinstance(v, dict)), None)
    if got is None:
        return {"judge_error": "the reply holds no object"}
    findings = [finding for finding, holds in RULES if not holds(got, expected)]
    if findings:
        return {"judge_error": "; ".join(findings)}
    summary = _whole(got["decision_summary"].strip())
    return {"verdict": got["verdict"], "matched_policy_id": got.get("matched_policy_id"), "judged_severity": got.get("severity"), "requires_external_context": got["requires_external_context"], "decision_summary": summary}


def _replies(raw: pd.Series) -> pd.DataFrame:
    rows = [parsed_reply(x) for x in raw]
    made = [[{"prompt": p, "generation_rationale": r} for p, r in entries] for entries, _, _ in rows]
    return pd.DataFrame({"prompts": made, "strategy": [r[1] for r in rows], "error": [r[2] for r in rows]})


_JUDGED = ("verdict", "matched_policy_id", "judged_severity", "requires_external_context", "decision_summary", "judge_error")


def _judgments(raw: pd.Series, expected: pd.Series) -> pd.DataFrame:
    rows = [parsed_judgment(x, y) for x, y in zip(raw, expected)]
    return pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in _JUDGED})


def parse_reply(raw: Column | str) -> Column:
    """(prompts, strategy, error) of a reply."""
    return F.pandas_udf(_replies, "prompts array<struct<prompt:string,generation_rationale:string>>, strategy string, error string")(raw)


def parse_judgment(raw: Column | str, expected: Column | str) -> Column:
    """(verdict, matched_policy_id, judged_severity, requires_external_context, decision_summary, judge_error) of a judge's reply."""
    kind = ", ".join(f"{c} {'boolean' if c == 'requires_external_context' else 'string'}" for c in _JUDGED)
    return F.pandas_udf(_judgments, kind)(raw, expected)
