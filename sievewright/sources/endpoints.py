"""Connectors to models: completions over HTTP, and vectors from an encoder. Both take any callable in their place.

A call runs in a task, one at a time, so that as many calls as partitions are under way at most. Answers cost time or
money; they are written as they come in, to the shared folder, and read from there.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.workspace import Workspace
from .config import ConfigError, Judge, Run

ANSWER = "content string, ok boolean, attempts int, error string, finish_reason string, completion_tokens int"
#: (model, system, user) to a mapping with the fields of ANSWER.
Complete = Callable[[str, str, str], dict]
Encode = Callable[[list[str]], list[list[float]]]


@dataclass(frozen=True)
class Endpoint:
    """Chat completions at a base URL. The key is read from its variable where the call is made; no plan holds it."""

    base_url: str
    key_variable: str
    temperature: float = 1.0
    max_tokens: int = 4096
    tries: int = 3
    timeout: float = 300.0
    effort: str | None = None
    #: Seconds to wait before the next try, times the number of tries so far; more if the endpoint is busy.
    pause: float = 5.0

    @staticmethod
    def of(run: Run, judge: bool = False) -> "Endpoint":
        settings: Run | Judge = run.judge if judge else run
        return Endpoint(settings.base_url, settings.api_key_env, settings.temperature, settings.max_tokens, settings.max_retries, settings.timeout, run.judge.reasoning_effort if judge else None)

    def _post(self, model: str, system: str, user: str) -> dict:
        body = {"model": model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}], "temperature": self.temperature, "max_tokens": self.max_tokens}
        if self.effort:
            body["reasoning_effort"] = self.effort
        head = {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ[self.key_variable]}"}
        asked = urllib.request.Request(self.base_url.rstrip("/") + "/chat/completions", json.dumps(body).encode(), head)
        with urllib.request.urlopen(asked, timeout=self.timeout) as reply:
            return json.load(reply)

    def __call__(self, model: str, system: str, user: str) -> dict:
        """An answer in any case; one that failed tells why. Errors of the request itself aren't tried again."""
        if not os.environ.get(self.key_variable, "").strip():
            raise ConfigError(f"the variable {self.key_variable} holds no key")
        failed, tried = "no try was allowed", 0
        while tried < self.tries:
            tried, wait = tried + 1, self.pause
            try:
                got = self._post(model, system, user)
                choice = got["choices"][0]
                content = (choice["message"].get("content") or "").strip()
                if content:
                    return {"content": content, "ok": True, "attempts": tried, "error": None, "finish_reason": choice.get("finish_reason"), "completion_tokens": (got.get("usage") or {}).get("completion_tokens")}
                failed = "the answer is blank"
            except urllib.error.HTTPError as error:
                failed = f"HTTP {error.code}"
                if error.code == 429:
                    wait *= 2
                elif 400 <= error.code < 500:
                    break
            except Exception as error:  # noqa: BLE001  one call must not end a run
                failed = f"{type(error).__name__}: {error}"
            if tried < self.tries:
                time.sleep(wait * tried)
        return {"content": "", "ok": False, "attempts": tried, "error": failed, "finish_reason": None, "completion_tokens": None}


def completed(requests: DataFrame, complete: Complete, concurrency: int, user: str = "user") -> DataFrame:
    """requests, which have model, system and a column with what the user says, with the fields of ANSWER."""
    schema = StructType([*requests.schema.fields, *StructType.fromDDL(ANSWER).fields])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = pd.DataFrame([complete(m, s, u) for m, s, u in zip(batch["model"], batch["system"], batch[user])], index=batch.index, columns=[f.name for f in schema.fields[len(batch.columns) :]])
            yield pd.concat([batch, made.astype({"completion_tokens": "Int32", "attempts": "Int32"})], axis=1)

    return Workspace(requests.sparkSession, "completions").save(requests.repartition(concurrency).mapInPandas(rows, schema), "answers")


def embedded(records: DataFrame, encoder: Callable[[], Encode], batch_size: int = 16) -> DataFrame:
    """(id, vector) of (id, prompt); encoder makes the function that encodes texts, once in a task."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for batch in batches:
            for at in range(0, len(batch), batch_size):
                some = batch.iloc[at : at + batch_size]
                yield pd.DataFrame({"id": some["id"], "vector": [[float(x) for x in v] for v in encode(some["prompt"].tolist())]})

    named = records.select(F.col("id").cast("string").alias("id"), "prompt")
    return Workspace(records.sparkSession, "vectors").save(named.mapInPandas(rows, "id string, vector array<double>"), "vectors")


def sentence_encoder(model: str, batch_size: int = 16) -> Callable[[], Encode]:
    """An encoder of the sentence-transformers library, which is asked for where it is used."""

    def make() -> Encode:
        try:
            from sentence_transformers import SentenceTransformer
        except ImportError as error:
            raise ConfigError("vectors need the sentence-transformers library on the workers, or an encoder of your own") from error
        held = SentenceTransformer(model)
        return lambda texts: held.encode(texts, batch_size=batch_size, normalize_embeddings=True).tolist()

    return make
