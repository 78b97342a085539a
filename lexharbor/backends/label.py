"""Labelling backends: a chat gateway, a local model server, and offline rules."""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from . import BackendError, make_backend

# Attempts, attempts at a rate limit, and seconds of one request.
RETRIES, RATE_RETRIES, TIMEOUT_S = 3, 8, 60


def without_fence(text: str) -> str:
    """A reply without the code fence around it."""
    s = text.strip()
    fenced = re.fullmatch(r"```[^\n]*\n(.*?)(?:```)?", s, re.DOTALL)
    return (fenced[1] if fenced else s).strip()


@dataclass
class _Chat:
    model: str = ""
    temperature: float = 0.0
    opener: Callable = urllib.request.urlopen
    sleep: Callable = time.sleep

    def _send(self, url: str, payload: dict, headers: dict, pick) -> dict:
        """The parsed reply; 429 has a budget of its own, other failures are tried three times."""
        limited = attempt = 0
        while True:
            try:
                req = urllib.request.Request(url, data=json.dumps(payload).encode(), headers={"Content-Type": "application/json"} | headers)
                with self.opener(req, timeout=TIMEOUT_S) as r:
                    return json.loads(without_fence(pick(json.loads(r.read()))))
            except urllib.error.HTTPError as e:
                if e.code == 429:
                    limited += 1
                    if limited >= RATE_RETRIES:
                        raise BackendError(f"rate limit after {limited} attempts") from e
                    self.sleep(min(2 ** (limited + 1), 60))
                    continue
                reason = f"HTTP {e.code}"
            except (ValueError, KeyError, IndexError, TypeError) as e:
                reason = f"parse: {e}"
            except OSError as e:
                reason = str(e)
            attempt += 1
            if attempt >= RETRIES:
                raise BackendError(reason)
            self.sleep(2 ** (attempt - 1))


@dataclass
class GatewayLabel(_Chat):
    """A gateway with the common chat-completions interface."""

    api_key: str = ""
    api_url: str = "http://localhost:8000/v1"
    max_tokens: int = 400
    min_interval_s: float = 0.0
    _last: float = field(default=0.0, init=False, repr=False)

    def check(self) -> None:
        if not self.api_key:
            raise ValueError("the gateway needs an API key")

    def call(self, prompt: str, system_prompt: str) -> dict:
        self.sleep(max(0.0, self._last + self.min_interval_s - time.monotonic()) if self.min_interval_s else 0)
        self._last = time.monotonic()
        body = {"model": self.model, "messages": [{"role": "system", "content": system_prompt}, {"role": "user", "content": prompt}], "temperature": self.temperature, "max_tokens": self.max_tokens}
        return self._send(f"{self.api_url.rstrip('/')}/chat/completions", body, {"Authorization": f"Bearer {self.api_key}"}, lambda r: r["choices"][0]["message"]["content"])


@dataclass
class OllamaLabel(_Chat):
    """A local model server asked for JSON."""

    host: str = "http://localhost:11434"

    def check(self) -> None:
        with self.opener(urllib.request.Request(f"{self.host.rstrip('/')}/api/tags"), timeout=10) as r:
            if not any(m["name"].startswith(self.model) for m in json.loads(r.read()).get("models", [])):
                raise ValueError(f"the server has no model {self.model!r}")

    def call(self, prompt: str, system_prompt: str) -> dict:
        body = {"model": self.model, "messages": [{"role": "system", "content": system_prompt}, {"role": "user", "content": prompt}], "stream": False, "format": "json", "options": {"temperature": self.temperature}}
        return self._send(f"{self.host.rstrip('/')}/api/chat", body, {}, lambda r: r["message"]["content"])


@dataclass
class RuleLabel:
    """Offline: core where the title matches ``pattern``, else off_topic."""

    pattern: str = "."

    def check(self) -> None:
        re.compile(self.pattern)

    def call(self, prompt: str, system_prompt: str) -> dict:
        title = prompt.partition("\n")[0].removeprefix("TITLE: ")
        return {"relevance": "core" if re.search(self.pattern, title, re.IGNORECASE) else "off_topic", "methods": [], "minerals": [], "is_review": False, "rationale": "rule"}


LABEL_BACKENDS = {"gateway": GatewayLabel, "ollama": OllamaLabel, "rules": RuleLabel}


def label_column(df: DataFrame, key: str, prompt: str, system_prompt: str = "", backend: str = "rules", **options) -> DataFrame:
    """(key, reply, error): a JSON reply for each prompt; a failure is an error row, never an exception."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        b = make_backend(LABEL_BACKENDS, backend, **options)
        for pdf in batches:
            replies, errors = [], []
            for p in pdf[prompt]:
                try:
                    replies.append(json.dumps(b.call(p, system_prompt)))
                    errors.append(None)
                except BackendError as e:
                    replies.append(None)
                    errors.append(e.reason)
            yield pd.DataFrame({key: pdf[key], "reply": replies, "error": errors})

    return df.select(key, prompt).mapInPandas(run, f"{key} {kind}, reply string, error string")
