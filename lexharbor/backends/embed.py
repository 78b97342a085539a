"""Embedding backends and their application to a column."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.request
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import make_backend


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows of length 1; zero rows stay."""
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1, n)


@dataclass
class HashingEmbed:
    """Deterministic offline vectors: signed counts of hashed words, or plain ones where all signs cancel out."""

    size: int = 64

    def embed(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size), dtype=np.float32)
        for i, t in enumerate(texts):
            hashes = [int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in t.lower().split()]
            for h in hashes:
                out[i, h % self.size] += 1 if h >> 63 else -1
            if not out[i].any():
                for h in hashes:
                    out[i, h % self.size] += 1
        return unit_rows(out)


@dataclass
class OllamaEmbed:
    """A local model server that answers batches of texts."""

    model: str = "bge-m3"
    host: str = "http://localhost:11434"
    batch_size: int = 32
    timeout_s: float = 120.0
    max_retries: int = 3
    normalize: bool = True
    opener: Callable = urllib.request.urlopen

    def _batch(self, texts: Sequence[str]) -> np.ndarray:
        body = json.dumps({"model": self.model, "input": list(texts)}).encode()
        error = None
        for attempt in range(1, self.max_retries + 1):
            try:
                req = urllib.request.Request(f"{self.host.rstrip('/')}/api/embed", data=body, headers={"Content-Type": "application/json"})
                with self.opener(req, timeout=self.timeout_s) as r:
                    reply = json.loads(r.read())
                m = np.asarray(reply.get("embeddings") or [reply["embedding"]], dtype=np.float32)
                if m.ndim != 2 or len(m) != len(texts):
                    raise ValueError(f"{m.shape} for {len(texts)} texts")
                return m
            except (OSError, ValueError, KeyError) as e:
                error = e
                if attempt < self.max_retries:
                    time.sleep(1.5 * attempt)
        raise RuntimeError(f"no embeddings after {self.max_retries} attempts: {error}")

    def embed(self, texts: Sequence[str]) -> np.ndarray:
        if not texts:
            return np.zeros((0, 0), dtype=np.float32)
        m = np.vstack([self._batch(texts[i : i + self.batch_size]) for i in range(0, len(texts), self.batch_size)])
        return unit_rows(m) if self.normalize else m


EMBED_BACKENDS = {"hashing": HashingEmbed, "ollama": OllamaEmbed}


def embed_column(df: DataFrame, key: str, text: str, backend: str = "hashing", **options) -> DataFrame:
    """(key, embedding) of rows with a text; one backend instance for each task."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        b = make_backend(EMBED_BACKENDS, backend, **options)
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({key: pdf[key], "embedding": list(b.embed(pdf[text].tolist()))})

    return df.where(f"length({text}) > 0").select(key, text).mapInPandas(run, f"{key} {kind}, embedding array<float>")
