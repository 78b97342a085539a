"""Language identification by prediction by partial matching.

Each language has a variable-order tree of byte contexts with counts and escape probabilities
(method C).  After training the statistics are frozen, so the code length of a byte in a context is
a constant: every kept context of any language is a state with one row of code lengths for each
language, and the state of a position follows from its three preceding bytes.  A text's code length
is the sum over all its bytes; the language with the shortest one is predicted.

The model is fitted on a bounded sample: ``DOCS_PER_LANGUAGE`` different labelled texts of each language
are expected in it (whole texts, chosen by a hash; all where a language has fewer).  Every byte value
and every context of the sample is in the model; a language holds rows for its own contexts only.
Prediction covers every byte.

A text is in no learned language where the best one needs ``MARGIN`` bits a byte more than it needs for
held-out texts of its own, and more the shorter the text is (``SPREAD``).  The held-out rate is that of
one half of the sample under a model of the other half.

Defined results: null text and text without a letter are ``und`` with score 0; without any usable
label everything is ``und``; bytes never seen in training cost the escapes to the uniform order -1;
ties go to the language that sorts first; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune

#: Expected number of sampled training texts of a language.
DOCS_PER_LANGUAGE = 400
CHUNK = 1 << 20
#: Bits of a byte without a model, and what a byte may cost beyond a language's own rate: that many
#: bits, and SPREAD divided by the root of the text's bytes.
RAW_BITS, MARGIN, SPREAD = 8.0, 3.0, 32.0
PAD = b"   "


@dataclass
class PpmModel:
    langs: list[str]
    remap: np.ndarray  # byte -> symbol; 0 for bytes that the sample lacks
    n_sym: int
    state_of: np.ndarray  # three symbols -> state
    row_of: list[np.ndarray]  # of each language: state -> row
    cost: list[np.ndarray]  # of each language: row * n_sym + symbol -> bits
    limit: np.ndarray  # bits a byte beyond which a long text is in none of the languages

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        buf = np.frombuffer(b"".join(PAD + t for t in texts), dtype=np.uint8)
        lens = np.array([len(t) + len(PAD) for t in texts])
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
        out = np.zeros((len(self.langs), len(texts)))
        s = self.n_sym
        for a in range(0, len(buf), CHUNK):
            b = min(a + CHUNK, len(buf))
            sym = self.remap[np.concatenate([np.frombuffer(PAD, np.uint8), buf[a:b]]) if a == 0 else buf[a - 3 : b]].astype(np.int32)
            state = self.state_of[(sym[:-3] * s + sym[1:-2]) * s + sym[2:-1]]
            inside = starts[(starts > a) & (starts < b)]
            first = int(np.searchsorted(starts, a, side="right")) - 1
            points = np.concatenate([[a], inside]) - a
            pads = (starts[(starts > a - 3) & (starts < b)][:, None] + np.arange(3)).ravel()
            pads = pads[(pads >= a) & (pads < b)] - a
            for k in range(len(self.langs)):
                bits = self.cost[k][self.row_of[k][state] * s + sym[3:]]
                bits[pads] = 0
                out[k, first : first + len(points)] += np.add.reduceat(bits, points, dtype=np.float64)
        return out


def _language_rows(n_sym, states, grams, counts):
    """(row of each state, code lengths by row) of one language; ``grams``: (n, 4) symbols with counts."""
    row_of, rows = np.zeros(len(states), dtype=np.int64), []
    for order in range(4):
        keys = np.zeros(len(grams), dtype=np.int64)
        for j in range(3 - order, 3):
            keys = keys * n_sym + grams[:, j]
        flat, inv = np.unique(keys * n_sym + grams[:, 3], return_inverse=True)
        ctx, sym, n = flat // n_sym, flat % n_sym, np.bincount(inv, weights=counts)
        at_order = [(i, key, up) for i, (o, key, up) in enumerate(states) if o == order]
        lows, highs = (np.searchsorted(ctx, [k for _, k, _ in at_order], side) for side in ("left", "right"))
        for (i, _, up), lo, hi in zip(at_order, lows.tolist(), highs.tolist(), strict=True):
            if lo == hi:  # not this language's context: as in the shorter one
                row_of[i] = row_of[up]
                continue
            base = rows[row_of[up]] if up is not None else np.full(n_sym, RAW_BITS, np.float32)
            total, distinct = n[lo:hi].sum(), hi - lo
            row = base - np.float32(np.log2(distinct / (total + distinct)))
            row[sym[lo:hi]] = -np.log2(n[lo:hi] / (total + distinct))
            row_of[i] = len(rows)
            rows.append(row)
    return row_of, np.concatenate(rows)


def _bytes_of(grams: pd.DataFrame) -> np.ndarray:
    raw = grams["gram"].to_numpy(np.int64)
    return np.stack([(raw >> s) & 255 for s in (24, 16, 8, 0)], axis=1)


def build_model(grams: pd.DataFrame) -> PpmModel | None:
    """Model of (lang, gram, n): counts of four-byte strings, the last byte coded in the first three."""
    if grams.empty:
        return None
    by, n = _bytes_of(grams), grams["n"].to_numpy(np.float64)
    kept = np.unique(by)
    n_sym = len(kept) + 1
    remap = np.zeros(256, dtype=np.int32)
    remap[kept] = np.arange(1, n_sym)
    sym = remap[by].astype(np.int64)

    states, ids = [(0, 0, None)], {}
    state_of = np.zeros((n_sym,) * 3, dtype=np.int32)
    for order in (1, 2, 3):
        key = np.zeros(len(sym), dtype=np.int64)
        for j in range(3 - order, 3):
            key = key * n_sym + sym[:, j]
        for k in np.unique(key).tolist():
            up = 0 if order == 1 else ids[order - 1, k % n_sym ** (order - 1)]
            ids[order, k] = len(states)
            c, a, b = k // n_sym**2, k // n_sym % n_sym, k % n_sym
            state_of[(slice(None), slice(None), b) if order == 1 else (slice(None), a, b) if order == 2 else (c, a, b)] = len(states)
            states.append((order, k, up))
    langs = sorted(grams["lang"].unique(), key=str.encode)
    row_of, cost = [], []
    for lang in langs:
        own = (grams["lang"] == lang).to_numpy()
        rows, bits = _language_rows(n_sym, states, sym[own], n[own])
        row_of.append(rows)
        cost.append(bits)
    return PpmModel(langs, remap, n_sym, state_of.ravel(), row_of, cost, np.full(len(langs), RAW_BITS))


def held_out_rates(grams: pd.DataFrame) -> dict[str, float]:
    """Bits a byte of each language in one half of the sample under a model of the other; only where both have it."""
    model, rates = build_model(grams[grams["half"] == 0]), {}
    for k, lang in enumerate(model.langs if model else []):
        other = grams[(grams["half"] == 1) & (grams["lang"] == lang)]
        if len(other):
            sym, n, s = model.remap[_bytes_of(other)].astype(np.int64), other["n"].to_numpy(np.float64), model.n_sym
            state = model.state_of[(sym[:, 0] * s + sym[:, 1]) * s + sym[:, 2]]
            rates[lang] = float((model.cost[k][model.row_of[k][state] * s + sym[:, 3]] * n).sum() / n.sum())
    return rates


def fit(grams: pd.DataFrame) -> PpmModel | None:
    """Model of both halves of (lang, half, gram, n), with the limits that the held-out rates give."""
    model = build_model(grams)
    if model is not None:
        rates = held_out_rates(grams)
        model.limit = np.array([rates[lang] + MARGIN if lang in rates else RAW_BITS for lang in model.langs])
    return model


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE) -> PpmModel | None:
    """Fit the model; the driver gets counts of four-byte strings of the sample, not texts."""
    tune(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    # Different texts are counted and drawn, so copies neither crowd a language out nor in.
    number = F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 30))
    totals = {r["lang"]: r["n"] for r in rows.select("lang", number.alias("number")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return None
    share = F.lit(0.0)
    for lang, n in sorted(totals.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, docs_per_language / n))).otherwise(share)
    drawn = rows.where(number / F.lit(float(1 << 30)) < share).dropDuplicates(["lang", "text"]).withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "text"), F.lit(2)))

    def count(batches):
        for pdf in batches:
            for (lang, half), part in pdf.groupby(["lang", "half"]):
                codes = []
                for text in part["text"]:
                    b = np.frombuffer(PAD + text.encode("utf-8", "replace"), dtype=np.uint8).astype(np.int64)
                    codes.append((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:])
                gram, n = np.unique(np.concatenate(codes), return_counts=True)
                yield pd.DataFrame({"lang": lang, "half": half, "gram": gram, "n": n.astype(np.int64)})

    counts = drawn.mapInPandas(count, "lang string, half long, gram long, n long")
    return fit(counts.groupBy("lang", "half", "gram").agg(F.sum("n").alias("n")).toPandas().sort_values(["lang", "half", "gram"]))


def identify(docs: DataFrame, model: PpmModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, bits_per_byte) for every row; score is the posterior of the language."""
    spark = docs.sparkSession
    tune(spark)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col)).alias("text"),  # null: nothing to score
    )
    held = spark.sparkContext.broadcast(model)

    def predict(batches):
        model = held.value
        for pdf in batches:
            text = pdf["text"].tolist()
            use = [i for i, t in enumerate(text) if isinstance(t, str)] if model else []
            lang, score = np.full(len(pdf), "und", dtype=object), np.zeros(len(pdf))
            rate = np.full(len(pdf), np.nan)
            if use:
                raw = [text[i].encode("utf-8", "replace") for i in use]
                bits = model.code_lengths(raw)
                best = bits.argmin(axis=0)
                least = bits.min(axis=0)
                lang[use] = np.array(model.langs, dtype=object)[best]
                score[use] = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(axis=0)
                rate[use] = least / np.array([len(r) for r in raw])
            yield pd.DataFrame({
                "id": pdf["id"].astype("Int64"), "lang_pred": lang, "score": score, "bits_per_byte": pd.array(rate, dtype="Float64"),
            })

    return rows.mapInPandas(predict, "id long, lang_pred string, score double, bits_per_byte double")


def in_known_language(model: PpmModel, raw: list[bytes]) -> np.ndarray:
    """Whether the best language of each text codes it about as well as texts of its own."""
    bits, size = model.code_lengths(raw), np.array([len(r) for r in raw])
    return bits.min(axis=0) <= model.limit[bits.argmin(axis=0)] * size + SPREAD * np.sqrt(size)


def keep_known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows of ``docs`` in a learned language; ``und`` and texts that no language foresees are rejected."""
    spark = docs.sparkSession
    tune(spark)
    model = train(docs, text_col, lang_col)
    held = spark.sparkContext.broadcast(model)
    rows = docs.where(F.col(text_col).rlike(r"\p{L}"))

    def keep(batches):
        model = held.value
        for batch in batches:
            if model is None or not batch.num_rows:
                continue
            raw = [t.encode("utf-8", "replace") for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(in_known_language(model, raw)))

    return rows.mapInArrow(keep, rows.schema)
