"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of ``2 * BLOCK`` words with TF-IDF weights over ``TERMS`` hashed terms; document
frequencies count every document.  A randomised SVD (range finder, power iteration, small
eigenproblem; all products with the passage matrix run on the executors) gives ``RANK`` latent
directions.  It is fitted on all benchmark passages, and on nothing else: what a document's passage has
outside of their span adds nothing to its product with any of them.  Every passage of every document is
projected and compared by cosine with all benchmark passages, in blocks.  A term that the benchmark
lacks has no place in the space, so tasks hold rows for the benchmark's terms only.
Candidates are confirmed by the longest common subsequence of
words, by the share of the item's weighted words that the passage has, and by the answer, i.e. the
end of the item, so paraphrases that keep most words in order are found and chance overlap is not.

The latent space holds less of each passage the more items there are, so candidates also come from an
exact search (``RareWords``): no place near which ``WEIGHTED`` of an item's weight is found can lack
its rare words, so every place that would be confirmed is looked at, whatever the rank.

The benchmark is the stated query set: tasks hold it, in shards of at most ``SHARD_WORDS`` words that
are searched for one after the other; the documents are never held.

Defined results: null or blank texts match nothing, null or wordless items are ignored; an item of up
to ``WHOLE`` + 2 words matches only whole, and the share that may be missing grows with its length;
words in another order count as missing; equal items each report their own match; an empty table
gives an empty result; very long texts are processed in stretches; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, tune
from .shingles import BREAKS, batch_words, word_hashes

TERMS, RANK, OVERSAMPLING, POWER_STEPS = 1 << 16, 96, 16, 1
BLOCK, STRETCH, QUERY_BLOCK = 16, 1 << 15, 2048
#: Documents' passages in the fit: none.  Nothing reads it but a test that the fit has a bound.
SAMPLE = 0
#: Words of the benchmark that are searched for at once, and blocks of words that are summed up at once.
SHARD_WORDS, SUMMED = 1 << 20, 64
#: Exponent of the inverse document frequency, so that frequent words do not make passages alike.
IDF_POWER = 2
#: Cosine of a candidate, and the share of the item's latent vector that it must hold.
COSINE, LATENT_SHARE = 0.4, 0.4
#: Shares of the item that the subsequence, the weighted words and the answer must reach.
SUBSEQUENCE, WEIGHTED, ANSWER = 0.6, 0.6, 0.5
#: Words of an item that the subsequence share is not asked of, and the part of an item that is its answer.
WHOLE, ANSWER_SHARE = 5, 0.2
#: Share of an item's weight that a place must have in its rare words, and (word, item) pairs held at once.
RARE_SHARE, PAIRS = 0.2, 1 << 20


def words_of(text) -> np.ndarray:
    return word_hashes(text.lower(), BREAKS) if isinstance(text, str) else np.zeros(0, np.uint64)


def words_of_all(texts: list) -> list[np.ndarray]:
    """``words_of`` of each text, hashed together."""
    words, bounds = batch_words([t.lower() if isinstance(t, str) else None for t in texts], BREAKS)
    return [words[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def missing_words(length: int) -> int:
    """Words that a subsequence of an item of ``length`` words may lack."""
    return int((1 - SUBSEQUENCE) * max(0, length - WHOLE) + 1e-9)


def terms_of(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(TERMS - 1)).astype(np.int64)


def windows(n: int) -> list[tuple[int, int]]:
    """Word ranges of the passages of ``n`` words: two neighbouring blocks each."""
    if n <= 2 * BLOCK:
        return [(0, n)] if n else []
    return [(a, min(a + 2 * BLOCK, n)) for a in range(0, n - BLOCK, BLOCK)]


def common_subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's words."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    state = full
    for w in text[np.isin(text, item)].tolist():
        hit = state & places[w]
        state = ((state + hit) | (state - hit)) & full
    return len(item) - state.bit_count()


def near_words(first: int, length: int) -> tuple[int, int]:
    """Words that count as near the passage at ``first`` for an item of ``length`` words."""
    return max(0, first - length), first + 2 * BLOCK + length


def judge(words: np.ndarray, item: np.ndarray, first: int, weights: np.ndarray) -> tuple[float, float, float] | None:
    """(subsequence, weighted, answer) shares of ``item`` in the words near the passage at ``first``, if confirmed."""
    near = words[slice(*near_words(first, len(item)))]
    w = weights[terms_of(item)]
    weighted = float(w[np.isin(item, near)].sum() / w.sum())
    if weighted < WEIGHTED:
        return None
    end = item[-max(min(3, len(item)), round(ANSWER_SHARE * len(item))) :]
    sub = common_subsequence(item, near)
    answer = common_subsequence(end, near) / len(end)
    if sub < len(item) - missing_words(len(item)) or answer < ANSWER:
        return None
    return sub / len(item), weighted, answer


class Passages:
    """The passages of a batch of texts: blocks of BLOCK words, two neighbouring ones each."""

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(w) for w in texts], dtype=np.int64)
        blocks = -(-lengths // BLOCK)
        self.start = np.concatenate([[0], np.cumsum(blocks)])
        self.terms = np.full(self.start[-1] * BLOCK, TERMS, dtype=np.int64)  # TERMS: no word
        pad = np.repeat(self.start[:-1] * BLOCK - (np.cumsum(lengths) - lengths), lengths)
        self.terms[np.arange(len(pad)) + pad] = terms_of(np.concatenate(texts)) if len(pad) else 0
        # Of each block: whether a passage starts there, and whether its text goes on.
        self.goes_on = np.ones(self.start[-1], dtype=bool)
        self.goes_on[self.start[1:][blocks > 0] - 1] = False
        self.starts = self.goes_on.copy()
        self.starts[self.start[:-1][blocks == 1]] = True

    def stretches(self, latent: np.ndarray):
        """(numbers of the first blocks, latent vectors) of passages; ``latent`` ends with a row of zeros."""
        n, rank = len(self.starts), latent.shape[1]
        step = max(1, STRETCH // BLOCK)
        held = np.empty((SUMMED * BLOCK, rank), dtype=latent.dtype)
        for at in range(0, n, step):
            last = min(at + step + 1, n)
            sums = np.empty((last - at, rank), dtype=latent.dtype)
            for a in range(at, last, SUMMED):
                b = min(a + SUMMED, last)
                rows = held[: (b - a) * BLOCK]
                np.take(latent, self.terms[a * BLOCK : b * BLOCK], axis=0, out=rows, mode="clip")
                np.add.reduce(rows.reshape(-1, BLOCK, rank), axis=1, out=sums[a - at : b - at])
            whole = sums[: min(step, n - at)]
            on = self.goes_on[at : at + len(whole)]
            whole = whole + np.concatenate([sums[1:], np.zeros((1, rank), latent.dtype)])[: len(whole)] * on[:, None]
            first = np.flatnonzero(self.starts[at : at + len(whole)])
            yield first + at, whole[first]


class RareWords:
    """Exact search of the places near which ``WEIGHTED`` of an item's weight is found.

    An item's heaviest words are listed until the others weigh ``WEIGHTED - RARE_SHARE`` at most, so
    such a place has at least ``RARE_SHARE`` of the item's weight in listed words.
    """

    def __init__(self, items: list[np.ndarray], weights: np.ndarray):
        listed, owners, shares, self.least = [], [], [], np.zeros(len(items))
        for k, item in enumerate(items):
            words, n = np.unique(item, return_counts=True)
            share = weights[terms_of(words)].astype(np.float64) * n
            share /= share.sum()
            order = np.argsort(-share / n, kind="stable")
            held = np.cumsum(share[order])
            m = int(np.searchsorted(held, 1 - WEIGHTED + RARE_SHARE)) + 1
            listed.append(words[order[:m]])
            owners.append(np.full(len(listed[-1]), k))
            shares.append(share[order[:m]])
            self.least[k] = held[: len(listed[-1])][-1] - (1 - WEIGHTED) - 1e-5
        words, at = np.unique(np.concatenate(listed), return_inverse=True)
        order = np.argsort(at, kind="stable")
        self.words, self.owners, self.shares = words, np.concatenate(owners)[order], np.concatenate(shares)[order]
        self.bounds = np.searchsorted(at[order], np.arange(len(words) + 1))
        self.lengths = np.array([len(i) for i in items])
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(words & np.uint64(len(self.seen) - 1)).astype(np.int64)] = True

    def pieces(self, texts: list[np.ndarray]):
        """(text, first word, words, places, listed words) of stretches; windows fall whole into one of them."""
        room = 2 * (int(self.lengths.max()) + 2 * BLOCK)
        step = BLOCK * (max(STRETCH, 2 * room) // BLOCK)
        words, bounds = np.concatenate(texts), np.cumsum([0] + [len(w) for w in texts])
        at = np.flatnonzero(self.seen[(words & np.uint64(len(self.seen) - 1)).astype(np.int64)])
        found = np.searchsorted(self.words, words[at])
        same = self.words[np.minimum(found, len(self.words) - 1)] == words[at]
        at, found = at[same], found[same]
        edges = np.searchsorted(at, bounds)
        for t in np.flatnonzero(np.diff(edges)).tolist():
            own, own_found = at[edges[t] : edges[t + 1]] - bounds[t], found[edges[t] : edges[t + 1]]
            for first in range(0, len(texts[t]), step):
                a, b = np.searchsorted(own, (first - room, first + step + room))
                if a < b:
                    yield t, (first, first + step), own[a:b], own_found[a:b]

    def places(self, texts: list[np.ndarray]):
        """(text, item, first words): passages that may be confirmed, and all that are."""
        held, pairs = [], 0
        for piece in self.pieces(texts):
            n = int((self.bounds[piece[3] + 1] - self.bounds[piece[3]]).sum())
            if held and pairs + n > PAIRS:
                yield from self.settle(held, texts)
                held, pairs = [], 0
            held.append(piece)
            pairs += n
        if held:
            yield from self.settle(held, texts)

    def settle(self, held, texts):
        piece = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
        place, word = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
        lo, n = self.bounds[word], self.bounds[word + 1] - self.bounds[word]
        entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        piece, place = np.repeat(piece, n), np.repeat(place, n)
        key = piece * len(self.lengths) + self.owners[entry]
        # Repetitions are counted, so sums are upper bounds.
        keys, inv = np.unique(key, return_inverse=True)
        enough = np.bincount(inv, weights=self.shares[entry]) >= self.least[keys % len(self.lengths)]
        use = np.flatnonzero(enough[inv])
        use = use[np.argsort(inv[use], kind="stable")]
        cuts = np.flatnonzero(np.diff(inv[use])) + 1
        for own in np.split(use, cuts) if len(use) else []:
            t, (first, end), _, _ = held[piece[own[0]]]
            k = int(self.owners[entry[own[0]]])
            length, last = self.lengths[k], max(1, -(-len(texts[t]) // BLOCK) - 1) * BLOCK
            at, total = place[own], np.concatenate([[0.0], np.cumsum(self.shares[entry[own]])])
            reach = length + 2 * BLOCK
            grid = np.arange(max(first, (at[0] - reach) // BLOCK * BLOCK), min(end, last, at[-1] + reach + 1), BLOCK)
            inside = total[np.searchsorted(at, grid + reach)] - total[np.searchsorted(at, np.maximum(grid - length, 0))]
            if len(grid := grid[inside >= self.least[k]]):
                yield t, k, grid.tolist()


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Documents that have each hashed term, and documents with words; all documents count."""
    def count(batches):
        df, n = np.zeros(TERMS, dtype=np.int64), 0
        for pdf in batches:
            for words in words_of_all(pdf["text"].tolist()):
                terms = np.unique(terms_of(words))
                df[terms] += 1
                n += bool(len(terms))
        at = np.flatnonzero(df)
        yield pd.DataFrame({"term": np.append(at, -1), "n": np.append(df[at], n)})

    got = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(TERMS)
    own = got["term"] >= 0
    df[got["term"][own].to_numpy()] = got["n"][own].to_numpy()
    return df, int(got["n"][~own].sum())


def randomised_svd(passages: DataFrame, n: int, weights: np.ndarray) -> np.ndarray:
    """(TERMS, RANK) right singular vectors of the weighted passage matrix; ``passages``: row, terms."""
    spark = passages.sparkSession
    held = spark.sparkContext.broadcast(weights)
    width = RANK + OVERSAMPLING

    def times(right):
        """The matrix times ``right`` (None: a seeded Gaussian), row by row, on the executors."""
        sent = spark.sparkContext.broadcast(right)

        def rows(batches):
            right = sent.value
            if right is None:
                right = np.random.default_rng(11).standard_normal((TERMS, width), dtype=np.float32)
            for pdf in batches:
                out = [(held.value[t][:, None] * right[t]).sum(axis=0) for t in pdf["terms"]]
                yield pd.DataFrame({"row": pdf["row"], "y": [v.astype(np.float32).tobytes() for v in out]})

        out = np.zeros((n, width if right is None else right.shape[1]), dtype=np.float32)
        for row, y in passages.mapInPandas(rows, "row long, y binary").toLocalIterator():
            out[row] = np.frombuffer(y, np.float32)
        sent.destroy()
        return out

    def project(left):
        """``left`` transposed times the matrix: partial sums by term, added up by term."""
        sent = spark.sparkContext.broadcast(left.astype(np.float32))

        def partial(batches):
            acc = {}
            for pdf in batches:
                for row, terms in zip(pdf["row"], pdf["terms"], strict=True):
                    for t in terms:
                        v = sent.value[row] * held.value[t]
                        acc[t] = acc[t] + v if t in acc else v
            if acc:
                yield pd.DataFrame({"term": list(acc), "v": [v.astype(np.float32).tobytes() for v in acc.values()]}, columns=["term", "v"])

        def add(pdf):
            sums = {}
            for t, v in zip(pdf["term"], pdf["v"], strict=True):
                v = np.frombuffer(v, np.float32)
                sums[t] = sums[t] + v if t in sums else v
            return pd.DataFrame({"term": list(sums), "v": [v.tobytes() for v in sums.values()]}, columns=["term", "v"])

        parts = passages.mapInPandas(partial, "term long, v binary")
        out = np.zeros((TERMS, left.shape[1]), dtype=np.float32)
        for term, v in parts.groupBy((F.col("term") % 64).alias("g")).applyInPandas(add, "term long, v binary").toLocalIterator():
            out[term] = np.frombuffer(v, np.float32)
        sent.destroy()
        return out

    small = project(np.linalg.qr(times(None))[0])
    for _ in range(POWER_STEPS):
        small = project(np.linalg.qr(times(small))[0])
    held.destroy()
    values, left = np.linalg.eigh((small.T @ small).astype(np.float64))
    top = np.argsort(-values)[: min(RANK, n)]
    top = top[values[top] > 1e-9 * max(values.max(), 1e-30)]
    return small @ (left[:, top] / np.sqrt(values[top])).astype(np.float32)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, cosine, subsequence, weighted, answer, first_word): confirmed leaks, best place each."""
    spark = docs.sparkSession
    tune(spark)
    found = spark.createDataFrame([], "id long, item_id long, cosine double, subsequence double, weighted double, answer double, first_word long")
    items = [(int(r[0]), words_of(r[1])) for r in benchmark.select(F.col(item_col).cast("long"), F.col(item_text)).where(F.col(item_col).isNotNull()).toLocalIterator()]
    items = sorted(((i, w) for i, w in items if len(w)), key=lambda x: x[0])
    df, n_docs = document_frequencies(docs, text_col)
    if not items or not n_docs:
        return found
    weights = np.log((1 + n_docs) / (1 + df)).clip(min=1e-3).astype(np.float32)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    shard_of = np.cumsum([len(w) for _, w in items]) // SHARD_WORDS
    parts = [rows.mapInPandas(_search([items[k] for k in np.flatnonzero(shard_of == s)], weights, spark), found.schema) for s in np.unique(shard_of)]
    for part in parts[1:]:
        parts[0] = parts[0].unionByName(part)
    return parts[0]


def latent_space(items: list, weights: np.ndarray, spark: SparkSession) -> tuple[np.ndarray, list]:
    """(latent directions of the weighted terms, passages (item, first word, end) of the items): fitted on all these passages."""
    queries = [(k, a, b) for k, (_, w) in enumerate(items) for a, b in windows(len(w))]
    passages = spark.createDataFrame([(row, terms_of(items[k][1][a:b]).tolist()) for row, (k, a, b) in enumerate(queries)], "row long, terms array<long>")
    strong = weights**IDF_POWER
    return randomised_svd(settle(passages, "lsa-rows"), len(queries), strong) * strong[:, None], queries


def _search(items: list, weights: np.ndarray, spark: SparkSession):
    """The batch function that finds ``items`` in texts."""
    latent, queries = latent_space(items, weights, spark)
    asked = np.stack([latent[terms_of(items[k][1][a:b])].sum(axis=0) for k, a, b in queries])
    lengths = np.maximum(np.linalg.norm(asked, axis=1), 1e-12)
    asked /= lengths[:, None]
    # Rows of the benchmark's terms, and one of zeros for all others and for no word.
    known = np.flatnonzero(latent.any(axis=1))
    place = np.full(TERMS + 1, len(known))
    place[known] = np.arange(len(known))
    latent = np.concatenate([latent[known], np.zeros((1, latent.shape[1]), latent.dtype)])
    rare = RareWords([w for _, w in items], weights)
    held = spark.sparkContext.broadcast((place, latent, weights, items, np.array([k for k, _, _ in queries]), asked, lengths, rare))

    def search(batches):
        place, latent, weights, items, item_of, asked, lengths, rare = held.value
        for pdf in batches:
            if pdf.empty:
                continue
            texts = words_of_all(pdf["text"].tolist())
            best, passages = [{} for _ in texts], Passages(texts)
            passages.terms = place[passages.terms]

            def look(t, k, first, cosine):
                """Judge a place; ``cosine``: called only if it is confirmed."""
                if got := judge(texts[t], items[k][1], first, weights):
                    got = (*got, float(cosine()))
                    if k not in best[t] or got > best[t][k][:4]:
                        best[t][k] = (*got, first)

            for blocks, vectors in passages.stretches(latent):
                norms = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
                for q in range(0, len(asked), QUERY_BLOCK):
                    along = vectors @ asked[q : q + QUERY_BLOCK].T
                    r, c = np.nonzero(along >= LATENT_SHARE * lengths[q : q + QUERY_BLOCK])
                    near = along[r, c] / norms[r]
                    keep = near >= COSINE
                    text = np.searchsorted(passages.start, blocks[r[keep]], side="right") - 1
                    for t, block, k, cos in zip(text.tolist(), blocks[r[keep]].tolist(), item_of[q + c[keep]].tolist(), near[keep].tolist(), strict=True):
                        look(t, k, (block - int(passages.start[t])) * BLOCK, lambda: cos)

            def cosine(t, k, first):
                passage = latent[place[terms_of(texts[t][first : first + 2 * BLOCK])]].sum(axis=0)
                return (asked[item_of == k] @ passage).max() / max(np.linalg.norm(passage), 1e-12)

            for t, k, places in rare.places(texts):
                for first in places:
                    look(t, k, first, lambda: cosine(t, k, first))
            out = [(doc, items[k][0], v[3], *v[:3], v[4]) for doc, own in zip(pdf["id"], best, strict=True) for k, v in sorted(own.items())]
            yield pd.DataFrame(out, columns=["id", "item_id", "cosine", "subsequence", "weighted", "answer", "first_word"])

    return search
