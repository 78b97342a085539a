"""Phrase collocations by pivot partitioning.

1. **Words** are counted for each language.  The frequencies of the frequent ones are held in a table
   of ``SLOTS`` numbers, whatever the vocabulary is: it orders words by rarity and shows which are
   infrequent (a shared slot makes a word look more frequent, which costs work and changes no count).
2. **Pairs** of neighbouring frequent words are counted by the keys of both, and named by a join with the
   words.  A filter of ``PAIR_BITS`` bits shows which are frequent; no longer phrase goes across another
   pair.  **Triples** of such pairs are counted by hash and held in a second filter.  (Equal hashes and
   shared bits let a pair or triple pass, which costs work and changes no count of a longer phrase.  Pairs
   are confused only if two words of a language share a 64-bit key: with n words, below n**2 / 2**65.)
3. **Rewriting.**  The pivot of a phrase is its rarest word, the leftmost if it stands there twice.
   Around every word of a text the fragment is cut in which all phrases of this pivot lie: up to
   ``longest`` - 1 words on either side, as far as pairs and triples may be frequent and no word is rarer
   (to the left: no word is as rare).  Other words never matter to this pivot, so they are left out.
   Where the triple around the pivot is infrequent, its sides are two fragments; those of two words are
   left out.
4. **Routing.**  Fragments go to their pivot's partition, equal ones as one row with a count.  The
   fragments of a pivot with more than ``SHARE_WORDS`` occurrences are dealt over shares.
5. **Mining.**  In its partition, every fragment gives the phrases that hold its pivot; an infrequent
   phrase never leaves the partition, unless its pivot has shares that must be added up first.

A phrase of k words has its score at the weakest of its cuts.  A phrase is redundant if a longer
candidate holds it almost as often; as frequencies fall with length, one word more tells it all.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count
again; ties are settled by the order stated in ``collocations``; a phrase never crosses a break; very
long texts are cut in one pass; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import joined_spread, settle, tune
from .shingles import hash_words, mix

#: Entries of the rarity table; steps of an octave that it tells apart.
SLOTS, STEPS = 1 << 20, 1024
#: Bits of the filters of pairs and of triples.
PAIR_BITS = 1 << 26
#: Characters of texts that are looked at together.
JOINED = 1 << 19
#: Occurrences of a pivot in one share, and different fragments that a task combines
#: before it sends them on, SENT rows at once.
SHARE_WORDS, COMBINED, SENT = 1 << 18, 1 << 19, 1 << 16
#: Characters that end a piece, and all that end a word (fixed values).
BREAK = r".,;:!?\x0A-\x0D"
_STEP = np.uint64(0xD6E8FEB86659FD93)
_GAPS = re.compile(rb"[\x20\x09]+")
_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_IS_END = _IS_BREAK.copy()
_IS_END[[9, 32]] = True
_BEFORE = [bytes([n]) for n in range(256)]
_TO_SPACE = bytes(32 if _IS_END[i] else i for i in range(256))


def _language(lang_col: str):
    return F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, word, f) of all words."""
    low = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.split(low, rf"[{BREAK}\x20\x09]+")
    rows = docs.select(_language(lang_col).alias("lang"), F.explode(words).alias("word")).where("word <> ''")
    return rows.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f"))


def word_keys(words: list[bytes], lang: str) -> np.ndarray:
    """A hash of each word in its language."""
    return mix(hash_words(words) ^ hash_words([lang.encode()]) * np.uint64(3))


def levels_of(levels: np.ndarray, key: np.ndarray) -> np.ndarray:
    return levels[(key & np.uint64(len(levels) - 1)).astype(np.int64)]


def rarity_levels(frequent: DataFrame, least: int) -> np.ndarray:
    """SLOTS levels (0: no frequent word), higher for more frequent words."""

    def levels(batches):
        for pdf in batches:
            for lang, own in pdf.groupby("lang", sort=False):
                key = word_keys([w.encode() for w in own["word"]], lang)
                level = 1 + np.floor(STEPS * np.log2(own["f"].to_numpy(np.float64) / least)).astype(np.int64)
                yield pd.DataFrame({"slot": (key & np.uint64(SLOTS - 1)).astype(np.int64), "level": np.minimum(level, 65535)})

    held = frequent.mapInPandas(levels, "slot long, level long").groupBy("slot").agg(F.max("level").alias("level")).toPandas()  # SLOTS rows at most
    table = np.zeros(SLOTS, dtype=np.uint16)
    table[held["slot"].to_numpy(np.int64)] = held["level"].to_numpy(np.int64)
    return table


def _joined(batches):
    """(lang, texts) of a batch: texts of a language are joined by breaks, so no phrase goes across them."""
    for pdf in batches:
        for lang, texts in pdf.groupby("lang", sort=False)["text"]:
            held, size = [], 0
            for text in texts:
                held.append(text)
                size += len(text)
                if size >= JOINED:
                    yield lang, "\n".join(held)
                    held, size = [], 0
            if held:
                yield lang, "\n".join(held)


def _text_words(text: str, lang: str, levels: np.ndarray):
    """(raw, starts, ends, keys, levels, pairs): a text's words, and which neighbours stand in one piece and are frequent."""
    raw = text.encode("utf-8").lower()
    if b"\t" in raw or b"  " in raw:
        raw = _GAPS.sub(b" ", raw)
    b = np.frombuffer(b" " + raw + b" ", np.uint8)
    inside = ~_IS_END[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]  # places in ``raw``
    key = word_keys(raw.translate(_TO_SPACE).split(), lang)
    level = levels_of(levels, key).astype(np.uint64)
    # Words of one piece have no break between them.
    pairs = (level[1:] > 0) & (level[:-1] > 0) & (starts[1:] - ends[:-1] == 1) & ~_IS_BREAK[b[ends[:-1] + 1]]
    return raw, starts, ends, key, level, pairs


def _longer_hashes(hashes: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one word more, from those of phrases (at first: the words)."""
    return mix(hashes[:-1] * _STEP + key[len(key) - len(hashes) + 1 :])


def _open(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    slot = (hashes & np.uint64(8 * len(bitmap) - 1)).astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _counted(docs: DataFrame, made, schema: str, least: int, text_col: str, lang_col: str) -> DataFrame:
    """(*columns of ``schema``, n): the rows of numbers that ``made(text, lang)`` gives ``least`` times."""
    names = [x.split()[0] for x in schema.split(", ")]

    def rows(batches):
        for lang, text in _joined(batches):
            yield pd.DataFrame(made(text, lang).view(np.int64), columns=names)

    found = _texts(docs, text_col, lang_col).mapInPandas(rows, schema)  # tasks combine equal rows before they send them on
    return found.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap of the column ``phrase``: PAIR_BITS bits, whatever the input is."""
    slot = F.pmod("phrase", F.lit(PAIR_BITS)) + 1
    pages = hashes.groupBy(F.bitmap_bucket_number(slot).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    bitmap = np.zeros(PAIR_BITS // 8, dtype=np.uint8)
    for page, bits in pages.collect():  # 4 KiB for each 32768 bits of the filter
        bitmap[(page - 1) * 4096 : page * 4096] = np.frombuffer(bits, np.uint8)
    return bitmap


def frequent_pairs(docs: DataFrame, levels: np.ndarray, least: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(first, second, n): the keys of neighbours that occur ``least`` times."""
    held = docs.sparkSession.sparkContext.broadcast(levels)  # 2 * SLOTS bytes

    def pairs(text: str, lang: str) -> np.ndarray:
        _, _, _, key, _, pairs = _text_words(text, lang, held.value)
        return np.stack([key[:-1][pairs], key[1:][pairs]], axis=1)

    return settle(_counted(docs, pairs, "first long, second long", least, text_col, lang_col), "phrase-pairs")


def pair_filter(pairs: DataFrame) -> np.ndarray:
    def hashes(batches):
        for pdf in batches:
            key = pdf[["first", "second"]].to_numpy(np.int64).view(np.uint64)
            yield pd.DataFrame({"phrase": mix(key[:, 0] * _STEP + key[:, 1]).view(np.int64)})

    return _bitmap(pairs.mapInPandas(hashes, "phrase long"))


def triple_filter(docs: DataFrame, levels: np.ndarray, bitmap: np.ndarray, least: int, text_col: str = "text", lang_col: str = "lang") -> np.ndarray:
    """A bitmap of the hashes of all triples that occur ``least`` times."""
    held = docs.sparkSession.sparkContext.broadcast((levels, bitmap))  # 2 * SLOTS and PAIR_BITS / 8 bytes

    def triples(text: str, lang: str) -> np.ndarray:
        levels, bitmap = held.value
        _, _, _, key, _, pairs = _text_words(text, lang, levels)
        if len(key) < 3:
            return np.zeros((0, 1), np.uint64)
        found = _longer_hashes(key, key)
        pairs &= _open(found, bitmap)
        return _longer_hashes(found, key)[pairs[:-1] & pairs[1:], None]

    return _bitmap(_counted(docs, triples, "phrase long", least, text_col, lang_col))


def pair_phrases(pairs: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, phrase, f) of the counted pairs, their keys looked up among the frequent words."""

    def keyed(batches):
        for pdf in batches:
            for lang, own in pdf.groupby("lang", sort=False):
                yield pd.DataFrame({"key": word_keys([w.encode() for w in own["word"]], lang).view(np.int64), "lang": lang, "word": own["word"].to_numpy()})

    words = settle(frequent.mapInPandas(keyed, "key long, lang string, word string"), "phrase-keys")
    # Many pairs may begin or end with one word.
    named = joined_spread(pairs, words.select(F.col("key").alias("first"), "lang", F.col("word").alias("one")), "first", "second")
    named = joined_spread(named, words.select(F.col("key").alias("second"), F.col("lang").alias("l"), F.col("word").alias("two")), "second", "first", counted=pairs)
    return named.where("lang = l").select("lang", F.concat_ws(" ", "one", "two").alias("phrase"), F.col("n").alias("f"))


def cut_fragments(text: str, lang: str, levels: np.ndarray, longest: int, bitmap: np.ndarray | None = None, triple_bitmap: np.ndarray | None = None, shortest: int = 2) -> list[bytes]:
    """The fragments of every frequent word with company, behind a byte that tells how many words stand before the pivot."""
    raw, starts, ends, key, level, pairs = _text_words(text, lang, levels)
    if len(key) < 2:
        return []
    found = _longer_hashes(key, key)
    if bitmap is not None:
        pairs &= _open(found, bitmap)
    triples = pairs[:-1] & pairs[1:]
    if triple_bitmap is not None:
        triples &= _open(_longer_hashes(found, key), triple_bitmap)
    # Higher is rarer.
    rarity = ((np.uint64(65535) - level) << np.uint64(47)) | (key >> np.uint64(17))
    left, right = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    # The d-th word on a side follows if all before it did, its pair or triple is open and it is no rarer.
    more = np.flatnonzero(pairs) + 1
    for d in range(1, longest):
        more = more[rarity[more - d] < rarity[more]]
        left[more] = d
        more = more[more > d]
        more = more[triples[more - d - 1]]
    more = np.flatnonzero(pairs)
    for d in range(1, longest):
        more = more[rarity[more + d] <= rarity[more]]
        right[more] = d
        more = more[more + d < len(pairs)]
        more = more[triples[more + d - 1]]
    # No frequent phrase goes across a pivot whose triple is not open: its sides are two fragments.
    at = np.flatnonzero(left + right)
    apart = at[(left[at] > 0) & (right[at] > 0)]
    apart = apart[~triples[apart - 1]]
    before, after = left[at], right[at]
    after[np.searchsorted(at, apart)] = 0
    at, before, after = np.concatenate([at, apart]), np.concatenate([before, 0 * apart]), np.concatenate([after, right[apart]])
    whole = before + after + 1 >= shortest
    at, before, after = at[whole], before[whole], after[whole]
    first, last = starts[at - before], ends[at + after]
    return [_BEFORE[n] + raw[a:z] for n, a, z in zip(before.tolist(), first.tolist(), last.tolist(), strict=True)]


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(_language(lang_col).alias("lang"), F.col(text_col).alias("text")).where("text <> ''")


def fragments(docs: DataFrame, levels: np.ndarray, bitmaps: tuple[np.ndarray, np.ndarray], least: int, longest: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, pivot, share, shares, before, fragment, n): the rewritten texts, equal ones of a task combined."""
    held = docs.sparkSession.sparkContext.broadcast((levels, *bitmaps))  # 2 * SLOTS and twice PAIR_BITS / 8 bytes

    def rows(lang: str, keys: list[bytes], n: list[int]) -> pd.DataFrame:
        before = [k[0] for k in keys]
        pivot = word_keys([k[1:].split(b" ")[b] for k, b in zip(keys, before, strict=True)], lang)
        level = levels_of(held.value[0], pivot).astype(np.float64)
        shares = np.ceil(least * np.exp2(level / STEPS) / SHARE_WORDS).astype(np.int64)
        share = (hash_words(keys) >> np.uint64(1)).astype(np.int64) % shares
        text = [k[1:].decode("utf-8") for k in keys]
        return pd.DataFrame({"lang": lang, "pivot": pivot.view(np.int64), "share": share, "shares": shares, "before": before, "fragment": text, "n": n})

    def rewrite(batches):
        found: dict[str, Counter] = {}

        def combined():
            for lang, own in found.items():
                keys, n = list(own), list(own.values())
                for i in range(0, len(keys), SENT):
                    yield rows(lang, keys[i : i + SENT], n[i : i + SENT])
            found.clear()

        for lang, text in _joined(batches):
            found.setdefault(lang, Counter()).update(cut_fragments(text, lang, held.value[0], longest, *held.value[1:], shortest=3))
            if sum(map(len, found.values())) >= COMBINED:
                yield from combined()
        yield from combined()

    return _texts(docs, text_col, lang_col).mapInPandas(rewrite, "lang string, pivot long, share long, shares long, before int, fragment string, n long")


def _spans(longest: int) -> str:
    """SQL: the (start, length) of all phrases of 3 words or more that hold word ``before`` of ``size`` words, looked up."""
    of = lambda before, size: [(a + 1, z - a + 1) for a in range(before + 1) for z in range(before, size) if 1 < z - a < longest]
    spans = lambda found: "array(" + ", ".join(f"struct({a} AS a, {n} AS n)" for a, n in found) + ")"
    rows = [spans(of(b, size) or [(1, 0)]) for b in range(longest) for size in range(2 * longest)]
    return f"array({', '.join(rows)})[before * {2 * longest} + size(w)]"


def frequent_phrases(docs: DataFrame, levels: np.ndarray, bitmaps: tuple[np.ndarray, np.ndarray], least: int, longest: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, f) of all phrases of 3 to ``longest`` words that occur ``least`` times."""
    key = ["lang", "pivot", "share", "shares"]
    routed = fragments(docs, levels, bitmaps, least, longest, text_col, lang_col).repartition("lang", "pivot", "share")
    # Grouping by more than the partitioning's columns moves nothing.
    routed = routed.groupBy(*key, "before", "fragment").agg(F.sum("n").alias("times")).withColumn("w", F.split("fragment", " "))
    mined = routed.select(*key, "times", "w", F.expr(f"inline({_spans(longest)})")).select(*key, "times", F.array_join(F.slice("w", F.col("a"), F.col("n")), " ").alias("phrase"))
    mined = mined.groupBy(*key, "phrase").agg(F.sum("times").alias("f"))
    whole = mined.where((F.col("shares") > 1) | (F.col("f") >= least))
    return whole.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, percent: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    By score, then frequency (both falling), then phrase.  Scores are exact decimals: floor(1000 a n / (l r)).
    """
    tune(docs.sparkSession)
    words = settle(word_counts(docs, text_col, lang_col), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))  # a row for each language
    frequent = words.where(F.col("f") >= least)
    levels = rarity_levels(frequent, least)
    pairs = frequent_pairs(docs, levels, least, text_col, lang_col)
    phrases = pair_phrases(pairs, frequent)
    if longest > 2:
        bitmap = pair_filter(pairs)
        bitmaps = bitmap, triple_filter(docs, levels, bitmap, least, text_col, lang_col)
        phrases = phrases.unionByName(frequent_phrases(docs, levels, bitmaps, least, longest, text_col, lang_col))
    phrases = settle(phrases, "phrases")
    # Keys of phrases and words alike; no word holds a tab.
    name = lambda phrase: F.concat(F.col("lang"), F.lit("\t"), phrase)
    counts = phrases.select(name(F.col("phrase")).alias("key"), "f").unionByName(frequent.select(name(F.col("word")).alias("key"), "f"))
    size = F.size(F.split("phrase", " "))
    longer = phrases.withColumn("w", F.split("phrase", " ")).withColumn("k", F.size("w")).where("k > 2")
    inside = longer.select("lang", "f", F.explode(F.array(*[F.array_join(F.slice("w", F.lit(i), F.col("k") - 1), " ") for i in (1, 2)])).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = phrases.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("f")))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w")).withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    part = lambda start, n: name(F.array_join(F.slice("w", start, n), " "))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.size("w")).alias("rest"))
    cuts = settle(cuts, "phrase-cuts")
    # Many phrases may begin or end with one word.
    scored = joined_spread(cuts, counts.select(F.col("key").alias("first"), F.col("f").alias("l")), "first", "phrase")
    scored = joined_spread(scored, counts.select(F.col("key").alias("rest"), F.col("f").alias("r")), "rest", "phrase", counted=cuts)
    scored = scored.join(F.broadcast(totals), "lang")
    scored = scored.withColumn("score", F.expr("(cast(a as decimal(17,0)) * cast(n as decimal(17,0)) * 1000BD) div (cast(l as decimal(17,0)) * cast(r as decimal(17,0)))"))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = weakest.withColumn("rank", place).where(F.col("rank") <= top)  # tasks send on their first ``top`` of each language
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])
