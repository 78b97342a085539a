"""Removal of repeated strings with suffix arrays.

Every byte that a string of ``LENGTH`` bytes covers which also starts earlier (smaller identifier,
or same document and earlier start) is removed; strings are judged on the input.

1. Copies of whole texts are settled by digest: only the first enters what follows.
2. Every window of LENGTH bytes selects an anchor, the smallest-hash ``GRAM``-byte string in it, so
   equal windows select equal anchors.  Anchors that occur once cannot hold a repeat and are left out
   (anchors are counted over the whole corpus; a fixed-size filter carries the result to the texts).
3. The windows of one anchor occurrence are a region.  Equal regions are settled by their first
   occurrence.  The distinct regions of an anchor meet in one shard.
4. A shard builds its suffix array by Larsson-Sadakane refinement (doubling, only groups that are not
   yet singletons are sorted again) and the common prefixes by Kasai's carry, in step over regions.
   Neighbours that share LENGTH bytes are one string; its first start stays.
5. An anchor with more than ``HOT_REGIONS`` distinct regions is split over shards; the strings each of
   them keeps are merged by binary search in sorted runs.

Defined results: null text is empty; texts below LENGTH bytes are never cut; null identifiers come
last; rows that repeat an identifier and its text are one document and get the same result; different
texts under one identifier are different documents, ordered by digest; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, settle, spread_join, tune, with_membership
from .shingles import mix

LENGTH, GRAM = 100, 32
#: Bits of the filters that the texts meet: 16 MiB each whatever the input is.
FILTER_BITS = 1 << 27
#: Bytes of regions that one suffix array is built over, and regions of one anchor in one shard.
SHARD_BYTES, HOT_REGIONS = 1 << 20, 8000
#: Longest stretch of a text whose anchors are selected at once.
STRETCH = 1 << 18
_LAST = (1 << 63) - 1
_POS = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below ``n`` at least."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, b in enumerate((_BASE, _INV)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def anchors(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, first start): maximal runs of windows of ``b`` that select one anchor; a run ends where the next starts."""
    keys, firsts = [], []
    for at in range(0, max(len(b) - LENGTH + 1, 0), STRETCH):
        part = b[at : at + STRETCH + LENGTH - 1]
        power, inverse = _power_tables(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=total[1:])
        n = len(part) - GRAM + 1
        h = mix((total[GRAM:] - total[:n]) * inverse[:n])
        # Sliding minimum over w grams: running minima from both ends of blocks of w.
        w = LENGTH - GRAM + 1
        v = (h & ~_POS) | np.arange(n, dtype=np.uint64)
        padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:n] = v
        blocks = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = len(part) - LENGTH + 1
        least = np.minimum(behind[:starts], ahead[w - 1 : w - 1 + starts])
        place = (least & _POS).astype(np.int64)
        cut = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate([[0], cut])
        keys.append(h[place[first]])
        firsts.append(first + at)
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys).view(np.int64), np.concatenate(firsts)


def _region_ends(first: np.ndarray, n: int) -> np.ndarray:
    """Where the regions of runs that start at ``first`` end in a text of ``n`` bytes."""
    return np.append(first[1:] - 1 + LENGTH, n)


def suffix_array(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of the suffixes of regions ``text[..ends[k]]``.

    A suffix ends with its region; what follows counts as a symbol of that region only, so all
    suffixes differ.  (Kasai's carry needs the full order, not one by the first LENGTH bytes.)
    """
    n = len(text)
    used = np.bincount(text, minlength=256) > 0
    width = max(1, int(used.sum()).bit_length())
    h = 62 // width  # symbols of the first sort
    end = np.repeat(ends, np.diff(np.concatenate([[0], ends]))).astype(np.int32)  # of each position's region
    left = end - np.arange(n, dtype=np.int32)
    pad = np.concatenate([np.cumsum(used)[text].astype(np.uint8), np.zeros(h, np.uint8)])
    key = np.zeros(n, dtype=np.uint64)
    for j in range(h):
        key <<= np.uint64(width)
        key |= np.where(left > j, pad[j : n + j], np.uint8(0))
    order = np.argsort(key, kind="stable").astype(np.int32)
    key = key[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    group = np.repeat(start, np.diff(np.concatenate([start, [n]]))).astype(np.int32)
    del key, left, pad
    rank = np.empty(n, dtype=np.int32)
    rank[order] = group
    while True:
        # Places (in the order) whose group has more than one suffix; a group's places are neighbours.
        same = group[1:] == group[:-1]
        open_ = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(open_):
            break
        suffix = order[open_]
        follow = suffix + h
        inside = follow < end[suffix]
        second = rank[np.minimum(follow, n - 1)].astype(np.int64) + n
        second[~inside] = np.searchsorted(ends, suffix[~inside], side="right")
        both = group[open_].astype(np.int64) * (2 * n) + second
        again = np.argsort(both, kind="stable")
        suffix, both = suffix[again], both[again]
        order[open_] = suffix
        differs = np.concatenate([[True], both[1:] != both[:-1]])
        # A group's first place stays its number; where a group splits, the later part starts at its own place.
        at = np.flatnonzero(differs)
        group[open_] = np.repeat(open_[at], np.diff(np.concatenate([at, [len(open_)]])))
        rank[suffix] = group[open_]
        h *= 2
    return order, rank


def common_prefixes(text: np.ndarray, ends: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """lcp[i]: bytes, up to ``most``, that suffix order[i] shares with order[i - 1] (Kasai).

    Kasai's carry (the next suffix shares at least one byte less) runs in step over all regions.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    starts = np.concatenate([[0], ends[:-1]])
    end = np.repeat(ends, ends - starts).astype(np.int32)
    lcp_at, held = np.zeros(n, dtype=np.int32), np.zeros(len(ends), dtype=np.int32)
    for t in range(int((ends - starts).max(initial=0))):
        lanes = np.flatnonzero(starts + t < ends)
        i = starts[lanes] + t
        j = before[i]
        m = np.where(j >= 0, np.maximum(held[lanes] - 1, 0), 0)
        room = np.where(j >= 0, np.minimum(np.minimum(end[i] - i, end[np.maximum(j, 0)] - j), most), 0)
        m = np.minimum(m, room)
        live = np.flatnonzero(m < room)
        while len(live):
            live = live[text[i[live] + m[live]] == text[j[live] + m[live]]]
            m[live] += 1
            live = live[m[live] < room[live]]
        held[lanes] = m
        lcp_at[i] = m
    return lcp_at[order]


def _raw(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "replace"), np.uint8)


def _filter_bits(rows: DataFrame, value: Column) -> np.ndarray:
    """Bits of ``value`` over ``rows``; at most FILTER_BITS / 8 bytes reach the driver, whatever the input is."""
    slot = F.pmod(value, F.lit(FILTER_BITS)) + 1
    pages = rows.groupBy(F.bitmap_bucket_number(slot).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    bits = np.zeros((FILTER_BITS // 32768, 4096), dtype=np.uint8)
    for page, got in pages.toLocalIterator():
        bits[page - 1] = np.frombuffer(bytes(got), np.uint8)
    return bits.ravel()


def _in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values % FILTER_BITS
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def repeated_starts(regions: list[bytes], ords: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every string of LENGTH bytes in ``regions``: (region, start in document, is its first start)."""
    text = np.frombuffer(b"".join(regions), dtype=np.uint8)
    ends = np.cumsum([len(r) for r in regions])
    order, _ = suffix_array(text, ends)
    lcp = common_prefixes(text, ends, order, LENGTH)
    bounds = np.concatenate([[0], ends])
    region_at = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(bounds))
    string = np.cumsum(lcp < LENGTH)  # suffixes with one number share LENGTH bytes
    region = region_at[order]
    full = ends[region] - order >= LENGTH
    region, string, order = region[full], string[full], order[full]
    start = begins[region] + order - bounds[region]
    first = np.ones(len(string), dtype=bool)
    same = string[1:] == string[:-1]
    several = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same])) if len(string) else np.zeros(0, np.int64)
    by = several[np.lexsort((start[several], ords[region[several]], string[several]))]
    region[several], start[several] = region[by], start[by]  # equal strings stand together, the earliest ahead
    first[several[1:]] = string[several[1:]] != string[several[:-1]]
    return region, start, first


def _ranges(region: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring starts of a region: (region, first byte, end of the last string)."""
    by = np.lexsort((start, region))
    region, start = region[by], start[by]
    new = np.concatenate([[True], (region[1:] != region[:-1]) | (start[1:] > start[:-1] + LENGTH)]) if len(region) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:] - 1, [len(region) - 1]]).astype(np.int64) if len(at) else at
    return region[at], start[at], start[last] + LENGTH


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_regions: int = HOT_REGIONS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) for every row.

    ``spans`` are the removed [start, end) byte ranges; ``kept`` the remaining text where some was
    removed (invalid bytes at cuts replaced), null where nothing was.
    """
    spark = docs.sparkSession
    tune(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("ord", F.coalesce("id", F.lit(_LAST))).withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    # Different texts under one identifier are told apart, and ordered, by the head of their digest.
    rows = rows.withColumn("tag", F.conv(F.substring("sha", 1, 15), 16, 10).cast("long"))
    meta = settle(rows.select("id", "ord", "tag", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "sx-meta")
    owner = settle(meta.groupBy("sha").agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "sx-copies")
    n_rows = meta.count()

    # Texts that enter the search: one row for each distinct text.
    judged = with_membership(rows.where(F.octet_length("text") >= LENGTH), "sha", owner, "sha", "maybe").select("ord", "tag", "sha", "text", "maybe")
    copies = spread_join(judged.where("maybe"), owner, "sha", "n", "ord", n_rows, "left")
    copies = copies.where("first is null or ord = first").select("ord", "tag", "text").dropDuplicates(["ord", "tag"])
    texts = judged.where("not maybe").select("ord", "tag", "text").unionByName(copies)

    def select_anchors(batches):
        for pdf in batches:
            found = [anchors(_raw(t)) for t in pdf["text"]]
            yield pdf.assign(keys=[key for key, _ in found], firsts=[first for _, first in found])

    texts = settle(texts.mapInPandas(select_anchors, "ord long, tag long, text string, keys array<long>, firsts array<int>"), "sx-texts")
    repeated = texts.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = spark.sparkContext.broadcast(_filter_bits(repeated, F.col("key")))

    def place_regions(batches):
        """Where repeated anchors are, and a digest of their regions; the bytes stay behind."""
        bits = held.value
        for pdf in batches:
            digs, parts = [], []
            for o, tag, text, key, first in zip(pdf["ord"].tolist(), pdf["tag"].tolist(), pdf["text"], pdf["keys"], pdf["firsts"], strict=True):
                k = np.flatnonzero(_in_filter(bits, key))
                if len(k):
                    raw, first = text.encode("utf-8", "replace"), first.astype(np.int64)
                    first, end = first[k], _region_ends(first, len(raw))[k]
                    digs += [hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(first.tolist(), end.tolist(), strict=True)]
                    parts.append((key[k], np.full(len(k), o), np.full(len(k), tag), first, end))
            if parts:
                yield pd.DataFrame({"dig": digs} | dict(zip(("key", "ord", "tag", "first", "end"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    regions = settle(texts.mapInPandas(place_regions, "dig binary, key long, ord long, tag long, first long, end long"), "sx-regions")
    spot = F.struct("ord", "tag", "first", "key")
    distinct = settle(regions.groupBy("dig").agg(F.min(spot).alias("at"), F.count(F.lit(1)).alias("n")), "sx-distinct")
    # Later occurrences of equal regions: all their strings start earlier in the first one.
    some = distinct.where("n > 1").select("dig", "n", F.struct("at.ord", "at.tag", "at.first").alias("kept"))
    later = spread_join(regions.drop("key"), some, "dig", "n", F.struct("ord", "first"), regions.count())
    later = later.where(F.struct("ord", "tag", "first") != F.col("kept"))
    later = settle(later.select("ord", "tag", F.col("first").alias("lo"), F.col("end").alias("hi")), "sx-later")
    discard(regions)

    # Anchors with several distinct regions: suffix arrays over the bytes of their first occurrences.
    busy = distinct.groupBy(F.col("at.key").alias("key")).agg(F.count(F.lit(1)).alias("d")).where("d > 1")
    work = settle(spread_join(distinct.select("dig", "at.*"), busy, "key", "d", "dig", distinct.count()), "sx-work")
    discard(distinct)
    # ``tag`` is a digest of the text, so its sum without carry with a start spreads well over the filter.
    held_work = spark.sparkContext.broadcast(_filter_bits(work, F.col("tag").bitwiseXOR(F.col("first"))))

    def cut_regions(batches):
        bits = held_work.value
        for pdf in batches:
            spots, cut = [], []
            for o, tag, text, first in zip(pdf["ord"].tolist(), pdf["tag"].tolist(), pdf["text"], pdf["firsts"], strict=True):
                first = first.astype(np.int64)
                k = np.flatnonzero(_in_filter(bits, first ^ tag))
                if len(k):
                    raw = text.encode("utf-8", "replace")
                    spots.append((np.full(len(k), o), np.full(len(k), tag), first[k]))
                    cut += [raw[x:y] for x, y in zip(first[k].tolist(), _region_ends(first, len(raw))[k].tolist(), strict=True)]
            if cut:
                yield pd.DataFrame(dict(zip(("ord", "tag", "first"), map(np.concatenate, zip(*spots, strict=True)), strict=True)) | {"region": cut})

    size = work.count()
    shards = int(size * (LENGTH + 40) // shard_bytes) + 1
    split = F.ceil(F.col("d") / F.lit(hot_regions)).cast("int")  # 1: the anchor is not hot
    hot = F.col("d") > hot_regions
    shard = F.when(hot, F.concat_ws(":", F.col("key"), F.pmod(F.xxhash64("dig"), split))).otherwise(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("string"))
    placed = work.select("ord", "tag", "first", hot.alias("hot"), shard.alias("shard"))
    cut_out = texts.select("ord", "tag", "text", "firsts").mapInPandas(cut_regions, "ord long, tag long, first long, region binary").join(placed, ["ord", "tag", "first"])

    parts = max(1, size // hot_regions) * 4
    ranges = "ord long, tag long, lo long, hi long"
    runs = "part int, strings binary, ords array<long>, tags array<long>, los array<long>"

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        """Covered ranges of a shard; a shard of a hot anchor also gives sorted runs of the strings it keeps."""
        ords = pd.factorize(pd.MultiIndex.from_arrays([pdf["ord"], pdf["tag"]]), sort=True)[0]
        begin, raw, own_ord, own_tag = pdf["first"].to_numpy(), list(pdf["region"]), pdf["ord"].to_numpy(), pdf["tag"].to_numpy()
        region, start, first = repeated_starts(raw, ords, begin)
        r, lo, hi = _ranges(region[~first], start[~first])
        rows = [(o, t, a, b, None, None, None, None, None) for o, t, a, b in zip(own_ord[r].tolist(), own_tag[r].tolist(), lo.tolist(), hi.tolist(), strict=True)]
        if pdf["hot"].iloc[0]:
            region, start = region[first], start[first]
            kept = np.array([raw[k][s - begin[k] : s - begin[k] + LENGTH] for k, s in zip(region, start, strict=True)], dtype=object)
            part = np.array([zlib.crc32(x) % parts for x in kept])
            for p in np.unique(part):
                at = np.flatnonzero(part == p)
                at = at[np.argsort(kept[at])]
                rows.append((None, None, None, None, int(p), b"".join(kept[at]), own_ord[region[at]], own_tag[region[at]], start[at]))
        out = pd.DataFrame(rows, columns=["ord", "tag", "lo", "hi", "part", "strings", "ords", "tags", "los"], dtype=object)
        return out.astype({c: "Int64" for c in ("ord", "tag", "lo", "hi", "part")})

    found = settle(cut_out.groupBy("shard").applyInPandas(build, f"{ranges}, {runs}"), "sx-found")
    discard(texts, work)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        """Merge sorted runs one by one: binary search tells which strings an earlier run has."""
        out, held, held_at = [], np.zeros(0, dtype=f"S{LENGTH + 1}"), []
        for strings, *at in pdf[["strings", "ords", "tags", "los"]].itertuples(index=False):
            run = np.array([strings[i : i + LENGTH] + b"\x01" for i in range(0, len(strings), LENGTH)], dtype=held.dtype)
            at = list(zip(*at, strict=True))
            place = np.searchsorted(held, run)
            known = (place < len(held)) & (held[np.minimum(place, len(held) - 1)] == run) if len(held) else np.zeros(len(run), bool)
            for i in np.flatnonzero(known).tolist():
                earlier, later = sorted((held_at[place[i]], at[i]))
                held_at[place[i]] = earlier
                out.append((*later, later[2] + LENGTH))
            fresh = np.flatnonzero(~known)
            where = place[fresh] + np.arange(len(fresh))
            grown = np.zeros(len(held) + len(fresh), dtype=held.dtype)
            old = np.ones(len(grown), dtype=bool)
            old[where] = False
            grown[where], grown[old] = run[fresh], held
            rest, new = iter(held_at), iter([at[i] for i in fresh.tolist()])
            held, held_at = grown, [next(rest) if o else next(new) for o in old.tolist()]
        return pd.DataFrame(out, columns=["ord", "tag", "lo", "hi"]).astype("int64")

    crossed = found.where("part is not null").groupBy("part").applyInPandas(merge, ranges)
    cover = later.unionByName(found.where("part is null").select("ord", "tag", "lo", "hi")).unionByName(crossed)
    cover = settle(cover.groupBy("ord", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("cover")), "sx-cover")
    discard(later, found)

    def cut(batches):
        for pdf in batches:
            out = []
            for o, tag, text, cover in zip(pdf["ord"], pdf["tag"], pdf["text"], pdf["cover"], strict=True):
                raw, spans = text.encode("utf-8", "replace"), []
                for lo, hi in sorted((c["lo"], c["hi"]) for c in cover):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], hi)
                    else:
                        spans.append([lo, hi])
                kept, at = [], 0
                for lo, hi in spans:
                    kept.append(raw[at:lo])
                    at = hi
                kept = b"".join([*kept, raw[at:]])
                out.append((o, tag, len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": a, "end": b} for a, b in spans], kept.decode("utf-8", "replace")))
            yield pd.DataFrame(out, columns=["ord", "tag", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    touched = with_membership(rows, "tag", cover, "tag", "maybe").where("maybe").select("ord", "tag", "text").join(cover, ["ord", "tag"]).dropDuplicates(["ord", "tag"])
    spans = "array<struct<start:long,end:long>>"
    touched = touched.mapInPandas(cut, f"ord long, tag long, n_removed long, n_spans long, kept_sha256 string, spans {spans}, kept string")
    copy = F.col("first").isNotNull() & (F.col("ord") != F.col("first")) & (F.col("n_bytes") >= LENGTH)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    out = spread_join(meta, owner, "sha", "n", "ord", n_rows, "left").join(touched, ["ord", "tag"], "left")
    return out.select(
        "id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("spans", F.array().cast(spans))).alias("spans"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
