"""Fill-in-middle, quality rules and collocations against plain loops, and their odd input."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexharbor.llm import collocations, fim, quality
from lexharbor.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, langs=None):
    rows = [(i, t, langs[i] if langs else "en", "a", 0) for i, t in enumerate(texts)]
    clash = ("id", "n", "form", "cuts", "words", "lines", "w", "f", "phrase", "rule", "h1", "output", "label", "l_id")
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(c) for c in clash})


# ------------------------------------------------------------------ fill in the middle
@pytest.mark.parametrize("unit", ["line", "char"])
def test_checkpoints_find_every_cut(unit, monkeypatch):
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice("aé\n\n漢𝄞x\r") for _ in range(rng.randrange(50)))
        units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
        monkeypatch.setattr(fim, "SCAN_BYTES", rng.choice([1, 3, 7, 1 << 20]))
        index = fim.checkpoints(text, unit, rng.choice([1, 2, 3, 5, 256]))
        assert index.n == len(units)
        for k in range(len(units) + 1):
            part = "".join(units[:k])
            assert index.cut(k) == (len(part.encode()), len(part))


def test_the_index_is_sparse():
    index = fim.checkpoints("x\n" * 100_000, every=256)
    assert len(index.units) == 1 + 100_000 // 256 and index.cut(99_999) == (199_998, 199_998)


def test_outputs_are_rebuilt(spark):
    rng = random.Random(5)
    texts = ["", None, "one", "a\nb\nc", "a <P> b", "<M>", "\n\n\n", "é\n漢\n" * 500, "<S", "P>\n<", "x" * 300_000 + "\n" + "y" * 300_000]
    texts += ["".join(rng.choice("ab<PSM>\n é") for _ in range(rng.randrange(80))) for _ in range(300)]
    docs = docs_of(spark, texts)
    docs = docs.unionByName(docs.where("doc_id < 20")).unionByName(docs.limit(5).withColumn("doc_id", F.lit(None).cast("long")))
    out = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = out.collect()
    assert len(got) == len(texts) + 25
    for r in got:
        if r["id"] is None:
            continue
        t = texts[r["id"]] or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", t)
        h = [int(hashlib.sha256(f"7:{r['id']}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
        a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        form = "plain" if not t or re.search("<[PSM]>", t) else "spm" if h[3] % 100 < 50 else "psm"
        want = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        assert (r["n"], r["form"], r["output"], r["back"]) == (len(units), form, want, t)
        assert (r["prefix_chars"], r["middle_chars"], r["prefix_bytes"]) == ((None, None, None) if form == "plain" else (len(p), len(m), len(p.encode())))
    chars = fim.fill_in_middle(docs, unit="char", rate=30).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert all(r["back"] == (texts[r["id"]] or "") for r in chars if r["id"] is not None)
    assert {r["form"] for r in chars} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, unit="page")


# ------------------------------------------------------------------ quality rules
def counts(t):
    t = t or ""
    w, seen, covered = WORD.findall(t), {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    for places in seen.values():
        for i in places if len(places) > 1 else ():
            covered.update(range(i, i + 8))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_statistics_match_a_plain_count(spark, sf):
    rng = random.Random(2)
    texts = [None, "", " \n\t\x0b", "a", "a " * 8, "a " * 9, "a b " * 40, "x\nx\n x\n\nx", "é#|漢\r\nb", "w " * 20_000 + "end"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += [" ".join(f"w{rng.randrange(5000)}" for _ in range(30)) + "\n" + " ".join(f"v{i}" for i in range(12)) * rng.randrange(4) for _ in range(50)]
    docs = docs_of(spark, texts)
    got = {r["id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality.statistics(docs).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}
    table = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r["doc_id"]: counts(r["text"]) for r in table.collect()}
    out = QUERIES["op12_quality_rules"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out} == want
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (r["reason"] is None) and not (r["base_failed"] and r["kept"])


def test_windows_are_compared_where_hashes_are_equal(spark, monkeypatch):
    """With a hash that tells nothing apart, the result is the same."""
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    texts = [" ".join(random.Random(i).choice("abc") for _ in range(50)) for i in range(30)]
    got = {r["id"]: r["n_repeat_words"] for r in quality.statistics(docs_of(spark, texts)).collect()}
    assert got == {i: counts(t)[4] for i, t in enumerate(texts)}


def test_rules_are_learned_in_order():
    rng = random.Random(1)
    blank = {name: 0.0 for name, _, _ in quality.STATISTICS}
    rows = []
    for i in range(900):
        kind = i % 10
        row = dict(blank, words=float(rng.randrange(20, 400)), upper_share=rng.random() * 0.2, symbols_per_word=rng.random() * 0.1, low=0)
        if kind == 0:
            row.update(upper_share=0.8 + rng.random() * 0.2, low=1)
        if kind == 1:
            row.update(symbols_per_word=0.7 + rng.random(), low=1)
        if kind == 2:  # noise that no rule should be kept for
            row["low"] = int(rng.random() < 0.1)
        rows.append(row)
    rng.shuffle(rows)
    rules = quality.learn_rules(rows)
    used = {c.statistic for rule in rules for c in rule}
    assert used == {"upper_share", "symbols_per_word"} and all(c.above for rule in rules for c in rule)
    assert rules == quality.learn_rules(rows)
    assert quality.learn_rules([]) == [] == quality.learn_rules([dict(r, low=0) for r in rows]) == quality.learn_rules([dict(r, low=1) for r in rows])


def test_the_first_rule_that_holds_names_the_verdict(spark):
    c = quality.Condition
    rules = [(c("words", False, 30.0), c("upper_share", True, 0.5)), (c("words", False, 40.0),)]
    texts = ["AB " * 25 + "zz", "ab " * 25, " ".join(f"w{i}" for i in range(25)), " ".join(f"W{i} X{i}" for i in range(11)), " ".join(f"w{i}" for i in range(60))]
    got = {r["id"]: (r["rule"], r["reason"], r["kept"]) for r in quality.quality_rules(docs_of(spark, texts), None, rules=rules).collect()}
    assert got[2] == (2, "words < 40", False) and got[3] == (1, "words < 30 and upper_share >= 0.5", False) and got[4] == (None, None, True)
    assert got[0][1:] == got[1][1:] == ("base", False)


def test_fit_is_bounded_and_takes_odd_labels(spark):
    rng = random.Random(4)
    good = [" ".join(f"w{rng.randrange(900)}" for _ in range(60)) for _ in range(120)]
    bad = [" ".join(f"w{rng.randrange(900)}###" for _ in range(60)) for _ in range(120)]
    docs = docs_of(spark, good + bad)
    docs = docs.unionByName(docs.where("doc_id >= 230")).unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(240)] + [(None, 1), (5, None), (10**9, 0), (7, 1)], "doc_id long, quality int").withColumn("label", F.lit("x"))
    rules = quality.fit(docs, labels)
    assert rules and {c.statistic for r in rules for c in r} <= {"symbols_per_word", "letter_share", "word_length"}
    kept = {r["id"]: r["kept"] for r in quality.quality_rules(docs, labels).where("id is not null").collect()}
    assert all(kept[i] == (i < 120) for i in range(240))
    seen = []
    original = quality.learn_rules
    quality.learn_rules = lambda rows: seen.append(len(rows)) or original(rows)
    try:
        quality.fit(docs, labels, rows=50)
        quality.fit(docs.withColumn("doc_id", F.lit(7).cast("long")), labels, rows=50)  # one identifier, many rows
    finally:
        quality.learn_rules = original
    assert max(seen) <= 50
    assert quality.fit(docs, labels.limit(0)) == [] == quality.fit(docs.limit(0), labels)
    assert quality.quality_rules(docs.limit(0), labels).collect() == []


def test_rules_hold_on_labels_that_they_have_not_seen(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    out = quality.quality_rules(docs, labels.where(half == 0)).join(labels.where(half == 1).withColumnRenamed("doc_id", "id"), "id").where("not base_failed")
    got = {(r["quality"], r["kept"]): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert got.get((1, False), 0) <= 0.02 * got[(1, True)]


# ------------------------------------------------------------------ collocations
def plain_collocations(rows, least, longest, top, percent=100):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    frequent = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    gone = set()
    for (lang, w), v in frequent.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and 100 * v >= percent * f[lang, w[i:j]]:
                    gone.add((lang, w[i:j]))
    found = collections.defaultdict(list)
    for (lang, w), a in frequent.items():
        if (lang, w) not in gone:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i, p.decode(), -a, x, y, n[lang], -s) for lang, own in found.items() for i, (s, a, p, x, y) in enumerate(sorted(own)[:top], 1)}


def as_set(df):
    return {(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("seed, percent", [(0, 100), (1, 100), (2, 60)])
def test_collocations_match_a_plain_count(spark, monkeypatch, seed, percent):
    rng = random.Random(seed)
    monkeypatch.setattr(collocations, "SHARE_WORDS", 40)  # frequent pivots are dealt over shares
    monkeypatch.setattr(collocations, "COMBINED", 50)
    words = ["the", "The", "of", "é", "new", "york", "x-y", "a", "b", "c|d", " ", "z<"]
    sep = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ; ", "\x0b"]
    texts = [None, "", " ", ".", "the", "the the the the the the the"] + ["".join(rng.choice(words) + rng.choice(sep) for _ in range(rng.randrange(40))) for _ in range(120)]
    texts += ["new york of the c|d a"] * 30
    langs = [rng.choice(["en", "en", "en", "de", None, ""]) for _ in texts]
    docs = docs_of(spark, texts, langs)
    for longest, top in ((5, 2000), (3, 7)):
        got = as_set(collocations.collocations(docs, least=6, longest=longest, top=top, percent=percent))
        assert got == plain_collocations(zip(texts, langs), 6, longest, top, percent) and got


def test_shared_slots_change_no_count(spark, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(f"w{int(rng.paretovariate(1))}" for _ in range(30)) for _ in range(150)]
    monkeypatch.setattr(collocations, "SLOTS", 4)
    monkeypatch.setattr(collocations, "PAIR_BITS", 1 << 15)
    docs = docs_of(spark, texts)
    assert as_set(collocations.collocations(docs, least=8)) == plain_collocations([(t, "en") for t in texts], 8, 5, 2000)
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_pivots_are_the_rarest_words(spark):
    """A fragment holds words that are more frequent than its pivot, and no more than four on a side."""
    texts = ["a a a a a a b a a a a a a c"] * 20 + ["a b"] * 10
    docs = docs_of(spark, texts)
    counts = collocations.word_counts(docs)
    levels = collocations.rarity_levels(counts.where("f >= 5"), 5)
    assert levels.dtype == np.uint16 and (levels > 0).sum() == 3
    out = collections.Counter((f[1:], f[0]) for t in texts for f in collocations.cut_fragments(t, "en", levels, 5))
    assert out[("a a a a b a a a a".encode(), 4)] == 20 and out[("a a a a c".encode(), 4)] == 20 and out[("a b".encode(), 1)] == 10
    assert all(set(f.split()) == {b"a"} for f, _ in out if b"b" not in f and b"c" not in f)


def test_scores_beyond_64_bits_are_exact(spark):
    got = spark.sql("select (cast(9000000000000001L as decimal(17,0)) * cast(90000000000000007L as decimal(17,0)) * 1000BD) div (cast(9000000000000003L as decimal(17,0)) * cast(9000000000000005L as decimal(17,0))) as s").first()["s"]
    assert got == 1000 * 9000000000000001 * 90000000000000007 // (9000000000000003 * 9000000000000005)


def test_only_frequent_triples_are_rewritten(spark):
    """Pairs are counted by their words, so texts without a frequent triple send no fragment."""
    texts = [f"a b. b c. c a. {x} {y} {z}." for x, y, z in [("a", "b", "c"), ("b", "c", "a"), ("c", "a", "b")] * 10]
    docs = docs_of(spark, texts)
    for least, sent in ((11, 0), (10, 30)):
        levels = collocations.rarity_levels(collocations.word_counts(docs).where(f"f >= {least}"), least)
        pairs = collocations.frequent_pairs(docs, levels, least)
        assert sorted(r["n"] for r in pairs.collect()) == [50, 50, 50]
        bitmap = collocations.pair_filter(pairs)
        bitmaps = bitmap, collocations.triple_filter(docs, levels, bitmap, least)
        got = collocations.fragments(docs, levels, bitmaps, least, 5).groupBy().sum("n").first()[0]
        assert (got or 0) == sent
        assert as_set(collocations.collocations(docs, least=least)) == plain_collocations([(t, "en") for t in texts], least, 5, 2000)
