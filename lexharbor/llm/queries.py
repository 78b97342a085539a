"""Queries of the training-data operators: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontaminate, exact_dedup, fim, langid, licences, mixing, near_dedup, packing, quality, suffix_dedup, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licences.scan_documents(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.array_join("families", ",").alias("families"), "n_paragraphs", "first_paragraph", F.round("probability", 4).alias("probability"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "item_id", *[F.round(c, 6).alias(c) for c in ("cosine", "subsequence", "weighted", "answer")], "first_word")


def op3_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat.rotate_perspectives(_table(spark, sf_dir, "conversations"))
    return views.select(
        "conv_id", "perspective", "piece", "n_turns", "text",
        F.array_join(F.transform("masks", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"))), ",").alias("masks"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(index).select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.shard_documents(_table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.train(docs.where(F.coalesce(~held_out, F.lit(True))))
    out = langid.identify(docs, model)
    held_out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return out.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), (F.col("id") == component).alias("kept"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c, 256)
    back = fim.restored(F.col("output"), F.col("form"))
    return out.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest(back).alias("restored_sha256"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reason")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the top of the repository, beside the package

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_licences": op1_licences,
    "op2_decontaminate": op2_decontaminate,
    "op3_chat_perspectives": op3_chat_perspectives,
    "op4_warc": op4_warc,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_shards": op7_shards,
    "op8_language": op8_language,
    "op9_near_dedup": op9_near_dedup,
    "op10_mix": op10_mix,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_quality_rules": op12_quality_rules,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}

SQL = {
    "op3_chat_perspectives": r"""
WITH r AS (SELECT conv_id, turn, COALESCE(NULLIF(trim(regexp_replace(role, '[\r\n]+|<\|', ' ', 'g')), ''), 'unknown') AS speaker,
    replace(COALESCE(text, ''), '<|im_', '<|im\_') AS said FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM r WHERE speaker <> 'system'),
v AS (SELECT r.*, p.perspective, r.speaker = p.perspective AS own, CAST(0 AS BIGINT) AS piece,
    '<|im_start|>' || CASE WHEN r.speaker = 'system' THEN 'system' WHEN r.speaker = p.perspective THEN 'assistant' ELSE 'user name=' || r.speaker END || chr(10) AS head,
    r.said || '<|im_end|>' AS body FROM r JOIN p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
w AS (SELECT *, COALESCE(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, piece ORDER BY turn, speaker, said
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS a FROM v)
SELECT conv_id, perspective, piece, CAST(count(*) AS INTEGER) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY turn, speaker, said) AS text,
    COALESCE(string_agg(CASE WHEN own THEN CAST(CAST(a AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(a + length(body) AS BIGINT) AS VARCHAR) END, ',' ORDER BY turn, speaker, said), '') AS masks
FROM w GROUP BY conv_id, perspective, piece""",
    "op4_warc": """
WITH p AS (SELECT page_id, COALESCE(html, '') AS h, octet_length(encode(COALESCE(html, ''))) AS payload_bytes FROM pages),
g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM g""",
    "op5_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
    doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256 FROM d""",
    "op9_near_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)""",
    "op11_fill_in_middle": r"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t, sha256('7:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
l AS (SELECT *, CASE WHEN t = '' THEN [] ELSE regexp_extract_all(t, '[^\n]*\n|[^\n]+') END AS l, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (SELECT *, array_to_string(l[1:a], '') AS p, array_to_string(l[a + 1:b], '') AS m, array_to_string(l[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM p""",
    "op13_collocations": r"""
WITH d AS (SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM p, range(1, 6) AS s(m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 100),
i AS (SELECT lang, f, unnest([array_to_string(w[1:m - 1], ' '), array_to_string(w[2:m], ' ')]) AS phrase FROM c WHERE m > 2),
k AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.lang = c.lang AND i.phrase = c.phrase AND i.f >= c.f)),
u AS (SELECT lang, phrase, f AS a, w, m, unnest(range(1, m)) AS cut FROM k),
s AS (SELECT u.lang, u.phrase, u.a, u.cut, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * u.a * t.n) // (x.f::HUGEINT * y.f) AS score FROM u
    JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[1:u.cut], ' ') JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[u.cut + 1:u.m], ' ') JOIN t ON t.lang = u.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM b QUALIFY rank <= 2000""",
}
