"""A query for each operator over the driver's tables, with the same result as DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bibtex, nested, text
from ..operators import citations, filters, incremental, labels, merge, ranking, reports, resolve, simjoin, vectors
from ..operators._storage import saved, scratch
from ..sources import archive
from . import records as R

# ------------------------------------------------------------------ configuration of the queries
VOCAB = {
    "article": {"english": ["the", "a"], "french": ["le", "la", "les"], "german": ["der", "die", "das"], "none": []},
    "link": {"and": ["and", "et", "und", "y"], "accented": ["été", "für"]},
}
BLOCK = ("anea", "ément")
MIN_SCORE = 0.3

_stop = "[" + ", ".join(f"'{w}'" for w in text.STOPWORDS) + "]"
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"


def _doi(c: str) -> str:
    return rf"nullif(regexp_replace(lower(trim({c})), '^(https://doi\.org/|http://doi\.org/|doi\.org/|doi:)', ''), '')"


def _tok(c: str) -> str:
    return f"list_filter(list_distinct(regexp_extract_all(lower(COALESCE({c}, '')), '[a-z0-9À-ɏЀ-ӿ]+')), lambda x: len(x) > 1 AND NOT list_contains({_stop}, x))"


def _collapse(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '{_WS}+', ' ', 'g'), '^ | $', '', 'g')"


def _snip(c: str) -> str:
    s = _collapse(f"COALESCE({c}, '')")
    return f"substring({s}, 1, 400) || CASE WHEN length({s}) > 400 THEN '…' ELSE '' END"


def _tags(c: str, vocab: dict) -> str:
    cases = [rf"CASE WHEN regexp_matches({c}, '(^|[^\p{{L}}\p{{N}}_])({'|'.join(s)})([^\p{{L}}\p{{N}}_]|$)', 'i') THEN '{t}' END" for t, s in vocab.items() if s]
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


_HAY = "(COALESCE(title, '') || ' ' || COALESCE(abstract, ''))"
_blocked = " OR ".join(f"contains(lower(COALESCE(title, '')), '{b}')" for b in BLOCK)
_NON_EN = "COALESCE(lower(language) NOT IN ('en', 'eng', 'english'), false)"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ------------------------------------------------------------------ scalars
@query(f"WITH {R.REC} SELECT * FROM rec")
def record_view(spark: SparkSession, sf: str) -> DataFrame:
    return R.records(spark, sf)


@query(f"WITH {R.REC} SELECT ord, {_doi('doi')} AS norm_doi FROM rec")
def doi_normalize(spark, sf):
    return R.records(spark, sf).select("ord", text.normalize_doi(F.col("doi")).alias("norm_doi"))


@query(f"WITH {R.REC} SELECT ord, array_to_string(list_sort({_tok('title')}), ' ') AS tokens FROM rec")
def title_tokens(spark, sf):
    return R.records(spark, sf).select("ord", F.array_join(F.array_sort(text.title_tokens(F.col("title"))), " ").alias("tokens"))


@query(f"WITH {R.REC} SELECT ord, {_snip('abstract')} AS snippet FROM rec")
def snippet(spark, sf):
    return R.records(spark, sf).select("ord", text.snippet(F.col("abstract")).alias("snippet"))


@query(
    r"""WITH t AS (SELECT page_id, list_transform(regexp_extract_all(html, '[<>]|[^<>]+'), lambda x: {'t': x, 'd': 0::BIGINT, 'o': ''}) AS p FROM pages),
f AS (SELECT page_id, list_reduce(p, lambda a, x: {'t': '', 'd': CASE x.t WHEN '<' THEN a.d + 1 WHEN '>' THEN greatest(a.d - 1, 0) ELSE a.d END,
  'o': a.o || CASE WHEN x.t NOT IN ('<', '>') AND a.d = 0 THEN x.t ELSE '' END}, {'t': '', 'd': 0::BIGINT, 'o': ''}) AS r FROM t)
SELECT page_id, """
    + _collapse("r.o")
    + " AS plain FROM f"
)
def strip_html_depth(spark, sf):
    return R.table(spark, sf, "pages").select("page_id", text.strip_markup(F.col("html")).alias("plain"))


@query(f"SELECT page_id, {_collapse('''regexp_replace(html, '<[^>]+>', ' ', 'g')''')} AS plain FROM pages")
def strip_tags_regex(spark, sf):
    return R.table(spark, sf, "pages").select("page_id", text.strip_tags(F.col("html")).alias("plain"))


def _words_in(words: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words.replace("grãos?", "grãos|grão").split("|"))
    return rf"len(list_distinct(list_filter(regexp_split_to_array(lower(title), '[^\p{{L}}\p{{N}}_]+'), lambda w: w IN ({listed}))))"


@query(
    f"WITH {R.REC} SELECT ord, CASE WHEN title IS NULL OR title = '' THEN NULL WHEN regexp_matches(title, '[Ѐ-ӿ]') THEN 'ru' WHEN regexp_matches(title, '[一-鿿ぁ-ヿ]') THEN 'zh' "
    f"WHEN {_words_in(text.GERMAN_WORDS)} >= 2 THEN 'de' WHEN {_words_in(text.PORTUGUESE_WORDS)} >= 2 THEN 'pt' WHEN {_words_in(text.FRENCH_WORDS)} >= 2 THEN 'fr' ELSE 'en' END AS inferred FROM rec"
)
def infer_language(spark, sf):
    return R.records(spark, sf).select("ord", text.infer_language(F.col("title")).alias("inferred"))


@query(f"WITH {R.REC} SELECT ord, " + ", ".join(f"array_to_string({_tags(_HAY, v)}, '|') AS {a}_mentioned" for a, v in VOCAB.items()) + " FROM rec")
def vocab_tags(spark, sf):
    hay = text.haystack(F.col("title"), F.col("abstract"))
    return R.records(spark, sf).select("ord", *[F.array_join(text.vocab_tags(hay, v), "|").alias(f"{a}_mentioned") for a, v in VOCAB.items()])


@query(
    rf"WITH {R.REC}, k AS (SELECT ord, id, nullif(lower(regexp_replace(regexp_replace(trim(COALESCE(doi, '')), '^https://doi\.org/', ''), '^(?i)doi:', '')), '') AS d FROM rec) "
    "SELECT ord, array_to_string(list_filter([id, CASE WHEN contains(id, '/') THEN string_split(id, '/')[-1] END, d, 'doi:' || d], lambda x: x IS NOT NULL), ' ') AS keys FROM k"
)
def candidate_keys(spark, sf):
    return R.records(spark, sf).select("ord", F.array_join(text.candidate_keys(F.col("id"), F.col("doi")), " ").alias("keys"))


@query(f"WITH {R.REC}, s AS (SELECT *, {_snip('abstract')} AS sn FROM rec) SELECT ord, trim(concat_ws(' ', nullif(title, ''), COALESCE(nullif(sn, ''), nullif(abstract, '')))) AS row_text FROM s")
def row_text(spark, sf):
    return R.records(spark, sf).select("ord", text.row_text(F.col("title"), text.snippet(F.col("abstract")), F.col("abstract")).alias("row_text"))


@query(
    f"WITH {R.REC}, s AS (SELECT *, {_snip('abstract')} AS sn, array_to_string({_tags(_HAY, VOCAB['article'])}, '|') AS tags FROM rec) "
    "SELECT ord, concat_ws(chr(10), 'TITLE: ' || trim(COALESCE(title, '')), CASE WHEN COALESCE(language, '') <> '' THEN 'LANGUAGE: ' || language END, "
    f"CASE WHEN tags <> '' THEN 'MINERALS_DETECTED_BY_REGEX: ' || tags END, 'ABSTRACT: ' || COALESCE(nullif(regexp_replace(COALESCE(abstract, ''), '^{_WS}+|{_WS}+$', '', 'g'), ''), nullif(sn, ''), '(none)')) AS prompt FROM s"
)
def label_prompt(spark, sf):
    r = R.records(spark, sf)
    tags = F.array_join(text.vocab_tags(text.haystack(F.col("title"), F.col("abstract")), VOCAB["article"]), "|")
    return r.select("ord", text.label_prompt(F.col("title"), F.col("language"), tags, F.col("abstract"), text.snippet(F.col("abstract"))).alias("prompt"))


@query(
    "SELECT conv_id, turn, concat_ws(chr(10), 'TITLE: ' || role, 'ABSTRACT: ' || COALESCE(nullif(regexp_replace(text, '^"
    + _WS
    + "+|"
    + _WS
    + "+$', '', 'g'), ''), '(none)')) AS prompt FROM conversations"
)
def turn_prompts(spark, sf):
    none = F.lit(None).cast("string")
    return R.table(spark, sf, "conversations").select("conv_id", "turn", text.label_prompt(F.col("role"), none, none, F.col("text"), none).alias("prompt"))


# ------------------------------------------------------------------ nested extraction
@query(f"WITH {R.REC} SELECT ord, nullif(array_to_string(list_filter(regexp_split_to_array(title, '{_WS}+'), lambda x: x <> ''), ' '), '') AS rebuilt FROM rec")
def inverted_index_text(spark, sf):
    words = F.filter(F.split(F.col("title"), f"{text.WS}+"), lambda w: w != "")
    spots = lambda w: F.filter(F.transform(words, lambda x, i: F.when(x == w, i)), lambda p: p.isNotNull())
    index = F.map_from_entries(F.transform(F.array_distinct(words), lambda w: F.struct(w, spots(w))))
    return R.records(spark, sf).select("ord", nested.inverted_index_text(index).alias("rebuilt"))


@query(
    f"""WITH {R.REC} SELECT ord, title, CASE WHEN ord % 4 <> 3 THEN doi END AS doi, CASE WHEN ord % 3 = 2 THEN NULL ELSE publication_year END AS year,
CASE WHEN ord % 3 = 0 THEN language ELSE COALESCE(language, 'x') END AS language, 'First, A; Second, B' AS authors, cited_by_count AS cited,
CASE ord % 3 WHEN 0 THEN 'one two' WHEN 1 THEN 'one' END AS abstract, 'Article' AS doctype FROM rec"""
)
def variant_paths(spark, sf):
    """The same path as object, list or scalar, read back by the extraction functions."""
    r = R.records(spark, sf)
    three = F.col("ord") % 3
    js = lambda c: F.coalesce(F.to_json(F.struct(c.alias("x"))), F.lit("{}"))
    quoted = lambda c: F.when(c.isNull(), F.lit("null")).otherwise(F.regexp_extract(js(c), r'^\{"x":(.*)\}$', 1))
    title = F.concat(F.lit('{"type":"item","content":'), quoted(F.col("title")), F.lit("}"))
    many = lambda one: F.when(three == 0, one).otherwise(F.concat(F.lit('[{"type":"other"},'), one, F.lit("]")))
    lang = F.when(three == 0, F.col("language")).otherwise(F.coalesce("language", F.lit("x")))
    doc = F.concat(
        F.lit('{"UID":"WOS:1","static_data":{"summary":{"titles":{"title":'), many(title),
        F.lit('},"names":{"name":[{"role":"author","display_name":"First, A"},{"role":"editor","display_name":"No, N"},{"full_name":"Second, B"}]},"pub_info":'),
        F.when(three == 0, F.concat(F.lit('{"@pubyear":'), F.col("publication_year"), F.lit("}"))).when(three == 1, F.concat(F.lit('{"pubyear":"'), F.col("publication_year"), F.lit('"}'))).otherwise('"none"'),
        F.lit(',"doctypes":{"doctype":'), F.when(three == 0, '"Article"').otherwise('["Article","Other"]'),
        F.lit('}},"fullrecord_metadata":{"languages":{"language":'),
        F.when(three == 0, F.concat(F.lit('{"content":'), quoted(lang), F.lit("}"))).otherwise(F.concat(F.lit('[{"content":'), quoted(lang), F.lit("}]"))),
        F.lit('},"abstracts":{"abstract":'),
        F.when(three == 0, '{"abstract_text":{"p":["one","two"]}}').when(three == 1, '[{"abstract_text":{"p":"one"}}]').otherwise('"text"'),
        F.lit('}}},"dynamic_data":{"cluster_related":{"identifiers":{"identifier":'),
        F.when(F.col("ord") % 4 != 3, many(F.concat(F.lit('{"type":"DOI","value":'), quoted(F.col("doi")), F.lit("}")))).otherwise('"gone"'),
        F.lit('}},"citation_related":{"tc_list":{"silo_tc":{"@local_count":'), quoted(F.col("cited_by_count")), F.lit("}}}}}"),
    )
    v = F.col("v")
    return r.withColumn("v", nested.variant(doc)).select(
        "ord", nested.wos_title(v).alias("title"), nested.wos_doi(v).alias("doi"), nested.wos_year(v).alias("year"), nested.wos_language(v).alias("language"),
        nested.wos_authors(v).alias("authors"), nested.wos_citations(v).alias("cited"), nested.wos_abstract(v).alias("abstract"), nested.wos_doctype(v).alias("doctype"),
    )


@query(
    """SELECT doc_id AS ord, CASE WHEN doc_id % 4 = 3 THEN 'error' ELSE 'core' END AS relevance_llm, CASE WHEN doc_id % 4 = 3 THEN '' ELSE 'sieve|' || quality END AS methods_llm,
CASE WHEN doc_id % 4 = 3 THEN false ELSE toxic = 1 END AS is_review_llm, CASE WHEN doc_id % 4 = 3 THEN 'unparseable reply' ELSE 'because ' || doc_id END AS label_rationale,
CASE WHEN doc_id % 4 = 3 THEN 'not_applicable' ELSE '' END AS climate_zone_llm FROM labels"""
)
def json_label_parse(spark, sf):
    t = R.table(spark, sf, "labels").withColumnRenamed("doc_id", "ord")
    body = F.concat(F.lit('{"relevance":"core","methods":["sieve","'), F.col("quality"), F.lit('"],"is_review":'), F.when(F.col("toxic") == 1, "true").otherwise("false"), F.lit(',"rationale":"because '), F.col("ord"), F.lit('"}'))
    four = F.col("ord") % 4
    reply = F.when(four == 0, body).when(four == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(four == 2, F.concat(F.lit("  "), body, F.lit(" \n"))).otherwise("no json")
    out = labels.with_labels(t.withColumn("reply", reply))
    return out.select("ord", "relevance_llm", "methods_llm", "is_review_llm", "label_rationale", "climate_zone_llm")


# ------------------------------------------------------------------ filters
@query(f"WITH {R.REC} SELECT ord FROM rec WHERE lower(COALESCE(type, '')) NOT IN ('paratext', 'erratum', 'editorial', 'letter') AND NOT ({_blocked})")
def spec_filter(spark, sf):
    return filters.spec_filter(R.records(spark, sf), BLOCK).select("ord")


_PRIORITY = (
    f"CASE WHEN {_NON_EN} THEN 3 ELSE 0 END + CASE WHEN contains(lower(COALESCE(type, '')), 'thesis') OR contains(lower(COALESCE(type, '')), 'dissertation') THEN 2 ELSE 0 END + "
    + " + ".join(f"CASE WHEN len({_tags(_HAY, v)}) > 0 THEN 1 ELSE 0 END" for v in VOCAB.values())
    + " + CASE WHEN cited_by_count < 10 THEN 1 ELSE 0 END + CASE WHEN COALESCE(open_access_url, '') <> '' THEN 1 ELSE 0 END"
)


@query(f"WITH {R.REC}, p AS (SELECT ord, id, {_NON_EN} AS non_english, {_PRIORITY} AS priority_score FROM rec) SELECT ord, non_english, CAST(priority_score AS INTEGER) AS priority_score, row_number() OVER (ORDER BY priority_score DESC, id) AS place FROM p")
def priority_rank(spark, sf):
    done = filters.augment(R.records(spark, sf), VOCAB).select("ord", "id", "non_english", "priority_score")
    return ranking.global_rank(done, [F.col("priority_score").desc(), F.col("id")]).drop("id")


@query(f"WITH {R.REC} SELECT ord FROM rec WHERE doi IS NULL OR lower(trim(doi)) NOT IN (SELECT lower(trim(doi)) FROM rec WHERE ord % 10 = 1 AND doi IS NOT NULL)")
def doi_exclude(spark, sf):
    r = R.records(spark, sf)
    return filters.exclude_dois(r, r.where("ord % 10 = 1").select("doi")).select("ord")


@query(f"WITH {R.REC} SELECT ord, CASE WHEN {_blocked} THEN 'blocked' WHEN len({_tags(_HAY, VOCAB['article'])}) = 0 THEN 'off_topic' WHEN {_tags(_HAY, VOCAB['article'])} = ['english'] THEN 'english_only' ELSE 'non_english' END AS relevance FROM rec")
def screen_relevance(spark, sf):
    return R.records(spark, sf).select("ord", filters.relevance(F.col("title"), F.col("abstract"), VOCAB["article"], "english", BLOCK).alias("relevance"))


# ------------------------------------------------------------------ entity resolution
@query(f"WITH {R.REC}, d AS (SELECT ord, {_doi('doi')} AS d FROM rec) SELECT ord, CASE WHEN d IS NULL THEN ord ELSE min(ord) OVER (PARTITION BY d) END AS leader FROM d")
def dedup_doi(spark, sf):
    return resolve.cluster_leaders(R.records(spark, sf).withColumn("title", F.lit(None).cast("string")))


_EDGES = f"""tok AS MATERIALIZED (SELECT ord, COALESCE(lower(language), '') AS b, {_doi('doi')} AS d, {_tok('title')} AS t FROM {{rec}}),
big AS (SELECT * FROM tok WHERE len(t) >= 6), w AS (SELECT ord, b, len(t) AS n, unnest(t) AS w FROM big),
shared AS (SELECT x.ord AS j, y.ord AS i, any_value(x.n) AS nj, any_value(y.n) AS ni, count(*) AS k FROM w x JOIN w y ON x.b = y.b AND x.w = y.w AND x.ord < y.ord GROUP BY 1, 2),
e AS MATERIALIZED (SELECT j, i, CAST(k AS DOUBLE) / (nj + ni - k) AS s FROM shared WHERE CAST(k AS DOUBLE) / (nj + ni - k) >= CAST(0.85 AS DOUBLE))"""


@query(
    f"WITH {R.REC}, {_EDGES.format(rec='rec')}, k AS (SELECT o, count(*) AS n FROM (SELECT j AS o FROM e UNION ALL SELECT i FROM e) GROUP BY o) "
    "SELECT ord, min(ord) OVER (PARTITION BY b, list_sort(t)) AS class_id, COALESCE(k.n, 0) AS n_links FROM big LEFT JOIN k ON k.o = big.ord"
)
def title_jaccard_links(spark, sf):
    """Records with enough title tokens: their class of equal token sets, and how many records are similar."""
    r = R.records(spark, sf).select("ord", F.coalesce(F.lower("language"), F.lit("")).alias("bucket"), F.array_sort(text.title_tokens(F.col("title"))).alias("tokens"))
    return simjoin.similarity_links(r.where(F.size("tokens") >= 6), 0.85).select("ord", "class_id", "n_links")


def _resolved(rec: str, extra: str = "") -> str:
    """DuckDB text of the resolution of ``rec``, by stepping through its rows in order."""
    return f"""WITH RECURSIVE {R.REC}{extra}, {_EDGES.format(rec=rec)},
num AS (SELECT ord, row_number() OVER (ORDER BY ord) AS i, d FROM tok),
x AS MATERIALIZED (SELECT n.ord, n.i, CASE WHEN d IS NOT NULL THEN lag(n.i) OVER (PARTITION BY d ORDER BY n.i) END AS dj,
  COALESCE((SELECT list(m.i ORDER BY m.i) FROM e JOIN num m ON e.j = m.ord WHERE e.i = n.ord), []) AS nb FROM num n),
r(i, l) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
  SELECT x.i, list_append(r.l, COALESCE(CASE WHEN x.dj IS NOT NULL THEN r.l[x.dj] END, list_filter(x.nb, lambda j: r.l[j] = j)[1], x.i)) FROM r JOIN x ON x.i = r.i + 1),
fin AS (SELECT unnest(l) AS li, generate_subscripts(l, 1) AS i FROM (SELECT l FROM r ORDER BY i DESC LIMIT 1)),
c AS (SELECT s.*, lead.ord AS leader FROM fin JOIN x ON x.i = fin.i JOIN x lead ON lead.i = fin.li JOIN {rec} s ON s.ord = x.ord),
g AS (SELECT leader, array_to_string(list_sort(list(DISTINCT source_database)), '|') AS source_databases,
  arg_min(authors, ord) FILTER (WHERE COALESCE(authors, '') <> '' AND len(string_split(authors, ';')) <= 25) AS good FROM c GROUP BY leader)
SELECT s.ord, s.id, s.title, s.doi, CASE WHEN COALESCE(s.authors, '') <> '' AND len(string_split(s.authors, ';')) <= 25 THEN s.authors ELSE COALESCE(g.good, s.authors) END AS authors, g.source_databases
FROM g JOIN {rec} s ON s.ord = g.leader"""


@query(_resolved("rec"))
def dedup_full(spark, sf):
    return resolve.resolve(R.records(spark, sf)).select("ord", "id", "title", "doi", "authors", "source_databases")


@query(_resolved("rec"))
def dedup_idempotent(spark, sf):
    once = saved(resolve.resolve(R.records(spark, sf)), "resolved")
    return resolve.resolve(once).select("ord", "id", "title", "doi", "authors", "source_databases")


@query(_resolved("main2", f", {R.SECOND}, main2 AS (SELECT * FROM rec UNION ALL BY NAME SELECT * FROM sec)"))
def gapfill_merge(spark, sf):
    return merge.gap_fill_merge(R.records(spark, sf), R.second_corpus(spark, sf)).select("ord", "id", "title", "doi", "authors", "source_databases")


@query(_resolved("main2", f", {R.SECOND}, main2 AS (SELECT * FROM rec UNION ALL BY NAME SELECT * FROM sec)"))
def gapfill_incremental(spark, sf):
    """The second corpus in two batches against an index of the first."""
    second = R.second_corpus(spark, sf)
    batches = [R.records(spark, sf), second.where(F.col("ord") < 1 << 41), second.where(F.col("ord") >= 1 << 41)]
    return incremental.resolve_in_batches(batches, scratch(spark, "leaders")).select("ord", "id", "title", "doi", "authors", "source_databases")


# ------------------------------------------------------------------ joins and merges
@query(f"WITH {R.REC}, {R.LABELS} SELECT COALESCE(relevance_llm, '(none)') AS value, count(*) AS n FROM rec LEFT JOIN lab USING (id) GROUP BY 1")
def label_join(spark, sf):
    return reports.value_counts(labels.join_labels(R.records(spark, sf), R.labels(spark, sf)), "relevance_llm", null_as="(none)")


@query(f"WITH {R.REC} SELECT ord FROM rec WHERE ord % 4 <> 0")
def pending_antijoin(spark, sf):
    r = R.records(spark, sf)
    return filters.pending(r, r.where("ord % 4 = 0").select("id")).select("ord")


@query("WITH log AS (SELECT doc_id, 1 AS chunk, quality FROM labels UNION ALL SELECT doc_id, 2, 1 - quality FROM labels WHERE doc_id % 3 = 0) SELECT doc_id AS id, arg_max(quality, chunk) AS quality, max(chunk) AS chunk FROM log GROUP BY 1")
def checkpoint_last_wins(spark, sf):
    t = R.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")
    log = t.withColumn("chunk", F.lit(1)).unionByName(t.where("id % 3 = 0").select("id", (1 - F.col("quality")).alias("quality")).withColumn("chunk", F.lit(2)))
    return labels.last_checkpoint(log).select("id", F.col("quality").cast("int").alias("quality"), "chunk")


@query(f"WITH {R.REC}, {R.SECOND}, old AS (SELECT * FROM rec WHERE ord % 3 <> 1) SELECT id FROM sec WHERE id NOT IN (SELECT id FROM old) AND ({_doi('doi')} IS NULL OR {_doi('doi')} NOT IN (SELECT {_doi('doi')} FROM old WHERE doi IS NOT NULL))")
def not_present_antijoin(spark, sf):
    return filters.not_present(R.second_corpus(spark, sf), R.records(spark, sf).where("ord % 3 <> 1")).select("id")


@query(f"WITH {R.REC}, {R.SECOND}, k AS (SELECT DISTINCT {_doi('doi')} AS d FROM rec WHERE ord % 3 <> 1 AND doi IS NOT NULL), t AS (SELECT CASE WHEN {_doi('doi')} IS NULL THEN 'no_doi' WHEN {_doi('doi')} IN (SELECT d FROM k) THEN 'in_corpus' ELSE 'new' END AS novelty, abstract FROM sec) SELECT novelty, count(*) AS n, count(*) FILTER (WHERE trim(COALESCE(abstract, '')) = '') AS n_no_abstract FROM t GROUP BY 1")
def novelty(spark, sf):
    return merge.novelty_counts(merge.novelty(R.second_corpus(spark, sf), R.records(spark, sf).where("ord % 3 <> 1")))


@query(f"WITH {R.REC}, n AS (SELECT {_doi('doi')} AS d, arg_max(source_database, ord) AS note FROM rec WHERE doi IS NOT NULL GROUP BY 1) SELECT ord, COALESCE(CASE WHEN ord % 2 = 0 THEN source_database END, note, '') AS source_databases FROM rec LEFT JOIN n ON n.d = {_doi('doi')}")
def source_recovery(spark, sf):
    r = R.records(spark, sf)
    notes = r.where("doi is not null").groupBy(text.normalize_doi(F.col("doi")).alias("doi")).agg(F.max_by("source_database", "ord").alias("note"))
    lost = r.withColumn("source_databases", F.when(F.col("ord") % 2 == 0, F.col("source_database")).otherwise(""))
    return merge.recover_sources(lost, notes).select("ord", "source_databases")


@query(f"WITH {R.REC}, cache AS (SELECT CASE ord % 2 WHEN 0 THEN id ELSE {_doi('doi')} END AS key, 'cached ' || ord AS t, ord FROM rec WHERE ord % 11 = 0 AND ord % 3 <> 0), "
       f"k AS (SELECT r.ord, COALESCE((SELECT min(t) FROM cache c WHERE c.key = r.id), (SELECT min(t) FROM cache c WHERE c.key = {_doi('r.doi')})) AS t FROM rec r WHERE r.ord % 11 = 0) "
       "SELECT rec.ord, COALESCE(rec.abstract, k.t) AS abstract FROM rec LEFT JOIN k USING (ord)")
def cache_fill(spark, sf):
    r = R.records(spark, sf)
    own = r.where("ord % 11 = 0 and ord % 3 <> 0").select(F.when(F.col("ord") % 2 == 0, F.col("id")).otherwise(text.normalize_doi(F.col("doi"))).alias("key"), F.concat(F.lit("cached "), F.col("ord")).alias("text"))
    cache = own.groupBy("key").agg(F.min("text").alias("text"))
    return merge.fill_from_cache(r, cache).select("ord", "abstract")


def _waterfall_sql() -> str:
    parts, prev = [f"WITH {R.REC}, s0 AS (SELECT ord, {_doi('doi')} AS d, abstract, CAST(NULL AS VARCHAR) AS filled_by FROM rec)"], "s0"
    for k, (name, cap) in enumerate(_WATERFALL, 1):
        parts.append(
            f"src{k} AS (SELECT {_doi('doi')} AS d, min('{name} ' || md5(id)) AS t FROM rec WHERE ord % 5 = {k - 1} AND doi IS NOT NULL GROUP BY 1), "
            f"ask{k} AS (SELECT ord, d FROM {prev} WHERE COALESCE(trim(abstract), '') = '' AND d IS NOT NULL ORDER BY ord LIMIT {cap}), "
            f"s{k} AS (SELECT p.ord, p.d, COALESCE(g.t, p.abstract) AS abstract, CASE WHEN g.t IS NOT NULL THEN '{name}' ELSE p.filled_by END AS filled_by "
            f"FROM {prev} p LEFT JOIN (SELECT ask{k}.ord, t FROM ask{k} JOIN src{k} USING (d)) g ON g.ord = p.ord)"
        )
        prev = f"s{k}"
    return ", ".join(parts) + f" SELECT ord, abstract, filled_by FROM {prev}"


_WATERFALL = [("openalex", 6000), ("crossref", 6000), ("semantic_scholar", 3000), ("europepmc", 2000)]


@query(_waterfall_sql())
def backfill_waterfall(spark, sf):
    """The caps are a feature of the operator: lookups of one run."""
    r = R.records(spark, sf)
    tables = []
    for k, (name, cap) in enumerate(_WATERFALL):
        t = r.where((F.col("ord") % 5 == k) & F.col("doi").isNotNull()).groupBy(text.normalize_doi(F.col("doi")).alias("doi"))
        tables.append((name, t.agg(F.min(F.concat(F.lit(name + " "), F.md5("id"))).alias("text")), cap))
    return merge.waterfall(r, tables).select("ord", "abstract", "filled_by")


@query()
def corpus_compare(spark, sf):
    """Its DuckDB text steps through the left rows in order."""
    return merge.compare_corpora(R.records(spark, sf), R.second_corpus(spark, sf))


@query(f"WITH {R.REC}, {R.SECOND}, l AS (SELECT DISTINCT {_doi('doi')} AS d FROM rec WHERE doi IS NOT NULL), r AS (SELECT DISTINCT {_doi('doi')} AS d FROM sec WHERE doi IS NOT NULL) "
       f"SELECT 'left' AS side, ord FROM rec WHERE {_doi('doi')} IN (SELECT d FROM r) UNION ALL SELECT 'right', ord FROM sec WHERE {_doi('doi')} IN (SELECT d FROM l)")
def doi_overlap(spark, sf):
    out = None
    pair = [df.withColumn("_d", text.normalize_doi(F.col("doi"))) for df in (R.records(spark, sf), R.second_corpus(spark, sf))]
    for side, one, other in (("left", *pair), ("right", *pair[::-1])):
        hit = one.where("_d is not null").join(other.select("_d"), "_d", "left_semi").select(F.lit(side).alias("side"), "ord")
        out = hit if out is None else out.unionByName(hit)
    return out


@query(f"WITH {R.REC} SELECT id, source_databases, cited_by_count, abstract FROM (SELECT id, source_database AS source_databases, cited_by_count, NULL AS abstract FROM rec WHERE ord % 2 = 0 UNION ALL SELECT id, NULL, NULL, abstract FROM rec WHERE ord % 2 = 1)")
def union_by_name(spark, sf):
    r = R.records(spark, sf)
    main = r.where("ord % 2 = 0").select("id", F.col("source_database").alias("source_databases"), "cited_by_count")
    return merge.union_by_name(main, r.where("ord % 2 = 1").select("abstract", "id"))


# ------------------------------------------------------------------ citations
_SEEDS = "seeds AS (SELECT o_orderkey AS id FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)"


def _seeds(spark, sf):
    return R.table(spark, sf, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20).select(F.col("o_orderkey").alias("id"))


@query(f"WITH {_SEEDS} SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_orderkey IN (SELECT id FROM seeds)")
def citation_backward(spark, sf):
    return citations.backward(R.citation_edges(spark, sf), _seeds(spark, sf))


@query(f"WITH {_SEEDS}, cited AS (SELECT DISTINCT l_partkey AS p FROM lineitem WHERE l_orderkey IN (SELECT id FROM seeds)), "
       "n AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 8 + l_linenumber, l_orderkey) AS k FROM lineitem WHERE l_partkey IN (SELECT p FROM cited)) SELECT DISTINCT id FROM n WHERE k <= 500")
def citation_forward(spark, sf):
    edges = R.citation_edges(spark, sf)
    return citations.forward(edges, citations.backward(edges, _seeds(spark, sf)))


@query("WITH c AS (SELECT o_custkey AS g, o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(floor(o_totalprice) AS INTEGER) AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders) "
       "SELECT g, arg_max(id, struct_pack(a := -abs(y - 1995), b := k, c := -p)) AS id FROM c WHERE p <= 25 GROUP BY g")
def seed_argmax(spark, sf):
    o = R.table(spark, sf, "orders").select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("publication_year"), F.floor("o_totalprice").cast("int").alias("cited_by_count"))
    return citations.best_match(o, "g", F.lit(1995), 25, "id")


# ------------------------------------------------------------------ vectors and reports
@query("SELECT vec_id, round(sqrt(list_inner_product(e, e)), 6) AS length, round(e[1], 6) AS first FROM (SELECT vec_id, " + R._UNIT.format(v="embedding") + " AS e FROM embeddings)")
def vector_normalize(spark, sf):
    e = R.table(spark, sf, "embeddings").select("vec_id", vectors.unit(F.col("embedding")).alias("e"))
    return e.select("vec_id", F.round(vectors.norm(F.col("e")), 6).alias("length"), F.round(F.get("e", F.lit(0)), 6).alias("first"))


@query(f"WITH {R.ANCHORS}, {R.SIMS} SELECT vec_id AS ord, round(embed_score, 6) AS embed_score, embed_top_anchor FROM best")
def anchor_max_cosine(spark, sf):
    return R.scored(spark, sf).select("ord", F.round("embed_score", 6).alias("embed_score"), "embed_top_anchor")


@query(f"WITH {R.ANCHORS}, {R.SIMS}, q AS (SELECT quantile_cont(embed_score, 0.75) AS p75 FROM best) SELECT count(*) AS n, round(min(embed_score), 6) AS min, round(quantile_cont(embed_score, 0.5), 6) AS median, "
       "round(any_value(p75), 6) AS p75, round(quantile_cont(embed_score, 0.9), 6) AS p90, round(max(embed_score), 6) AS max, count(*) FILTER (WHERE embed_score >= p75) AS n_p75 FROM best, q")
def anchor_score_stats(spark, sf):
    s = reports.score_stats(R.scored(spark, sf))
    return s.select(*[F.round(c, 6).alias(c) if c not in ("n", "n_p75") else c for c in s.columns])


@query(f"WITH {R.ANCHORS}, {R.SIMS}, a AS (SELECT * FROM best WHERE embed_score >= {MIN_SCORE}) SELECT anchor_idx, count(embed_score) AS n, round(quantile_cont(embed_score, 0.5), 6) AS median, "
       "round(quantile_cont(embed_score, 0.1), 6) AS p10, round(quantile_cont(embed_score, 0.9), 6) AS p90, round(max(embed_score), 6) AS max FROM anc LEFT JOIN a ON a.embed_top_anchor = anchor_idx GROUP BY anchor_idx")
def anchor_coverage(spark, sf):
    c = reports.anchor_coverage(R.scored(spark, sf), R.anchors(spark, sf), MIN_SCORE)
    return c.select("anchor_idx", "n", *[F.round(x, 6).alias(x) for x in ("median", "p10", "p90", "max")])


@query(f"WITH {R.ANCHORS}, {R.SIMS} SELECT count(*) AS n, count(*) FILTER (WHERE embed_score >= {MIN_SCORE}) AS n_above, round(100.0 * count(*) FILTER (WHERE embed_score >= {MIN_SCORE}) / count(*), 6) AS percent_above FROM best")
def anchor_totals(spark, sf):
    t = reports.global_totals(R.scored(spark, sf), MIN_SCORE)
    return t.withColumn("percent_above", F.round("percent_above", 6))


@query(f"WITH {R.ANCHORS}, {R.SIMS}, r AS (SELECT *, row_number() OVER (PARTITION BY embed_top_anchor ORDER BY embed_score DESC, vec_id) AS rank FROM best WHERE embed_score >= {MIN_SCORE}) SELECT vec_id AS ord, embed_top_anchor, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3")
def anchor_topk(spark, sf):
    return reports.anchor_topk(R.scored(spark, sf), 3, MIN_SCORE).select("ord", "embed_top_anchor", "rank")


@query(f"WITH {R.REC}, {R.ANCHORS}, {R.SIMS} SELECT r.ord, b.embed_score >= 0.5 AS strong FROM rec r JOIN best b ON b.vec_id = r.ord WHERE b.embed_score >= {MIN_SCORE} AND b.embed_score < 0.9")
def score_band(spark, sf):
    s = R.records(spark, sf).join(R.scored(spark, sf), "ord")
    return filters.score_band(s, MIN_SCORE, 0.9).select("ord", (F.col("embed_score") >= 0.5).alias("strong"))


@query(f"WITH {R.REC} SELECT language AS value, count(*) AS n FROM rec WHERE language IS NOT NULL GROUP BY 1")
def value_counts_language(spark, sf):
    return reports.value_counts(R.records(spark, sf), "language")


@query(f"WITH {R.REC} SELECT COALESCE(type, 'unknown') AS value, count(*) AS n FROM rec GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def value_counts_type_top10(spark, sf):
    return reports.value_counts(R.records(spark, sf), "type", null_as="unknown").orderBy(F.col("n").desc(), "value").limit(10)


# ------------------------------------------------------------------ sinks
_KEY = """lower(COALESCE(nullif(regexp_replace(trim(string_split(string_split(COALESCE(authors, ''), ';')[1], ',')[1]), '[^A-Za-z]+', '', 'g'), ''), 'anon') || publication_year ||
COALESCE(nullif(substring(regexp_replace(string_split(COALESCE(trim(title), ''), ' ')[1], '[^A-Za-z0-9]+', '', 'g'), 1, 20), ''), 'untitled'))"""


def _esc(c: str) -> str:
    return rf"replace(replace(replace({c}, '\', '\\'), '{{', '\{{'), '}}', '\}}')"


@query(
    rf"""WITH {R.REC}, f AS (SELECT *, {_KEY} AS key,
CASE WHEN lower(COALESCE(type, '')) IN ('thesis', 'dissertation') THEN 'phdthesis' WHEN lower(COALESCE(type, '')) = 'book-chapter' THEN 'incollection' ELSE 'article' END AS kind FROM rec)
SELECT ord, '@' || kind || '{{' || key || ',' || chr(10) || '  ' || concat_ws(',' || chr(10) || '  ', 'title = {{' || nullif({_esc('trim(title)')}, '') || '}}',
'author = {{' || nullif(array_to_string(string_split(authors, '; '), ' and '), '') || '}}', 'year = {{' || publication_year || '}}', 'journal = {{Journal}}', 'doi = {{' || doi || '}}',
'url = {{' || open_access_url || '}}', 'language = {{' || language || '}}', 'note = {{' || source_database || '}}') || chr(10) || '}}' || chr(10) AS entry FROM f"""
)
def bibtex_entries(spark, sf):
    r = R.records(spark, sf).withColumn("year", F.col("publication_year")).withColumnRenamed("source_database", "source_databases")
    key = bibtex.entry_key(r["authors"], r["year"], r["publication_year"], r["title"])
    return r.select("ord", bibtex.entry(r, key).alias("entry"))


@query()
def bibtex_keys(spark, sf):
    """Keys made unique in row order; the DuckDB text steps through the rows."""
    r = R.records(spark, sf).withColumn("year", F.col("publication_year"))
    return bibtex.with_keys(r, "ord").select("ord", "bib_key")


@query("SELECT lang AS source, 'q' || (doc_id % 10) AS query, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1, 2")
def raw_archive_roundtrip(spark, sf):
    """Raw payloads written as compressed Parquet, verified, and read back."""
    d = R.table(spark, sf, "documents").select(F.col("lang").alias("source"), F.concat(F.lit("q"), (F.col("doc_id") % 10).cast("string")).alias("query"), F.col("text").alias("payload_json"))
    back = archive.archive_verified(d)
    return back.groupBy("source", "query").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("payload_json")).alias("chars"))


from . import file_queries, flow_queries, source_queries  # noqa: E402, F401  (they add their queries)
