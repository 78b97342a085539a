"""Queries of composite flows, and of single operators that only flows use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import citations, filters, merge, ranking, resolve
from ..sources import normalize
from . import pipelines
from . import records as R
from .queries import _KEY, SQL, VOCAB, _NON_EN, _PRIORITY, _WATERFALL, _doi, _snip, _tok, _waterfall_sql, backfill_waterfall, query

c = F.col


def _raw_schema() -> str:
    return "source string, query string, payload_json string"


@query(f"WITH {R.REC} SELECT ord FROM rec WHERE trim(COALESCE(title, '') || COALESCE(abstract, '')) <> ''")
def rows_with_text(spark, sf):
    r = R.records(spark, sf)
    return r.where(F.length(text.row_text(c("title"), F.lit(None).cast("string"), c("abstract"))) > 0).select("ord")


@query(f"WITH {R.REC}, f AS (SELECT ord, CASE WHEN COALESCE(trim(abstract), '') = '' AND ord % 2 = 0 THEN 'uid ' || ord ELSE abstract END AS abstract FROM rec) SELECT ord, abstract, {_snip('abstract')} AS abstract_snippet FROM f")
def uid_fill(spark, sf):
    """Backfill with nothing cached and no lookups: identifiers of one kind are filled from a table, others are not."""
    r = R.records(spark, sf).withColumn("id", F.when(c("ord") % 2 == 0, F.concat(F.lit("WOS:"), c("ord"))).otherwise(c("id")))
    table = r.select(c("id").alias("key"), F.concat(F.lit("uid "), c("ord")).alias("text"))
    raw = spark.createDataFrame([], _raw_schema())
    return pipelines.backfill(r, raw, [], table).select("ord", "abstract", "abstract_snippet")


_SCORED = f"{R.LABELS}, s AS (SELECT rec.id, ord, relevance_llm, CASE WHEN ord % 5 <> 0 THEN (ord * 7919) % 1000 END AS embed_score FROM rec JOIN lab ON lab.id = rec.id)"


def _labelled(spark, sf) -> DataFrame:
    r = R.records(spark, sf).join(R.labels(spark, sf), "id")
    return r.withColumn("embed_score", F.when(c("ord") % 5 != 0, c("ord") * 7919 % 1000))


@query(f"WITH {R.REC}, {_SCORED} SELECT id FROM s WHERE relevance_llm = 'core' ORDER BY embed_score DESC NULLS LAST, id LIMIT 20")
def top_seeds(spark, sf):
    return citations.seeds_from_labels(_labelled(spark, sf)).select("id")


@query(f"WITH {R.REC} SELECT id, title, authors, type, cited_by_count FROM rec")
def available_columns(spark, sf):
    return filters.available(R.records(spark, sf), ["id", "none", "title", "authors", "notes", "type", "cited_by_count"])


@query("SELECT o_custkey AS key, min(o_orderkey) AS ord FROM orders GROUP BY 1")
def first_of_key(spark, sf):
    return resolve.first_by(R.table(spark, sf, "orders").select(c("o_custkey").alias("key"), c("o_orderkey").alias("ord")), "key", "ord")


@query(f"WITH {R.REC}, {_SCORED}, r AS (SELECT id, embed_score, row_number() OVER (ORDER BY embed_score DESC NULLS LAST, id) AS place FROM s) SELECT id, place FROM r")
def nulls_last_rank(spark, sf):
    rows = _labelled(spark, sf).select("id", "embed_score")
    return ranking.global_rank(rows, [c("embed_score").desc_nulls_last(), c("id")]).select("id", "place")


@query(f"WITH {R.REC}, two AS (SELECT 0 AS s, 'hal:' || ord AS id, 'h' || lpad(CAST(ord % 7 AS VARCHAR), 2, '0') AS q, ord FROM rec WHERE ord % 2 = 0 UNION ALL SELECT 1, 'core:' || ord, 'c' || lpad(CAST(ord % 5 AS VARCHAR), 2, '0'), ord FROM rec WHERE ord % 2 = 1) "
       "SELECT id, row_number() OVER (ORDER BY s, q, id) AS ord FROM two")
def harvest_order(spark, sf):
    """Two sources' records in one order: source, query, place in the reply, identifier."""
    r, n = R.records(spark, sf), c("ord").cast("string")
    hal = r.where("ord % 2 = 0").select(F.lit("hal").alias("source"), F.concat(F.lit("h"), F.lpad((c("ord") % 7).cast("string"), 2, "0")).alias("query"),
                                        F.concat(F.lit('{"response":{"docs":[{"docid":"'), n, F.lit('","title_s":["T"]}]}}')).alias("payload_json"))
    core = r.where("ord % 2 = 1").select(F.lit("core").alias("source"), F.concat(F.lit("c"), F.lpad((c("ord") % 5).cast("string"), 2, "0")).alias("query"),
                                         F.concat(F.lit('{"results":[{"id":'), n, F.lit(',"title":"T"}]}')).alias("payload_json"))
    return normalize.harvest(core.unionByName(hal), ["hal", "core"]).select("id", "ord")


@query(f"WITH {R.REC}, all_ AS (SELECT 'openalex:' || ord AS id, 'Work ' || ord AS title, publication_year, language, type, cited_by_count, open_access_url, ord FROM rec) "
       "SELECT id, title FROM all_ WHERE lower(COALESCE(type, '')) NOT IN ('paratext', 'erratum', 'editorial', 'letter') AND ord % 10 <> 1")
def harvest_pipeline(spark, sf):
    """Raw replies to a bibliography: types filtered, excluded DOIs dropped after resolving."""
    r, n = R.records(spark, sf), c("ord").cast("string")
    work = F.struct(F.concat(F.lit("openalex:"), n).alias("id"), F.concat(F.lit("10.9/"), n).alias("doi"), F.concat(F.lit("Work "), n).alias("display_name"), "publication_year", "language", "type")
    raw = r.select(F.lit("openalex").alias("source"), F.concat(F.lit("q"), c("ord") % 3).alias("query"), F.to_json(F.struct(F.array(work).alias("results"))).alias("payload_json"))
    gone = r.where("ord % 10 = 1").select(F.concat(F.lit(" 10.9/"), n).alias("doi"))
    return pipelines.harvest(raw, ["openalex"], {"link": {"and": ["and"]}}, (), gone).select("id", "title")


@query(f"WITH {R.REC} SELECT id FROM rec WHERE ord % 2 = 0 UNION ALL SELECT 'new:' || ord FROM rec WHERE ord % 2 = 1 AND ord % 3 < 2 AND lower(COALESCE(type, '')) NOT IN ('editorial', 'letter')")
def add_queries(spark, sf):
    """Records of two of three queries, appended to a corpus that lacks them."""
    r, n = R.records(spark, sf), c("ord").cast("string")
    key = F.when(c("ord") % 2 == 0, c("id")).otherwise(F.concat(F.lit("new:"), n))
    work = F.struct(key.alias("id"), F.concat(F.lit("Work "), n).alias("display_name"), "type")
    raw = r.select(F.lit("openalex").alias("source"), F.concat(F.lit("q"), c("ord") % 3).alias("query"), F.to_json(F.struct(F.array(work).alias("results"))).alias("payload_json"))
    corpus = r.where("ord % 2 = 0").withColumn("priority_score", F.when(c("ord") % 4 == 0, 2))
    return pipelines.add_queries(corpus, raw, ["q0", "q1"], {"link": {"and": ["and"]}}).select("id")


@query(f"WITH {R.REC}, {R.SECOND}, k AS (SELECT DISTINCT {_doi('doi')} AS d FROM sec WHERE doi IS NOT NULL) SELECT rec.id, {_NON_EN.replace('language', 'rec.language')} AS non_english, CASE WHEN rec.doi IS NULL THEN 'no_doi' WHEN {_doi('rec.doi')} IN (SELECT d FROM k) THEN 'in_corpus' ELSE 'new' END AS novelty FROM rec")
def gap_novelty(spark, sf):
    """Found records, each twice, against a corpus."""
    r = R.records(spark, sf)
    twice = r.unionByName(r.withColumn("ord", c("ord") + (1 << 45)).withColumn("doi", F.lit(None).cast("string")))
    return pipelines.gap_novelty(twice, R.second_corpus(spark, sf), {"link": {"and": ["and"]}}).select("id", "non_english", "novelty")


@query(f"WITH {R.REC}, {_SCORED}, r AS (SELECT *, row_number() OVER (ORDER BY ord) AS p FROM s WHERE embed_score >= 300 AND embed_score < 700) SELECT s.ord, COALESCE(r.p <= 15, false) AS labelled FROM s LEFT JOIN r ON r.ord = s.ord")
def label_pipeline(spark, sf):
    """Offline labels for the first rows of a score band, joined to all rows."""
    rows = _labelled(spark, sf).drop("relevance_llm", "toxic")
    return pipelines.label(rows, 300, 700, 15).select("ord", c("relevance_llm").isNotNull().alias("labelled"))


_WATER = _waterfall_sql()
_PASSES = [name for name, _ in _WATERFALL]


@query(
    f"WITH w AS ({_WATER}), t AS (SELECT count(*) AS n, count(*) FILTER (WHERE filled_by IS NULL AND COALESCE(trim(abstract), '') <> '') AS had FROM w), "
    f"p AS (SELECT 0 AS step, 'start' AS pass UNION ALL SELECT * FROM (VALUES {', '.join(f'({i}, {chr(39)}{n}{chr(39)})' for i, n in enumerate(_PASSES, 1))}) AS v(step, pass)), "
    "f AS (SELECT step, pass, CASE WHEN step = 0 THEN (SELECT had FROM t) ELSE (SELECT count(*) FROM w WHERE w.filled_by = p.pass) END AS filled FROM p) "
    "SELECT CAST(step AS INTEGER) AS step, pass, CAST(filled AS BIGINT) AS filled, CAST(sum(filled) OVER (ORDER BY step) AS BIGINT) AS covered, round(100.0 * sum(filled) OVER (ORDER BY step) / (SELECT n FROM t), 6) AS percent FROM f"
)
def coverage_by_pass(spark, sf):
    """Texts after each pass of the waterfall."""
    out = merge.coverage_by_pass(backfill_waterfall(spark, sf), _PASSES)
    return out.select("step", "pass", "filled", "covered", F.round("percent", 6).alias("percent"))


@query(f"WITH {R.REC} SELECT count(*) FILTER (WHERE ord % 2 = 0) AS before, count(*) AS after, count(*) FILTER (WHERE ord % 2 = 1) AS net_new FROM rec")
def net_new(spark, sf):
    r = R.records(spark, sf).select("ord", "id")
    return merge.net_new(r.where("ord % 2 = 0"), merge.union_by_name(r.where("ord % 2 = 0"), r.where("ord % 2 = 1")))


@query(f"WITH {R.REC}, l AS (SELECT *, {_PRIORITY} AS score FROM rec) SELECT ord, CAST(score AS INTEGER) AS priority_score, length({_snip('abstract')}) AS snippet_length, publication_year AS year FROM l")
def augment_columns(spark, sf):
    done = filters.augment(R.records(spark, sf), VOCAB)
    return done.select("ord", "priority_score", F.length("abstract_snippet").alias("snippet_length"), "year")


def _compare_sql() -> str:
    pairs = (
        "CAST(count(*) AS DOUBLE) / (any_value(x.n) + any_value(y.n) - count(*)) AS s FROM lw x JOIN rw y ON x.w = y.w GROUP BY 1, 2, 3"
    )
    return (
        f"WITH RECURSIVE {R.REC}, {R.SECOND}, l AS MATERIALIZED (SELECT ord, {_doi('doi')} AS d, {_tok('title')} AS t FROM rec), r AS MATERIALIZED (SELECT ord, {_doi('doi')} AS d, {_tok('title')} AS t FROM sec), "
        "both_ AS (SELECT d FROM l WHERE d IS NOT NULL INTERSECT SELECT d FROM r WHERE d IS NOT NULL), "
        "lf AS (SELECT * FROM l WHERE d IS NULL OR d NOT IN (SELECT d FROM both_)), rf AS (SELECT * FROM r WHERE d IS NULL OR d NOT IN (SELECT d FROM both_)), "
        "lw AS (SELECT ord, d IS NULL AS late, len(t) AS n, unnest(t) AS w FROM lf), rw AS (SELECT ord, d IS NULL AS late, len(t) AS n, unnest(t) AS w FROM rf), "
        f"p AS (SELECT x.ord AS a, y.ord AS b, y.late, any_value(x.late) AS a_late, {pairs}), "
        "q AS MATERIALIZED (SELECT a, list(b ORDER BY s DESC, late, b) AS near, row_number() OVER (ORDER BY any_value(a_late), a) AS i FROM p WHERE s >= CAST(0.85 AS DOUBLE) GROUP BY a), "
        "step(i, a, b, used) AS (SELECT 0::BIGINT, NULL::BIGINT, NULL::BIGINT, []::BIGINT[] UNION ALL SELECT i, a, b, CASE WHEN b IS NULL THEN used ELSE list_append(used, b) END FROM "
        "(SELECT q.i, q.a, list_filter(q.near, lambda x: NOT list_contains(step.used, x))[1] AS b, step.used FROM step JOIN q ON q.i = step.i + 1)), "
        "m AS (SELECT a, b FROM step WHERE b IS NOT NULL) "
        "SELECT 'left' AS side, ord, CASE WHEN d IN (SELECT d FROM both_) THEN 'overlap_doi' WHEN ord IN (SELECT a FROM m) THEN 'overlap_title' ELSE 'only' END AS status FROM l "
        "UNION ALL SELECT 'right', ord, CASE WHEN d IN (SELECT d FROM both_) THEN 'overlap_doi' WHEN ord IN (SELECT b FROM m) THEN 'overlap_title' ELSE 'only' END FROM r"
    )


COMPARE_SQL = SQL["corpus_compare"] = _compare_sql()
_KEYS = f"""WITH RECURSIVE {R.REC}, k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY ord) AS i, ord, {_KEY} AS key FROM rec),
s(i, used) AS (SELECT 0::BIGINT, []::VARCHAR[] UNION ALL SELECT s.i + 1, list_append(s.used, list_filter(list_concat([k.key], list_transform(range(0, 300), lambda n: k.key || chr(CAST(97 + n AS INTEGER)))), lambda x: NOT list_contains(s.used, x))[1])
  FROM s JOIN k ON k.i = s.i + 1)
SELECT k.ord, u.used[k.i] AS bib_key FROM k, (SELECT used FROM s ORDER BY i DESC LIMIT 1) AS u"""
SQL["bibtex_keys"] = _KEYS


@query(f"WITH c AS ({COMPARE_SQL}) SELECT CASE WHEN status <> 'only' THEN 'overlap' WHEN side = 'left' THEN 'left_only' ELSE 'right_only' END AS part, count(*) AS n, CAST(sum(ord % 1000003) AS BIGINT) AS ords FROM c GROUP BY 1")
def comparison_tables(spark, sf):
    """How many rows, and which, each of the three tables of a comparison holds."""
    out = None
    for part, df in pipelines.comparison_tables(R.records(spark, sf), R.second_corpus(spark, sf)).items():
        one = df.select(F.lit(part).alias("part"), "ord")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(c("ord") % 1000003).alias("ords"))


@query(
    "WITH seeds AS (SELECT o_orderkey AS id FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20), cited AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_orderkey IN (SELECT id FROM seeds)), "
    "citing AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 8 + l_linenumber, l_orderkey) AS k FROM lineitem WHERE l_partkey IN (SELECT id FROM seeds)) "
    "SELECT id FROM cited UNION SELECT id FROM citing WHERE k <= 500"
)
def chase_works(spark, sf):
    """Works one citation away from the seeds, both ways, each once."""
    edges = R.citation_edges(spark, sf)
    seeds = R.table(spark, sf, "orders").orderBy(c("o_totalprice").desc(), "o_orderkey").limit(20).select(c("o_orderkey").alias("id"))
    return citations.forward(edges, seeds).unionByName(citations.backward(edges, seeds)).distinct()
