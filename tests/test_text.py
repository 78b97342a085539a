import pytest
from pyspark.sql import functions as F

from lexharbor.functions import html, nested, text
from lexharbor.operators import filters


def one(spark, expr, **cells):
    df = spark.range(1)
    for k, v in cells.items():
        df = df.withColumn(k, F.lit(v).cast("string") if v is None or isinstance(v, str) else F.lit(v))
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, want", [(" HTTPS://doi.org/10.1/A ", "10.1/a"), ("doi:10.1/b", "10.1/b"), ("doi.org/doi:10.1/c", "doi:10.1/c"), ("http://dx.doi.org/10.1/d", "http://dx.doi.org/10.1/d"), ("", None), (None, None)])
def test_normalize_doi(spark, raw, want):
    assert one(spark, text.normalize_doi(F.col("c")), c=raw) == want


@pytest.mark.parametrize("raw, want", [("<a <b> c>d", "d"), ("x > y", "x y"), ("a <b c", "a"), ("<p>Hello</p>  <p>World</p>", "Hello World"), ("", ""), (None, ""), ("a<<>>b", "ab")])
def test_strip_markup(spark, raw, want):
    assert one(spark, text.strip_markup(F.col("c")), c=raw) == want


def test_tags_and_entities(spark):
    assert one(spark, html.strip_tags_unescape(F.col("c")), c="<jats:p>a &amp; b</jats:p><p>c</p>") == "a & b c"
    assert one(spark, text.strip_tags(F.col("c")), c="a  b\x1cc") == "a b c"


@pytest.mark.parametrize("title, want", [("Étude des sols dans les Alpes", "fr"), ("Die Form der Körner", "de"), ("Análise do solo", "pt"), ("Песок", "ru"), ("砂粒", "zh"), ("A plain title", "en"), ("der der der", "en"), (None, None), ("", None)])
def test_infer_language(spark, title, want):
    assert one(spark, text.infer_language(F.col("c")), c=title) == want


def test_vocab_tags_keep_order_and_boundaries(spark):
    vocab = {"b": ["étude"], "a": ["sol", "c++"], "none": []}
    assert one(spark, text.vocab_tags(F.col("c"), vocab), c="Le SOL, l'ÉTUDE") == ["b", "a"]
    assert one(spark, text.vocab_tags(F.col("c"), vocab), c="xétude solar") == []
    assert one(spark, text.vocab_tags(F.col("c"), vocab), c="in C++ only") == ["a"]


def test_years(spark):
    assert one(spark, text.year_prefix(F.col("c")), c="2019-05-01") == 2019
    assert one(spark, text.year_prefix(F.col("c")), c="n.d.") is None
    assert one(spark, text.year_token(F.col("c"), 1900, 2100), c="vol 1234 Dic 2024") == 2024
    assert one(spark, text.year_token(F.col("c")), c="no year") is None


def test_snippet_and_labels(spark):
    assert one(spark, text.snippet(F.col("c")), c="a  " * 300) == ("a " * 200) + "…"
    assert one(spark, text.short_label(F.col("c")), c="First one. Second") == "First one"
    assert one(spark, text.short_label(F.col("c")), c="x" * 80) == "x" * 59 + "…"
    assert one(spark, text.raw_file_name(F.lit("s"), F.col("c")), c="a b/c").startswith("s__a_b_c__")


def test_candidate_keys(spark):
    assert one(spark, text.candidate_keys(F.col("i"), F.col("d")), i="https://openalex.org/W1", d="https://doi.org/10.1/A") == ["https://openalex.org/W1", "W1", "10.1/a", "doi:10.1/a"]
    assert one(spark, text.candidate_keys(F.col("i"), F.col("d")), i="WOS:1", d=None) == ["WOS:1"]
    assert one(spark, text.native_id(F.col("i")), i="https://openalex.org/W1") == "W1"


def test_label_json(spark):
    fence = '```json\n{"a": 1}\n```'
    assert one(spark, nested.label_json(F.col("c")), c=fence) == '{"a": 1}'
    assert one(spark, nested.label_json(F.col("c")), c=' {"a": 1} ') == '{"a": 1}'


@pytest.mark.parametrize("json, want", [('{"a":{"x":1}}', 1), ('{"a":[{"x":2},{"x":3}]}', 2), ('{"a":"s"}', None), ("{}", None), ("no", None)])
def test_first_of_object_or_list(spark, json, want):
    v = nested.variant(F.col("c"))
    assert one(spark, nested.path(nested.first(v, "a"), "x", "int"), c=json) == want


def test_inverted_index(spark):
    df = spark.createDataFrame([({"world": [1], "hello": [0, 2]},), (None,), ({},)], "m map<string,array<int>>")
    assert [r[0] for r in df.select(nested.inverted_index_text(F.col("m"))).collect()] == ["hello world hello", None, None]


def test_filters_on_nulls(spark):
    df = spark.createDataFrame([(None, None, None), ("Editorial", "t", ""), ("article", "Bad concrete", "EN"), ("article", "good", "fr")], "type string, title string, language string")
    assert [r["title"] for r in filters.spec_filter(df, ["concrete"]).collect()] == [None, "good"]
    assert [r[0] for r in df.select(filters.non_english(F.col("language"))).collect()] == [False, True, False, True]
    aug = filters.augment(df.limit(0).withColumn("abstract", F.lit("")).withColumn("publication_year", F.lit(1)).withColumn("cited_by_count", F.lit(1)).withColumn("open_access_url", F.lit("")), {"v": {"t": ["s"]}})
    assert "v_mentioned" in aug.columns and aug.count() == 0
