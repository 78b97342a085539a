"""Schemas of the record table and of what operators add to it."""

from pyspark.sql import types as T

_s, _i = T.StringType(), T.IntegerType()

#: One row per harvested record; ``raw`` is the source's own JSON.
RECORD = T.StructType(
    [
        T.StructField("id", _s),
        T.StructField("doi", _s),
        T.StructField("title", _s),
        T.StructField("publication_year", _i),
        T.StructField("language", _s),
        T.StructField("type", _s),
        T.StructField("abstract", _s),
        T.StructField("authors", _s),
        T.StructField("source_journal_or_publisher", _s),
        T.StructField("cited_by_count", _i),
        T.StructField("open_access_url", _s),
        T.StructField("raw", _s),
        T.StructField("source_database", _s),
    ]
)

#: Archive of raw responses.
RAW_ARCHIVE = T.StructType([T.StructField("source", _s), T.StructField("query", _s), T.StructField("payload_json", _s)])

#: Persisted column order; vocabulary axes and the gate follow.
CSV_COLUMNS = [
    "id", "doi", "title", "title_english_translation", "authors", "year", "language", "source_journal_or_publisher", "type",
    "abstract", "abstract_snippet", "cited_by_count", "non_english", "open_access_url", "source_databases", "priority_score", "notes",
]

#: What a label backend returns; the defaults are the enumerations of the shipped labelling schema.
LABEL = T.StructType(
    [T.StructField(c, _s) for c in ("relevance", "parent_lithology", "process_focus", "regolith_zone")]
    + [T.StructField(c, T.ArrayType(_s)) for c in ("methods", "minerals")]
    + [T.StructField("climate_zone", _s), T.StructField("is_thesis", T.BooleanType()), T.StructField("is_review", T.BooleanType()), T.StructField("rationale", _s)]
)
LABEL_COLUMNS = [
    "relevance_llm", "parent_lithology_llm", "process_focus_llm", "regolith_zone_llm", "methods_llm", "minerals_llm",
    "climate_zone_llm", "is_thesis_llm", "is_review_llm", "label_rationale",
]
