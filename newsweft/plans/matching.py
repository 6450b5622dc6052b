"""Glossaries of many terms, made of the words of ``conversations``, over whole ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins
from .registry import query, table

_SEPARATED = r"[^\s.,;:!?\"()]+"


def terms(spark, sf_dir) -> DataFrame:
    """``mm, en``: long words, every second length as it is, the others without regard to case."""
    words = table(spark, sf_dir, "conversations").select(F.explode(F.regexp_extract_all("text", F.lit(_SEPARATED), 0)).alias("w")).distinct()
    words = words.filter(F.length("w").between(9, 40))
    even = F.length("w") % 2 == 0
    return words.select(F.when(even, F.col("w")).otherwise("").alias("mm"), F.when(even, F.lit("")).otherwise(F.initcap("w")).alias("en")).distinct()


TERMS = rf"""w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{_SEPARATED}')) AS w FROM conversations),
 g AS MATERIALIZED (SELECT DISTINCT CASE WHEN length(w) % 2 = 0 THEN w ELSE '' END AS mm, CASE WHEN length(w) % 2 = 0 THEN '' ELSE lower(w) END AS en FROM w WHERE length(w) BETWEEN 9 AND 40),
 d AS MATERIALIZED (SELECT doc_id, text, lower(text) AS low FROM documents WHERE text IS NOT NULL)"""


@query("WITH " + TERMS + " SELECT doc_id, mm, en FROM d JOIN g ON (mm <> '' AND contains(text, mm)) OR (en <> '' AND contains(low, en))")
def glossary_many_terms(spark, sf_dir):
    """Every document with every term that occurs in it."""
    found = joins.glossary_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), terms(spark, sf_dir), "text")
    return found.select("doc_id", "mm", F.lower("en").alias("en"))


_EDGES = r"regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])' || en || '([^\p{L}\p{N}_]|$)')"


@query("WITH " + TERMS + f", c AS MATERIALIZED (SELECT doc_id, text, en FROM d JOIN g ON en <> '' AND contains(low, en)) SELECT doc_id, en FROM c WHERE {_EDGES}")
def region_many_names(spark, sf_dir):
    """Names as whole words."""
    names = terms(spark, sf_dir).filter("en <> ''")
    found = joins.region_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), names, "text")
    return found.select("doc_id", F.lower("en").alias("en"))


_ENTRIES = [(1, "tion", "", "ション"), (2, "ション", "", "ばつ"), (3, "lich", "", "的"), (4, "ción", "", "シオン"), (5, "ch", "", "ヒ"), (6, "zzzz", "", "無"), (7, "ea", "", "")]


def _replaced() -> str:
    """SQL that puts in one entry after another, if the source text has it."""
    t = "text"
    for _, mm, _, ja in _ENTRIES:
        if ja:
            t = f"CASE WHEN contains(text, '{mm}') THEN replace({t}, '{mm}', '{ja}') ELSE {t} END"
    return t


@query(f"SELECT doc_id, sha256({_replaced()}) AS sha FROM documents WHERE text IS NOT NULL")
def glossary_in_texts(spark, sf_dir):
    """Entries of a glossary put into whole texts; a term that only an earlier entry brought in is not an entry of the text."""
    glossary = spark.createDataFrame(_ENTRIES, "nth int, mm string, en string, body_ja string")
    d = table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", "text", F.col("text").alias("out"))
    return joins.with_glossary(d, glossary, "out", "text", "nth").select("doc_id", F.sha2("out", 256).alias("sha"))
