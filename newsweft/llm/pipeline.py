"""Corpus pipeline: five stages applied one after another to ``documents``.

All stages but the last return the columns of documents; a stage sees all that
the one before it kept, and its decisions take effect on rows, whatever their
ids. A stage's own tables are deleted when the next stage starts, so each
result must be written before that, as ``run`` does.

In every stage an empty table gives an empty one, texts of any length count
whole, repeated rows are judged alike, and columns of any other name pass
through the first four stages, clashing ones included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import near_dedup, packing, quality_lm, quality_rules, substring_dedup
from .scratch import free, persist, stage_of

#: Near duplicates share 80 % of their shingles of so many words.
SHINGLE = 5
PIPELINE = "corpus"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_unlikely_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents whose perplexity lies above their language's limit go.

    Null or wordless texts, and languages without trusted documents, have no
    perplexity and stay; a null language is one of its own. A null id is judged
    like any other.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_lm.keep(docs, labels)


def drop_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rule or a compression band go, null and wordless texts among them."""
    return quality_rules.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group the first row by id stays; of rows that tie, one.

    Two texts under one id are two rows: each stays unless its own text is in
    the group of an earlier row. Rows without id or words stay.
    """
    return near_dedup.drop_near_duplicates(docs, shingle=SHINGLE)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages that start in a document of a smaller id go; n_chars follows the text.

    A document may lose all its words and stays as an empty text; null text
    becomes empty. Rows without id are neither cut nor sources.
    """
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    renamed = docs.select("doc_id", "text", *[F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)])
    out = substring_dedup.dedup_substrings(renamed, carry=tuple(f"carried_{i}" for i in range(len(carry))))
    back = {c: F.col(f"carried_{i}") for i, c in enumerate(carry)} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in back:
        back["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[back[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the place of every piece of every document in sequences of 1024 tokens.

    Null and empty texts are one piece, the end id; rows are packed one by one
    whatever their ids; only doc_id and text are read.
    """
    return packing.pack(docs, with_ids=False)


def _staged(stage: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with stage_of(PIPELINE, docs):
            return stage(spark, docs, sf_dir)

    run_stage.__name__, run_stage.__doc__ = stage.__name__, stage.__doc__
    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", _staged(drop_unlikely_text)),
    ("quality rules", _staged(drop_by_rules)),
    ("near dedup", _staged(drop_near_duplicates)),
    ("substring dedup", _staged(drop_repeated_passages)),
    ("best-fit packing", _staged(pack_sequences)),
]
#: Compression, language models and tokenizers can't be expressed in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = persist(out, name.replace(" ", "-"))
        if before is not None:
            free(before)
        before = docs
    return docs
