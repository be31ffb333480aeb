"""The corpus pipeline: raw documents to packed training sequences.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of ``docs``; the table is
written and read back between stages. Nulls, empty texts, repeated rows and extra columns are handled as the operators'
modules state.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import langid, lines, packing, pii, simhash
from shopledger.llm.common import fresh, prepare, table, with_columns
from shopledger.session import store

#: No stage can be stated as SQL: trained models, similarity joins and tokenizers.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any language (null texts, texts without a letter) go; a missing ``lang`` is filled in, if
    any rows have one to learn from."""
    prepare(spark)
    model = langid.fit(docs)
    (found,) = fresh(docs, "lang_pred")
    if not model.languages:
        lettered = lambda texts: [pa.array([any(c.isalpha() for c in t or "") for t in texts], pa.bool_())]
        return with_columns(docs, "text", lettered, {found: "boolean"}).where(F.col(found)).select(*docs.columns)
    labelled = with_columns(docs, "text", langid.labels_of(spark, model), {found: "string"})
    return labelled.where(F.col(found) != langid.UNKNOWN).withColumn("lang", F.coalesce("lang", found)).select(*docs.columns)


def drop_similar_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; all documents stay."""
    prepare(spark)
    return sized(lines.without_similar_lines(docs).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (SimHash of three-word shingles, at most two bits apart, directly or
    through others) stays: the one with the smallest id."""
    prepare(spark)
    return simhash.one_of_each(docs, size=simhash.SHINGLE, limit=simhash.LIMIT)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind, as in <email>."""
    prepare(spark)
    weights = pii.fit(docs).weights
    (masked,) = fresh(docs, "masked")
    out = with_columns(docs, "text", lambda texts: [pa.array([pii.mask(t, weights) for t in texts], pa.string())], {masked: "string"})
    return sized(out.select(*(F.col(masked).alias("text") if c == "text" else F.col(c) for c in docs.columns)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the ids of each document lie in sequences of at most 1024, with the ids."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).withColumnRenamed("id", "doc_id")


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with the lengths of the texts as they are now."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0))).select(*docs.columns) if "n_chars" in docs.columns else docs


STAGES = [
    ("language", identify_language),
    ("lines", drop_similar_lines),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
