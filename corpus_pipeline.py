"""The corpus pipeline: language ID, near-duplicates, benchmark decontamination, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again for the next
one. All but the last return the columns of documents.

Defined results of every stage: columns that a stage does not need travel beside it in one struct, so names that clash with an
operator's own come back as they were; an empty table gives no rows; a null text is an empty one (and goes in the first
stage, as it has no letters); texts of any length are worked on whole; repeated rows are rows like any other, but of rows
that share a doc_id near_dedup keeps one, and rows without a doc_id all stay there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import common, decontaminate, langid, packing, pii, shingles

#: The near-duplicate stage compares sets of shingles of five words.
SHINGLE = 5


def aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with all but the used columns in one struct of a new name, and what brings the columns back."""
    name, others = f"c{uuid.uuid4().hex}", [c for c in docs.columns if c not in used]
    if not others:
        return docs, lambda df: df.select(*docs.columns)
    packed = docs.select(*[c for c in docs.columns if c in used], F.struct(*[F.col(f"`{c}`") for c in others]).alias(name))
    return packed, lambda df: df.select(*[F.col(name).getField(c).alias(c) if c in others else F.col(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without any letter (null texts too); a missing lang becomes the predicted one, and stays missing where nothing could be learned from."""
    model = langid.learned(docs, ~langid.held_out(), common.tokenizer_path(langid.VOCABULARY))
    if not model[0]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    packed, back = aside(docs, "text", "lang")
    found = langid.identified(packed, model).where(F.col("lang_pred") != "und")
    return back(found.withColumn("lang", F.coalesce("lang", "lang_pred")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies: what links of 0.8 or more of shingle sets connect. Pigeonring over SimHash fingerprints proposes pairs, a prefix filter the rest, and each is compared by its full sets."""
    packed, back = aside(docs, "doc_id", "text")
    return back(shingles.deduplicated(packed, SHINGLE))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item; a null text has none and stays."""
    packed, back = aside(docs, "text")
    return back(decontaminate.scanned(packed, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where(F.size("hit_runs") == 0))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in texts by the name of its kind; n_chars, where there is one, is counted anew."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches of what is left: the other columns of documents, without text, and where each row goes; of clashing names, the new column stays."""
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("pii", personal_data),
    ("packing", packs),
]

#: SQL expresses neither the language model nor the bootstrapped patterns; tests/llm/test_pipeline.py has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
