"""The corpus pipeline: stages applied one after another to the table of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm import jaccard, langid, packing, secret_scan
from maskwright.llm.common import free_name, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# A text of at least so many characters whose cosine stays below this fits no known language.
MIN_CHARS, MIN_SCORE = 200, 0.15
# Near copies: shingles of so many words, and a Jaccard similarity of at least so many percent.
COPY_WORDS, COPY_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and long ones that resemble no language.

    Short texts have too few n-grams for a cosine to mean much; with a letter, they stay.
    """
    prototypes = langid.train_on_folds(docs)
    lang, score = free_name(docs, "__lang"), free_name(docs, "__score")
    judged = langid.predict(docs, prototypes, lang_out=lang, score_out=score)
    unlike = (F.length("text") >= MIN_CHARS) & (F.col(score) < MIN_SCORE)
    return judged.filter((F.col(lang) != langid.UNKNOWN) & ~unlike).drop(lang, score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal or similar texts: that with the smallest id."""
    return jaccard.keep_one(docs, percent=COPY_PERCENT, size=COPY_WORDS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; no document is dropped."""
    return secret_scan.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two sequences of all documents that are left, with their token ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("packing", pack_sequences),
]

# SQL can state neither the language profiles nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written as Parquet and reread as the next stage's input."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
