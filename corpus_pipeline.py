"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``. Every stage works on all that the stage before kept.

Cases: a null or empty text is ``und`` and goes at the first stage; an empty table
stays empty; columns beyond those of ``documents`` are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from caretide.llm import bpe, decontaminate, langid, pii, simhash
from caretide.llm.common import table
from caretide.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in no language; a missing label is filled in."""
    model = langid.fit(docs.where(~langid.held_out()))
    named = langid.predict(docs, model, *COLUMNS).where(F.col("lang_pred") != langid.UND)
    return named.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    items = table(spark, sf_dir, "benchmark")
    return decontaminate.uncontaminated(docs, items, *rest, size=10).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data is replaced by its kind; ``n_chars`` follows the text."""
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    found = pii.redact(pii.annotate(docs, pii.fit(docs), *rest))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids``, their number, and the text as decoded from them."""
    coded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.col("bytes").cast("string").alias("decoded"),
    )


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal_data),
    ("byte-level BPE", tokenize),
]

#: SQL cannot state the language model, the hashes or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written once."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
