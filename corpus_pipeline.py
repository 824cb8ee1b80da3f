"""The corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``:

1. quality rules drop documents that fail the base rules or diverge from
   their language;
2. the toxicity model, trained on the labelled documents still there, drops
   those it predicts toxic;
3. near-duplicate detection keeps one document of each group;
4. the secret scan replaces secrets in the texts;
5. packing turns the texts into full token sequences: one row per piece of a
   document with its token ids, the pieces of a sequence next to each other
   (``packing.sequences`` makes one row of them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import minhash, packing, quality, secrets, toxicity
from cartwheel.llm.scratch import stage, table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the workers still hold what earlier stages left: fewer words are kept here
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), known_words=120_000)
    return pieces.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("drop_toxic", drop_toxic),
    ("drop_near_duplicates", drop_near_duplicates),
    ("redact_secrets", redact_secrets),
    ("pack_sequences", pack_sequences),
]

#: No SQL form: the model, the tokenizer and the test battery have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
