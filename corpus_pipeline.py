"""The corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, redaction of personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs.  All
but the last return the columns of documents, with further columns of whatever names unchanged.  Null ids stay and stand for a document each; an empty
table goes through every stage and gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from racelake.llm import decontaminate, ngram_join, packing, pii, quality
from racelake.llm._scratch import Scratch


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Null, empty and blank texts go (fewer than 50 words); repeated rows are judged one by one, alike."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more: that of least doc_id, null last; of rows equal in id and text, one. Texts without words link with nothing and stay."""
    # wider than operator 3's own contract of four words and 0.85
    return ngram_join.one_of_each(spark, docs, n=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item (the whole item, where it is shorter). Null texts stay; rows of one id with different texts are judged apart; null and empty items hit nothing."""
    return decontaminate.clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind in brackets; n_chars follows. Null and empty texts stay as they are; findings that overlap become one, named by the first."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in sequences of 2,048 tokens. A null or empty text is one piece of its end id; repeated rows are packed one by one; pieces of one length are placed in no promised order."""
    import public_tokenizers

    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", drop_bad),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("packing", pack_sequences),
]

#: Packing is not expressible in SQL; the stages are tested against SQL and brute force one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of documents. A stage's table is dropped when the next one's is written."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        scratch.keep(1)
    return docs
