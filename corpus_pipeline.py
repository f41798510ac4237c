"""From raw documents to token ids: five stages, each one of the training-data operators.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet in the shared
folder and read again as the next stage's docs. Every stage works on all rows of its predecessor:

1. language ID: documents whose language the model rejects go;
2. exact dedup: of equal texts the row with the largest doc_id stays;
3. SimHash near-dedup: of each group linked at 2 or fewer bits the row with the smallest doc_id stays;
4. mixing: the sources are brought to their target weights; a document is repeated, cut to the words
   that the mix takes, or left out;
5. SentencePiece: each text is encoded to ids, decoded again and compared.

All but the last return the columns of documents; the last adds ids, n_ids, parity and round_trip. How
nulls, empty texts, repeated rows and extra columns are handled stands with each operator. SQL cannot
express the stages, so ORACLE_SQL is None and the tests hold run() against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm.chunk_dedup import drop_exact_copies
from footfall.llm.common import documents, written
from footfall.llm.gray_simhash import drop_near_copies
from footfall.llm.lang_id import accepted_documents
from footfall.llm.mixing import mixed_documents
from footfall.llm.sp_codec import encoded_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted_documents(spark, docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(spark, docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(spark, docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(spark, docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded_documents(spark, docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return docs
