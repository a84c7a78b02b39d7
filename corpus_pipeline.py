"""Five operators of ``cadenza.llm`` as a pipeline over the documents table.

Toxic documents go; one document of each group of near-duplicates stays; what
holds an item of the benchmark goes; secrets in the texts that are left are
masked; the last stage encodes those texts and decodes the ids again.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all
but the last return the columns of ``documents``. Null texts count as empty
and stay as they are; a null doc_id belongs to no group and is kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import blob_ledger, bpe, decontamination, lsh_forest, toxicity
from cadenza.llm.common import read_table
from cadenza.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the operator's bound; the network learns from the labels outside the held-out fold."""
    return toxicity.reject(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by five-word shingles at 80 percent."""
    return lsh_forest.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified item of the benchmark."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each finding replaced by ``[SECRET]``; ``n_chars`` follows a changed text."""
    return blob_ledger.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Count and digests of the ids of each text and of what they decode to."""
    return bpe.encoding_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each result written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The network and the tokenizer can't be written in SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None
