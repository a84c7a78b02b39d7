"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import fill_in_middle as _fill_in_middle
from cadenza.llm import fingerprints as _fingerprints
from cadenza.llm import warc as _warc
from cadenza.llm.common import read_table
from cadenza.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {"op4_fingerprints": _fingerprints.SQL, "op11_warc": _warc.SQL, "op12_fill_in_middle": _fill_in_middle.SQL}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cadenza.llm.pfor import read_digests, token_files

    return read_digests(token_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cadenza.llm.bpe import encoding_digests

    return encoding_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadenza.llm.lsh_forest import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"), size=4, percent=80)


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadenza.llm.fingerprints import fingerprints

    return fingerprints(read_table(spark, sf_dir, "documents"))


@query
def op1_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadenza.llm.blob_ledger import secret_scan, span_digests

    return span_digests(secret_scan(read_table(spark, sf_dir, "documents")))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadenza.llm.langid import predict_languages

    return predict_languages(read_table(spark, sf_dir, "documents"))


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadenza.llm.pii import find_personal_data, span_digests

    return span_digests(find_personal_data(read_table(spark, sf_dir, "documents")))


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadenza.llm.licenses import scan_licenses

    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadenza.llm.decontamination import contaminated

    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadenza.llm.toxicity import fit, score

    docs = read_table(spark, sf_dir, "documents")
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    _warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    return _warc.read_archives(spark, path, payloads=False).drop("url", "payload")


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fill_in_middle.fim_digests(_fill_in_middle.fill_in_middle(read_table(spark, sf_dir, "documents")))


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cadenza.llm.alignment import alignment_digests

    return alignment_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
