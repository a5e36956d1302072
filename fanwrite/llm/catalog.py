"""One query per operator, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from fanwrite.llm import ann, bpe, clusters, decontam, html_text, jaccard, langid, lexical, pii, secrets, sharding, simhash, urls
from fanwrite.sources.tables import read_table

TOKENIZER = os.environ.get("FANWRITE_TOKENIZER", "")


def tokenizer_path() -> str:
    """The vocabulary file: ``$FANWRITE_TOKENIZER``, else the installed public one."""
    if TOKENIZER:
        return TOKENIZER
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# Rows that Spark hands to a Python worker at once. Texts are long, and a task may
# hold several batches in several forms; Spark's default of 10,000 is for short rows.
ROWS_AT_ONCE = 500


def bounded_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to ``ROWS_AT_ONCE`` rows, unless they
    are smaller already."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ROWS_AT_ONCE:
        spark.conf.set(setting, ROWS_AT_ONCE)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(read_table(spark, sf_dir, "embeddings"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.texts(read_table(spark, sf_dir, "pages"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read_table(spark, sf_dir, "documents"), "doc_id")


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(read_table(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(read_table(spark, sf_dir, "documents"))


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digests(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read_table(spark, sf_dir, "pages"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(read_table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(read_table(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.digests(read_table(spark, sf_dir, "embeddings"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _query(of_table: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(of_table)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return of_table(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": _query(op1_ann),
    "op2_html_text": _query(op2_html_text),
    "op3_sharding": _query(op3_sharding),
    "op4_jaccard": _query(op4_jaccard),
    "op5_langid": _query(op5_langid),
    "op6_pii": _query(op6_pii),
    "op7_decontam": _query(op7_decontam),
    "op8_urls": _query(op8_urls),
    "op9_bpe": _query(op9_bpe),
    "op10_secrets": _query(op10_secrets),
    "op11_simhash": _query(op11_simhash),
    "op12_clusters": _query(op12_clusters),
    "op13_lexical": _query(op13_lexical),
}
