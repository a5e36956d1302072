"""Documents to training tokens in five stages.

Every stage works on all rows its predecessor kept, which are written to the
shared folder as Parquet in between, so a lost executor costs a stage's tasks
and no more.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanwrite.llm import bpe, decontam, jaccard, langid, pii
from fanwrite.llm.catalog import bounded_batches, tokenizer_path
from fanwrite.session import scratch_dir
from fanwrite.sources.tables import read_table


def _free(name: str, docs: DataFrame) -> str:
    """The name, with underscores if ``docs`` has such a column (in any case of letters)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: null texts and those without
    a letter.  A missing ``lang`` is filled with the one found."""
    bounded_batches(spark)
    own = _free("_judged", docs)
    judged = docs.withColumn(own, langid.judgement(spark, F.col("text"), langid.learn(docs)))
    kept = judged.where(F.col(own)["lang_pred"] != langid.UNDETERMINED)
    return kept.withColumn("lang", F.coalesce("lang", F.col(own)["lang_pred"])).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their shingles the least doc_id stays."""
    bounded_batches(spark)
    return jaccard.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    bounded_batches(spark)
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; ``n_chars`` follows the text."""
    bounded_batches(spark)
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``n_tokens``, whether the ids decode to the text (``exact``),
    and the token ``ids``.  A column that a document brings under such a name stays
    as it is; the new one's name has an underscore more."""
    bounded_batches(spark)
    ids, decoded = _free("ids", docs), _free("_decoded", docs)
    coded = bpe.encode(docs, tokenizer_path(), ids=ids, decoded=decoded)
    exact = F.col(decoded).eqNullSafe(F.coalesce("text", F.lit("")))
    added = F.size(ids).cast("bigint").alias(_free("n_tokens", docs)), exact.alias(_free("exact", docs))
    return coded.select(*docs.columns, *added, ids)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# No SQL can express a stage; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
