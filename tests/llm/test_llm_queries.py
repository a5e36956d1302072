"""Registered queries against their SQL; the pipeline against its operators by brute force."""

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from fanwrite.llm.catalog import QUERIES
from fanwrite.llm.oracle import ORACLE_SQL

TABLES = ("documents", "benchmark", "pages", "embeddings")


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries()) >= {*QUERIES, "pipeline"} and set(oracle_sql()) >= set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(c) for c in columns]
    got = queries()[name](spark, sf_small)
    assert sorted(got.columns) == columns
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, (tuple(r[i] for i in order) for r in want.fetchall())))


def test_pipeline_equals_brute_force(spark, sf_small):
    from test_decontam import brute as contaminated
    from test_jaccard import brute as grouped
    from test_langid import langid  # noqa: F401
    from tokenizers import Tokenizer

    from fanwrite.llm import pii
    from fanwrite.llm.catalog import tokenizer_path

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    lettered = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    first = {i for i, _, c in grouped(lettered) if i == c}
    single = [(i, t) for i, t in lettered if i in first]
    bad = {r[0] for r in contaminated(single, items) if r[-1]}
    clean = {i: pii.mask(t) for i, t in single if i not in bad}
    library = Tokenizer.from_file(tokenizer_path())
    want = {i: (t, len(t), library.encode(t, add_special_tokens=False).ids) for i, t in clean.items()}
    rows = corpus_pipeline.run(spark, sf_small).collect()
    assert {r["doc_id"]: (r["text"], r["n_chars"], r["ids"]) for r in rows} == want and len(rows) == len(want)
    assert all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert bad and len(first) < len(lettered)


def through_all_stages(spark, docs, sf_dir, folder):
    """As ``run`` does it: each stage's rows are written and read again."""
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


def test_pipeline_stages_take_odd_rows(spark, sf_small, make_docs, no_docs, tmp_path):
    rows = [(1, None, None), (2, "", "en"), (3, "123", None), (4, "some words a@b.cd", None), (4, "some words a@b.cd", None), (None, "no id here", "en"), (5, "more words here", "en")]
    for k, (docs, kept) in enumerate(((make_docs(rows), [4, 5, None]), (no_docs, []))):
        columns = docs.columns
        got = through_all_stages(spark, docs, sf_small, f"{tmp_path}/{k}")
        assert got.columns[: len(columns)] == columns
        assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted(kept, key=str)
        assert all("@" not in r["text"] for r in got.collect())


CLASHING = ("ids", "N_tokens", "exact", "_decoded", "_judged", "_Judged_", "lang_pred", "score", "component", "spans", "_benchmark_windows", "found")


def test_pipeline_keeps_columns_of_any_name(spark, sf_small, tmp_path):
    names = [n for n in CLASHING if n != "_Judged_"] + ["_Judged_"]
    rows = [(i, f"text number {i} of some words", "en", "s", 20, *[f"{n}-{i}" for n in names]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} string" for n in names))
    got = through_all_stages(spark, docs, sf_small, tmp_path)
    assert got.columns == [*docs.columns, "n_tokens_", "exact_", "ids_"]
    kept = {r["doc_id"]: r for r in got.collect()}
    assert len(kept) == 6
    for i, r in kept.items():
        assert [r[n] for n in names] == [f"{n}-{i}" for n in names]
        assert r["exact_"] and r["n_tokens_"] == len(r["ids_"]) > 0


def test_pipeline_takes_a_very_long_text(spark, sf_small, tmp_path):
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(300_000))
    docs = spark.createDataFrame([(1, long, "en", "s", len(long)), (2, long, None, "s", len(long)), (3, "short and different", "en", "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = through_all_stages(spark, docs, sf_small, tmp_path).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 3] and all(r["exact"] for r in got)
    assert next(r for r in got if r["doc_id"] == 1)["text"] == long
