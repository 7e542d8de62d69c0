"""The queries against their SQL, and the pipeline against its stages done by brute force."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skytally.llm import rules
from test_cases import brute_components
from skytally.llm.oracle import ORACLE
from skytally.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")


def sorted_rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(None if v is None or v is pd.NA else v for v in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    assert sorted_rows(QUERIES[name](spark, SF_DIR).toPandas()) == sorted_rows(duck.execute(ORACLE[name]).df())


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    inputs, kept = [docs], {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        inputs.append(stage(spark, inputs[-1], SF_DIR).cache())
        kept[name] = inputs[-1]
        assert inputs[-1].columns == docs.columns
    good = {r["doc_id"] for r in rules.measured(docs, rules.RULES).filter("kept").collect()}
    assert {r["doc_id"] for r in kept["quality_rules"].collect()} == good
    assert {r["doc_id"] for r in kept["line_dedup"].collect()} == good
    assert kept["line_dedup"].filter(F.length("text") != F.col("n_chars")).count() == 0
    texts = {r["doc_id"]: r["text"] for r in kept["line_dedup"].collect()}
    heads = {k for k, (_, component) in brute_components(texts, 80).items() if k == component}
    assert {r[0] for r in kept["near_dedup"].select("doc_id").collect()} == heads
    once = {r["doc_id"]: r["text"] for r in kept["near_dedup"].collect()}
    assert all(once[r["doc_id"]] == r["text"] for r in kept["mixture"].collect())
    last = corpus_pipeline.STAGES[-1][1](spark, kept["mixture"], SF_DIR)
    assert last.filter("NOT restored").count() == 0
    whole = corpus_pipeline.run(spark, SF_DIR)
    columns = ["doc_id", "sample", "n_pieces"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, last.select(columns).collect()))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_dedup_stage_is_exact_at_four_fifths(spark):
    from test_cases import brute_components

    filler = lambda k, n: [f"w{k}x{i}" for i in range(n)]
    rows = []
    for k in range(60):  # 200 words, of which the last 12 to 29 differ: similarity from 0.89 to 0.74
        text = filler(k, 200)
        rows.append((2 * k, " ".join(text)))
        rows.append((2 * k + 1, " ".join(text[: 188 - k % 18] + filler(1000 + k, 12 + k % 18))))
    want = {i for i, (_, c) in brute_components(dict(rows), 80).items() if i == c}
    assert want != {i for i, (_, c) in brute_components(dict(rows), 85).items() if i == c}
    docs = spark.createDataFrame([*rows, rows[0], (None, rows[2][1])], "doc_id long, text string").withColumn("source", F.lit("a"))
    kept = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
