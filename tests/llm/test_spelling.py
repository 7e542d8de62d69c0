"""Spelling variants against brute force over all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skytally.llm import spelling
from skytally.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def count(docs, every=31, least_length=7, least_count=2):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def neighbours(words):
    """Near words of each, by deleting every place of every word."""
    near = {w: set() for w in words}
    for kind in (0, 1):
        by = {}
        for w in words:
            for k in range(len(w)):
                by.setdefault((k if kind else -1, w[:k] + w[k + 1 :]), set()).add(w)
        for (_, short), group in by.items():
            if kind:
                for w in group:
                    near[w] |= group - {w}
            elif short in near:
                near[short] |= group
                for w in group:
                    near[w].add(short)
    return near


def brute(counts, ratio=10):
    near, form = neighbours(counts), {}
    for w in counts:
        if near[w]:
            best = min(near[w], key=lambda v: (-counts[v], v))
            if counts[best] >= ratio * counts[w]:
                form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return out


def rows(df):
    found = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]
    assert len(set(found)) == len(found)
    return set(found)


def test_neighbours_themselves():
    words = ["aaaa", "aaa", "aab", "abab", "baba", "b"]
    assert neighbours(words) == {w: {v for v in words if spelling.near_edit(w, v)} for w in words}
    assert spelling.near_edit("aaa", "aaaa") and spelling.near_edit("aab", "aaa") and not spelling.near_edit("abab", "baba")


@pytest.mark.parametrize("tile", [1024, 3])
@pytest.mark.parametrize("alphabet, lengths", [("ab", (1, 9)), ("abcdeé÷", (2, 7)), ("a", (1, 80)), ("xyzü", (62, 67))])
def test_equals_brute_force(spark, monkeypatch, alphabet, lengths, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    draw = random.Random(len(alphabet) + tile)
    words = {"".join(draw.choices(alphabet, k=draw.randint(*lengths))) for _ in range(250)}
    for w in [*words][:120]:
        k = draw.randrange(len(w))
        words |= {w[:k] + w[k + 1 :], w[:k] + draw.choice(alphabet) + w[k:], w[:k] + draw.choice(alphabet) + w[k + 1 :]}
    counts = {w: draw.choice([1, 2, 2, 20, 20, 200, 2000]) for w in words if w}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows(spelling.variants(frame)) == brute(counts)


def test_chunks_end_where_groups_do(spark, monkeypatch):
    draw = random.Random(9)
    counts = {"".join(draw.choices("abcd", k=draw.randint(5, 7))): draw.randint(2, 900) for _ in range(800)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    import pyarrow as pa

    table = pa.Table.from_pandas(spelling._blocked(frame, 1).toPandas().sort_values(["block", "tile_a", "tile_b"]), preserve_index=False)
    whole = [b for b in spelling._near(iter(table.to_batches()))]
    monkeypatch.setattr(spelling, "CHUNK", 50)
    cut = [b for b in spelling._near(iter(table.to_batches(max_chunksize=17)))]
    assert len(cut) > 5 and sum(sum(b.column(1).to_pylist()) for b in cut) == sum(sum(b.column(1).to_pylist()) for b in whole)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op13_spelling"](spark, SF_DIR)) == brute(count(docs))


def test_edge_cases(spark):
    long = "q" * 50_000
    texts = [
        (1, None), (2, ""), (3, "Elephant elephant ÉLÉPHANT élephant"), (3, "Elephant elephant ÉLÉPHANT élephant"),
        (None, "elephant elephants elephants"), (4, f"{long} {long} {long}r {long}r"), (5, "123 4567 - 日本語日本語日本語"), (6, "a×÷b×÷c×÷ a×÷b×÷c×÷"),
    ]
    texts += [(k, "elephant " * 3) for k in range(10, 40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit("own")).withColumn("n", F.lit(1))
    for every in (31, 2):
        counted = spelling.count_words(docs, "doc_id", "text", change=spelling.delete_some(every))
        assert {r["word"]: r["n"] for r in counted.collect()} == count(texts, every)
        assert rows(spelling.variants(counted, least_length=7)) == brute(count(texts, every))
    assert spelling.variants(spelling.count_words(docs.limit(0), "doc_id", "text")).collect() == []
