"""A quality classifier by co-training on two views of a page.

The text view sees the words: shares of hashed words, and measures of repetition, symbols and word
lengths.  The metadata view sees source, language and size.  Each is a logistic regression fitted on
labelled rows.  In each round, either view labels the unlabelled rows that it is surest of, and these
join the other view's training rows.  Then each view is calibrated on labelled rows kept out of
training, and a logistic regression of both calibrated views, fitted there too, scores every document.

Features of all rows are worked out once and written.  Labelled rows beyond about ``max_labelled``, chosen by a hash of
the id, are not fitted.  The unlabelled ones are all scored in every round: each task keeps the ``per_round`` surest
of each label, and of these the ``per_round`` surest of all reach the driver, where the fit is.  Equally sure rows
go by the hash of their content; copies of a row count once.  Scoring is a pass over the features of all rows.

Null or empty texts are scored like any other, by their features; null metadata is a value of its own.
Labels other than 0 and 1 don't count; of several labels of an id the mean decides, halves are dropped.
Without labels of both kinds nothing can be learned: the score is then the labels' smoothed mean (0.5
without any), and a document is kept from 0.5 on.  Repeated rows get equal scores, rows with a null id
are scored but not learned from.  A text of any length is read whole.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import begin, stored
from skytally.llm.rules import Text
from skytally.llm.shingles import mixed, slices, words

WORDS, SOURCES, LANGS = 256, 64, 16
_MEASURES = 9


def text_features(texts: list[str | None]) -> np.ndarray:
    """One row per text: measures, then root shares of hashed words."""
    out = np.zeros((len(texts), _MEASURES + WORDS))
    arrow = pa.array([t or "" for t in texts], pa.large_string())
    for start, end, offsets, data in slices(arrow):
        ends, values = words(offsets, data)
        place = (values >> np.uint64(56)).astype(np.int64)
        for row in range(start, end):
            own = place[ends[row - start] : ends[row - start + 1]]
            if len(own):
                out[row, _MEASURES:] = np.sqrt(np.bincount(own, minlength=WORDS) / len(own))
    for row, text in enumerate(texts):
        t = Text(text)
        n, chars, n_lines = max(t.n_words, 1), max(t.word_chars, 1), max(len(t.lines), 1)
        out[row, :_MEASURES] = (
            np.log1p(t.n_words),
            min(t.word_chars / n, 30) / 10,
            min(t.n_symbols / n, 2),
            t.n_dup_lines / n_lines,
            t.n_repeat_words / n,
            len(set(t.words)) / n,
            sum(map(str.isupper, t.text)) / chars,
            sum(map(str.isdigit, t.text)) / chars,
            np.log1p(len(t.lines)),
        )
    return out


def metadata_features(source: pd.Series, lang: pd.Series, size: pd.Series) -> np.ndarray:
    """One row per page: hashed source and language, and size."""
    out = np.zeros((len(source), SOURCES + LANGS + 2))
    rows = np.arange(len(source))
    out[rows, _hashed(source, SOURCES)] = 1
    out[rows, SOURCES + _hashed(lang, LANGS)] = 1
    known = size.notna().to_numpy()
    out[:, -2] = np.log1p(np.maximum(size.fillna(0).to_numpy(np.float64), 0))
    out[:, -1] = known
    return out


def _hashed(values: pd.Series, n: int) -> np.ndarray:
    codes, names = pd.factorize(values.fillna("\0"))
    keys = [int.from_bytes(str(x).encode("utf-8", "surrogatepass")[:64], "little") % (2**61 - 1) for x in names]
    return (mixed(np.array(keys, np.uint64), 21) % np.uint64(n)).astype(np.int64)[codes]


class Linear(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.weights + self.bias, -30, 30)


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 15) -> Linear:
    """Logistic regression with standardised features and an L2 penalty, by Newton's method."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w, ridge = np.zeros(z.shape[1]), np.full(z.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(
            (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w
        )
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Linear(mean, scale, w[:-1], float(w[-1]))


class Model(NamedTuple):
    """Both views, their calibration, and how they are combined; ``rate`` alone if nothing was learned."""

    views: tuple[Linear, Linear] | None
    calibrations: tuple[Linear, Linear] | None
    combined: Linear | None
    rate: float

    def score(self, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        if self.views is None:
            return np.full(len(views[0]), self.rate)
        logits = _calibrated(self.views, self.calibrations, views)
        return 1 / (1 + np.exp(-self.combined.logit(logits)))


def _calibrated(models, calibrations, views) -> np.ndarray:
    return np.stack([c.logit(m.logit(x)[:, None]) for m, c, x in zip(models, calibrations, views)], axis=1)


class Pool:
    """Unlabelled rows in memory: the two views."""

    def __init__(self, views: tuple[np.ndarray, np.ndarray]):
        self.views = views
        self.used = np.zeros((2, len(views[0])), bool)

    def surest(self, models: tuple[Linear, Linear], limits: tuple[int, int], sure: float) -> dict[tuple[int, int], np.ndarray]:
        """For (view, label) the other view of the rows that the view is surest of, and never gave before."""
        found = {}
        for v in (0, 1):
            p = 1 / (1 + np.exp(-models[v].logit(self.views[v])))
            for label, confidence in ((1, p), (0, 1 - p)):
                open_rows = np.flatnonzero((confidence >= sure) & ~self.used[1 - v])
                taken = open_rows[np.argsort(-confidence[open_rows], kind="stable")[: limits[label]]]
                self.used[1 - v, taken] = True
                found[v, label] = self.views[1 - v][taken]
        return found


class StoredPool:
    """All unlabelled rows of a table of features (key, text_view, meta_view), scored where they are."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.select("key", "text_view", "meta_view")
        self.used: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def surest(self, models: tuple[Linear, Linear], limits: tuple[int, int], sure: float) -> dict[tuple[int, int], np.ndarray]:
        used = self.used

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict[tuple[int, int], list] = {}
            for batch in batches:
                keys, views = batch.column(0).to_numpy(), [_matrix(batch.column(v + 1), v) for v in (0, 1)]
                for v in (0, 1):
                    p = 1 / (1 + np.exp(-models[v].logit(views[v].astype(np.float64))))
                    given = np.isin(keys, used[1 - v])
                    for label, confidence in ((1, p), (0, 1 - p)):
                        taken = np.flatnonzero((confidence >= sure) & ~given)
                        old = kept.get((v, label), [np.zeros(0), np.zeros(0, np.int64), np.zeros((0, views[1 - v].shape[1]), np.float32)])
                        sums = [np.concatenate(c) for c in zip(old, (confidence[taken], keys[taken], views[1 - v][taken]))]
                        # Copies once; then the surest, equal ones by key.
                        once = np.unique(sums[1], return_index=True)[1]
                        order = once[np.lexsort((sums[1][once], -sums[0][once]))][: limits[label]]
                        kept[v, label] = [c[order] for c in sums]
            for (v, label), (confidence, keys, other) in kept.items():
                n = len(keys)
                parts = [np.full(n, v, np.int32), np.full(n, label, np.int32), confidence, keys]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, parts), pa.array([x.tobytes() for x in other], pa.binary())],
                    ["view", "label", "confidence", "key", "other"],
                )

        found = self.rows.mapInArrow(best, "view int, label int, confidence double, key long, other binary")
        found = found.dropDuplicates(["view", "label", "key"]).withColumn("fold", F.pmod("key", F.lit(FOLDS)))
        limit = F.when(F.col("label") == 1, limits[1]).otherwise(limits[0])
        # First the surest of each fold, so that no task meets what all tasks have found.
        for group in (["view", "label", "fold"], ["view", "label"]):
            place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("confidence"), "key"))
            found = found.withColumn("place", place).filter(F.col("place") <= limit)
        top = found.toPandas()
        out, now = {}, [list(u) for u in used]
        for v in (0, 1):
            for label in (0, 1):
                own = top[(top["view"] == v) & (top["label"] == label)].sort_values("place")
                out[v, label] = _matrix(pa.array(own["other"], pa.binary()), 1 - v).astype(np.float64)
                now[1 - v] += own["key"].tolist()
        self.used = tuple(np.array(u, np.int64) for u in now)
        return out


def co_train(
    labelled: tuple[np.ndarray, np.ndarray],
    y: np.ndarray,
    held: np.ndarray,
    pool: tuple[np.ndarray, np.ndarray] | Pool | StoredPool,
    rounds: int = 3,
    sure: float = 0.95,
    per_round: int = 500,
) -> Model:
    """``held`` marks the labelled rows kept for calibration; ``pool`` holds the views of unlabelled rows."""
    rate = (float(y.sum()) + 1) / (len(y) + 2)
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        return Model(None, None, None, rate)
    pool = Pool(pool) if isinstance(pool, tuple) else pool
    own = [[labelled[v][~held]] for v in (0, 1)]
    targets = [[y[~held]] for _ in (0, 1)]
    # As many of each label as its share among the labelled rows, the surest first.
    limits = (max(1, round(per_round * (1 - rate))), max(1, round(per_round * rate)))
    for n in range(rounds + 1):
        models = tuple(fit(np.concatenate(own[v]), np.concatenate(targets[v])) for v in (0, 1))
        if n < rounds:
            found = pool.surest(models, limits, sure)
            for v in (0, 1):
                for label in (1, 0):
                    own[1 - v].append(found[v, label])
                    targets[1 - v].append(np.full(len(found[v, label]), float(label)))
    views = tuple(x[held] for x in labelled)
    calibrations = tuple(fit(m.logit(x)[:, None], y[held]) for m, x in zip(models, views))
    combined = fit(_calibrated(models, calibrations, views), y[held])
    return Model(models, calibrations, combined, rate)


_PARTS = 1_000_000
#: Groups by key in which the surest rows of all tasks are first compared.
FOLDS = 256
_WIDTH = (_MEASURES + WORDS, SOURCES + LANGS + 2)


def _matrix(rows: pa.Array, view: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows.to_pylist()), np.float32).reshape(-1, _WIDTH[view])


def featured(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, key, y, text_view, meta_view) of every row; ``y`` is null without a label, or without an id."""
    votes = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.avg(F.col(label).cast("double")).alias("y"))
        .filter("y <> 0.5")
        .withColumn("y", (F.col("y") > 0.5).cast("double"))
    )
    key = F.xxhash64("doc_id", "text", "source", "lang", "n_chars").alias("key")
    rows = docs.select("doc_id", key, "text", "source", "lang", "n_chars")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("cotrain")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                source, lang, size = (part.column(k).to_pandas() for k in (3, 4, 5))
                views = text_features(part.column(2).to_pylist()), metadata_features(source, lang, size)
                columns = [pa.array([x.tobytes() for x in v.astype(np.float32)], pa.binary()) for v in views]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["doc_id", "key", "text_view", "meta_view"])

    found = rows.mapInArrow(features, f"doc_id {dict(docs.dtypes)['doc_id']}, key long, text_view binary, meta_view binary")
    return found.join(votes, "doc_id", "left")


def learn(features: DataFrame, max_labelled: int = 8000, rounds: int = 3, sure: float = 0.95, per_round: int = 500) -> Model:
    """The model from rows of features, as ``featured`` gives them."""
    known = features.filter("y IS NOT NULL")
    share = int(min(1.0, max_labelled / max(known.select("doc_id").distinct().count(), 1)) * _PARTS)
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(_PARTS))
    held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(10)) < 3
    rows = known.filter(place < share).select(held.alias("held"), "y", "text_view", "meta_view").toPandas()
    # In one order, whatever the partitioning, so that rounding doesn't differ between runs.
    rows = rows.sort_values(["text_view", "meta_view", "y"], kind="stable").reset_index(drop=True)
    views = tuple(_matrix(pa.array(rows[c], pa.binary()), v).astype(np.float64) for v, c in enumerate(("text_view", "meta_view")))
    pool = StoredPool(features.filter("y IS NULL AND doc_id IS NOT NULL"))
    return co_train(views, rows["y"].to_numpy(np.float64), rows["held"].to_numpy(bool), pool, rounds, sure, per_round)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.5, **learning) -> DataFrame:
    """(doc_id, score, text_score, meta_score, kept) of each row of ``docs``.

    ``docs`` has doc_id, text, source, lang and n_chars; ``labels`` has doc_id and the label.  ``learning``: ``learn``'s
    parameters.
    """
    docs = docs.select("doc_id", "text", "source", "lang", F.col("n_chars").cast("double").alias("n_chars"))
    features = stored(featured(docs, labels.select("doc_id", label), label), "cotrain-features")
    model = learn(features, **learning)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = tuple(_matrix(batch.column(v + 1), v).astype(np.float64) for v in (0, 1))
            out = [model.score(views)]
            for k in (0, 1):
                if model.views is None:
                    out.append(np.full(batch.num_rows, model.rate))
                else:
                    out.append(1 / (1 + np.exp(-model.calibrations[k].logit(model.views[k].logit(views[k])[:, None]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], ["doc_id", "score", "text_score", "meta_score"])

    kind = f"doc_id {dict(docs.dtypes)['doc_id']}, score double, text_score double, meta_score double"
    scored = features.select("doc_id", "text_view", "meta_view").mapInArrow(scores, kind)
    return scored.withColumn("kept", F.col("score") >= threshold)
