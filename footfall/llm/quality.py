"""Quality by co-training: a view of the text and a view of the page metadata teach each other."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, joined, slices, small
from .logistic import Sparse, logistic
from .minhash import word_hashes

TRAIN_ROWS = 12_000  # labelled rows, at most
ROUNDS, STEPS = 4, 2  # of exchanging pseudo-labels; Newton steps of each view in a round
SURE = 0.98  # a pseudo-label's probability at least
PENALTY = 1e-3
GRAIN = 1 << 20  # weights of rows are multiples of 1 / GRAIN, so that sums don't depend on their order
BINS = 12  # of a numeric feature, by quantiles of the training rows
HASHED = 64  # places for each of source and lang
REJECT_BELOW = 0.5  # or lower: at most LOSE of the good calibration rows may go
LOSE = 0.005

TEXT, META = range(15), range(15, 16)  # numeric features of each view; META also has hashes

_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1  # capitals
_CLASS[97:123] = 2  # small letters
_CLASS[48:58] = 3  # digits
_CLASS[[9, 11, 12, 13, 32]] = 4  # blanks
_CLASS[10] = 5  # line ends
_CLASS[[33, 63]] = 6  # loud marks
_CLASS[[34, 39, 40, 41, 44, 46, 58, 59, 45]] = 7  # quiet marks
_CLASS[128:] = 8  # bytes of other characters; all else is 0, symbols


def features(texts: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Numeric features of whole texts: shares of kinds of bytes and of words, and of n_chars.
    An empty or null text has zeros, a null n_chars counts as 0."""
    data, starts = joined(texts)
    words, bounds = word_hashes(data, starts)
    rows = len(starts) - 1
    n, m = np.diff(starts).astype(float), np.diff(bounds).astype(float)
    out = np.zeros((rows, 16))
    doc = np.repeat(np.arange(rows), np.diff(starts))
    kinds = np.bincount(doc * 9 + _CLASS[data], minlength=rows * 9).reshape(rows, 9)
    out[:, :9] = kinds / np.maximum(n, 1)[:, None]
    word_doc = np.repeat(np.arange(rows), np.diff(bounds))
    same = (words[1:] == words[:-1]) & (word_doc[1:] == word_doc[:-1]) if len(words) else np.zeros(0, bool)
    out[:, 9] = np.bincount(word_doc[1:][same], minlength=rows) / np.maximum(m, 1)
    order = np.lexsort((words, word_doc))
    w, d = words[order], word_doc[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    uses = np.diff(np.append(at, len(w)))
    distinct = np.bincount(d[at], minlength=rows)
    top = np.zeros(rows)
    np.maximum.at(top, d[at], uses)
    out[:, 10] = distinct / np.maximum(m, 1)
    out[:, 11] = top / np.maximum(m, 1)
    out[:, 12] = n / np.maximum(m, 1)
    out[:, 13] = np.log1p(m)
    out[:, 14] = kinds[:, 5] / np.maximum(m, 1)
    out[:, 15] = np.log1p(np.maximum(np.asarray(n_chars.cast(pa.float64()).fill_null(0)), 0))
    return out


def hashed(values: pa.Array) -> np.ndarray:
    """The place of each value among HASHED; null has place 0."""
    coded = values.cast(pa.string()).dictionary_encode()
    places = np.array([1 + zlib.crc32(v.encode()) % (HASHED - 1) for v in coded.dictionary.to_pylist()] + [0])
    return places[np.asarray(coded.indices.fill_null(-1))]


@dataclass
class View:
    """Logistic regression over binned numbers and hashed values."""

    numbers: list[int]
    names: int  # hashed columns that it uses
    edges: np.ndarray
    weights: np.ndarray  # the last is the bias
    scale: tuple[float, float] = (1.0, 0.0)

    def places(self, x: np.ndarray, names: np.ndarray) -> np.ndarray:
        """The weights that each row adds up."""
        base = len(self.numbers) * (BINS + 1)
        columns = [i * (BINS + 1) + np.searchsorted(self.edges[i], x[:, j]) for i, j in enumerate(self.numbers)]
        columns += [base + k * HASHED + names[:, k] for k in range(self.names)]
        return np.stack([*columns, np.full(len(x), len(self.weights) - 1)], axis=1)

    def logit(self, x: np.ndarray, names: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return a * self.weights[self.places(x, names)].sum(axis=1) + b

    def fit(self, x: np.ndarray, names: np.ndarray, y: np.ndarray) -> None:
        at = self.places(x, names)[:, :-1]
        rows = np.repeat(np.arange(len(x)), at.shape[1])
        matrix = Sparse(rows, at.ravel(), np.ones(at.size), (len(x), len(self.weights) - 1))
        weights, bias = logistic(matrix, y, penalty=PENALTY)
        self.weights = np.append(weights, bias)

    def sums(self, x: np.ndarray, names: np.ndarray, y: np.ndarray) -> np.ndarray:
        """What a Newton step needs of some rows: curvature, slope, number of rows."""
        at, d = self.places(x, names), len(self.weights)
        p = 1 / (1 + np.exp(-np.clip(self.weights[at].sum(axis=1), -500, 500)))
        curve, slope = np.rint(p * (1 - p) * GRAIN), np.rint((y - p) * GRAIN)
        cells = (at[:, :, None] * d + at[:, None, :]).reshape(len(x), -1)
        return np.concatenate([
            np.bincount(cells.ravel(), np.repeat(curve, cells.shape[1]), d * d),
            np.bincount(at.ravel(), np.repeat(slope, at.shape[1]), d), [len(x)],
        ]).astype(np.int64)

    def step(self, sums: np.ndarray) -> None:
        d, n = len(self.weights), sums[-1]
        pull = np.append(np.full(d - 1, PENALTY * n), 0.0)
        curve = sums[: d * d].reshape(d, d) / GRAIN + np.diag(pull + 1e-6 * n)
        self.weights = self.weights + np.linalg.solve(curve, sums[d * d : -1] / GRAIN - pull * self.weights)


def _view(numbers: range, names: int, x: np.ndarray) -> View:
    steps = np.linspace(0, 1, BINS + 1)[1:]
    edges = np.array([np.quantile(x[:, j], steps) for j in numbers])
    return View(list(numbers), names, edges, np.zeros(len(numbers) * (BINS + 1) + names * HASHED + 1))


@dataclass
class Model:
    text: View | None
    meta: View | None
    prior: float
    reject_below: float

    def scores(self, x: np.ndarray, names: np.ndarray) -> np.ndarray:
        """Probability of good quality by text, by metadata, and by both."""
        if self.text is None:
            z = np.full((len(x), 3), self.prior)
        else:
            a, b = self.text.logit(x, names), self.meta.logit(x, names)
            z = np.stack([a, b, a + b - self.prior], axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def row_key() -> list[Column]:
    """Two hashes of all that a score rests on, and the doc_id: rows that agree in them are alike."""
    given = [v for c in ("doc_id", "text", "lang", "source", "n_chars") for v in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*given).alias("one"), F.xxhash64(F.lit(1), *given).alias("two")]


FEATURES = "doc_id long, one long, two long, x array<double>, names array<int>"


def featured(docs: DataFrame) -> DataFrame:
    """FEATURES of each row of ``docs``, written: texts are read once."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            x = features(batch.column("text"), batch.column("n_chars"))
            names = np.stack([hashed(batch.column("source")), hashed(batch.column("lang"))], axis=1)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "one", "two")], _lists(x, pa.float64()), _lists(names, pa.int32())], ["doc_id", "one", "two", "x", "names"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), "text", F.col("n_chars").cast("long").alias("n_chars"), "source", "lang")
    return cut(rows.mapInArrow(made, FEATURES), "features")


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel(), kind), values.shape[1]).cast(pa.list_(kind))


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x, names = (np.asarray(batch.column(c).flatten()) for c in ("x", "names"))
    return x.reshape(batch.num_rows, -1), names.reshape(batch.num_rows, -1)


def sure(view: View, x: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that a view is sure of, and the labels it gives them."""
    z = view.logit(x, names)
    at = np.flatnonzero(np.abs(z) >= np.log(SURE / (1 - SURE)))
    return at, (z[at] > 0).astype(float)


def _pool_sums(pool: DataFrame, views: list[View], teachers: list[View]) -> list[np.ndarray]:
    """For each view the sums over all rows of the pool that its teacher is sure of. A task adds
    up its rows and reports one cell of the models' size, some tasks more add up those cells; the
    driver gets the square root of as many."""
    sizes = [len(v.weights) ** 2 + len(v.weights) + 1 for v in views]

    def cell(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(sizes), np.int64)
        for batch in batches:
            x, names = _arrays(batch)
            base = 0
            for view, teacher, size in zip(views, teachers, sizes):
                at, y = sure(teacher, x, names)
                for lo in range(0, len(at), 2048):
                    part = at[lo : lo + 2048]
                    total[base : base + size] += view.sums(x[part], names[part], y[lo : lo + 2048])
                base += size
        if total.any():
            yield cell(total)

    def summed(cells: Iterable[pa.Scalar]) -> np.ndarray:
        total = np.zeros(sum(sizes), np.int64)
        for one in cells:
            total += np.frombuffer(one.as_buffer(), np.int64)
        return total

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = summed(one for batch in batches for one in batch.column("sums"))
        if total.any():
            yield cell(total)

    # The features are small: as many parts as cores, since each reports sums of the models' size.
    cores = pool.sparkSession.sparkContext.defaultParallelism
    parts = pool.coalesce(cores).mapInArrow(added, "sums binary")
    got = parts.repartition(math.isqrt(cores)).mapInArrow(merged, "sums binary").toArrow()
    return np.split(summed(got["sums"]), np.cumsum(sizes)[:-1])


def train(rows: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """Learn from at most ``most`` labelled rows, drawn by a hash of their ids, and from all rows
    without such a label. ``rows``: see ``featured``.

    Both views are fitted to four fifths of the labelled rows. In each round each view then takes
    STEPS Newton steps over these and over every other row that the other view, as it was at the
    start of the round, is sure of, with the label it gives. On the last fifth of the labelled rows
    the views' logits are calibrated and the limit for rejecting is set. Without labels of both kinds
    nothing is rejected. Of rows that share a labelled doc_id the one with the smallest hashes
    stands for the label, and none is in the pool; a doc_id with several labels has the largest.
    """
    marked = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    light = rows.where("doc_id IS NOT NULL").select("doc_id").distinct()
    some = cut(marked.join(light, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "some")
    sample = rows.join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality").agg(F.min_by(F.struct("x", "names"), F.struct("one", "two")).alias("row"))
    table = sample.select("doc_id", "quality", "row.x", "row.names").toPandas().sort_values("doc_id")
    y = table["quality"].to_numpy(np.float64)
    good, bad = int((y == 1).sum()), int((y == 0).sum())
    prior = float(np.log((good + 1.0) / (bad + 0.5)))
    if min(good, bad) < 10:
        return Model(None, None, prior, 0.0)
    x, names = np.array(table["x"].tolist()), np.array(table["names"].tolist())
    apart = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in table["doc_id"]])
    pool = rows.join(F.broadcast(some.select("doc_id")), "doc_id", "left_anti").select("x", "names")
    text, meta = co_train(x, names, y, apart, lambda views, teachers: _pool_sums(pool, views, teachers))
    hold = apart
    if hold.sum() >= 50 and 0 < y[hold].sum() < hold.sum():
        for view in (text, meta):
            z = view.logit(x[hold], names[hold])
            one = Sparse(np.arange(len(z)), np.zeros(len(z), np.int64), z, (len(z), 1))
            a, b = logistic(one, y[hold], penalty=PENALTY, steps=2000)
            view.scale = (float(a[0]), float(b))
    model = Model(text, meta, prior, REJECT_BELOW)
    kept = model.scores(x[hold], names[hold])[y[hold] == 1, 2]
    if len(kept):
        model.reject_below = min(REJECT_BELOW, float(np.quantile(kept, LOSE)))
    return model


def co_train(x, names, y, apart, pool_sums) -> list[View]:
    """The two views after ROUNDS rounds. ``pool_sums(views, teachers)`` adds up the pool."""
    views = [_view(TEXT, 0, x), _view(META, 2, x)]
    for view in views:
        view.fit(x[~apart], names[~apart], y[~apart])
    for _ in range(ROUNDS):
        teachers = [replace(v) for v in views[::-1]]
        for _ in range(STEPS):
            for view, pooled in zip(views, pool_sums(views, teachers)):
                view.step(pooled + view.sums(x[~apart], names[~apart], y[~apart]))
    return views


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, one, two, text_score, meta_score, score, kept), one row per row of ``docs``:
    scores from 0 to 1, higher for better quality; one and two, see ``row_key``, name the row.
    Every whole text counts; null texts, languages, sources and n_chars have features of their
    own, other columns than these and doc_id count for nothing."""
    rows = featured(docs)
    model = train(rows, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(*_arrays(batch)) if batch.num_rows else np.zeros((0, 3))
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in ("doc_id", "one", "two")], *[pa.array(score[:, k]) for k in range(3)],
                pa.array(score[:, 2] >= model.reject_below),
            ], ["doc_id", "one", "two", "text_score", "meta_score", "score", "kept"])

    kinds = "doc_id long, one long, two long, text_score double, meta_score double, score double, kept boolean"
    return rows.mapInArrow(scored, kinds)


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps. Texts stay where they are: what meets them
    is the rejected rows' hashes."""
    gone = small(classify(docs, labels).where("NOT kept").select("one", "two").distinct())
    return docs.withColumns(dict(zip(_NAMES, row_key()))).join(
        gone.select(F.col("one").alias(_NAMES[0]), F.col("two").alias(_NAMES[1])), list(_NAMES), "left_anti"
    ).select(*[F.col(f"`{c}`") for c in docs.columns])


_NAMES = ("__key_one", "__key_two")
