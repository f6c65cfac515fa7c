"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mixed, random_words, slices

ORDERS = (3, 4, 5, 6)  # characters of an n-gram
TRAIN_ROWS = 12_000  # labelled rows that a model learns from, at most
BITS = 20  # that name a feature: one tells if the n-gram crosses words, the others are of its hash
ACROSS = 0.1  # of its log-count ratio is the scale of an n-gram that crosses words
PARTS = 16  # tasks of a pass over the labelled rows, at most; each returns 4 bytes a feature
PENALTY = 0.1  # on the squared weights, against the loss summed over rows
STEPS = 20
BLOCK = 1 << 20  # characters that are hashed at a time
FOLDS = 5

_PLACE = random_words(max(ORDERS), 11) | np.uint64(1)
_TOP = np.uint64(65 - BITS)
_LOSS_UNIT = 1 << 20


@dataclass
class Model:
    weights: np.ndarray  # of each feature, log-count ratio times the learned weight
    bias: float


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in lower case, one after the other, and where each starts."""
    low = pc.utf8_lower(texts.fill_null("").cast(pa.large_string()))
    n = np.asarray(pc.utf8_length(low), np.int64)
    data = "".join(low.to_pylist()).encode("utf-32-le")
    return np.frombuffer(data, np.uint32), np.concatenate([[0], np.cumsum(n)])


def _hashed(codes: np.ndarray) -> dict[int, np.ndarray]:
    """For each order: the feature of the n-gram at each place. One crosses words if a blank or
    control character stands between its first and its last character."""
    blanks = np.concatenate([[0], np.cumsum(codes <= 32, dtype=np.int32)])
    mixed_codes = mixed(codes.astype(np.uint64) + np.uint64(1))
    total, out = np.zeros(len(codes), np.uint64), {}
    for n in range(1, min(max(ORDERS), len(codes)) + 1):
        total = total[: len(codes) - n + 1] + mixed_codes[n - 1 :] * _PLACE[n - 1]
        if n in ORDERS:
            across = blanks[n - 1 : -1] > blanks[1 : len(total) + 1]
            out[n] = ((total + np.uint64(n)) >> _TOP).astype(np.int32) | across.astype(np.int32) << (BITS - 1)
    return out


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct features of each text. A text too short for an n-gram, or null, has none."""
    codes, starts = _characters(texts)
    last = np.empty(1 << BITS, np.int32)
    lap = max(ORDERS) - 1

    def distinct(parts: list[np.ndarray]) -> np.ndarray:
        found = np.concatenate([np.zeros(0, np.int32), *parts])
        at = np.arange(len(found), dtype=np.int32)
        last[found] = at
        return found[last[found] == at]

    doc = 0
    while doc < len(starts) - 1:
        to = max(doc + 1, int(np.searchsorted(starts, starts[doc] + BLOCK, "right")) - 1)
        if starts[to] - starts[doc] > BLOCK:  # one long text
            cuts = range(starts[doc], starts[to], BLOCK)
            pieces = [distinct(list(_hashed(codes[at : min(at + BLOCK + lap, starts[to])]).values())) for at in cuts]
            yield distinct(pieces)
        else:
            found = _hashed(codes[starts[doc] : starts[to]])
            for lo, hi in zip(starts[doc:to] - starts[doc], starts[doc + 1 : to + 1] - starts[doc]):
                yield distinct([f[lo : max(lo, hi - n + 1)] for n, f in found.items()])
        doc = to


def _summed(sample: DataFrame, rates: Callable[[float, int], float], weights: np.ndarray, bias: float, unit: int) -> tuple[np.ndarray, int, int]:
    """For each feature the sum of ``rates(z, toxic)`` over the rows that have it, the sum over
    all rows, and the loss, in whole units: sums don't depend on the order of rows. The weights
    are broadcast for this pass only, so that passes don't pile up on the executors' disks."""
    sent = sample.sparkSession.sparkContext.broadcast(weights)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sums, total, loss = sent.value, np.zeros(1 << BITS, np.int32), 0, 0
        for batch in slices(batches, "text"):
            for toxic, found in zip(batch.column("toxic").to_pylist(), features(batch.column("text"))):
                z = bias + float(weights[found].sum(dtype=np.float64))
                rate = round(rates(z, toxic) * unit)
                sums[found] += rate
                total += rate
                loss += round((np.logaddexp(0, z) - toxic * z) * _LOSS_UNIT)
        yield pa.RecordBatch.from_arrays(
            [pa.array([sums.tobytes()], pa.binary()), pa.array([total], pa.int64()), pa.array([loss], pa.int64())],
            ["sums", "total", "loss"],
        )

    parts = sample.coalesce(PARTS).mapInArrow(add, "sums binary, total long, loss long").toArrow()
    sent.destroy(blocking=True)
    sums = np.zeros(1 << BITS, np.int64)
    for part in parts.column("sums"):
        sums += np.frombuffer(part.as_buffer(), np.int32)
    return sums, sum(parts.column("total").to_pylist()), sum(parts.column("loss").to_pylist())


def _slope(z: float, toxic: int) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -500, 500)))) - toxic


def ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-count ratios of features. Counts are scaled to the size of the rarer class, so that
    adding one to both favours neither and a feature of few rows stays near 0."""
    fewest = min(n_toxic, n_clean)
    return np.log(toxic * (fewest / n_toxic) + 1) - np.log(clean * (fewest / n_clean) + 1)


def scales(names: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """What features are scaled by: log-count ratios, times the standard errors by which their
    toxic rows differ from the expected number. No feature is left out, but the many that tell
    little take no weight from a word of few rows; those that cross words, of which each text
    has many for itself, count ACROSS of that."""
    share = n_toxic / (n_toxic + n_clean)
    expected = (toxic + clean) * share
    errors = np.abs(toxic - expected) / np.sqrt(expected * (1 - share))
    return ratios(toxic, clean, n_toxic, n_clean) * errors * np.where(names >> (BITS - 1), ACROSS, 1.0)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from at most ``rows`` labelled documents, drawn by a hash of their ids from those
    whose crc32(doc_id) mod 5 is not 0.

    Every n-gram counts: its hash names one of 2^BITS features, which a text has or not. Each
    feature is scaled by its log-count ratio (see scales), and weights are learned by logistic regression
    with a penalty on their squares; a pass over the rows sums the slopes in Spark, and sums of
    the model's size reach the driver. Nothing is chosen, so there are no ties to break. Rows
    that repeat a doc_id each count; of several labels the highest holds. Labels that are null,
    or without a document, count for nothing. Without rows of both classes all scores are the
    share of toxic rows.
    """
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").select("doc_id", "text", "toxic")
    sample = cut(sample.repartition(PARTS, F.xxhash64("doc_id", "text")), "labelled")
    sizes = {toxic: n for toxic, n in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    bias = float(np.log((n_toxic + 0.5) / (n_clean + 1.5)))
    weights = np.zeros(1 << BITS, np.float32)
    if not n_toxic or not n_clean:
        return Model(weights, bias)
    toxic, _, _ = _summed(sample, lambda z, toxic: toxic, weights, 0.0, 1)
    clean, _, _ = _summed(sample, lambda z, toxic: 1 - toxic, weights, 0.0, 1)
    used = np.flatnonzero(toxic + clean)
    ratio = scales(used, toxic[used], clean[used], n_toxic, n_clean)
    unit = (1 << 30) // (n_toxic + n_clean)

    def spread(point: np.ndarray) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[used] = ratio * point[:-1]
        return out

    def measured(point: np.ndarray) -> tuple[float, np.ndarray]:
        sums, total, loss = _summed(sample, _slope, spread(point), float(point[-1]), unit)
        slope = np.append(ratio * sums[used] / unit + PENALTY * point[:-1], total / unit)
        return loss / _LOSS_UNIT + PENALTY / 2 * float(point[:-1] @ point[:-1]), slope

    best = descend(measured, np.append(np.zeros(len(used)), bias))
    return Model(spread(best), float(best[-1]))


def descend(measured: Callable[[np.ndarray], tuple[float, np.ndarray]], point: np.ndarray, steps: int = STEPS, memory: int = 4) -> np.ndarray:
    """The least point of a smooth convex function, by limited-memory quasi-Newton steps."""
    value, slope = measured(point)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    first = float(np.linalg.norm(slope))
    for _ in range(steps):
        way, parts = -slope, []
        for move, turn in reversed(moves):
            part = float(move @ way) / float(move @ turn)
            way = way - part * turn
            parts.append(part)
        if moves:
            move, turn = moves[-1]
            way = way * (float(move @ turn) / float(turn @ turn))
        else:
            way = way / max(first, 1e-12)
        for (move, turn), part in zip(moves, reversed(parts)):
            way = way + (part - float(turn @ way) / float(move @ turn)) * move
        size, fall = 1.0, float(slope @ way)
        while True:
            there, slope_there = measured(point + size * way)
            if there <= value + 1e-4 * size * fall or size < 1e-3:
                break
            size /= 2
        if there >= value:
            break
        move, turn = size * way, slope_there - slope
        if float(move @ turn) > 0:
            moves = [*moves, (move, turn)][-memory:]
        point, done = point + move, value - there < 1e-4 * value
        value, slope = there, slope_there
        if done or np.linalg.norm(slope) < 1e-3 * first:
            break
    return point


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row of ``docs``, from its whole text and nothing else. A null or
    empty text scores as one without any n-gram; repeated rows score alike."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            z = np.array([float(model.weights[found].sum(dtype=np.float64)) for found in features(batch.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(model.bias + z, -500, 500))))], ["doc_id", "score"]
            )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(scores, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``. A row without doc_id
    is not held out."""
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
