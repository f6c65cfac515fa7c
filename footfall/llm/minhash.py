"""Near duplicates by MinHash: many universal hash minima, banding, check on full sets,
components by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, joined, mixed, powers, random_words, slices, small
from .graph import linked

SHINGLE = 5  # words
ROWS, BANDS = 5, 26  # a pair at 0.85 shares no band with a chance of 2.4e-7
PERCENT = 85

_BYTE = random_words(256, 1)
_PLACE = random_words(SHINGLE, 2) | np.uint64(1)
_A = random_words(ROWS * BANDS, 3) | np.uint64(1)
_B = random_words(ROWS * BANDS, 4)
_BASE = 0x9E3779B97F4A7C15


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased), and the number of words before each text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    first = np.flatnonzero(solid & (edge[:-1] | np.concatenate([[True], ~solid[:-1]])))
    at = np.flatnonzero(solid)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    word = np.searchsorted(at, first)
    inside = at - np.repeat(first, np.diff(np.append(word, len(at))))
    place = powers(_BASE, int(inside.max()) + 1)
    return mixed(np.add.reduceat(_BYTE[data[at]] * place[inside], word)), np.searchsorted(first, starts)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, bounds = word_hashes(*joined(texts))
    n = len(words) - SHINGLE + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for j in range(SHINGLE if n > 0 else 0):
        rolled += words[j : j + n] * _PLACE[j]
    rolled = mixed(rolled)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= SHINGLE:
            yield np.unique(rolled[lo : hi - SHINGLE + 1])
        elif hi > lo:
            yield mixed(np.array([(words[lo:hi] * _PLACE[: hi - lo]).sum() + np.uint64(hi - lo)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[at : at + 1024]
        np.minimum(low, (part[None, :] * _A[:, None] + _B[:, None]).min(axis=1), out=low)
    return low


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights, salt = random_words(ROWS, 5) | np.uint64(1), random_words(BANDS, 6)
    for batch in slices(batches, "text"):
        counts, one, two, bands = [], [], [], []
        for s in shingle_sets(batch.column("text")):
            counts.append(len(s))
            one.append(mixed(s).sum(dtype=np.uint64))
            two.append(np.bitwise_xor.reduce(mixed(s + np.uint64(7)), initial=np.uint64(0)))
            if len(s):
                low = _minima(s).reshape(BANDS, ROWS)
                bands.append(mixed((low * weights).sum(axis=1, dtype=np.uint64) + salt).view(np.int64))
            else:
                bands.append(np.zeros(0, np.int64))
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"),
            pa.array(counts, pa.int64()),
            pa.array(np.array(one, np.uint64).view(np.int64)),
            pa.array(np.array(two, np.uint64).view(np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*bands, np.zeros(0, np.int64)]))),
        ], ["doc_id", "n_shingles", "one", "two", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = list(shingle_sets(batch.column("text")))
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
            ["id", "shingles"],
        )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Words are runs of other than ASCII white space with A-Z lower-cased; a document's set are
    its distinct five-word shingles, with fewer words the whole sequence. Documents are linked
    if 100 * intersection >= percent * union (percent 85 or more, for which the bands are
    made); pairs that share a band are checked on their full sets of 64-bit shingle hashes.

    Equal sets are one node, so a group of copies is never paired. An empty or null text has
    no shingles and is linked with nothing, nor is a row with a null doc_id (its component_id
    is null and it is kept). Rows that share a doc_id are one node: each gets its component.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut(docs.mapInArrow(_signed, "doc_id long, n_shingles long, one long, two long, bands array<long>"), "signed")
    solid = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut(
        solid.groupBy("one", "two", "n_shingles").agg(F.min("doc_id").alias("id"), F.any_value("bands").alias("bands")),
        "classes",
    )
    buckets = classes.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = buckets.select(F.xxhash64("band", "key").alias("bucket"), "id").distinct()
    counts = classes.select("id", "n_shingles")

    sets: list[DataFrame] = []

    def prepare(ids: DataFrame) -> None:
        # Sets are made only of documents that share a band.
        ids = small(ids.withColumnRenamed("id", "doc_id"))
        found = docs.join(ids, "doc_id", "left_semi").mapInArrow(_sets, "id long, shingles array<long>")
        sets.append(cut(found, "sets"))

    def rarest(ids: DataFrame) -> DataFrame:
        """Of each document as many of its rarest shingles that a similar one has at least one of
        them: (bucket, id, n, place), without shingles that no other of ``ids`` has."""
        each = sets[0].join(ids.select("id"), "id", "left_semi").select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
        each = cut(each, "each")
        uses = each.groupBy("shingle").agg(F.count("*").alias("uses"))
        ordered = F.sort_array(F.collect_list(F.struct("uses", "shingle")))
        first = F.expr(f"n - CAST(ceil({percent} * n / 100) AS INT) + 1")
        held = each.join(uses, "shingle").groupBy("id", "n").agg(ordered.alias("held")).select("id", "n", F.slice("held", F.lit(1), first).alias("held"))
        held = held.select("id", "n", F.posexplode("held").alias("place", "one"))
        return held.where("one.uses > 1").select(F.col("one.shingle").alias("bucket"), "id", "n", "place")

    # What follows the first shared one of the rarest is all that two sets can share besides.
    possible = (
        f"100 * least(l.n, r.n) >= {percent} * greatest(l.n, r.n) AND "
        f"{100 + percent} * least(l.n - l.place, r.n - r.place) >= {percent} * (l.n + r.n)"
    )

    def verify(pairs: DataFrame) -> DataFrame:
        for end in "ab":
            pairs = pairs.join(counts.select(F.col("id").alias(end), F.col("n_shingles").alias(f"n{end}")), end)
        pairs = pairs.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b")
        for end in "ab":
            pairs = pairs.join(sets[0].select(F.col("id").alias(end), F.col("shingles").alias(f"s{end}")), end)
        shared = F.size(F.array_intersect("sa", "sb"))
        return pairs.where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b")

    parts = linked(buckets, verify, prepare, (None, possible), narrow=rarest)
    one, two, n = "one", "two", "n_shingles"
    # A null id never joins: its row keeps no class.
    by_set = classes.select(one, two, n, "id").join(parts, "id", "left")
    by_set = by_set.select(one, two, n, F.coalesce("component_id", "id").alias("component_id"))
    rows = signed.drop("bands").join(by_set, [one, two, n], "left")
    part = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    return rows.select("doc_id", n, part).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of each component those of its smallest doc_id."""
    found = near_duplicates(docs, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti")
