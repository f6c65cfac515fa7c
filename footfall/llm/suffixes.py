"""Repeated passages by suffix arrays: induced sorting of shards, permuted common prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, joined, mixed, random_words, slices

LENGTH = 200  # bytes of a passage
GRAM = 40  # bytes of an anchor
SPAN = LENGTH - GRAM + 1  # places for an anchor in a passage
SHARD_BYTES = 4 << 20  # of text sorted at once, about

_BYTE = random_words(256, 21)
_STEP = random_words(8, 22) | np.uint64(1)


# --- suffix arrays -----------------------------------------------------------------------


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``t`` in order; ``t`` holds bytes, the last one a 0 that occurs
    nowhere else.

    Induced sorting: suffixes are classified as smaller (S) or larger (L) than their right
    neighbour; substrings between leftmost S places are sorted by induction and named, the
    string of their names is sorted, and its order induces that of all suffixes in two linear
    scans. The scans go bucket by bucket, each as a few array operations.
    """
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    step = np.sign(t[1:].astype(np.int16) - t[:-1])
    change = np.flatnonzero(step)
    # An equal neighbour has the type of the next place that differs.
    s_type = np.append(step[change[np.searchsorted(change, np.arange(n - 1))]] > 0, True)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    order = _induce(t, lms[np.argsort(t[lms], kind="stable")])
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = order[is_lms[order]]
    names = _names(t, lms, ordered)
    if names.max() + 1 < len(lms):
        ordered = lms[np.argsort(_ranks(names), kind="stable")]
    return _induce(t, ordered)


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """The rank of each leftmost-smaller substring, in text order, equal ones having one."""
    number = np.zeros(len(t), np.int64)
    number[lms] = np.arange(len(lms))
    size = np.append(np.diff(lms) + 1, 1)
    which = number[ordered]
    same = np.zeros(len(ordered), bool)
    pair = np.flatnonzero(size[which[1:]] == size[which[:-1]])
    # Compared symbol by symbol, those still equal only.
    a, b, left = ordered[pair], ordered[pair + 1], size[which[pair]]
    k = 0
    while len(pair):
        equal = t[a + k] == t[b + k]
        done = equal & (left == k + 1)
        same[pair[done] + 1] = True
        go = equal & ~done
        pair, a, b, left, k = pair[go], a[go], b[go], left[go], k + 1
    out = np.zeros(len(lms), np.int64)
    out[which] = np.cumsum(~same) - 1
    return out


def _ranks(names: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes of a string of names. If the names fit into bytes the string is
    sorted in the same way; else by ranks of twice as many names each time."""
    top = int(names.max()) + 1
    if top < 255:
        order = suffix_array(np.append(names + 1, 0).astype(np.uint8))[1:]
        out = np.empty(len(names), np.int64)
        out[order] = np.arange(len(names))
        return out
    rank, reach = names, 1
    while top < len(rank):
        key = rank * (top + 1)
        key[:-reach] += rank[reach:] + 1
        order = np.argsort(key)
        new = np.ones(len(key), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(new) - 1
        top, reach = int(rank.max()) + 1, 2 * reach
    return rank


def _induce(t: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The order of all suffixes that that of the leftmost S places, sorted, induces."""
    size = 256
    ends = np.cumsum(np.bincount(t[lms], minlength=size))
    given = np.split(lms, ends[:-1])
    large = _scan(t, given, range(size))
    small = _scan(t, [x[::-1] for x in large], range(size - 1, -1, -1))
    small[0] = np.array([len(t) - 1])
    return np.concatenate([part for c in range(size) for part in (large[c], small[c][::-1])])


def _scan(t: np.ndarray, given: list[np.ndarray], buckets: range) -> list[np.ndarray]:
    """One scan: each suffix met puts its left neighbour at the next place of that one's bucket
    if the bucket is still to come, or the same and the suffix is of the kind being placed."""
    waiting: list[list[np.ndarray]] = [[] for _ in given]
    placed: list[np.ndarray] = [np.zeros(0, np.int64)] * len(given)
    up = buckets.step > 0

    def put(places: np.ndarray, symbols: np.ndarray) -> None:
        order = np.argsort(symbols, kind="stable")
        places, count = places[order], np.bincount(symbols, minlength=len(given))
        at = 0
        for c in np.flatnonzero(count):
            waiting[c].append(places[at : at + count[c]])
            at += count[c]

    for c in buckets:
        wave = np.concatenate(waiting[c]) if waiting[c] else placed[c]
        waves = []
        while len(wave):
            waves.append(wave)
            left = wave[wave > 0] - 1
            symbol = t[left]
            later = symbol > c if up else symbol < c
            put(left[later], symbol[later])
            wave = left[symbol == c]
        placed[c] = np.concatenate(waves) if waves else placed[c]
        left = given[c][given[c] > 0] - 1
        symbol = t[left]
        later = symbol > c if up else symbol < c
        put(left[later], symbol[later])
    return placed


def permuted_lcp(t: np.ndarray, order: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, in text order: the place of the suffix before it in the array, and how
    many symbols the two share up to the next of the sorted places ``stops``.

    Where the symbols before the two agree, the value is that of the place to the left less
    one; only at other places, and after stops, are symbols compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    left = before - 1
    known = np.zeros(n, bool)
    known[1:] = (left[1:] >= 0) & (t[np.maximum(left[1:], 0)] == t[:-1])
    known[np.minimum(stops + 1, n - 1)] = False
    known[before < 0] = False
    at = np.flatnonzero(~known)
    room = stops[np.searchsorted(stops, at)] - at
    room[before[at] < 0] = 0
    padded = np.append(t, np.zeros(8, np.uint8))
    words = np.ndarray((n + 1,), "<u8", padded, strides=(1,))
    share = np.zeros(len(at), np.int64)
    going = np.flatnonzero(room > 0)
    a, b = at[going], before[at[going]]
    while len(going):
        differ = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        low = differ & (~differ + np.uint64(1))
        share[going] += np.where(differ == 0, 8, (np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64))
        go = (differ == 0) & (share[going] < room[going])
        going, a, b = going[go], a[go] + 8, b[go] + 8
    value = np.zeros(n, np.int64)
    value[at] = np.minimum(share, room)
    source = np.maximum.accumulate(np.where(known, -1, np.arange(n)))
    return before, np.maximum(value[source] - (np.arange(n) - source), 0)


def repeated(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece the places at which a string of ``length`` bytes starts that starts
    anywhere else in the pieces too. Bytes 254 and 255, which UTF-8 never has, are not allowed."""
    t = np.frombuffer(b"\xff".join(pieces) + b"\xff\xfe", np.uint8) + np.uint8(2)
    # 255 becomes 1, the end of a piece, and 254 becomes 0, the end of all.
    sizes = np.array([len(p) for p in pieces], np.int64)
    stops = np.append(np.cumsum(sizes + 1) - 1, len(t) - 1)
    before, share = permuted_lcp(t, suffix_array(t), stops)
    hit = np.flatnonzero(share >= length)
    found = np.zeros(len(t), bool)
    found[hit] = found[before[hit]] = True
    starts = np.cumsum(sizes + 1) - sizes - 1
    return [np.flatnonzero(found[a : a + n]) for a, n in zip(starts, sizes)]


# --- shards ------------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each place, by doubling: 1, 2, ... 32, and 32 + 8."""
    h, eight = _BYTE[data], None
    for k in range(5):
        h = h[: -(1 << k)] * _STEP[k] + h[1 << k :]
        if k == 2:
            eight = h
    return mixed(h[: len(data) - GRAM + 1] * _STEP[5] + eight[32:])


def _least(h: np.ndarray) -> np.ndarray:
    """The minimum of the SPAN values from each place on."""
    width, m = 1, h
    while 2 * width <= SPAN:
        m, width = np.minimum(m[:-width], m[width:]), 2 * width
    return np.minimum(m[: len(h) - SPAN + 1], m[SPAN - width :]) if SPAN > width else m


def _stretches(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of passages with the same anchor: (document, first passage, last passage, anchor's
    hash). The anchor of a passage is the smallest of its grams by hash, the leftmost of
    equals, so equal passages have equal anchors at equal places."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none
    h = _gram_hashes(data)
    low = _least(h)
    n = len(low)
    valid = np.zeros(n + 1, np.int64)
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= LENGTH:
            valid[a] += 1
            valid[b - LENGTH + 1] -= 1
    valid = np.cumsum(valid)[:n] > 0
    new = valid.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~valid[:-1] | (h[: n - 1] == low[:-1])
    opening = starts[:-1][np.diff(starts) >= LENGTH]
    new[opening] = True
    first = np.flatnonzero(new)
    if not len(first):
        return none, none, none, none
    doc = np.searchsorted(starts, first, "right") - 1
    last = np.minimum(np.append(first[1:], n) - 1, starts[doc + 1] - LENGTH)
    return doc, first, last, low[first].view(np.int64)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, starts = joined(batch.column("text"))
        doc, first, last, key = _stretches(data, starts)
        whole = data.tobytes()
        content = np.array([xxhash.xxh3_64_intdigest(whole[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())], np.uint64)
        yield pa.RecordBatch.from_arrays([
            batch.column("row").take(pa.array(doc)), pa.array(key), pa.array(content.view(np.int64)),
            pa.array(first - starts[doc], pa.int32()), pa.array(last - starts[doc], pa.int32()),
        ], ["row", "key", "content", "first", "last"])


def _packed(docs: DataFrame) -> DataFrame:
    """(row, packed): texts as compressed bytes, for a shuffle."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array([squeeze(x or b"") for x in texts], pa.binary())],
                [*[c for c in batch.schema.names if c != "text"], "packed"],
            )

    kinds = ", ".join(f"{c} {k}" for c, k in docs.dtypes if c != "text")
    return docs.mapInArrow(pack, f"{kinds}, packed binary")


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for row in batch.to_pylist():
            text = expand(row["packed"])
            parts = row["parts"]
            yield pa.RecordBatch.from_arrays([
                pa.array([p["key"] for p in parts], pa.int64()), pa.array([p["content"] for p in parts], pa.int64()),
                pa.array([text[p["first"] : p["last"] + LENGTH] for p in parts], pa.binary()),
            ], ["key", "content", "piece"])


def _sorted_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: shards of about SHARD_BYTES end between keys."""
    keys, contents, pieces, size = [], [], [], 0

    def marked() -> pa.RecordBatch:
        runs = []
        for places in repeated(pieces):
            edge = np.flatnonzero(np.diff(places) != 1)
            runs.append(np.stack([places[np.append(0, edge + 1)], places[np.append(edge, len(places) - 1)]], 1).ravel().tolist() if len(places) else [])
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(contents, pa.int64()), pa.array(runs, pa.list_(pa.int32()))], ["key", "content", "runs"]
        )

    for batch in batches:
        for key, content, piece in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "piece"))):
            if size >= SHARD_BYTES and key != keys[-1]:
                yield marked()
                keys, contents, pieces, size = [], [], [], 0
            keys.append(key)
            contents.append(content)
            pieces.append(piece)
            size += len(piece)
    if keys:
        yield marked()


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for packed, runs in zip(batch.column("packed").to_pylist(), batch.column("runs").to_pylist()):
            text, spans = expand(packed), []
            for run in sorted((x["a"], x["b"]) for x in runs or []):
                if spans and run[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], run[1])
                else:
                    spans.append(list(run))
            kept, at = [], 0
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            kept = b"".join([*kept, text[at:]])
            out.append((len(text), len(text) - len(kept), spans, kept))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
            pa.array([x[2] for x in out], pa.list_(pa.list_(pa.int32()))), pa.array([x[3] for x in out], pa.binary()),
        ], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept), one row per row of ``docs``: every byte of the
    UTF-8 text that a 200-byte string covers which also starts anywhere else is removed.

    Each passage of 200 bytes belongs to its smallest gram, its anchor; passages that follow
    each other with the same anchor are a stretch of text. Equal passages have equal anchors,
    so an anchor that occurs once has no repeat. Stretches equal as a whole are repeats of each
    other and stand for one piece; the different pieces of an anchor go to one shard, whose
    suffix array shows what they share. A passage is in one piece only, so it never meets
    itself. Documents are shuffled twice, compressed.

    Null and empty texts have no bytes. Equal rows repeat each other like other copies. Very
    long texts need memory for one text and its stretches in a task.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    docs = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    kinds = "row long, key long, content long, first int, last int"
    every = cut(docs.select("row", "text").mapInArrow(_anchored, kinds), "anchors")
    often = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    every = cut(every.join(often, "key"), "repeated")
    classes = cut(
        every.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(F.struct("row", "first", "last")).alias("one")),
        "classes",
    )
    several = classes.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    parts = classes.join(several, "key").select(
        "one.row", F.struct("key", "content", "one.first", "one.last").alias("part")
    ).groupBy("row").agg(F.collect_list("part").alias("parts"))
    packed = _packed(docs.select("row", "text")).join(parts, "row").dropDuplicates(["row"])
    pieces = packed.select("packed", "parts").mapInArrow(_cut_out, "key long, content long, piece binary")
    pieces = pieces.repartition("key").sortWithinPartitions("key")
    marks = cut(pieces.mapInArrow(_sorted_shards, "key long, content long, runs array<int>"), "marks")
    # A stretch that occurs whole elsewhere is removed whole, of others what their shard shows.
    whole = F.array(F.struct(F.col("first").alias("a"), (F.col("last") + LENGTH).alias("b")))
    pairs = F.transform(
        F.sequence(F.lit(0), F.expr("int(size(runs) div 2)") - 1),
        lambda i: F.struct(
            (F.col("first") + F.get("runs", 2 * i)).alias("a"),
            (F.col("first") + F.get("runs", 2 * i + 1) + LENGTH).alias("b"),
        ),
    )
    single = marks.where("size(runs) > 0")
    found = classes.select("key", "content", "n").join(single, ["key", "content"], "left").where("n > 1 OR runs IS NOT NULL")
    runs = F.when(F.col("n") > 1, whole).otherwise(pairs)
    spans = every.join(found, ["key", "content"]).select("row", F.explode(runs).alias("run"))
    spans = spans.groupBy("row").agg(F.collect_set("run").alias("runs"))
    joined_ = _packed(docs).join(spans, "row", "left").select("doc_id", "packed", "runs")
    return joined_.mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, spans array<array<int>>, kept binary"
    )


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
