"""Byte-level BPE: ranked merges folded over the bytes of words by higher-order functions."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

TIMES = (1_640_531_527, 1_540_483_477)  # odd, below 2**31: products of 32-bit keys fit into a long
NO_MERGE = 2**31 - 1
HOT_WORDS = 1 << 18  # words with the most uses whose ids every worker gets: some 10 MB
HOT_BYTES = 64  # of such a word at most
LEVELS = 16  # of a word's count per power of two, for choosing them


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def words_of(text: Column, pattern: str) -> Column:
    """Matches of a tokenizer's pattern, with white space as Unicode has it."""
    pattern = pattern.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


class Ranks:
    """The rank map as a literal, folded once when planning, over pairs of ids (an id is its
    rank): the rank of a pair is that of the bytes of both together.

    Spark looks a key up in a map by a walk over all keys. So the literal is a hash table made
    of two arrays, the keys and their ranks, in which a key is at one of two places that
    products with two numbers give (cuckoo hashing).
    """

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values(), default=0) >= 1 << 16 or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("ranks below 65536 and one for each byte are needed")
        self.pairs = pairs = {
            ranks[piece[:i]] << 16 | ranks[piece[i:]]: rank
            for piece, rank in ranks.items()
            for i in range(1, len(piece))
            if piece[:i] in ranks and piece[i:] in ranks
        }
        self._bits = max(8, (2 * len(pairs)).bit_length())
        keys: list[int] = [-1] * (1 << self._bits)
        for key in pairs:
            at, turns = self._places(key)[0], 0
            while key >= 0:
                key, keys[at] = keys[at], key
                if key >= 0:
                    one, two = self._places(key)
                    at, turns = one + two - at, turns + 1
                    if turns > len(keys):
                        raise ValueError("the pairs do not fit into the table")
        self._table = F.struct(
            F.from_json(F.lit(json.dumps(keys)), "array<bigint>").alias("keys"),
            F.from_json(F.lit(json.dumps([pairs.get(k, 0) for k in keys])), "array<int>").alias("ranks"),
            F.from_json(F.lit(json.dumps([ranks[bytes([b])] for b in range(256)])), "array<int>").alias("bytes"),
        )

    def _places(self, key: int) -> tuple[int, int]:
        return tuple((key * m >> 31 - self._bits + 16) & ((1 << self._bits) - 1) for m in TIMES)

    def of(self, table: Column, left: Column, right: Column) -> Column:
        """The rank of a pair, NO_MERGE if it has none or a side is null."""
        key = F.shiftleft(left.cast("long"), 16).bitwiseOR(right.cast("long"))
        one, two = (
            F.shiftright(key * m, 31 - self._bits + 16).bitwiseAND((1 << self._bits) - 1).cast("int") for m in TIMES
        )
        return (
            F.when(F.get(table["keys"], one) == key, F.get(table["ranks"], one))
            .when(F.get(table["keys"], two) == key, F.get(table["ranks"], two))
            .otherwise(NO_MERGE)
        )

    def encode(self, word: Column) -> Column:
        """Array of ids of a word: of its neighbours the pair with the lowest rank, the leftmost
        of equals, is merged until no pair has a rank."""
        data = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
        chars = F.filter(F.split(data, ""), lambda c: c != "")
        return _at(self._table, lambda t: _at(F.transform(chars, lambda c: F.get(t["bytes"], F.ascii(c))), lambda x: self._fold(t, x)))

    def _fold(self, table: Column, parts: Column) -> Column:
        ranks = F.zip_with(parts, F.slice(parts, 2, F.size(parts)), lambda a, b: self.of(table, a, b))
        steps = F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1)))
        start = F.struct(parts.alias("parts"), ranks.alias("ranks"))
        return F.aggregate(steps, start, lambda state, _: self._merge(table, state))["parts"]

    def _merge(self, table: Column, state: Column) -> Column:
        parts, ranks = state["parts"], state["ranks"]

        def at(low: Column, i: Column) -> Column:
            before = F.when(i > 1, F.array(self.of(table, F.get(parts, i - 2), low))).otherwise(F.array().cast("array<int>"))
            return F.struct(
                F.concat(F.slice(parts, F.lit(1), i - 1), F.array(low), F.slice(parts, i + 2, F.size(parts))).alias("parts"),
                F.concat(
                    F.slice(ranks, F.lit(1), F.greatest(i - 2, F.lit(0))), before,
                    F.array(self.of(table, low, F.get(parts, i + 1))), F.slice(ranks, i + 2, F.size(ranks)),
                ).alias("ranks"),
            )

        # The rank of the pair is the id of what it becomes.
        return _at(F.array_min(ranks), lambda low: F.when(low == NO_MERGE, state).otherwise(
            _at(F.array_position(ranks, low).cast("int"), lambda i: at(low, i))
        ))


def _at(value: Column, build) -> Column:
    """``build`` over a value that is computed once for all its uses."""
    return F.element_at(F.transform(F.array(value), build), 1)


def _lists_cut(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the lists of a column have about ``most`` values together."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.list_value_length(batch.column(column)), np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            # A copy: some Arrow functions go wrong on slices of strings.
            yield batch.take(pa.array(np.arange(at, to)))
            at = to


def hot_words(words: DataFrame, most: int = HOT_WORDS) -> DataFrame:
    """(word) rows -> the distinct words used most, not more than ``most`` of them.

    The count above which words are hot comes from a histogram with LEVELS bins per power of
    two, so no sort of the words is needed.
    """
    counts = words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
    counts = counts.where(F.octet_length("word") <= HOT_BYTES)
    counts = cut(counts.select("word", F.floor(F.log2("n") * LEVELS).cast("int").alias("level")), "words")
    least, total = None, 0
    for level, n in sorted(counts.groupBy("level").count().collect(), reverse=True):
        total += n
        if total > most:
            break
        least = level
    return counts.where("false" if least is None else f"level >= {least}").select("word")


def merge_word(data: bytes, single: list[int], pairs: dict[int, int]) -> list[int]:
    """The same merges for one word, the next pair taken from a heap, so that a word of any
    length takes steps in proportion to it (times a logarithm)."""
    ids = [single[b] for b in data]
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    heap = [(rank, i) for i in range(len(ids) - 1) if (rank := pairs.get(ids[i] << 16 | ids[i + 1])) is not None]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        # An entry is stale if either side has been merged since.
        if ids[i] < 0 or j >= len(ids) or pairs.get(ids[i] << 16 | ids[j]) != rank:
            continue
        ids[i], ids[j] = rank, -1
        after[i] = k = after[j]
        if k < len(ids):
            before[k] = i
            if (new := pairs.get(rank << 16 | ids[k])) is not None:
                heappush(heap, (new, i))
        h = before[i]
        if h >= 0 and (new := pairs.get(ids[h] << 16 | rank)) is not None:
            heappush(heap, (new, h))
    return [i for i in ids if i >= 0]


Pass = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

CODED = "doc_id long, ids array<int>"
DECODED = f"{CODED}, packed binary, decoded binary"


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int = HOT_WORDS) -> DataFrame:
    """(doc_id, text) -> (doc_id, ids), one row per row; a null text counts as empty, an empty
    text has no ids."""
    split = _split(docs, pattern)
    return split.mapInArrow(_encoding(split, ranks, most), CODED)


def decode(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, ids) -> (doc_id, ids, packed, decoded): the ids as little-endian unsigned
    32-bit integers, and the bytes that they stand for. An unknown id is an error."""
    return tokens.mapInArrow(_decoding(tokens.sparkSession, ranks), DECODED)


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int = HOT_WORDS) -> DataFrame:
    """What ``decode`` makes of what ``encode`` gives, slice by slice in one Python worker a task
    instead of two."""
    split = _split(docs, pattern)
    there, back = _encoding(split, ranks, most), _decoding(docs.sparkSession, ranks)
    return split.mapInArrow(lambda batches: back(there(batches)), DECODED)


def _split(docs: DataFrame, pattern: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text"), pattern).alias("words"))


def _encoding(split: DataFrame, ranks: dict[bytes, int], most: int) -> Pass:
    """Batches of (doc_id, words) -> batches of (doc_id, ids).

    Distinct words are counted over the whole corpus, and the merges are folded once for each
    of the words used most; their ids, bounded in number and length, go to every worker. Other
    words are rare by that choice and are merged where they stand. So the documents are never
    shuffled, and no table that grows with them is broadcast.
    """
    spark = split.sparkSession
    rank_map = Ranks(ranks)
    hot = hot_words(split.select(F.explode("words").alias("word")), most)
    hot = hot.repartition(spark.sparkContext.defaultParallelism * 4)
    known = hot.select("word", rank_map.encode(F.col("word")).alias("ids")).toArrow()
    lists = known.column("ids").combine_chunks()
    table = spark.sparkContext.broadcast((
        known.column("word").combine_chunks().cast(pa.large_string()), np.asarray(lists.flatten(), np.int32),
        np.asarray(pc.list_value_length(lists), np.int32), [ranks[bytes([b])] for b in range(256)], rank_map.pairs,
    ))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids, sizes, single, pairs = table.value
        for batch in _lists_cut(batches, "words"):
            lists = batch.column("words")
            coded = lists.flatten().dictionary_encode()
            row = pc.index_in(coded.dictionary.cast(pa.large_string()), value_set=words)
            rare = coded.dictionary.filter(row.is_null()).to_pylist()
            merged = [merge_word(w.encode(), single, pairs) for w in rare]
            row = row.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            row[row < 0] = len(sizes) + np.arange(len(rare))
            every = np.concatenate([ids, np.array([i for m in merged for i in m], np.int32)])
            size = np.concatenate([sizes, np.array([len(m) for m in merged], np.int32)]).astype(np.int64)
            start = np.cumsum(size) - size
            row = row[np.asarray(coded.indices, np.int64)]
            count = size[row]
            ends = np.cumsum(count)
            flat = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[row] - (ends - count), count)
            docs = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))])
            bounds = np.concatenate([[0], ends])[docs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(every[flat]))], ["doc_id", "ids"]
            )

    return look_up


def _decoding(spark: SparkSession, ranks: dict[bytes, int]) -> Pass:
    """Batches of (doc_id, ids) -> batches of DECODED."""
    pieces = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in pieces] != list(range(len(pieces))):
        raise ValueError("ranks have gaps")
    table = spark.sparkContext.broadcast(pa.array([p for p, _ in pieces], pa.large_binary()))

    def concatenate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lists_cut(batches, "ids"):
            ids = batch.column("ids")
            each = np.asarray(pc.list_value_length(ids), np.int64)
            flat = ids.flatten()
            got = table.value.take(flat)
            ends = np.concatenate([[0], np.cumsum(each)])
            places = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(got), np.int64))])
            data = got.buffers()[2]
            start = np.frombuffer(got.buffers()[1], np.int64)[got.offset] if len(got) else 0
            data = memoryview(data)[start:] if data is not None else b""
            packed = np.asarray(flat, "<u4").tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), ids,
                pa.array([packed[4 * a : 4 * b] for a, b in zip(ends, ends[1:])], pa.binary()),
                pa.array([bytes(data[places[a] : places[b]]) for a, b in zip(ends, ends[1:])], pa.binary()),
            ], ["doc_id", "ids", "packed", "decoded"])

    return concatenate


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of ``docs``."""
    return encode_decode(docs, ranks, pattern).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
