"""Token ids in files, compressed by Re-Pair grammars that allow random access."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import slices
from .word_ids import SLICE, encoder, spread

END = 1  # id that closes a document
CHUNK = 1 << 20  # ids that share a grammar, about; a longer document stays whole
FIRST_RULE = 1 << 16  # nonterminals start here, above the ids
PAIRS, LEAST = 1 << 14, 16  # pairs replaced in a round, at most; uses of a pair that is replaced
FILES = "shard int, chunk int, doc_ids array<long>, counts array<int>, n_ids long, rules binary, lengths binary, sequence binary"


def compress(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: (rules, lengths, sequence).

    In each round the pairs of neighbours used most, at least LEAST times, become nonterminals
    and are replaced from left to right, a pair that overlaps a replaced one staying. Rounds go
    on until no pair is used so often. Rule k, a row of two symbols, defines FIRST_RULE + k,
    which stands for lengths[k] ids.
    """
    sequence = np.array(ids, np.int32)
    rules, lengths = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    # Places of pairs that may be frequent: at first all, later those with a new symbol and those
    # that were frequent and stayed. No other pair can have become frequent.
    at = np.arange(max(len(sequence) - 1, 0))
    while len(at):
        pair = sequence[at].astype(np.int64) << 32 | sequence[at + 1]
        # Pairs whose hash is too rare are not frequent; only the others are sorted and looked up.
        short = _short(pair)
        maybe = np.flatnonzero(np.bincount(short, minlength=1 << 20)[short] >= LEAST)
        at, pair, short = at[maybe], pair[maybe], short[maybe]
        ordered = np.sort(pair)
        ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], [True] * min(len(ordered), 1)))
        uses = np.diff(ends, prepend=-1)
        often = np.flatnonzero(uses >= LEAST)
        if not len(often):
            break
        frequent = ordered[ends[often]]
        place = _find(frequent, pair, short)
        at, place = at[place >= 0], place[place >= 0]
        mark = np.zeros(len(sequence), bool)
        mark[at] = True
        if len(often) > PAIRS:
            some = np.sort(np.argsort(-uses[often], kind="stable")[:PAIRS])
            number = np.full(len(often), -1)
            number[some] = np.arange(len(some))
            frequent, place = frequent[some], number[place]
            at, place = at[place >= 0], place[place >= 0]
        index = np.arange(len(at))
        run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) == 1, 0, index))
        alternate = (index - run) % 2 == 0
        take = at[alternate]
        first = FIRST_RULE + len(rules)
        new = np.stack([frequent >> 32, frequent & 0xFFFFFFFF], axis=1)
        rules = np.concatenate([rules, new])
        lengths = np.concatenate([lengths, _lengths(new, lengths).sum(axis=1)])
        sequence[take] = first + place[alternate]
        stay = np.ones(len(sequence), bool)
        stay[take + 1] = False
        sequence, mark = sequence[stay], mark[stay]
        made = take - np.arange(len(take))
        mark[made] = True
        mark[np.maximum(made - 1, 0)] = True
        at = np.flatnonzero(mark[:-1])
    return rules.astype("<i4"), lengths.astype("<i4"), sequence.astype("<i4")


def _find(ordered: np.ndarray, pairs: np.ndarray, short: np.ndarray) -> np.ndarray:
    """The place of each pair among the ``ordered``, -1 if it is not there. Most are found by
    ``short``, their hashes; of those that share a hash all but one need a search."""
    slot = np.full(1 << 20, -1, np.int32)
    slot[_short(ordered)] = np.arange(len(ordered))
    found = slot[short]
    other = np.flatnonzero((found >= 0) & (ordered[found] != pairs))
    if len(other):
        near = np.minimum(np.searchsorted(ordered, pairs[other]), len(ordered) - 1)
        found[other] = np.where(ordered[near] == pairs[other], near, -1)
    return found


def _short(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def _lengths(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many ids each symbol stands for."""
    if not len(lengths):
        return np.ones(symbols.shape, np.int64)
    return np.where(symbols < FIRST_RULE, 1, lengths[np.maximum(symbols - FIRST_RULE, 0)])


def expand(rules: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """The ids that a sequence of symbols stands for. Each rule that it uses is expanded once."""
    deep = sequence >= FIRST_RULE
    number = np.zeros(len(rules), np.int64)
    number[sequence[deep] - FIRST_RULE] = 1
    used = np.flatnonzero(number)
    if not len(used):
        return sequence
    number[used] = np.arange(len(used))
    flat, owner = (used + FIRST_RULE).astype(sequence.dtype), np.arange(len(used))
    while (inner := flat >= FIRST_RULE).any():
        at = np.cumsum(inner) - inner + np.arange(len(flat))
        out = np.empty(len(flat) + int(inner.sum()), flat.dtype)
        pairs = rules[flat[inner] - FIRST_RULE]
        out[at[~inner]] = flat[~inner]
        out[at[inner]], out[at[inner] + 1] = pairs[:, 0], pairs[:, 1]
        flat, owner = out, np.repeat(owner, 1 + inner)
    each = np.bincount(owner)
    starts, sizes = sequence.astype(np.int64), np.ones(len(sequence), np.int64)
    row = number[sequence[deep] - FIRST_RULE]
    starts[deep], sizes[deep] = FIRST_RULE + (np.cumsum(each) - each)[row], each[row]
    return np.concatenate([np.arange(FIRST_RULE, dtype=flat.dtype), flat])[spread(starts, sizes)]


def window(rules: np.ndarray, lengths: np.ndarray, sequence: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a chunk: only the symbols that reach into it are expanded."""
    ends = np.cumsum(_lengths(sequence, lengths))
    lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    skipped = ends[lo - 1] if lo else 0
    return expand(rules, sequence[lo:hi])[start - skipped : stop - skipped]


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (
        np.frombuffer(row["rules"], "<i4").reshape(-1, 2), np.frombuffer(row["lengths"], "<i4"),
        np.frombuffer(row["sequence"], "<i4"),
    )


def write_ids(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encode each text (null: empty), close it with END, and write the ids in ascending order
    of doc_id: a shard per range of ids, cut into chunks with a grammar each.

    ``tokenizer`` is the tokenizer's JSON. Equal doc_ids are ordered by text, null ids come first.
    A task holds one chunk of ids and one slice of texts at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, chunk = encoder(shared.value), TaskContext.get().partitionId(), 0
        ids, names, counts, n = [], [], [], 0

        def packed() -> pa.RecordBatch:
            rules, lengths, sequence = compress(np.concatenate(ids))
            row = (shard, chunk, names, counts, n, rules.tobytes(), lengths.tobytes(), sequence.tobytes())
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [c.split()[0] for c in FILES.split(", ")])

        for batch in slices(batches, "text", SLICE):
            flat, each = coder.encode(batch.column("text"))
            ids.append(np.insert(flat, np.cumsum(each), END))
            names, counts = names + batch.column("doc_id").to_pylist(), counts + (each + 1).tolist()
            n += len(ids[-1])
            if n >= CHUNK:
                yield packed()
                ids, names, counts, n, chunk = [], [], [], 0, chunk + 1
        if ids:
            yield packed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(chunks, FILES).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from files that ``write_ids`` made, ids packed as
    little-endian unsigned 32-bit integers; start counts the ids of all documents before."""
    files = spark.read.schema(FILES).parquet(path)
    sizes = files.select("shard", "chunk", "n_ids")
    ahead = (W.unboundedPreceding, -1)
    inside = F.sum("n_ids").over(W.partitionBy("shard").orderBy("chunk").rowsBetween(*ahead))
    before = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = before.select("shard", F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(*ahead)), F.lit(0)).alias("before"))
    starts = sizes.select("shard", "chunk", F.coalesce(inside, F.lit(0)).alias("inside")).join(before, "shard")
    starts = starts.select("shard", "chunk", (F.col("before") + F.col("inside")).alias("start"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rules, _, sequence = _arrays(row)
                data = expand(rules, sequence).astype("<u4").tobytes()
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - counts), pa.array(counts),
                    pa.array([data[4 * (e - c) : 4 * e] for e, c in zip(ends, counts)], pa.binary()),
                ], ["doc_id", "start", "n_tokens", "ids"])

    return files.join(starts, ["shard", "chunk"]).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def read_window(spark: SparkSession, path: str, doc_ids: list[int], start: int, stop: int) -> DataFrame:
    """(doc_id, ids): ids ``start`` to ``stop`` of single documents, without expanding the rest
    of their chunks."""
    wanted = set(doc_ids)
    files = spark.read.schema(FILES).parquet(path).where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, doc_ids))))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.cumsum(row["counts"])
                for doc_id, count, end in zip(row["doc_ids"], row["counts"], ends):
                    if doc_id in wanted:
                        base = end - count
                        part = window(*_arrays(row), min(base + start, end), min(base + stop, end))
                        yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([part.tolist()], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return files.mapInArrow(windows, "doc_id long, ids array<int>")


def digest(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32)."""
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
