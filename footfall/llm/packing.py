"""Best-fit packing of token ids into sequences, planned on a histogram of lengths."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.session import scratch_path

from .common import cut, slices
from .word_ids import SLICE, encoder

END = 1  # id that closes a document
ROOM = 4096  # ids in a sequence
RANKS = 256  # places of one length that meet the plan under one key
PIECES = "doc_id long, piece int, start long, length int, ids binary, part int, place long"
RUNS = "length int, low long, n long, first long, per int, at int"


def best_fit(counts: dict[int, int], room: int = ROOM) -> np.ndarray:
    """The plan: runs (length, low, n, first, per, at) that hold ``counts[length]`` pieces each.

    Longest first, a piece goes where it leaves the least room, else into a new sequence. Equal
    pieces and equally full sequences are handled together: piece number low + j of a length
    has place ``at + j % per * length`` in sequence ``first + j // per``, for j below n.
    Sequences that got the same pieces have following numbers. A sequence that takes a piece
    has, after all of that length, less than half the room it had, so each is met some
    log2(room) times, and each length splits two runs of sequences at most: the runs, and the
    time, are bounded by ``room``, whatever the number of pieces.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> (first, count)
    runs, sequences = [], 0
    has = np.zeros(room + 1, bool)

    def put(length: int, low: int, n: int, first: int, count: int, left: int) -> int:
        """Into ``count`` sequences from ``first`` on; returns how many pieces are left."""
        per = left // length
        full = min(count, n // per)
        used = [(first, full, per)] if full else []
        if full < count and n % per:
            used.append((first + full, 1, n % per))
        for start, many, each in used:
            runs.append((length, low, many * each, start, each, room - left))
            low, n = low + many * each, n - many * each
            free[left - each * length].append((start, many))
            has[left - each * length] = True
        taken = sum(many for _, many, _ in used)
        if taken < count:
            free[left].append((first + taken, count - taken))
            has[left] = True
        return n

    for length in sorted(counts, reverse=True):
        n = counts[length]
        for left in (np.flatnonzero(has[length:]) + length).tolist():
            if not n:
                break
            groups, free[left], has[left] = free[left], [], False
            for first, count in groups:
                if n:
                    n = put(length, counts[length] - n, n, first, count, left)
                else:
                    free[left].append((first, count))
                    has[left] = True
        if n:
            count = -(-n // (room // length))
            put(length, counts[length] - n, n, sequences, count, room)
            sequences += count
    return np.array(runs, np.int64).reshape(-1, 6)


def pieces(docs: DataFrame, tokenizer: str, room: int = ROOM) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, place), written: the ids of each text (null:
    empty) and END, cut after every ``room`` ids. ids are little-endian unsigned 32-bit integers,
    ``place`` numbers the pieces of one length within the task ``part``."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seen = encoder(shared.value), TaskContext.get().partitionId(), np.zeros(room + 1, np.int64)
        for batch in slices(batches, "text", SLICE):
            flat, each = coder.encode(batch.column("text"))
            data = np.insert(flat, np.cumsum(each), END).astype("<u4")
            size = each + 1
            many = -(-size // room)
            row = np.repeat(np.arange(len(size)), many)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            start = piece * room
            length = np.minimum(size[row] - start, room)
            ends = np.concatenate([[0], np.cumsum(length)])
            place = np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            kinds, first, uses = np.unique(length[order], return_index=True, return_counts=True)
            place[order] = np.arange(len(order)) - np.repeat(first, uses) + seen[length[order]]
            seen[kinds] += uses
            doc_id = batch.column("doc_id")
            for lo in range(0, len(row), 4096):
                hi = min(lo + 4096, len(row))
                offsets = pa.py_buffer(((ends[lo : hi + 1] - ends[lo]) * 4).astype(np.int32))
                ids = pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, offsets, pa.py_buffer(data[ends[lo] : ends[hi]].tobytes())])
                yield pa.RecordBatch.from_arrays([
                    doc_id.take(pa.array(row[lo:hi])), pa.array(piece[lo:hi], pa.int32()), pa.array(start[lo:hi]),
                    pa.array(length[lo:hi], pa.int32()), ids, pa.array(np.full(hi - lo, part), pa.int32()), pa.array(place[lo:hi]),
                ], [c.split()[0] for c in PIECES.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    path = scratch_path(docs.sparkSession, "pieces")
    rows.mapInArrow(cut_up, PIECES).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(PIECES).parquet(path)


def pack(docs: DataFrame, tokenizer: str, room: int = ROOM) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset), one row per piece of a document.

    A document is its text's ids by ``tokenizer`` (the tokenizer's JSON; null text: empty) and
    END. Only documents of more than ``room`` ids are cut. Sequences are filled from 0 on without gaps. The
    number of pieces of each length, at most ``room`` numbers, goes to the driver; the plan
    comes back as at most some twenty runs a length (see ``best_fit``). Pieces are numbered
    within their length (by task, then within it) and meet their run by length and number,
    RANKS numbers under one key, so that no length is hot. Other columns of ``docs`` are left
    out; null and repeated doc_ids have their rows packed like any other; pieces of one length
    are alike to the plan, so ties need no rule. No rows give no rows.
    """
    spark = docs.sparkSession
    found = pieces(docs, tokenizer, room)
    counts = cut(found.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    total = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = best_fit({r.length: r.n for r in total}, room)
    runs = spark.createDataFrame(pa.table(dict(zip([c.split()[0] for c in RUNS.split(", ")], plan.T))).to_pandas(), RUNS)
    runs = runs.withColumn("key", F.explode(F.sequence(F.expr(f"low div {RANKS}"), F.expr(f"(low + n - 1) div {RANKS}"))))
    ahead = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    numbered = found.join(before, ["part", "length"]).withColumn("number", F.col("before") + F.col("place"))
    numbered = numbered.withColumn("key", F.expr(f"number div {RANKS}"))
    met = numbered.join(runs, ["length", "key"]).where("number >= low AND number < low + n")
    return met.withColumn("j", F.col("number") - F.col("low")).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids",
        F.expr("first + j div per").alias("sequence_id"), F.expr("at + j % per * length").cast("long").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): each sequence's ids as one binary, and whose they are, in
    order. A sequence is bounded by its room."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", F.hex("ids").alias("ids")))).alias("held"))
    return rows.select("sequence_id", F.unhex(F.array_join("held.ids", "")).alias("ids"), F.col("held.doc_id").alias("doc_ids"))


def digest(packed: DataFrame) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
