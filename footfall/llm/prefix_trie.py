"""Prefix tries of conversations: containers of suffixes burst by their next turn, then swept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.session import scratch_path

from .common import cut

TURN = 20  # bytes of a packed turn: a 128-bit hash of role and text, and the text's code points
LIMIT = 4096  # suffixes in a container, at most
WEIGHT = 16 << 20  # bytes of them, at most, unless a container holds one suffix
SALTS = 64  # parts of a container's rows when many containers burst at once
FEW = 100_000  # containers bursting at once that are broadcast, of some 200 bytes each
CHUNK = 1 << 20  # bytes of joined ids in a row
LEADERS, LENT = 100, 6  # the first turns come from conversation c - c % LEADERS, fewer than LENT of them

SEQUENCES = "suffix binary, n long, low long, ends string"
NODES = "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NONE = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, packed): the turns of each conversation, by turn (null first; equal ones by
    their packed form), TURN bytes each. A null role or text is empty. Rows without conv_id
    belong to no conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    name = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    packed = F.concat(name, F.lpad(F.hex(F.length(text)), 2 * (TURN - 16), "0"))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", packed.alias("packed"))
    held = F.sort_array(F.collect_list(F.struct("turn", "packed")))
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(held["packed"], "")).alias("packed"))


def rebuilt(packed: DataFrame, leaders: int = LEADERS, lent: int = LENT) -> DataFrame:
    """(conv_id, packed): the first h turns of conversation c - c % leaders (all, if it has
    fewer; none, if there is no such conversation), then c's own without its first h, for
    h = crc32(c) % lent."""
    rows = packed.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % lent).cast("int"))
    rows = rows.withColumn("leader", F.expr(f"conv_id - conv_id % {leaders}"))
    heads = packed.where(f"conv_id % {leaders} = 0")
    heads = heads.select(F.col("conv_id").alias("leader"), F.substring("packed", 1, TURN * (lent - 1)).alias("head"))
    found = rows.join(heads, "leader", "left")
    head = F.coalesce(F.expr(f"substring(head, 1, {TURN} * h)"), F.lit(b""))
    return found.select("conv_id", F.concat(head, F.expr(f"substring(packed, {TURN} * h + 1)")).alias("packed"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id, packed) -> a row for each run of a key, or part of it of CHUNK bytes:
    its ids as text, and what all of the key share."""
    def row(key: str, first: int, n: int, ids: list[str], packed: bytes | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([key]), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([",".join(ids)]), pa.array([packed], pa.binary()),
        ], ["key", "low", "n", "ids", "packed"])

    last, ids, size, first, shared, out = None, [], 0, 0, None, []
    for batch in batches:
        for key, conv_id, packed in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "packed"))):
            if key != last or size >= CHUNK:
                if ids:
                    out.append(row(last, first, len(ids), ids, shared))
                shared = packed if key != last else None
                last, ids, size, first = key, [], 0, conv_id
            ids.append(str(conv_id))
            size += len(ids[-1]) + 1
            if len(out) >= 1024:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
    if ids:
        out.append(row(last, first, len(ids), ids, shared))
    if out:
        yield from pa.Table.from_batches(out).combine_chunks().to_batches()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_joined``, sorted by key and low -> one row per key, the hash made chunk by chunk."""
    last, digest, n, low, packed = None, None, 0, 0, b""

    def row() -> tuple:
        return packed, n, low, digest.hexdigest()

    for batch in batches:
        done = []
        for key, first, count, ids, shared in zip(*(batch.column(c).to_pylist() for c in ("key", "low", "n", "ids", "packed"))):
            if key != last:
                if last is not None:
                    done.append(row())
                last, digest, n, low, packed = key, hashlib.sha256(), 0, first, shared
            else:
                digest.update(b",")
            digest.update(ids.encode())
            n += count
        if done:
            yield _rows(done, SEQUENCES)
    if last is not None:
        yield _rows([row()], SEQUENCES)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, (_, k) in zip(zip(*rows), fields)], [c for c, _ in fields])


def sequences(conversations: DataFrame) -> DataFrame:
    """(suffix, n, low, ends), written: each distinct sequence of turns, how many conversations
    have it, the smallest, and the hash of all their ids in ascending order, joined by commas.

    Copies are sorted by ranges of ids and joined in parts by many tasks; one task then hashes a
    group's parts, in order, with one part of CHUNK bytes in memory.
    """
    rows = conversations.select("conv_id", F.md5("packed").alias("key"), "packed")
    sorted_rows = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = cut(sorted_rows.mapInArrow(_joined, "key string, low long, n long, ids string, packed binary"), "joined")
    return cut(parts.repartition("key").sortWithinPartitions("key", "low").mapInArrow(_hashed, SEQUENCES), "sequences")


def shared_prefix(a: bytes, b: bytes) -> int:
    """Bytes of the turns at the start that two packed sequences have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(differ[0]) // TURN * TURN


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("first").to_pylist(), batch.column("last").to_pylist())
        chains = [a[: shared_prefix(a, b)] for a, b in pairs]
        yield batch.drop_columns(["first", "last"]).append_column("chain", pa.array(chains, pa.binary()))


def _bursting(rows: DataFrame, least: str) -> DataFrame:
    """(container, heads, base, parent, n, low, chain) of the containers to burst: the chain is
    what all of the container's suffixes start with."""
    sizes = rows.groupBy("container").agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("suffix")).alias("bytes"), F.sum("n").alias("n"), F.min("low").alias("low"),
        F.min("suffix").alias("first"), F.max("suffix").alias("last"), F.any_value("heads").alias("heads"),
        F.any_value("base").alias("base"), F.any_value("parent").alias("parent"),
    )
    sizes = sizes.where(least).drop("rows", "bytes")
    kinds = "container string, n long, low long, heads array<string>, base long, parent long, chain binary"
    return cut(sizes.mapInArrow(_shared, kinds), "bursting")


def _with_heads(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows beside the containers that burst, a hot container's too: either those are few, and
    broadcast, or its rows are dealt to SALTS keys."""
    heads = heads.select("container", "chain", F.col("low").alias("head_low"))
    if heads.count() <= FEW:
        return rows.join(F.broadcast(heads), "container", "left")
    heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("suffix"), F.lit(SALTS)).cast("int"))
    return salted.join(heads, ["container", "salt"], "left").drop("salt")


def burst(found: DataFrame, limit: int = LIMIT, weight: int = WEIGHT) -> tuple[DataFrame, DataFrame | None]:
    """Containers no larger than the limits, and the heads over them.

    All sequences start in the container of the root, which always bursts. A container that
    bursts becomes a head: its members lose the chain of turns that they share and go to
    containers by their next turn, except the one that ends there. Containers that still
    exceed a limit burst in the next round, so every round ends at a branch of the trie.

    Returns rows (container, heads, base, parent, suffix, n, low, ends), where ``base`` turns lie
    above the suffix, ``parent`` is the smallest conversation through them, and ``heads`` are
    the heads above; and heads (container, heads, base, parent, n, low, chain, ends, n_children).
    """
    rows = found.withColumns({
        "container": F.lit(""), "heads": F.expr("CAST(array() AS array<string>)"), "base": F.lit(0).cast("long"), "parent": F.lit(None).cast("long"),
    })
    settled, all_heads, least = None, None, "true"
    while True:
        heads = _bursting(rows, least)
        if heads.isEmpty():
            settled = rows if settled is None else settled.union(rows.select(*settled.columns))
            return settled, all_heads
        met = cut(_with_heads(rows, heads), "met")
        calm = met.where("chain IS NULL").drop("chain", "head_low")
        left = F.expr("substring(suffix, octet_length(chain) + 1)")
        moved = met.where("chain IS NOT NULL").withColumn("suffix", left)
        ended = moved.where("octet_length(suffix) = 0").select("container", "ends")
        rows = moved.where("octet_length(suffix) > 0").select(
            F.md5(F.concat(F.col("container").cast("binary"), F.substring("suffix", 1, TURN))).alias("container"),
            F.concat("heads", F.array("container")).alias("heads"), (F.col("base") + F.expr(f"octet_length(chain) div {TURN}")).alias("base"),
            F.col("head_low").alias("parent"), "suffix", "n", "low", "ends", F.col("container").alias("above"),
        )
        below = rows.select("above", "container").distinct().groupBy(F.col("above").alias("container")).agg(F.count("*").alias("n_children"))
        heads = heads.join(ended, "container", "left").join(below, "container", "left")
        heads = cut(heads.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "heads")
        all_heads = heads if all_heads is None else all_heads.unionByName(heads)
        rows = rows.drop("above")
        settled = calm if settled is None else settled.union(calm.select(*settled.columns))
        least = f"rows > 1 AND (rows > {limit} OR bytes > {weight})"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of containers, sorted by container and suffix -> the nodes. Only the path to the
    present suffix is held."""
    out: list[tuple] = []
    path: list[list] = []  # [n, low, children, leaves, saved, ends, code points, children's rows]
    container, above, base, before = None, None, 0, b""

    def close(to: int) -> None:
        while len(path) > to:
            n, low, children, leaves, saved, ends, points, below = path.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * points
            depth = base + len(path) + 1
            # The parent's smallest conversation is known when it closes.
            out.extend((c[0], c[1], low, *c[3:]) for c in below)
            own = (depth, low, None, n, children, leaves, saved, ends or NONE)
            if path:
                top = path[-1]
                top[0] += n
                top[1] = min(top[1], low)
                top[2] += 1
                top[3] += leaves
                top[4] += saved
                top[7].append(own)
            else:
                out.append((*own[:2], above, *own[3:]))

    columns = ("container", "base", "parent", "suffix", "n", "low", "ends")
    for batch in batches:
        for key, depth, parent, suffix, n, low, ends in zip(*(batch.column(c).to_pylist() for c in columns)):
            if key != container:
                close(0)
                container, base, above, before = key, depth, parent, b""
            same = shared_prefix(before, suffix) // TURN
            close(same)
            for at in range(same * TURN, len(suffix), TURN):
                path.append([0, low, 0, 0, 0, None, int.from_bytes(suffix[at + 16 : at + TURN], "big"), []])
            top = path[-1]
            top[0], top[1], top[5], before = n, low, ends, suffix
            if len(out) >= 8192:
                yield _rows(out, NODES)
                out.clear()
    close(0)
    if out:
        yield _rows(out, NODES)


def _swept(settled: DataFrame) -> DataFrame:
    rows = settled.select("container", "base", "parent", "suffix", "n", "low", "ends")
    return rows.repartition("container").sortWithinPartitions("container", "suffix").mapInArrow(_sweep, NODES)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heads with what their subtrees hold -> the nodes of their chains, the head itself last."""
    columns = ("base", "parent", "n", "low", "chain", "ends", "n_children", "leaves", "saved")
    for batch in batches:
        out = []
        for base, parent, n, low, chain, ends, children, leaves, saved in zip(*(batch.column(c).to_pylist() for c in columns)):
            points = [int.from_bytes(chain[at + 16 : at + TURN], "big") for at in range(0, len(chain), TURN)]
            root = parent is None
            for depth in range(base + len(points), base - root, -1):
                last = depth == base + len(points)
                saved += (n - 1) * points[depth - base - 1] if depth > base else 0
                above = low if depth > base + 1 or root and depth > 0 else parent
                out.append((depth, low, above, n, children if last else 1, max(leaves, 1), saved, ends or NONE if last else NONE))
                if len(out) >= 8192:
                    yield _rows(out, NODES)
                    out = []
        if out:
            yield _rows(out, NODES)


def trie(conversations: DataFrame, limit: int = LIMIT, weight: int = WEIGHT) -> DataFrame:
    """The nodes of the trie over (conv_id, packed) conversations, as the columns NODES.

    A node is a distinct sequence of the first ``depth`` turns, the root that of none; its
    members are the conversations that start with it, conv_id the smallest of them. saved_tokens
    adds up (n_convs - 1) * code points of the last text over the subtree, ends_sha256 hashes the
    ids of the members that end there. Copies are one sequence before the trie is built, and
    heads add up what their containers report, so no task holds a subtree. No conversations have
    no trie, not even a root.
    """
    settled, heads = burst(sequences(conversations), limit, weight)
    if heads is None:
        return conversations.sparkSession.createDataFrame([], NODES)
    settled = cut(settled, "containers")
    path = scratch_path(conversations.sparkSession, "nodes")
    _swept(settled).write.parquet(path)
    swept = conversations.sparkSession.read.schema(NODES).parquet(path)
    # The top node of a container is the one below its parent: (depth, conv_id) names a node.
    tops = settled.groupBy("container").agg(F.any_value("heads").alias("heads"), (F.any_value("base") + 1).alias("depth"), F.min("low").alias("conv_id"))
    reports = tops.join(swept.select("depth", "conv_id", "n_leaves", "saved_tokens"), ["depth", "conv_id"])
    points = F.expr(f"transform(sequence(1, greatest(octet_length(chain) div {TURN}, 1)), i -> CAST(conv(hex(substring(chain, {TURN} * i - 3, 4)), 16, 10) AS BIGINT))")
    own = F.when(F.octet_length("chain") > 0, (F.col("n") - 1) * F.aggregate(points, F.lit(0).cast("long"), lambda x, y: x + y)).otherwise(F.lit(0).cast("long"))
    reports = reports.select("heads", "n_leaves", "saved_tokens").union(heads.select("heads", F.expr("IF(n_children = 0, 1L, 0L)"), own))
    below = reports.select(F.explode("heads").alias("container"), "n_leaves", "saved_tokens")
    below = below.groupBy("container").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    whole = heads.join(below, "container", "left").withColumns({"leaves": F.coalesce("leaves", F.lit(0).cast("long")), "saved": F.coalesce("saved", F.lit(0).cast("long"))})
    return swept.union(whole.mapInArrow(_chains, NODES))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie over conversations whose first turns are those of their leader; see ``turns``,
    ``rebuilt`` and ``trie``. Other columns than conv_id, turn, role and text count for nothing."""
    own = cut(turns(conversations), "turns")
    return trie(cut(rebuilt(own), "rebuilt")).select("conv_id", *[c.split()[0] for c in NODES.split(", ") if not c.startswith("conv_id")])
