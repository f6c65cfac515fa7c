"""Connected components, and links found through buckets. DataFrame operations only.

Both are built for buckets and hubs that hold much of the input: pairs within a bucket are
formed only with a few centres, and then between members that are still in different
components.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, drop

PILOT = 64  # the part of the buckets whose pairs tell how many rounds the last step takes


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (id, component_id), the smallest id reachable, for every linked id.

    Alternates large-star (every larger neighbour to the smallest) and small-star (every
    smaller neighbour to the smallest) until the links no longer change. Loops and links with
    a null end count for nothing.
    """
    links = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.inline(F.array(
                F.struct(F.col("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            ))
        )
        links, old = cut(small.where("u > v").distinct(), "links"), links
        drop(old)
    return links.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
        links.select("v", "v").distinct()
    )


def linked(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    prepare: Callable[[DataFrame], object] | None = None,
    bound: tuple[Callable[[DataFrame], DataFrame] | None, str] | None = None,
    turns: int = 2,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
    sized: tuple[str, str] | None = None,
    most: int | None = None,
) -> DataFrame:
    """Components under the links that ``verify`` keeps among pairs that share a bucket.

    ``buckets`` holds (bucket, id) rows, ``verify`` filters (a, b) pairs with a < b, and
    ``prepare`` is called once with the ids that share a bucket at all. In each turn the member
    that shares buckets with most others is a bucket's centre and meets all members, in the
    second turn the centre comes from what the first left unlinked. What then still shares a
    bucket across two components meets in full, so no link between components is lost; the
    largest component of a bucket is not paired with itself. ``bound`` keeps pairs from being
    formed that cannot be links: a function from (id) to (id, ...) rows, and a condition
    over ``l`` and ``r`` with those columns, the same if they are swapped; or ``narrow`` gives
    the last step other buckets: from the (id, part) still open, (bucket, id, ...) rows such that
    every link between them shares one, with the condition as the second of ``bound``, whose
    first is None then. ``sized`` names a column of ``buckets`` and tells, as SQL over ``low``
    and ``high``, which two of its values can be linked: members go that can be linked with
    neither neighbour in the order of that column, so a value between two must be nearer to
    both. With ``most``, the buckets are gone through in rounds of about so many rows, in the
    last step also of about so many pairs: only those of one round are on disk at a time. Returns (id, component_id) for every linked id.
    """
    # A window sorts a bucket's rows, on disk if they are many: one exchange, no join.
    size = F.count("*").over(W.partitionBy("bucket"))
    if sized is None:
        members = buckets.withColumn("size", size).where("size > 1")
    else:
        by, can = sized
        order = W.partitionBy("bucket").orderBy(by)
        fits = lambda low, high: f"coalesce({can.format(low=low, high=high)}, false)"
        members = buckets.withColumn("size", size).withColumn("low", F.lag(by).over(order)).withColumn("high", F.lead(by).over(order))
        members = members.where(f"{fits('low', by)} OR {fits(by, 'high')}").select("bucket", "id", "size")
    first = cut(members, "members")
    popular = first.groupBy("id").agg(F.sum("size").alias("popular"))
    members = first.join(popular, "id").select("bucket", "id", "popular")
    more = []
    if bound is not None and bound[0] is not None:
        more = [c for c in bound[0](popular.select("id")).columns if c != "id"]
        bounds = cut(bound[0](popular.select("id")), "bounds")
        members = members.join(bounds, "id")
    # Sorted by id, what is told of an id takes next to no room in the files.
    members = cut(members.sortWithinPartitions("id"), "members")
    drop(first, *([bounds] if more else []))
    if prepare is not None:
        prepare(members.select("id").distinct())
    rows = members.count() if most else 0
    edges = tested = parts = None
    for turn in range(turns + 1):
        last, rounds = turn == turns, max(1, -(-rows // most)) if most else 1

        def paired(k: int, rounds: int, turn: int = turn, last: bool = last) -> tuple[DataFrame | None, list[DataFrame]]:
            """Pairs of the k-th of so many rounds, None if no bucket is open, and tables that
            are read until the pairs are written."""
            now, used = members if rounds == 1 else members.where(F.pmod("bucket", F.lit(rounds)) == k), []
            if parts is None:
                now = now.withColumn("part", F.col("id"))
            else:
                now = now.join(parts.select("id", F.col("component_id").alias("part")), "id", "left")
                now = now.withColumn("part", F.coalesce("part", "id"))
                now = cut(_mixed(now), "open")
                used.append(now)
                if now.isEmpty():
                    return None, used
            pairs = _last(now, bound, narrow, used) if last else _centred(now, more, bound, turn)
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            return pairs.distinct(), used

        if last and most and rows >= PILOT:
            # How many pairs meet in full is known only when they are made.
            pairs, used = paired(0, PILOT)
            rounds = max(rounds, -(-(0 if pairs is None else pairs.count()) * PILOT // most))
            drop(*used)
        found, still_open = [], False
        for k in range(rounds):
            pairs, used = paired(k, rounds)
            if pairs is not None:
                still_open = True
                pairs = cut(pairs, "pairs")
            drop(*used)
            if pairs is None:
                continue
            if last:
                # One round's pairs are on disk at a time. Few of them come again in another.
                if not pairs.isEmpty():
                    found.append(cut(verify(pairs), "edges"))
                if most:
                    drop(pairs)
            else:
                found.append(pairs)
        if not still_open:
            break
        if not last:
            pairs = found[0]
            if len(found) > 1:
                pairs = cut(functools.reduce(DataFrame.union, found).distinct(), "pairs")
                drop(*found)
            if turn and pairs.isEmpty():
                # Pairs that no centre proposes may still be open: only the last step is whole.
                continue
            tested = pairs if tested is None else tested.union(pairs)
            found = [cut(verify(pairs), "edges")]
        if found:
            edges = functools.reduce(DataFrame.union, found if edges is None else [edges, *found])
            parts = components(edges)
    drop(members)
    return parts


def _centred(now: DataFrame, more: list[str], bound, turn: int) -> DataFrame:
    """Pairs (a, b) of each bucket's centre with the members of other parts. In later turns the
    centre comes from those that the first is not linked with."""
    rank = F.struct("popular", -F.col("id"))
    one = F.max_by(F.struct("id", "part", *more), rank).alias("c")
    centre = now.groupBy("bucket").agg(one)
    if turn:
        rest = now.join(centre, "bucket").where("part <> c.part")
        centre = rest.groupBy("bucket").agg(one)
    centre = centre.select("bucket", "c.*").alias("l")
    condition = "l.part <> r.part" + (f" AND {bound[1]}" if more else "")
    pairs = now.alias("r").join(centre, F.expr(f"l.bucket = r.bucket AND {condition}"))
    return pairs.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b"))


def _last(now: DataFrame, bound, narrow, used: list[DataFrame]) -> DataFrame:
    """Pairs (a, b) of the last step; tables written for it are added to ``used``."""
    if narrow is not None:
        ids = cut(now.select("id", "part").distinct(), "still")
        now = cut(_mixed(narrow(ids).join(ids, "id")), "narrow")
        used += [ids, now]
    return _across(now, bound, used)


def _mixed(now: DataFrame) -> DataFrame:
    """The rows of buckets with members of several parts."""
    mixed = now.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q")
    return now.join(mixed.select("bucket"), "bucket")


def _across(now: DataFrame, bound, used: list[DataFrame]) -> DataFrame:
    """Pairs (a, b) that share a bucket in different parts."""
    condition = "l.part <> r.part AND (r.largest OR l.id < r.id)"
    if bound is not None:
        condition = f"{condition} AND {bound[1]}"
    count = now.groupBy("bucket", "part").agg(F.count("*").alias("members"))
    top = count.groupBy("bucket").agg(F.max_by("part", F.struct("members", "part")).alias("top"))
    now = cut(now.join(top, "bucket").withColumn("largest", F.col("part") == F.col("top")).drop("top"), "open")
    drop(*used)
    used[:] = [now]
    pairs = now.where("NOT largest").alias("l").join(now.alias("r"), F.expr(f"l.bucket = r.bucket AND {condition}"))
    return pairs.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b"))
