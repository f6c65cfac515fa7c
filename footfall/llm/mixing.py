"""Mixing sources to target weights with a splitting tree over output shards. DataFrame
operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut

WEIGHTS = (5, 2, 1)  # in turn, over the sources in ascending order
SHARE = 1.5  # of all words
MOST = 2  # times a source's or a document's own words
PIECES = 65536  # of a source, by a keyed hash: a target ends inside one of them
BLOCKS = 256  # of a source: what the tree deals to shards, each 256 pieces
DEPTH = 6  # of the splitting tree: 64 output shards


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _source_order() -> list[Column]:
    return [F.col("source").isNull(), F.encode("source", "UTF-8")]


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Sources in code-point order, null last, weigh 5, 2, 1, repeating, and share 1.5 times all
    words. A target stops at twice its source's words; the excess goes to the others by weight
    until none is above. Sources stop in the order of limit per weight: with the first k
    stopped the others get ``level`` per weight. Up to the right k the level rises, beyond it
    falls, and only from there on it stays within the next limit, so it is the largest such.
    One row per source goes through one task, which the numbering by order asks for.
    """
    place = F.row_number().over(W.orderBy(*_source_order())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), place % len(WEIGHTS) + 1)
    ranked = sizes.withColumn("weight", weight).withColumn("ratio", MOST * F.col("source_size") / F.col("weight"))
    rank = W.orderBy("ratio", *_source_order())
    stopped = F.coalesce(F.sum("source_size").over(rank.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    total = SHARE * F.sum("source_size").over(W.partitionBy())
    going = F.sum("weight").over(rank.rowsBetween(0, W.unboundedFollowing))
    ranked = ranked.withColumn("level", (total - MOST * stopped) / going)
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(W.partitionBy())
    return ranked.select(
        "source", "source_size",
        F.least((MOST * F.col("source_size")).cast("double"), level * F.col("weight")).alias("target"),
    )


def deal_blocks(quotas: DataFrame, seed: int, depth: int = DEPTH) -> DataFrame:
    """(source, copy, blocks) -> (source, copy, shards), the shard of each block.

    A tree halves the blocks of a node, so that its two sides differ by one block at most; a
    side takes the first half of the node's blocks in a keyed random order. Its number of each
    source's blocks is thereby a draw from the multivariate hypergeometric law, and all blocks
    are dealt exactly once.
    """
    block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    units = quotas.where("blocks > 0").select("source", "copy", block).withColumn("node", F.lit(0))
    for level in range(depth):
        key = F.xxhash64(F.lit(seed), F.lit(level), "node", F.coalesce("source", F.lit("")), F.col("source").isNull(), "copy", "block")
        node = W.partitionBy("node")
        rank = F.row_number().over(node.orderBy(key, *_source_order(), "copy", "block"))
        left = rank <= F.ceil((F.count("*").over(node) + F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(2))) / 2 - 0.5)
        units = units.withColumn("node", 2 * F.col("node") + F.when(left, 0).otherwise(1))
    inside = F.array_sort(F.collect_list(F.struct("block", F.col("node").alias("shard"))))
    return units.groupBy("source", "copy").agg(inside.getField("shard").alias("shards"))


def plan(docs: DataFrame, keep: list[str] | None = None, seed: int = 1) -> DataFrame:
    """The columns of ``docs`` (or ``keep``) as a struct ``doc``, with size, source_size, target, taken,
    copies: an array of (copy, words, shard, place).

    A keyed hash deals a source's documents into pieces and orders them. ``taken`` counts the
    words that the mix takes of a document: as many whole rounds over the source as fit into
    its target, then the pieces in order until the target is reached; the last document is
    cut. The tree deals the blocks of each round to output shards, ``place`` orders a shard.

    A null or empty text has size 0 and is never taken; a null source is a source. Rows equal
    in source, doc_id and text share what is taken of them evenly. Reruns agree, whatever the
    order or the partitions of the input. The documents themselves are not shuffled: they meet
    one row per source and the documents of the pieces in which a target ends.
    """
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc"),
        n_words(F.col("text")).alias("size"),
        "source", F.xxhash64(F.lit(seed), "doc_id", "text").alias("deal"),
    )
    sized = sized.withColumn("piece", F.pmod("deal", F.lit(PIECES)).cast("int"))
    light = cut(sized.select("source", "size", "deal", "piece"), "sizes")
    pieces = light.groupBy("source", "piece").agg(F.sum("size").alias("words"))
    goals = cut(targets(pieces.groupBy("source").agg(F.sum("words").alias("source_size"))), "targets")
    goals = goals.withColumn("rounds", F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("int"))
    goals = goals.withColumn("extra", F.floor("target") - F.col("rounds") * F.col("source_size"))
    g = goals.select(F.col("source").alias("s"), "extra")
    same = F.col("source").eqNullSafe(F.col("s"))
    # The piece in which the target ends: by blocks first, so that no window sees all pieces.
    blocks = pieces.groupBy("source", F.expr(f"piece div {PIECES // BLOCKS}").alias("block")).agg(F.sum("words").alias("words"))
    ends = _where_it_ends(blocks.join(g, same).drop("s"), "block")
    in_block = pieces.withColumn("block", F.expr(f"piece div {PIECES // BLOCKS}"))
    e = ends.select(F.col("source").alias("s"), F.col("block").alias("b"), F.col("room").alias("extra"))
    ends = _where_it_ends(in_block.join(e, same & (F.col("block") == F.col("b"))).drop("s", "b", "block"), "piece")
    ends = cut(ends.select(F.col("source").alias("s"), F.col("piece").alias("end"), "room"), "ends")
    rest = light.join(ends, same & (F.col("piece") == F.col("end")))
    rest = rest.groupBy("source", "deal").agg(F.max("size").alias("size"), F.count("*").alias("n"), F.max("room").alias("room"))
    ahead = W.partitionBy("source").orderBy("deal").rowsBetween(W.unboundedPreceding, -1)
    rest = rest.withColumn("ahead", F.coalesce(F.sum(F.col("n") * F.col("size")).over(ahead), F.lit(0)))
    left = F.least(F.greatest(F.col("room") - F.col("ahead"), F.lit(0)), F.col("n") * F.col("size"))
    rest = rest.withColumn("left", left)
    rest = rest.select(F.col("source").alias("s2"), F.col("deal").alias("d2"), F.expr("`left` div n").alias("part"))
    # Each round deals all blocks, the last one those up to the end.
    quotas = goals.join(ends, same, "left").select(
        "source", F.explode(F.sequence(F.lit(0), F.col("rounds"))).alias("copy"), "rounds",
        F.coalesce(F.col("end") / (PIECES // BLOCKS) + 1, F.lit(0)).cast("int").alias("last"),
    ).select("source", "copy", F.when(F.col("copy") < F.col("rounds"), BLOCKS).otherwise(F.col("last")).alias("blocks"))
    dealt = deal_blocks(quotas, seed).groupBy(F.col("source").alias("s3")).agg(
        F.map_from_entries(F.collect_list(F.struct("copy", "shards"))).alias("dealt")
    )
    rows = goals.drop("extra").join(ends, same, "left").drop("s")
    rows = cut(rows.join(dealt, F.col("source").eqNullSafe(F.col("s3")), "left").drop("s3").withColumnRenamed("source", "s"), "sources")
    out = sized.join(rows, same, "left").join(rest, same_deal(), "left")
    part = F.when(F.col("piece") < F.col("end"), F.col("size")).when(F.col("piece") == F.col("end"), F.col("part"))
    out = out.withColumn("part", F.coalesce(part, F.lit(0)).cast("long"))
    at = F.expr(f"piece div {PIECES // BLOCKS} + 1").cast("int")
    copy = F.transform(
        F.sequence(F.lit(0), F.col("rounds")),
        lambda c: F.struct(
            c.alias("copy"),
            F.when(c < F.col("rounds"), F.col("size")).otherwise(F.col("part")).alias("words"),
            F.get(F.element_at("dealt", c), at - 1).alias("shard"),
            F.xxhash64(F.lit(seed), F.lit("place"), c, "deal").alias("place"),
        ),
    )
    return out.select(
        "doc", "size", "source_size", "target",
        (F.col("rounds") * F.col("size") + F.col("part")).alias("taken"),
        F.filter(copy, lambda c: c["words"] > 0).alias("copies"),
    )


def same_deal() -> Column:
    return F.col("source").eqNullSafe(F.col("s2")) & (F.col("deal") == F.col("d2"))


def _where_it_ends(parts: DataFrame, name: str) -> DataFrame:
    """(source, <name>, words, extra) -> the part in which the running sum passes ``extra``,
    and how much of ``extra`` is left there (room). A source whose extra is 0 has none."""
    ahead = W.partitionBy("source").orderBy(name).rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    parts = parts.where("extra > ahead AND extra <= ahead + words")
    return parts.select("source", name, (F.col("extra") - F.col("ahead")).alias("room"))


def mix(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The mix itself: a row of ``docs`` for each copy taken, a cut copy with its first words,
    n_chars (if there is such a column) following the text, dealt to the shards of the tree
    and put into a random order inside each.

    Shards are split further by the hash of the place, so that their size is no limit.
    """
    copies = plan(docs, seed=seed).select("doc", "size", F.inline("copies"))
    text = F.when(F.col("words") == F.col("size"), F.col("doc.text")).otherwise(_first_words())
    out = copies.withColumn("text", text)
    spread = F.pmod("place", F.lit(64))
    out = out.repartition("shard", spread).sortWithinPartitions("shard", "place")
    columns = [
        F.col("text") if c == "text"
        else F.when(F.col("words") == F.col("size"), F.col("doc.n_chars")).otherwise(F.length("text")).cast(dict(docs.dtypes)[c]).alias(c)
        if c == "n_chars" else F.col("doc").getField(c).alias(c)
        for c in docs.columns
    ]
    return out.select(*columns)


def _first_words() -> Column:
    """The text up to the end of its first ``words`` words, with its white space."""
    parts = F.regexp_extract_all(F.col("doc.text"), F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(parts, 1, F.col("words").cast("int")), "")
