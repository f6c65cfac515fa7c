"""Merkle manifest of a dataset: trees of digests per language, and proofs by a recursive query."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

RUN = 8  # nodes under one parent
DEEP = 4  # levels above which nodes are repeated, once for each block of RUN ** DEEP leaves
BLOCK = RUN**DEEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 3  # a leaf is tampered with if this divides the crc32 of its doc_id
TOP = -1  # the tree whose leaves are the others' roots
STATE = "tree, at, block, up, place, folded, siblings, step, doc_id, leaf"

_TEN = "spark.sql.cteRecursionRowLimit"


def encoded(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 bytes behind their number."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(text: Column) -> Column:
    """Digest of the FIELDS of a row, with the given text."""
    return F.unhex(F.sha2(F.concat(*[encoded(F.col(c) if c != "text" else text) for c in FIELDS]), 256))


def digest_of(digests: Column) -> Column:
    """H of packed 32-byte digests, which it reads as lower-case hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def ordered(rows: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """Rows with ``at``, their place (from 0) in the ascending order of ``keys`` within ``group``,
    and ``n``, the rows of the group. A group, also a null one, may hold any share of all rows:
    these are sorted by ranges, numbered in each range, and only the numbers of rows per range
    are added up in one place per group."""
    by = [F.col(c).asc_nulls_first() for c in (group, *keys)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = cut(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", place), "ordered")
    sizes = ranged.groupBy("part", group).agg(F.min("at").alias("low"), F.count("*").alias("size"))
    whole = W.partitionBy(group)
    ahead = whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("part").alias("p"), F.col(group).alias("g"), F.sum("size").over(whole).alias("n"),
        (F.coalesce(F.sum("size").over(ahead), F.lit(0)) - F.col("low")).alias("shift"),
    )
    found = ranged.join(cut(sizes, "sizes"), (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g")))
    return found.withColumn("at", F.col("at") + F.col("shift")).drop("part", "p", "g", "shift")


def _height(n: str) -> str:
    return f"IF({n} = 1, 0, length(conv({n} - 1, 10, {RUN})))"


def _id(tree: object, level: object, at: str) -> str:
    return f"concat_ws('/', {tree}, {level}, {at})"


def _links(n_trees: int) -> list[Column]:
    """up, the parent's id (null at the root), and place, under it, of a node of a tree of n leaves."""
    inside = f"level < {_height('n')}"
    above = f"tree <> {TOP} AND {n_trees} > 1"
    up = f"CASE WHEN {inside} THEN {_id('tree', 'level + 1', f'at div {RUN}')} WHEN {above} THEN {_id(TOP, 1, f'tree div {RUN}')} END"
    return [F.expr(up).alias("up"), F.expr(f"CAST(CASE WHEN {inside} THEN at % {RUN} WHEN {above} THEN tree % {RUN} END AS INT)").alias("place")]


def levels(nodes: DataFrame) -> Iterator[DataFrame]:
    """The levels above (tree, level, at, n, hash), each written, as long as any tree has more
    than one node; a node's ``children`` are the digests of its run."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    while most > 1:
        runs = nodes.where(f"level < {_height('n')}").groupBy("tree", "level", "n", F.expr(f"at div {RUN}").alias("at"))
        held = runs.agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("place"), F.hex("hash").alias("hash")))).alias("held"))
        held = held.select("tree", (F.col("level") + 1).alias("level"), "at", "n", F.unhex(F.array_join("held.hash", "")).alias("children"))
        nodes = cut(held.withColumn("hash", digest_of(F.col("children"))), "level")
        yield nodes
        most = -(-most // RUN)


def _tops(nodes: DataFrame) -> DataFrame:
    return nodes.where(f"level = {_height('n')}").select("tree", "hash")


def manifest(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, bytes | None]:
    """(leaves, nodes, subroots, root) of the trees over ``docs``: a tree per lang, whose leaves
    ascend by doc_id (null first, equal ids by digest), and one over their roots by lang (null
    first, by UTF-8 bytes).

    leaves: (doc_id, tree, at, n, leaf, tampered, up, place); nodes: (tree, level, at, n,
    children, hash, up, place), parent-linked by ids ``tree/level/at``; subroots: (tree, hash);
    root: 32 bytes, null without rows.
    """
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    other = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    rows = rows.select("doc_id", "lang", leaf(F.col("text")).alias("leaf"), F.when(other, leaf(text)).alias("tampered"))
    rows = ordered(cut(rows, "leaves"), "lang", ["doc_id", "leaf"])
    langs = ordered(rows.where("at = 0").select("lang", F.lit(TOP).alias("top")), "top", ["lang"])
    langs = cut(langs.select(F.col("lang").alias("l"), F.col("at").alias("tree"), F.col("n").alias("trees")), "langs")
    first = langs.select("trees").first()
    n_trees = first.trees if first else 0
    # Langs that are few are broadcast by the planner, langs that are many are mostly small groups.
    rows = cut(rows.join(langs, F.col("lang").eqNullSafe(F.col("l"))).withColumn("level", F.lit(0)), "numbered")
    low = rows.select("tree", "level", "at", "n", F.col("leaf").alias("hash"))
    built = list(levels(low))
    trees = [_tops(x) for x in (low.where("n = 1"), *built)]
    subroots = trees[0]
    for tree in trees[1:]:
        subroots = subroots.union(tree)
    subroots = cut(subroots, "subroots")
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"), F.lit(n_trees).cast("long").alias("n"), "hash")
    upper = list(levels(top))
    root = (upper[-1] if upper else top).select("hash").first()
    nodes = None
    for level in (*built, *upper):
        level = level.select("tree", "level", "at", "n", "children", "hash", *_links(n_trees))
        nodes = level if nodes is None else nodes.union(level)
    leaves = rows.select("doc_id", "tree", "at", "n", "leaf", "tampered", *_links(n_trees))
    return leaves, nodes, subroots, bytes(root.hash) if root else None


def steps(leaves: DataFrame, nodes: DataFrame, n_trees: int) -> DataFrame:
    """Nodes by (tree, block, id), for the leaves of a block of BLOCK to climb. A node above
    several blocks is there once for each, so that no key is met by more than BLOCK leaves; the
    copies are one in BLOCK leaves for each level. They have a number, ``above``, that ascends
    with the level, and the place of the node below, ``below``, both null in other nodes."""
    own = nodes.withColumn("id", F.expr(_id("tree", "level", "at")))
    low = own.where(f"tree <> {TOP} AND level <= {DEEP}").select(
        "tree", F.expr(f"at div CAST(pow({RUN}, {DEEP} - level) AS BIGINT)").alias("block"), "id", "up", "place", "children",
        F.lit(None).cast("int").alias("above"), F.lit(None).cast("int").alias("below"),
    )

    def line(tree: object, first: int, last: str, leaf: str, base: int, number: str) -> str:
        at = lambda l: f"{leaf} div CAST(pow({RUN}, {l} - {base}) AS BIGINT)"
        node = f"struct({_id(tree, 'l', at('l'))} AS id, {number} AS above, CAST({at('l - 1')} % {RUN} AS INT) AS below)"
        return f"transform(filter(sequence({first}, greatest({first}, {last})), l -> l <= {last}), l -> {node})"

    inner = line("tree", DEEP + 1, _height("n"), "block", DEEP, "l")
    outer = line(TOP, 1, _height(str(n_trees)) if n_trees > 1 else "0", "tree", 0, "1000 + l")
    blocks = leaves.where(f"at % {BLOCK} = 0").select("tree", "n", F.expr(f"at div {BLOCK}").alias("block"))
    high = blocks.select("tree", "block", F.inline(F.expr(f"concat({inner}, {outer})")))
    return low.union(high.join(own.select("id", "up", "place", "children"), "id").select(*low.columns))


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_TEN, None)
    spark.conf.set(_TEN, "-1")
    try:
        yield
    finally:
        spark.conf.unset(_TEN) if before is None else spark.conf.set(_TEN, before)


def climb(leaves: DataFrame, path: DataFrame) -> DataFrame:
    """A row per leaf and step of a recursive query that ascends from every leaf: the digest
    folded so far, which starts as that of the tampered row, if there is one, and the siblings
    met (in order, without the leaf's own node). Those above the block are the same for all its
    leaves and null here, see ``above_blocks``; this bounds what a leaf carries, whatever the
    height. ``path``: see ``steps``."""
    spark = leaves.sparkSession
    start = leaves.select(
        "tree", "at", F.expr(f"at div {BLOCK}").alias("block"), "up", "place", F.coalesce("tampered", "leaf").alias("folded"),
        F.lit(None).cast("binary").alias("siblings"), F.lit(0).alias("step"), "doc_id", "leaf",
    )
    run = "concat(substr(s.children, 1, 32 * c.place), {}substr(s.children, 32 * c.place + 33))"
    folded = f"unhex(sha2(lower(hex({run.format('c.folded, ')})), 256))"
    return spark.sql(
        f"""
        WITH RECURSIVE climb({STATE}) AS (
            SELECT {STATE} FROM {{start}}
            UNION ALL
            SELECT c.tree, c.at, c.block, s.up, s.place, {folded}, IF(s.above IS NULL, {run.format('')}, NULL), c.step + 1, CAST(NULL AS BIGINT), CAST(NULL AS BINARY)
            FROM climb c JOIN {{path}} s ON s.id = c.up AND s.tree = c.tree AND s.block = c.block
        )
        SELECT {STATE} FROM climb
        """,
        start=start, path=path,
    )


def above_blocks(path: DataFrame) -> DataFrame:
    """(tree, block, upper): the siblings that all leaves of a block meet above it, in order."""
    others = F.expr("concat(substr(children, 1, 32 * below), substr(children, 32 * below + 33))")
    rows = path.where("above IS NOT NULL").select("tree", "block", F.struct("above", F.hex(others).alias("others")).alias("met"))
    return rows.groupBy("tree", "block").agg(F.unhex(F.array_join(F.sort_array(F.collect_list("met"))["others"], "")).alias("upper"))


def verify(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, verified), one row per row of ``docs``;
    digests and proofs (the siblings' digests, level by level, left to right) are binary.

    Columns other than FIELDS count for nothing. Any null field has an encoding of its own; rows
    without lang are a tree like others. Rows without doc_id come first and are never tampered
    with. Rows with one doc_id are ordered by digest; equal rows are leaves of their own. No
    rows give no rows. A lone leaf is its tree's root and has no siblings there.
    """
    spark = docs.sparkSession
    leaves, nodes, subroots, root = manifest(docs)
    n_trees = subroots.count()
    if nodes is None:
        up = leaves.withColumn("proof", F.lit(b"")).withColumn("folded_root", F.coalesce("tampered", "leaf"))
        found, above = up.withColumn("block", F.lit(0).cast("long")), None
    else:
        path = cut(steps(leaves, nodes, n_trees), "path")
        with _any_number_of_rows(spark):
            # Of what was folded only the last goes on.
            last = F.when(F.col("up").isNull(), F.col("folded")).alias("folded")
            held = F.sort_array(F.collect_list(F.struct("step", "siblings", last, "doc_id", "leaf"))).alias("held")
            found = climb(leaves, path).groupBy("tree", "at", "block").agg(held).select(
                "tree", "block", F.expr("held[0].doc_id").alias("doc_id"), F.expr("held[0].leaf").alias("leaf"),
                F.unhex(F.array_join(F.transform("held", lambda x: F.coalesce(F.hex(x["siblings"]), F.lit(""))), "")).alias("proof"),
                F.expr("element_at(held, -1).folded").alias("folded_root"),
            )
            found, above = cut(found, "climbed"), above_blocks(path)
    blocks = leaves.where(f"at % {BLOCK} = 0").select("tree", F.expr(f"at div {BLOCK}").alias("block"))
    blocks = blocks.join(subroots.withColumnRenamed("hash", "subroot"), "tree")
    blocks = blocks.withColumn("upper", F.lit(b"")) if above is None else blocks.join(above, ["tree", "block"], "left")
    root, proof = F.lit(root).cast("binary"), F.concat("proof", F.coalesce("upper", F.lit(b"")))
    return found.join(blocks, ["tree", "block"]).select(
        "doc_id", "leaf", "subroot", root.alias("root"), proof.alias("proof"), "folded_root", (F.col("folded_root") == root).alias("verified")
    )


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), digests as hex text."""
    text = lambda c: F.lower(F.hex(c)).alias(c)
    proof = F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256")
    return found.select("doc_id", text("leaf"), text("subroot"), text("root"), proof, text("folded_root"), "verified")
