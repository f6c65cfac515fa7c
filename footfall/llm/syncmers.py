"""Document fingerprints from closed syncmers over words. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut

K, S = 5, 2  # words of a k-mer and of its inner substrings
BUCKET = 256  # width in ids of the buckets in which neighbours meet


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Array of (position, hash): the closed syncmers of a text.

    A k-mer of words is one if the smallest of its inner s-mer hashes lies at its first or last
    place (ties count as smallest). Whether it is depends on its own words only, so shared
    passages have the same anchors in whatever context. A text with fewer than k words has one
    anchor, the whole sequence; without words, or null, none.
    """
    words = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1)), lambda w: F.xxhash64(w))
    span = k - s + 1

    def chosen(words: Column) -> Column:
        inner = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
        inner = F.filter(inner, lambda x: x.isNotNull())
        return _at(inner, lambda inner: F.filter(
            F.transform(
                F.sequence(F.lit(1), F.size(words) - k + 1),
                lambda i: F.when(
                    F.array_min(F.slice(inner, i, span)).isin(F.element_at(inner, i), F.element_at(inner, i + span - 1)),
                    F.struct(i.alias("position"), F.xxhash64(F.slice(words, i, k)).alias("hash")),
                ),
            ),
            lambda x: x.isNotNull(),
        ))

    def whole(words: Column) -> Column:
        return F.array(F.struct(F.lit(1).alias("position"), F.xxhash64(words).alias("hash")))

    none = F.expr("CAST(array() AS array<struct<position:int,hash:bigint>>)")
    return _at(words, lambda w: F.when(F.size(w) == 0, none).when(F.size(w) < k, whole(w)).otherwise(chosen(w)))


def _at(value: Column, build) -> Column:
    """``build`` over a value that is computed once for all its uses."""
    return F.element_at(F.transform(F.array(value), build), 1)


def hashes(found: Column) -> Column:
    """Hashes of all anchors in the order of the text."""
    return F.transform(found, lambda x: x["hash"])


def digest(hashes: Column) -> Column:
    """The fingerprint as 32 hex digits: two chained 64-bit hashes over all anchor hashes in
    order. It changes with every anchor, and every word with K - 1 others on either side is
    part of one. Without anchors it is empty."""
    halves = [F.lpad(F.lower(F.hex(h)), 16, "0") for h in (F.xxhash64(hashes), F.xxhash64(F.lit(1), hashes))]
    return F.when(F.size(hashes) == 0, F.lit("")).otherwise(F.concat(*halves))


def likeness(a: Column, b: Column) -> Column:
    """Share of common anchors (Jaccard), 0 to 1, of all distinct hashes of two texts. 1 if both
    have none, null if one is null."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(union == 0, F.lit(1.0)).otherwise(both / union).cast("double")


def passages(docs: DataFrame, pairs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """(a, b, start_a, start_b, n_words, n_anchors): the passages that the documents of each pair
    (a, b) of doc_ids share, found by positional matching of anchors.

    Equal anchors are matched, and matches at one offset that follow each other without a gap
    make a passage: between shared words no more than k - s places lie without an anchor, so a
    gap is an edit. Positions count words from 1. An anchor that a text has several times is
    matched in order, counted from the first and from the last, so the work is linear in the
    anchors. Passages of fewer than 2k - s - 1 words may hold no anchor and are not found. Texts with
    fewer than k words match as a whole or not at all. Pairs with a null or unknown id have no
    passage, pairs given twice count once; rows that share an id are matched each for itself.
    """
    pairs = pairs.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"))
    docs = docs.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi")
    size = F.least(F.lit(k), F.regexp_count("text", F.lit(WORD)))
    found = docs.select("id", F.xxhash64("text").alias("row"), size.alias("size"), F.inline(anchors(F.col("text"), k, s))).distinct()
    of = W.partitionBy("id", "row", "hash")
    found = found.withColumn("up", F.row_number().over(of.orderBy("position"))).withColumn("down", -F.row_number().over(of.orderBy(F.desc("position"))))
    found = cut(found.withColumn("nth", F.explode(F.array("up", "down"))).drop("up", "down"), "anchors")

    def end(name: str) -> DataFrame:
        return found.select(F.col("id").alias(name), F.col("row").alias(f"row_{name}"), F.col("position").alias(f"at_{name}"), "hash", "nth", "size")

    met = pairs.join(end("a"), "a").join(end("b").drop("size"), ["b", "hash", "nth"])
    met = met.select("a", "b", "row_a", "row_b", "at_a", (F.col("at_b") - F.col("at_a")).alias("offset"), "size").distinct()
    one = ["a", "b", "row_a", "row_b", "offset"]
    along = W.partitionBy(*one).orderBy("at_a")
    new = F.coalesce(F.col("at_a") - F.lag("at_a").over(along) > k - s, F.lit(True))
    met = met.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(along))
    runs = met.groupBy(*one, "run").agg(
        F.min("at_a").alias("start_a"), F.max("at_a").alias("last"), F.max("size").alias("size"), F.count("*").alias("n_anchors"),
    )
    words = (F.col("last") - F.col("start_a") + F.col("size")).alias("n_words")
    return runs.select("a", "b", "start_a", (F.col("start_a") + F.col("offset")).alias("start_b"), words, "n_anchors").distinct()


def with_next(docs: DataFrame, derived: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, text, the ``derived`` columns, next), where the struct ``next`` holds text and
    derived columns of the document that follows by doc_id, after the last the first. One
    shuffle of the texts, no sort of them all; derived columns are made behind it.

    Ids are cut into buckets of BUCKET ids, in which neighbours meet. Each bucket lends its
    first document to the bucket before, for that one's last. Only the list of buckets is
    ordered as a whole, and that in chunks. Rows with equal ids follow each other by text;
    null ids come last.
    """
    derived = derived or {}
    rows = docs.select("doc_id", "text", F.expr(f"doc_id div {BUCKET}").alias("bucket"), F.lit(False).alias("is_lent"))
    used = cut(docs.groupBy(F.expr(f"doc_id div {BUCKET}").alias("bucket")).agg(F.min("doc_id").alias("low")), "buckets")
    used = used.withColumn("chunk", F.expr(f"bucket div {4 * BUCKET}"))
    inner = W.partitionBy("chunk").orderBy(F.col("bucket").asc_nulls_last())
    line = W.orderBy(F.col("chunk").asc_nulls_last())
    ends = used.groupBy("chunk").agg(F.max("bucket").alias("top"))
    ends = ends.select(
        F.col("chunk").alias("c"),
        F.when(F.row_number().over(line) == 1, F.last("top").over(line.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .otherwise(F.lag("top").over(line)).alias("prior"),
    )
    used = used.withColumn("first", F.row_number().over(inner) == 1).withColumn("before", F.lag("bucket").over(inner))
    lends = used.join(ends, F.col("chunk").eqNullSafe(F.col("c")), "left").select(
        F.col("low"), F.when(F.col("first"), F.col("prior")).otherwise(F.col("before")).alias("to")
    )
    lends = cut(lends, "lends")
    lent = docs.join(lends, F.col("doc_id").eqNullSafe(F.col("low")))
    lent = lent.groupBy("doc_id", F.col("to").alias("bucket")).agg(F.min("text").alias("text"))
    lent = lent.select("doc_id", "text", "bucket", F.lit(True).alias("is_lent"))
    both = rows.union(lent).repartition("bucket").select("*", *[c.alias(name) for name, c in derived.items()])
    order = W.partitionBy("bucket").orderBy("is_lent", F.col("doc_id").asc_nulls_last(), "text")
    out = both.withColumn("next", F.lead(F.struct("text", *derived)).over(order)).where("NOT is_lent")
    return out.select("doc_id", "text", *derived, "next")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint, anchors) of each row: the digest and the whole list of
    (position, hash). A null text counts as empty; rows with equal ids stay rows of their own."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), anchors(F.col("text")).alias("anchors"))
    return rows.select("doc_id", "n_chars", digest(hashes(F.col("anchors"))).alias("fingerprint"), "anchors")


def edit_trial(docs: DataFrame) -> DataFrame:
    """Each document against an edited one (its last half of code points replaced by as many
    of the next document's first) and against the next document.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and n_anchors, n_aligned: anchors of the document, and how many of them the
    edited text has at the same position. A single document is its own next. Rows with equal
    ids follow each other by text and equal rows in any order, rows without id come last; a
    null text is empty. Texts without words have no anchors and are fully alike.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = with_next(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), {"found": _lists(F.col("text"))})
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next.text", F.lit(1), half))
    rows = rows.select(
        "doc_id", size.cast("long").alias("n_chars"), "found", F.col("next.found.hashes").alias("next"), edited.alias("edited"),
    )
    rows = rows.select(
        "doc_id", "n_chars", "found", "next", F.sha2("edited", 256).alias("edited_sha256"), _lists(F.col("edited")).alias("other"),
    )
    own, other = F.col("found.hashes"), F.col("other.hashes")
    placed = lambda side: F.zip_with(f"{side}.places", f"{side}.hashes", lambda at, h: F.xxhash64(at, h))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", digest(own).alias("fingerprint"), digest(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"), likeness(own, F.col("next")).alias("near_next"),
        F.size(own).cast("long").alias("n_anchors"),
        F.size(F.array_intersect(placed("found"), placed("other"))).cast("long").alias("n_aligned"),
    )


def _lists(text: Column) -> Column:
    """The anchors of a text as a struct of two arrays, which take less room than one of structs."""
    return _at(anchors(text), lambda x: F.struct(F.transform(x, lambda a: a["position"]).alias("places"), hashes(x).alias("hashes")))
