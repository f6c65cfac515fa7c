"""The operators applied to their tables, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.session import scratch_path

from . import bpe, merkle, packing, repair, suffixes
from .common import table
from .hnsw import near_vectors
from .lines import line_dedup
from .minhash import near_duplicates
from .mixing import plan
from .prefix_trie import conversation_trie
from .quality import classify
from .syncmers import edit_trial
from .toxicity import toxicity


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op5_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    path = scratch_path(spark, "ids")
    repair.write_ids(table(spark, sf_dir, "documents"), tokenizer, path)
    return repair.digest(repair.read_ids(spark, path))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(table(spark, sf_dir, "documents")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    found = classify(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", "text_score", "meta_score", "score", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return planned.select("doc.doc_id", "size", "source_size", "target", "taken", "copies.shard")


def op9_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_trial(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(merkle.verify(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_minhash, op3_byte_bpe, op4_lines, op5_repair, op6_suffixes, op7_quality, op8_mixing, op9_hnsw,
        op10_syncmers, op11_prefix_trie, op12_packing, op13_merkle,
    )
}

# Components as the smallest id reachable, from links (a, b) in both directions.
REACHED = """
    reached AS (
        SELECT id, id AS other FROM nodes
        UNION
        SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other
    ),
    parts AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
"""

# crc32 of decimal numbers: a table of the 256 bytes, then a fold over the digits.
CRC_TABLE = """
    crc_table AS (
        SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS c
            FROM (SELECT unnest(range(256)) AS i)
        )
    )
"""
CRC = """(xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])
), 4294967295))"""

#: For the rest SQL can't express the result: trained models, random draws, 64-bit hashes
#: that DuckDB lacks, and tokenizers. The tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_minhash": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^ 	-
]+') AS w
            FROM documents
        ),
        sets AS (
            SELECT doc_id AS id, CASE
                WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
            FROM words
        ),
        nodes AS (SELECT id, CAST(len(s) AS BIGINT) AS n FROM sets),
        each AS (SELECT id, unnest(s) AS shingle FROM sets),
        shared AS (
            SELECT x.id AS a, y.id AS b, count(*) AS k FROM each x JOIN each y ON x.shingle = y.shingle AND x.id < y.id
            GROUP BY x.id, y.id
        ),
        pairs AS (
            SELECT a, b FROM shared JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b
            WHERE 100 * k >= 85 * (p.n + q.n - k)
        ),
        links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
        {REACHED}
        SELECT id AS doc_id, n AS n_shingles, component_id, id = component_id AS kept FROM nodes JOIN parts USING (id)
    """,
    "op9_hnsw": f"""
        WITH RECURSIVE nodes AS (
            SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        ),
        links AS (
            SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y ON x.id <> y.id AND list_cosine_similarity(x.v, y.v) >= 0.9
        ),
        {REACHED},
        counts AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
        SELECT id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, id = component_id AS kept
        FROM nodes JOIN parts USING (id) LEFT JOIN counts USING (id)
    """,
    "op11_prefix_trie": f"""
        WITH RECURSIVE {CRC_TABLE},
        own AS (
            SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS s
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ),
        heads AS (SELECT *, {CRC.format("conv_id")} % 6 AS h FROM own, crc_table),
        built AS (
            SELECT c.conv_id, list_concat(coalesce(l.s[1:h], []), c.s[h + 1:]) AS s
            FROM heads c LEFT JOIN own l ON l.conv_id = c.conv_id - c.conv_id % 100
        ),
        prefixes AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS depth FROM built),
        nodes AS (
            SELECT s[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                coalesce(any_value(length(s[depth].text)), 0) AS points,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = depth), '')) AS ends_sha256
            FROM prefixes GROUP BY s[1:depth], depth
        ),
        below AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
        counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN below b ON b.depth = n.depth AND b.p = n.p),
        reports AS (
            SELECT p[1:up] AS p, up AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * points) AS saved_tokens
            FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted) GROUP BY ALL
        )
        SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
            CAST(r.n_leaves AS BIGINT) AS n_leaves, CAST(r.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM counted n JOIN reports r ON r.depth = n.depth AND r.p = n.p
        LEFT JOIN nodes a ON a.depth = n.depth - 1 AND a.p = n.p[1:n.depth - 1]
    """,
    "op13_merkle": f"""
        WITH RECURSIVE {CRC_TABLE},
        fields AS (
            SELECT coalesce(lang, '') AS g, lang IS NOT NULL AS named, doc_id, text, concat(
                coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')
            ) AS head, {CRC.format("doc_id")} % 3 = 0 AS other
            FROM documents, crc_table
        ),
        leaves AS (
            SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                sha256(head || coalesce(strlen(text) || ':' || CASE WHEN other THEN
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS tampered
            FROM fields
        ),
        placed AS (
            SELECT *, dense_rank() OVER (ORDER BY named, encode(g)) - 1 AS tree, count(*) OVER (PARTITION BY named, g) AS n,
                row_number() OVER (PARTITION BY named, g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM leaves
        ),
        lower_nodes AS (
            SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
            UNION ALL
            SELECT tree, level + 1, pos // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY pos))
            FROM lower_nodes WHERE n > 1 GROUP BY tree, level, pos // 8
        ),
        subroots AS (SELECT tree, level, h, count(*) OVER () AS n FROM lower_nodes WHERE n = 1),
        upper_nodes AS (
            SELECT 0 AS level, tree AS pos, n, h FROM subroots
            UNION ALL
            SELECT level + 1, pos // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY pos))
            FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 8
        ),
        tops AS (SELECT level, h FROM upper_nodes WHERE n = 1),
        -- All levels that a leaf climbs, those of its own tree first.
        nodes AS (
            SELECT tree, level, pos, n, h FROM lower_nodes WHERE n > 1
            UNION ALL
            SELECT s.tree, s.level + u.level, u.pos, u.n, u.h FROM subroots s, upper_nodes u WHERE u.n > 1
        ),
        climb AS (
            SELECT p.tree, p.pos AS leaf_pos, 0 AS level, CASE WHEN s.level = 0 THEN p.tree ELSE p.pos END AS pos,
                p.tampered AS folded, '' AS siblings
            FROM placed p JOIN subroots s USING (tree)
            UNION ALL
            SELECT c.tree, c.leaf_pos, c.level + 1, CASE WHEN any_value(s.level) = c.level + 1 THEN c.tree ELSE any_value(c.pos) // 8 END,
                sha256(string_agg(CASE WHEN m.pos = c.pos THEN c.folded ELSE m.h END, '' ORDER BY m.pos)),
                any_value(c.siblings) || coalesce(string_agg(m.h, '' ORDER BY m.pos) FILTER (m.pos <> c.pos), '')
            FROM climb c JOIN nodes m ON m.tree = c.tree AND m.level = c.level AND m.pos // 8 = c.pos // 8
            JOIN subroots s ON s.tree = c.tree
            GROUP BY c.tree, c.leaf_pos, c.level
        )
        SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(c.siblings) AS proof_sha256, c.folded AS folded_root,
            c.folded = t.h AS verified
        FROM placed p JOIN subroots s USING (tree) JOIN climb c ON c.tree = p.tree AND c.leaf_pos = p.pos, tops t
        WHERE c.level = s.level + t.level
    """,
}
