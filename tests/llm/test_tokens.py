"""Token operators against the libraries, fingerprints and mixing against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from footfall.llm import bpe, mixing, repair, syncmers

tokenizers = pytest.importorskip("public_tokenizers")


def _texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.mark.parametrize("hot", [bpe.HOT_WORDS, 0])
def test_byte_bpe(spark, odd_docs, no_docs, ranks, hot):
    import tiktoken

    odd = spark.createDataFrame([(500, "I'll don't　we've  <|endoftext|> 12½ \x85\x1c日本語 \U0001F600\n\n  "), (501, "q" * 500)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").union(odd)
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(docs, ranks, tokenizers.PATTERN, hot)
    got = Counter((r.doc_id, tuple(r.ids)) for r in coded.collect())
    assert got == Counter((i, tuple(library.encode_ordinary(t))) for i, t in _texts(docs))
    back = Counter((r.doc_id, bytes(r.decoded)) for r in bpe.decode(coded, ranks).collect())
    assert back == Counter((i, t.encode()) for i, t in _texts(docs))
    assert bpe.round_trip(no_docs, ranks, tokenizers.PATTERN).count() == 0


def test_token_files(spark, odd_docs, no_docs, tmp_path):
    from tokenizers import Tokenizer

    with open(tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        text = file.read()
    library = Tokenizer.from_str(text)
    odd = spark.createDataFrame([(500, "I'll Don't\x85we've <|endoftext|> <|x 12½ é́ İ.'s ...\n\n"), (501, "q" * 500)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").union(odd)
    repair.write_ids(docs, text, str(tmp_path / "ids"))
    got = repair.digest(repair.read_ids(spark, str(tmp_path / "ids"))).collect()
    want, start = [], 0
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    for r in order:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    ids = library.encode(next(t for i, t in _texts(docs) if i == 130), add_special_tokens=False).ids
    (part,) = repair.read_window(spark, str(tmp_path / "ids"), [130], 50, 90).collect()
    assert part.ids == ids[50:90]
    repair.write_ids(no_docs, text, str(tmp_path / "none"))
    assert repair.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_grammar():
    rng = np.random.default_rng(0)
    for kinds, n in ((1, 5000), (3, 4000), (40, 20000), (40000, 500), (2, 1), (2, 0)):
        ids = rng.integers(0, kinds, n).astype(np.int32)
        rules, lengths, sequence = repair.compress(ids)
        assert (repair.expand(rules, sequence) == ids).all()
        for k, rule in enumerate(rules):
            assert lengths[k] == len(repair.expand(rules, rule))
        for start in range(0, n, 997):
            assert (repair.window(rules, lengths, sequence, start, start + 30) == ids[start : start + 30]).all()
    assert len(sequence) < 2 and len(repair.compress(np.zeros(5000, np.int32))[2]) < 200


def _targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        going = [s for s in order if s not in stopped]
        level = (total - sum(stopped.values())) / sum(weight[s] for s in going)
        over = [s for s in going if level * weight[s] > 2 * sizes[s]]
        if not over:
            return {s: stopped.get(s, level * weight[s]) for s in order}
        stopped |= {s: 2.0 * sizes[s] for s in over}


def test_mixing(spark, odd_docs, words_of):
    rows = mixing.plan(odd_docs).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == len(words_of(r.doc.text))
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == sum(c.words for c in r.copies)
        sizes[r.doc.source] += r["size"]
        taken[r.doc.source] += r.taken
    want = _targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.doc.source]
        assert r.target == pytest.approx(want[r.doc.source])
    # Rows equal in all that counts share what is left over evenly.
    assert all(abs(taken[s] - want[s]) <= 3 for s in want)
    again = mixing.plan(odd_docs.repartition(3)).collect()
    assert sorted(str(r.copies) for r in rows) == sorted(str(r.copies) for r in again)
    out = mixing.mix(odd_docs)
    assert out.columns == odd_docs.columns
    words = sum(len(words_of(r.text)) for r in out.collect())
    assert words == sum(r.taken for r in rows) and out.count() == sum(len(r.copies) for r in rows)


def test_mixing_of_nothing(spark, no_docs):
    assert mixing.plan(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.plan(blank).collect()] == [(0, 0.0, 0)] * 2


def test_tree_deals_every_block_once(spark):
    quotas = spark.createDataFrame([("a", 0, 256), ("a", 1, 37), (None, 0, 100), ("b", 0, 0)], "source string, copy int, blocks int")
    shards = Counter()
    for r in mixing.deal_blocks(quotas, seed=1, depth=3).collect():
        assert len(r.shards) == {("a", 0): 256, ("a", 1): 37, (None, 0): 100}[r.source, r["copy"]]
        shards.update(r.shards)
    assert sum(shards.values()) == 393 and len(shards) == 8
    assert max(shards.values()) - min(shards.values()) <= 3


def test_fingerprints(spark, odd_docs, no_docs):
    rows = syncmers.edit_trial(odd_docs).collect()
    order = sorted(_texts(odd_docs), key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))
    assert len(order) == len(rows)
    want = Counter()
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want[(i, len(text), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    prints = defaultdict(set)
    for r in rows:
        prints[r.doc_id].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert prints[100] == prints[None] - {""} and prints[123] == prints[124] and prints[121] == prints[120] == {""}
    long = [r for r in rows if r.doc_id in (1, 130) and r.n_chars > 100]
    assert all(r.near_edited > r.near_next for r in long)
    assert syncmers.edit_trial(no_docs).count() == 0


def test_anchors_are_free_of_context(spark):
    words = [f"w{i * i % 89}" for i in range(80)]
    passage = " ".join(words[20:60])
    texts = [passage, "a b c d e f " + passage, passage + " x y z u v w", " ".join(words)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [{a["hash"] for a in r[0]} for r in df.select(syncmers.anchors(df.text)).collect()]
    assert found[0] and all(found[0] <= f for f in found[1:])
    places = [[a.position for a in r[0]] for r in df.select(syncmers.anchors(df.text)).collect()]
    assert [p + 6 for p in places[0]] == [p for p in places[1] if 6 < p <= 6 + 36]


def test_closed_syncmers_by_definition(spark):
    import xxhash

    words = [f"w{i * i % 31}" for i in range(60)]

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def one(text, seed=42):
        return signed(xxhash.xxh64(text.encode(), seed=seed).intdigest())

    def chain(values):
        h = 42
        for v in values:
            h = xxhash.xxh64((v & (1 << 64) - 1).to_bytes(8, "little"), seed=h & (1 << 64) - 1).intdigest()
        return signed(h)

    h = [one(w) for w in words]
    inner = [chain(h[i : i + 2]) for i in range(len(h) - 1)]
    want = [(i + 1, chain(h[i : i + 5])) for i in range(len(h) - 4) if min(inner[i : i + 4]) in (inner[i], inner[i + 3])]
    df = spark.createDataFrame([(" ".join(words),)], "text string")
    got = df.select(syncmers.anchors(df.text)).first()[0]
    assert [(a.position, a["hash"]) for a in got] == want


def test_words_are_counted_as_the_pattern_says(spark):
    texts = ["", " ", "a", " a  b\x0b\x0cc\x1cd\xa0e ", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(mixing.n_words(df.text)).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_a_task_has_one_python_worker(spark, odd_docs, ranks):
    """Ids are decoded where they were made, with the rows of the two steps."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(bpe.round_trip(odd_docs, ranks, tokenizers.PATTERN)).count("MapInArrow") == 1
    one = bpe.encode_decode(odd_docs, ranks, tokenizers.PATTERN)
    two = bpe.decode(bpe.encode(odd_docs, ranks, tokenizers.PATTERN), ranks)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
