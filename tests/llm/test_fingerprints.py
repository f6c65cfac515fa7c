"""Fingerprints over all anchors, and passages by position, against brute force."""

import random
import re

import pytest
import xxhash

from footfall.llm import syncmers


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _chain(values):
    h = 42
    for v in values:
        h = xxhash.xxh64((v & (1 << 64) - 1).to_bytes(8, "little"), seed=h & (1 << 64) - 1).intdigest()
    return _signed(h)


def _anchors(text, k=5, s=2):
    h = [_signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if len(h) < k:
        return [(1, _chain(h))] if h else []
    inner = [_chain(h[i : i + s]) for i in range(len(h) - s + 1)]
    last = k - s
    return [(i + 1, _chain(h[i : i + k])) for i in range(len(h) - k + 1) if min(inner[i : i + last + 1]) in (inner[i], inner[i + last])]


def _alike(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def _prose(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def test_likeness_of_all_anchors(spark):
    rng = random.Random(3)
    texts = [" ".join(_prose(rng, rng.choice([0, 1, 4, 5, 30, 400, 6000]))) for _ in range(40)] + [None]
    docs = spark.createDataFrame([(3 * i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in syncmers.edit_trial(docs).collect()}
    for i, text in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(text) // 2
        own, edited = _anchors(text), _anchors(text[: len(text) - half] + after[:half])
        got = rows[3 * i]
        assert got.near_edited == pytest.approx(_alike(own, edited))
        assert got.near_next == pytest.approx(_alike(own, _anchors(after)))
        assert (got.n_anchors, got.n_aligned) == (len(own), len(set(own) & set(edited)))
        assert (got.fingerprint == got.edited_fingerprint) == ([h for _, h in own] == [h for _, h in edited])
    stored = {r.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    assert all(stored[i].fingerprint == r.fingerprint for i, r in rows.items())
    assert [tuple(a) for a in stored[0].anchors] == _anchors(texts[0])


def test_one_changed_word_of_a_long_text_changes_the_fingerprint(spark):
    rng = random.Random(4)
    words = _prose(rng, 20_000)
    rows = [(0, " ".join(words))]
    for i, at in enumerate(rng.sample(range(5, 19_990), 20)):
        rows.append((i + 1, " ".join(words[:at] + ["other"] + words[at + 1 :])))
    got = syncmers.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r.fingerprint for r in got}) == 21


def test_shared_passages_are_found_where_they_stand(spark):
    rng = random.Random(5)
    shared, second = _prose(rng, 40), _prose(rng, 25)
    a = _prose(rng, 700) + shared + _prose(rng, 300) + second
    b = _prose(rng, 90) + second + _prose(rng, 2000) + shared + _prose(rng, 50)
    c = a[:500] + ["inserted", "here"] + a[500:]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (4, "two words"), (5, "two  words\n"), (6, None), (None, " ".join(a))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = [(1, 2), (1, 2), (1, 3), (4, 5), (4, 6), (1, None), (1, 99)]
    got = syncmers.passages(docs, spark.createDataFrame(pairs, "a long, b long")).collect()
    found = {p: sorted((r.start_a, r.start_b, r.n_words) for r in got if (r.a, r.b) == p and r.n_words > 12) for p in pairs[:3]}
    for (start, other, n), (at_a, at_b, size) in zip(found[1, 2], [(701, 2116, 40), (1041, 91, 25)], strict=True):
        assert start - at_a == other - at_b and 0 <= start - at_a <= 2 and size - 4 <= n <= size
    (s1, o1, n1), (s2, o2, n2) = found[1, 3]
    assert s1 == o1 <= 3 and 496 <= s1 + n1 - 1 <= 500 and s2 + 2 == o2 and 501 <= s2 <= 503 and s2 + n2 - 1 >= len(a) - 2
    assert [(r.start_a, r.start_b, r.n_words) for r in got if r.a == 4] == [(1, 1, 2)]
    assert {(r.a, r.b) for r in got} <= {(1, 2), (1, 3), (4, 5)}
    none = syncmers.passages(docs.where("false"), spark.createDataFrame(pairs, "a long, b long"))
    assert none.count() == 0


def test_a_repeated_passage_is_matched_from_both_ends(spark):
    rng = random.Random(6)
    passage = _prose(rng, 30)
    rows = [(1, " ".join(passage + _prose(rng, 100) + passage)), (2, " ".join(_prose(rng, 10) + passage))]
    got = syncmers.passages(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, 2)], "a long, b long"))
    assert sorted(r.start_b - r.start_a for r in got.where("n_words > 20").collect()) == [-120, 10]
