"""Best-fit packing against the rule applied piece by piece, and against the tokenizer itself."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from footfall.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def _one_by_one(lengths, room):
    """How full each sequence is, when pieces are placed one after the other."""
    full = []
    for length in sorted(lengths, reverse=True):
        fits = [(room - f, -i) for i, f in enumerate(full) if room - f >= length]
        if fits:
            full[-min(fits)[1]] += length
        else:
            full.append(length)
    return full


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_is_the_rule(seed):
    rng = random.Random(seed)
    room = rng.choice([1, 7, 50, 100])
    few = [rng.randint(1, room) for _ in range(4)]
    lengths = [rng.choice(few) if rng.random() < 0.6 else rng.randint(1, room) for _ in range(rng.randint(0, 300))]
    filled, places = Counter(), defaultdict(list)
    numbers = defaultdict(list)
    for length, low, n, first, per, at in packing.best_fit(Counter(lengths), room).tolist():
        for j in range(n):
            numbers[length].append(low + j)
            places[first + j // per].append((at + j % per * length, length))
            filled[first + j // per] += length
    assert {k: len(v) for k, v in numbers.items()} == dict(Counter(lengths))
    assert all(sorted(v) == list(range(len(v))) for v in numbers.values())
    for held in places.values():
        end = 0
        for at, length in sorted(held):
            assert at == end
            end += length
        assert end <= room
    assert sorted(filled.values()) == sorted(_one_by_one(lengths, room))


def test_plan_does_not_grow_with_the_pieces():
    rng = np.random.default_rng(0)
    shares = rng.pareto(1.0, 4096)
    small = packing.best_fit({i + 1: int(s * 100) + 1 for i, s in enumerate(shares)})
    large = packing.best_fit({i + 1: (int(s * 100) + 1) * 10**9 for i, s in enumerate(shares)})
    assert len(small) < 100_000 and len(large) < 100_000


def _check(rows, got, tokenizer, room):
    library = Tokenizer.from_str(tokenizer)
    want = Counter()
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), room)):
            part = ids[start : start + room]
            want[(doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        end = 0
        for at, length in sorted(pieces):
            assert at == end
            end += length
        assert end <= room
    lengths = [length for pieces in held.values() for _, length in pieces]
    assert sorted(sum(n for _, n in p) for p in held.values()) == sorted(_one_by_one(lengths, room))


@pytest.mark.parametrize("room", [16, 4096])
def test_pack(spark, odd_docs, tokenizer, room):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    _check(rows, packing.digest(packing.pack(odd_docs, tokenizer, room)).collect(), tokenizer, room)


def test_many_of_one_length(spark, tokenizer):
    """A third of all rows has one length and spreads over many keys of the plan."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'one', repeat('a ', CAST(id % 90 AS INT))) AS text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    _check(rows, packing.digest(packing.pack(docs.repartition(7), tokenizer, 64)).collect(), tokenizer, 64)


def test_sequences_hold_the_ids(spark, odd_docs, tokenizer):
    packed = packing.pack(odd_docs, tokenizer, 64)
    parts = defaultdict(list)
    for r in packed.collect():
        parts[r.sequence_id].append((r.offset, bytes(r.ids), r.doc_id))
    for r in packing.sequences(packed).collect():
        held = sorted(parts.pop(r.sequence_id), key=lambda x: x[0])
        assert bytes(r.ids) == b"".join(x[1] for x in held) and r.doc_ids == [x[2] for x in held]
    assert not parts


def test_nothing_to_pack(no_docs, tokenizer):
    assert packing.pack(no_docs, tokenizer).count() == 0
