"""Grammars that go on until no pair is frequent, and the ids of words against the library."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from footfall.llm import repair, word_ids


@pytest.mark.parametrize("kinds, n", [(2, 5000), (50, 20000), (3000, 20000), (1, 4000)])
def test_no_frequent_pair_is_left(kinds, n):
    ids = np.random.default_rng(kinds).integers(0, kinds, n)
    rules, lengths, sequence = repair.compress(ids)
    assert (repair.expand(rules, sequence) == ids).all()
    assert max(Counter(zip(sequence.tolist(), sequence[1:].tolist())).values(), default=0) < repair.LEAST
    assert [len(repair.expand(rules, np.array([repair.FIRST_RULE + k]))) for k in range(len(rules))] == lengths.tolist()


def test_a_thousand_copies_cost_little_more_than_one():
    text = np.random.default_rng(0).integers(0, 40000, 1000)
    rules, lengths, sequence = repair.compress(np.tile(text, 1000))
    assert (repair.expand(rules, sequence) == np.tile(text, 1000)).all()
    assert 3 * len(rules) + len(sequence) < 12 * len(text)
    # Random access expands only what it reaches into.
    for start, stop in ((0, 1), (123_456, 123_956), (999_990, 1_000_000)):
        assert (repair.window(rules, lengths, sequence, start, stop) == np.tile(text, 1000)[start:stop]).all()


def test_ids_of_words_are_the_library_s():
    """Odd characters, and a worker that knows some words from earlier slices."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    library, coder, rng = Tokenizer.from_str(tokenizer), word_ids.Encoder(tokenizer), random.Random(1)
    parts = [*"abzAZ09.,;:!?'\"-_ \t\n\r\x0b\x0c éÉßÿÀÞ×÷ªºσΣςİıḰ=<>|ſ漢", "é", "̸", "‍", "<|endoftext|>", "<|", "'s", "'RE", "'ll ", "è."]
    for _ in range(400):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4)] + [None, ""]
        ids, sizes = coder.encode(pa.array(texts))
        want = [x.ids for x in library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want, texts


def test_a_worker_remembers_few_words(monkeypatch):
    monkeypatch.setattr(word_ids, "KNOWN_WORDS", 10)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    library, coder = Tokenizer.from_str(tokenizer), word_ids.Encoder(tokenizer)
    for k in range(4):
        text = " ".join(f"word{i} other{chr(97 + i % 26)}" for i in range(k, 30 + k)) + " " + "x" * 100
        ids, _ = coder.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(coder.known) <= 10


def test_rounds_look_at_pairs_that_may_have_become_frequent(monkeypatch):
    """A tenth of the ids are copies, replaced round by round; the rest is looked at once."""
    looked, short = [], repair._short
    monkeypatch.setattr(repair, "_short", lambda pairs: looked.append(len(pairs)) or short(pairs))
    rng = np.random.default_rng(4)
    ids = np.concatenate([rng.permutation(30_000), np.tile(30_000 + np.arange(64), 50)])
    rules, _, sequence = repair.compress(ids)
    assert len(rules) > 32 and (repair.expand(rules, sequence) == ids).all()
    assert sum(looked) < 2 * len(ids)
