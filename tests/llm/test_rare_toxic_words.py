"""Toxic words that few rows have, against a local model over all n-grams as they are."""

import random
import zlib

import numpy as np

from footfall.llm import toxicity
from footfall.llm.logistic import Sparse, logistic


def _grams(text):
    text = text.lower()
    return {text[i : i + n] for n in (3, 4, 5, 6) for i in range(len(text) - n + 1)}


def _local(rows):
    """Scores of held-out rows by exact n-grams and plain gradient descent."""
    learn, held = [r for r in rows if not r[3]], [r for r in rows if r[3]]
    names = {}
    for _, text, _, _ in learn:
        for g in _grams(text):
            names.setdefault(g, len(names))
    y = np.array([r[2] for r in learn], float)
    lists = [np.array([names[g] for g in _grams(r[1])]) for r in learn]
    row, at = np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists)
    toxic = np.bincount(at, y[row], len(names))
    across = np.array([" " in g[1:-1] for g in names]).astype(int) << (toxicity.BITS - 1)
    ratio = toxicity.scales(across, toxic, np.bincount(at, minlength=len(names)) - toxic, int(y.sum()), int(len(y) - y.sum()))
    weights, bias = logistic(Sparse(row, at, ratio[at], (len(y), len(names))), y, penalty=toxicity.PENALTY / len(y), steps=200)
    return {i: bias + sum(weights[names[g]] * ratio[names[g]] for g in _grams(text) if g in names) for i, text, _, _ in held}


def test_rare_toxic_words_are_learned(spark):
    rng = random.Random(8)
    plain = ["".join(rng.choice("aeiorstln") for _ in range(rng.randint(2, 8))) for _ in range(2000)]
    bad = ["".join(rng.choice("bcdfghkmpuvwxyz") for _ in range(rng.randint(5, 9))) for _ in range(400)]
    rows = []
    for i in range(4000):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.12)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), toxic, zlib.crc32(str(i).encode()) % 5 == 0))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    want = _local(rows)
    caught = [i for i, _, t, h in rows if h and t]
    clean = [i for i, _, t, h in rows if h and not t]
    local, ours = (np.mean([z > 0 for z in (want[i] for i in caught)]), np.mean([got[i].predicted for i in caught]))
    known = {w for _, text, t, h in rows if t and not h for w in text.split()} & set(bad)
    seen = np.mean([bool(known & set(rows[i][1].split())) for i in caught])
    print(local, ours, seen)
    assert ours >= 0.9 * local and ours >= 0.8 * seen
    assert np.mean([got[i].predicted for i in clean]) < 0.01


def test_features_of_a_long_text_are_those_of_its_parts(monkeypatch):
    import pyarrow as pa

    rng = random.Random(9)
    texts = ["", None, "ab", "abc"] + ["".join(rng.choice("abcdé 文") for _ in range(n)) for n in (5, 90, 500, 3000, 20)]
    whole = [set(x.tolist()) for x in toxicity.features(pa.array(texts))]
    assert [len(x) for x in whole[:4]] == [0, 0, 0, 1]
    assert [len(x) for x in toxicity.features(pa.array(texts))] == [len(x) for x in whole]
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    assert [set(x.tolist()) for x in toxicity.features(pa.array(texts))] == whole
