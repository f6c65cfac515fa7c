"""Near duplicates, repeated lines and passages against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from footfall.llm import graph, lines, minhash, suffixes


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, a):
        while self.up.setdefault(a, a) != a:
            a = self.up[a]
        return a

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, None)]
    want = Sets()
    for a, b in edges:
        if b is not None and a != b:
            want.link(a, b)
    got = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(a, want.find(a)) for a in want.up}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("size", [40, 7])
def test_linked_loses_no_link(spark, size):
    """Buckets whose members are only partly linked, a chain among them."""
    members = [(b, i) for b in range(3) for i in range(b * 10, b * 10 + size)]
    links = {(i, i + 3) for i in range(60)} | {(i, i + 7) for i in range(0, 60, 2)}
    table = spark.createDataFrame(sorted(links), "a long, b long")
    got = graph.linked(spark.createDataFrame(members, "bucket long, id long"), lambda pairs: pairs.join(table, ["a", "b"]))
    want, by = Sets(), defaultdict(set)
    for b, i in members:
        by[b].add(i)
    for a, b in links:
        if any({a, b} <= ids for ids in by.values()):
            want.link(a, b)
    assert {tuple(r) for r in got.collect()} == {(a, want.find(a)) for a in want.up}


def _shingles(text, words_of):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words_of(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_near_duplicates(spark, odd_docs, words_of):
    rows = odd_docs.collect()
    want, sets = Sets(), [(r.doc_id, _shingles(r.text, words_of)) for r in rows]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 85 * len(x | y):
                want.link(a, b)
    got = minhash.near_duplicates(odd_docs).collect()
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(s)) for i, s in sets)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want.find(r.doc_id))
        assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    kept = minhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r.kept for r in got)


def test_near_copies_of_a_large_group(spark, words_of):
    """Copies with edits: some near the base, some near each other only, many near none."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(160):
        w = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 9)):
            w[at] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [_shingles(t, words_of) for t in texts]
    want = Sets()
    for a, x in enumerate(sets):
        want.find(a)
        for b in range(a):
            if 100 * len(x & sets[b]) >= 85 * len(x | sets[b]):
                want.link(a, b)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == {a: want.find(a) for a in want.up}


def test_pairs_grow_with_a_group_of_near_copies(spark, monkeypatch):
    """1,600 copies with edits, most of them too many: not every two of them are compared, and
    components are those of brute force."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(1600):
        w = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 12)):
            w[at] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(w))
    names, sets = {}, []
    for t in texts:
        w = t.split()
        sets.append({names.setdefault(tuple(w[i : i + 5]), len(names)) for i in range(len(w) - 4)})
    has = np.zeros((len(texts), len(names)), np.float32)
    for i, s in enumerate(sets):
        has[i, list(s)] = 1
    size = has.sum(axis=1)
    shared = has @ has.T
    want = Sets()
    for a, b in zip(*np.nonzero(100 * shared >= 85 * (size[:, None] + size[None, :] - shared))):
        want.link(int(a), int(b))
    seen, real = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df, label: (seen.append((label, real(df, label))), seen[-1][1])[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {a: want.find(a) for a in range(len(texts))}
    assert sum(df.count() for label, df in seen if label == "pairs") < 30 * len(texts)


def _norm(line):
    for c in "\t\r\x0b\x0c":
        line = line.replace(c, " ")
    return " ".join(x for x in line.lower().split(" ") if x)


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (c != d)))
        row = new
    return row[-1]


def test_lines(spark):
    base = " ".join(f"word{i * i % 211}" for i in range(130))
    rows = [(i, f"line {i} alone here\n{base}\n\nshort") for i in range(5)]
    rows += [(10 + i, base.replace(f"word{i * i} ", f"Word{i * i}s  ").upper() + f"\r\nown words {i} {i * i}") for i in range(2, 9)]
    rows += [(20 + i, " ".join(base.split()[: -1 - i])) for i in range(4)]
    rows += [(30, None), (31, ""), (32, "  \n \n"), (33, "once\nonce\nOnce "), (34, "b " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = defaultdict(list)
    for i, text in rows:
        for p, line in enumerate((text or "").split("\n")):
            if _norm(line):
                nodes[_norm(line)].append((i, p))
    keys = list(nodes)
    want = Sets()
    for i, a in enumerate(keys):
        want.find(i)
        for j in range(i):
            longer = max(len(a), len(keys[j]))
            if abs(len(a) - len(keys[j])) <= longer // 10:
                if _distance(a, keys[j]) <= longer * 10 // 100:
                    want.link(i, j)
    groups = defaultdict(list)
    for i, k in enumerate(keys):
        groups[want.find(i)] += nodes[k]
    gone = {o for g in groups.values() for o in g} - {min(g) for g in groups.values()}
    assert len(groups) < len(keys)
    got = {r.doc_id: r for r in lines.line_dedup(docs).collect()}
    for i, text in rows:
        kept = "\n".join(line for p, line in enumerate((text or "").split("\n")) if (i, p) not in gone)
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest(), i
        assert got[i].n_removed == sum(o[0] == i for o in gone)


def test_lines_of_odd_documents(odd_docs, no_docs):
    out = lines.drop_repeated_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert lines.drop_repeated_lines(no_docs).count() == 0


def test_suffix_array_and_repeats():
    rng = np.random.default_rng(1)
    for trial in range(80):
        kinds, n = int(rng.choice([1, 2, 3, 26])), int(rng.integers(1, 300))
        text = bytes(rng.integers(97, 97 + kinds, n).astype(np.uint8)) + b"\0"
        order = suffixes.suffix_array(np.frombuffer(text, np.uint8))
        assert order.tolist() == sorted(range(n + 1), key=lambda i: text[i:])
        pieces = [bytes(rng.integers(97, 97 + kinds, int(rng.integers(0, 60))).astype(np.uint8)) for _ in range(8)]
        pieces += [pieces[0], pieces[1][2:]]
        length = int(rng.integers(2, 12))
        uses = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        for p, places in zip(pieces, suffixes.repeated(pieces, length)):
            assert places.tolist() == [i for i in range(len(p) - length + 1) if uses[p[i : i + length]] > 1]


def test_repeated_passages(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    texts = [(r.text or "").encode() for r in rows]
    uses = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    want = Counter()
    for r, t in zip(rows, texts):
        covered = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 199):
            if uses[t[i : i + 200]] > 1:
                covered[i : i + 200] = True
        kept = bytes(b for b, c in zip(t, covered) if not c)
        spans = int((covered[:-1] & ~covered[1:]).sum())
        want[(r.doc_id, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest())] += 1
    got = suffixes.digest(suffixes.remove_repeats(odd_docs)).collect()
    assert Counter(tuple(r) for r in got) == want
    assert suffixes.remove_repeats(no_docs).count() == 0


def test_near_duplicates_of_nothing(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
