"""Classifiers by held-out accuracy, vectors against brute force, the pipeline end to end."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from footfall.llm import hnsw, queries, quality, toxicity

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def marked(spark):
    rng = random.Random(2)
    plain = ["".join(rng.choice("aeiorstln") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    docs, labels = [], []
    for i in range(1500):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 120))]
        toxic, good = rng.random() < 0.2, rng.random() < 0.8
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["gromblax", "vuxdreck", "hizzpok"])
        text = " ".join(words)
        docs.append((i, text if good else text.upper() + "!!!", "en", f"s{i % 4}", len(text)))
        labels.append((i, int(good), int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {i: (q, t) for i, q, t in labels},
    )


def test_toxicity(marked):
    docs, labels, truth = marked
    got = toxicity.toxicity(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == truth[r.doc_id][1] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    # Labels of held-out rows play no part.
    other = labels.where(~toxicity.held_out(labels.doc_id))
    assert {r.doc_id: r.score for r in toxicity.toxicity(docs, other).collect()} == {r.doc_id: r.score for r in got}


def test_toxicity_of_odd_documents(odd_docs, odd_labels, no_docs):
    got = toxicity.toxicity(odd_docs, odd_labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert [r for r in got if r.doc_id == 120] and len({r.score for r in got if r.doc_id in (120, 121)}) == 1
    assert toxicity.toxicity(no_docs, odd_labels).count() == 0
    none = toxicity.toxicity(odd_docs, odd_labels.where("false")).collect()
    assert len({r.score for r in none}) == 1 and not any(r.predicted for r in none)


def test_quality(marked):
    docs, labels, truth = marked
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    good = [i for i in truth if truth[i][0]]
    assert np.mean([got[i].kept for i in good]) > 0.98
    assert np.mean([not got[i].kept for i in truth if not truth[i][0]]) > 0.95
    assert quality.drop_rejected(docs, labels).columns == docs.columns


def test_quality_of_odd_documents(odd_docs, odd_labels, no_docs):
    out = quality.classify(odd_docs, odd_labels)
    assert out.count() == odd_docs.count()
    twice = [sorted(map(str, quality.classify(x, odd_labels).collect())) for x in (odd_docs, odd_docs.repartition(3))]
    assert twice[0] == twice[1]
    assert quality.drop_rejected(odd_docs, odd_labels.where("false")).count() == odd_docs.count()
    assert quality.classify(no_docs, odd_labels).count() == 0


def test_co_training_is_that_of_one_machine(spark, marked):
    """All rows without a label are in the pool: the same views as with the pool in memory."""
    docs, labels, _ = marked
    rows = quality.featured(docs)
    model = quality.train(rows, labels, most=150)
    ids = sorted(r.doc_id for r in labels.where("quality IS NOT NULL").select("doc_id").distinct().collect())
    table = {r.doc_id: (r.x, r.names) for r in rows.collect()}
    drawn = [r.doc_id for r in labels.select("doc_id", F.xxhash64("doc_id").alias("h")).distinct().orderBy("h", "doc_id").limit(150).collect()]
    assert set(drawn) <= set(ids)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    drawn = sorted(drawn)
    pick = lambda some: (np.array([table[i][0] for i in some]), np.array([table[i][1] for i in some]))
    x, names = pick(drawn)
    px, pn = pick([i for i in table if i not in set(drawn)])
    y = np.array([truth[i] for i in drawn], float)
    apart = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in drawn])

    def pool(views, teachers):
        for view, teacher in zip(views, teachers):
            at, label = quality.sure(teacher, px, pn)
            yield view.sums(px[at], pn[at], label)

    for got, want in zip((model.text, model.meta), quality.co_train(x, names, y, apart, pool)):
        assert np.allclose(got.weights, want.weights, atol=1e-9)
    assert sum(len(quality.sure(v, px, pn)[0]) for v in (model.text, model.meta)) > 100


@pytest.mark.parametrize("shard_rows", [10_000, 200])
def test_near_vectors(spark, shard_rows):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((400, 16))
    near = base[:60].repeat(5, axis=0) + 0.12 * rng.standard_normal((300, 16))
    rows = [(i, x.tolist()) for i, x in enumerate(np.concatenate([base, near, np.repeat(base[:1], 30, axis=0)]))]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, [1.0] + [None] * 15, [1.0, 2.0], [2.0, 4.0], [1e-200] * 16, [1e200] * 16]
    rows += [(10_000 + i, x) for i, x in enumerate(odd)] + [(None, rows[0][1])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n_links int")
    got = {r.vec_id: r for r in hnsw.near_vectors(table, shard_rows).collect()}
    assert len(got) == len(rows)
    links, up = defaultdict(int), {}

    def find(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    sound = [(i, np.array(x)) for i, x in rows if i is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    for size in (2, 16):
        ids = [i for i, x in sound if len(x) == size]
        x = np.array([x / np.abs(x).max() for _, x in sound if len(x) == size])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= 0.9)):
            if a != b:
                links[ids[a]] += 1
                p, q = find(ids[a]), find(ids[b])
                up[max(p, q)] = min(p, q)
    assert all(got[i].n_links <= links[i] for i, _ in rows if i is not None)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(links.values())
    wrong = [i for i, _ in rows if i is not None and got[i].component_id != find(i)]
    assert len(wrong) <= 0.01 * len(rows)
    assert got[10_006].n_links == got[10_007].n_links == got[10_008].n_links == 1
    assert hnsw.near_vectors(table.where("false")).count() == 0


@pytest.mark.parametrize("name", ["op9_hnsw"])
def test_recall_on_the_table(spark, name):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    x = np.array([v.embedding for v in vectors], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = int((x @ x.T >= 0.9).sum()) - len(x)
    assert sum(r.n_links for r in queries.QUERIES[name](spark, SF_DIR).collect()) >= 0.9 * want


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns or name == "byte_bpe"
    assert docs.count() == corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_pipeline_of_odd_documents(spark, odd_docs, tmp_path):
    import corpus_pipeline

    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0
