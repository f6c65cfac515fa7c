"""Links that no centre of a bucket proposes."""

from footfall.llm import graph


def test_the_last_step_runs_if_the_centres_propose_nothing(spark):
    c, m, k, r = 1, 2, 3, 4
    buckets = [{c, m, k, r}, {k, m}, {k, r}] + [{c, 10 + i} for i in range(4)]
    links = [(c, m), (k, r), (m, r)]
    want = {(i, c) for i in (c, m, k, r)} | {(10 + i, c) for i in range(4)}
    links += [(c, 10 + i) for i in range(4)]
    members = [(n, i) for n, ids in enumerate(buckets) for i in sorted(ids)]
    table = spark.createDataFrame([(min(x), max(x)) for x in links], "a long, b long")
    got = graph.linked(spark.createDataFrame(members, "bucket long, id long"), lambda pairs: pairs.join(table, ["a", "b"]))
    assert {tuple(x) for x in got.collect()} == want
