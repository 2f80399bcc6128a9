import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfweek.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size bigint, mix string"


def made(n=400, seed=0):
    chance = random.Random(seed)
    sources = ["b", "a", "é", None, "c", "Z", ""]
    rows = []
    for i in range(n):
        source = sources[0] if chance.random() < 0.4 else chance.choice(sources)
        rows.append((i, " ".join(["w"] * chance.choice([0, 1, 5, 30, 100])), source, -1, "m"))
    return rows


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def targets(sizes):
    """Targets by filling up: whoever would pass the cap gets it, the rest share again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 2 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets_are_met(spark, seed):
    rows = made(seed=seed)
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixing.mixture(docs.repartition(5)).collect()
    sizes, taken = Counter(), Counter()
    for _, text, source, *_ in rows:
        sizes[source] += words(text)
    want = targets(sizes)
    assert len(found) == len(rows)
    for r in found:
        assert r["size"] == words(r.doc.text) and r.source_size == sizes[r.doc.source]
        assert r.target == pytest.approx(want[r.doc.source])
        assert r.taken in (0, r["size"], 2 * r["size"]) and len(r.shards_of) <= 2
        assert r.taken == r["size"] * len(r.shards_of)
        taken[r.doc.source] += r.taken
    for source, target in want.items():
        assert 0 <= target - taken[source] < 30 or target - taken[source] <= 0.1 * target
    again = mixing.mixture(docs.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_shards_get_exact_quotas(spark):
    """Halving splits every source's blocks and the total exactly, and at random."""
    quotas = [37, 0, 5, 64, 1]
    nodes = spark.createDataFrame([(0, quotas)], "node bigint, quotas array<bigint>")
    for level in range(4):
        nodes = mixing.split(nodes, level, 3)
    leaves = [r.quotas for r in nodes.orderBy("node").collect()]
    assert len(leaves) == 16 and [sum(c) for c in zip(*leaves)] == quotas
    assert {sum(q) for q in leaves} <= {6, 7}
    assert len({tuple(q) for q in leaves}) > 4


def test_splits_are_hypergeometric(spark):
    """Over many seeds the left half's share has the mean and variance of draws without replacement."""
    frame = spark.range(400).selectExpr("id AS node", "array(12L, 8L) AS quotas")
    halves = mixing.split(frame, 0, 11).where("node % 2 = 0").collect()
    left = [r.quotas[0] for r in halves]
    mean = sum(left) / len(left)
    variance = sum((x - mean) ** 2 for x in left) / len(left)
    assert all(sum(r.quotas) == 10 for r in halves)
    assert abs(mean - 6) < 0.25
    assert abs(variance - 10 * 0.6 * 0.4 * 10 / 19) < 0.35


def test_draw_repeats_rows_and_shuffles_within_shards(spark):
    docs = spark.createDataFrame(made(), SCHEMA)
    want = Counter()
    shards = defaultdict(Counter)
    for r in mixing.mixture(docs, shards=4).collect():
        want[tuple(r.doc)] += len(r.shards_of)
        for s in r.shards_of:
            shards[s][tuple(r.doc)] += 1
    drawn = mixing.draw(docs, shards=4)
    assert drawn.columns == docs.columns
    rows = drawn.withColumn("part", F.spark_partition_id()).collect()
    assert Counter(tuple(r)[:-1] for r in rows) == +want
    parts = defaultdict(list)
    for r in rows:
        parts[r.part].append(r.doc_id)
    assert any(p != sorted(p) for p in parts.values())
    assert set(shards) == {0, 1, 2, 3}
    # A partition is a shard.
    assert {p: Counter(ids) for p, ids in parts.items()} == {
        s: Counter({d: n for d, n in Counter(r[0] for r in own.elements()).items()}) for s, own in shards.items()
    }


def test_taken_words_are_those_that_the_shards_draw(spark):
    """The tree's borders decide the result: the optimizer keeps them, and without them nothing is taken."""
    docs = spark.createDataFrame(made(), SCHEMA)
    mixed = mixing.mixture(docs, shards=8)
    plan = mixed.select("taken")._jdf.queryExecution().optimizedPlan().toString()
    assert "ends" in plan
    drawn, taken = Counter(), Counter()
    for r in mixed.collect():
        taken[r.doc.source] += r.taken
        for _ in r.shards_of:
            drawn[r.doc.source] += r["size"]
    assert drawn == taken


def test_number_of_shards_grows_with_the_words():
    assert mixing.shard_number(0) == mixing.shard_number(10**6) == 64
    assert mixing.shard_number(2 * 10**13) == 65536


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "a", 0, ""), (2, "x y", "a", 0, ""), (2, "x y", "a", 0, ""),
            (3, "w " * 500_000, "b", 0, "")]
    found = mixing.mixture(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["size"] for r in found) == [0, 0, 2, 2, 500_000]
    assert all(0 <= r.taken <= 2 * r["size"] for r in found)
    assert mixing.mixture(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixing.draw(spark.createDataFrame([], SCHEMA)).collect() == []
    empty = mixing.mixture(spark.createDataFrame([(1, "", "a", 0, ""), (2, None, None, 0, "")], SCHEMA))
    assert [(r.taken, r.target) for r in empty.collect()] == [(0, 0.0)] * 2
