"""Collapsing runs and top-N against brute force."""

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandloom.llm.runs import runs, segment
from strandloom.llm.topn import best_of_subgroups, top_n


def within(v, cost):
    if cost == "steps":
        return sum(max(abs(x - y) for x, y in zip(a, b, strict=True)) for a, b in zip(v, v[1:], strict=False))
    return sum(sum((x - sum(c) / len(c)) ** 2 for x in c) for c in zip(*v, strict=True))


def by_search(v, penalty, cost):
    """Optimal cost over all segmentations, by unpruned dynamic programming over every last boundary."""
    best = [0.0] * (len(v) + 1)
    for t in range(1, len(v) + 1):
        best[t] = min(best[s] + within(v[s:t], cost) + (penalty if s else 0) for s in range(t))
    return best[-1]


@pytest.mark.parametrize("cost", ["steps", "spread"])
def test_segmentation_is_optimal(cost):
    """Against the unpruned recursion; many stretches at a time and one at a time give the same."""
    rng = random.Random(2)
    stretches = []
    for _ in range(400):
        v = [(0, 0)]
        while rng.random() < 0.9:
            v.append(tuple(x + rng.choice([0, 0, 3, -4, 10, 11, 40]) for x in v[-1]))
        stretches.append(v)
    begins = np.cumsum([0] + [len(v) for v in stretches[:-1]])
    together = segment(np.array(sum(stretches, [])), begins, 10 if cost == "steps" else 60, cost)
    for v, b in zip(stretches, begins, strict=True):
        penalty = 10 if cost == "steps" else 60
        starts = segment(np.array(v), np.zeros(1, np.int64), penalty, cost)
        assert starts.tolist() == together[b : b + len(v)].tolist()
        cut = [*np.flatnonzero(starts), len(v)]
        got = sum(within(v[a:z], cost) for a, z in zip(cut, cut[1:], strict=False)) + penalty * (len(cut) - 2)
        assert got == pytest.approx(by_search(v, penalty, cost))


def test_long_stretches_of_copies_are_one_event():
    v = np.repeat(np.array([[0], [3], [50]]), [400_000, 100_000, 300_000], axis=0)
    assert np.flatnonzero(segment(v, np.zeros(1, np.int64), 10)).tolist() == [0, 500_000]
    assert np.flatnonzero(segment(v, np.zeros(1, np.int64), 1_000_000, "spread")).tolist() == [0, 500_000]
    assert np.flatnonzero(segment(v, np.zeros(1, np.int64), 100_000, "spread")).tolist() == [0, 400_000, 500_000]
    assert segment(v[:0], np.zeros(0, np.int64), 10).tolist() == []


def test_costs_are_no_threshold():
    """A drift of small steps stays together with one cost and is cut with the other; one outlier is worth no boundary."""
    drift = np.array([[8 * i] for i in range(20)])
    assert segment(drift, np.zeros(1, np.int64), 10).sum() == 1
    assert segment(drift, np.zeros(1, np.int64), 400, "spread").sum() > 1
    outlier = np.array([[0], [0], [25], [0], [0], [0]])
    assert segment(outlier, np.zeros(1, np.int64), 10).sum() == 3
    assert segment(outlier, np.zeros(1, np.int64), 600, "spread").sum() == 1


def brute_runs(data):
    seen, out = {}, []
    for q, n, s, a, b in data:
        if None not in (q, n, s, a, b):
            seen.setdefault((q, n), (s, a, b))
    last = None
    for (q, n), (s, a, b) in sorted(seen.items()):
        if last and last[0] == q and last[1] == s and (last[2] <= last[3]) == (a <= b) and abs(last[2] - a) <= 10 and abs(last[3] - b) <= 10:
            out[-1][2], out[-1][3] = n, out[-1][3] + 1
        else:
            out.append([q, n, n, 1])
        last = (q, s, a, b)
    return sorted((tuple(x) for x in out), key=str)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_runs_however_they_are_cut(spark, partitions):
    rng = random.Random(partitions)
    data = []
    for n in range(600):
        q = rng.choice(["hot"] * 6 + ["b", "c", None])
        s = rng.choice(["F", "F", "F", "G", None])
        a = rng.choice([100, 105, 111, 130, None])
        b = rng.choice([200, 206, 90, None]) if rng.random() < 0.2 else 200
        data += [(q, n, s, a, b)] * rng.choice([1, 1, 1, 2])
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "q string, n bigint, s string, a bigint, b bigint, entity string, first int")
    got = runs(df, "q", "n", ["s", F.col("a") <= F.col("b")], ["a", "b"], partitions=partitions)
    assert rows(got.select("entity", "first", "last", "n_events")) == brute_runs(data)
    long = runs(df, "q", "n", ["s", F.col("a") <= F.col("b")], ["a", "b"], partitions=partitions, least=3)
    assert rows(long.select("entity", "first", "last", "n_events")) == [r for r in brute_runs(data) if r[3] >= 3]
    assert rows(runs(df.limit(0), "q", "n", ["s"], ["a"])) == []


def test_one_run_over_many_batches_and_partitions(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(1000).select(F.lit("q").alias("q"), F.col("id").alias("n"), F.lit("f").alias("s"), (F.col("id") * 5).alias("a"))
        one = runs(df, "q", "n", ["s"], ["a"], partitions=9).collect()
        assert [(r["first"], r["last"], r.n_events, r.lo_a, r.hi_a) for r in one] == [(0, 999, 1000, 0, 4995)]
        far = df.withColumn("a", F.col("a") + F.when(F.col("n") >= 500, 100).otherwise(0))
        assert rows(runs(far, "q", "n", ["s"], ["a"], partitions=9).select("first", "last")) == [(0, 499), (500, 999)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_spread_however_it_is_cut(spark, partitions):
    rng = random.Random(partitions)
    data = [(rng.choice(["hot"] * 8 + ["b"]), n, rng.choice("FFFFFFG"), rng.choice([0, 5, 20, 60])) for n in range(500)]
    data += [("long", 1000 + n, "F", rng.choice([0, 40])) for n in range(200)]
    df = spark.createDataFrame(data + data[::4], "q string, n bigint, s string, a bigint")
    want, stretch = [], []
    for r in [*sorted(data), (None, 0, None, 0)]:
        if stretch and (r[0], r[2]) != (stretch[-1][0], stretch[-1][2]):
            cut = [*np.flatnonzero(segment(np.array([[x[3]] for x in stretch]), np.zeros(1, np.int64), 500, "spread")), len(stretch)]
            want += [(stretch[0][0], stretch[a][1], stretch[z - 1][1], int(z - a)) for a, z in zip(cut, cut[1:], strict=False)]
            stretch = []
        stretch.append(r)
    got = runs(df, "q", "n", ["s"], ["a"], penalty=500, partitions=partitions, cost="spread")
    assert rows(got.select("entity", "first", "last", "n_events")) == sorted(want, key=str)
    some = runs(df, "q", "n", ["s"], ["a"], penalty=500, partitions=partitions, cost="spread", least=2)
    assert rows(some.select("entity", "first")) == sorted([(r[0], r[1]) for r in want if r[3] > 1], key=str)


def test_copies_of_an_item_go_on_once(spark):
    """Of 100,000 copies of the best item one survives the first stage."""
    df = spark.range(100_000).select(F.lit("g").alias("g"), F.lit(9.0).alias("v"), F.lit(1).cast("bigint").alias("n"))
    df = df.unionByName(spark.createDataFrame([("g", 1.0, 2), ("g", 1.0, 3), ("g", 0.5, 4)], "g string, v double, n bigint"))
    first = best_of_subgroups(df.withColumn("__salt", F.lit(0)), ["g"], [F.col("v").desc(), F.col("n").asc()], ["g", "v", "n"], 3)
    assert rows(first.select("n")) == [(1,), (2,), (3,)]
    assert rows(top_n(df, ["g"], [("v", True), ("n", False)], 3, F.col("n")).select("n", "place")) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("salts", [1, 5])
def test_top_n(spark, salts):
    rng = random.Random(salts)
    data = [(rng.choice(["hot"] * 8 + ["b", None]), rng.choice([1.0, 2.0, 2.0, 9.5, None, float("nan")]), rng.choice(["x", "y", "Z", None]), n) for n in range(400)]
    data += data[::3]
    df = spark.createDataFrame([(*r, 1, 2) for r in data], "g string, score double, s string, n bigint, place int, __salt int")
    got = top_n(df.drop("place", "__salt"), ["g"], [("score", True), ("s", False), ("n", False)], 3, F.col("n"), salts)
    want = []
    for g in {r[0] for r in data} - {None}:
        some = sorted({(-v, s, n) for k, v, s, n in data if k == g and v is not None and v == v and s is not None})
        want += [(g, -v, s, n, i) for i, (v, s, n) in enumerate(some[:3], 1)]
    assert rows(got) == sorted(want, key=str)
    assert rows(top_n(df.limit(0), ["g"], [("score", True), ("n", False)], 3, F.col("n"))) == []


def test_top_n_of_few(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 2), ("b", 5.0, 3)], "g string, v double, n bigint")
    assert rows(top_n(df, ["g"], [("v", True), ("n", False)], 3, F.col("n")).select("g", "n", "place")) == [("a", 1, 1), ("a", 2, 2), ("b", 3, 1)]
