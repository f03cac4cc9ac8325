"""The operators for problems 1, 4 and 5 against brute force and on awkward input."""

import json
import random
from collections import Counter
from itertools import product

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandloom.operators import eager, periods, shred


# -- eager aggregation ---------------------------------------------------------------------------------------------------
def test_join_states_equal_the_joined_rows(spark):
    rng = random.Random(1)
    left = [(rng.choice(["a", "a", "a", "b", "c", None, "."]), rng.choice([1, 2, None])) for _ in range(300)]
    right = [(rng.choice(["a", "a", "b", "d", None, "."]), rng.choice([5, 7, None])) for _ in range(200)]
    a = spark.createDataFrame(left, "k string, x bigint")
    b = spark.createDataFrame(right, "k string, y bigint")
    states = eager.join_states(eager.compact(a.filter(eager.present("k")), ["k"], sums={"sx": "x"}, mins={"mx": "x"}), eager.compact(b.filter(eager.present("k")), ["k"], sums={"sy": "y"}), ["k"], left_sums=["sx"], right_sums=["sy"], products={"sxy": ("sx", "sy")})
    got = {r.k: (int(r.n_pairs), int(r.sx), int(r.sy), int(r.sxy), r.mx) for r in states.collect()}
    want = {}
    for k in ("a", "b"):
        pairs = [(x, y) for (p, x), (q, y) in product(left, right) if p == q == k]
        want[k] = (len(pairs), sum(x or 0 for x, _ in pairs), sum(y or 0 for _, y in pairs), sum((x or 0) * (y or 0) for x, y in pairs), 1)
    assert got == want


def test_counts_beyond_64_bits(spark):
    a = spark.createDataFrame([("k", 6_000_000_000)], "k string, n_rows bigint")
    one = eager.join_states(a, a, ["k"]).collect()[0]
    assert int(one.n_pairs) == 36 * 10**18


def test_heavy_keys_with_missing_copies_and_clashing_names(spark):
    data = [("t", "A")] * 95 + [("t", "B")] * 5 + [("t", None)] * 50 + [("t", ".")] * 40 + [("t", "NONE")] * 3 + [("u", "C")]
    df = spark.createDataFrame([(t, k, 1) for t, k in data], "t string, key string, n_rows int")
    assert rows(eager.heavy_keys(df, ["t"], "key", 5)) == [("t", "A", 95), ("t", "B", 5), ("u", "C", 1)]
    assert rows(eager.heavy_keys(df, ["t"], "key", 6)) == [("t", "A", 95), ("u", "C", 1)]
    assert rows(eager.heavy_keys(df.limit(0), ["t"], "key", 5)) == []


# -- ranks and periods ---------------------------------------------------------------------------------------------------
def brute_periods(intervals):
    out = []
    by = {}
    for k, lo, hi in intervals:
        if k is not None and lo is not None and hi is not None and lo < hi:
            by.setdefault(k, []).append((lo, hi))
    for k, spans in by.items():
        spans.sort()
        merged = [list(spans[0])]
        for lo, hi in spans[1:]:
            if lo <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        out += [(k, "period", *m) for m in merged] + [(k, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:], strict=False)]
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [1, 7, 1 << 18])
def test_periods_and_gaps(spark, width):
    rng = random.Random(width)
    data = [(rng.choice(["hot", "hot", "hot", "x", "y", None]), rng.choice([None, *range(-50, 300)]), rng.choice([None, *range(-50, 300)])) for _ in range(150)]
    data = [(k, lo, hi if rng.random() < 0.5 or lo is None else lo + rng.randrange(0, 12)) for k, lo, hi in data] * 2
    df = spark.createDataFrame([(*r, "q", 3) for r in data], "k string, lo bigint, hi bigint, kind string, at int")
    assert rows(periods.periods_and_gaps(df, ["k"], width=width)) == brute_periods(data)


def test_periods_touch_and_nothing(spark):
    df = spark.createDataFrame([("k", 0, 5), ("k", 5, 9), ("k", 10, 12)], "k string, lo bigint, hi bigint")
    assert rows(periods.periods_and_gaps(df, ["k"])) == [("k", "gap", 9, 10), ("k", "period", 0, 9), ("k", "period", 10, 12)]
    assert rows(periods.periods_and_gaps(df.limit(0), ["k"])) == []


def test_axis_intervals_leave_out_what_has_no_extent(spark):
    df = spark.createDataFrame([("r", "q", 9, 3, 1, 1), ("r", "q", None, 3, 5, 2), ("r", None, 1, 3, 5, 2)], "rid string, qid string, rs bigint, re bigint, qs bigint, qe bigint")
    assert rows(periods.axis_intervals(df, ["rid", "qid"], {"r": ("rs", "re"), "q": ("qs", "qe")})) == [("r", "q", "q", 2, 5), ("r", "q", "r", 3, 9)]


# -- shredding -----------------------------------------------------------------------------------------------------------
H = {"sstart": 1, "posq": [3, None, 4]}
BODIES = [
    ({"data": [{"qseqid": "a", "positions": [H, None, {"sstart": "2"}]}, None, {"qseqid": "b"}, {"positions": None}, {"positions": []}]}, [(0, 0), (0, 2)]),
    ({"data": {"positions": H}}, [(0, 0)]),
    ({"v": 2, "result": {"data": [{"positions": {"0": H, "2": {}, "1": None}}]}}, [(0, 0), (0, 2)]),
    ({"data": [{"positions": json.dumps([H, H])}]}, [(0, 0), (0, 1)]),
    (json.dumps({"data": [{"positions": [H]}]}), [(0, 0)]),
    ({"data": [[1], 5, "x", {"positions": [5, "y", [H], {}]}]}, [(3, 3)]),
    ({"data": [{"positions": {"1": {"a": 1}, "01": {}, "0": [1]}}]}, [(0, 1)]),
    ({"data": [{"positions": {"9" * 30: {}}}]}, [(0, 0)]),
    ({"data": []}, []), ({}, []), ([1], []), (5, []),
]
RAW = [None, "", "  ", '{"data": [{"positions": [{"a": 1}', "[" * 100_000, "7" * 5000, '{"data": [{"positions": [{"a": NaN}]}]}', "nonsense"]


def test_every_shape(spark):
    texts = [json.dumps(b) for b, _ in BODIES] + RAW
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "rec bigint, body string, data_ix string")
    chunks = shred.shred(df, "rec", "body", ("data", "data.positions"), ("result",), chunk=3)
    want = sorted(((i, a, b) for i, (_, found) in enumerate(BODIES) for a, b in found), key=str)
    assert rows(shred.assemble(chunks, "rec", "data[].positions[]", places=["d", "p"])) == want
    pruned = shred.shred(df, "rec", "body", ("data", "data.positions"), ("result",), ["data[].#", "data[].positions[].#"])
    assert rows(shred.assemble(pruned, "rec", "data[].positions[]", places=["d", "p"])) == want


def test_fields_and_values_keep_their_parents(spark):
    df = spark.createDataFrame([(7, json.dumps(BODIES[0][0])), (8, json.dumps(BODIES[2][0]))], "rec bigint, body string")
    chunks = shred.shred(df, "rec", "body", ("data", "data.positions"), ("result",))
    got = shred.assemble(chunks, "rec", "data[].positions[]", {"sstart": "bigint", "none": "string"}, ["d", "p"])
    assert rows(got) == [(7, 0, 0, 1, None), (7, 0, 2, 2, None), (8, 0, 0, 1, None), (8, 0, 2, None, None)]
    assert rows(shred.assemble(chunks, "rec", "data[]", {"qseqid": "string"}, ["d"])) == [(7, 0, "a"), (7, 2, "b"), (7, 3, None), (7, 4, None), (8, 0, None)]
    assert rows(shred.assemble_values(chunks, "rec", "data[].positions[]", ["posq"], ["d", "p"])) == [(7, 0, 0, "posq", 0, "3"), (7, 0, 0, "posq", 2, "4"), (8, 0, 0, "posq", 0, "3"), (8, 0, 0, "posq", 2, "4")]


def test_levels_of_a_known_record():
    found = shred.stripe([{"a": [{"b": [1, 2]}, {"b": [3]}, {}]}, {"a": []}, None])
    assert found["a[].b[]"] == ([0, 2, 1, 1, 0, 0], [4, 4, 4, 2, 0, 0], ["1", "2", "3", None, None, None])
    assert found["a[].#"][0] == [0, 1, 1, 0, 0]


def test_latest(spark):
    data = [(1, 5, "old"), (1, 9, "new"), (1, 9, "new"), (2, None, "x"), (2, 1, None), (3, 4, "a"), (3, 4, "b"), (None, 9, "z")]
    df = spark.createDataFrame(data, "k bigint, t bigint, body string")
    assert rows(shred.latest(df, "k", "t", "body")) == [(1, "new"), (2, None), (3, "b")]
    assert rows(shred.latest(df, "k", "t", "body", ["t"])) == [(1, "new", 9), (2, None, 1), (3, "b", 4)]
    assert rows(shred.latest(df.limit(0), "k", "t", "body")) == []


def test_wide_numbers_and_odd_strings(spark):
    body = '{"data": [{"x": 123456789012345678901234567890, "y": "\\ud800", "z": true}]}'
    chunks = shred.shred(spark.createDataFrame([(1, body)], "k bigint, b string"), "k", "b", ("data",))
    got = shred.assemble(chunks, "k", "data[]", {"x": "string", "y": "string", "z": "boolean"}).collect()[0]
    assert got.x == "123456789012345678901234567890" and got.y == "?" and got.z is True


def test_integers_of_any_length(spark):
    long = "7" * 5000
    chunks = shred.shred(spark.createDataFrame([(1, '{"data": [{"x": %s}]}' % long)], "k bigint, b string"), "k", "b", ("data",))
    assert shred.assemble(chunks, "k", "data[]", {"x": "string"}).collect()[0].x == long


def test_one_group_of_many(spark):
    """A record with thousands of elements keeps every place."""
    body = json.dumps({"data": [{"positions": [{"s": i} for i in range(5000)]}]})
    chunks = shred.shred(spark.createDataFrame([(1, body)], "k bigint, b string"), "k", "b", ("data", "data.positions"))
    got = shred.assemble(chunks, "k", "data[].positions[]", {"s": "bigint"}, ["d", "p"])
    assert got.filter("s <> p").count() == 0 and got.count() == 5000
    assert Counter(r.d for r in got.select("d").collect()) == {0: 5000}
    assert got.agg(F.max("p")).collect()[0][0] == 4999
