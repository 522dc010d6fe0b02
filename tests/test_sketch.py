"""Stream statistics against plain-Python loops over the same items."""

import random
import statistics
from collections import Counter

import pytest

from tallyspark.operators import sketch as S

P = 8191
ROWS = [(17, 23, 101, 7), (4001, 77, 3333, 1000), (8190, 0, 5, 8000)]
W = 16


def h(x, a, b, w):
    return ((a * x + b) % P) % w


def g(x, a, b):
    r = (a * x + b) % P
    return 1 if 2.0 * r / (P - 1) - 1.0 >= 0 else -1


def python_sketch(values):
    m = {}
    for x in values:
        for j, (a, b, ga, gb) in enumerate(ROWS):
            key = (j, h(x, a, b, W))
            m[key] = m.get(key, 0) + g(x, ga, gb)
    return m


@pytest.fixture
def values():
    rnd = random.Random(3)
    vals = [rnd.choice(range(-5, 60)) for _ in range(700)] + [10, 40, 40, 3_000_000_000]
    return vals


def test_histogram_open_interval(items_df, values):
    hist = S.interval_histogram(items_df(values), 10, 40)
    got = {r.item: r.n for r in hist.collect()}
    want = Counter(x for x in values if 10 < x < 40)
    assert got == dict(want)
    assert 10 not in got and 40 not in got


def test_count_sketch_matches_loops(items_df, values):
    got = {(r.row_idx, r.col_idx): r.value
           for r in S.count_sketch(items_df(values), ROWS, W).collect()}
    assert got == python_sketch(values)


def test_sign_hash_boundary(spark):
    # r = 4095 -> +1, r = 4094 -> -1 (x chosen with a=1, b=0)
    df = spark.createDataFrame([(4095,), (4094,)], "item bigint")
    got = {r.item: r.sign for r in
           S.sketch_hashes(df, [(1, 0, 1, 0)], 8).collect()}
    assert got == {4095: 1, 4094: -1}


def test_moments(items_df, values):
    items = items_df(values)
    hist = S.interval_histogram(items, 0, 50)
    freq = Counter(x for x in values if 0 < x < 50)
    f2 = sum(n * n for n in freq.values())
    r = S.second_moment_true(hist).collect()[0]
    assert (r.f2, r.n_distinct) == (f2, len(freq))
    assert r.f2_normalized == f2 / len(freq) ** 2
    sk = S.count_sketch(S.in_interval(items, 0, 50), ROWS, W)
    m = python_sketch([x for x in values if 0 < x < 50])
    rows = {r.row_idx: r.f2 for r in S.second_moment_rows(sk).collect()}
    want_rows = {j: sum(v * v for (jj, _), v in m.items() if jj == j) for j in range(3)}
    assert rows == want_rows
    a = S.second_moment_approx(sk, hist).collect()[0]
    med = statistics.median(want_rows.values())
    assert a.f2_median == med
    assert a.f2_normalized == med / len(freq) ** 2


def test_empty_interval_gives_null(items_df, values):
    hist = S.interval_histogram(items_df(values), 1000, 1001)
    r = S.second_moment_true(hist).collect()[0]
    assert (r.f2, r.n_distinct, r.f2_normalized) == (0.0, 0, None)
    assert S.largest_item(hist).collect()[0].largest_item == 0


def test_largest_item_floor_zero(items_df):
    hist = S.interval_histogram(items_df([-9, -3, -3]), -10, 0)
    assert S.largest_item(hist).collect()[0].largest_item == 0
    hist = S.interval_histogram(items_df([5, 99, 7]), 0, 100)
    assert S.largest_item(hist).collect()[0].largest_item == 99


def test_point_estimates(items_df, values):
    items = items_df(values)
    hist = S.interval_histogram(items, 0, 50)
    sk = S.count_sketch(S.in_interval(items, 0, 50), ROWS, W)
    m = python_sketch([x for x in values if 0 < x < 50])
    got = {r.item: r.estimate for r in S.sketch_point_estimates(hist, sk, ROWS, W).collect()}
    for x, est in got.items():
        per_row = [g(x, ga, gb) * m.get((j, h(x, a, b, W)), 0)
                   for j, (a, b, ga, gb) in enumerate(ROWS)]
        assert est == statistics.median(per_row)


def test_topk_ties_kept(items_df):
    vals = [1] * 5 + [2] * 5 + [3] * 4 + [4] * 4 + [5] * 2 + [6]
    hist = S.interval_histogram(items_df(vals), 0, 100)
    got = sorted((r.rank, r.item, r.n) for r in S.topk_items(hist, 3).collect())
    # ranks 1,1 (n=5), 3,3 (n=4): rank <= 3 keeps four items
    assert got == [(1, 1, 5), (1, 2, 5), (3, 3, 4), (3, 4, 4)]
    assert S.topk_items(hist, 100).count() == 6
    empty = S.interval_histogram(items_df(vals), 50, 60)
    assert S.topk_items(empty, 3).count() == 0


def test_topk_relative_error_exact_when_wide(items_df):
    # a sketch much wider than the number of items has no collisions
    vals = [1] * 9 + [2] * 4 + [3]
    rows = [(1, 0, 1, 0)]
    hist = S.interval_histogram(items_df(vals), 0, 10)
    sk = S.count_sketch(items_df(vals), rows, 1000)
    r = S.topk_avg_relative_error(hist, sk, rows, 1000, 2).collect()[0]
    assert (r.k_items, r.avg_relative_error) == (2, 0.0)


@pytest.mark.parametrize("threshold", [1, 250, 300, 301, 10_000])
def test_stream_prefix(items_df, threshold):
    vals = list(range(1000))
    items = items_df(vals, batch_size=150)
    sizes = Counter(i // 150 for i in range(len(vals)))
    taken, total = 0, 0
    for b in sorted(sizes):
        if total < threshold:
            taken, total = taken + 1, total + sizes[b]
    r = S.stream_prefix(items, threshold).collect()[0]
    assert (r.n_batches, r.n_items) == (taken, total)


def test_stream_prefix_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "PREFIX_BLOCK", 4)
    rows = [(i, b) for b in range(0, 40, 3) for i in range(b % 5 + 1)]
    items = spark.createDataFrame(rows, "item bigint, batch bigint")
    sizes = Counter(b for _, b in rows)
    for threshold in [5, 17, 30, 1000]:
        taken, total = 0, 0
        for b in sorted(sizes):
            if total < threshold:
                taken, total = taken + 1, total + sizes[b]
        r = S.stream_prefix(items, threshold).collect()[0]
        assert (r.n_batches, r.n_items) == (taken, total)


def test_batch_item_counts(items_df):
    vals = [1, 1, 2, 3, 3, 3]
    got = sorted(map(tuple, S.batch_item_counts(items_df(vals, batch_size=4)).collect()))
    assert got == [(0, 1, 2), (0, 2, 1), (0, 3, 1), (1, 3, 2)]


def test_narrow32_hashes_low_bits(spark):
    big = (1 << 33) + 12345          # low 32 bits: 12345
    neg = (1 << 32) - 7              # low 32 bits: -7 as a signed int
    df = spark.createDataFrame([(big,), (12345,), (neg,), (-7,)], "item bigint")
    got = {r.item: (r.col_idx, r.sign) for r in
           S.sketch_hashes(df, ROWS[:1], W, narrow32=True).collect()}
    assert got[big] == got[12345]
    assert got[neg] == got[-7]
    plain = {r.item: (r.col_idx, r.sign) for r in S.sketch_hashes(df, ROWS[:1], W).collect()}
    assert plain[12345] == got[12345]


def test_batch_sizes(items_df):
    got = sorted(map(tuple, S.batch_sizes(items_df(list(range(10)), batch_size=4)).collect()))
    assert got == [(0, 4), (1, 4), (2, 2)]


def test_second_moment_no_overflow_for_a_hot_item(spark):
    # one item seen 4e9 times (its square is past 2^63) next to a small one
    hist = spark.createDataFrame([(1, 4_000_000_000), (2, 3)], "item bigint, n bigint")
    r = S.second_moment_true(hist).collect()[0]
    assert r.f2 == float(4_000_000_000 ** 2 + 9)
    sketch = spark.createDataFrame([(0, 0, 4_000_000_000), (0, 1, -3)],
                                   "row_idx int, col_idx bigint, value bigint")
    assert S.second_moment_rows(sketch).collect()[0].f2 == float(4_000_000_000 ** 2 + 9)


def test_low32_extremes(spark):
    from pyspark.sql import functions as F

    from tallyspark.functions import low32
    vals = [0, -1, 2**31 - 1, 2**31, -(2**31), 2**63 - 1, -(2**63), 2**32 + 5]
    df = spark.createDataFrame([(v,) for v in vals], "x bigint")
    got = [r[0] for r in df.select(low32("x")).collect()]
    want = [((v + 2**31) % 2**32) - 2**31 for v in vals]
    assert got == want
    assert df.select(F.max(low32("x"))).collect()[0][0] == 2**31 - 1


def test_point_estimates_do_not_shuffle_the_histogram(items_df, values):
    hist = items_df(values).groupBy("item").count().withColumnRenamed("count", "n")
    sk = S.count_sketch(items_df(values), ROWS, W)
    shuffles = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("HashAggregate(keys=[item")
    df = S.sketch_point_estimates(hist, sk, ROWS, W)
    main = df._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0]
    assert "Join" not in main and shuffles(df) == shuffles(hist)


@pytest.mark.parametrize("n_rows", [1, 2, 3])
def test_point_estimates_median_of_rows(items_df, values, n_rows):
    items, rows = items_df(values), ROWS[:n_rows]
    m = python_sketch(values)
    got = {r.item: r.estimate for r in S.sketch_point_estimates(
        S.item_histogram(items), S.count_sketch(items, rows, W), rows, W).collect()}
    assert got == {x: statistics.median([g(x, ga, gb) * m.get((j, h(x, a, b, W)), 0)
                                         for j, (a, b, ga, gb) in enumerate(rows)]) for x in set(values)}


def test_items_a_small_prime_merges_are_told_apart(items_df):
    items = items_df([5] * 30 + [5 + 8191] * 7)
    def estimates(rows, p):
        sk = S.count_sketch(items, rows, 4096, p)
        return {r.item: r.estimate for r in S.sketch_point_estimates(
            S.item_histogram(items), sk, rows, 4096, p).collect()}
    assert set(estimates(ROWS, 8191).values()) == {37.0}
    assert estimates([(48_271, 11, 1_583_458_089, 3)], 2147483647) == {5: 30.0, 5 + 8191: 7.0}
