"""Triangle operators against hand-made graphs and a brute-force counter."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import graph as G

P = 8191


# -- brute force (plain Python, adjacency sets) -----------------------------

def undirected(pairs):
    return {frozenset(p) for p in pairs if p[0] != p[1]}


def brute_triangles(pairs):
    edges = undirected(pairs)
    vertices = sorted(set().union(*edges)) if edges else []
    return [t for t in itertools.combinations(vertices, 3)
            if all(frozenset(side) in edges for side in itertools.combinations(t, 2))]


def color(x, a, b, c):
    return ((a * x + b) % P) % c


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][0]


TINY = {
    "empty": ([], 0),
    "noisy_triangle": ([(1, 2), (2, 1), (2, 3), (1, 3), (3, 3), (1, 2)], 1),
    "square_diagonal": ([(1, 2), (2, 3), (3, 4), (4, 1), (1, 3)], 2),
    "k5": (list(itertools.combinations(range(1, 6), 2)), 10),
}


@pytest.mark.parametrize("name", list(TINY))
@pytest.mark.parametrize("order", ["degree", "id"])
def test_tiny_graphs(spark, edges_df, name, order):
    pairs, expected = TINY[name]
    assert one(G.triangles_exact(edges_df(pairs), order)) == expected


def random_graph(seed, n=40, m=260, hub=True):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
    if hub:  # a hub joined to most vertices, plus negative ids
        pairs += [(0, x) for x in range(1, n, 2)]
        pairs += [(-5, 3), (3, -7), (-5, -7), (-5, 3)]
    return pairs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_matches_brute_force(spark, edges_df, seed):
    pairs = random_graph(seed)
    expected = len(brute_triangles(pairs))
    df = edges_df(pairs)
    assert one(G.triangles_exact(df, "degree")) == expected
    assert one(G.triangles_exact(df, "id")) == expected
    got = sorted(tuple(sorted(r)) for r in
                 G.list_triangles(G.oriented_edges(df)).select("a", "b", "c").collect())
    assert got == sorted(brute_triangles(pairs))


@pytest.mark.parametrize("a,b,c", [(17, 23, 4), (4001, 77, 3), (8190, 0, 2), (3, 5000, 5)])
def test_colored_exact_equals_exact(spark, edges_df, a, b, c):
    pairs = random_graph(7)
    expected = len(brute_triangles(pairs))
    assert one(G.triangles_exact_colored(edges_df(pairs), a, b, c)) == expected


def test_per_color_triple_matches_brute_force(spark, edges_df):
    pairs = random_graph(11)
    a, b, c = 17, 23, 3
    want = {}
    for tri in brute_triangles(pairs):
        key = tuple(sorted(color(x, a, b, c) for x in tri))
        want[key] = want.get(key, 0) + 1
    got = {(r.k0, r.k1, r.k2): r.triangles for r in
           G.triangles_per_color_triple(edges_df(pairs), a, b, c).collect()}
    assert {k: v for k, v in got.items() if v} == want
    # every key reached by a replicated edge is listed, zero or not
    assert set(got) >= set(want)


def test_per_color_matches_brute_force(spark, edges_df):
    pairs = random_graph(5)
    a, b, c = 4001, 77, 3
    mono = [(u, v) for u, v in pairs if u != v and color(u, a, b, c) == color(v, a, b, c)]
    want = {}
    for tri in brute_triangles(mono):
        k = color(tri[0], a, b, c)
        want[k] = want.get(k, 0) + 1
    classes = {color(u, a, b, c) for u, v in mono}
    got = {r.color: r.triangles for r in
           G.triangles_per_color(edges_df(pairs), a, b, c).collect()}
    assert set(got) == classes
    assert {k: v for k, v in got.items() if v} == want
    est = one(G.triangles_approx_color(edges_df(pairs), a, b, c))
    assert est == c * c * sum(want.values())


def test_one_color_is_exact(spark, edges_df):
    pairs = random_graph(3)
    expected = len(brute_triangles(pairs))
    df = edges_df(pairs)
    assert one(G.triangles_approx_color(df, 5, 6, 1)) == expected
    assert one(G.triangles_approx_partition(df, 31, 57, 11, 1)) == expected
    assert one(G.triangles_approx_spark_partition(df, 1)) == expected


def test_runs_mean_and_median(spark, edges_df):
    pairs = random_graph(9)
    runs = [(17, 23), (4001, 77), (8190, 0), (3, 5000)]
    c = 2
    df = edges_df(pairs)
    per_run = {r.run: r.estimate for r in
               G.triangles_approx_color_runs(df, runs, c).collect()}
    single = [one(G.triangles_approx_color(df, a, b, c)) for a, b in runs]
    assert [per_run[i] for i in range(len(runs))] == single
    srt = sorted(single)
    assert one(G.median_estimate(G.triangles_approx_color_runs(df, runs, c))) == \
        (srt[1] + srt[2]) // 2
    assert one(G.median_estimate(G.triangles_approx_color_runs(df, runs[:3], c))) == \
        sorted(single[:3])[1]
    assert one(G.mean_estimate(G.triangles_approx_color_runs(df, runs, c))) == \
        int(sum(single) / len(single))


def test_median_even_integer_mean_of_middles(spark):
    runs = spark.createDataFrame([(0, 1), (1, 2), (2, 4), (3, 8)], "run int, estimate bigint")
    assert one(G.median_estimate(runs)) == 3
    runs = spark.createDataFrame([(0, 1), (1, 4)], "run int, estimate bigint")
    assert one(G.median_estimate(runs)) == 2  # (1 + 4) / 2 truncated


def test_no_monochromatic_edge_gives_zero(spark, edges_df):
    # two vertices of different colours: no monochromatic edge at all
    a, b, c = 1, 0, 2
    df = edges_df([(0, 1)])
    assert one(G.triangles_approx_color(df, a, b, c)) == 0
    assert G.triangles_per_color(df, a, b, c).count() == 0
    assert [r.estimate for r in G.triangles_approx_color_runs(df, [(a, b)], c).collect()] == [0]


def test_edge_buckets_match_brute_force(spark, edges_df):
    pairs = random_graph(13)
    a_u, a_v, b, c = 31, 57, 11, 3
    canon = {(min(u, v), max(u, v)) for u, v in pairs if u != v}
    bucket = {e: ((a_u * e[0] + a_v * e[1] + b) % P) % c for e in canon}
    want = {}
    for k in set(bucket.values()):
        part = [e for e in canon if bucket[e] == k]
        want[k] = len(brute_triangles(part))
    got = {r.bucket: r.triangles for r in
           G.triangles_per_edge_bucket(edges_df(pairs), a_u, a_v, b, c).collect()}
    assert got == want


def test_edge_sets(spark, edges_df):
    pairs = [(1, 2), (2, 1), (1, 2), (3, 3), (4, -1)]
    df = edges_df(pairs)
    assert one(G.edge_count(df)) == 5
    assert sorted(map(tuple, G.distinct_directed_edges(df).collect())) == \
        [(1, 2), (2, 1), (3, 3), (4, -1)]
    assert sorted(map(tuple, G.canonical_edges(df).collect())) == [(-1, 4), (1, 2)]
    adj = {r.vertex: (r.degree, r.min_neighbor, r.max_neighbor)
           for r in G.adjacency(df).collect()}
    assert adj == {1: (1, 2, 2), 2: (1, 1, 1), 4: (1, -1, -1), -1: (1, 4, 4)}


def test_degree_order_bounds_out_degree(spark, edges_df):
    # star with 200 leaves plus a ring over the leaves
    leaves = list(range(1, 201))
    pairs = [(0, x) for x in leaves] + [(x, x + 1) for x in leaves[:-1]]
    o = G.oriented_edges(edges_df(pairs), "degree")
    hub_out = o.where("src = 0").count()
    assert hub_out == 0  # the hub has the highest rank
    assert one(G.triangles_exact(edges_df(pairs))) == len(brute_triangles(pairs))


def test_node_colors_and_mono(spark, edges_df):
    pairs = random_graph(4, hub=False)
    a, b, c = 17, 23, 4
    got = {r.vertex: r.color for r in G.node_colors(edges_df(pairs), a, b, c).collect()}
    verts = {x for e in pairs for x in e}
    assert got == {x: color(x, a, b, c) for x in verts}
    mono = sorted(map(tuple, G.monochromatic_edges(edges_df(pairs), a, b, c).collect()))
    canon = {(min(u, v), max(u, v)) for u, v in pairs if u != v}
    assert mono == sorted((u, v, color(u, a, b, c)) for u, v in canon
                          if color(u, a, b, c) == color(v, a, b, c))


def test_graph_summary(spark, edges_df):
    pairs, expected = TINY["square_diagonal"]
    r = G.graph_summary(edges_df(pairs)).collect()[0]
    assert (r.n_vertices, r.n_edges, r.triangles) == (4, 5, expected)


@pytest.mark.parametrize("n", [3, 12, 40])
def test_complete_graph_golden(spark, edges_df, n):
    pairs = list(itertools.combinations(range(n), 2))
    assert one(G.triangles_exact(edges_df(pairs))) == n * (n - 1) * (n - 2) // 6
    assert one(G.triangles_exact_colored(edges_df(pairs), 17, 23, 3)) == \
        n * (n - 1) * (n - 2) // 6


def test_color_estimate_is_unbiased_on_average(spark):
    from tallyspark.sources import raw_edges
    edges = raw_edges(spark, "/root/testdata/sf0.001")
    exact = one(G.triangles_exact(edges))
    rnd = random.Random(42)
    runs = [(rnd.randrange(1, P), rnd.randrange(0, P)) for _ in range(40)]
    est = G.triangles_approx_color_runs(edges, runs, 2).collect()
    mean = sum(r.estimate for r in est) / len(est)
    assert abs(mean - exact) / exact < 0.05
    part = G.triangles_approx_partition(edges, 31, 57, 11, 2)
    assert abs(one(part) - exact) / exact < 0.2


def test_operators_accept_a_stored_orientation(spark, edges_df):
    pairs = random_graph(21)
    raw = edges_df(pairs)
    o = G.oriented_edges(raw)
    assert G.oriented_edges(o) is o
    same = [
        (G.triangles_exact, ()),
        (G.triangles_per_color, (17, 23, 3)),
        (G.triangles_approx_color, (17, 23, 3)),
        (G.triangles_approx_color_runs, ([(17, 23), (5, 6)], 3)),
        (G.triangles_per_color_triple, (17, 23, 3)),
        (G.triangles_exact_colored, (17, 23, 3)),
        (G.triangles_per_edge_bucket, (31, 57, 11, 3)),
        (G.triangles_approx_spark_partition, (3,)),
        (G.edge_color_triples, (17, 23, 3)),
        (G.graph_summary, ()),
    ]
    for fn, args in same:
        assert sorted(map(tuple, fn(raw, *args).collect())) == \
            sorted(map(tuple, fn(o, *args).collect())), fn.__name__


@pytest.mark.parametrize("values,median", [
    ([9007199254740993] * 3, 9007199254740993),
    ([9007199254740993, 9007199254740995], 9007199254740994),
    ([5, 1, 4], 4), ([1, 4], 2), ([9223372036854775807, 9223372036854775805], 9223372036854775806)])
def test_median_is_whole_number_arithmetic(spark, values, median):
    runs = spark.createDataFrame(list(enumerate(values)), "run int, estimate bigint")
    assert one(G.median_estimate(runs)) == median


def test_directed_partition_needs_one_bucket_for_three_directions(edges_df):
    # both directions of each edge of a triangle and a tail; a repeated edge
    pairs = [(1, 2), (2, 1), (2, 3), (3, 1), (1, 3), (3, 4), (1, 2), (4, 4)]
    edges = edges_df(pairs)
    assert G.triangles_approx_partition_directed(edges, 31, 57, 11, 1).collect()[0][0] == 1
    for buckets in (2, 3):
        held = {}
        for u, v in pairs:
            held.setdefault(((31 * u + 57 * v + 11) % 8191) % buckets, set()).add(frozenset((u, v)))
        want = sum(all(frozenset(e) in s for e in ((1, 2), (2, 3), (1, 3))) for s in held.values())
        got = G.triangles_approx_partition_directed(edges, 31, 57, 11, buckets).collect()[0][0]
        assert got == want * buckets * buckets
    with pytest.raises(ValueError):
        G.triangles_approx_partition_directed(G.oriented_edges(edges), 31, 57, 11, 2)


# -- hubs apart, parameter table ------------------------------------------------

def plain_count(pairs):
    near = {}
    for u, v in undirected(pairs):
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    return sum(len([w for w in near[u] & near[v] if w > v]) for u in near for v in near[u] if v > u)


@pytest.mark.parametrize("hubs", [1, 2, 7, 64, 65, 512])
def test_hub_split_counts(spark, edges_df, hubs):
    rng = random.Random(hubs)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(500)]
    pairs += [(0, i) for i in range(200)] + [(i, 1) for i in range(150)] + [(-5, 0), (-5, 1), (7, 7)]
    assert G.triangles_hub_split(edges_df(pairs), hubs).collect()[0][0] == plain_count(pairs)


def test_hub_split_of_small_graphs(spark, edges_df):
    assert G.triangles_hub_split(edges_df([])).collect()[0][0] == 0
    assert G.triangles_hub_split(edges_df([(1, 1)])).collect()[0][0] == 0
    assert G.triangles_hub_split(edges_df([(1, 2), (2, 3), (3, 1)])).collect()[0][0] == 1
    with pytest.raises(ValueError):
        G.triangles_hub_split(edges_df([(1, 2)]), 0)


def star_and_clique():
    """40 vertices that are all linked, two of them linked to 3000 leaves
    each, and 3000 pairs of leaves."""
    pairs = [(i, j) for i in range(40) for j in range(i)]
    pairs += [(h, 1000 + leaf) for leaf in range(3000) for h in range(2)]
    return pairs + [(1000 + i, 1000 + (i * 7 + 1) % 3000) for i in range(3000)]


def test_hub_split_has_no_hot_key(spark, edges_df):
    pairs = star_and_clique()
    edges = G.oriented_edges(edges_df(pairs))
    assert G.triangles_hub_split(edges, 64).collect()[0][0] == G.triangles_exact(edges).collect()[0][0]
    hubs = G.hub_numbers(edges, 64).select(F.col("vertex").alias("dst"))

    def widest(rows, key):
        per_task = [r.n for r in rows.repartition(8, key).groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n")).collect()]
        per_task += [0] * (8 - len(per_task))
        return max(per_task) / max(1, sorted(per_task)[4])

    # the joins on the middle vertex: hubs' in-edges are hot, the others not
    assert widest(edges, "dst") > 3
    light = edges.join(hubs, "dst", "left_anti")
    assert light.count() > 1000 and widest(light, "dst") < 3
    # the bitmaps are combined by the vertex that points to hubs
    assert widest(edges.join(hubs, "dst"), "src") < 3


def test_hub_split_probes_hubs_without_wedges(spark, edges_df):
    df = G.triangles_hub_split(edges_df(star_and_clique()), 64)
    plan = df._jdf.queryExecution().toString()
    assert "bit_or" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_run_table(spark, edges_df):
    runs = G.run_parameters(spark, 50, 3)
    rows = [tuple(r) for r in runs.collect()]
    assert [r[0] for r in rows] == list(range(50))
    assert all(1 <= a < 8191 and 0 <= b < 8191 for _, a, b in rows) and len(set(rows)) == 50
    assert rows == [tuple(r) for r in G.run_parameters(spark, 50, 3).repartition(7).orderBy("run").collect()]
    assert rows != [tuple(r) for r in G.run_parameters(spark, 50, 4).collect()]
    pairs = [(i, j) for i in range(30) for j in range(i)]
    listed = G.triangles_approx_color_runs(edges_df(pairs), [(a, b) for _, a, b in rows], 3)
    table = G.triangles_approx_color_runs(edges_df(pairs), runs, 3)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, listed.collect()))
    # unbiased: 50 draws of a graph with 4060 triangles
    mean = G.mean_estimate(table).collect()[0][0]
    assert 0.6 * 4060 < mean < 1.4 * 4060
    with pytest.raises(ValueError):
        G.triangles_approx_color_runs(edges_df(pairs), runs.limit(0), 3)
    few = runs.where("run in (3, 9)")  # any different runs
    got = G.triangles_approx_color_runs(edges_df(pairs), few, 3)
    assert sorted(r.run for r in got.collect()) == [3, 9]
