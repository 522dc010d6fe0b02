"""Work that grows no faster than the input: wedges, copies and shuffles."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

from conftest import SF_SMALL
from tallyspark.llm import neardup
from tallyspark.operators import graph as G
from tallyspark.operators import wordcount as W


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def two_sided(near=4, far=300):
    """Vertex 0 points to a few vertices, which point to many."""
    pairs = [(0, i) for i in range(1, near + 1)] + [(1, 2)]
    return pairs + [(i, 1000 * i + j) for i in range(1, near + 1) for j in range(far)]


def test_wedges_come_from_the_shorter_list(spark, edges_df):
    oriented = G.oriented_edges(edges_df(two_sided()), "id")
    middle = oriented.alias("x").join(oriented.alias("y"), F.col("x.dst") == F.col("y.src")).count()
    assert middle > 1000
    wedges = G.short_wedges(oriented, oriented)
    # 0->1..4 look at the out-edges of 0, 1->2 at 300 of one end
    assert wedges.count() <= 4 * 3 + 301
    assert G.closed_wedges(oriented, oriented).count() == 1


def test_wedges_keep_groups_and_labels(spark):
    rows = [(g, u, v, 10 * u + v) for g in (1, 2) for u, v in [(1, 2), (2, 3), (1, 3), (3, 4)] if (g, u) != (2, 2)]
    e = spark.createDataFrame(rows, "g int, src bigint, dst bigint, label bigint")
    found = G.closed_wedges(e, e.drop("label"), ["g"], ["label"]).collect()
    assert [(r.g, r.label, r.c) for r in found] == [(1, 12, 3)]


def test_id_order_is_reversed_for_a_hub_with_a_low_id(spark, edges_df):
    pairs = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1, 399)]
    oriented = G._fewer_out(G.oriented_edges(edges_df(pairs), "id"))
    assert oriented.groupBy("src").count().agg(F.max("count")).first()[0] == 2
    assert G.triangles_exact(edges_df(pairs), "id").first()[0] == 398
    assert G.triangles_exact(edges_df([]), "id").first()[0] == 0


def test_triples_look_up_one_copy_of_an_edge(spark):
    """Only the edges that look for a third vertex are replicated."""
    df = E.queries()["triangles_exact_colored"](spark, SF_SMALL)
    assert plan_text(df).count("(i#") >= 2 and " = 0)" in plan_text(df)
    df.collect()


@pytest.mark.parametrize("name,columns", [
    ("triangles_approx_color_runs", "src:bigint,dst:bigint"),
    ("triangles_approx_partition_directed", "bucket:bigint,src:bigint,dst:bigint")])
def test_stored_groups_are_narrow(spark, name, columns):
    plan = plan_text(E.queries()[name](spark, SF_SMALL))
    assert plan.count(f"ReadSchema: struct<{columns}>") >= 3
    assert "lo#" not in plan and "lineitem.parquet" not in plan


@pytest.mark.parametrize("name", ["triangles_exact", "graph_summary", "triangles_exact_hub_split",
                                  "triangles_per_edge_bucket", "triangles_approx_spark_partition"])
def test_edges_are_never_broadcast(spark, name):
    """One plan for every size: at sf0.001 too."""
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    assert not re.search(r"BroadcastHashJoin \[[^\]]*\b[abcxy]#", plan_text(df))


def test_term_counts_shuffle_texts_once(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, None]), rng.randrange(3), " ".join(rng.choice("ab c") for _ in range(9)))
            for _ in range(60)] + [(5, 0, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, line_no bigint, text string")
    want = {}
    for d, n, text in rows:
        for w in text.split(" ") if text is not None else []:
            want[d, n, w] = want.get((d, n, w), 0) + 1
    df = W.doc_term_counts(docs)
    plan = plan_text(df)
    assert re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan.split("Initial Plan")[0])
    assert not re.search(r"hashpartitioning\([^)]*word#", plan)
    assert {(r.doc_id, r.line_no, r.word): r.n for r in df.collect()} == want


def test_prefix_length_comes_from_no_sample(spark, monkeypatch):
    def never(*_):
        raise AssertionError("the length is not measured")

    monkeypatch.setattr(neardup, "matched_length", never)
    docs = spark.createDataFrame([(i, f"one two three four five six seven eight {i % 3}") for i in range(9)],
                                 "doc_id bigint, text string")
    assert {r.n_copies for r in neardup.near_duplicates(docs).collect()} == {3}
    assert neardup.FOREST.sampled_nodes == 1


def random_pairs(seed, vertices=40, rows=400):
    rng = random.Random(seed)
    return [(rng.randrange(vertices), rng.randrange(vertices)) for _ in range(rows)] + [(None, 1), (2, None)]


@pytest.mark.parametrize("name", ["triangles_exact", "graph_summary", "triangles_exact_hub_split", "triangles_per_color",
                                  "triangles_approx_partition", "triangles_approx_spark_partition"])
def test_wedges_travel_as_lists(spark, name):
    """F7 F8 F9 F15 F16: no shuffle has a row for every wedge or closing pair."""
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    plan = plan_text(df)
    assert not re.search(r"hashpartitioning\((\w+#\d+L?, )*y#", plan)
    assert "array_intersect" in plan and "ReusedExchange" in plan


@pytest.mark.parametrize("buckets", [1, 3])
def test_lists_keep_groups_apart(spark, edges_df, buckets):
    pairs = random_pairs(buckets)
    edges = {(min(p), max(p)) for p in pairs if None not in p and p[0] != p[1]}
    bucket = {(u, v): (31 * u + 57 * v + 11) % 8191 % buckets for u, v in edges}
    want = dict.fromkeys(bucket.values(), 0)
    for u, v in edges:
        for w in range(v + 1, 40):
            if (u, w) in edges and (v, w) in edges and bucket[u, v] == bucket[u, w] == bucket[v, w]:
                want[bucket[u, v]] += 1
    for order in ("degree", "id"):
        got = G.triangles_per_edge_bucket(edges_df(pairs), 31, 57, 11, buckets, order=order).collect()
        assert {r.bucket: r.triangles for r in got} == want
    if buckets == 1:
        assert G.triangles_exact(edges_df(pairs)).first()[0] == want[0]
        assert tuple(G.graph_summary(edges_df(pairs)).first()) == (40, len(edges), want[0])


def test_lists_carry_few_neighbours_that_do_not_close(spark, edges_df):
    """An edge sends the neighbours whose bit is set: here 1 of 300 can close."""
    oriented = G.oriented_edges(edges_df([(0, i) for i in range(1, 301)] + [(1, 2), (1, 1000)]), "id")
    lists = G.out_lists(oriented)
    rows = {r.a: r.n for r in G.shared_outs(lists, G.listed_edges(lists).where("dst = 1")).collect()}
    assert rows == {0: 1}
    assert G.shared_outs(lists).count() == 1  # only 0->1 meets a vertex with out-edges


def test_copies_of_an_edge_only_change_the_order(spark, edges_df):
    pairs = random_pairs(9) + [(1, 2)] * 500
    assert G.triangles_exact(edges_df(pairs)).first()[0] == G.triangles_exact(edges_df(set(pairs))).first()[0]
    assert G.triangles_exact(edges_df([])).first()[0] == 0
    assert tuple(G.graph_summary(edges_df([])).first()) == (0, 0, 0)


def test_id_order_travels_as_lists(spark):
    """no shuffle has a row for every wedge or closing pair."""
    df = E.queries()["triangles_exact_id_order"](spark, SF_SMALL)
    df.collect()
    plan = plan_text(df)
    assert not re.search(r"hashpartitioning\((\w+#\d+L?, )*y#", plan) and "array_intersect" in plan


@pytest.mark.parametrize("hub", [-1, 100])
@pytest.mark.parametrize("longest", [4, 12, 1024])
def test_id_order_makes_no_long_list(spark, edges_df, monkeypatch, longest, hub):
    """ids bound no out-degree; a hub at either end of the ids, or at both, has no list."""
    pairs = random_pairs(longest) + [(hub, i) for i in range(40)] + [(i, 50) for i in range(0, 40, 3)] + [(hub, 50)]
    edges = {(min(p), max(p)) for p in pairs if None not in p and p[0] != p[1]}
    want = sum((u, w) in edges and (v, w) in edges for u, v in edges for w in {e[1] for e in edges})
    made, out_lists = [], G.out_lists
    monkeypatch.setattr(G, "LONGEST_LIST", longest)
    monkeypatch.setattr(G, "out_lists", lambda *a, **k: made.append(out_lists(*a, **k)) or made[-1])
    for rows in (edges_df(pairs), G.oriented_edges(edges_df(pairs), "id")):
        assert G.triangles_exact(rows, "id").first()[0] == want
    assert all((found.agg(F.max(F.size("out"))).first()[0] or 0) <= longest for found in made) and len(made) == 2


def test_id_order_sends_only_later_neighbours(spark, edges_df):
    lists = G.out_lists(G.oriented_edges(edges_df([(0, i) for i in range(1, 301)] + [(200, 201)]), "id"))
    only = G.listed_edges(lists).where("dst = 200")
    assert {r.a: r.n for r in G.shared_outs(lists, only, later=lambda c, b: c > b).collect()} == {0: 1}
    assert G.shared_outs(lists, only, later=lambda c, b: c > b + 100).collect() == []


@pytest.mark.parametrize("name", ["triangles_per_color_triple", "triangles_exact_colored"])
def test_copies_look_where_their_neighbours_are(spark, name):
    """F1 F2: no shuffle has a row for every copy of an edge, every wedge or closing pair."""
    df = E.queries()[name](spark, SF_SMALL)
    initial = plan_text(df)
    df.collect()
    plan = plan_text(df)
    assert not re.search(r"hashpartitioning\((\w+#\d+L?, )*y#", plan)
    assert "array_intersect" in plan and "ReusedExchange" in plan
    # the copies are made behind the join with a's neighbours
    made = re.search(r"explode\([^\n]*, \[[^\n]*\], false, \[i#", initial)
    assert made and re.search(r"Join \[src#", initial).start() > made.start()


@pytest.mark.parametrize("colors", [1, 3, 4])
def test_copies_own_their_triangles(spark, edges_df, colors):
    """F1 F2: with copies of rows, nulls and a hub; keys without a triangle report 0."""
    pairs = random_pairs(colors) + [(7, i) for i in range(40)] * 2
    edges = {(min(p), max(p)) for p in pairs if None not in p and p[0] != p[1]}

    def key(*ends):
        return tuple(sorted((17 * x + 23) % 8191 % colors for x in ends))

    want = {tuple(sorted((*key(*e), i))): 0 for e in edges for i in range(colors)}
    for u, v in edges:
        for w in range(v + 1, 40):
            if (u, w) in edges and (v, w) in edges:
                want[key(u, v, w)] += 1
    for order in ("degree", "id"):
        got = G.triangles_per_color_triple(edges_df(pairs), 17, 23, colors, order=order).collect()
        assert {(r.k0, r.k1, r.k2): r.triangles for r in got} == want and len(got) == len(want)
        assert G.triangles_exact_colored(edges_df(pairs), 17, 23, colors, order=order).first()[0] == sum(want.values())


def test_copies_without_a_third_vertex_end_early(spark, edges_df):
    """F1 F2: of the four copies of an edge, only the one of the third vertex's colour goes on."""
    oriented = G.oriented_edges(edges_df([(1, 2), (2, 3), (1, 3), (3, 4)]))
    k0, k1, k2 = sorted((17 * x + 23) % 4 for x in (1, 2, 3))
    rows = G._owned_triangles(oriented, 17, 23, 4, 8191, "degree").collect()
    assert [tuple(r) for r in rows] == [(16 * k0 + 4 * k1 + k2, 1)]
    assert G.triangles_exact_colored(edges_df([]), 17, 23, 4).first()[0] == 0
    assert G.triangles_per_color_triple(edges_df([]), 17, 23, 4).collect() == []
