"""Property tests: random inputs against plain-Python references."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyspark.operators import graph as G
from tallyspark.operators import sketch as S
from tallyspark.operators import wordcount as W

from test_graph import brute_triangles

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

vertex = st.integers(min_value=-6, max_value=14)
edge_lists = st.lists(st.tuples(vertex, vertex), min_size=0, max_size=60)


@SETTINGS
@given(pairs=edge_lists, a=st.integers(1, 8190), b=st.integers(0, 8190),
       c=st.integers(1, 4))
def test_exact_counts_agree(spark, pairs, a, b, c):
    df = spark.createDataFrame(pairs, "u bigint, v bigint")
    want = len(brute_triangles(pairs))
    assert G.triangles_exact(df).collect()[0][0] == want
    assert G.triangles_exact_colored(df, a, b, c).collect()[0][0] == want


word = st.text(alphabet="ab é.", min_size=0, max_size=4)
texts = st.lists(st.lists(word, min_size=1, max_size=6).map(" ".join),
                 min_size=1, max_size=5).map("\n".join)


@SETTINGS
@given(docs=st.lists(texts, min_size=1, max_size=4), k=st.integers(1, 5))
def test_word_counts_agree(spark, docs, k):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    from tallyspark.sources.fixtures import document_lines
    lines = document_lines(df)
    want = Counter(w for d in docs for line in d.split("\n") for w in line.split(" "))
    for wc in (W.word_count(lines), W.word_count_salted(lines, k),
               W.word_count_salted_at_shuffle(lines, k), W.word_count_by_partition(lines)):
        assert {r.word: r.n for r in wc.collect()} == dict(want)


@SETTINGS
@given(values=st.lists(st.integers(-20, 40), min_size=0, max_size=80),
       left=st.integers(-25, 10), width=st.integers(5, 30), k=st.integers(1, 6))
def test_histogram_and_topk(spark, values, left, width, k):
    right = left + width
    items = spark.createDataFrame([(v,) for v in values], "item bigint")
    hist = S.interval_histogram(items, left, right)
    freq = Counter(v for v in values if left < v < right)
    assert {r.item: r.n for r in hist.collect()} == dict(freq)
    top = {r.item: r.rank for r in S.topk_items(hist, k).collect()}
    want = {x: 1 + sum(1 for y in freq.values() if y > n) for x, n in freq.items()}
    assert top == {x: r for x, r in want.items() if r <= k}


params = st.tuples(st.integers(1, 8190), st.integers(0, 8190),
                   st.integers(1, 8190), st.integers(0, 8190))


@SETTINGS
@given(values=st.lists(st.integers(-(2**40), 2**40), min_size=1, max_size=60),
       rows=st.lists(params, min_size=1, max_size=4), width=st.integers(1, 50))
def test_count_sketch_random_params(spark, values, rows, width):
    p = 8191
    want = {}
    for x in values:
        for j, (a, b, ga, gb) in enumerate(rows):
            col = ((a * x + b) % p) % width
            sign = 1 if 2 * ((ga * x + gb) % p) >= p - 1 else -1
            want[(j, col)] = want.get((j, col), 0) + sign
    items = spark.createDataFrame([(v,) for v in values], "item bigint")
    got = {(r.row_idx, r.col_idx): r.value for r in S.count_sketch(items, rows, width).collect()}
    assert got == want


@SETTINGS
@given(sizes=st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=0, max_size=25),
       threshold=st.integers(0, 120), block=st.integers(1, 7))
def test_stream_prefix_random(spark, sizes, threshold, block):
    rows = [(i, b) for b, n in sizes.items() for i in range(n)]
    items = spark.createDataFrame(rows, "item bigint, batch bigint")
    taken = total = 0
    for b in sorted(sizes):  # the original loop: whole batches while below T
        if total < threshold:
            taken, total = taken + 1, total + sizes[b]
    old = S.PREFIX_BLOCK
    S.PREFIX_BLOCK = block
    try:
        r = S.stream_prefix(items, threshold).collect()[0]
    finally:
        S.PREFIX_BLOCK = old
    assert (r.n_batches, r.n_items) == (taken, total)


@SETTINGS
@given(lines=st.lists(st.tuples(
    st.lists(st.tuples(st.integers(-99, 10**12), st.integers(-99, 10**12)), min_size=1,
             max_size=6),
    st.integers(0, 2)), min_size=1, max_size=8))
def test_flat_lines_random(spark, lines):
    import os
    import tempfile

    from tallyspark.sources import files as FS
    text = [",".join(f"{u},{v}" for u, v in pairs) + "," * trailing
            for pairs, trailing in lines]
    d = tempfile.mkdtemp(prefix="flat-prop-")
    with open(os.path.join(d, "part-0.txt"), "w") as f:
        f.write("\n".join(text) + "\n")
    want = sorted(e for pairs, _ in lines for e in pairs)
    assert sorted(map(tuple, FS.read_flat_lines(spark, d).collect())) == want


@SETTINGS
@given(pairs=edge_lists, a=st.integers(1, 8190), b=st.integers(0, 8190),
       c=st.integers(1, 4), au=st.integers(1, 8190), av=st.integers(1, 8190))
def test_decompositions_random_params(spark, pairs, a, b, c, au, av):
    p = 8191
    df = spark.createDataFrame(pairs, "u bigint, v bigint")
    tris = brute_triangles(pairs)
    col = lambda x: ((a * x + b) % p) % c
    want = {}
    for t in tris:
        k = tuple(sorted(col(x) for x in t))
        want[k] = want.get(k, 0) + 1
    got = {(r.k0, r.k1, r.k2): r.triangles
           for r in G.triangles_per_color_triple(df, a, b, c).collect()}
    assert {k: v for k, v in got.items() if v} == want
    canon = {(min(u, v), max(u, v)) for u, v in pairs if u != v}
    bucket = {e: ((au * e[0] + av * e[1] + 11) % p) % c for e in canon}
    wb = {}
    for x, y, z in tris:
        bs = {bucket[(x, y)], bucket[(y, z)], bucket[(x, z)]}
        if len(bs) == 1:
            k = bs.pop()
            wb[k] = wb.get(k, 0) + 1
    gb = {r.bucket: r.triangles
          for r in G.triangles_per_edge_bucket(df, au, av, 11, c).collect()}
    assert {k: v for k, v in gb.items() if v} == wb


@SETTINGS
@given(docs=st.lists(texts, min_size=1, max_size=4))
def test_term_counts_and_mean_length(spark, docs):
    from tallyspark.sources.fixtures import document_lines
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    lines = document_lines(df)
    want = {}
    for d, text in enumerate(docs):
        for i, line in enumerate(text.split("\n")):
            for w, n in Counter(line.split(" ")).items():
                want[(d, i, w)] = n
    got = {(r.doc_id, r.line_no, r.word): r.n for r in W.doc_term_counts(lines).collect()}
    assert got == want
    distinct = {w for (_, _, w) in want}
    r = W.average_word_length(lines).collect()[0]
    assert r.n_words == len(distinct)
    assert r.avg_word_length == sum(len(w) for w in distinct) / len(distinct)
