"""Triangle counting on undirected graphs, as Spark joins.

Input: any DataFrame with bigint columns ``u, v`` (an edge list; loops,
duplicates and both orientations allowed).  The graph is undirected and
simple: loops are dropped and parallel edges collapse.

Plan shape (exact count)::

    canonical edges (u < v, distinct)          -- one aggregate shuffle
      -> orientation src -> dst by rank         -- degree agg + 2 joins
      -> edges a->b with out(a), out(b)         -- out-degree agg + 2 joins
      -> wedges  a->b JOIN x->c ON x            -- x: the end with fewer out-edges
      -> closing y->c  LEFT SEMI ON (y, c)      -- y: the other end
      -> count                                   -- partial + final agg

:func:`list_triangles` lists the triangles with b as every wedge's middle.

Orientation.  Each triangle is found exactly once under *any* total order
of the vertices (it is the path a->b->c closed by a->c with a<b<c).  With
``order="id"`` the order is the vertex id (as in the original jobs).  With
``order="degree"`` (default) it is ``(degree, id)``: every vertex then has
out-degree at most sqrt(2m), so the wedge join emits at most
m*sqrt(2m) rows even when one hub holds a third of all edges (the
"curse of the last reducer" fix).  A hub's many in-edges form a skewed
join key on the wedge join's left side only, which AQE's skew-join
splitting handles, while its right side stays small.

Grouped variants (colour classes, colour triples, edge buckets, several
runs) are the same join with the group columns added to every join key,
so a triangle is only found when its three edges share the group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions.hashing import (
    DEFAULT_PRIME,
    edge_bucket,
    node_color,
    sorted3,
)
from tallyspark.plans.materialize import materialize

ORDERS = ("degree", "id")


# ---------------------------------------------------------------------------
# Edge-set preparation
# ---------------------------------------------------------------------------

def edge_count(edges: DataFrame) -> DataFrame:
    """Number of raw edge rows (no dedup): ``(n_edges)``."""
    return edges.agg(F.count(F.lit(1)).alias("n_edges"))


def distinct_directed_edges(edges: DataFrame) -> DataFrame:
    """Distinct ``(u, v)`` pairs; ``(u, v)`` and ``(v, u)`` both stay."""
    return edges.select("u", "v").distinct()


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Undirected simple edge set: ``u < v``, no loops, no duplicates."""
    return (edges.where(F.col("u") != F.col("v"))
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
            .where("u is not null and v is not null")
            .distinct())


def vertex_degrees(canon: DataFrame) -> DataFrame:
    """``(vertex, degree)`` of a canonical edge set."""
    return (canon.select(F.explode(F.array("u", "v")).alias("vertex"))
            .groupBy("vertex").agg(F.count(F.lit(1)).alias("degree")))


def adjacency(edges: DataFrame) -> DataFrame:
    """Per vertex of the undirected simple graph: degree, smallest and
    largest neighbour.  Algebraic aggregates only (no neighbour lists),
    so a hub vertex is combined map-side like any other key."""
    canon = canonical_edges(edges)
    both = canon.select(F.col("u").alias("vertex"), F.col("v").alias("nbr")).unionByName(
        canon.select(F.col("v").alias("vertex"), F.col("u").alias("nbr")))
    return both.groupBy("vertex").agg(
        F.count(F.lit(1)).alias("degree"),
        F.min("nbr").alias("min_neighbor"),
        F.max("nbr").alias("max_neighbor"))


def vertex_rows(edges: DataFrame) -> DataFrame:
    """``(vertex, degree)`` with an edge's copies counted: from the rows as they
    come, where a vertex's edges often lie together."""
    return vertex_degrees(edges.where("u <> v"))


def orient(canon: DataFrame, order: str = "degree", degrees: DataFrame | None = None) -> DataFrame:
    """Direct every canonical edge from lower to higher rank: ``(src, dst)``,
    then further columns.  ``degrees`` may give other ranks ``(vertex, degree)``
    of all vertices than their degrees."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}, got {order!r}")
    if order == "id":
        return canon.withColumnsRenamed({"u": "src", "v": "dst"})
    more = [c for c in canon.columns if c not in ("u", "v")]
    deg = vertex_degrees(canon) if degrees is None else degrees
    du = deg.select(F.col("vertex").alias("u"), F.col("degree").alias("du"))
    dv = deg.select(F.col("vertex").alias("v"), F.col("degree").alias("dv"))
    # degrees grow with the graph: one plan for every size
    e = canon.join(du.hint("merge"), "u").join(dv.hint("merge"), "v")
    u_first = (F.col("du") < F.col("dv")) | (
        (F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))
    return e.select(F.when(u_first, F.col("u")).otherwise(F.col("v")).alias("src"),
                    F.when(u_first, F.col("v")).otherwise(F.col("u")).alias("dst"), *more)


def is_oriented(edges: DataFrame) -> bool:
    """True for the ``(src, dst)`` output of :func:`oriented_edges`."""
    return {"src", "dst"} <= set(edges.columns) and "u" not in edges.columns


def oriented_edges(edges: DataFrame, order: str = "degree",
                   stored: bool = True) -> DataFrame:
    """Canonical edges oriented by ``order``: ``(src, dst)``.

    With ``stored`` (default) the result is written once to the shared
    checkpoint folder and scanned from there, because every triangle
    query reads it several times.  (The degree orientation reads the
    canonical edges three times, from one shuffle that Spark reuses.)

    Every triangle operator below accepts either raw ``(u, v)`` edges or
    this result; pass it to run several estimators over one orientation
    (as the original jobs reuse one cached edge set).  An already
    oriented input is returned unchanged.
    """
    if is_oriented(edges):
        return edges
    canon = canonical_edges(edges)
    if not stored:
        return orient(canon, order)
    return materialize(orient(canon, order), "oriented-edges")


def _oriented_once(edges: DataFrame, order: str) -> DataFrame:
    """The oriented edges for one reader that stores what it makes of them:
    the orientation itself is not stored.  Its degrees are :func:`vertex_rows`:
    any order finds the same triangles, and no out-degree is above the root of
    twice the rows."""
    if is_oriented(edges):
        return edges
    return orient(canonical_edges(edges), order, vertex_rows(edges) if order == "degree" else None)


def _oriented_stored(edges: DataFrame, order: str) -> DataFrame:
    """:func:`_oriented_once`, stored."""
    return edges if is_oriented(edges) else materialize(_oriented_once(edges, order), "oriented-edges")


# ---------------------------------------------------------------------------
# Triangle join
# ---------------------------------------------------------------------------

def list_triangles(oriented: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Triangles ``(keys..., a, b, c)`` of an oriented edge set.

    ``keys`` are group columns every edge of a triangle must share.
    """
    k = list(keys)
    e1 = oriented.select(*k, F.col("src").alias("a"), F.col("dst").alias("b"))
    e2 = oriented.select(*k, F.col("src").alias("b"), F.col("dst").alias("c"))
    e3 = oriented.select(*k, F.col("src").alias("a"), F.col("dst").alias("c"))
    wedges = e1.join(e2, on=k + ["b"])
    return wedges.join(e3, on=k + ["a", "c"], how="left_semi").select(*k, "a", "b", "c")


def short_wedges(firsts: DataFrame, edges: DataFrame, keys: Sequence[str] = (),
                 labels: Sequence[str] = ()) -> DataFrame:
    """Wedges ``(labels..., keys..., x, y, c)`` of the edges a->b of ``firsts``
    (``labels..., keys..., src, dst``) in ``edges`` (``keys..., src, dst``).

    The end of a->b with fewer out-edges is the wedge's middle x, the other one
    is y: x->c is the wedge, y->c would close it.  So an edge has at most
    min(out(a), out(b)) wedges, and none if an end has no out-edge: never more
    than in :func:`list_triangles`, and under any order of the vertices at most
    m times twice the graph's arboricity.  The pairs x, y are stored, so that a
    query scans them, the edges for x->c and those for y->c.  All grow with the
    graph: one plan for every size, so no side is broadcast.
    """
    k = list(keys)
    out = edges.groupBy(*k, "src").agg(F.count(F.lit(1)).alias("n"))
    out_a = out.select(*k, F.col("src").alias("a"), F.col("n").alias("out_a"))
    out_b = out.select(*k, F.col("src").alias("b"), F.col("n").alias("out_b"))
    e1 = firsts.select(*labels, *k, F.col("src").alias("a"), F.col("dst").alias("b"))
    e1 = e1.join(out_b.hint("merge"), k + ["b"]).join(out_a.hint("merge"), k + ["a"])
    a_first = F.col("out_a") <= F.col("out_b")
    ends = materialize(e1.select(*labels, *k, F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("src"),
                                 F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("dst")), "wedge-ends")
    e1 = ends.withColumnsRenamed({"src": "x", "dst": "y"})
    e2 = edges.select(*k, F.col("src").alias("x"), F.col("dst").alias("c"))
    return e1.join(e2.hint("merge"), k + ["x"]).where("c <> y").select(*labels, *k, "x", "y", "c")


def closed_wedges(firsts: DataFrame, edges: DataFrame, keys: Sequence[str] = (),
                  labels: Sequence[str] = ()) -> DataFrame:
    """The closed ones of :func:`short_wedges`: one row ``(keys..., y, c,
    labels...)`` per triangle a->b->c whose a->b is in ``firsts``."""
    closing = edges.select(*keys, F.col("src").alias("y"), F.col("dst").alias("c"))
    return short_wedges(firsts, edges, keys, labels).drop("x").join(
        closing.hint("merge"), [*keys, "y", "c"], "left_semi")


Group = Callable[[Column, Column], Column]


def out_lists(oriented: DataFrame, group: Group | None = None) -> DataFrame:
    """``(src, out)``: every vertex's out-neighbours as one array, stored once;
    with ``group(src, dst)``, also ``groups``, those of the edges, whole numbers
    below 2**31.  For edges in degree order: no array is longer than sqrt(2m)."""
    # dealt by vertex first: lists made before the shuffle would save nothing
    lists = oriented.select("src", "dst").repartition("src").groupBy("src").agg(
        F.sort_array(F.collect_list("dst")).alias("out"))
    if group is not None:
        lists = lists.withColumn("groups", F.transform("out", lambda c: group(F.col("src"), c).cast("int")))
    return materialize(lists, "out-lists")


def joined_lists(stored: DataFrame, group: Group | None = None) -> DataFrame:
    """:func:`out_lists` that are not stored but made from stored edges where they
    are joined; their one shuffle serves every join."""
    entries = [F.collect_list("dst").alias("out")]
    if group is not None:
        entries.append(F.collect_list(group(F.col("src"), F.col("dst")).cast("int")).alias("groups"))
    return stored.select("src", "dst").repartition("src").groupBy("src").agg(*entries)


def looking_edges(stored: DataFrame, group: Group | None = None) -> DataFrame:
    """The edges a->b whose b has out-edges, so that they look for a third
    vertex, with a signature of those out-edges (one bit for each in 64):
    ``(src, dst, sign)``."""
    key = [F.col("dst")] if group is None else [F.col("dst"), group(F.col("src"), F.col("dst")).cast("int")]
    signs = materialize(stored.groupBy("src").agg(F.bit_or(_bit(_mark(*key))).alias("sign")), "out-signs")
    return stored.join(signs.withColumnRenamed("src", "dst").hint("shuffle_hash"), "dst").select("src", "dst", "sign")


def listed_edges(lists: DataFrame, least: int = 1) -> DataFrame:
    """The edges ``(src, dst)`` of the lists with ``least`` entries or more."""
    return lists.where(F.size("out") >= least).select("src", F.explode("out").alias("dst"))


def _mark(*key: Column) -> Column:
    """A key's bit in a 64-bit signature, 0 to 63."""
    return F.shiftrightunsigned(F.xxhash64(*key), 58).cast("int")


def _bit(mark: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), mark)


def _if_any(entries: Column) -> Column:
    """A generator: the array, if not empty.  A filter behind the column would
    compute it twice."""
    return F.explode(F.filter(F.array(entries), lambda t: F.size(t) > 0))


def shared_outs(lists: DataFrame, firsts: DataFrame | None = None, group: Group | None = None,
                later: Group | None = None) -> DataFrame:
    """``(a, [group,] n)``: how many vertices c make a triangle with an edge
    a->b of ``firsts`` (``src, dst``; all edges, if not given), in rows of one
    edge each; edges surely without one have no row.  ``firsts`` may be
    :func:`looking_edges`.  With ``group``, that of the lists, a triangle's three edges share one.  ``later(c, b)``, if given,
    tells from the ids that c comes after b, so that no other c goes along.

    ``lists`` are the :func:`out_lists` of a degree order.  Each a->b fetches a
    signature of b's out-edges (one bit for each in 64), goes to a and takes
    those of a's out-neighbours along whose bit is set; at b the exact
    intersection is counted.  So wedges travel as one array an edge, and mostly
    the ones that close: a neighbour that b lacks goes along only if another's
    bit is its own.  In degree order out(a) <= degree(a) <= degree(b), so all
    arrays together hold at most m times twice the graph's arboricity.
    A signature is 8 bytes a vertex, so each partition's are hashed; the lists
    are merged.
    """
    k = [] if group is None else ["group"]
    if firsts is None:
        firsts = listed_edges(lists, 2)  # a lone out-edge starts no triangle
    zero = F.lit(0).cast("bigint")

    def marked(c: Column) -> Column:
        has = F.col("sign").bitwiseAND(_bit(_mark(c, *map(F.col, k)))) != 0
        return has if later is None else later(c, F.col("b")) & has

    if group is None:
        marks = F.transform("out", lambda c: _mark(c))
        third, own = F.filter("out", marked), F.col("out")
    else:
        marks = F.transform("out", lambda c, i: _mark(c, F.get("groups", i)))
        third = F.filter("out", lambda c, i: (F.get("groups", i) == F.col("group")) & marked(c))
        own = F.filter("out", lambda c, i: F.get("groups", i) == F.col("group"))
    more = lists.columns[1:]
    edges = firsts.withColumnsRenamed({"src": "a", "dst": "b"})
    if "sign" not in firsts.columns:
        signs = lists.select(F.col("src").alias("b"),
                             F.aggregate(marks, zero, lambda found, m: found.bitwiseOR(_bit(m))).alias("sign"))
        edges = edges.select("a", "b").join(signs.hint("shuffle_hash"), "b")
    if group is not None:  # before the join: once an edge, not once an entry
        edges = edges.withColumn("group", group(F.col("a"), F.col("b")).cast("int"))
    # one shuffle of the lists serves both ends
    at_a = edges.join(lists.select(F.col("src").alias("a"), *more).hint("merge"), "a")
    taken = at_a.select("a", "b", *k, _if_any(third).alias("third"))
    return taken.join(lists.select(F.col("src").alias("b"), *more).hint("merge"), "b").select(
        "a", *k, F.size(F.array_intersect("third", own)).cast("bigint").alias("n"))


def _total(found: DataFrame) -> DataFrame:
    """``(triangles)`` of the rows of :func:`shared_outs`."""
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("triangles"))


def count_triangles(oriented: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., triangles)`` for the groups that have at least one, for edges
    in any order."""
    tri = closed_wedges(oriented, oriented, keys)
    return tri.groupBy(*keys).agg(F.count(F.lit(1)).alias("triangles"))


def _reversed(oriented: DataFrame) -> DataFrame:
    return oriented.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def _out_degrees(oriented: DataFrame) -> tuple[bool, int]:
    """Whether the vertices' out-degrees are smaller (by their squares) with all
    edges reversed, and the largest out-degree of the better direction."""
    def degrees(end: str) -> Column:
        n = oriented.groupBy(end).agg(F.count(F.lit(1)).alias("n"))
        square = F.col("n").cast("double") * F.col("n")
        return n.agg(F.struct(F.sum(square).alias("squares"), F.max("n").alias("most"))).scalar()

    row = oriented.sparkSession.range(1).select(degrees("src").alias("out"), degrees("dst").alias("back")).first()
    if row.out.most is None:  # no edges
        return False, 0
    reverse = row.back.squares < row.out.squares
    return reverse, (row.back if reverse else row.out).most


def _fewer_out(oriented: DataFrame) -> DataFrame:
    """The edges, all reversed if that makes the vertices' out-degrees smaller:
    an order of vertices and its reverse have the same triangles."""
    return _reversed(oriented) if _out_degrees(oriented)[0] else oriented


#: entries of the longest list made in an order that does not bound out-degrees
LONGEST_LIST = 1024


def _count_in_id_order(edges: DataFrame) -> DataFrame:
    """``(triangles)`` of edges in id order or its reverse.

    Ids bound no out-degree, so only the vertices with at most
    :data:`LONGEST_LIST` out-edges have lists.  A triangle a->b->c is counted by
    :func:`shared_outs` if a and b have one, else by the rows of
    :func:`closed_wedges`, whose middle is the end with fewer out-edges.  The
    direction follows from the rows as given, as :func:`vertex_rows`.
    """
    given = edges if is_oriented(edges) else edges.where("u <> v").select(
        F.least("u", "v").alias("src"), F.greatest("u", "v").alias("dst"))
    reverse, most = _out_degrees(given)
    oriented = _oriented_once(edges, "id")
    if reverse:
        oriented = _reversed(oriented)

    def listed(some: DataFrame) -> DataFrame:
        return _total(shared_outs(out_lists(some), later=lambda c, b: c < b if reverse else c > b))

    if most <= LONGEST_LIST:
        return listed(oriented)
    oriented = materialize(oriented, "oriented-edges")
    out = oriented.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    # up to an edge in LONGEST_LIST: may be many
    wide = materialize(out.where(F.col("n") > LONGEST_LIST).select("src"), "wide-vertices")
    wide_src, wide_dst = wide.hint("merge"), wide.select(F.col("src").alias("dst")).hint("merge")
    narrow = materialize(oriented.join(wide_src, "src", "left_anti"), "narrow-edges")
    firsts = oriented.join(wide_src, "src", "left_semi").select("src", "dst").unionByName(
        narrow.join(wide_dst, "dst", "left_semi").select("src", "dst"))
    rows = closed_wedges(firsts, oriented).agg(F.count(F.lit(1)).alias("triangles"))
    return listed(narrow).unionByName(rows).agg(F.sum("triangles").alias("triangles"))


def _scaled(triangles: DataFrame, parts: int) -> DataFrame:
    """``(estimate)``: the triangles that ``parts`` parts kept, times its square."""
    return triangles.select((F.col("triangles") * F.lit(parts * parts)).cast("bigint").alias("estimate"))


def _zero_filled(groups: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join per-group counts onto a *bounded* group list, 0 if absent."""
    return (groups.join(counts, on=list(keys), how="left")
            .select(*keys, F.coalesce(F.col("triangles"), F.lit(0)).cast("bigint")
                    .alias("triangles")))


def triangles_exact(edges: DataFrame, order: str = "degree") -> DataFrame:
    """Exact triangle count of the undirected simple graph: ``(triangles)``."""
    # a degree order bounds the out-degrees, ids do not
    if order == "id":
        return _count_in_id_order(edges)
    oriented = _oriented_stored(edges, order)
    return _total(shared_outs(joined_lists(oriented), looking_edges(oriented)))


def graph_summary(edges: DataFrame, order: str = "degree") -> DataFrame:
    """``(n_vertices, n_edges, triangles)`` of the undirected simple graph."""
    if order == "id":
        oriented = oriented_edges(edges, order)
        n_edges = F.count(F.lit(1))
        ends, found = F.array("src", "dst"), count_triangles(oriented)
    else:
        oriented = out_lists(_oriented_once(edges, order))
        n_edges = F.coalesce(F.sum(F.size("out")), F.lit(0)).cast("bigint")
        ends, found = F.concat(F.array("src"), "out"), _total(shared_outs(oriented))
    n_vertices = oriented.select(F.explode(ends).alias("x")).distinct().agg(F.count(F.lit(1))).scalar()
    # two scalar subqueries next to the triangle aggregate
    return found.select(n_vertices.alias("n_vertices"), oriented.agg(n_edges).scalar().alias("n_edges"), "triangles")


# ---------------------------------------------------------------------------
# Exact count with the hubs apart
# ---------------------------------------------------------------------------

#: vertices of the highest degrees whose neighbourhoods are bitmaps
HUBS = 512
_WORD_BITS = 64


def _bit_words(number: str, words: int) -> list[Column]:
    """Aggregates: the set of the group's hub numbers as 64-bit words."""
    bit = F.expr(f"shiftleft(1L, cast({number} % {_WORD_BITS} as int))")
    word = F.expr(f"{number} div {_WORD_BITS}")
    return [F.bit_or(F.when(word == w, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"w{w}") for w in range(words)]


def hub_numbers(oriented: DataFrame, hubs: int = HUBS) -> DataFrame:
    """``(vertex, hub)``: the ``hubs`` last vertices of the degree order,
    numbered from 0 (at most that many rows)."""
    canon = oriented.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    top = vertex_degrees(canon).orderBy(F.desc("degree"), F.desc("vertex")).limit(hubs)
    return top.select("vertex", (F.row_number().over(Window.orderBy("vertex")) - 1).cast("bigint").alias("hub"))


def triangles_hub_split(edges: DataFrame, hubs: int = HUBS) -> DataFrame:
    """Exact triangle count with no hot join key: ``(triangles)``.

    The last ``hubs`` vertices of the degree order are hubs, so every edge from
    a hub leads to a hub.  A triangle a -> b -> c is counted

    * with b a hub (then c is one): per a, the hubs it points to are a bitmap,
      made by one combined aggregate on a.  For each such b, the bits it shares
      with b's own bitmap are counted.  The hubs' bitmaps are one array of
      ``hubs ** 2 / 8`` bytes, a parameter's size, so the closing edge needs
      neither a wedge nor a shuffle.
    * with b no hub: by the joins of :func:`list_triangles`.  Each vertex left in
      the middle has a degree below ``2 * m / hubs``, and a key (a, c) has at
      most sqrt(2m) wedges.

    Takes raw edges, or the output of :func:`oriented_edges` in degree order.
    """
    if not 0 < hubs <= 4096:
        raise ValueError("between 1 and 4096 hubs are possible")
    lists = out_lists(oriented_edges(edges, "degree", stored=False))
    oriented = listed_edges(lists)
    words = -(-hubs // _WORD_BITS)
    # at most 4096 rows, and read three times
    numbers = F.broadcast(materialize(hub_numbers(oriented, hubs), "hubs"))
    to_hub = oriented.join(numbers.select(F.col("vertex").alias("dst"), "hub"), "dst")
    sets = to_hub.groupBy("src").agg(*_bit_words("hub", words), F.collect_list("hub").alias("hubs"))  # at most `hubs` each
    own = sets.join(numbers.select(F.col("vertex").alias("src"), "hub"), "src").select(
        "hub", F.array(*[f"w{w}" for w in range(words)]).alias("set"))
    every = edges.sparkSession.range(hubs).select(F.col("id").alias("hub"))
    empty = F.array_repeat(F.lit(0).cast("bigint"), words)
    matrix = every.join(own, "hub", "left").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("hub", F.coalesce("set", empty).alias("set")))), lambda r: r["set"]))
    shared = F.aggregate("hubs", F.lit(0).cast("bigint"), lambda total, b: total + sum(
        (F.bit_count(F.col(f"w{w}").bitwiseAND(F.get(F.get("matrix", b.cast("int")), F.lit(w)))) for w in range(1, words)),
        F.bit_count(F.col("w0").bitwiseAND(F.get(F.get("matrix", b.cast("int")), F.lit(0))))))
    # one hub alone closes no triangle
    closed = sets.where(F.size("hubs") > 1).withColumn("matrix", matrix.scalar()).select(shared.alias("n"))
    light = numbers.select(F.col("vertex"))
    to_light = listed_edges(lists, 2).join(light.withColumnRenamed("vertex", "dst"), "dst", "left_anti")
    wedges = _total(shared_outs(lists, to_light)).select(F.col("triangles").alias("n"))
    return closed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).unionByName(wedges).agg(
        F.sum("n").cast("bigint").alias("triangles"))


# ---------------------------------------------------------------------------
# Node colouring (one run)
# ---------------------------------------------------------------------------

def node_colors(edges: DataFrame, a: int, b: int, num_colors: int,
                p: int = DEFAULT_PRIME) -> DataFrame:
    """``(vertex, color)`` for every vertex of the graph."""
    v = edges.select(F.explode(F.array("u", "v")).alias("vertex")).distinct()
    return v.select("vertex", node_color("vertex", a, b, num_colors, p).alias("color"))


def monochromatic_edges(edges: DataFrame, a: int, b: int, num_colors: int,
                        p: int = DEFAULT_PRIME) -> DataFrame:
    """Canonical edges whose endpoints share a colour: ``(u, v, color)``."""
    canon = canonical_edges(edges)
    cu = node_color("u", a, b, num_colors, p)
    cv = node_color("v", a, b, num_colors, p)
    return canon.where(cu == cv).select("u", "v", cu.alias("color"))


def _mono_oriented(edges: DataFrame, a, b, num_colors: int, p: int,
                   order: str) -> DataFrame:
    """Oriented edges inside colour classes.  Raw edges are filtered before
    they are made distinct and oriented."""
    def same(x: str, y: str) -> Column:
        return node_color(x, a, b, num_colors, p) == node_color(y, a, b, num_colors, p)
    inside = edges.where(same("src", "dst") if is_oriented(edges) else same("u", "v"))
    return _oriented_once(inside, order).withColumn("color", node_color("src", a, b, num_colors, p))


def triangles_per_color(edges: DataFrame, a: int, b: int, num_colors: int,
                        p: int = DEFAULT_PRIME, order: str = "degree") -> DataFrame:
    """Triangles inside each colour class: ``(color, triangles)``.

    A class with monochromatic edges but no triangle reports 0; a class
    without any monochromatic edge has no row.
    """
    mono = _mono_oriented(edges, a, b, num_colors, p, order)
    if order == "id":
        mono = materialize(mono, "color-edges")
        counts = count_triangles(mono, ["color"])
        colors = mono.select("color").distinct()  # at most C rows
        return _zero_filled(colors, counts, ["color"])
    # edges of one colour that meet have the same
    lists = out_lists(mono)

    def color(vertex: str) -> Column:
        return node_color(vertex, a, b, num_colors, p).alias("color")

    counts = shared_outs(lists).groupBy(color("a")).agg(F.sum("n").alias("triangles"))
    return _zero_filled(lists.select(color("src")).distinct(), counts, ["color"])


def triangles_approx_color(edges: DataFrame, a: int, b: int, num_colors: int,
                           p: int = DEFAULT_PRIME, order: str = "degree") -> DataFrame:
    """Node-colouring estimate ``C^2 * sum_i t_i``: ``(estimate)``."""
    mono = _mono_oriented(edges, a, b, num_colors, p, order)
    if order == "id":
        tri = count_triangles(materialize(mono, "color-edges"))
    else:
        tri = _total(shared_outs(out_lists(mono)))
    return _scaled(tri, num_colors)


# ---------------------------------------------------------------------------
# Node colouring, R independent runs in one job
# ---------------------------------------------------------------------------

#: runs of one job; their parameters travel as one array
MAX_RUNS = 10_000
RunParams = Sequence[tuple[int, int]] | DataFrame


def run_parameters(spark: SparkSession, num_runs: int, seed: int,
                   p: int = DEFAULT_PRIME) -> DataFrame:
    """``(run, ha, hb)`` for runs ``0 .. num_runs - 1``: ``ha`` in ``[1, p)``
    and ``hb`` in ``[0, p)`` from 48 bits of a SHA-256 of seed and run, so that
    every task, and every replay of one, sees the same table."""
    def draw(part: str, below: int) -> Column:
        digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"), F.lit(f":{part}")).cast("binary"), 256)
        return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint"), F.lit(below))
    return spark.range(num_runs).select(
        F.col("id").cast("int").alias("run"), (draw("a", p - 1) + 1).alias("ha"), draw("b", p).alias("hb"))


def _run_params(params: RunParams) -> Column:
    """Array of ``struct(run, ha, hb)``: the fan-out per edge is
    the number of runs, a parameter (the same work as that many separate jobs,
    over one scan).  A table of runs is read as one array, its size checked."""
    if isinstance(params, DataFrame):
        n = params.count()
        if not 0 < n <= MAX_RUNS:
            raise ValueError(f"between 1 and {MAX_RUNS} runs are possible, got {n}")
        return params.agg(F.sort_array(F.collect_list(F.struct("run", "ha", "hb")))).scalar()
    if not params:
        raise ValueError("at least one (a, b) run is required")
    return F.array(*[
        F.struct(F.lit(i).alias("run"), F.lit(int(a)).cast("bigint").alias("ha"),
                 F.lit(int(b)).cast("bigint").alias("hb"))
        for i, (a, b) in enumerate(params)])


def triangles_approx_color_runs(edges: DataFrame, params: RunParams,
                                num_colors: int, p: int = DEFAULT_PRIME,
                                order: str = "degree") -> DataFrame:
    """One node-colouring estimate per run: ``(run, estimate)``.

    ``params`` are ``(a, b)`` pairs, numbered from 0, or a table ``(run, ha,
    hb)`` of different runs such as :func:`run_parameters`.  The edges of one
    colour in any run are stored once: the joins see the set's real size.  A
    wedge is one row for all its runs, and none if no run gives its vertices one
    colour.
    """
    runs = _run_params(params)
    u, v = ("src", "dst") if is_oriented(edges) else ("u", "v")

    def same(x: str, y: str, r: Column) -> Column:
        return (node_color(x, r["ha"], r["hb"], num_colors, p)
                == node_color(y, r["ha"], r["hb"], num_colors, p))

    # of one colour in some run
    some = edges.select(u, v, runs.alias("runs")).where(F.exists("runs", lambda r: same(u, v, r))).select(u, v)
    mono = materialize(_oriented_once(some, order).select("src", "dst"), "run-edges")

    def shared(r: Column) -> Column:
        return same("x", "y", r) & same("x", "c", r)

    # edges of one colour that meet have the same: the closing edge has it too
    wedges = short_wedges(mono, mono).withColumn("runs", runs).where(F.exists("runs", shared)).drop("runs")
    closing = mono.select(F.col("src").alias("y"), F.col("dst").alias("c"))
    found = wedges.join(closing.hint("merge"), ["y", "c"], "left_semi").withColumn("runs", runs)
    per_run = (found.select(F.explode(F.transform(F.filter("runs", shared), lambda r: r["run"])).alias("run"))
               .groupBy("run").agg(F.count(F.lit(1)).alias("triangles")))
    every = edges.sparkSession.range(1).select(F.explode(runs).alias("r")).select(F.col("r.run").alias("run"))
    c2 = num_colors * num_colors
    return (every.join(per_run, "run", "left")
            .select("run", (F.coalesce(F.col("triangles"), F.lit(0)) * F.lit(c2))
                    .cast("bigint").alias("estimate")))


def mean_estimate(runs: DataFrame) -> DataFrame:
    """Mean of the run estimates truncated to an integer: ``(estimate_mean)``
    (what the original PySpark job prints as its "median")."""
    return runs.agg(F.floor(F.avg("estimate")).cast("bigint").alias("estimate_mean"))


def median_estimate(runs: DataFrame) -> DataFrame:
    """Exact median of the run estimates; for an even count, the integer
    mean of the two middle values: ``(estimate_median)``."""
    # R rows, a parameter; whole-number arithmetic
    ranked = runs.agg(F.sort_array(F.collect_list("estimate")).alias("e"))
    return ranked.select(F.expr(
        "case when size(e) = 0 then null when size(e) % 2 = 1 then e[size(e) div 2] "
        "else cast((cast(e[size(e) div 2 - 1] as decimal(38, 0)) + e[size(e) div 2]) div 2 as bigint) end")
        .alias("estimate_median"))


# ---------------------------------------------------------------------------
# Exact count by colour triples
# ---------------------------------------------------------------------------

def _colored_ends(oriented: DataFrame, a: int, b: int, num_colors: int, p: int) -> DataFrame:
    """The edges with the colours of both ends."""
    return oriented.withColumns({"color_src": node_color("src", a, b, num_colors, p),
                                 "color_dst": node_color("dst", a, b, num_colors, p)})


def _replicated_by_triple(colored: DataFrame, num_colors: int) -> DataFrame:
    """Each row of :func:`_colored_ends` C times, keyed by
    ``sort(h(src), h(dst), i)``, i in [0, C): ``(k0, k1, k2, columns..., i)``."""
    rep = colored.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                   F.lit(num_colors - 1).cast("bigint"))).alias("i"))
    k0, k1, k2 = sorted3(F.col("color_src"), F.col("color_dst"), F.col("i"))
    return rep.select(k0.alias("k0"), k1.alias("k1"), k2.alias("k2"), *rep.columns)


def edge_color_triples(edges: DataFrame, a: int, b: int, num_colors: int,
                       p: int = DEFAULT_PRIME) -> DataFrame:
    """Replicated canonical edges per colour-triple key: ``(k0, k1, k2, n_edges)``."""
    canon = edges if is_oriented(edges) else canonical_edges(edges).select(
        F.col("u").alias("src"), F.col("v").alias("dst"))
    rep = _replicated_by_triple(_colored_ends(canon, a, b, num_colors, p), num_colors)
    return rep.groupBy("k0", "k1", "k2").agg(F.count(F.lit(1)).alias("n_edges"))


def _triple_key(num_colors: int) -> Column:
    """The colour triple as one number."""
    return ((F.col("k0") * num_colors + F.col("k1")) * num_colors + F.col("k2")).alias("key")


def triangles_per_color_triple(edges: DataFrame, a: int, b: int, num_colors: int,
                               p: int = DEFAULT_PRIME,
                               order: str = "degree") -> DataFrame:
    """Per colour-triple key, the triangles whose sorted vertex colours equal
    the key: ``(k0, k1, k2, triangles)``; keys without one report 0.

    Edges are replicated C times (key ``sort(h(u), h(v), i)``) and each copy
    looks for its own triangles.  A triangle belongs to key k only if its sorted
    vertex colours are k; for the copy of edge a->b keyed with ``i`` that means
    the third vertex must have colour ``i``.  So a copy takes only the third
    vertices of colour ``i``: only owned wedges are ever produced, none is
    filtered after the join.
    """
    oriented = _oriented_stored(edges, order)
    counts = _owned_triangles(oriented, a, b, num_colors, p, order).groupBy("key").agg(F.sum("n").alias("triangles"))
    # at most C^2 pairs of colours and C^3 keys
    pairs = _colored_ends(oriented, a, b, num_colors, p).select("color_src", "color_dst").distinct()
    keys = _replicated_by_triple(pairs, num_colors).select(_triple_key(num_colors)).distinct()
    c = num_colors
    return _zero_filled(keys, counts, ["key"]).select(
        F.expr(f"key div {c * c}").alias("k0"), F.expr(f"key div {c} % {c}").alias("k1"),
        F.expr(f"key % {c}").alias("k2"), "triangles")


def _owned_triangles(oriented: DataFrame, a: int, b: int, num_colors: int, p: int, order: str) -> DataFrame:
    """``(key, n)``: the triangles of each copy of an edge, under the copy's key
    only; copies surely without one have no row.

    As in :func:`shared_outs`, an edge goes to a's out-neighbours, keeps those in
    b's signature, and b decides.  Its C copies are made at a, where the ones
    whose colour ``i`` no such neighbour has end at once.  So the C-fold edges
    are neither stored nor shuffled.  In id order, which bounds no list, the
    copies look for their third vertex by rows.
    """
    def color(x: Column | str) -> Column:
        return node_color(x, a, b, num_colors, p)

    looking, key = materialize(looking_edges(oriented), "triple-edges"), _triple_key(num_colors)
    if order == "id":
        copies = _replicated_by_triple(_colored_ends(looking, a, b, num_colors, p), num_colors)
        found = closed_wedges(copies.select(key, F.col("i").alias("color_c"), "src", "dst"),
                              oriented.select(color("dst").alias("color_c"), "src", "dst"), ["color_c"], ["key"])
        return found.select("key", F.lit(1).cast("bigint").alias("n"))
    lists = joined_lists(oriented)
    near = F.filter("out", lambda c: F.col("sign").bitwiseAND(_bit(_mark(c))) != 0)
    at_a = looking.join(lists.hint("merge"), "src").select("src", "dst", _if_any(near).alias("near"))
    at_a = _colored_ends(at_a, a, b, num_colors, p).withColumn("colors", F.transform("near", color))
    copies = _replicated_by_triple(at_a, num_colors).where(F.exists("colors", lambda c: F.col("i") == c))
    third = F.filter("near", lambda _, at: F.col("i") == F.get("colors", at))
    at_b = copies.select(key, "dst", third.alias("third")).join(
        lists.withColumnRenamed("src", "dst").hint("merge"), "dst")
    return at_b.select("key", F.size(F.array_intersect("third", "out")).cast("bigint").alias("n"))


def triangles_exact_colored(edges: DataFrame, a: int, b: int, num_colors: int,
                            p: int = DEFAULT_PRIME, order: str = "degree") -> DataFrame:
    """Exact count as the sum over colour triples: ``(triangles)``.
    Independent of ``a``, ``b`` and ``C``."""
    return _total(_owned_triangles(_oriented_stored(edges, order), a, b, num_colors, p, order))


# ---------------------------------------------------------------------------
# Edge-partition estimate
# ---------------------------------------------------------------------------

def _within_buckets(edges: DataFrame, bucket: Group, order: str) -> tuple[DataFrame, DataFrame]:
    """The buckets that have an edge, and the triangles inside a bucket
    ``(bucket, triangles)``; ``bucket`` takes an edge's smaller and larger end."""
    def group(x: Column, y: Column) -> Column:
        return bucket(F.least(x, y), F.greatest(x, y)).cast("bigint")

    if order == "id":
        bk = materialize(_oriented_once(edges, order).withColumn("bucket", group(F.col("src"), F.col("dst"))), "bucket-edges")
        return bk.select("bucket").distinct(), count_triangles(bk, ["bucket"])
    oriented = _oriented_stored(edges, order)
    looking = materialize(looking_edges(oriented, group), "looking-edges")
    counts = shared_outs(joined_lists(oriented, group), looking, group).groupBy("group").agg(F.sum("n").alias("triangles"))
    return (oriented.select(group(F.col("src"), F.col("dst")).alias("bucket")).distinct(),
            counts.select(F.col("group").cast("bigint").alias("bucket"), "triangles"))


def _partition_estimate(edges: DataFrame, bucket: Group, order: str, parts: int) -> DataFrame:
    counts = _within_buckets(edges, bucket, order)[1]
    return _scaled(counts.agg(F.coalesce(F.sum("triangles"), F.lit(0)).alias("triangles")), parts)


def triangles_per_edge_bucket(edges: DataFrame, a_u: int, a_v: int, b: int,
                              num_buckets: int, p: int = DEFAULT_PRIME,
                              order: str = "degree") -> DataFrame:
    """Split the distinct edges into C buckets by an edge hash and count the
    triangles whose three edges share a bucket: ``(bucket, triangles)``."""
    buckets, counts = _within_buckets(
        edges, lambda lo, hi: edge_bucket(lo, hi, a_u, a_v, b, num_buckets, p), order)
    return _zero_filled(buckets, counts, ["bucket"])


def triangles_approx_partition(edges: DataFrame, a_u: int, a_v: int, b: int,
                               num_buckets: int, p: int = DEFAULT_PRIME,
                               order: str = "degree") -> DataFrame:
    """``C^2 * sum`` of :func:`triangles_per_edge_bucket`: ``(estimate)``."""
    return _partition_estimate(
        edges, lambda lo, hi: edge_bucket(lo, hi, a_u, a_v, b, num_buckets, p), order, num_buckets)


def triangles_approx_spark_partition(edges: DataFrame, num_parts: int,
                                     order: str = "degree") -> DataFrame:
    """Edge-partition estimate where the parts are the ones Spark's hash
    partitioner gives ``repartition(C, "u", "v")`` -- ``pmod(hash(u, v), C)``
    -- computed as a column, so C does not limit the parallelism:
    ``(estimate)``."""
    return _partition_estimate(
        edges, lambda lo, hi: F.pmod(F.hash(lo, hi), F.lit(num_parts)), order, num_parts)


def triangles_approx_partition_directed(edges: DataFrame, a_u: int, a_v: int, b: int,
                                        num_buckets: int, p: int = DEFAULT_PRIME,
                                        order: str = "degree") -> DataFrame:
    """Edge-partition estimate over the *directed* edges as given: ``u,v`` and
    ``v,u`` may fall into different buckets, a repeated edge counts once in a
    bucket: ``(estimate)``.  Takes raw edges only."""
    if is_oriented(edges):
        raise ValueError("the directed form needs the raw edges")
    # a direction of an edge has one bucket, so an edge has two at most
    canon = edges.where("u <> v").groupBy(F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi")).agg(
        F.max(F.col("u") < F.col("v")).alias("up"), F.max(F.col("u") > F.col("v")).alias("down")).select(
        F.col("lo").alias("u"), F.col("hi").alias("v"), "up", "down")
    if order == "degree":
        canon = materialize(canon, "canonical-edges")
    lo, hi = F.least("src", "dst"), F.greatest("src", "dst")
    there = F.when(F.col("up"), edge_bucket(lo, hi, a_u, a_v, b, num_buckets, p).cast("bigint"))
    back = F.when(F.col("down"), edge_bucket(hi, lo, a_u, a_v, b, num_buckets, p).cast("bigint"))
    bk = materialize(orient(canon, order).select(
        F.explode(F.array_compact(F.array_distinct(F.array(there, back)))).alias("bucket"), "src", "dst"), "bucket-edges")
    c2 = num_buckets * num_buckets
    return closed_wedges(bk, bk, ["bucket"]).agg(
        (F.count(F.lit(1)) * F.lit(c2)).cast("bigint").alias("estimate"))
