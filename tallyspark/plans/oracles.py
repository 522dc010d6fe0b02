"""DuckDB SQL equivalent to every registered query (same column names and
types), over the provided tables as views.

The SQL is written the straightforward way -- triangles by the vertex-id
order ``u < v < w`` with a plain three-way join, windows for ranks and
running totals -- so it cross-checks the Spark plans rather than
mirroring them.  Parameters come from :mod:`tallyspark.plans.params`.
"""

from __future__ import annotations

from tallyspark.plans import params as P
from tallyspark.sources.fixtures import EVENTS_PER_BATCH, KIND_ORDER, KIND_PART
from tallyspark.sources.fixtures import KIND_SUPPLIER, NUM_KINDS, WIDE_CENTRE, WIDE_STEP

p = P.P
C = P.NUM_COLORS
C2 = C * C

# --------------------------------------------------------------------------
# Shared CTEs
# --------------------------------------------------------------------------

LINES = """lines AS (
  SELECT doc_id, unnest(generate_series(0, len(parts) - 1)) AS line_no,
         unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents) d)"""

TOKENS = LINES + """,
tokens AS (SELECT doc_id, line_no, unnest(string_split(line, ' ')) AS word FROM lines)"""

RAW = f"""raw_edges AS (
  SELECT CASE WHEN l_linenumber % 2 = 0 THEN y ELSE x END AS u,
         CASE WHEN l_linenumber % 2 = 0 THEN x ELSE y END AS v
  FROM (SELECT l_linenumber, l_orderkey * {NUM_KINDS} + {KIND_ORDER} AS x,
               l_partkey * {NUM_KINDS} + {KIND_PART} AS y FROM lineitem
        UNION ALL
        SELECT l_linenumber, l_orderkey * {NUM_KINDS} + {KIND_ORDER},
               l_suppkey * {NUM_KINDS} + {KIND_SUPPLIER} FROM lineitem
        UNION ALL
        SELECT l_linenumber, l_partkey * {NUM_KINDS} + {KIND_PART},
               l_suppkey * {NUM_KINDS} + {KIND_SUPPLIER} FROM lineitem) t)"""

CANON = RAW + """,
canon AS (SELECT DISTINCT least(u, v) AS u, greatest(u, v) AS v
          FROM raw_edges WHERE u <> v)"""

TRIANGLE_COUNT = """SELECT count(*) FROM canon e1
  JOIN canon e2 ON e2.u = e1.v
  JOIN canon e3 ON e3.u = e1.u AND e3.v = e2.v"""


def color(x: str, a, b, c=C, prime=p) -> str:
    return f"((({a}) * ({x} % {prime}) + ({b})) % {prime}) % {c}"


A0, B0 = P.COLOR_RUNS[0]


def mono_sql(a: int, b: int, prime: int = p) -> str:
    cu, cv = color("u", a, b, prime=prime), color("v", a, b, prime=prime)
    return CANON + f""",
mono AS (SELECT u, v, {cu} AS color FROM canon WHERE {cu} = {cv})"""


MONO = mono_sql(A0, B0)

SAME_COLOR = """,
tri AS (SELECT e1.color, count(*) AS t FROM mono e1
  JOIN mono e2 ON e2.color = e1.color AND e2.u = e1.v
  JOIN mono e3 ON e3.color = e1.color AND e3.u = e1.u AND e3.v = e2.v
  GROUP BY e1.color)"""

MONO_TRI = MONO + SAME_COLOR


def listed(runs) -> str:
    return "VALUES " + ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(runs))


def drawn(part: str) -> str:
    return f"CAST('0x' || substr(sha256('{P.RUN_SEED}:' || run || ':{part}'), 1, 12) AS BIGINT)"


RUN_TABLE = f"""SELECT CAST(run AS INTEGER) AS run, {drawn('a')} % {p - 1} + 1 AS ha, {drawn('b')} % {p} AS hb
  FROM (SELECT unnest(range({P.NUM_RUNS})) AS run) r"""


def runs_sql(params: str) -> str:
    return CANON + f""",
params(run, ha, hb) AS ({params}),
colored AS (SELECT q.run, c.u, c.v, {color('c.u', 'q.ha', 'q.hb')} AS cu,
                   {color('c.v', 'q.ha', 'q.hb')} AS cv
            FROM canon c CROSS JOIN params q),
mono AS (SELECT run, u, v, cu AS color FROM colored WHERE cu = cv),
tri AS (SELECT e1.run, count(*) AS t FROM mono e1
  JOIN mono e2 ON e2.run = e1.run AND e2.color = e1.color AND e2.u = e1.v
  JOIN mono e3 ON e3.run = e1.run AND e3.color = e1.color
              AND e3.u = e1.u AND e3.v = e2.v
  GROUP BY e1.run),
runs AS (SELECT q.run, CAST({C2} * coalesce(tri.t, 0) AS BIGINT) AS estimate
         FROM params q LEFT JOIN tri ON tri.run = q.run)"""


REP = CANON + f""",
col AS (SELECT u, v, {color('u', A0, B0)} AS cu, {color('v', A0, B0)} AS cv FROM canon),
rep AS (SELECT least(cu, cv, i) AS k0,
               cu + cv + i - least(cu, cv, i) - greatest(cu, cv, i) AS k1,
               greatest(cu, cv, i) AS k2, u, v, cu, cv
        FROM col CROSS JOIN (SELECT unnest(range({C})) AS i) r)"""

TRIPLE_TRI = REP + """,
tri AS (SELECT e1.k0, e1.k1, e1.k2, count(*) AS t FROM rep e1
  JOIN rep e2 ON e2.k0 = e1.k0 AND e2.k1 = e1.k1 AND e2.k2 = e1.k2 AND e2.u = e1.v
  JOIN rep e3 ON e3.k0 = e1.k0 AND e3.k1 = e1.k1 AND e3.k2 = e1.k2
             AND e3.u = e1.u AND e3.v = e2.v
  WHERE least(e1.cu, e1.cv, e2.cv) = e1.k0
    AND greatest(e1.cu, e1.cv, e2.cv) = e1.k2
    AND e1.cu + e1.cv + e2.cv - least(e1.cu, e1.cv, e2.cv)
        - greatest(e1.cu, e1.cv, e2.cv) = e1.k1
  GROUP BY e1.k0, e1.k1, e1.k2),
per_triple AS (SELECT k.k0, k.k1, k.k2, coalesce(tri.t, 0) AS triangles
  FROM (SELECT DISTINCT k0, k1, k2 FROM rep) k
  LEFT JOIN tri ON tri.k0 = k.k0 AND tri.k1 = k.k1 AND tri.k2 = k.k2)"""


def bucket_tri(buckets: str) -> str:
    """Triangles per bucket of a query ``u, v, bucket`` over canon edges."""
    return CANON + f""",
bk AS ({buckets}),
tri AS (SELECT e1.bucket, count(*) AS t FROM bk e1
  JOIN bk e2 ON e2.bucket = e1.bucket AND e2.u = e1.v
  JOIN bk e3 ON e3.bucket = e1.bucket AND e3.u = e1.u AND e3.v = e2.v
  GROUP BY e1.bucket),
per_bucket AS (SELECT b.bucket, coalesce(tri.t, 0) AS triangles
  FROM (SELECT DISTINCT bucket FROM bk) b LEFT JOIN tri ON tri.bucket = b.bucket)"""


EDGE_BUCKET = f"(({P.BUCKET_A_U} * u + {P.BUCKET_A_V} * v + {P.BUCKET_B}) % {p}) % {C}"
BUCKET_TRI = bucket_tri(f"SELECT u, v, {EDGE_BUCKET} AS bucket FROM canon")
DIRECTED_TRI = bucket_tri(f"""SELECT DISTINCT least(u, v) AS u, greatest(u, v) AS v, {EDGE_BUCKET} AS bucket
  FROM raw_edges WHERE u <> v""")

MASK32 = 2**32 - 1


def murmur3(query: str, columns: list[str], seed: int = 42) -> str:
    """``query`` with a column ``h``: the signed 32-bit Murmur3 hash of bigint
    columns, each hashed with the one before as its seed, as Spark's ``hash``
    does.  One subquery per step keeps the expressions short."""
    def times(x: str, c: int) -> str:
        return f"CAST((CAST({x} AS HUGEINT) * {c}) % {2**32} AS BIGINT)"

    def turned(x: str, r: int) -> str:
        return f"((({x} << {r}) & {MASK32}) | ({x} >> {32 - r}))"

    def step(name: str, value: str) -> None:
        nonlocal query
        keep = f"* REPLACE ({value} AS {name})" if name in made else f"*, {value} AS {name}"
        made.add(name)
        query = f"SELECT {keep} FROM ({query})"

    # fixed values: multipliers, turns and shifts of the 32-bit Murmur3
    made: set[str] = set()
    step("h", f"CAST({seed} AS BIGINT)")
    for c in columns:
        for word in (f"({c} & {MASK32})", f"(({c} >> 32) & {MASK32})"):
            step("k", times(word, 0xCC9E2D51))
            step("k", turned("k", 15))
            step("k", times("k", 0x1B873593))
            step("h", "xor(h, k)")
            step("h", turned("h", 13))
            step("h", f"(h * 5 + {0xE6546B64}) & {MASK32}")
        step("h", "xor(h, 8)")
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            step("h", f"xor(h, h >> {shift})")
            step("h", times("h", factor))
        step("h", "xor(h, h >> 16)")
    step("h", f"CASE WHEN h >= {2**31} THEN h - {2**32} ELSE h END")
    return query


SPARK_TRI = bucket_tri(f"""SELECT u, v, ((h % {C}) + {C}) % {C} AS bucket
  FROM ({murmur3('SELECT u, v FROM canon', ['u', 'v'])})""")

ITEMS = f"""items AS (SELECT user_id AS item, event_id // {EVENTS_PER_BATCH} AS batch
          FROM events)"""

HIST = ITEMS + f""",
hist AS (SELECT item, count(*) AS n FROM items
         WHERE item > {P.LEFT} AND item < {P.RIGHT} GROUP BY item)"""

W = P.SKETCH_WIDTH


def sk_cte(rows=P.SKETCH_ROWS) -> str:
    values = ", ".join(f"({j}, {a}, {b}, {ga}, {gb})" for j, (a, b, ga, gb) in enumerate(rows))
    return f"sk(row_idx, ha, hb, ga, gb) AS (VALUES {values})"


SK = sk_cte()


def sk_cols(x: str, prime: int = p) -> str:
    return (f"s.row_idx, {color(x, 's.ha', 's.hb', W, prime)} AS col_idx, "
            f"CASE WHEN 2 * ((s.ga * ({x} % {prime}) + s.gb) % {prime}) >= {prime - 1} "
            f"THEN 1 ELSE -1 END AS sign")


def sketch_cte(where: str, rows=P.SKETCH_ROWS, prime: int = p) -> str:
    return f"""{sk_cte(rows)},
cs AS (SELECT row_idx, col_idx, CAST(sum(sign) AS BIGINT) AS value
       FROM (SELECT {sk_cols('i.item', prime)} FROM items i CROSS JOIN sk s {where}) x
       GROUP BY row_idx, col_idx)"""


IN_INTERVAL = f"WHERE i.item > {P.LEFT} AND i.item < {P.RIGHT}"
HIST_SKETCH = HIST + ",\n" + sketch_cte(IN_INTERVAL)
HIST_SKETCH_ALL = HIST + ",\n" + sketch_cte("")

ALL_LARGE = ITEMS + """,
hist AS (SELECT item, count(*) AS n FROM items GROUP BY item),
""" + sketch_cte("", P.LARGE_ROWS, P.LARGE_P)

F2_APPROX = """SELECT quantile_cont(f2, 0.5) AS f2_median,
       quantile_cont(f2, 0.5)
       / nullif((SELECT CAST(count(*) AS DOUBLE) * count(*) FROM hist), 0)
       AS f2_normalized
FROM (SELECT row_idx, CAST(sum(CAST(value AS HUGEINT) * value) AS DOUBLE) AS f2
      FROM cs GROUP BY row_idx) r"""

TOP = f"""top AS (SELECT item, n, rnk AS rank FROM (
  SELECT item, n, rank() OVER (ORDER BY n DESC) AS rnk FROM hist) r
  WHERE rnk <= {P.TOP_K})"""


def point_estimates(src: str, prime: int = p) -> str:
    return f"""probes AS (SELECT h.item, h.n, {sk_cols('h.item', prime)}
                FROM {src} h CROSS JOIN sk s),
est AS (SELECT q.item, q.n, quantile_cont(q.sign * coalesce(c.value, 0), 0.5)
               AS estimate
        FROM probes q LEFT JOIN cs c ON c.row_idx = q.row_idx AND c.col_idx = q.col_idx
        GROUP BY q.item, q.n)"""


ORACLE_SQL: dict[str, str] = {
    # ---- text -----------------------------------------------------------
    "document_lines": f"WITH {LINES} SELECT doc_id, line_no, line FROM lines",
    "document_count": f"WITH {LINES} SELECT count(*) AS n_documents FROM lines",
    "doc_tokens": f"""WITH {LINES}
        SELECT doc_id, line_no, len(string_split(line, ' ')) AS n_tokens FROM lines""",
    "doc_term_counts": f"""WITH {TOKENS}
        SELECT doc_id, line_no, word, count(*) AS n FROM tokens
        GROUP BY doc_id, line_no, word""",
    "word_count": f"WITH {TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word",
    "distinct_words": f"""WITH {TOKENS}
        SELECT count(DISTINCT word) AS n_words FROM tokens""",
    "average_word_length": f"""WITH {TOKENS}
        SELECT count(*) AS n_words,
               CAST(sum(length(word)) AS DOUBLE) / count(*) AS avg_word_length
        FROM (SELECT DISTINCT word FROM tokens) w""",
    # ---- graph ----------------------------------------------------------
    "edge_count": f"WITH {RAW} SELECT count(*) AS n_edges FROM raw_edges",
    "distinct_directed_edges": f"WITH {RAW} SELECT DISTINCT u, v FROM raw_edges",
    "canonical_edges": f"WITH {CANON} SELECT u, v FROM canon",
    "adjacency": f"""WITH {CANON},
        nb AS (SELECT u AS vertex, v AS nbr FROM canon
               UNION ALL SELECT v, u FROM canon)
        SELECT vertex, count(*) AS degree, min(nbr) AS min_neighbor,
               max(nbr) AS max_neighbor
        FROM nb GROUP BY vertex""",
    "graph_summary": f"""WITH {CANON}
        SELECT (SELECT count(*) FROM (SELECT u FROM canon UNION SELECT v FROM canon) x)
                 AS n_vertices,
               (SELECT count(*) FROM canon) AS n_edges,
               ({TRIANGLE_COUNT}) AS triangles""",
    "triangles_exact": f"WITH {CANON} SELECT ({TRIANGLE_COUNT}) AS triangles",
    "node_colors": f"""WITH {RAW}
        SELECT vertex, {color('vertex', A0, B0)} AS color
        FROM (SELECT u AS vertex FROM raw_edges UNION SELECT v FROM raw_edges) x""",
    "monochromatic_edges": f"WITH {MONO} SELECT u, v, color FROM mono",
    "triangles_per_color": f"""WITH {MONO_TRI}
        SELECT c.color, coalesce(tri.t, 0) AS triangles
        FROM (SELECT DISTINCT color FROM mono) c
        LEFT JOIN tri ON tri.color = c.color""",
    "triangles_approx_color": f"""WITH {MONO_TRI}
        SELECT CAST({C2} * coalesce(sum(t), 0) AS BIGINT) AS estimate FROM tri""",
    "triangles_approx_color_large_prime": f"""WITH {mono_sql(*P.LARGE_RUN, P.LARGE_P)}{SAME_COLOR}
        SELECT CAST({C2} * coalesce(sum(t), 0) AS BIGINT) AS estimate FROM tri""",
    "triangles_approx_color_runs": f"""WITH {runs_sql(listed(P.COLOR_RUNS))}
        SELECT run, estimate FROM runs""",
    "triangles_approx_color_table": f"""WITH {runs_sql(RUN_TABLE)}
        SELECT run, estimate FROM runs""",
    "triangles_approx_color_mean": f"""WITH {runs_sql(listed(P.COLOR_RUNS))}
        SELECT CAST(floor(avg(estimate)) AS BIGINT) AS estimate_mean FROM runs""",
    "triangles_approx_color_median": f"""WITH {runs_sql(listed(P.COLOR_RUNS))}
        SELECT CASE WHEN count(*) % 2 = 1 THEN list_sort(list(estimate))[count(*) // 2 + 1]
            ELSE CAST((CAST(list_sort(list(estimate))[count(*) // 2] AS HUGEINT)
                       + list_sort(list(estimate))[count(*) // 2 + 1]) // 2 AS BIGINT) END AS estimate_median
        FROM runs""",
    "triangles_approx_color_median_even": f"""WITH {runs_sql(listed(P.EVEN_RUNS))}
        SELECT CASE WHEN count(*) % 2 = 1 THEN list_sort(list(estimate))[count(*) // 2 + 1]
            ELSE CAST((CAST(list_sort(list(estimate))[count(*) // 2] AS HUGEINT)
                       + list_sort(list(estimate))[count(*) // 2 + 1]) // 2 AS BIGINT) END AS estimate_median
        FROM runs""",
    "edge_color_triples": f"""WITH {REP}
        SELECT k0, k1, k2, count(*) AS n_edges FROM rep GROUP BY k0, k1, k2""",
    "triangles_per_color_triple": f"""WITH {TRIPLE_TRI}
        SELECT k0, k1, k2, triangles FROM per_triple""",
    "triangles_exact_colored": f"""WITH {TRIPLE_TRI}
        SELECT CAST(coalesce(sum(triangles), 0) AS BIGINT) AS triangles
        FROM per_triple""",
    "triangles_per_edge_bucket": f"""WITH {BUCKET_TRI}
        SELECT bucket, triangles FROM per_bucket""",
    "triangles_approx_partition": f"""WITH {BUCKET_TRI}
        SELECT CAST({C2} * coalesce(sum(triangles), 0) AS BIGINT) AS estimate
        FROM per_bucket""",
    "triangles_approx_partition_directed": f"""WITH {DIRECTED_TRI}
        SELECT CAST({C2} * coalesce(sum(triangles), 0) AS BIGINT) AS estimate
        FROM per_bucket""",
    "triangles_approx_spark_partition": f"""WITH {SPARK_TRI}
        SELECT CAST({C2} * coalesce(sum(triangles), 0) AS BIGINT) AS estimate
        FROM per_bucket""",
    "edges_from_pair_lines": f"WITH {RAW} SELECT u, v FROM raw_edges",
    "edges_from_flat_lines": f"WITH {RAW} SELECT u, v FROM raw_edges",
    # ---- item stream ----------------------------------------------------
    "batch_item_counts": f"""WITH {ITEMS}
        SELECT batch, item, count(*) AS n FROM items GROUP BY batch, item""",
    "batch_sizes": f"""WITH {ITEMS}
        SELECT batch, count(*) AS n_items FROM items GROUP BY batch""",
    "interval_histogram": f"WITH {HIST} SELECT item, n FROM hist",
    "stream_length": f"WITH {ITEMS} SELECT count(*) AS n_items FROM items",
    "stream_interval_histogram": f"WITH {HIST} SELECT item, n FROM hist",
    "stream_distinct_items": f"WITH {HIST} SELECT count(*) AS n_distinct FROM hist",
    "distinct_items": f"WITH {HIST} SELECT count(*) AS n_distinct FROM hist",
    "stream_count_sketch": f"""WITH {HIST_SKETCH}
        SELECT row_idx, col_idx, value FROM cs""",
    "stream_prefix": f"""WITH {ITEMS},
        pb AS (SELECT batch, count(*) AS n FROM items GROUP BY batch),
        run AS (SELECT batch, n,
                       coalesce(sum(n) OVER (ORDER BY batch ROWS BETWEEN
                                UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
                FROM pb)
        SELECT count(*) AS n_batches, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_items
        FROM run WHERE before < {P.THRESHOLD}""",
    "sketch_hashes_narrow32": f"""WITH {ITEMS}, {SK},
        wide AS (SELECT DISTINCT (item - {WIDE_CENTRE}) * {WIDE_STEP} + batch AS item FROM items),
        narrow AS (SELECT item, ((item & 4294967295) + 2147483648) % 4294967296 - 2147483648 AS low FROM wide),
        d AS (SELECT item, (low % {p} + {p}) % {p} AS low FROM narrow)
        SELECT s.row_idx, d.item, {color('d.low', 's.ha', 's.hb', W)} AS col_idx,
               CASE WHEN 2 * ((s.ga * d.low + s.gb) % {p}) >= {p - 1}
                    THEN 1 ELSE -1 END AS sign
        FROM d CROSS JOIN sk s""",
    "stream_batch_sizes": f"""WITH steps AS (
            SELECT event_id * {P.STREAM_STEPS} // ((SELECT max(event_id) FROM events) + 1) AS step FROM events)
        SELECT row_number() OVER (ORDER BY step) - 1 AS batch_id, count(*) AS n_items FROM steps GROUP BY step""",
    "sketch_hashes": f"""WITH {ITEMS}, {SK}
        SELECT s.row_idx, d.item, {color('d.item', 's.ha', 's.hb', W)} AS col_idx,
               CASE WHEN 2 * ((s.ga * d.item + s.gb) % {p}) >= {p - 1}
                    THEN 1 ELSE -1 END AS sign
        FROM (SELECT DISTINCT item FROM items) d CROSS JOIN sk s""",
    "count_sketch": f"WITH {HIST_SKETCH} SELECT row_idx, col_idx, value FROM cs",
    "count_sketch_all": f"WITH {HIST_SKETCH_ALL} SELECT row_idx, col_idx, value FROM cs",
    "second_moment_true": f"""WITH {HIST}
        SELECT CAST(coalesce(sum(CAST(n AS HUGEINT) * n), 0) AS DOUBLE) AS f2,
               count(*) AS n_distinct,
               CAST(sum(CAST(n AS HUGEINT) * n) AS DOUBLE)
               / nullif(CAST(count(*) AS DOUBLE) * count(*), 0) AS f2_normalized
        FROM hist""",
    "second_moment_rows": f"""WITH {HIST_SKETCH}
        SELECT row_idx, CAST(sum(CAST(value AS HUGEINT) * value) AS DOUBLE) AS f2
        FROM cs GROUP BY row_idx""",
    "second_moment_approx": f"WITH {HIST_SKETCH} {F2_APPROX}",
    "second_moment_approx_all": f"WITH {HIST_SKETCH_ALL} {F2_APPROX}",
    "sketch_point_estimates": f"""WITH {HIST_SKETCH}, {point_estimates('hist')}
        SELECT item, n, estimate FROM est""",
    "count_sketch_large_prime": f"WITH {ALL_LARGE} SELECT row_idx, col_idx, value FROM cs",
    "sketch_point_estimates_large_prime": f"""WITH {ALL_LARGE}, {point_estimates('hist', P.LARGE_P)}
        SELECT item, n, estimate FROM est""",
    "topk_items": f"WITH {HIST}, {TOP} SELECT item, n, rank FROM top",
    "topk_avg_relative_error": f"""WITH {HIST_SKETCH}, {TOP}, {point_estimates('top')}
        SELECT count(*) AS k_items,
               round(avg(abs(n - estimate) / n), 9) AS avg_relative_error
        FROM est""",
    "largest_item": f"""WITH {HIST}
        SELECT CAST(greatest(coalesce(max(item), 0), 0) AS BIGINT) AS largest_item
        FROM hist""",
}

# Same results as an already-listed query (cross-equalities).
ORACLE_SQL["word_count_salted"] = ORACLE_SQL["word_count"]
ORACLE_SQL["word_count_salted_at_shuffle"] = ORACLE_SQL["word_count"]
ORACLE_SQL["word_count_by_partition"] = ORACLE_SQL["word_count"]
ORACLE_SQL["text_file_word_count"] = ORACLE_SQL["word_count"]
ORACLE_SQL["triangles_exact_hub_split"] = ORACLE_SQL["triangles_exact"]
ORACLE_SQL["triangles_exact_id_order"] = ORACLE_SQL["triangles_exact"]
ORACLE_SQL["stream_until_threshold"] = ORACLE_SQL["stream_prefix"]
ORACLE_SQL["stream_second_moment_true"] = ORACLE_SQL["second_moment_true"]
ORACLE_SQL["stream_second_moment_approx"] = ORACLE_SQL["second_moment_approx"]
