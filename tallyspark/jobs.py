"""Command-line jobs over text inputs, printing a report of scalars as JSON.

    python -m tallyspark wordcount  K  <docs>            # one document per line
    python -m tallyspark triangles  C R <edges>          # u,v lines; colouring + partitions
    python -m tallyspark triangles2 C R F <edges>        # u1,v1,u2,v2,... lines; F=0 approx, 1 exact
    python -m tallyspark stream     D W left right K <items-dir | socket://host:port>

Every number is computed by the library operators; only one-row results
are brought to the driver for printing.  Hash parameters are drawn from
``--seed`` (default: fresh randomness) below the prime ``--prime``; ids or
items that are equal modulo the prime cannot be told apart by the hashes.
"""

from __future__ import annotations

import argparse
import json
import random
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.hashing import LARGE_PRIME
from tallyspark.operators import graph as G
from tallyspark.operators import sketch as S
from tallyspark.operators import wordcount as W
from tallyspark.sources import files as FS
from tallyspark.streaming import runner as R

# Fixed value: items after which the stream job stops.
STREAM_THRESHOLD = 10_000_000


def _scalar(df: DataFrame):
    return df.collect()[0][0]


def _hash_params(rnd: random.Random, p: int) -> tuple[int, int]:
    return rnd.randint(1, p - 1), rnd.randint(0, p - 1)


def wordcount(spark: SparkSession, k: int, path: str, seed: int) -> dict:
    docs = FS.read_text_documents(spark, path)
    ids = ["doc_id"]
    variants = {"plain": W.word_count(docs, ids),
                "salted": W.word_count_salted(docs, k, seed, ids),
                "salted_at_shuffle": W.word_count_salted_at_shuffle(docs, k, seed, ids),
                "by_partition": W.word_count_by_partition(docs, ids)}
    return {"documents": _scalar(W.document_count(docs)),
            "distinct_words": {name: _scalar(wc.agg(F.count(F.lit(1)))) for name, wc in variants.items()},
            "average_word_length": W.average_word_length(docs, ids).collect()[0].avg_word_length}


def triangles(spark: SparkSession, c: int, r: int, path: str, seed: int, p: int = LARGE_PRIME) -> dict:
    edges = FS.read_pair_lines(spark, path)
    rnd = random.Random(seed)
    runs = [_hash_params(rnd, p) for _ in range(r)]
    oriented = G.oriented_edges(edges)  # built once, used by both estimators
    colored = G.triangles_approx_color_runs(oriented, runs, c, p)
    return {"path": path, "edges": _scalar(G.edge_count(edges)), "colors": c, "runs": r,
            "estimate_by_colors": _scalar(G.mean_estimate(colored)),
            "estimate_by_partitions": _scalar(G.triangles_approx_spark_partition(oriented, c))}


def triangles2(spark: SparkSession, c: int, r: int, f: int, path: str,
               seed: int, p: int = LARGE_PRIME) -> dict:
    if c <= 0 or r <= 0 or f not in (0, 1):
        raise ValueError("C and R must be positive, F must be 0 or 1")
    edges = FS.read_flat_lines(spark, path)
    rnd = random.Random(seed)
    runs = [_hash_params(rnd, p) for _ in range(r)]
    out = {"path": path, "edges": _scalar(G.edge_count(edges)), "colors": c, "runs": r}
    oriented = G.oriented_edges(edges)
    if f == 0:
        colored = G.triangles_approx_color_runs(oriented, runs, c, p)
        return {**out, "estimate_median": _scalar(G.median_estimate(colored))}
    a, b = runs[-1]
    return {**out, "triangles": _scalar(G.triangles_exact_colored(oriented, a, b, c, p))}


def stream(spark: SparkSession, d: int, w: int, left: int, right: int, k: int,
           path: str, seed: int, threshold: int = STREAM_THRESHOLD,
           max_files_per_trigger: int | None = None, p: int = LARGE_PRIME,
           narrow32: bool = False,
           on_size: Callable[[int, int], None] | None = None) -> dict:
    """Stream statistics over one integer per line.

    ``narrow32`` hashes the low 32 bits of an item, as the original does;
    ``on_size(batch_id, n)`` is told each batch's size while the query runs.

    ``path`` is a directory of text files, or ``socket://host:port`` for a
    text socket read in 100 ms micro-batches (not replayable: a restart
    loses what the socket already sent).
    """
    rnd = random.Random(seed)
    rows = [(*_hash_params(rnd, p), *_hash_params(rnd, p)) for _ in range(d)]
    trigger = None
    if path.startswith("socket://"):
        host, port = path[len("socket://"):].rsplit(":", 1)
        reader = (spark.readStream.format("socket").option("host", host)
                  .option("port", int(port)))
        source = reader.load()
        trigger = "100 milliseconds"
    else:
        reader = spark.readStream.schema("value string")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        source = reader.text(path)
    items = source.select(FS.parse_id(F.col("value")).alias("item"))
    taken = R.run_until_threshold(items, threshold, "stream-job", processing_time=trigger, on_size=on_size)
    per_item = taken.groupBy("item").agg(F.sum("n").cast("bigint").alias("n"))
    n_items = _scalar(per_item.agg(F.coalesce(F.sum("n"), F.lit(0))))
    hist = S.in_interval(per_item, left, right)
    # like the original, the sketch covers all taken items, the truth and
    # the normaliser only the interval
    sketch = S.count_sketch_from_counts(per_item, rows, w, p, narrow32)
    true_f2 = S.second_moment_true(hist).collect()[0]
    approx = S.second_moment_approx(sketch, hist).collect()[0]
    err = S.topk_avg_relative_error(hist, sketch, rows, w, k, p, narrow32).collect()[0]
    return {"rows": d, "width": w, "left": left, "right": right, "k": k, "items": n_items,
            "second_moment": true_f2.f2_normalized,
            "second_moment_estimate": approx.f2_normalized,
            "top_k_relative_error": err.avg_relative_error,
            "largest_item": _scalar(S.largest_item(hist))}


def _print_size(batch_id: int, n: int) -> None:
    print(f"batch {batch_id}: {n} items", file=sys.stderr, flush=True)


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tallyspark", description=__doc__.split("\n\n")[0])
    ap.add_argument("--seed", type=int, default=None,
                    help="seed of the hash parameters (default: random)")
    ap.add_argument("--prime", type=int, default=LARGE_PRIME,
                    help="prime of the hashes, below 2**31 (default: %(default)s)")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("wordcount", help="distinct words four ways, mean word length")
    p.add_argument("K", type=int, help="number of salts")
    p.add_argument("path", help="text files, one document per line")
    p = sub.add_parser("triangles", help="colouring (mean of R runs) and partition estimates")
    p.add_argument("C", type=int, help="number of colours / parts")
    p.add_argument("R", type=int, help="number of colouring runs")
    p.add_argument("path", help="text files of u,v lines")
    p = sub.add_parser("triangles2", help="colouring median (F=0) or exact count (F=1)")
    p.add_argument("C", type=int, help="number of colours")
    p.add_argument("R", type=int, help="number of runs")
    p.add_argument("F", type=int, help="0 = approximate, 1 = exact")
    p.add_argument("path", help="text files of u1,v1,u2,v2,... lines")
    p = sub.add_parser("stream", help="interval histogram, count-sketch, second moments")
    for name, what in (("D", "sketch rows"), ("W", "sketch columns"),
                       ("left", "interval start (excluded)"),
                       ("right", "interval end (excluded)"), ("K", "top-k size")):
        p.add_argument(name, type=int, help=what)
    p.add_argument("path", help="folder of text files (one integer per line) "
                                "or socket://host:port")
    p.add_argument("--threshold", type=int, default=STREAM_THRESHOLD,
                   help="stop after whole batches reach this many items")
    p.add_argument("--narrow32", action="store_true",
                   help="hash the low 32 bits of each item")
    p.add_argument("--quiet", action="store_true",
                   help="do not print each batch's size to the error stream")
    args = ap.parse_args(argv)
    seed = args.seed if args.seed is not None else random.SystemRandom().randrange(2**31)
    from tallyspark.session import build_session, ensure_checkpoint_dir
    spark = build_session()
    ensure_checkpoint_dir(spark)  # local runs only; a cluster must configure one
    if args.job == "wordcount":
        report = wordcount(spark, args.K, args.path, seed)
    elif args.job == "triangles":
        report = triangles(spark, args.C, args.R, args.path, seed, args.prime)
    elif args.job == "triangles2":
        report = triangles2(spark, args.C, args.R, args.F, args.path, seed, args.prime)
    else:
        report = stream(spark, args.D, args.W, args.left, args.right, args.K, args.path,
                        seed, args.threshold, p=args.prime, narrow32=args.narrow32,
                        on_size=None if args.quiet else _print_size)
    print(json.dumps(report))


__all__ = ["main", "stream", "triangles", "triangles2", "wordcount"]
