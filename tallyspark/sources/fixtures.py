"""Inputs of the three domains, derived from the provided tables.

* documents: ``documents(doc_id, text)``; in line form every line of a
  text is one document (the original jobs read text files line by line).
* edges: a graph whose size is linear in ``lineitem``.  Vertex ids live
  in one space, typed by ``id = 3*key + kind`` (part 0, supplier 1,
  order 2).  Every lineitem row contributes the three edges
  order-part, order-supplier and part-supplier, written in the opposite
  orientation on even line numbers, so the raw edge list holds duplicates
  and both orientations.  Every row is itself a triangle, and further
  triangles appear where orders share parts and suppliers.
  (No pairs are formed inside a group: a hot order or supplier only adds
  3 edges per row.)
* items: ``events.user_id`` as the stream item; ``event_id div 1000`` as
  the micro-batch it arrives in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.text import lines
from tallyspark.sources.tables import read_table

# Vertex kinds of the typed id space, and items per batch.
KIND_PART, KIND_SUPPLIER, KIND_ORDER = 0, 1, 2
NUM_KINDS = 3
EVENTS_PER_BATCH = 1000
# Wide ids: (item - centre) * step + batch.
WIDE_CENTRE, WIDE_STEP = 50, 3_000_000_019


def vertex_id(key: Column, kind: int) -> Column:
    return key * NUM_KINDS + kind


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``: one row per document; a NULL text is empty."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def document_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, text)``: every line of every text is a document.

    ``line_no`` is 0-based; empty lines are kept (each is one empty word).
    """
    exploded = docs.select("doc_id", F.posexplode(lines("text")).alias("pos", "text"))
    return exploded.select("doc_id", F.col("pos").cast("bigint").alias("line_no"), "text")


def lineitem_edges(lineitem: DataFrame) -> DataFrame:
    """Raw edges ``(u, v)`` of the order-part-supplier graph (see module doc)."""
    return lineitem.select(F.inline(lineitem_edge_array()))


def lineitem_edge_array() -> Column:
    """The three edges of a lineitem row as ``array<struct<u, v>>``."""
    o = vertex_id(F.col("l_orderkey"), KIND_ORDER)
    p = vertex_id(F.col("l_partkey"), KIND_PART)
    s = vertex_id(F.col("l_suppkey"), KIND_SUPPLIER)
    flip = (F.col("l_linenumber") % 2) == 0

    def edge(x: Column, y: Column) -> Column:
        return F.struct(F.when(flip, y).otherwise(x).alias("u"),
                        F.when(flip, x).otherwise(y).alias("v"))

    return F.array(edge(o, p), edge(o, s), edge(p, s))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineitem columns the edge fixture needs."""
    return read_table(spark, sf_dir, "lineitem",
                      ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


def raw_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_edges(lineitem(spark, sf_dir))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item, batch)`` from ``events``."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id"])
    return events_to_items(ev)


def events_to_items(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("item"),
        F.expr(f"event_id div {EVENTS_PER_BATCH}").alias("batch"))


def wide_items(items: DataFrame) -> DataFrame:
    """``(item)``: ids of both signs beyond 32 bits, one per item and batch."""
    return items.select(((F.col("item") - WIDE_CENTRE) * WIDE_STEP + F.col("batch")).alias("item"))
