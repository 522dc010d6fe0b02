"""Text-file sources of the original jobs.

* :func:`read_text_documents` -- every line of the files is a document.
* :func:`read_pair_lines` -- one edge ``u,v`` per line.
* :func:`read_flat_lines` -- any even number of comma-separated ids per
  line, consumed two at a time (``u1,v1,u2,v2,...``).

Bad input fails the job, as the originals'
integer parsing does; nothing is silently turned into NULL or dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, text)``: one document per line of the text files.

    ``doc_id`` is ``monotonically_increasing_id()`` -- stable for a given
    file listing and split size, not dense.
    """
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("doc_id"), F.col("value").alias("text"))


def read_pair_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(u, v)`` from ``u,v`` lines; a malformed line, one with another
    number of fields and a blank one included, raises whatever the ANSI mode."""
    fields = spark.read.text(path).select("value", F.split("value", ",", -1).alias("f"))
    checked = fields.select(F.when(F.size("f") == 2, F.col("f")).otherwise(F.raise_error(F.concat(
        F.lit("malformed edge line: '"), F.col("value"), F.lit("'"))).cast("array<string>")).alias("f"))
    return checked.select(parse_id(F.col("f")[0]).alias("u"), parse_id(F.col("f")[1]).alias("v"))


def flat_line_tokens(line: Column) -> Column:
    """The ids of a flat line; trailing empty fields are dropped first (as
    Java's ``String.split`` does)."""
    return F.split(F.rtrim(line, F.lit(",")), ",", -1)


def flat_line_edges(tokens: Column, line: Column) -> Column:
    """Array of ``struct(u, v)`` from a line's id tokens, two at a time; an
    odd number of ids -- a blank line included -- raises.

    ``tokens`` must be a column reference (computed once per row in a
    projection below), not an expression: the lambda reads it per element.
    """
    n = F.size(tokens)
    last = F.when(n % 2 == 1, F.raise_error(F.concat(
        F.lit("odd number of vertex ids in edge line: '"), line, F.lit("'")))
    ).otherwise(n - 2)
    return F.transform(
        F.sequence(F.lit(0), last, F.lit(2)),
        lambda i: F.struct(parse_id(tokens[i]).alias("u"),
                           parse_id(tokens[i + 1]).alias("v")))


def parse_id(token: Column) -> Column:
    """bigint of a token; raises on a malformed one whatever the ANSI mode
    (a non-ANSI cast would yield NULL).  Tokens are never NULL, so NULL
    here means unparsable."""
    return F.coalesce(F.trim(token).try_cast("bigint"), F.raise_error(F.concat(
        F.lit("malformed number: '"), token, F.lit("'"))).cast("bigint"))


def read_flat_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(u, v)`` from lines holding ``u1,v1,u2,v2,...``."""
    lines = spark.read.text(path)
    toks = lines.select("value", flat_line_tokens(F.col("value")).alias("toks"))
    return toks.select(F.inline(flat_line_edges(F.col("toks"), F.col("value"))))


def write_pair_lines(edges: DataFrame, path: str) -> None:
    """Write ``(u, v)`` as ``u,v`` text lines."""
    edges.select(F.concat_ws(",", F.col("u").cast("string"), F.col("v").cast("string"))
                 .alias("value")).write.mode("overwrite").text(path)


def write_flat_lines(edge_arrays: DataFrame, path: str) -> None:
    """Write one line ``u1,v1,u2,v2,...`` per row of an ``edges`` array
    column (``array<struct<u, v>>``)."""
    flat = F.flatten(F.transform(
        F.col("edges"), lambda e: F.array(e["u"].cast("string"), e["v"].cast("string"))))
    edge_arrays.select(F.concat_ws(",", flat).alias("value")) \
        .write.mode("overwrite").text(path)
