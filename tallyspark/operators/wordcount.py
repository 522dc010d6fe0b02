"""Word counting over document collections.

Input: a DataFrame with one row per document, identifying columns
(``id_cols``, default ``doc_id, line_no`` -- the line form where every
line is a document) and a ``text`` column.  Words are the tokens of
``split(text, ' ')``: empty tokens count as words.

All variants produce the same ``(word, n)``; they differ in how the
aggregation is staged, which matters for a hot word (one word may hold a
third of all tokens):

* :func:`word_count` -- one shuffle; Spark's partial (map-side)
  HashAggregate already reduces a hot word to one row per map task.
* :func:`word_count_salted` -- two rounds keyed ``(salt, word)`` then
  ``word``; salt is a hash of ``(document, word)``, so it is replay-stable.
* :func:`word_count_salted_at_shuffle` -- two rounds with a salt per
  token *occurrence* (a hash of document, position and seed): spread like
  a random draw, but a re-run task assigns exactly the same salts whatever
  order its input rows arrive in, so a lost executor cannot make a token
  count under two salts.
* :func:`word_count_by_partition` -- combine inside each input partition, then
  across partitions.  Spark's partial aggregate is that combination, so it is
  the plan of :func:`word_count` under the original's name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.text import words

LINE_ID = ("doc_id", "line_no")
#: parts that :func:`doc_term_counts` deals each part of its input into
PARTS_PER_SPLIT = 16


def document_count(docs: DataFrame) -> DataFrame:
    """``(n_documents)``."""
    return docs.agg(F.count(F.lit(1)).alias("n_documents"))


def doc_tokens(docs: DataFrame, id_cols: Sequence[str] = LINE_ID) -> DataFrame:
    """Number of tokens per document: ``(id_cols..., n_tokens)``."""
    return docs.select(*id_cols, F.size(words("text")).cast("bigint").alias("n_tokens"))


def tokens(docs: DataFrame, id_cols: Sequence[str] = LINE_ID) -> DataFrame:
    """One row per token occurrence: ``(id_cols..., word)``."""
    return docs.select(*id_cols, F.explode(words("text")).alias("word"))


def doc_term_counts(docs: DataFrame, id_cols: Sequence[str] = LINE_ID) -> DataFrame:
    """Term frequency inside each document: ``(id_cols..., word, n)``.

    The documents are dealt by id before they are split: a text crosses the
    shuffle once, not as one row, with the id, for each of its words.  The
    parts grow in number with the input, so that one's counts fit in memory."""
    parts = PARTS_PER_SPLIT * docs.rdd.getNumPartitions()
    dealt = docs.select(*id_cols, "text").repartition(parts, *id_cols)
    return (tokens(dealt, id_cols).groupBy(*id_cols, "word")
            .agg(F.count(F.lit(1)).alias("n")))


def word_count(docs: DataFrame, id_cols: Sequence[str] = LINE_ID) -> DataFrame:
    """Occurrences of every distinct word: ``(word, n)``."""
    return tokens(docs, id_cols).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _two_round(salted: DataFrame) -> DataFrame:
    first = salted.groupBy("salt", "word").agg(F.count(F.lit(1)).alias("n"))
    return first.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def word_count_salted(docs: DataFrame, num_salts: int, seed: int = 0,
                      id_cols: Sequence[str] = LINE_ID) -> DataFrame:
    """Two-round count; the salt of a token is a hash of (document, word),
    i.e. one salt per per-document pair: ``(word, n)``."""
    t = tokens(docs, id_cols)
    salt = F.pmod(F.xxhash64(*id_cols, "word", F.lit(seed)), F.lit(num_salts))
    return _two_round(t.select(salt.alias("salt"), "word"))


def word_count_salted_at_shuffle(docs: DataFrame, num_salts: int, seed: int = 0,
                                 id_cols: Sequence[str] = LINE_ID) -> DataFrame:
    """Two-round count with a pseudo-random salt per token occurrence:
    ``(word, n)``."""
    t = docs.select(*id_cols, F.posexplode(words("text")).alias("pos", "word"))
    salt = F.pmod(F.xxhash64(*id_cols, "pos", F.lit(seed)), F.lit(num_salts))
    return _two_round(t.select(salt.alias("salt"), "word"))


def word_count_by_partition(docs: DataFrame,
                            id_cols: Sequence[str] = LINE_ID) -> DataFrame:
    """Combine per input partition, then sum across partitions: ``(word, n)``.
    Spark's partial aggregate is that combination, in place before the one
    shuffle."""
    return tokens(docs, id_cols).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def distinct_words(docs: DataFrame, id_cols: Sequence[str] = LINE_ID) -> DataFrame:
    """``(n_words)``: number of distinct words."""
    return word_count(docs, id_cols).agg(F.count(F.lit(1)).alias("n_words"))


def average_word_length(docs: DataFrame, id_cols: Sequence[str] = LINE_ID) -> DataFrame:
    """Mean length (in characters) of the *distinct* words, unweighted:
    ``(n_words, avg_word_length)``."""
    wc = word_count(docs, id_cols)
    return wc.agg(
        F.count(F.lit(1)).alias("n_words"),
        (F.sum(F.length("word").cast("bigint")).cast("double")
         / F.count(F.lit(1))).alias("avg_word_length"))
