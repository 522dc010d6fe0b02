"""tallyspark: counting and sketching operators on Spark DataFrames.

Three domains, each a set of DataFrame -> DataFrame functions:

* ``operators.wordcount`` -- word counts over document collections
  (plain, salted, partition-wise), distinct words, mean word length.
* ``operators.graph`` -- exact and approximate triangle counting
  (wedge join, node colouring, colour triples, edge buckets).
* ``operators.sketch`` -- item-stream statistics (interval histogram,
  count-sketch, second moments, top-k); they run unchanged on batch and
  streaming DataFrames, and ``streaming`` drives them as Structured
  Streaming queries.
"""

from tallyspark.session import build_session, drop_scratch, scratch_path

__all__ = ["build_session", "drop_scratch", "scratch_path"]
