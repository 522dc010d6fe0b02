"""Quality rules whose cutoffs come from the corpus.

Each text is counted once.  Four rates of it, as whole numbers per thousand,
go into quantile sketches per (lang, source, rate).  A sketch is a histogram
over buckets of about one per cent width, kept as rows ``bucket, n``: merging is
adding, so Spark builds it with map-side partial sums, a hot source is no hot
task, and the result does not depend on the order.  A group with few documents
uses the merged sketch of its language, then that of all documents, and no group
may reach beyond its language: one that is mostly junk cannot widen its own
limits.  A rate is out of line beyond ``q75 + reach * spread`` (word length also below
``q25 - reach * spread``), the spread being q75 - q25 or a stated least width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_full_lines")
RATES = ("word_length", "symbols", "dup_lines", "repeats")
_SYMBOLS = "#*$%&|<>"
#: groups whose thresholds (some 200 bytes each) may be broadcast
BROADCAST_GROUPS = 50_000


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: least documents of a group with thresholds of its own
    min_group: int = 200
    #: spreads above the third (below the first) quartile still in line
    reach: int = 4
    #: least spread of each rate, per thousand
    least: dict[str, int] = field(default_factory=lambda: {
        "word_length": 300, "symbols": 15, "dup_lines": 125, "repeats": 75})


RULES = QualityRules()


def count_text(text: str | None) -> tuple[int, ...]:
    """:data:`COUNTS` of one text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8")
    words = raw.split()  # bytes split at [\x20\x09-\x0D]
    n = len(words)
    white = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        seen: dict[tuple[bytes, ...], int] = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        covered = -1  # last word counted so far
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeats += i + 2 - max(covered, i - 1)
                covered = i + 2
    return (n, len(text) - white, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeats, len(lines))


def with_counts(docs: DataFrame) -> DataFrame:
    """The rows with a struct column ``row`` and the columns :data:`COUNTS`."""
    names = docs.columns
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = list(zip(*[count_text(t) for t in part.column(text_at).to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(f, pa.int64()) for f in found]],
                    [f"c{i}" for i in range(len(names))] + list(COUNTS))

    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    schema = plain.schema.simpleString()[len("struct<"):-1]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields) if schema else ""
    out = plain.mapInArrow(run, fields + "".join(f", {c} bigint" for c in COUNTS))
    return out.select(F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]).alias("row"), *COUNTS)


def base_failed(rules: QualityRules = RULES) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))


def rates() -> list[Column]:
    def per_mille(a: str, b: str) -> Column:
        return F.expr(f"case when {b} = 0 then 0 else 1000 * {a} div {b} end")
    return [per_mille("word_chars", "n_words").alias("word_length"), per_mille("n_symbols", "n_words").alias("symbols"),
            per_mille("n_dup_lines", "n_full_lines").alias("dup_lines"),
            per_mille("n_repeat_words", "n_words").alias("repeats")]


def bucket(value: str) -> Column:
    """The lower bound of the value's bucket: its seven leading bits."""
    shift = f"greatest(length(bin({value})) - 7, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, rate, bucket, n`` from rows with :data:`RATES`."""
    long = measured.select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rate"), bucket(r).alias("bucket")) for r in RATES])).alias("s"))
    return long.groupBy("lang", "source", "s.rate", "s.bucket").agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """``lang, source`` and for every rate ``<rate>_low, <rate>_high``: of the
    group itself, of its language or of all, by ``min_group``; a group's own
    lie within its language's."""
    def merged(keys: list[str]) -> DataFrame:
        rows = sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*keys, "rate")
        upto = F.sum("n").over(group.orderBy("bucket"))
        total = F.sum("n").over(group)
        ranked = rows.select(*keys, "rate", "bucket", upto.alias("upto"), total.alias("total"))
        quarter = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bucket")))
        quartiles = ranked.groupBy(*keys, "rate").agg(
            F.max("total").alias("total"), quarter(1).alias("q1"), quarter(3).alias("q3"))
        least = F.create_map(*[F.lit(x) for r in RATES for x in (r, rules.least[r])])
        spread = F.greatest(F.col("q3") - F.col("q1"), least[F.col("rate")])
        return quartiles.groupBy(*keys).agg(
            F.max("total").alias("total"),
            *[F.max(F.when(F.col("rate") == r, F.col("q1") - rules.reach * spread)).alias(f"{r}_low") for r in RATES],
            *[F.max(F.when(F.col("rate") == r, F.col("q3") + rules.reach * spread)).alias(f"{r}_high") for r in RATES])

    names = [f"{r}_{side}" for r in RATES for side in ("low", "high")]
    own = merged(["lang", "source"])
    by_lang = merged(["lang"]).select(F.col("lang").alias("l"), F.col("total").alias("l_total"),
                                      *[F.col(c).alias(f"l_{c}") for c in names])
    overall = merged([]).first()  # one row
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l")))
    inside = lambda c: (F.least if c.endswith("_high") else F.greatest)(F.col(c), F.col(f"l_{c}"))
    pick = lambda c: (F.when(F.col("total") >= rules.min_group, inside(c))
                      .when(F.col("l_total") >= rules.min_group, F.col(f"l_{c}"))
                      .otherwise(F.lit(overall[c] if overall else None).cast("bigint")))
    return joined.select("lang", "source", *[pick(c).alias(c) for c in names])


def judge_quality(docs: DataFrame, rules: QualityRules = RULES, keep_text: bool = True) -> DataFrame:
    """Every row as struct ``row``, with :data:`COUNTS`, ``base_failed`` and
    ``kept``; ``keep_text=False`` leaves the text out of ``row``.

    Thresholds come from all rows that pass the base rules.  A null or empty
    text has no words and fails the base; null ``lang`` or ``source`` form
    groups of their own; repeated rows count each; extra columns stay in
    ``row``; no rows give none.
    """
    if not {"lang", "source", "text"} <= set(docs.columns):
        raise ValueError("documents need text, lang and source")
    kept = [c for c in docs.columns if keep_text or c != "text"]
    counted = store(with_counts(docs).select(
        F.struct(*[F.col(f"row.`{c}`") for c in kept]).alias("row"), *COUNTS), "quality-counts")
    judged = counted.withColumn("base_failed", base_failed(rules))
    measured = judged.where(~F.col("base_failed")).select(
        F.col("row.lang").cast("string").alias("lang"), F.col("row.source").cast("string").alias("source"), *rates())
    sketch = store(sketches(measured), "quality-sketches")
    limits = store(thresholds(sketch, rules), "quality-limits")
    few = limits.count() <= BROADCAST_GROUPS
    limits = limits.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"),
                           *[c for c in limits.columns if c not in ("lang", "source")])
    # one row a group: sent to all if they are few, else joined by shuffle
    joined = judged.select("*", *rates()).join(
        F.broadcast(limits) if few else limits, F.col("row.lang").cast("string").eqNullSafe(F.col("t_lang"))
        & F.col("row.source").cast("string").eqNullSafe(F.col("t_source")), "left")
    fits = F.col("word_length") >= F.col("word_length_low")
    for r in RATES:
        fits = fits & (F.col(r) <= F.col(f"{r}_high"))
    return joined.select("row", *COUNTS, "base_failed",
                         F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(fits, F.lit(True))).alias("kept"))
