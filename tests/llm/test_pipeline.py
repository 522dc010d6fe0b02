"""The pipeline's stages and the registered queries."""

import collections
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from tallyspark.llm import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = docs.limit(3).selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars")
    docs = docs.union(docs.limit(5)).union(extra)
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, SF_SMALL), "test-stage")
        assert docs.columns == COLUMNS
        assert docs.where("n_chars <> length(text)").count() == 0
        now = docs.count()
        assert 0 < now <= before, name
        before = now
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert len(ids) == len(set(ids))  # repeated rows are near copies
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r.doc_id for r in packed.collect()} == set(ids)


def test_stages_take_no_rows(spark):
    none = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF_SMALL).count() == 0


def test_every_operator_is_registered():
    names = set(E.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


def test_queries_match_their_sql(spark):
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(E.__file__), "tools"))
    from oracle_check import compare, duck

    from tallyspark.llm.oracles import ORACLE_SQL
    con = duck(SF_SMALL)
    for name, sql in ORACLE_SQL.items():
        df = E.queries()[name](spark, SF_SMALL)
        problems, _, _ = compare(df.collect(), df.schema, con.sql(sql))
        assert not problems, (name, problems)


# -- stages against plain versions ------------------------------------------------

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def small(spark):
    """Documents of sf0.001, with copies, near copies and rows without an id."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*COLUMNS).collect()]
    long = [r for r in rows if len(r[1]) > 600][:20]
    extra = [(5000 + i, r[1] + " end", *r[2:]) for i, r in enumerate(long[:10])]
    extra += [(None, r[1], *r[2:]) for r in long[:4]] + [(None, "only here, " + " ".join(f"q{i}" for i in range(60)), "en", "s", 0)] * 2
    extra += [(long[5][0], "another text of this id " + " ".join(f"z{i}" for i in range(60)), "en", "s", 0)]
    return rows + extra


def plain_toxic(spark, rows):
    docs, labels = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = toxicity.fit(docs, labels)
    raw = [(t or "").encode() for _, t, *_ in rows]
    score = [float(model.scores(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0]) for r in raw]
    return [r for r, s in zip(rows, score) if s < model.training.threshold]


def plain_quality(rows):
    from tallyspark.llm.quality import RATES, RULES, count_text
    seen = []
    for r in rows:
        n, chars, symbols, dup, repeat, full = count_text(r[1])
        failed = n < RULES.min_words or 100 * repeat > RULES.max_repeat_percent * n
        rate = dict(zip(RATES, (1000 * chars // max(n, 1), 1000 * symbols // max(n, 1), 1000 * dup // max(full, 1),
                                1000 * repeat // max(n, 1))))
        seen.append((r, failed, rate))

    def limits(of, rate):
        values = sorted(v >> s << s for _, failed, x in of if not failed for v in [x[rate]]
                        for s in [max(v.bit_length() - 7, 0)])
        if not values:
            return 0, None, None
        q1, q3 = (next(v for i, v in enumerate(values, 1) if 4 * i >= k * len(values)) for k in (1, 3))
        spread = RULES.reach * max(q3 - q1, RULES.least[rate])
        return len(values), q1 - spread, q3 + spread

    kept = []
    for r, failed, rate in seen:
        fits = not failed
        for name in RATES if fits else ():
            own, lang, every = (limits([x for x in seen if same(x[0])], name) for same in (
                lambda o: (o[2], o[3]) == (r[2], r[3]), lambda o: o[2] == r[2], lambda o: True))
            n, low, high = ((own[0], max(own[1], lang[1]), min(own[2], lang[2])) if own[0] >= RULES.min_group
                            else lang if lang[0] >= RULES.min_group else every)
            fits = fits and rate[name] <= high and (name != "word_length" or rate[name] >= low)
        if fits:
            kept.append(r)
    return kept


def plain_line_dedup(rows):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return re.sub("[A-Z]", lambda m: m[0].lower(), line)

    holders = collections.defaultdict(list)
    for i, r in enumerate(rows):
        for k in {key(line) for line in (r[1] or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(i)
    keeper = {k: max((rows[i][0] for i in of if rows[i][0] is not None), default=None) for k, of in holders.items() if len(of) >= 3}
    out = []
    for r in rows:
        lines = [x for x in (r[1] or "").split("\n") if key(x) not in keeper or r[0] == keeper[key(x)] is not None]
        out.append((r[0], "\n".join(lines), *r[2:4]))
    return out


def plain_one_of_each(rows):
    sets = []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        sets.append({tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for i, r in enumerate(rows):
        if sets[i]:
            best[group[i]] = min(best.get(group[i], (True, 0)), (r[0] is None, r[0] or 0))
    kept = [r for i, r in enumerate(rows) if not sets[i] or best[group[i]] == (r[0] is None, r[0] or 0)]
    return {(r[0], r[1]) for r in kept}


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_equal_plain_versions(spark, small):
    stage = dict(corpus_pipeline.STAGES)

    def run(name, rows):
        return corpus_pipeline.store(stage[name](spark, spark.createDataFrame([(*r[:4], 0) for r in rows], SCHEMA), SF_SMALL), "test")

    def same(df, rows):
        assert texts(df) == sorted(((r[0], r[1]) for r in rows), key=str)
        return [tuple(r) for r in df.collect()]

    rows = same(run("toxicity", small), plain_toxic(spark, small))
    assert len(rows) < len(small)
    rows = same(run("quality rules", rows), plain_quality(rows))
    rows = same(run("line dedup", rows), plain_line_dedup(rows))
    rows = [r for r in rows if len(r[1] or "") < 20_000]
    got = run("near duplicates", rows)
    want = plain_one_of_each(rows)
    # several texts of one id in one group: the one with the least hashes stays
    assert {(r.doc_id, r.text) for r in got.collect()} <= want
    assert {r.doc_id for r in got.collect()} == {i for i, _ in want}
    assert got.count() == len(want) < len(rows)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = collections.Counter()
    for r in got.collect():
        tokens[r.doc_id] += len(library.encode(r.text or "", add_special_tokens=False).ids) + 1
    packed = stage["packing"](spark, got, SF_SMALL).collect()
    found, bins = collections.Counter(), collections.defaultdict(list)
    for p in packed:
        found[p.doc_id] += p.length
        bins[p.sequence_id].append((p.offset, p.length))
    assert found == tokens
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048


def test_rows_without_an_id_go_where_one_with_an_id_is_near(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(None, text), (None, text + " x"), (4, text), (None, "other " + " ".join(f"v{i}" for i in range(70))),
            (6, "two texts " + text[::-1]), (6, text + " y")]
    docs = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], SCHEMA)
    got = corpus_pipeline.one_of_each(spark, docs, SF_SMALL)
    assert {(r.doc_id, r.text) for r in got.collect()} == {rows[2], rows[3], rows[4]}
