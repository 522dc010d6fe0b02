"""Word-count operators against Python's ``str.split(' ')``."""

from collections import Counter

import pytest

from tallyspark.operators import wordcount as W
from tallyspark.sources import fixtures as X

TEXTS = [
    "the cat  sat on the mat ",   # double space, trailing space
    "",                           # empty document: one empty word
    "The the THE the.",           # case and punctuation kept
    " leading\nsecond line the\n\nfinal",  # lines, an empty line
    "héllo wörld 你好 héllo",       # non-ASCII
]


@pytest.fixture
def docs(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    return X.document_lines(df)


def python_lines():
    return [(d, i, line) for d, t in enumerate(TEXTS) for i, line in enumerate(t.split("\n"))]


def python_counts():
    c = Counter()
    for _, _, line in python_lines():
        c.update(line.split(" "))
    return c


def as_dict(df):
    return {r.word: r.n for r in df.collect()}


def test_lines(docs):
    got = sorted((r.doc_id, r.line_no, r.text) for r in docs.collect())
    assert got == sorted(python_lines())


def test_word_count_variants_agree(docs):
    want = dict(python_counts())
    assert as_dict(W.word_count(docs)) == want
    assert as_dict(W.word_count_salted(docs, 4, seed=1)) == want
    assert as_dict(W.word_count_salted_at_shuffle(docs, 4, seed=1)) == want
    assert as_dict(W.word_count_by_partition(docs)) == want
    assert as_dict(W.word_count_salted(docs, 1)) == want


def test_empty_word_counted(docs):
    c = as_dict(W.word_count(docs))
    assert c[""] == python_counts()[""] > 0


def test_doc_term_counts_and_tokens(docs):
    got = {(r.doc_id, r.line_no, r.word): r.n for r in W.doc_term_counts(docs).collect()}
    want = {}
    for d, i, line in python_lines():
        for w, n in Counter(line.split(" ")).items():
            want[(d, i, w)] = n
    assert got == want
    tok = {(r.doc_id, r.line_no): r.n_tokens for r in W.doc_tokens(docs).collect()}
    assert tok == {(d, i): len(line.split(" ")) for d, i, line in python_lines()}


def test_distinct_and_average_length(docs):
    words = list(python_counts())
    assert W.distinct_words(docs).collect()[0].n_words == len(words)
    r = W.average_word_length(docs).collect()[0]
    assert r.n_words == len(words)
    assert r.avg_word_length == sum(len(w) for w in words) / len(words)
    assert W.document_count(docs).collect()[0].n_documents == len(python_lines())


def test_row_form(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    want = Counter()
    for t in TEXTS:
        want.update(t.split(" "))
    assert as_dict(W.word_count(df, id_cols=["doc_id"])) == dict(want)
