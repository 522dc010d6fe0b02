"""Quality classifier, periodic runs and conversation trie against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import nbsvm, queries, runs, trie
from tallyspark.llm.common import table

SF = "/root/testdata/sf0.01"
EXTRA = ", lang string, source string, key string, features string, id string, y string, path string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- quality classifier -------------------------------------------------------

def plain_form(word, before):
    if word.lower() == before.lower():
        return "="
    kinds = "".join("a" if b >= 128 or 97 <= b < 123 else "A" if 65 <= b < 91 else "0" if 48 <= b < 58 else chr(b)
                    for b in word.encode())
    return re.sub(r"([aA0])\1+", r"\1", kinds)


def plain_features(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    forms = [plain_form(w, b) for w, b in zip(words, ["", *words])]
    found = {("word", re.sub("[A-Z]", lambda m: m[0].lower(), w)) for w in words}
    for n in (1, 2, 3):
        found |= {tuple(forms[i: i + n]) for i in range(len(forms) - n + 1)}
    return found


def as_rows(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_features_match_plain_n_grams():
    rng = random.Random(5)
    pool = ["The", "the", "to", "TO!!", "x###", "12", "A1b22", "é", "Ébc", "|", "a.b", "..."]
    texts = ["", " \n\t", "one", *[" ".join(rng.choices(pool, k=rng.randrange(1, 40))) for _ in range(200)]]
    row, feature = nbsvm.features(*as_rows(texts))
    hashes = [set(feature[row == i].tolist()) for i in range(len(texts))]
    plain = [plain_features(text) for text in texts]
    for i in range(len(texts)):
        assert len(hashes[i]) == len(plain[i])
        for j in range(i):  # a feature has one hash in every text
            assert len(hashes[i] & hashes[j]) == len(plain[i] & plain[j])


def test_long_text_has_the_features_of_its_whole():
    rng = random.Random(6)
    text = " ".join(rng.choice(["aa", "Bb", "aa", "c1", "!!", "w" * 30]) for _ in range(3000)) + " " + "y" * 900 + " end"
    data, offsets = as_rows(["head " + text])
    whole = nbsvm.features(data, offsets)[1]
    for piece in (40, 97, 1000):
        parts = nbsvm.features(data, offsets, nbsvm.Training(piece=piece))[1]
        assert set(parts.tolist()) == set(whole.tolist())


def test_ratios_are_those_of_plain_counts(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    training = nbsvm.Training(max_training_rows=150, passes=20)
    model = nbsvm.fit(docs, labels, training)
    marked = labels.where(~nbsvm.held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("y"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(150).join(docs, "doc_id").collect()
    good, bad, sizes = collections.Counter(), collections.Counter(), collections.Counter()
    for r in sample:
        found = set(nbsvm.features(*as_rows([r.text]))[1].tolist())
        (good if r.y else bad).update(found)
        sizes[r.y] += 1
    want = {}
    for f in good.keys() | bad.keys():
        p, q = good[f], bad[f]
        ratio = math.log((p + 1) / (sizes[1] + 2)) - math.log((q + 1) / (sizes[0] + 2))
        if p + q >= training.min_texts and ratio:
            want[f] = ratio
    assert len(want) <= training.max_features
    assert dict(zip(model.features.tolist(), model.ratios.tolist())) == pytest.approx(want)


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    x = [(np.sort(rng.choice(12, 4, replace=False)), rng.normal(size=4)) for _ in range(60)]
    y = np.where(rng.random(60) < 0.4, -1.0, 1.0)
    training = nbsvm.Training(passes=5000, tolerance=1e-10)
    w = nbsvm.descend(y, x, 12, training)
    dense = np.zeros((60, 13))
    for i, (at, value) in enumerate(x):
        dense[i, at] = value
    dense[:, 12] = 1

    def loss(v):
        return v @ v / 2 + np.maximum(0, 1 - y * (dense @ v)).sum()

    # the dual's value by projected gradient steps from elsewhere
    gram = (y[:, None] * dense) @ (y[:, None] * dense).T
    dual = np.full(60, 0.5)
    for _ in range(40_000):
        dual = np.clip(dual - (gram @ dual - 1) / np.linalg.norm(gram, 2), 0, 1)
    assert loss(w) == pytest.approx(dual.sum() - dual @ gram @ dual / 2, rel=1e-5)


def test_held_out_accuracy_and_length(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = nbsvm.fit(docs, labels)
    got = {r.doc_id: r for r in nbsvm.classify(docs, model).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [d for d in truth if d in got and got[d].held_out]
    assert all((zlib.crc32(str(d).encode()) % 3 == 1) == got[d].held_out for d in got)
    assert len(held) > 60
    assert sum(got[d].predicted == truth[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    # good texts, joined to long ones, stay good
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = [texts[d] for d in held if truth[d]]
    scores = model.scores(*as_rows(["\n".join(clean), "\n".join(clean * 8)]))
    assert (scores >= 0.5).all()


def test_classifier_edges(spark):
    schema = "doc_id bigint, text string" + EXTRA
    pad = (None,) * 7
    rows = [(i, f"good words here number {i}" if i % 2 else f"BAD!! WORDS!! {i}!!", *pad) for i in range(60)]
    docs = spark.createDataFrame([*rows, (None, "good words", *pad), (70, None, *pad), (71, "", *pad), (1, None, *pad),
                                  rows[5], (72, "words " * 200_000, *pad)], schema)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, 0, 0), (4, None, 0), (900, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    model = nbsvm.fit(docs, labels)
    got = nbsvm.classify(docs, model).collect()
    assert len(got) == 66
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and 1 < r.doc_id < 60)
    assert len({r.score for r in got if r.doc_id in (70, 71)}) == 1
    assert nbsvm.classify(docs.limit(0), model).collect() == []
    none = nbsvm.fit(docs, labels.limit(0))
    assert {r.predicted for r in nbsvm.classify(docs, none).collect()} == {0}
    ones = nbsvm.fit(docs.limit(0), labels)
    assert len(nbsvm.classify(docs, ones).collect()) == 66
    same = nbsvm.fit(docs, labels.where("quality = 1"))
    assert {r.predicted for r in nbsvm.classify(docs, same).collect()} == {1}


# -- periodic runs ------------------------------------------------------------

def plain_runs(s, least=6, repeats=4):
    n, out = len(s), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, repeats * q) and not any(
                    all(s[x] == s[x + d] for x in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_match_plain_search():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randrange(0, 70)
        s = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            if n:
                a, p = rng.randrange(n), rng.randrange(1, 9)
                for i in range(a + p, rng.randrange(a, n + 1)):
                    s[i] = s[i - p]
        for least, repeats in ((6, 4), (9, 3), (12, 5)):
            assert runs.find_runs(np.array(s, np.int32), least, repeats) == plain_runs(s, least, repeats), s


def test_suffix_tree_extensions_and_order():
    rng = random.Random(2)
    for _ in range(60):
        s = [rng.randrange(3) for _ in range(rng.randrange(1, 50))] + [3]
        tree = runs.SuffixTree(s)
        assert tree.leaves.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s)) if i != j]
        if pairs:
            a, b = map(np.array, zip(*pairs))
            want = [next(k for k in range(len(s)) if s[i + k: i + k + 1] != s[j + k: j + k + 1]) for i, j in pairs]
            assert tree.extension(a, b).tolist() == want


def test_long_runs_take_time_in_proportion():
    for period in (1, 5000):
        s = np.tile(np.random.default_rng(1).permutation(period), 100_000 // period).astype(np.int32)
        assert runs.find_runs(s) == [(0, 100_000, period)]


def plain_op12(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, digest("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            digest(" ".join(w for i, w in enumerate(words) if i not in drop)))


OP12 = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_op12_query_against_plain_search(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").collect()
    got = queries.op12_periodic_run_detection(spark, "/root/testdata/sf0.001")
    assert got.columns == OP12
    assert {f.dataType.simpleString() for f in got.schema.fields[:6]} == {"bigint"}
    got = sorted(tuple(r) for r in got.collect())
    assert [r[0] for r in got] == sorted(r.doc_id for r in docs)
    short = {r.doc_id: r.text for r in docs if len(r.text) < 6000}
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d in short) > 5
    assert [r for r in got if r[0] in short] == [plain_op12(d, short[d]) for d in sorted(short)]


def test_run_edges(spark):
    pad = (None,) * 7
    texts = [None, "", " \n\t ", "a a a a a", "a a a a a a", "é\x0bé\fé é é é é", "a b " * 4, "x" * 100_000,
             "a " * 50_000 + "b c " * 9, "A a A a A a A a", "one " + "two three four " * 5 + "two end"]
    rows = [(i, t, *pad) for i, t in enumerate(texts)] + [(None, texts[4], *pad), (4, texts[4], *pad)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string" + EXTRA)
    got = runs.collapse_runs(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [len(by_id[i].runs) for i in range(4)] == [0] * 4
    assert [by_id[i].text for i in range(4)] == ["", "", "", "a a a a a"]
    assert [tuple(r) for r in by_id[4].runs] == [(0, 6, 1)] and by_id[4].text == "a"
    assert by_id[5].text == "é" and by_id[6].text == "a b" and by_id[9].text == "A a"
    assert by_id[8].text == "a b c" and tuple(by_id[8].strongest) == (0, 50_000, 1)
    assert by_id[10].text == "one two three four end"
    assert sum(r.doc_id == 4 for r in got) == 2 and by_id[None].text == "a"
    assert runs.collapse_runs(docs.limit(0)).collect() == []
    planted = docs.select("doc_id", queries.with_planted_runs(F.col("doc_id"), F.col("text")).alias("text")).collect()
    assert len(planted) == len(rows)


# -- conversation trie --------------------------------------------------------

def plain_sequences(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            key = bytes.fromhex(digest(f"{len(role or '')}:{role or ''}{text or ''}"))[:16]
            own[conv].append((turn is not None, turn or 0, key, (role or "", text or "")))
    return {c: [v[-1] for v in sorted(turns)] for c, turns in own.items()}


def plain_heads(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def plain_trie(sequences):
    members = collections.defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, set()
    for node in sorted(members, key=len, reverse=True):
        own = members[node]
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = sum(saved[c] for c in children[node]) + ((len(own) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(node))
        out.add((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]),
                 leaves[node], saved[node], digest(ends)))
    return out


def trie_rows(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def talks():
    """Shared openings, one very common conversation, a long one, nulls, ties."""
    rng = random.Random(9)
    openings = [("system", "be kind"), ("user", "hi"), ("user", "é漢🙂"), ("user", "")]
    rows = []
    for c in range(-130, 420):
        if c % 3 == 0:
            turns = [openings[0], openings[1], ("assistant", "same")]
        else:
            turns = [rng.choice(openings) for _ in range(rng.randrange(1, 7))]
        if c == 7:
            turns = [rng.choice(openings) for _ in range(300)]
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    rows += [(None, 0, "user", "lost"), (500, None, "user", "first"), (500, 1, "user", "second"), (501, 0, None, None),
             (501, 1, "", ""), (502, 0, "user", "a"), (502, 0, "user", "b"), (502, 0, "user", "a"),
             (9_000_000_000, 5, "user", "hi"), (9_000_000_001, -5, "user", "hi")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def talk_rows(spark, talks):
    return spark.createDataFrame(
        [(*r, "k", "n", 1) for r in talks],
        "conv_id bigint, turn bigint, role string, text string, key string, node string, depth int")


@pytest.mark.parametrize("shard_turns,fan", [(trie.SHARD_TURNS, trie.FAN), (300, 4), (20, 2), (7, 5)])
def test_trie_matches_plain_prefixes(spark, talks, talk_rows, shard_turns, fan):
    own = plain_sequences(talks)
    sequences = trie.turn_sequences(talk_rows)
    assert trie_rows(trie.prefix_trie(sequences, shard_turns, fan)) == plain_trie(own)


def test_trie_of_shared_heads(spark, talks, talk_rows):
    heads = queries.with_shared_heads(trie.turn_sequences(talk_rows))
    assert trie_rows(trie.prefix_trie(heads, 50, 3)) == plain_trie(plain_heads(plain_sequences(talks)))


def test_open_nodes_without_broadcast(spark, talks, talk_rows, monkeypatch):
    monkeypatch.setattr(trie, "BROADCAST_NODES", 0)
    df = trie.prefix_trie(trie.turn_sequences(talk_rows), 50, 3)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().toString()
    assert trie_rows(df) == plain_trie(plain_sequences(talks))


def test_trie_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    none = trie.turn_sequences(spark.createDataFrame([(None, 1, "user", "x")], schema))
    assert trie_rows(trie.prefix_trie(none)) == set()
    kind = "conv_id bigint, turns array<struct<key: binary, chars: bigint>>"
    empty = spark.createDataFrame([(3, None), (2, [])], kind)
    assert trie_rows(trie.prefix_trie(empty)) == {(2, 0, None, 2, 0, 1, 0, digest("2,3"))}


def test_members_of_one_hash_over_many_tasks(spark):
    ids = [i * 7 - 900 for i in range(30_000)]
    members = spark.createDataFrame([(b"h" * 16, i) for i in ids] + [(b"i" * 16, 4)], "hash binary, conv_id bigint")
    got = {bytes(r.hash): r.ends for r in trie.member_digests(members.repartition(5)).collect()}
    assert got == {b"h" * 16: digest(",".join(map(str, sorted(ids)))), b"i" * 16: digest("4")}


def test_ternary_tree_is_balanced():
    tree = trie.TernaryTree()
    tree.insert_balanced([[i] for i in range(1000)])
    depth = {tree.down[0]: 1}
    for x in range(1, 1001):
        for y in (tree.less[x], tree.more[x]):
            if y:
                depth[y] = depth[x] + 1
    assert len(depth) == 1000 and max(depth.values()) <= 10
    assert sorted(tree.letter[x] for x in tree.children(0)) == list(range(1000))
