"""Each operator against a brute-force version on small rows with nulls,
empty and long texts, ties, repeated rows and columns of clashing names."""

import base64
import collections
import dataclasses
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyspark.llm import bpe, chat, extract, lines, neardup, packing, quality, queries, search, toxicity, urls
from tallyspark.llm.components import components

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row string, salt int"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [prose(rng, 120) for _ in range(12)]
    near = [b.replace("w7 ", "w8 ", 1).replace("w1", "x1", 1) for b in base]
    shared = "A shared line that many documents hold\n"
    rows = [*base, *near, base[0], base[0], None, "", " \n ", "one", "one two", "a  b\t c\n\n", prose(rng, 9000),
            "SHARED line that many documents hold \n" + base[1], *[shared + prose(rng, 60) for _ in range(5)],
            "  a SHARED line that many documents hold\t\nend", "é漢字 🙂 <|endoftext|> it's", "x" * 5000]
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 2}", 0, "k", "r", 1) for i, t in texts]
    rows += [rows[3], (None, texts[5][1], None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def tokens():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# -- extraction ---------------------------------------------------------------

def test_article_of_a_page_with_furniture():
    page = """<html><head><title>t</title><style>p{}</style></head><body class="with-sidebar"><header><h1>Site</h1>
      </header><nav><ul><li><a href=/>menu</a></ul></nav><div id="sidebar"><p>Side, side, side, side, side, side.</p></div>
      <article><h1>Head &amp; title</h1><p>One,  two<br>three <b>four <a href="x>y">five</a>.<p>1 < 2 &eacute;
      <div class="ad">Buy, buy, buy, buy, buy</div><ul><li>x<li>y</ul><form>mail, me</form><!-- gone -->
      <div class="comments"><p>I like it, very, very, much, I do</p></div><script>var a="</p>"</script></article>
      <div class="cookie-notice">We use cookies, and more</div><footer>foot</footer>"""
    text, n, tag = extract.main_text(page)
    assert text == "Head & title\nOne, two three four five.\n1 < 2 é\nx\ny"
    assert (n, tag) == (5, "article")


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain  words", "plain words"), ("<nav><p>menu</p></nav>", ""),
    ("<script>never closed <p>x</p>", ""), ("<!-- never closed <p>x</p>", ""), ("<p>a<p>b", "a\nb"),
    ("<div class=content><p>long, text, here, it is</p><div class=share>share</div></div>", "long, text, here, it is")])
def test_small_pages(page, text):
    assert extract.main_text(page)[0] == text


def test_extract_rows(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in extract.extract(df).collect()) == [
        (0, "", 0), (1, "a", 1), (1, "a", 1)]
    assert extract.extract(df.limit(0)).count() == 0


# -- urls ---------------------------------------------------------------------

def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = {f"k{i}" for i in range(0, 4000, 7)} | {"outside"}
    cascade = urls.build_cascade(universe, listed)
    assert len(cascade.levels) > 1
    assert all((f"k{i}" in cascade) == (f"k{i}" in listed) for i in range(4000))
    assert "k1" not in urls.build_cascade(universe, [])


def test_url_verdicts(spark):
    from tallyspark.llm.queries import BLOCKED_HOSTS, URL_RULES
    rng = random.Random(5)
    hosts = ["example.com", "WWW.example.com", "a.www.example.com", "x.net", "net", "spam-farm.example.org",
             "b.spam-farm.example.org", "example.org", "notexample.com", "example.com:80", "",
             "l." * 20_000 + "example.com", "." * 20_000 + "spam-farm.example.org"]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/x?y=/en/", "#a", "?q"]
    given = [f"{s}://{h}{p}" for s in ("http", "x") for h in hosts for p in paths]
    given += [None, "", "no scheme", "http:/x.com/", "a://b://c/d"]
    rng.shuffle(given)

    def expected(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        if fits:
            best = max(fits, key=lambda r: len(r.key))
            return host, path, best.key, best.verdict
        spam = any(host == b or host.endswith("." + b) for b in BLOCKED_HOSTS)
        return host, path, None, "block" if spam else "allow"

    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(given)], "page_id bigint, url string, host string")
    for r in urls.judge_urls(df, URL_RULES, BLOCKED_HOSTS).collect():
        assert (r.host, r.path, r.rule, r.verdict) == expected(given[r.page_id]), given[r.page_id]
    assert urls.judge_urls(df.limit(0), URL_RULES, BLOCKED_HOSTS).count() == 0


# -- quality ------------------------------------------------------------------

def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = collections.Counter(windows)
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in (i, i + 1, i + 2)}
    full = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(covered), len(full))


def test_text_counts():
    rng = random.Random(1)
    cases = [None, "", "\x1c\x85 a", "a a a a a", "a b c a b c d", "x\nx\n\n \nx", "#|<>&é漢"]
    cases += ["".join(rng.choice("ab c\n\t#") for _ in range(60)) for _ in range(300)]
    assert all(quality.count_text(t) == brute_counts(t) for t in cases)


def test_thresholds_follow_each_group(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):  # a source in which symbols are usual, and one without
        usual = i % 2 == 0
        words = [f"word{rng.randrange(900)}" + ("%" if usual and rng.random() < 0.5 else "") for _ in range(80)]
        rows.append((i, " ".join(words), "en", "code" if usual else "news"))
    junk = " ".join(f"word{k}%%" for k in range(80))
    rows += [(1000, junk, "en", "news"), (1001, rows[0][1], "en", "news"), (1002, "short", "en", "news"),
             (1003, None, None, None), (1004, rows[1][1], None, "new"), (1004, rows[1][1], None, "new")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = collections.defaultdict(list)
    for r in quality.judge_quality(df, keep_text=False).select("row.*", "kept", "base_failed").collect():
        got[r.doc_id].append((r.kept, r.base_failed))
    assert all(got[i] == [(True, False)] for i in range(600))
    assert got[1000] == got[1001] == [(False, False)]
    assert got[1002] == got[1003] == [(False, True)]
    assert got[1004] == [(True, False)] * 2
    assert quality.judge_quality(df.limit(0)).count() == 0


# -- tokens -------------------------------------------------------------------

def test_bpe_equals_the_tokenizer(spark, docs):
    enc = tokens()
    want = collections.Counter()
    for i, t in rows_of(docs):
        ids = enc.encode_ordinary(t or "")
        want[i, tuple(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = collections.Counter((r.doc_id, tuple(r.ids), r.ids_sha256, r.decoded_sha256)
                              for r in bpe.encode_decode(docs, RANKS).collect())
    assert got == want


def test_bpe_appends_and_edits():
    rng, enc, own = random.Random(4), tokens(), bpe.PrefixBpe(RANKS)
    alphabet = "ab \n\t'stre’éß漢🙂12 .,-_ \x00\x1c\x85xX"
    for _ in range(2000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        assert own.encode(s) == enc.encode_ordinary(s), s
        assert own.decode(own.encode(s)) == s.encode()
    for _ in range(300):
        word = bytes(rng.choice(b"abcdeth ") for _ in range(rng.randrange(1, 400)))
        states, at = own.append(word), rng.randrange(len(word))
        removed, new = rng.randrange(min(5, len(word) - at) + 1), bytes(rng.choice(b"abth") for _ in range(rng.randrange(5)))
        edited, fresh = own.edit(word, states, at, removed, new)
        assert fresh == own.append(edited)
        assert own.append(word + new, states) == own.append(word + new)


# -- chat ---------------------------------------------------------------------

def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi <|im_end|>\n<\\|x <|"), (1, 1, "assistant", "<"), (1, 2, "user", None),
            (2, 0, "system", "s"), (2, 1, "user", "u\n\n"), (2, 2, "assistant", "a <|im_start|>assistant\nno"),
            (2, 3, "assistant", "twice"), (3, 0, "ro\\n<|le\n", "|x"), (3, None, None, None),
            (4, 0, "user", "same"), (4, 0, "user", "same"), (None, 0, "user", "x")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "conv_id bigint, turn bigint, role string, text string, said string")
    got = {r.conv_id: r for r in chat.read_chat(chat.format_chat(df)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv))
        assert [(t.role, t.text) for t in got[conv].turns] == [t[1:] for t in turns]
        assert got[conv].loss_text == "".join(t[2] for t in turns if t[1] == "assistant")
        assert got[conv].formatted.count("<|im_start|>") == len(turns)
    assert [got[c].valid for c in (1, 2, 3, 4)] == [True, False, False, False]
    assert chat.format_chat(df.limit(0)).count() == 0


# -- near duplicates ----------------------------------------------------------

def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_near(rows):
    sets = [shingles(t) for _, t in rows]
    links = [[j for j, b in enumerate(sets) if j != i and a and 10 * len(a & b) >= 8 * len(a | b)] for i, a in enumerate(sets)]
    group = list(range(len(rows)))
    for _ in rows:
        for i, near in enumerate(links):
            for j in near:
                group[i] = group[j] = min(group[i], group[j])
    ids = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    return collections.Counter((rows[i][0], ids[group[i]], len(links[i])) for i in range(len(rows)))


@pytest.mark.parametrize("block", [150_000, 300])
def test_near_duplicates_equal_brute_force(spark, docs, block):
    found = neardup.near_duplicates(docs, neardup.Forest(block_shingles=block)).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.n_links) for r in found) == brute_near(rows_of(docs))


def test_large_near_copy_group_in_many_blocks(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(9999)}" for _ in range(300)]
    rows = []
    for i in range(80):
        copy = list(base)
        copy[rng.randrange(300)] = f"n{i}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = neardup.near_duplicates(df, neardup.Forest(block_shingles=3000)).collect()
    assert {(r.doc_id, r.class_id, r.n_links) for r in found} == {(i, 0, 79) for i in range(80)}
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def plain_links(rows):
    """For each row the number of other rows with a similarity of 0.8 or more."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets.append({tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    holders = collections.defaultdict(list)
    for i, own in enumerate(sets):
        for gram in own:
            holders[gram].append(i)
    links = []
    for i, own in enumerate(sets):
        shared = collections.Counter(j for gram in own for j in holders[gram])
        links.append(sum(1 for j, n in shared.items() if j != i and 10 * n >= 8 * (len(own) + len(sets[j]) - n)))
    return links


def test_recall_of_the_forest(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    exact = dict(zip([i for i, _ in rows], plain_links(rows)))
    got = {r.doc_id: r.n_links for r in neardup.near_duplicates(docs).collect()}
    recall = sum(got.values()) / sum(exact.values())
    print(f"recall of links {recall:.4f} of {sum(exact.values())}")
    assert all(got[i] <= exact[i] for i in exact) and recall >= 0.99


def minhash_labels(rng, forest, base, similarity):
    return b"".join((x if rng.random() < similarity else rng.randrange(1 << 16)).to_bytes(2, "little") for x in base)


@pytest.mark.parametrize("similarity,length", [(0.97, 8), (0.81, 6)])
def test_prefix_length_follows_the_corpus(spark, similarity, length):
    """Close pairs reach the target with the full label, pairs at the
    threshold with a shorter one."""
    forest = neardup.Forest(sampled_nodes=1)
    rng = random.Random(4)
    rows = []
    for i in range(400):
        base = [rng.randrange(1 << 16) for _ in range(forest.trees * forest.depth)]
        rows += [(2 * i, minhash_labels(rng, forest, base, 1)), (2 * i + 1, minhash_labels(rng, forest, base, similarity))]
    classes = spark.createDataFrame(rows, "id bigint, labels binary")
    assert neardup.matched_length(classes, forest) == length
    assert neardup.matched_length(classes.limit(0), forest) == forest.shortest() == 6
    tied = {tuple(sorted(t)) for t in neardup.candidate_ties(classes, forest).collect()}
    assert len(tied & {(2 * i, 2 * i + 1) for i in range(400)}) >= 398


def test_rows_without_or_with_one_id_stay_apart(spark):
    """Texts of one id, or of none, meet only their own class."""
    rng = random.Random(8)
    texts = [prose(rng, 40) for _ in range(300)]
    near = [t + " end" for t in texts]
    rows = [(None, t) for t in texts + near] + [(7, t) for t in texts[:150]] + [(None, texts[0])] * 500 + [(7, texts[1])] * 300
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = neardup.judged_rows(df).collect()
    assert len(got) == len(rows)
    assert sorted(r.n_links for r in got) == sorted(plain_links(rows))
    signed = neardup.signatures(df)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2")
    found = signed.groupBy("key", "size").agg(F.min(row).alias("least"), F.count("*").alias("copies")).withColumn(
        "component", F.lit(1).cast("bigint"))
    sent = neardup.candidate_shingles(df, found, neardup.Forest(block_members=100))
    assert sent.count() == found.count() == 600  # one text a class
    assert {r.blocks for r in sent.select("blocks").distinct().collect()} == {6}
    # one head a group: the one with an id where there is one
    heads = {(r.doc_id, r.h1) for r in got if r.head}
    assert len(heads) == 300 and sum(i == 7 for i, _ in heads) == 150


# -- packing ------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    counts = collections.Counter(min(100, int(rng.expovariate(1 / (5 + 12 * seed))) + 1) for _ in range(3000))
    slots, n = packing.plan_slots(dict(counts), 100)
    fill, ranks = collections.defaultdict(list), collections.defaultdict(list)
    for length, rank, bins, each, sequence, offset in slots:
        ranks[length] += range(rank, rank + bins * each)
        for b in range(bins):
            fill[sequence + b] += [(offset + k * length, length) for k in range(each)]
    assert all(sorted(ranks[k]) == list(range(c)) for k, c in counts.items())
    for items in fill.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 100
        assert sum(3 * k > 100 for _, k in items) <= 2
    assert set(fill) == set(range(n))
    lower = -(-sum(k * c for k, c in counts.items()) // 100)
    assert n <= 1.02 * max(lower, sum(c for k, c in counts.items() if 2 * k > 100)) + 1


def test_packing_rows(spark, docs):
    enc, hf = tokens(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    hf.encode_special_tokens = True
    want, got = collections.defaultdict(list), collections.defaultdict(list)
    for i, t in rows_of(docs):
        ids = hf.encode(t or "", add_special_tokens=False).ids + [0]
        assert ids[:-1] == enc.encode_ordinary(t or "")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i].append((k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    sequences = collections.defaultdict(list)
    for r in packing.pack(docs, RANKS).collect():
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for items in sequences.values():
        items.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(items, items[1:]))
        assert items[0][0] == 0 and sum(items[-1]) <= 2048
    assert packing.pack(docs.limit(0), RANKS).count() == 0


@pytest.mark.parametrize("n", [1_000_000, 10_000_000])
@pytest.mark.parametrize("white", [" ", "\n", "\t"])
def test_long_white_space_has_the_ids_of_tokenizers(white, n):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = packing._encoding(path, public_tokenizers.PATTERN), Tokenizer.from_file(path)
    texts = [f"a b{white * n}c it's"] if n > 1_000_000 else [
        white * n, f"x{white * n}", f"{white * n}x", f"a{white * n} 7{white * n}<|endoftext|>{white * n}\u00a0\u3000!",
        f"{white * 19_998}\x1c{white * 30_000}\x85"]
    for text in texts:
        assert encoder.ids(text) == library.encode(text, add_special_tokens=False).ids


def test_packing_of_long_white_space(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, " " * 1_000_000), (2, "x" + "\n" * 600_000 + "y"), (3, "plain")], "doc_id bigint, text string")
    got = packing.pack(df, path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    library = Tokenizer.from_file(path)
    assert {r.doc_id: r.n for r in got} == {
        r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in df.collect()}


def test_registered_packing_has_the_ids_of_the_tokenizer_file(spark, docs, monkeypatch):

    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert hf.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    more = ["a <|endoftext|> b", " <|endoftext|>\n\n<|endoftext|><|endoftext|>x", "<|endoftext|>", "<|endoftext|", "a  <|endoftext|>  's"]
    given = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(more, 500)), "doc_id bigint, text string"))
    monkeypatch.setattr(queries, "table", lambda *_: given)
    want = collections.Counter()
    for i, t in rows_of(given):
        ids = hf.encode(t or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = queries.op7_best_fit_packing(spark, "").collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want


# -- lines --------------------------------------------------------------------

def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    keys = np.unique(keys)
    found = lines.PerfectHash.from_bytes(lines.PerfectHash.build(keys).to_bytes())
    assert sorted(found.index(keys)) == list(range(len(keys)))


@pytest.mark.parametrize("shard_keys, probes", [(100_000, lines.PROBES), (7, lines.PROBES), (100_000, 3), (7, 1)])
def test_line_dedup_equals_brute_force(spark, docs, shard_keys, probes):
    def key(line):
        return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({i: i + 32 for i in range(65, 91)})
    rows = rows_of(docs)
    held = collections.defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k].append(-1 if i is None else i)
    want = collections.Counter()
    for i, t in rows:
        own = -1 if i is None else i
        all_lines = (t or "").split("\n")
        stay = [x for x in all_lines if not (len(key(x)) >= 20 and len(held[key(x)]) >= 3 and max(held[key(x)]) != own)]
        want[i, None if t is None else "\n".join(stay), len(all_lines), len(all_lines) - len(stay)] += 1
    found = lines.dedup_lines(docs, shard_keys=shard_keys, probes=probes)
    assert set(found.columns) == {*docs.columns, "n_lines", "n_dropped"}
    got = collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect())
    assert got == want and any(n for _, _, _, n in want)
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_busy_shards_are_few_at_any_size(spark, monkeypatch):
    monkeypatch.setattr(lines, "MAX_BUSY", 40)
    loads = [5, 90, 4000, 7, *[300] * 60]
    found = lines.busy_shards(spark.createDataFrame(list(enumerate(loads)), "shard int, n bigint"), 10).collect()
    each = -(-sum(loads) // 40)
    assert {r.shard: r.salts for r in found} == {i: -(-n // each) for i, n in enumerate(loads) if n > lines.SALTS * each}
    assert len(found) <= 40 / lines.SALTS
    assert lines.busy_shards(spark.createDataFrame([], "shard int, n bigint")).count() == 0


# -- search -------------------------------------------------------------------

@pytest.mark.parametrize("block", [4096, 60])
def test_top_k_equals_brute_force(spark, block):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(150, 8)), np.repeat(rng.normal(size=(3, 8)), 30, axis=0)])
    rows = [(i, [float(v) for v in e], 1) for i, e in enumerate(x)]
    odd = [(300, None, 1), (301, [], 1), (302, [1.0, None] + [0.0] * 6, 1), (350, [float("nan")] * 8, 1),
           (None, rows[0][1], 1), rows[5], (400, [float("inf")] + [0.0] * 7, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, rank int")
    whole = np.floor(256 * x.astype(np.float32).astype(np.float64))
    want = {}
    for q in range(0, len(x), 50):
        score = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:5]
        want |= {(q, k + 1): (int(i), int(score[i])) for k, i in enumerate(order)}
    found = search.top_k(df, 50, search.Search(candidates_per_block=block, queries_per_block=3, leaf=6, sample=20))
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()} == want
    few = search.top_k(df.where("vec_id < 3")).collect()
    assert [(r.query_id, r.rank) for r in few] == [(0, 1), (0, 2)]
    assert search.top_k(df.limit(0)).count() == 0


def test_cover_tree_covers():
    x = np.floor(256 * np.random.default_rng(2).normal(size=(500, 6)))
    tree = search.CoverTree(x, 8, 0.7)
    for node, points in enumerate(tree.points):
        apart = np.sqrt(((x[points] - x[tree.center[node]]) ** 2).sum(axis=1))
        assert apart.max() <= tree.radius[node] + 1e-9
        if tree.inner[node]:
            assert sorted(np.concatenate([tree.points[c] for c in tree.children[node]])) == sorted(points)


# -- toxicity -----------------------------------------------------------------

def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = prose(rng, 60, 3000).split()
        if toxic:
            words[rng.randrange(60)] = rng.choice(["Snarlgrub", "snarlgrubbing", "snarlgrubs"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, 0, int(toxic), "x"))
    rows += [(5000, None, "x"), (5001, "", "x"), (None, "snarlgrub", "x"), (5002, "hi\n" * 3000, "x"), (5002, "hi\n" * 3000, "x")]
    labels += [(None, 0, 1, "x"), (5001, 0, None, "x"), (7777, 0, 1, "x"), (0, 0, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")
    model = toxicity.fit(docs, marks)
    found = toxicity.judged(docs, model).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None and r.doc_id < 5000:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            if r.held_out:
                assert r.predicted == int(r.doc_id % 6 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    kept = {r.doc_id for r in toxicity.keep_civil(docs, model).collect()}
    assert kept == {r.doc_id for r in found if not r.predicted} and 5000 in kept
    none = toxicity.fit(docs.limit(0), marks)
    assert {r.predicted for r in toxicity.judged(docs, none).collect()} == {0}
    # labels of held-out rows change nothing
    flipped = marks.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert np.array_equal(toxicity.fit(docs, flipped).weights, model.weights)

    # rows that repeat an id are one training row: the model is the same
    again = docs.unionByName(docs.where("doc_id % 5 = 0")).unionByName(docs.where("doc_id = 7"))
    assert np.array_equal(toxicity.fit(again, marks).weights, model.weights)


def test_toxicity_of_long_texts(spark):
    rng = random.Random(11)
    clean = lambda n: " ".join(rng.choice(["gr", "sna", "lub", "ro", "mi", "ta", "ke", "or"]) * rng.randrange(1, 3)
                               + rng.choice(["gla", "pe", "ru", "sno", "bing"]) + str(rng.randrange(10 ** 6)) for _ in range(n))
    rows, labels = [], []
    for i in range(900):
        words = clean(120).split()
        if i % 6 == 0:
            words[rng.randrange(120)] = rng.choice(["Snarlgrub", "snarlgrubbing", "snarlgrubs"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 6 == 0)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"),
                         spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    long = [clean(n) for n in (80_000, 240_000, 800_000)]  # 1, 3 and 10 MB
    passage = next(t for i, t in rows if i % 6 == 0)
    held = [passage + " " + long[0], long[0] + " " + passage, long[0][:500_000] + " " + passage + " " + long[0][500_000:]]
    def marked(texts):
        data = [t.encode() for t in texts]
        offsets = np.cumsum([0, *map(len, data)])
        return list(model.scores(np.frombuffer(b"".join(data), np.uint8), offsets) >= 0.3)
    assert [marked([t]) for t in long] == [[False]] * 3
    assert marked(held) == [True] * 3
    assert marked(["", "x", passage, *held[:1]]) == [False, False, True, True]
    # a window is scored as the text of its own would be
    whole = dataclasses.replace(model, training=toxicity.Training(window=1 << 40))
    few = np.frombuffer(b"".join(t.encode() for _, t in rows[:50]), np.uint8)
    at = np.cumsum([0, *[len(t.encode()) for _, t in rows[:50]]])
    assert np.array_equal(whole.scores(few, at), model.scores(few, at))


def plain_windows(text, training):
    """n-grams of each window of a text, as strings."""
    half = training.window // 2
    body = re.sub(r"[ \t-\r]+", " ", " " + "".join(c.lower() if len(c.lower()) == 1 else c for c in text))
    whole = body + " "
    n = max(-(-len(body) // half) - 1, 1)
    ends = [(k + 2) * half if k < n - 1 else len(body) for k in range(n)]
    return [{whole[i: i + o] for i in range(k * half, ends[k]) for o in training.orders if i + o <= len(whole)}
            for k in range(n)]


STRANGE = ["", " ", "x", "\n\n a\tb  C", "ÀÉÎ Õü Straße ΣΑΣ Ж я 中文 😀😀 İstanbul ǅ", "abc " * 900, "é" * 5000,
           " ".join(f"w{i} Ünï{i % 7}" for i in range(3000)), "ab   " * 400 + " "]


def hash_of(gram):
    codes = np.array([ord(c) for c in gram], np.int32)
    return int(dict(toxicity.hashes_of(codes, (len(gram),)))[len(gram)][0])


def test_toxicity_windows_and_counts_equal_plain_ones(spark):
    training = toxicity.Training(window=64, max_training_windows=10 ** 6, min_windows=2, parts=3)
    rows = [(i, i % 2, t) for i, t in enumerate(STRANGE)]
    sample = spark.createDataFrame(rows, "id bigint, y int, text string")
    got = {r.feature: (r.p, r.q) for r in toxicity.counted(sample, training).collect()}
    want, windows = collections.Counter(), collections.Counter()
    for _, y, text in rows:
        for grams in plain_windows(text, training):
            windows[y] += 1
            want.update((g, y) for g in grams)
    assert got.pop(None) == (windows[1], windows[0])
    kept = {g for g, _ in want if want[g, 0] + want[g, 1] >= 2}
    hashes = {g: hash_of(g) for g in kept}
    assert len(set(hashes.values())) == len(kept)
    assert {f % (1 << 64): n for f, n in got.items()} == {hashes[g]: (want[g, 1], want[g, 0]) for g in kept}

    # a bound on windows takes evenly spread ones
    few = toxicity.Training(window=64, max_training_windows=4, parts=3)
    total = next(iter(r for r in toxicity.counted(sample, few).where("feature is null").collect()))
    assert total.p + total.q == sum(min(4, len(plain_windows(t, few))) for _, _, t in rows)


@pytest.mark.parametrize("chunk", [1 << 20, 100, 7])
def test_toxicity_scores_equal_plain_ones_however_texts_are_cut(chunk, monkeypatch):
    monkeypatch.setattr(toxicity, "_HALVES", 4)
    training = toxicity.Training(window=64)
    grams = sorted({g for t in STRANGE for w in plain_windows(t, training) for g in w}, key=hash_of)[::3]
    weights = np.random.default_rng(5).normal(size=len(grams))
    model = toxicity.Model(np.array([hash_of(g) for g in grams], np.uint64), weights, weights, 0.25, 0.5, training)
    weight = dict(zip(grams, weights))
    data = [t.encode() for t in STRANGE]
    got = model.scores(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]), chunk)
    for text, score in zip(STRANGE, got):
        found = plain_windows(text, training)
        margin = max(sum(weight.get(g, 0) for g in w) for w in found) + 0.25 - 0.5 * math.log(len(found))
        assert abs(score - 1 / (1 + math.exp(-max(-35, min(35, margin))))) < 1e-9, text[:20]


def test_toxicity_of_bytes_that_are_no_text():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    at = np.array([0, 0, 3, 1000, 1001, 4000, 5000])
    features = np.sort(rng.integers(0, 1 << 63, 50, dtype=np.uint64))
    model = toxicity.Model(features, np.ones(50), np.ones(50), 0.0, 0.1, toxicity.Training(window=64))
    assert np.isfinite(model.scores(data, at, 100)).all()


def test_toxicity_fit_is_the_optimum(monkeypatch):
    rng = np.random.default_rng(4)
    n, m = 300, 40
    dense = rng.random((n, m)) < 0.2
    y = (dense[:, :5].sum(axis=1) + rng.normal(size=n) > 1.5).astype(float)
    scale = rng.normal(size=m)
    rows = toxicity.Rows(np.nonzero(dense)[1].astype(np.uint16), dense.sum(axis=1))
    monkeypatch.setattr(toxicity, "_BLOCK", 7)
    own = rng.random(n) < 0.8
    training = toxicity.Training(steps=3000, slope=1e-7)
    w, b = toxicity.logistic(y[own], rows.where(own), scale, training)
    x = (dense * scale)[own]
    off = 1 / (1 + np.exp(-(x @ w + b))) - y[own]
    assert np.abs(x.T @ off + training.ridge * w).max() < 1e-4 and abs(off.sum()) < 1e-4
    again, _ = toxicity.logistic(y[own], rows.where(own), scale, training, (w * 0.5, b + 1))
    assert np.abs(again - w).max() < 1e-3


@pytest.mark.parametrize("noise", [0.0, 0.2])
@pytest.mark.parametrize("alike", [1, 40])
def test_toxicity_fit_reaches_its_slope_in_its_steps(noise, alike):
    # features that come in equal copies, labels that one feature separates or nearly so
    rng = np.random.default_rng(alike)
    dense = np.repeat(rng.random((400, 30)) < 0.3, alike, axis=1)
    y = (dense[:, 0] ^ (rng.random(400) < noise)).astype(float)
    rows = toxicity.Rows(np.nonzero(dense)[1].astype(np.uint16), dense.sum(axis=1))
    scale, training = rng.normal(size=30 * alike), toxicity.Training(ridge=0.5)
    w, b = toxicity.logistic(y, rows, scale, training)
    off = 1 / (1 + np.exp(-(dense @ (w * scale) + b))) - y
    slope = scale * (dense.T @ off) + training.ridge * w
    assert max(np.abs(slope).max(), abs(off.sum())) <= training.slope * len(y) * 1.001


def test_toxicity_fit_without_features():
    y = np.array([1.0, 0.0, 0.0, 0.0])
    rows = toxicity.Rows(np.empty(0, np.uint16), np.zeros(4, np.int64))
    w, b = toxicity.logistic(y, rows, np.empty(0), toxicity.TRAINING)
    assert len(w) == 0 and abs(1 / (1 + np.exp(-b)) - 0.25) < 1e-3


def test_toxicity_learns_from_the_toxic_windows_of_a_text(spark):
    """Toxic training texts are mostly clean; a clean text of their other words is not marked."""
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(300):
        words = [prose(rng, 1, 800) for _ in range(2400 if i % 3 == 0 else 300)]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(["snarlgrub", "snarlgrubs"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    held = [r for r in toxicity.judged(docs, model).collect() if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 3 == 0) for r in held) >= 0.9 * len(held)


@pytest.mark.parametrize("size", [1.0, 3e4, 3e5, 6e5])
def test_scores_are_exact_or_refused(spark, size):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4) * size + (i % 7) * 1e-3]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = [[math.floor(256 * x) for x in v] for _, v in rows]
    want = []
    for q in range(0, 120, 50):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[d])), d) for d in range(120) if d != q)[:5]
        want += [(q, n + 1, d, -s) for n, (s, d) in enumerate(scores)]
    assert sorted(map(tuple, search.top_k(df).collect())) == want


def test_scores_beyond_64_bits_raise(spark):
    rows = [(i, [3e8 + i, -3e8]) for i in range(60)]
    with pytest.raises(Exception, match="beyond 62 bits"):
        search.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert search.exact_scores(np.array([[2.0 ** 30, 1]]), np.array([[2.0 ** 30, 3]])).tolist() == [[2 ** 60 + 3]]


def scored_share(x, asked):
    ids = np.arange(len(x))
    exact = search.exact_scores(x[asked], x)
    exact[np.arange(len(asked)), asked] = search.NONE
    best = search.BestK(len(asked), 5, np.full(len(asked), search.NONE))
    s = search.Search()
    search.dual_search(search.CoverTree(x[asked], s.leaf, s.shrink), search.CoverTree(x, s.leaf, s.shrink), asked, ids, best)
    assert (np.sort(best.score) == np.sort(np.partition(exact, -5, axis=1)[:, -5:])).all()
    return best.scored / (len(asked) * len(x))


def test_clusters_are_pruned_and_independent_directions_are_not(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 64))
    centres *= 256 / np.linalg.norm(centres, axis=1)[:, None]
    clustered = np.floor(centres[rng.integers(0, 60, 4000)] + rng.normal(size=(4000, 64)) * 2)
    share = scored_share(clustered, np.arange(0, 4000, 50))
    rows = search.whole_vectors(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")).collect()
    given = np.array([r.v for r in sorted(rows, key=lambda r: r.vec_id)])
    given_share = scored_share(given, np.arange(0, len(given), 50))
    print(f"scored: clusters {share:.3f}, the provided vectors {given_share:.3f}")
    assert share < 0.3


def test_a_group_of_junk_cannot_widen_its_own_limits(spark):
    """30 and 40% junk in one group of a language with clean ones."""
    rng = random.Random(2)
    for percent in (30, 40):
        rows, junk = [], set()
        for i in range(1500):
            dirty = i < 500 and i % 100 < percent
            words = [f"w{rng.randrange(3000)}" + ("%%" if dirty and rng.random() < 0.5 else "") for _ in range(80)]
            rows.append((i, " ".join(words), "en", "dirty" if i < 500 else f"clean{i % 3}"))
            junk |= {i} if dirty else set()
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
        gone = {r.doc_id for r in quality.judge_quality(df, keep_text=False).where("not kept").select("row.doc_id").collect()}
        assert gone == junk, percent


def test_chat_query_runs_its_machine(spark):
    df = queries.op5_chat_formatting(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "instructed" in plan and "answered" in plan and "InArrow" not in plan
    got = {r.conv_id: (r.final_state, r.valid) for r in df.collect()}
    assert got[-1] == ("answered", True)
    bad = spark.createDataFrame([(1, 0, "assistant", "x"), (2, 0, "system", "x"), (3, 0, "user", "x")],
                                "conv_id bigint, turn bigint, role string, text string")
    states = {r.conv_id: (r.final_state, r.valid) for r in chat.format_chat(bad).collect()}
    assert states == {1: ("error", False), 2: ("instructed", False), 3: ("asked", True)}


@pytest.mark.parametrize("page,chars", [
    ("<div><p>text, more " * 50_000, 50_000 * 11 - 1), ("<div>" * 50_000 + "text, here" + "</div>" * 50_000, 10),
    ("<div>" * 50_000 + "</section>" * 50_000 + "end", 3), ("<ul><li>" + "<div>" * 50_000 + "<li>a" * 50_000, 50_000 * 2 - 1)])
def test_deep_pages_take_time_in_proportion(page, chars):
    start = time.monotonic()
    assert len(extract.main_text(page)[0]) == chars
    assert time.monotonic() - start < 20
