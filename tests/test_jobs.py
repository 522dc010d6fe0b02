"""Command-line jobs on small text inputs, checked against the operators
and plain Python."""

import json
import os
import tempfile
from collections import Counter

import pytest

from tallyspark import jobs
from tallyspark.sources import raw_edges
from tallyspark.operators import graph as G
from tallyspark.sources import files as FS

from conftest import SF_SMALL


def write(lines, name="part-0.txt"):
    d = tempfile.mkdtemp(prefix="job-")
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


def test_wordcount_job(spark):
    docs = ["a b  c", "", "b a", "x y z a"]
    out = jobs.wordcount(spark, 4, write(docs), seed=1)
    words = Counter(w for d in docs for w in d.split(" "))
    assert out["documents"] == 4
    assert list(out["distinct_words"].values()) == [len(words)] * 4
    assert out["average_word_length"] == sum(len(w) for w in words) / len(words)


def test_triangle_jobs(spark):
    edges = raw_edges(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="edges-") + "/pairs"
    FS.write_pair_lines(edges, d)
    exact = G.triangles_exact(edges).collect()[0][0]
    out = jobs.triangles(spark, 1, 2, d, seed=3)   # one colour / part: exact
    assert out["edges"] == edges.count()
    assert out["estimate_by_colors"] == out["estimate_by_partitions"] == exact
    # square 1-2-3-4 with diagonal 1-3: two triangles
    flat = write(["1,2,2,3", "1,3", "3,4,4,1,"])
    out = jobs.triangles2(spark, 3, 3, 1, flat, seed=5)
    assert out["edges"] == 5 and out["triangles"] == 2
    out = jobs.triangles2(spark, 1, 3, 0, flat, seed=5, p=8191)
    assert out["estimate_median"] == 2
    with pytest.raises(ValueError):
        jobs.triangles2(spark, 2, 1, 2, flat, seed=5)


def test_stream_job(spark):
    d = tempfile.mkdtemp(prefix="items-")
    batches = [[5, 7, 7, 200], [7, 9, 9, 9], [1, 1]]
    for i, b in enumerate(batches):
        path = os.path.join(d, f"b{i}.txt")
        with open(path, "w") as f:
            f.write("\n".join(map(str, b)) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))  # arrival order
    out = jobs.stream(spark, 3, 32, 0, 100, 2, d, seed=7, threshold=6,
                      max_files_per_trigger=1)
    assert out["items"] == 8  # two whole batches: 4 < 6, then 8 >= 6
    items = [x for b in batches[:2] for x in b]
    freq = Counter(x for x in items if 0 < x < 100)
    assert out["second_moment"] == sum(n * n for n in freq.values()) / len(freq) ** 2
    assert out["largest_item"] == max(freq)


def test_stream_job_rejects_a_bad_item(spark):
    with pytest.raises(Exception, match="malformed number"):
        jobs.stream(spark, 1, 8, 0, 100, 2, write(["5", "x", "7"]), seed=7)


def test_cli_entry_point():
    import subprocess
    import sys
    d = write(["a b", "b c c"])
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    res = subprocess.run([sys.executable, "-m", "tallyspark", "--seed", "1", "wordcount",
                          "2", d], cwd=repo, capture_output=True, text=True, timeout=300)
    assert res.returncode == 0, res.stderr[-2000:]
    report = json.loads(res.stdout.strip().splitlines()[-1])
    assert report["documents"] == 2
    assert list(report["distinct_words"].values()) == [3] * 4
