"""URL rules through a Bloom filter cascade.

A rule is (host, path, verdict).  Every pair of a host suffix of no more labels
than a listed host and a path beginning of a listed length is a key a rule could have; the distinct keys of
the corpus are the complete universe.  For each list a cascade is built: level
1 encodes the listed keys, level 2 the other universe keys that level 1 lets
through, level 3 the listed keys that level 2 lets through, and so on until a
level errs on nothing.  A key is listed exactly if the first level without it
is an even one, so over that universe membership is exact and no table is joined.

Size: level 1 is given an error rate of about listed / universe, so each later
level holds no more keys than the list has (in expectation under half); a
cascade takes a few bytes per listed key and log of the universe.  Lists are
parameters of at most ``MAX_LISTED`` keys, which bounds what is broadcast.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

MAX_LISTED = 2_000_000
SCHEMA = "page_id bigint, url string, host string, path string, rule string, verdict string"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # "allow" or "block"

    @property
    def key(self) -> str:
        return self.host + self.path


class Bloom:
    def __init__(self, keys: Iterable[str], n: int, error: float, level: int):
        self.level = level
        self.bits = max(64, math.ceil(-max(1, n) * math.log(error) / math.log(2) ** 2))
        self.hashes = max(1, round(self.bits / max(1, n) * math.log(2)))
        self.data = bytearray(-(-self.bits // 8))
        for key in keys:
            for at in self._at(key):
                self.data[at >> 3] |= 1 << (at & 7)

    def _at(self, key: str) -> Iterator[int]:
        raw = hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16,
                              salt=self.level.to_bytes(8, "little")).digest()
        a, b = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:], "little") | 1
        return ((a + i * b) % self.bits for i in range(self.hashes))

    def __contains__(self, key: str) -> bool:
        return all(self.data[at >> 3] >> (at & 7) & 1 for at in self._at(key))


class Cascade:
    """Levels of alternating Bloom filters; exact over its universe."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def __contains__(self, key: str) -> bool:
        for depth, level in enumerate(self.levels):
            if key not in level:
                return depth % 2 == 1
        return len(self.levels) % 2 == 1

    @property
    def n_bytes(self) -> int:
        return sum(len(x.data) for x in self.levels)


def build_cascade(universe: DataFrame, listed: Iterable[str], name: str = "list") -> Cascade:
    """``universe`` has one column ``key`` with every key that will be asked
    for; listed keys outside it need no place in the cascade but get one."""
    listed = set(listed)
    if len(listed) > MAX_LISTED:
        raise ValueError(f"{len(listed)} listed keys; at most {MAX_LISTED}")
    if not listed:
        return Cascade([])
    spark = universe.sparkSession
    total = max(len(listed), universe.count())
    levels = [Bloom(listed, len(listed), min(0.5, len(listed) / (math.sqrt(2) * total)), 0)]
    inside = spark.sparkContext.broadcast((levels[0], frozenset(listed)))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, known = inside.value
        for batch in batches:
            wrong = [k for k in batch.column(0).to_pylist() if k not in known and k in level]
            yield pa.RecordBatch.from_arrays([pa.array(wrong, pa.string())], ["key"])

    # about len(listed) / sqrt(2) keys, whatever the universe's size
    other = {r.key for r in universe.select("key").mapInArrow(passing, "key string").collect()}
    inside.unpersist()
    own = listed
    while other:
        levels.append(Bloom(other, len(other), 0.5, len(levels)))
        own, other = other, {k for k in own if k in levels[-1]}
        if len(levels) > 64:
            raise ValueError("the cascade does not end")
    return Cascade(levels)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) after the first ``://``; A-Z of the host lower-cased."""
    if not url:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    ends = [i for i in (rest.find(c) for c in "?#") if i >= 0]
    rest = rest[:min(ends)] if ends else rest
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def candidate_keys(host: str, path: str, lengths: tuple[int, ...], depth: int) -> list[tuple[str, str]]:
    """(host suffix of up to ``depth`` labels, path beginning) pairs, the
    longest first; a suffix of more labels than any listed host is no listed key."""
    if not host or not depth:
        return []
    labels = host.rsplit(".", depth)[-depth:]
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    pairs = [(h, path[:n]) for h in hosts for n in lengths if n <= len(path)]
    return sorted(pairs, key=lambda k: (-len(k[0]) - len(k[1]), -len(k[0])))


def judge_urls(pages: DataFrame, rules: Iterable[Rule], blocked_hosts: Iterable[str] = ()) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` of every row.

    A rule fits its host and all subdomains if the path starts with the
    rule's; the longest (host and path together, then host) wins.  Without a
    rule the verdict is block for hosts in or below ``blocked_hosts`` and else
    allow.  A null url, or one without ``://``, has an empty host and path and
    fits nothing; repeated rows stay repeated; a null ``page_id`` stays null;
    other columns are not read.
    """
    rules = list(rules)
    verdicts = {v: [r for r in rules if r.verdict == v] for v in ("allow", "block")}
    if len(verdicts["allow"]) + len(verdicts["block"]) != len(rules):
        raise ValueError("a verdict is allow or block")
    if {r.key for r in verdicts["allow"]} & {r.key for r in verdicts["block"]}:
        raise ValueError("two rules with one host and path disagree")
    lengths = tuple(sorted({len(r.path) for r in rules}))
    blocked_hosts = list(blocked_hosts)
    depth = max((h.count(".") + 1 for h in [*(r.host for r in rules), *blocked_hosts]), default=0)
    asked = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for host, path in {split_url(u) for u in batch.column(1).to_pylist()}:
                found.update(f"r{h}{p}" for h, p in candidate_keys(host, path, lengths, depth))
                found.update(f"h{h}" for h, _ in candidate_keys(host, "", (0,), depth))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["key"])

    universe = store(asked.mapInArrow(keys, "key string").distinct(), "url-keys")
    lists = {"allow": [f"r{r.key}" for r in verdicts["allow"]],
             "block": [f"r{r.key}" for r in verdicts["block"]],
             "hosts": [f"h{h}" for h in blocked_hosts]}
    cascades = {name: build_cascade(universe, listed, name) for name, listed in lists.items()}
    shared = pages.sparkSession.sparkContext.broadcast(cascades)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allow, block, hosts = (shared.value[x] for x in ("allow", "block", "hosts"))
        for batch in batches:
            known: dict[tuple[str, str], tuple[str | None, str]] = {}

            def verdict(host: str, beginning: str) -> tuple[str | None, str]:
                if (host, beginning) not in known:
                    for h, p in candidate_keys(host, beginning, lengths, depth):
                        if f"r{h}{p}" in allow:
                            known[host, beginning] = (h + p, "allow")
                            break
                        if f"r{h}{p}" in block:
                            known[host, beginning] = (h + p, "block")
                            break
                    else:
                        spam = any(f"h{h}" in hosts for h, _ in candidate_keys(host, "", (0,), depth))
                        known[host, beginning] = (None, "block" if spam else "allow")
                return known[host, beginning]

            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            longest = lengths[-1] if lengths else 0
            found = [verdict(h, p[:longest]) for h, p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.string()) for c in (
                    [h for h, _ in parts], [p for _, p in parts], [r for r, _ in found], [v for _, v in found]))],
                [x.split()[0] for x in SCHEMA.split(", ")])

    return asked.mapInArrow(judge, SCHEMA)
