"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of text exactly one token can be the last token
of the prefix's encoding.  The state is that array of last tokens; walking
it back from the end gives the ids.  Appending bytes only adds states, and
an edit only recomputes states from the edit on, until they agree again with
the old ones over the length of the longest token.

A token ``t`` that ends at byte ``i`` is the last token there exactly when
the pair (last token at the start of ``t``, ``t``) is the encoding of its own
bytes; the pair test undoes merges on both sides and looks for a merge
across the border that would have come first.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
CACHE_ENTRIES = 300_000
PAIR_ENTRIES = 400_000


class PrefixBpe:
    """Encoder over a rank file (token bytes -> id, lower ids merge first)."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.bytes_of[i] = token
        self.longest = max(map(len, self.ids))
        # finds all tokens that end at a byte, longest first
        self.ending = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.ending.add_word(token.decode("latin-1"), (i, len(token)))
        self.ending.make_automaton()
        self.pattern = regex.compile(pattern)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._words: dict[str, bytes] = {}  # word -> its ids as decimals
        self.decimals = [b"%d" % i for i in range(len(self.bytes_of))]
        self.by_decimal = {b"%d" % i: token for token, i in self.ids.items()}

    # -- tokens as merges ------------------------------------------------
    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for one byte."""
        if token not in self._halves:
            word = self.bytes_of[token]
            parts = [word[i:i + 1] for i in range(len(word))]
            while len(parts) > 2:
                rank, i = min((self.ids.get(a + b, 1 << 40), i)
                              for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank >= token:
                    raise ValueError(f"token {token} is not made of earlier merges")
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self._halves[token] = (self.ids[parts[0]], self.ids[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def stands(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their joined bytes."""
        key = (left, right)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIR_ENTRIES:
                self._pairs.clear()
            known = self._pairs[key] = self._stands(left, right)
        return known

    def _stands(self, left: int, right: int) -> bool:
        # History is replayed backwards: the later of the two border tokens'
        # last merges is undone; before it, a merge across the border of
        # lower rank would have happened first.
        before = 1 << 40
        while True:
            across = self.ids.get(self.bytes_of[left] + self.bytes_of[right])
            if across is not None and across < before:
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            # of equal merges the left one comes first, so the right is undone first
            if b is None or (a is not None and left > right):
                before, left = left, a[1]
            else:
                before, right = right + 1, b[0]

    # -- prefix states ---------------------------------------------------
    def append(self, piece: bytes, states: list[int] | None = None) -> list[int]:
        """The last token of every prefix of ``piece`` (index 0 is unused);
        ``states`` are those of a known prefix of it, which stay as they are."""
        states = [-1] if states is None else list(states)
        done, pairs = len(states) - 1, self._pairs
        states += [-1] * (len(piece) - done)
        skip = max(0, done - self.longest)  # no token reaches further back
        for end, (token, length) in self.ending.iter(piece[skip:].decode("latin-1")):
            end += skip + 1
            if end <= done:
                continue
            start = end - length
            if start:
                left = states[start]
                stands = pairs.get((left, token))
                if stands is None:
                    stands = self.stands(left, token)
                if not stands:
                    continue
            states[end] = token
            done = end
        if done < len(piece):
            raise ValueError("the vocabulary lacks a byte")
        return states

    def edit(self, old: bytes, states: list[int], at: int, removed: int, inserted: bytes) -> tuple[bytes, list[int]]:
        """The piece with ``removed`` bytes at ``at`` replaced, and its states.
        States before the edit are kept; behind it they are computed until
        they agree with the old ones over the longest token's length."""
        new = old[:at] + inserted + old[at + removed:]
        shift, fresh, same = len(inserted) - removed, states[:at + 1], 0
        for end in range(at + 1, len(new) + 1):
            fresh = self.append(new[:end], fresh) if end >= len(fresh) else fresh
            behind = end - shift
            if end > at + len(inserted) and behind > 0 and fresh[end] == states[behind]:
                same += 1
                if same >= self.longest:
                    return new, fresh + states[behind + 1:]
            else:
                same = 0
        return new, fresh

    def tokens(self, states: list[int]) -> list[int]:
        out, end = [], len(states) - 1
        while end > 0:
            out.append(states[end])
            end -= len(self.bytes_of[states[end]])
        return out[::-1]

    # -- texts -----------------------------------------------------------
    def piece_ids(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8")
        whole = self.ids.get(raw)
        return [whole] if whole is not None else self.tokens(self.append(raw))

    def decimal(self, text: str) -> bytes:
        """The ids of every match of the pattern as decimals joined by one
        space.  A single space before a visible character always begins a
        match, so the text is looked up word by word; a text with other
        spacing is matched whole."""
        if not text:
            return b""
        if _ODD_SPACE.search(text):
            words = self.pattern.findall(text)
        else:
            words = (" " + text).replace(" ", "\0 ").split("\0")[1:] if "\0" not in text \
                else [" " + w for w in text.split(" ")]
            if words[0] == " ":
                del words[0]
            else:
                words[0] = words[0][1:]
        known = self._words
        return b" ".join([known.get(w) or self._learn(w) for w in words])

    def _learn(self, word: str) -> bytes:
        known, parts = self._words, []
        for piece in self.pattern.findall(word):
            parts.append(known.get(piece) or b" ".join([self.decimals[i] for i in self.piece_ids(piece)]))
        ids = b" ".join(parts)
        if len(word) <= 64:
            if len(known) >= CACHE_ENTRIES:
                known.clear()
            known[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.decimal(text).split()]

    def decode(self, ids) -> bytes:
        of = self.bytes_of
        return b"".join([of[i] for i in ids])

    def decode_decimal(self, ids: bytes) -> bytes:
        return b"".join(map(self.by_decimal.__getitem__, ids.split()))


_ODD_SPACE = regex.compile(r" (?=\s|\p{Z}|\Z)")
_ENCODERS: dict[tuple[str, str], PrefixBpe] = {}


def encoder(path: str, pattern: str = public_tokenizers.PATTERN) -> PrefixBpe:
    """One encoder a Python worker, kept between tasks."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = PrefixBpe(path, pattern)
    return _ENCODERS[path, pattern]


def encode_decode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN,
                  with_ids: bool = True) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded_sha256`` of every row.

    The ids follow the rank file at ``path`` (the same path on every
    machine), special strings are ordinary text.  A null or empty text has no
    ids; a null ``doc_id`` stays null; repeated rows stay repeated; other
    columns are not read.  ``with_ids=False`` leaves the id arrays out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = [bpe.decimal(t) if t else b"" for t in part.column(1).to_pylist()]
                counts = [r.count(b" ") + 1 if r else 0 for r in rows]
                columns = [part.column(0)]
                if with_ids:
                    flat = np.array(b" ".join(rows).split(), np.int32)
                    ends = np.cumsum([0, *counts])
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
                columns += [
                    pa.array(counts, pa.int64()),
                    pa.array([hashlib.sha256(r).hexdigest() for r in rows], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode_decimal(r)).hexdigest() for r in rows], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [x.split()[0] for x in SCHEMA.split(", ") if with_ids or not x.startswith("ids ")]
    schema = ", ".join(x for x in SCHEMA.split(", ") if with_ids or not x.startswith("ids "))
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)
