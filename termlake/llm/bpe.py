"""Byte-level BPE by speculation: propose by longest match, verify pairs, merge only what fails.

A split of a word into tokens equals its BPE encoding exactly when every token
encodes to itself and every two neighbours stay apart when encoded together.
So distinct words are first cut greedily into longest vocabulary entries, then
all neighbouring pairs of a batch are tested at once by walking both merge trees
back in time, and only words with a failing pair are merged step by step.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from copy import copy
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import map_rows, texts_of

# Fixed values of byte-level BPE: the word pattern, and the printable stand-ins of bytes.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# The same pattern for texts of Latin letters only, which the plainer engine reads faster.
WIDE = r"[^\x00-\u024f]"
NARROW_WORD = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+| ?[0-9\xb2\xb3\xb9\xbc-\xbe]+"
    r"| ?[^\t-\r \x85\xa0A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f0-9\xb2\xb3\xb9\xbc-\xbe]+"
    r"|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+"
)

LONG_WORD = 200
CACHED_WORDS = 150_000
NEVER = np.int64(1) << 40


def byte_symbols() -> dict[str, int]:
    """Stand-in character -> byte; bytes without a printable form follow from U+0100 on."""
    table = {chr(b): b for b in PRINTABLE}
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    table.update({chr(0x100 + i): b for i, b in enumerate(others)})
    return table


class Bpe:
    """Vocabulary, merge trees and a cache of encoded words of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, symbols = spec["model"], byte_symbols()
        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special = special
        raw = {bytes(symbols[c] for c in s): i for s, i in model["vocab"].items() if s not in special}
        size = max([*raw.values(), *special.values()]) + 1
        self.bytes_of = [b""] * size
        for b, i in raw.items():
            self.bytes_of[i] = b
        for s, i in special.items():
            self.bytes_of[i] = s.encode()
        self.byte_ids = np.array([raw[bytes([b])] for b in range(256)], np.int64)

        # Rank of the merge that makes a token (-1: a byte) and its two parts.
        self.rank = np.full(size, -1, np.int64)
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        self.made = np.zeros(len(model["merges"]), np.int64)
        keys = np.zeros(len(model["merges"]), np.int64)
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = (bytes(symbols[c] for c in x) for x in (a, b))
            i, j, made = raw[a], raw[b], raw[a + b]
            keys[r], self.made[r] = i << 32 | j, made
            self.rank[made], self.left[made], self.right[made] = r, i, j
        self.pair_ranks = np.argsort(keys)
        self.pair_keys = keys[self.pair_ranks]

        # Only tokens that encode to themselves may be proposed.
        made = np.flatnonzero(self.rank >= 0)
        whole = self.rank < 0
        whole[made] = self.apart(self.left[made], self.right[made], self.rank[made])
        for i in made[np.argsort(self.rank[made])]:
            whole[i] &= whole[self.left[i]] and whole[self.right[i]]
        self.rank_of = {(k >> 32, k & 0xFFFFFFFF): r for r, k in enumerate(keys.tolist())}
        self.grow_trie({b: i for b, i in raw.items() if whole[i]})

        self.pattern, self.narrow, self.wide = regex.compile(WORD), re.compile(NARROW_WORD), re.compile(WIDE)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.cache: dict[str, tuple[int, ...]] = {}
        self.checked = self.failed = 0

    def fresh(self) -> Bpe:
        """The same tables with an empty cache, which goes with its task."""
        own = copy(self)
        own.cache = {}
        return own

    def grow_trie(self, tokens: dict[bytes, int]) -> None:
        """Transitions sorted by (node, byte), for lookups of many at once."""
        nodes: dict[bytes, int] = {b"": 0}
        edges = []
        for b in sorted(tokens):
            for n in range(1, len(b) + 1):
                if b[:n] not in nodes:
                    nodes[b[:n]] = len(nodes)
                    edges.append((nodes[b[: n - 1]] << 8 | b[n - 1], nodes[b[:n]]))
        edges.sort()
        self.trie_keys, self.trie_next = np.array(edges, np.int64).T.copy()
        self.trie_token = np.full(len(nodes), -1, np.int64)
        for b, i in tokens.items():
            self.trie_token[nodes[b]] = i

    def apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE leaves tokens ``a`` and ``b`` unmerged when they stand together.

        Time is counted in merge ranks. Walking back, the later of the two
        tokens is undone; each two that stood together at some time must not have
        been mergeable before one of them was used up. Of equal merges the left
        one comes first, so the right token is undone first and a merge of the
        rank that uses up the right token still counts. ``before`` limits the time.
        """
        a, b = a.copy(), b.copy()
        end_a = np.full(len(a), NEVER) if before is None else before.copy()
        end_b = np.full(len(a), NEVER) if before is None else before - 1
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            rank = self.pair_rank(x, y)
            bad = (rank < end_a[live]) & (rank <= end_b[live]) & (rank < NEVER)
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            first = go & (rx > ry)
            second = go & ~first
            end_a[live[first]] = rx[first]
            a[live[first]] = self.right[x[first]]
            end_b[live[second]] = ry[second]
            b[live[second]] = self.left[y[second]]
            live = live[go]
        return good

    def longest_match(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy cut of each word into longest vocabulary entries: tokens and
        the word each belongs to, in order. All words walk the trie together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        end = np.cumsum(sizes)
        at = end - sizes
        word, end = np.arange(len(words)), end.copy()
        node, best, resume = np.zeros(len(words), np.int64), np.full(len(words), -1), at.copy()
        tokens, owners = [], []
        while len(word):
            here = np.minimum(at, len(text) - 1)
            keys = node << 8 | text[here]
            slot = np.minimum(np.searchsorted(self.trie_keys, keys), len(self.trie_keys) - 1)
            goes = (at < end) & (self.trie_keys[slot] == keys)
            node = np.where(goes, self.trie_next[slot], 0)
            at = np.where(goes, at + 1, resume)
            token = np.where(goes, self.trie_token[node], -1)
            tokens.append(best[~goes])
            owners.append(word[~goes])
            best = np.where(token >= 0, token, np.where(goes, best, -1))
            resume = np.where(token >= 0, at, resume)
            left = (at < end) | (node > 0)
            if not left.all():
                word, end, node, best, resume, at = (x[left] for x in (word, end, node, best, resume, at))
        flat, owner = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return flat[order], owner[order]

    def long_word(self, word: bytes) -> list[int]:
        """The merges of one long word, taken from a heap over a linked list."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        first = self.pair_rank(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first < NEVER).tolist()]
        heapq.heapify(heap)
        while heap:
            rank, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = int(self.made[rank]), -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n:
                    rank = self.rank_of.get((ids[left], ids[right]))
                    if rank is not None:
                        heapq.heappush(heap, (rank, left, ids[left], ids[right]))
        return [t for t in ids if t >= 0]

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def exact(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The merges of each word in order of rank, from the left among equals.

        All words take a step together: each merges every occurrence of its own
        lowest pair. What that makes can only be part of later merges.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        result: list[tuple[int, ...]] = [()] * len(words)

        def ranks(at: np.ndarray) -> np.ndarray:
            found = np.full(len(at), NEVER)
            inner = at[at + 1 < len(ids)]
            same = inner[owner[inner] == owner[inner + 1]]
            found[np.isin(at, same, assume_unique=True)] = self.pair_rank(ids[same], ids[same + 1])
            return found

        rank = ranks(np.arange(len(ids)))
        while len(ids):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(ids)]))
            over = lowest == NEVER
            if over.any():
                done, whose = ids[over], owner[over]
                cuts = np.flatnonzero(np.r_[True, whose[1:] != whose[:-1], True]).tolist()
                tokens, names = done.tolist(), whose[cuts[:-1]].tolist()
                for i, begin, stop in zip(names, cuts, cuts[1:]):
                    result[i] = tuple(tokens[begin:stop])
                ids, owner, rank, lowest = ids[~over], owner[~over], rank[~over], lowest[~over]
                if not len(ids):
                    break
            hit = rank == lowest
            place = np.arange(len(ids))
            run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            first = np.flatnonzero(hit & ((place - run) % 2 == 0))
            ids[first] = self.made[rank[first]]
            keep = np.ones(len(ids), bool)
            keep[first + 1] = False
            moved = first - np.arange(len(first))
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            touched = np.unique(np.r_[moved, moved[moved > 0] - 1])
            rank[touched] = ranks(touched)
        return result

    def learn(self, words: set[str]) -> None:
        """Encode distinct words into the cache, all pairs verified together."""
        long = [w for w in words if len(w) > LONG_WORD]
        self.cache.update((w, tuple(self.long_word(w.encode()))) for w in long)
        words = list(words.difference(long))
        if not words:
            return
        raw = [w.encode() for w in words]
        flat, owner = self.longest_match(raw)
        inside = owner[1:] == owner[:-1]
        good = self.apart(flat[:-1][inside], flat[1:][inside])
        failing = np.zeros(len(words), bool)
        failing[owner[1:][inside][~good]] = True
        self.checked += len(words)
        self.failed += int(failing.sum())
        ids = flat.tolist()
        ends = np.cumsum(np.bincount(owner, minlength=len(words))).tolist()
        proposed = [tuple(ids[i:j]) for i, j in zip([0, *ends], ends)]
        wrong = np.flatnonzero(failing).tolist()
        for i, tokens in zip(wrong, self.exact([raw[i] for i in wrong])):
            proposed[i] = tokens
        self.cache.update(zip(words, proposed))

    def split(self, text: str) -> list[str | int]:
        """Words of a text and, as ids, the special tokens that it spells out."""
        pattern = self.pattern if self.wide.search(text) else self.narrow
        if self.cut is None or not any(s in text for s in self.special):
            return pattern.findall(text)
        parts: list[str | int] = []
        for piece in self.cut.split(text):
            if piece in self.special:
                parts.append(self.special[piece])
            else:
                parts.extend(pattern.findall(piece))
        return parts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.split(text) for text in texts]
        words = set().union(*cut).difference(self.special.values())
        unknown = words.difference(self.cache)
        if len(self.cache) + len(unknown) > CACHED_WORDS:
            self.cache = {w: self.cache[w] for w in words - unknown}
        if unknown:
            self.learn(unknown)
        self.cache.update((i, (i,)) for i in self.special.values())
        get, flatten = self.cache.__getitem__, chain.from_iterable
        return [np.fromiter(flatten(map(get, parts)), "<u4") for parts in cut]

    def decode(self, ids: np.ndarray) -> str:
        of = self.bytes_of
        return b"".join([of[i] for i in ids.tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Token ids of every text, as ``(doc_id, ids array<int>)``; null text: no ids.

    Rows are treated one by one: null ids, repeated rows and further columns of
    any name make no difference.
    """

    def make():
        bpe = load(path).fresh()
        return lambda batch: zip(batch.column(0).to_pylist(), (i.tolist() for i in bpe.encode(texts_of(batch.column(1)))))

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, ids array<int>", make)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of ``(doc_id, ids)``; null ids: empty text."""

    def make():
        bpe = load(path)

        def run(batch):
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield doc, bpe.decode(np.array(ids or [], np.int64))

        return run

    return map_rows(encoded.select("doc_id", "ids"), "doc_id bigint, text string", make)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per row ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encoded, then decoded again."""

    def make():
        bpe = load(path).fresh()

        def run(batch):
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode(texts_of(batch.column(1)))):
                decoded = hashlib.sha256(bpe.decode(ids).encode()).hexdigest()
                yield doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded

        return run

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_rows(docs.select("doc_id", "text"), schema, make)


def token_count(text: Column, path: str) -> Column:
    """Number of tokens of a text column (null: 0), beside any other columns."""
    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([len(bpe.encode([t or ""])[0]) for t in texts], dtype="int64")

    return run(text)
