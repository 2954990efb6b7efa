"""Byte-level BPE encoding of whole corpora with a public vocabulary."""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public tokenizers; overridden by the caller or the environment.
TOKENIZERS = os.environ.get("CIVICLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's texts were cut into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pre-tokens a worker remembers; beyond it starts afresh. It bounds memory, not results.
MEMO = 200_000


def _mix(words: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    """A 64-bit mix of 64-bit keys under a seed."""
    with np.errstate(over="ignore"):
        x = words ^ (np.asarray(seed, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _prints(tokens: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in tokens), dtype=np.uint64, count=len(tokens))


class PerfectHash:
    """A minimal perfect hash of a fixed set of byte strings, by hashing into buckets and displacing them.

    Every key has a slot of its own in 0..n-1. A string that isn't a key also gets a slot; the stored key
    there tells it apart.
    """

    def __init__(self, keys: list[bytes], values: list[int], load: int = 2) -> None:
        n = len(keys)
        self.n, self.buckets = n, max(1, n // load)
        prints = _prints(keys)
        home = (_mix(prints, 0) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        starts = np.searchsorted(home[order], np.arange(self.buckets + 1))
        sizes = np.diff(starts)
        #: Per bucket the seed under which its keys fall on free slots; for one key alone, -1 - slot.
        self.seeds = np.zeros(self.buckets, dtype=np.int64)
        taken = np.zeros(n, dtype=bool)
        slots = np.zeros(n, dtype=np.int64)
        largest_first = np.argsort(-sizes, kind="stable")
        for b in largest_first[sizes[largest_first] > 1]:
            mine = order[starts[b] : starts[b + 1]]
            seed = 1
            while True:
                tried = np.arange(seed, seed + 16, dtype=np.uint64)[:, None]
                at = (_mix(prints[mine][None, :], tried) % np.uint64(n)).astype(np.int64)
                line = np.sort(at, axis=1)
                fits = ~taken[at].any(axis=1) & (line[:, 1:] != line[:, :-1]).all(axis=1)
                if fits.any():
                    k = int(np.argmax(fits))
                    break
                seed += 16
            self.seeds[b] = seed + k
            taken[at[k]] = True
            slots[mine] = at[k]
        single = np.flatnonzero(sizes == 1)
        free = np.flatnonzero(~taken)
        self.seeds[single] = -1 - free[: len(single)]
        slots[order[starts[single]]] = free[: len(single)]
        self.keys: list[bytes] = [b""] * n
        self.values = np.zeros(n, dtype=np.int32)
        for key, value, slot in zip(keys, values, slots.tolist()):
            self.keys[slot] = key
            self.values[slot] = value

    def find(self, tokens: list[bytes]) -> list[int]:
        """The value of each token, -1 for what isn't a key."""
        if not tokens:
            return []
        prints = _prints(tokens)
        seeds = self.seeds[(_mix(prints, 0) % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(seeds < 0, -1 - seeds, (_mix(prints, seeds.astype(np.uint64)) % np.uint64(self.n)).astype(np.int64))
        keys = self.keys
        return [v if keys[s] == t else -1 for s, t, v in zip(slots.tolist(), tokens, self.values[slots].tolist())]


def merge_bytes(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: the pair of neighbours of the lowest rank merges first, the leftmost on a tie.

    The parts are a doubly linked list and the mergeable pairs wait in a heap, so a pre-token of n
    bytes costs n log n, however long it is.
    """
    n = len(token)
    ends = list(range(1, n + 1))
    before, after, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(token[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = after[i]
        if j < 0 or ends[j] != end:
            continue
        ends[i], alive[j], after[i] = end, False, after[j]
        k = after[i]
        if k >= 0:
            before[k] = i
            if (r := ranks.get(token[i : ends[k]])) is not None:
                heapq.heappush(heap, (r, i, ends[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get(token[h:end])) is not None:
            heapq.heappush(heap, (r, h, end))
    ids, i = [], 0
    while i >= 0:
        ids.append(ranks[token[i : ends[i]]])
        i = after[i]
    return ids


class Encoder:
    """Texts to ids: whole pre-tokens of the vocabulary by the perfect hash, the rest by merging."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.table = PerfectHash(list(self.ranks), list(self.ranks.values()))
        self.cut = regex.compile(PATTERN).findall
        self.memo: dict[str, list[int]] = {}

    def _learn(self, words: list[str]) -> None:
        tokens = [w.encode("utf-8", "replace") for w in words]
        for word, token, value in zip(words, tokens, self.table.find(tokens)):
            self.memo[word] = [value] if value >= 0 else merge_bytes(token, self.ranks)

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text; null and empty texts have none."""
        cut = [self.cut(t) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo = {}
        unknown = {w for words in cut for w in words} - self.memo.keys()
        self._learn(list(unknown))
        memo = self.memo
        return [[i for w in words for i in memo[w]] for words in cut]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, built once per worker."""
    return Encoder(path)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", tokenizers: str | None = None, vocabulary: str = VOCABULARY, counts_only: bool = False, slice_texts: int = 64) -> DataFrame:
    """``docs`` with the column ``ids`` (array<int>, or the number of ids) in place of ``text``.

    Null, empty: the empty list (0). White space is text like any other. Whole texts are encoded; a text
    that isn't valid Unicode has its stray halves replaced. Repeated rows stay. Column ``ids`` is
    replaced if present. Narrow: no shuffle. Batches are encoded in slices of ``slice_texts`` so that
    memory doesn't grow with the batch.
    """
    path = os.path.join(tokenizers or TOKENIZERS, vocabulary)
    kept = [c for c in docs.columns if c not in (text, ids)]
    kind = "int" if counts_only else "array<int>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for batch in batches:
            for at in range(0, len(batch), slice_texts):
                part = batch.iloc[at : at + slice_texts]
                found = own.encode_batch([t if isinstance(t, str) else None for t in part[text]])
                out = part[kept].copy()
                out[ids] = [len(x) for x in found] if counts_only else found
                yield out

    return docs.select(*kept, F.col(text)).mapInPandas(run, f"{schema}, `{ids}` {kind}")
