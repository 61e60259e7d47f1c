"""Problem 8: encode a corpus with a public byte-level BPE vocabulary.

Method: pair occurrence index.  The distinct pre-tokens of a batch are laid out in one flat array of byte ids.  A
map holds, for each adjacent pair that has a rank, all its positions; the lowest active rank is taken first, all
its occurrences are merged from left to right, and the lists of the pairs that appear around each merge are
updated.  Since every pre-token is merged lowest rank first and pairs of equal rank from the left, the result is
that of the tokenizer itself.

The vocabulary file is a parameter and is read on each worker; it is never part of this repository.  Empty and
null texts have an empty list.  No special tokens: their strings are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the vocabulary's family.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class PairIndexEncoder:
    """Encoder of one worker.  ``keep`` bounds the memory of known pre-tokens; beyond it they are encoded again."""

    def __init__(self, vocabulary: str = VOCABULARY, pattern: str = PATTERN, keep: int = 200_000) -> None:
        with open(vocabulary, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.byte_id = [self.ranks[bytes([b])] for b in range(256)]
        self.split = regex.compile(pattern).findall
        self.keep = keep
        self.known: dict[str, list[int]] = {}
        self.pair_rank: dict[tuple[int, int], int] = {}

    def _rank(self, a: int, b: int) -> int:
        """The rank (and id) of a pair, or -1."""
        got = self.pair_rank.get((a, b))
        if got is None:
            got = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1)
            if len(self.pair_rank) < 1_000_000:
                self.pair_rank[a, b] = got
        return got

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """The ids of each word: one index over all of them."""
        ids: list[int] = []
        starts = []
        for w in words:
            starts.append(len(ids))
            raw = w.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(raw)
            ids += [whole] if whole is not None and len(raw) == 1 else [self.byte_id[b] for b in raw]
            ids.append(-1)  # a wall between words
        n = len(ids)
        prev = list(range(-1, n - 1))
        nxt = list(range(1, n + 1))
        at: dict[int, list[int]] = defaultdict(list)  # rank -> left positions of its occurrences
        rank = self._rank
        for i in range(n - 1):
            a, b = ids[i], ids[i + 1]
            if a >= 0 and b >= 0 and (r := rank(a, b)) >= 0:
                at[r].append(i)
        active = list(at)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            spots = at.pop(r, None)
            if spots is None:
                continue
            spots.sort()
            for i in spots:
                if ids[i] < 0:
                    continue
                j = nxt[i]
                # The occurrence may have been used up by an overlapping merge.
                if j >= n or ids[j] < 0 or rank(ids[i], ids[j]) != r:
                    continue
                ids[i] = r
                ids[j] = -2
                k = nxt[j]
                nxt[i] = k
                if k < n:
                    prev[k] = i
                    if ids[k] >= 0 and (q := rank(r, ids[k])) >= 0:
                        if q not in at:
                            heapq.heappush(active, q)
                        at[q].append(i)
                h = prev[i]
                if h >= 0 and ids[h] >= 0 and (q := rank(ids[h], r)) >= 0:
                    if q not in at:
                        heapq.heappush(active, q)
                    at[q].append(h)
        out = []
        for s in starts:
            one, i = [], s
            while ids[i] != -1:
                one.append(ids[i])
                i = nxt[i]
            out.append(one)
        return out

    def encode_batch(self, texts: Iterable[str | None]) -> list[list[int]]:
        known = self.known
        split = [self.split(t) if t else [] for t in texts]
        new = list({w for ws in split for w in ws if w not in known})
        fresh = dict(zip(new, self.merge_all(new))) if new else {}
        room = self.keep - len(known)
        if room > 0:
            known.update(list(fresh.items())[:room])
        out = []
        for ws in split:
            ids: list[int] = []
            for w in ws:
                got = known.get(w)
                ids += fresh[w] if got is None else got
            out.append(ids)
        return out


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY) -> PairIndexEncoder:
    return PairIndexEncoder(vocabulary)


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids): one row per row of ``df``; a narrow map, no shuffle."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(vocabulary)
        for p in parts:
            for i in range(0, len(p), 512):
                q = p.iloc[i : i + 512]
                yield pd.DataFrame({key: q["k"], "ids": e.encode_batch(t if isinstance(t, str) else None for t in q["t"])})

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"{key} {kind}, ids array<int>")
