"""Byte-level BPE encoding and decoding by monoid tree reduction.

Encodings form a monoid: the encoding of a concatenation follows from the encodings of its parts
by mending the seam. :meth:`ByteBpe.encode` halves a piece, encodes the halves, and joins them.
Joining re-encodes a window around the seam, first one token on either side, and widens the window
until the tokens outside cannot change.

Why that is enough: a token sequence is the encoding of its bytes exactly when every two neighbours
``a, b`` are themselves the encoding of ``bytes(a) + bytes(b)``, since a merge across a token
border would already happen within those two tokens. Inside the halves and inside the re-encoded
window all neighbours fulfil this, so only the window's two outer seams need the test.
A failing side doubles its tokens in the window; at the worst the window is the whole piece, which is
then merged by the definition.

Decoding concatenates the tokens' bytes pairwise up the same tree.

Text is cut by the tokenizer's pattern first; each match is encoded on its own. Matches never span
a change from non-space to space, so a text is cut there at once and each distinct run is matched
and encoded once per worker process, within a bounded cache.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow.llm.rows import Memo, map_texts

#: Bytes up to which a piece or window is merged directly (the tree's leaf).
LEAF_BYTES = 6
#: Entries of each cache generation.
CACHE = 150_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class ByteBpe:
    """Encoder and decoder for one rank table and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int = CACHE):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.odd_space = re.compile(r" \s|\s |^\s")
        self.pieces, self.runs, self.seams = Memo(cache), Memo(cache), Memo(cache)

    # -- encoding -----------------------------------------------------------------------------

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Lowest rank first, leftmost among equals: the definition."""
        ranks = self.ranks
        if len(data) > 64:
            return self.merge_heap(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def merge_heap(self, data: bytes) -> tuple[int, ...]:
        """:meth:`merge` in n log n steps, for windows that grew to a whole long piece."""
        ranks, n = self.ranks, len(data)
        part, after, before = [data[i:i + 1] for i in range(n)], [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            k = after[i]
            if part[i] is None or k < 0 or len(part[i]) + len(part[k]) != size:
                continue
            part[i], part[k], after[i] = part[i] + part[k], None, after[k]
            if after[i] >= 0:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and (y := after[x]) >= 0 and (r := ranks.get(part[x] + part[y])) is not None:
                    heapq.heappush(heap, (r, x, len(part[x]) + len(part[y])))
        return tuple(ranks[p] for p in part if p is not None)

    def seam(self, a: int, b: int) -> tuple[int, ...]:
        """Encoding of two tokens' joint bytes."""
        memo, key = self.seams, (a, b)
        got = memo.young.get(key)
        return got or memo.put(key, memo.old.get(key) or self.merge(self.bytes_of[a] + self.bytes_of[b]))

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The monoid operation: the encoding of the concatenated bytes."""
        if not left or not right:
            return left or right
        i, j = 1, 1
        window = self.seam(left[-1], right[0])
        while True:
            steady = True
            if i < len(left) and (i > 1 or window[0] != left[-1]) and self.seam(left[-i - 1], window[0]) != (left[-i - 1], window[0]):
                i, steady = min(2 * i, len(left)), False
            if j < len(right) and (j > 1 or window[-1] != right[0]) and self.seam(window[-1], right[j]) != (window[-1], right[j]):
                j, steady = min(2 * j, len(right)), False
            if steady:
                return left[:-i] + window + right[j:]
            window = self.encode(self.concat(left[-i:] + right[:j]), whole=len(left) == i and len(right) == j)

    def encode(self, piece: bytes, whole: bool = False) -> tuple[int, ...]:
        """Token ids of one pattern match (``whole``: merge directly, the widest window)."""
        if (r := self.ranks.get(piece)) is not None:
            return (r,)
        memo = self.pieces
        got = memo.young.get(piece)
        if got is None:
            got = memo.old.get(piece)
            if got is None:
                if whole or len(piece) <= LEAF_BYTES:
                    got = self.merge(piece)
                else:
                    half = len(piece) >> 1
                    half -= half & 63 if half > 64 else 0  # long runs of one character then tile alike on both sides
                    got = self.join(self.encode(piece[:half]), self.encode(piece[half:]))
            if len(piece) <= 64:
                memo.put(piece, got)
        return got

    def run(self, text: str) -> bytes:
        """Packed ids of a stretch of text: every pattern match encoded on its own."""
        out: list[int] = []
        for piece in self.pattern.findall(text):
            out.extend(self.encode(piece.encode()))
        return np.array(out, "<u4").tobytes()

    def encode_text(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.odd_space.search(text):
            return self.run(text)
        first, *rest = text.split(" ")
        memo, out = self.runs, [self.run(first)]
        young, old = memo.young, memo.old
        for word in rest:
            ids = young.get(word)
            if ids is None:
                ids = old.get(word) or self.run(" " + word)
                if len(word) <= 64:
                    memo.put(word, ids)
                    young, old = memo.young, memo.old
            out.append(ids)
        return b"".join(out)

    # -- decoding -----------------------------------------------------------------------------

    def concat(self, ids: Sequence[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids: leaves of 4096 tokens concatenated, then pairwise up the tree."""
        ids = memoryview(packed).cast("I").tolist()
        level = [self.concat(ids[i:i + 4096]) for i in range(0, len(ids), 4096)] or [b""]
        while len(level) > 1:
            level = [b"".join(level[i:i + 2]) for i in range(0, len(level), 2)]
        return level[0]


def _codec(shared) -> ByteBpe:
    """The worker process's codec: broadcast values live as long as the process, and so do its caches."""
    state = shared.value
    if "codec" not in state:
        state["codec"] = ByteBpe(state["ranks"], state["pattern"])
    return state["codec"]


def encode_decode(df: DataFrame, ranks_path: str, pattern: str, keep: Sequence[str] = ("doc_id",),
                  text: str = "text") -> DataFrame:
    """``keep`` plus ``ids`` (packed little-endian uint32) and ``decoded`` (the bytes they stand for).

    Null and empty texts give empty binaries. Every row is encoded whole, repeated rows each on
    their own; text that looks like a special token is ordinary text. An empty table gives an empty
    result; columns outside ``keep`` and ``text`` are ignored. The rank table is read on the driver
    and broadcast: its size is that of the vocabulary file, whatever the corpus.
    """
    shared = df.sparkSession.sparkContext.broadcast({"ranks": load_ranks(ranks_path), "pattern": pattern})

    def make():
        codec = _codec(shared)

        def row(data: bytes):
            ids = codec.encode_text(data.decode("utf-8", "replace"))
            return ids, codec.decode(ids)

        return row

    return map_texts(df, keep, text, make, [("ids", "binary"), ("decoded", "binary")])


def digests(encoded: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Token count and SHA-256 digests of :func:`encode_decode`'s columns."""
    return encoded.select(
        *[F.col(f"`{k}`") for k in keep],
        (F.octet_length("ids") / F.lit(4)).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
