"""Token counts of a sentence-piece BPE model by heap-and-linked-list merging.

The symbols of a text (its code points, spaces written as U+2581, one such mark in front) form a
linked list; a heap holds the adjacent pairs that are vocabulary pieces, best score first, leftmost
among equals. Popping a pair merges its two symbols and pushes the pairs with the new neighbours;
pairs whose symbols changed meanwhile are stale and skipped. The count is the initial symbols minus
the merges, and no identifier is looked up. A code point that is no piece never merges and counts
as its UTF-8 bytes (byte fallback); that surplus is added to the initial symbols.

No piece of the model has the space mark after another character (checked when the model is read),
so nothing merges across the start of a run of marks, and a text is counted in those runs. Counts
of short runs are cached per worker process within a bound.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Sequence

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow.llm.rows import Memo, map_texts

MARK = "▁"
#: Entries of each cache generation.
CACHE = 300_000


def load_pieces(path: str) -> dict[str, float]:
    """Piece scores of a BPE model file: ordinary pieces only (no control, unknown or byte pieces).

    Raises ValueError where the model asks for what this counter does not do.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    if any(model.is_unused(i) for i in ids):
        raise ValueError("models with unused pieces are not supported")
    pieces = {model.id_to_piece(i): model.get_score(i) for i in ids}
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece has the space mark inside a word")
    if model.encode("a  b ", out_type=str)[-1][-1] != MARK:
        raise ValueError("models that trim or squeeze spaces are not supported")
    return pieces


class PieceCounter:
    """Counts tokens of text under one vocabulary of scored pieces."""

    def __init__(self, pieces: dict[str, float], cache: int = CACHE):
        # heap keys: -score as the first item, so the best piece is the least
        self.rank = {p: -s for p, s in pieces.items()}
        self.runs = Memo(cache)
        self.cut = re.compile(f"{MARK}*[^{MARK}]*")

    def count(self, run: str) -> int:
        """Tokens of one run: symbols minus merges."""
        rank, n = self.rank, len(run)
        total = n
        for c in run:
            if c not in rank:
                total += len(c.encode()) - 1
        heap = []
        for i in range(n - 1):
            s = rank.get(run[i:i + 2])
            if s is not None:
                heap.append((s, i, i + 2))
        if not heap:
            return total
        heapq.heapify(heap)
        # symbol i spans run[i:end[i]]; start[e] is the symbol that ends at e; merged-away symbols have end 0
        end = list(range(1, n + 1))
        start = list(range(-1, n))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, e = pop(heap)
            k = end[i]
            if k == 0 or k >= e or end[k] != e:
                continue
            end[i], end[k], start[e] = e, 0, i
            total -= 1
            if e < n:
                f = end[e]
                s = rank.get(run[i:f])
                if s is not None:
                    push(heap, (s, i, f))
            if i:
                h = start[i]
                s = rank.get(run[h:e])
                if s is not None:
                    push(heap, (s, h, e))
        return total

    def count_text(self, text: str) -> int:
        if not text:
            return 0
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return sum(self.count(r) for r in self.cut.findall(MARK + text.replace(" ", MARK)))
        memo = self.runs
        young, old, total = memo.young, memo.old, 0
        for word in text.split(" "):
            n = young.get(word)
            if n is None:
                n = old.get(word) or self.count(MARK + word)
                if len(word) <= 64:
                    memo.put(word, n)
                    young, old = memo.young, memo.old
            total += n
        return total


def count_tokens(df: DataFrame, model_path: str, limit: int, keep: Sequence[str] = ("doc_id",),
                 text: str = "text") -> DataFrame:
    """``keep`` plus ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Null and empty texts count zero. Texts are counted whole, repeated rows each on their own;
    strings that look like control pieces are ordinary text. Empty tables give empty results and
    other columns are ignored. The vocabulary is read on the driver and broadcast (its size is the
    model file's).
    """
    shared = df.sparkSession.sparkContext.broadcast({"pieces": load_pieces(model_path)})

    def make():
        state = shared.value
        counter = state.setdefault("counter", None) or PieceCounter(state["pieces"])
        state["counter"] = counter

        def row(data: bytes):
            return len(data), counter.count_text(data.decode("utf-8", "replace"))

        return row

    counted = map_texts(df, keep, text, make, [("n_bytes", "long"), ("n_tokens", "long")])
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
