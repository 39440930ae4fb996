"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Texts and items are normalised alike: A-Z lower-cased, every other ASCII character that is no letter
or digit becomes a separator, all else stays. Words become symbols of one alphabet (words that no
item has share one), so the automaton reads a document once, word by word.

A hit is a run of ``width`` words in common with an item. Its patterns are not the items' overlapping
windows but their consecutive blocks of ``(width + 1) // 2`` words: every window holds one such block
whole, so each match of a window is met by a block, which is then extended to both sides as far as
text and item agree; runs of ``width`` words or more count. So the automaton is as large as the items,
not ``width`` times that. An item of fewer words is one pattern as it stands.

Normalising keeps every byte in its place, so a run is mapped back by its word numbers to the bytes
and code points of the original text.

The items are broadcast. Their size is measured first; above BLOCK_BYTES of text (or a million
different words) they are dealt by hash over as many automata as needed, each used in a pass of its
own over the texts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow.llm.rows import map_texts, staged

#: Bytes of normalised items and their ids in one automaton (one broadcast).
BLOCK_BYTES = 16 << 20
#: Different words one automaton can have symbols for (code points without surrogates).
MAX_WORDS = 1_000_000
#: Every byte to itself, A-Z to lower case, other ASCII without digits and letters to a space.
NORMAL = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(NORMAL).split()


def item_bodies(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct items that have words: ``body`` (words between single spaces), ``n`` words, ``items``.

    ``items`` lists the distinct ids as sorted strings (null ids are left out, their text stays).
    """
    def make():
        def row(data: bytes):
            w = words_of(data)
            return b" ".join(w).decode("latin-1"), len(w)

        return row

    cut = map_texts(items, [item_id], text, make, [("body", "string"), ("n", "int")]).filter("n > 0")
    return (cut.select(F.col(f"`{item_id}`").cast("string").alias("item"), "n", "body")
            .groupBy("body", "n").agg(F.array_sort(F.collect_set("item")).alias("items")))


class Matcher:
    """Finds the runs a text has in common with any of the items."""

    def __init__(self, rows: Sequence[tuple[str, list[str]]], width: int):
        self.width, self.names, self.symbols, self.bodies = width, [], {}, []
        places: dict[str, list[tuple[int, int]]] = {}
        block = (width + 1) // 2
        for number, (body, names) in enumerate(rows):
            own = "".join([self._symbol(w) for w in body.encode("latin-1").split(b" ")])
            self.names.append(names)
            self.bodies.append(own)
            if len(own) < width:
                places.setdefault(own, []).append((number, -1))
            else:
                for at in range(0, len(own) - block + 1, block):
                    places.setdefault(own[at:at + block], []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for pattern, where in places.items():
            self.automaton.add_word(pattern, (len(pattern), where))
        self.automaton.make_automaton()

    def _symbol(self, word: bytes) -> str:
        got = self.symbols.get(word)
        if got is None:
            code = len(self.symbols) + 1
            got = self.symbols[word] = chr(code if code < 0xD800 else code + 0x800)
        return got

    def runs(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """``(first word, end word, item number)`` of every maximal common run that counts."""
        get = self.symbols.get
        text = "".join([get(w, "\0") for w in words])
        found, done = [], {}
        for end, (size, where) in self.automaton.iter(text):
            start = end - size + 1
            for number, at in where:
                if at < 0:
                    found.append((start, end + 1, number))
                    continue
                own, lane = self.bodies[number], (number, start - at)
                if done.get(lane, -1) > start:                    # inside a run that is known already
                    continue
                low, high, shift = start, end + 1, at - start
                while low > 0 and low + shift > 0 and text[low - 1] == own[low - 1 + shift]:
                    low -= 1
                while high < len(text) and high + shift < len(own) and text[high] == own[high + shift]:
                    high += 1
                done[lane] = high
                if high - low >= self.width:
                    found.append((low, high, number))
        return found


def scan(data: bytes, matcher: Matcher | None):
    """``(n_words, first words, end words, from, to, items)`` of one text.

    The ranges are maximal runs of hit words, as word numbers (end exclusive) and as code points of
    the original text.
    """
    normal = data.translate(NORMAL)
    words = normal.split()
    none = (len(words), [], [], [], [], [])
    hits = matcher.runs(words) if matcher and words else []
    if not hits:
        return none
    covered, items = np.zeros(len(words) + 1, np.int64), set()
    for low, high, number in hits:
        covered[low] += 1
        covered[high] -= 1
        items.update(matcher.names[number])
    inside = np.concatenate(([0], np.cumsum(covered)[:-1] > 0, [0])).astype(np.int8)
    edges = np.diff(inside)
    first, last = np.nonzero(edges == 1)[0].tolist(), np.nonzero(edges == -1)[0].tolist()
    spans = [m.span() for m in re.finditer(rb"[^ \x09-\x0D]+", normal)]
    points = [[len(data[:x].decode("utf-8", "replace")) for x in side]
              for side in ([spans[i][0] for i in first], [spans[i - 1][1] for i in last])]
    return len(words), first, last, *points, sorted(items)


FIELDS = [("n_words", "long"), ("first_words", "array<int>"), ("end_words", "array<int>"),
          ("from_chars", "array<int>"), ("to_chars", "array<int>"), ("items", "array<string>")]


def contaminated(df: DataFrame, items: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", width: int = 10) -> DataFrame:
    """``keep`` plus, for each text, its words, hit words, hit ranges and the items that occur.

    ``n_words``, ``n_hit`` (words inside any occurrence of an item window), ``items`` (sorted ids as
    strings) and, per automaton, ranges of hit words as word numbers and as code points of the text.
    Null and empty texts have no words; null and empty items no windows; repeated rows stay and
    repeated items count once. Without items nothing is hit. Whole texts are read.
    """
    bodies = staged(item_bodies(items, item_id, item_text), "item-bodies")
    size = F.length("body") + F.length(F.array_join("items", ","))
    total, words = bodies.agg(F.coalesce(F.sum(size), F.lit(0)),
                              F.coalesce(F.sum("n"), F.lit(0))).first()
    if words > MAX_WORDS:
        words = bodies.select(F.explode(F.split("body", " ")).alias("w")).distinct().count()
    blocks = max(1, -(-total // BLOCK_BYTES), -(-words // MAX_WORDS))
    part = F.pmod(F.xxhash64("body"), F.lit(blocks))
    sc = df.sparkSession.sparkContext
    names = ["scanned" if k == text else f"key{i}" for i, k in enumerate(keep)]    # the text travels once
    out = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keep, names, strict=True) if k != text],
                    F.col(f"`{text}`").cast("string").alias("scanned"))
    for b in range(blocks):
        rows = [tuple(r) for r in bodies.filter(part == b).select("body", "items").toLocalIterator()]
        shared = sc.broadcast({"items": rows})

        def make(shared=shared):
            state = shared.value
            if "matcher" not in state:
                state["matcher"] = Matcher(state.pop("items"), width) if state["items"] else None     # once per worker process
            return lambda data: scan(data, state["matcher"])

        last = b + 1 == blocks
        found = [c for c in out.columns if c not in names and c != "scanned"]
        held = [*names, *found, *([] if last or "scanned" in names else ["scanned"])]
        out = map_texts(out, held, "scanned", make, [(f"{f}_{b}", t) for f, t in FIELDS])
        if not last:
            out = staged(out, "scanned")
    every = lambda f: F.concat(*[F.col(f"{f}_{b}") for b in range(blocks)])
    positions = F.flatten(F.zip_with(every("first_words"), every("end_words"),
                                     lambda a, e: F.sequence(a, e - F.lit(1))))
    n_hit = (F.aggregate(F.zip_with("first_words_0", "end_words_0", lambda a, e: e - a), F.lit(0).cast("int"), lambda s, x: s + x)
             if blocks == 1 else F.size(F.array_distinct(positions)))
    return out.select(
        *[F.col(n).alias(k) for k, n in zip(keep, names, strict=True)],
        F.col("n_words_0").alias("n_words"), n_hit.cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(every("items"))).alias("items"),
        *[every(f).alias(f) for f in ("first_words", "end_words", "from_chars", "to_chars")])


def digests(found: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    return found.select(
        *[F.col(f"`{k}`") for k in keep], "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_OP7 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS i, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT i, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT i, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM bs),
ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
hit AS (SELECT ds.doc_id, ds.s, ds.n, bw.i FROM ds JOIN bw ON ds.n = bw.n AND array_to_string(ds.w[ds.s:ds.s + ds.n - 1], ' ') = bw.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l FROM (SELECT DISTINCT doc_id, i FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""
