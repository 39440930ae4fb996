"""Source divergence audit: how far the word use of each source departs from its language and its sister sources.

Two passes over the texts. The first counts exactly in how many documents of its language each term
stands; terms in ``min_docs`` documents or more are kept. The kept terms of a language are dealt by
hash into shards of a few thousand, and every shard gets a minimal perfect hash (levels of collision
free bits; the slot of a key is the number of set bits before its own). The second pass broadcasts
the shards and counts again: a term's slot is looked up, verified against the key stored there, and
the dense counter array of its (language, source) is incremented.

Broadcasts are bounded: shards travel in blocks of at most ``BLOCK_BYTES`` of measured size, keys of
more than ``LONG_KEY`` bytes as their SHA-256. Blocks are packed language by language, and a block's
pass reads only the documents of its languages, so a text is read again only where the kept terms of
its own language exceed a block (about 3 million terms).

Everything after the second pass is per shard: a task holds the counts of one shard for the sources
of one language, at most about ``CELLS`` integers, because shards get smaller as sources get more.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabflow.llm.rows import bytes_of, staged
from fabflow.operators.joins import join_small

#: Bytes outside the terms become spaces, A-Z become a-z; all bytes of other characters stay.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of text split into words at a time.
PIECE_BYTES = 1 << 20
#: Bytes of distinct terms (with their overhead) a task of the first pass holds before it hands them on.
HELD_BYTES = 48 << 20
#: Counters (8 bytes each) a task of the second pass holds before it hands them on.
HELD_SLOTS = 6 << 20
#: Terms of a shard at most on average, and counts (terms times sources) of a shard at most on average.
SHARD_TERMS, CELLS = 4096, 2 << 20
#: Bytes of perfect hashes in one broadcast.
BLOCK_BYTES = 48 << 20
#: Keys longer than this are stored as their digest.
LONG_KEY = 128
#: Levels of a perfect hash; keys still colliding then (equal 64-bit hashes) are listed.
LEVELS = 24


def pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about PIECE_BYTES of text."""
    data = data.translate(TERMS)
    if len(data) <= PIECE_BYTES:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE_BYTES)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def normal(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    empty = F.lit("")
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), empty).alias("lang"),
                       F.coalesce(F.col(f"`{source}`").cast("string"), empty).alias("source"), bytes_of(text).alias("text"))


def document_counts(docs: DataFrame) -> DataFrame:
    """``(lang, term, docs)``: the number of documents (rows) of a language with the term."""

    def rows(found):
        for lang, counts in found.items():
            terms, n = list(counts), list(counts.values())
            for i in range(0, len(terms), 50_000):
                some = pa.array(terms[i:i + 50_000], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(some)), some, pa.array(n[i:i + 50_000], pa.int64())],
                                                 names=["lang", "term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = {}, 0
        for batch in batches:
            texts = batch.column(1)
            for i, lang in enumerate(batch.column(0).to_pylist()):
                data = texts[i].as_py() or b""
                distinct = set()
                for words in pieces(data):
                    distinct.update(words)
                counts = found.setdefault(lang, Counter())
                before = len(counts)
                counts.update(distinct)
                held += 100 * (len(counts) - before) + (len(data) if len(data) > PIECE_BYTES else 0)
                if held >= HELD_BYTES:
                    yield from rows(found)
                    found, held = {}, 0
        yield from rows(found)

    part = docs.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    return part.groupBy("lang", "term").agg(F.sum("n").alias("docs"))


def hashes(terms) -> np.ndarray:
    """XXH64 (seed 42) of byte strings, as Spark's ``xxhash64`` computes it."""
    return np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms))


def stored(terms: list[bytes]) -> list[bytes]:
    """What a hash keeps of each term to verify it; no term holds a zero byte, so digests and terms never meet."""
    if not terms or max(map(len, terms)) <= LONG_KEY:
        return terms
    return [t if len(t) <= LONG_KEY else b"\0" + hashlib.sha256(t).digest() for t in terms]


def _place(h: np.ndarray, level: int, size) -> np.ndarray:
    """Where a key falls among ``size`` bits of a level (a 64-bit mixing function of hash and level)."""
    x = h + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2 ** 64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.asarray(size, np.uint64)).astype(np.int64)


def perfect_hash(h: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """``(sizes of the levels, their bits, slot of each key)``; slots are 0 to n - 1, each used once.

    Keys alone on their bit of a level own it; the others go on to the next level. Keys that never
    part get the last slots, in order.
    """
    slot, left, sizes, bits, used = np.zeros(len(h), np.int64), np.arange(len(h)), [], [], 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, 2 * len(left))
        at = _place(h[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        slot[left[mine]] = used + np.cumsum(alone)[at[mine]] - 1
        used += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~mine]
    slot[left] = used + np.arange(len(left))
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slot


def shards(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """One row per (lang, shard): its perfect hash, the stored keys and the whole terms in slot order."""

    def build(table: pa.Table) -> pa.Table:
        terms = table.column("term").to_pylist()
        terms.sort()                                              # slots do not depend on the order of arrival
        sizes, bits, slot = perfect_hash(hashes(terms))
        ordered = [terms[i] for i in np.argsort(slot).tolist()]
        keys = stored(ordered)
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        return pa.table({
            "lang": table.column("lang").slice(0, 1).combine_chunks(), "shard": table.column("shard").slice(0, 1).combine_chunks(),
            "n": pa.array([len(terms)], pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()), "keys": pa.array([b"".join(keys)], pa.binary()),
            "ends": pa.array([ends.tobytes()], pa.binary()), "terms": pa.array([ordered], pa.list_(pa.binary()))})

    dealt = join_small(kept, langs.select(F.col("lang").alias("of"), "shards"), F.expr("lang = of"), "inner").select(
        "lang", "term", (F.shiftrightunsigned(F.xxhash64("term"), 40) % F.col("shards")).cast("long").alias("shard"))
    return dealt.groupBy("lang", "shard").applyInArrow(
        build, "lang string, shard long, n long, sizes array<int>, bits binary, keys binary, ends binary, terms array<binary>")


class Slots:
    """Lookup in consecutive shards of one language: term to slot, verified by the stored key."""

    def __init__(self, rows: list[tuple], total: int):
        """``rows``: (shard, n, sizes, bits, keys, ends) in shard order, without empty shards; ``total``: shards of the language."""
        self.total, self.shards = np.uint64(total), np.array([r[0] for r in rows])
        deepest = max(len(r[2]) for r in rows)
        self.size = np.zeros((len(rows), deepest), np.int64)
        bits, offsets = [], [np.zeros(1, np.int64)]
        for i, (_, n, sizes, packed, _, ends) in enumerate(rows):
            self.size[i, :len(sizes)] = sizes
            bits.append(np.unpackbits(np.frombuffer(packed, np.uint8), count=sum(sizes)).astype(bool))
            offsets.append(np.frombuffer(ends, np.int32)[1:] + offsets[-1][-1])
        self.base = np.cumsum([0, *(r[1] for r in rows)])                       # first slot of each shard
        ones = np.cumsum([0, *(int(b.sum()) for b in bits)])
        self.start = np.cumsum([0, *(len(b) for b in bits)])[:-1, None] + np.cumsum(self.size, axis=1) - self.size
        self.bits = np.concatenate(bits)
        self.shift = self.base[:-1] - ones[:-1]
        self.rank = np.cumsum(self.bits, dtype=np.int32)
        self.n = int(self.base[-1])
        self.keys = pa.Array.from_buffers(pa.large_binary(), self.n, [
            None, pa.py_buffer(np.concatenate(offsets).tobytes()), pa.py_buffer(b"".join(r[4] for r in rows))])
        listed = [s for i, r in enumerate(rows) for s in range(int(self.base[i] + ones[i + 1] - ones[i]), int(self.base[i] + r[1]))]
        self.listed = {self.keys[s].as_py(): s for s in listed}

    def find(self, terms: list[bytes]) -> np.ndarray:
        """The slot of each term, -1 for terms that are not among the keys."""
        h = hashes(terms)
        number = ((h >> np.uint64(40)) % self.total).astype(np.int64)
        shard = np.minimum(np.searchsorted(self.shards, number), len(self.shards) - 1)
        slot = np.full(len(terms), -1)
        live = np.nonzero(self.shards[shard] == number)[0]
        keys = stored(terms)
        for level in range(self.size.shape[1]):
            live = live[self.size[shard[live], level] > 0]
            own = shard[live]
            at = self.start[own, level] + _place(h[live], level, self.size[own, level])
            hit = self.bits[at]
            slot[live[hit]] = self.rank[at[hit]] - 1 + self.shift[own[hit]]
            live = live[~hit]
        if self.listed:
            for i in live.tolist():
                slot[i] = self.listed.get(keys[i], -1)
        found = np.nonzero(slot >= 0)[0]
        same = pc.equal(self.keys.take(pa.array(slot[found])), pa.array(keys, pa.large_binary()).take(pa.array(found)))
        slot[found[~same.to_numpy(zero_copy_only=False)]] = -1
        return slot


def blocks(table: DataFrame, limit: int) -> Iterator[dict[str, tuple[int, int]]]:
    """Shard ranges by language, packed in order until ``limit`` bytes; only sizes reach the driver."""
    size = F.length("bits") + F.length("keys") + F.length("ends")
    held, total = {}, 0
    for r in table.select("lang", "shard", size.alias("b")).orderBy("lang", "shard").toLocalIterator():
        if held and total + r["b"] > limit:
            yield held
            held, total = {}, 0
        held[r["lang"]] = (held.get(r["lang"], (r["shard"],))[0], r["shard"])
        total += r["b"]
    if held:
        yield held


def recount(docs: DataFrame, table: DataFrame, langs: DataFrame, block: dict[str, tuple[int, int]]) -> DataFrame:
    """``(lang, shard, source, slot, n)`` for the shards of one block, written; its broadcast is gone afterwards."""
    mine = F.lit(False)
    for lang, (first, last) in block.items():
        mine = mine | ((F.col("lang") == lang) & F.col("shard").between(first, last))
    totals = {r["lang"]: r["shards"] for r in langs.filter(F.col("lang").isin(list(block))).collect()}
    packed: dict[str, list] = {}
    for r in table.filter(mine).select("lang", "shard", "n", "sizes", "bits", "keys", "ends").collect():   # at most BLOCK_BYTES
        packed.setdefault(r["lang"], []).append((r["shard"], r["n"], list(r["sizes"]), bytes(r["bits"]), bytes(r["keys"]), bytes(r["ends"])))
    shared = docs.sparkSession.sparkContext.broadcast({k: (sorted(v, key=lambda r: r[0]), totals[k]) for k, v in packed.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, dense, held = shared.value, {}, 0

        def slots(lang: str) -> Slots:
            if not isinstance(value[lang], Slots):
                value[lang] = Slots(*value[lang])                 # once per worker process
            return value[lang]

        def flush():
            for (lang, source), counts in dense.items():
                at, found = slots(lang), np.nonzero(counts)[0]
                shard = np.searchsorted(at.base, found, side="right") - 1
                for i in range(0, len(found), 200_000):
                    some, part = found[i:i + 200_000], shard[i:i + 200_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang), len(some)), pa.repeat(pa.scalar(source), len(some)), pa.array(at.shards[part]),
                         pa.array((some - at.base[part]).astype(np.int32)), pa.array(counts[some])],
                        names=["lang", "source", "shard", "slot", "n"])

        def add(key: tuple, counts: Counter):
            nonlocal held
            terms = list(counts)
            found = slots(key[0]).find(terms)
            ok = found >= 0
            if key not in dense:
                dense[key] = np.zeros(slots(key[0]).n, np.int64)
                held += len(dense[key])
            dense[key][found[ok]] += np.fromiter(counts.values(), np.int64, len(terms))[ok]

        for batch in batches:
            texts, waiting, size = batch.column(2), {}, 0
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                data = texts[i].as_py() or b""
                counts = waiting.setdefault(key, Counter())
                for words in pieces(data):
                    counts.update(words)
                size += len(data)
                if size >= 4 * PIECE_BYTES or i + 1 == batch.num_rows:
                    for group, found in waiting.items():
                        if found:
                            add(group, found)
                        if held >= HELD_SLOTS:
                            yield from flush()
                            dense.clear()
                            held = 0
                    waiting, size = {}, 0
        yield from flush()

    part = docs.filter(F.col("lang").isin(list(block))).mapInArrow(run, "lang string, source string, shard long, slot int, n long")
    counts = staged(part.groupBy("lang", "shard", "source", "slot").agg(F.sum("n").alias("n")), "divergence-counts")
    shared.destroy()
    return counts


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(10^9 (count + 1) / total)`` by long division in steps of 1000 (exact for totals below 9 * 10^15)."""
    rest, out = counts + 1, 0
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _judge(top: int):
    def judge(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        source, slot, n = table.column("source"), table.column("slot").to_numpy(), table.column("n").to_numpy()
        mark = pc.and_(source.is_valid(), pc.equal(table.column("slot"), -1)).to_numpy(zero_copy_only=False)
        names = source.filter(pa.array(mark)).to_pylist()
        order = np.argsort(np.array([x.encode() for x in names], object), kind="stable")
        names = [names[i] for i in order.tolist()]
        totals, size = n[mark][order], int(table.column("size").filter(pa.array(mark))[0].as_py())
        word = ~source.is_valid().to_numpy(zero_copy_only=False)
        terms = [None] * int(word.sum())
        for s, t in zip(slot[word].tolist(), table.column("term").filter(pa.array(word)).to_pylist(), strict=True):
            terms[s] = t
        cell = ~mark & ~word
        counts = np.zeros((len(names), len(terms)), np.int64)
        row = pc.index_in(source.filter(pa.array(cell)), value_set=pa.array(names, pa.string())).to_numpy()
        counts[row, slot[cell]] = n[cell]
        out = {"source": [], "part": [], "item": [], "value": []}

        def put(source, part, items, values):
            out["source"] += [source] * len(items)
            out["part"] += [part] * len(items)
            out["item"] += items
            out["value"] += values

        p = shares(counts, (totals + size)[:, None]) if terms else np.zeros(counts.shape, np.int64)
        sums = np.zeros((len(names), len(names)), np.int64)
        if terms:
            for j in range(len(names)):
                gap = p - p[j]
                sums[:, j] = (gap * gap // p[j]).sum(axis=1)
        sisters = [x.encode() for x in names]
        for i, name in enumerate(names):
            put(name, "pair", sisters[:i] + sisters[i + 1:], np.delete(sums[i], i).tolist())
        if terms:
            q = shares(counts.sum(axis=0), np.int64(totals.sum() + size))
            for i, name in enumerate(names):
                over = np.nonzero((counts[i] > 0) & (p[i] > q))[0]
                gap = p[i, over] - q[over]
                value = gap * gap // q[over]
                if len(over) > top:
                    least = np.partition(value, len(value) - top)[len(value) - top]
                    over, value = over[value >= least], value[value >= least]
                best = sorted(zip((-value).tolist(), [terms[s] for s in over.tolist()], strict=True))[:top]
                put(name, "term", [t for _, t in best], [-v for v, _ in best])
        return pa.table({"lang": pa.repeat(pa.scalar(lang), len(out["item"])), "source": pa.array(out["source"], pa.string()),
                         "part": pa.array(out["part"], pa.string()), "item": pa.array(out["item"], pa.binary()),
                         "value": pa.array(out["value"], pa.int64())})

    return judge


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 3, top: int = 200,
          block_bytes: int = BLOCK_BYTES, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: sister sources by divergence, and the ``top`` telling terms.

    Null text, lang and source read as ''. Every row is a document, repeated rows included. Part
    ``pair`` lists each other source of the language, part ``term`` the kept terms a source uses more
    than its language does. A language without kept terms has pairs of value 0; an empty table gives
    an empty result; other columns, whatever their names, are not read. Ranks follow the value, ties
    the UTF-8 bytes of the item. All arithmetic is exact.
    """
    rows = normal(docs, text, lang, source)
    groups = staged(rows.select("lang", "source").distinct(), "divergence-groups")
    kept = staged(document_counts(rows).filter(F.col("docs") >= min_docs).select("lang", "term"), "divergence-terms")
    target = F.greatest(F.lit(1), F.least(F.lit(shard_terms), F.greatest(F.lit(64), F.floor(F.lit(CELLS) / F.col("sources")))))
    langs = staged(groups.groupBy("lang").agg(F.count("*").alias("sources"))
                   .join(kept.groupBy("lang").agg(F.count("*").alias("size")), "lang", "left")
                   .select("lang", F.coalesce("size", F.lit(0)).alias("size"),
                           F.ceil(F.coalesce("size", F.lit(0)) / target).cast("long").alias("shards")), "divergence-langs")
    table = staged(shards(kept, langs), "divergence-hashes")

    cells = None
    for block in blocks(table, block_bytes):
        part = recount(rows, table, langs, block)
        cells = part if cells is None else cells.unionByName(part)
    if cells is None:
        cells = rows.sparkSession.createDataFrame([], "lang string, shard long, source string, slot int, n long")

    of = cells.groupBy(F.col("lang").alias("l"), F.col("source").alias("s")).agg(F.sum("n").alias("total"))
    marks = (groups.join(of, F.expr("lang = l and source = s"), "left").join(langs, "lang")
             .select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.col("shards") - 1))).alias("shard"),
                     "source", F.lit(-1).alias("slot"), F.coalesce("total", F.lit(0)).alias("n"), "size",
                     F.lit(None).cast("binary").alias("term")))
    none = F.lit(None)
    words = table.select("lang", "shard", none.cast("string").alias("source"), F.posexplode("terms").alias("slot", "term"))
    words = words.select("lang", "shard", "source", "slot", F.lit(0).cast("long").alias("n"), none.cast("long").alias("size"), "term")
    counts = cells.select("lang", "shard", "source", "slot", "n", none.cast("long").alias("size"), none.cast("binary").alias("term"))
    found = staged(marks.unionByName(words).unionByName(counts).groupBy("lang", "shard")
                   .applyInArrow(_judge(top), "lang string, source string, part string, item binary, value long"), "divergence-found")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", rank).unionByName(
        found.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= top))
    return ranked.select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value", "rank")


ORACLE_OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c,
             1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1)) // CAST(n.n + v.v AS HUGEINT) AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (k.c + 1)) // CAST(v.n + v.v AS HUGEINT) AS q
      FROM n JOIN k ON n.lang = k.lang JOIN v ON v.lang = n.lang
      LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM p WHERE c > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
WHERE part = 'pair' OR rank <= 200"""
