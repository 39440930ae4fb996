"""Substring dedup with fixed-block anchors.

A word is removed where a window of ``width`` words covers it whose word sequence also starts in a
document with a smaller id. Anchors find the places to look at: every document is indexed by its
non-overlapping blocks of ``(width + 1) / 2`` words, at multiples of that length, and every rolling
window of the same length is a probe. A window of ``width`` words always holds one whole block, so a
repeat is met by at least one probe that hits a block of another document. Around hits the repeat is
extended: the full windows over a hit are compared by 128-bit hashes, and runs of matching windows
are the maximal exact repeats.

How it runs: texts are dealt into chunks of about ``chunk_bytes`` (one shuffle of the text, used
three times). A chunk sends the distinct hashes of its probes, marked if they are blocks too, as
packed arrays to hash buckets; a bucket answers each chunk with those that hit. The chunk then sends
the windows over hits with the smallest and largest id that holds them, and the bucket answers with
the smallest id of all. A hash crosses the network once per chunk, however many copies it has, so a
passage shared by a third of all documents makes one entry per chunk and nobody gathers its
documents. Chunks and buckets are bounded by bytes; their numbers follow the size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabflow.llm.rows import bytes_of, text_bytes

CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 12 << 20
#: Id of rows without one: larger than any, so such rows never cause a removal.
NO_ID = np.iinfo(np.int64).max
_U = np.uint64


def _weights(n: int) -> np.ndarray:
    """Odd multipliers of the window hashes, one per place (hashes of the place numbers)."""
    return np.array([xxhash.xxh3_64_intdigest(b"place %d" % j) | 1 for j in range(n)], np.uint64)


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """Two 64-bit hashes per word, as columns."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), "<u8").reshape(-1, 2)


def roll(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words (a multilinear hash of the word hashes, then mixed)."""
    n = len(h) - width + 1
    total = np.zeros(max(n, 0), np.uint64)
    for j, m in enumerate(_weights(width)):
        total += h[j:j + n] * m
    total ^= total >> _U(32)
    total *= _U(0x9E3779B97F4A7C15)
    return total ^ (total >> _U(29))


def places(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket number (high half) and 32 more bits of each hash."""
    return ((hashes >> _U(32)) * _U(buckets) & _U(0xFFFFFFFF00000000)) | (hashes & _U(0xFFFFFFFF))


def pack(values: np.ndarray) -> bytes:
    """An array by byte planes: high bytes of sorted or small numbers stand together, where the shuffle's compression sees them."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _by_bucket(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(bucket, from, to)`` over sorted places."""
    owner = keys >> _U(32)
    edges = np.nonzero(np.diff(owner))[0] + 1
    for a, e in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
        if e > a:
            yield int(owner[a]), a, e


class Chunk:
    """The documents of one chunk that have at least one full window: ids, probes and blocks."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        self.width, self.block, self.buckets = width, (width + 1) // 2, buckets
        ids = table.column("order_id").to_numpy(zero_copy_only=False)
        self.rows, self.ids, self.hashes = [], [], []
        for i, data in enumerate(table.column("text")):
            words = (data.as_py() or b"").split()
            if len(words) >= width:
                self.rows.append(i)
                self.ids.append(int(ids[i]))
                self.hashes.append(word_hashes(words))

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of all probes, whether each starts a block, and the document of each."""
        keys = [places(roll(h[:, 0], self.block), self.buckets) for h in self.hashes]
        sizes = [len(k) for k in keys]
        block = np.concatenate([np.arange(n) % self.block == 0 for n in sizes]) if keys else np.zeros(0, bool)
        return (np.concatenate(keys) if keys else np.zeros(0, np.uint64)), block, np.repeat(np.arange(len(keys)), sizes)


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


_PROBES = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("blocks", pa.binary())])
_HITS = pa.schema([("chunk", pa.int64()), ("keys", pa.binary())])
_WINDOWS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary()),
                      ("least", pa.binary()), ("span", pa.binary())])
_FIRST = pa.schema([("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("least", pa.binary())])
_DDL = {_PROBES: "bucket long, chunk long, keys binary, blocks binary", _HITS: "chunk long, keys binary",
        _WINDOWS: "bucket long, chunk long, a binary, b binary, least binary, span binary",
        _FIRST: "chunk long, a binary, b binary, least binary"}


def send_probes(table: pa.Table, width: int, buckets: int) -> pa.Table:
    """A chunk's distinct probes by bucket: the low 32 bits, sorted, and a bit for blocks."""
    keys, block, _ = Chunk(table, width, buckets).probes()
    both = np.sort((keys << _U(1)) | block.astype(np.uint64))     # places stay below 2^63
    keys = both >> _U(1)
    last = np.append(keys[1:] != keys[:-1], True) if len(keys) else np.zeros(0, bool)
    keys, block = keys[last], (both[last] & _U(1)).astype(bool)
    chunk = table.column("chunk")[0].as_py()
    return _table(_PROBES, [(b, chunk, pack(keys[a:e].astype("<u4")), np.packbits(block[a:e]).tobytes())
                            for b, a, e in _by_bucket(keys)])


def meet(table: pa.Table) -> pa.Table:
    """In a bucket: to each chunk its probes that two chunks have and that are a block of one."""
    bucket = table.column("bucket")[0].as_py()
    chunks = table.column("chunk").to_pylist()
    parts = [unpack(k.as_py(), "<u4") for k in table.column("keys")]
    block = np.concatenate([np.unpackbits(np.frombuffer(b.as_py(), np.uint8), count=len(p))
                            for b, p in zip(table.column("blocks"), parts, strict=True)])
    keys, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, owner, block = keys[order], owner[order], block[order]
    starts = np.nonzero(np.append(True, keys[1:] != keys[:-1]))[0]
    size = np.diff(np.append(starts, len(keys)))
    hit = np.repeat((size > 1) & (np.add.reduceat(block.astype(np.int64), starts) > 0), size)
    keys, owner = keys[hit].astype(np.uint64) | (_U(bucket) << _U(32)), owner[hit]
    order = np.argsort(owner, kind="stable")
    keys, owner = keys[order], owner[order]
    edges = np.searchsorted(owner, np.arange(len(parts) + 1))
    return _table(_HITS, [(chunks[i], pack(keys[edges[i]:edges[i + 1]]))
                          for i in range(len(parts)) if edges[i + 1] > edges[i]])


def send_windows(table: pa.Table, hits: pa.Table, width: int, buckets: int) -> pa.Table:
    """A chunk's distinct full windows over hits, with the smallest and largest id that holds each."""
    if not table.num_rows:
        return _table(_WINDOWS, [])
    c = Chunk(table, width, buckets)
    keys, block, doc = c.probes()
    order = np.argsort(keys, kind="stable")
    if len(keys):                                              # hits between documents of this chunk
        k, d = keys[order], doc[order]
        starts = np.nonzero(np.append(True, k[1:] != k[:-1]))[0]
        ends = np.append(starts[1:], len(k)) - 1
        own = (d[starts] != d[ends]) & (np.add.reduceat(block[order].astype(np.int64), starts) > 0)
        known = np.sort(np.concatenate([k[starts[own]], *[unpack(x.as_py(), "<u8") for x in hits.column("keys")]]))
    hit = np.zeros(len(keys), bool)
    if len(keys) and len(known):
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = known[at] == keys
    a, b, ids, at = [], [], [], 0
    for h, i in zip(c.hashes, c.ids, strict=True):
        n = len(h) - c.block + 1
        mine, at = hit[at:at + n], at + n
        if mine.any():
            sums = np.concatenate(([0], np.cumsum(mine)))
            wins = len(h) - width + 1
            over = np.nonzero(sums[width - c.block + 1:][:wins] > sums[:wins])[0]
            a.append(roll(h[:, 0], width)[over])
            b.append(roll(h[:, 1], width)[over])
            ids.append(np.full(len(over), i, np.int64))
    if not a:
        return _table(_WINDOWS, [])
    a, b, ids = np.concatenate(a), np.concatenate(b), np.concatenate(ids)
    order = np.lexsort((b, a))
    a, b, ids = a[order], b[order], ids[order]
    starts = np.nonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[0]
    a, b, least = a[starts], b[starts], np.minimum.reduceat(ids, starts)
    span = np.maximum.reduceat(ids, starts) - least              # zero but for windows in several documents of the chunk
    chunk = table.column("chunk")[0].as_py()
    return _table(_WINDOWS, [(o, chunk, pack(a[s:e]), pack(b[s:e]), pack(least[s:e]), pack(span[s:e]))
                             for o, s, e in _by_bucket(places(a, buckets) & _U(0xFFFFFFFF00000000))])


def first_holders(table: pa.Table) -> pa.Table:
    """In a bucket: to each chunk the windows that some document of it has after a smaller id."""
    chunks = table.column("chunk").to_pylist()
    col = lambda name, kind: [unpack(x.as_py(), kind) for x in table.column(name)]
    parts = col("a", "<u8")
    a, b, least, span = np.concatenate(parts), *[np.concatenate(col(n, k)) for n, k in (("b", "<u8"), ("least", "<i8"), ("span", "<i8"))]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.lexsort((b, a))
    a, b, least, span, owner = a[order], b[order], least[order], span[order], owner[order]
    starts = np.nonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[0]
    first = np.repeat(np.minimum.reduceat(least, starts), np.diff(np.append(starts, len(a))))
    late = first < least + span
    a, b, first, owner = a[late], b[late], first[late], owner[late]
    order = np.argsort(owner, kind="stable")
    a, b, first, owner = a[order], b[order], first[order], owner[order]
    edges = np.searchsorted(owner, np.arange(len(parts) + 1))
    return _table(_FIRST, [(chunks[i], pack(a[s:e]), pack(b[s:e]), pack(first[s:e]))
                           for i, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if e > s])


def cut(table: pa.Table, firsts: pa.Table, width: int, tidy: bool, schema: pa.Schema) -> pa.Table:
    """The chunk's documents without the words under windows that a smaller id holds."""
    col = lambda name, kind: np.concatenate([np.zeros(0, kind), *[unpack(x.as_py(), kind) for x in firsts.column(name)]])
    a, b, first = col("a", "<u8"), col("b", "<u8"), col("least", "<i8")
    order = np.argsort(a, kind="stable")
    a, b, first = a[order], b[order], first[order]
    ids = table.column("order_id").to_numpy(zero_copy_only=False)
    n_words, n_removed, kept = [], [], []
    for data, i in zip(table.column("text"), ids, strict=True):
        data = data.as_py() or b""
        words, gone = data.split(), None
        if len(words) >= width and len(a):
            h = word_hashes(words)
            wa = roll(h[:, 0], width)
            lo, hi = np.searchsorted(a, wa), np.searchsorted(a, wa, side="right")
            maybe = np.nonzero(hi > lo)[0]
            if len(maybe):
                wb = roll(h[:, 1], width)[maybe]
                late, step, open_ = np.zeros(len(maybe), bool), 0, hi[maybe] - lo[maybe]
                while (open_ > step).any():                    # windows that share the first hash: one, but for chance
                    at = np.minimum(lo[maybe] + step, len(a) - 1)
                    late |= (open_ > step) & (b[at] == wb) & (first[at] < i)
                    step += 1
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, maybe[late], 1)
                np.add.at(edges, maybe[late] + width, -1)
                gone = np.cumsum(edges)[:-1] > 0
        lost = 0 if gone is None else int(gone.sum())
        n_words.append(len(words))
        n_removed.append(lost)
        if lost:
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        kept.append(b" ".join(words) if lost or tidy else data)
    held = [table.column(n) for n in schema.names[:-3]]
    return pa.Table.from_arrays([*held, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                 pa.array(kept, pa.binary())], names=schema.names)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", keep: Sequence[str] = (), width: int = 13, tidy: bool = True,
                   chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``id_col`` and ``keep`` plus ``n_words``, ``n_removed`` and ``kept`` (UTF-8, words joined by one space;
    without ``tidy`` a text that loses nothing keeps its own white space).

    One row per input row; ids are integers. Windows are judged on the input, whatever else is
    removed; a window that only repeats within its own document, or in rows of the same id, stays.
    Rows without an id count as larger than any. Null, empty and short texts lose nothing; an empty
    table gives an empty result. Words are the runs between ASCII white space, unchanged.
    """
    names = [id_col, *keep]
    if clash := {"n_words", "n_removed", "kept"} & set(names):
        raise ValueError(f"columns share names with result columns: {sorted(clash)}")
    total = text_bytes(df, text)
    chunks = max(16, -(-total // chunk_bytes))
    buckets = max(16, -(-total // bucket_bytes))
    # the input partition is part of the key, so that rows repeated very often do not meet in one chunk
    key = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text}`"), F.spark_partition_id()), F.lit(chunks))
    held = [F.col(f"`{n}`").alias(f"k{i}") for i, n in enumerate(names)]
    dealt = df.select(key.alias("chunk"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(int(NO_ID))).alias("order_id"),
                      bytes_of(text).alias("text"), *held)

    def probes(table: pa.Table) -> pa.Table:
        return send_probes(table, width, buckets)

    def windows(table: pa.Table, hits: pa.Table) -> pa.Table:
        return send_windows(table, hits, width, buckets)

    sent = dealt.groupBy("chunk").applyInArrow(probes, _DDL[_PROBES])
    hits = sent.groupBy("bucket").applyInArrow(meet, _DDL[_HITS])
    over = dealt.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(windows, _DDL[_WINDOWS])
    firsts = over.groupBy("bucket").applyInArrow(first_holders, _DDL[_FIRST])
    out = T.StructType([T.StructField(f"k{i}", df.schema[n].dataType) for i, n in enumerate(names)]
                       + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                          T.StructField("kept", T.BinaryType())])
    columns = [f.name for f in out]

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        types = [table.schema.field(c) for c in columns[:-3]]
        schema = pa.schema([*types, ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])
        return cut(table, answers, width, tidy, schema)

    done = dealt.groupBy("chunk").cogroup(firsts.groupBy("chunk")).applyInArrow(finish, out)
    return done.select(*[F.col(f"k{i}").alias(n) for i, n in enumerate(names)], "n_words", "n_removed", "kept")


ORACLE_OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM s),
m AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN m USING (g) WHERE first < doc_id),
r AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)"""
