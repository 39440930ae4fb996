"""SimHash near-duplicates: segment-popcount embedding, grid range join, exact check.

A 64-bit fingerprint is embedded as the bit counts of its sixteen 4-bit segments. The Manhattan
distance of two embeddings is a lower bound of the fingerprints' bit distance: one flipped bit moves
one count by one. Two vectors at distance at most 2r share a lattice cell at distance at most r from
both, so every fingerprint is entered in the cells within r of its vector and only fingerprints that
share a cell are compared. At the contract's two bits r is 1: 33 cells.

Exact copies fall together before the grid (one row per distinct fingerprint). Cells of up to
``crowd`` fingerprints are compared pair by pair on the real fingerprints. Crowded cells are not:
at two bits their fingerprints are entered under every word within r bits, and those that meet under a word are
linked to the smallest one there. Fingerprints at distance at most 2r share such a word and those
that share one are within 2r, so this finds the same components, without pairs, and a word has at
most as many members as there are words within r bits of it (65 for r = 1), whatever the data. At one
bit those that share a word can be two bits apart, so there a fingerprint is linked to each of the 64
words one bit from it that is a fingerprint too.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabflow.llm.graph import components
from fabflow.llm.rows import join_sorted, map_texts, staged

SEGMENTS = 16
#: Cells with more fingerprints than this are resolved without pairs.
CROWD = 24
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(data: bytes, width: int, seed: int) -> int:
    """SimHash of UTF-8 text as a signed 64-bit integer (zero without words)."""
    words = data.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= width:
        hashes = digest(joined, seed)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-width].tolist()]
        hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1:] - 1).tolist(), strict=True)])
    n, ones = len(hashes) // 8, np.zeros(64, np.int64)
    octets = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for at in range(0, n, 65536):
        ones += np.unpackbits(octets[at:at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
                 width: int = 3, seed: int = 42) -> DataFrame:
    """``keep`` plus ``fp``: the fingerprint of the whole text over shingles of ``width`` words.

    Words are what ASCII white space leaves, A-Z lower-cased; with fewer words than ``width`` the
    whole sequence is one shingle; null, empty and blank texts have fingerprint zero.
    """
    def make():
        return lambda data: (fingerprint(data, width, seed),)

    return map_texts(df, keep, text, make, [("fp", "long")])


def counts_of(fp: Column) -> Column:
    """The sixteen segment bit counts, packed one to a nibble."""
    one_each = F.lit(0x1111111111111111)
    return sum((F.shiftrightunsigned(fp, i).bitwiseAND(one_each) for i in range(1, 4)), fp.bitwiseAND(one_each))


def _around(df: DataFrame, cell: str) -> DataFrame:
    """Each row with its lattice cell and every cell one step away (counts stay within 0 to 4)."""
    step = F.col("step")
    nibble = F.expr(f"shiftrightunsigned(`{cell}`, 4 * (abs(step) - 1)) & 15")
    moved = (F.when(step == 0, F.col(cell))
             .when((step > 0) & (nibble < 4), F.col(cell) + F.expr("shiftleft(1L, 4 * (step - 1))"))
             .when((step < 0) & (nibble > 0), F.col(cell) - F.expr("shiftleft(1L, 4 * (-step - 1))")))
    steps = F.array(*[F.lit(i) for i in range(-SEGMENTS, SEGMENTS + 1)])
    return (df.select("fp", cell, F.explode(steps).alias("step"))
            .select("fp", moved.alias(cell)).filter(F.col(cell).isNotNull()))


def links(distinct: DataFrame, bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all pairs of ``fp`` at ``bits`` or fewer.

    ``distinct(fp)`` holds each fingerprint once. Every pair outside crowded cells appears; in
    crowded cells, at two bits, a star per shared word stands for its pairs. ``bits`` is 1 or 2 (radius one).
    """
    if bits not in (1, 2):
        raise ValueError("the grid is built for a distance of one or two bits")
    cells = _around(distinct.select("fp", counts_of(F.col("fp")).alias("cell")), "cell")
    size = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    shared = staged(join_sorted(cells, size, "cell"), "cells")
    within = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    few = (shared.filter(F.col("n") <= crowd).groupBy("cell").agg(F.collect_list("fp").alias("fps"))
           .select("fps", F.explode("fps").alias("a"))
           .select("a", F.explode("fps").alias("b")).filter("a < b").filter(within).distinct())
    word = F.when(F.col("bit") < 64, F.col("fp").bitwiseXOR(F.expr("shiftleft(1L, bit)"))).otherwise(F.col("fp"))
    crowded = shared.filter(F.col("n") > crowd).select("fp").distinct()
    words = crowded.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64 if bits == 2 else 63))).alias("bit")).select("fp", word.alias("word"))
    if bits == 1:  # those that share a word may be two bits apart: only words that are fingerprints link
        many = (join_sorted(words, distinct.select(F.col("fp").alias("b")), F.col("word") == F.col("b"))
                .select(F.col("fp").alias("a"), "b").filter("a < b"))
    else:
        many = (words.groupBy("word").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")
                .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b"))
    return few.unionByName(many)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, bits: int = 2,
                    seed: int = 42, crowd: int = CROWD) -> DataFrame:
    """One row per input row: ``id_col``, ``fp`` (long) and ``component`` (the smallest id reachable).

    Rows whose fingerprints differ in at most ``bits`` bits are linked; components follow links of
    any number. Texts without words share fingerprint zero and are linked like any others. Rows with
    a null id get the component of their group; a group of null ids only has a null component.
    Repeated rows stay. An empty table gives an empty result.
    """
    prints = staged(fingerprints(df, [id_col], text, width, seed).withColumnRenamed(id_col, "id"), "fingerprints")
    first = staged(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = components(links(first, bits, crowd)).select(F.col("node").alias("fp"), "root")
    rooted = join_sorted(first, roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select("fp", "component")
    return join_sorted(prints, named, "fp").select(F.col("id").alias(id_col), "fp", "component")


def hex_of(fp: str | Column) -> Column:
    """Sixteen lowercase hex digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
