"""Quality rules with a word suffix array: longest-common-prefix intervals find repeats within a text.

The suffix array comes from prefix doubling over word numbers: level k ranks every run of 2^k words,
and the levels, read from the highest down, give the longest common prefix (LCP) of neighbours in the
array. Suffixes in an LCP interval of depth l share l words, so the deepest interval a suffix is in,
the larger LCP to its two neighbours, is the longest repeat that starts there. Repeats that cannot
be made longer at either end are the ends of those intervals; the union of their spans is the set
of words inside any repeat of a given least length.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow.llm.rows import map_texts

#: Least words of a repeat that counts as covered text.
MIN_REPEAT = 8
#: Most per cent of the words that such repeats may cover.
MAX_COVERED_PERCENT = 18
#: Most words of the longest repeat.
MAX_LONGEST = 100
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
CONTINUATION = bytes(range(0x80, 0xC0))


def longest_repeats(ids: np.ndarray) -> np.ndarray:
    """For every word the length of the longest run from there that also starts elsewhere in the text."""
    n = len(ids)
    rank, levels, step = np.unique(ids, return_inverse=True)[1].astype(np.int64), [], 1
    levels.append(rank)
    while rank.max(initial=0) < n - 1:
        after = np.zeros(n, np.int64)
        if step < n:
            after[:n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b = order[:-1], order[1:]
    lcp = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, size = levels[k], 1 << k
        x, y = a + lcp, b + lcp
        inside = np.maximum(x, y) + size <= n
        same = np.zeros(len(lcp), bool)
        same[inside] = level[x[inside]] == level[y[inside]]
        lcp[same] += size
    deepest = np.zeros(n, np.int64)
    if n > 1:
        deepest[order] = np.maximum(np.append(lcp, 0), np.append(0, lcp))
    return deepest


def covered(deepest: np.ndarray, least: int, most: int | None = None) -> int:
    """Words inside the repeats of at least ``least`` words (each cut to its first ``most`` words)."""
    start = np.nonzero(deepest >= least)[0]
    if not len(start):
        return 0
    size = deepest[start] if most is None else np.minimum(deepest[start], most)
    edges = np.zeros(len(deepest) + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + size, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measure(data: bytes, min_repeat: int) -> tuple[int, ...]:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, longest)`` of one text."""
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    chars = len(data.translate(None, SPACES + CONTINUATION))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return len(words), chars, symbols, len(lines) - len(set(lines)), 0, 0, 0
    deepest = longest_repeats(ids)
    return (len(words), chars, symbols, len(lines) - len(set(lines)), covered(deepest, 5, 5),
            covered(deepest, min_repeat), int(deepest.max()))


FIELDS = [(f, "long") for f in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest")]


def judge(df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", min_repeat: int = MIN_REPEAT,
          max_covered_percent: int = MAX_COVERED_PERCENT, max_longest: int = MAX_LONGEST) -> DataFrame:
    """``keep`` plus the counts of :func:`measure`, ``base_failed`` and ``kept``.

    ``base_failed``: under 10 words, or over a fifth of the words in 5-word windows found twice.
    ``kept`` is false where the base rule fails, repeats of ``min_repeat`` words or more cover over
    ``max_covered_percent`` of the words, or the longest repeat has over ``max_longest`` words.
    Null and empty texts have no words and fail the base rule. Whole texts are read; repeated rows
    stay. Words are the runs between ASCII white space.
    """
    m = map_texts(df, keep, text, lambda: lambda data: measure(data, min_repeat), FIELDS)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    rejected = (F.col("n_covered") * 100 > F.col("n_words") * max_covered_percent) | (F.col("longest") > max_longest)
    return m.withColumn("base_failed", failed).withColumn("kept", ~failed & ~rejected)


ORACLE_OP4 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2),
dup AS (SELECT doc_id, sum(n - 1) AS n_dup FROM l GROUP BY 1),
i AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (VALUES (5), ({MIN_REPEAT}), ({MAX_LONGEST + 1})) ks(k) WHERE len(w) >= k),
g AS (SELECT doc_id, k, list(s) AS ss FROM (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS g FROM i) GROUP BY doc_id, k, g HAVING count(*) > 1),
p AS (SELECT doc_id, k, count(DISTINCT pos) AS n FROM (SELECT doc_id, k, unnest(range(s, s + k)) AS pos FROM (SELECT doc_id, k, unnest(ss) AS s FROM g)) GROUP BY 1, 2),
r AS (SELECT doc_id, max(n) FILTER (k = 5) AS n5, max(n) FILTER (k = {MIN_REPEAT}) AS nm, bool_or(k = {MAX_LONGEST + 1}) AS long FROM p GROUP BY 1),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n5, 0) AS BIGINT) AS n_repeat_words,
             coalesce(nm, 0) AS nm, coalesce(long, false) AS long
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * nm <= {MAX_COVERED_PERCENT} * n_words AND NOT long AS kept
FROM m"""
