"""URL filters: host names split into words by unigram Viterbi, then naive Bayes over the words.

Rules decide the urls they fit, the longest rule first. For all others a multinomial naive Bayes
model decides, learnt from the urls that the rules decide, over the words of host and path. Names
such as ``thedailynews`` are split first: the words' unigram counts come from the pages' own text
(every word of every page, however rare or long), and Viterbi picks the split of highest probability.
A word unknown to the counts costs ``10 / (N * 10^length)``, so unknown stretches stay whole rather
than fall into letters.

Names are made distinct and each is split from the few substrings that are words, which three
equality joins find: substrings of up to SHORT letters meet the counts of such words as a broadcast
(at most 26 + 26^2 + 26^3 rows; single letters stand in every name, so as join keys they would all
be hot), those of up to STEM letters meet them by shuffle, and longer words are met by their first
STEM letters and compared in full. So a name of n letters makes about STEM * n rows, not n^2. The model is
a table of word counts by class, joined by word. Urls with equal host and path are scored once and
weigh by their number.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabflow.llm.rows import staged

#: Letters up to which words are few enough to broadcast, and from which longer words are met by a common start.
SHORT, STEM = 3, 16
#: Copies of each word's row in the model, for words that stand in very many urls.
SALTS = 16
#: Rules as (verdict, host, path start).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or for null."""
    u = F.coalesce((F.col(f"`{url}`") if isinstance(url, str) else url).cast("string"), F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule (``host`` + path start, ties by text) and its verdict, else nulls."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [(host == F.lit(h)) | host.endswith("." + h) for _, h, _ in ranked]
    fits = [f & path.startswith(p) for f, (_, _, p) in zip(fits, ranked, strict=True)]
    name = F.coalesce(*[F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, ranked, strict=True)], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, ranked, strict=True)], F.lit(None).cast("string"))
    return name, verdict


def unigrams(pages: DataFrame, text: str) -> DataFrame:
    """``word, n``: lower-case runs of letters (any script) in the pages' visible text, over all pages."""
    visible = F.lower(F.regexp_replace(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), r"<[^>]*>", " "))
    words = F.explode(F.regexp_extract_all(visible, F.lit(r"[\p{L}]+"), F.lit(0)))
    return pages.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def viterbi(name: str, words: dict[tuple[int, int], float], total: float) -> list[str]:
    """Most probable split of a name; ``words`` maps (start, length) to log probability.

    A stretch that is no word costs log(10 / total) - length * log(10), with a total of 100 at least so
    that more pieces always cost more. Among equal splits the one
    whose last piece is longest wins.
    """
    n = len(name)
    best, back = [0.0] + [float("-inf")] * n, [0] * (n + 1)
    by_end: dict[int, list[tuple[int, float]]] = {}
    for (start, size), p in words.items():
        by_end.setdefault(start + size, []).append((start, p))
    unknown, floor = log(10) - log(max(total, 100.0)), log(10)
    lead, lead_at = 0.0, 0       # best start of an unknown stretch: its score grows with start, falls with length
    for end in range(1, n + 1):
        options = [(best[s] + p, -s) for s, p in by_end.get(end, ())]
        if best[end - 1] + (end - 1) * floor > lead:
            lead, lead_at = best[end - 1] + (end - 1) * floor, end - 1
        options.append((lead - end * floor + unknown, -lead_at))
        score, start = max(options)
        best[end], back[end] = score, -start
    out, end = [], n
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def word_places(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, start, size, n`` for every place of every counted word inside a name of lower-case letters."""
    length = F.length("name")
    starts = names.select("name", F.explode(F.sequence(F.lit(1), length)).alias("start"))
    room = length - F.col("start") + 1

    def cuts(low: int, high: int) -> DataFrame:
        return (starts.filter(room >= low)
                .select("name", "start", F.explode(F.sequence(F.lit(low), F.least(F.lit(high), room))).alias("size"))
                .select("name", "start", "size", F.substring("name", F.col("start"), F.col("size")).alias("word")))

    letters = counts.filter(F.col("word").rlike("^[a-z]+$"))
    size = F.length("word")
    short = cuts(1, SHORT).join(F.broadcast(letters.filter(size <= SHORT)), "word")
    middle = cuts(SHORT + 1, STEM).join(letters.filter((size > SHORT) & (size <= STEM)), "word")
    stems = letters.filter(size > STEM).select(F.substring("word", 1, STEM).alias("stem"), F.col("word").alias("whole"), "n")
    long = (cuts(STEM, STEM).withColumnRenamed("word", "stem").join(stems, "stem")
            .filter(F.substring("name", F.col("start"), F.length("whole")) == F.col("whole"))
            .withColumn("size", F.length("whole")))
    return reduce(DataFrame.unionByName, [t.select("name", "start", "size", "n") for t in (short, middle, long)])


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, words`` for every distinct name of lower-case letters."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()["total"]
    found = (word_places(names, counts).groupBy("name")
             .agg(F.collect_list(F.struct((F.col("start") - 1).alias("start"), "size", F.col("n").cast("double").alias("n"))).alias("found")))
    rows = names.join(found, "name", "left").select("name", "found")

    def run(batches):
        for batch in batches:
            out = []
            for name, hits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {(h["start"], h["size"]): log(h["n"]) - log(total) for h in hits or ()}
                out.append(viterbi(name, words, float(total)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["name", "words"])

    return rows.mapInArrow(run, "name string, words array<string>")


def raw_tokens(host: Column, path: Column) -> Column:
    """Runs of letters and runs of digits (as ``#`` and their length) of host and lower-cased path."""
    both = F.concat_ws(" ", host, F.translate(path, UPPER, LOWER))
    return F.transform(F.regexp_extract_all(both, F.lit(r"[0-9]+|[^\x00-\x2F0-9\x3A-\x60\x7B-\x7F]+"), F.lit(0)),
                       lambda t: F.when(t.rlike("^[0-9]+$"), F.concat(F.lit("#"), F.length(t).cast("string"))).otherwise(t))


def judge(pages: DataFrame, id_col: str = "page_id", url: str = "url", text: str = "html",
          rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``id_col, host, path, rule, verdict`` and ``log_odds`` (of allow against block), one row per page.

    ``verdict`` is the longest fitting rule's, else naive Bayes' (``allow`` at even odds). Null urls
    and urls without ``://`` have an empty host and path and no words: the class prior decides.
    Where the rules decide no page of a class, add-one counts still give a verdict. Repeated rows
    stay and weigh as often as they stand; empty tables give empty results.
    """
    host, path = host_and_path(url)
    parsed = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    targets = parsed.groupBy("host", "path").agg(F.count("*").alias("weight")).withColumns({"rule": rule, "ruled": ruled})
    raw = targets.select("host", "path", "weight", "ruled", F.explode(raw_tokens(F.col("host"), F.col("path"))).alias("name"))
    letters = F.col("name").rlike("^[a-z]+$")
    counts = staged(unigrams(pages, text), "unigrams")             # read by four joins, counted once
    split = segment(raw.filter(letters).select("name").distinct(), counts)
    tokens = (raw.join(split, "name", "left")
              .select("host", "path", "weight", "ruled", F.explode(F.coalesce("words", F.array("name"))).alias("word"))
              .groupBy("host", "path", "word").agg(F.count("*").alias("times"), F.first("weight").alias("weight"), F.first("ruled").alias("ruled")))
    seen = lambda v: F.sum(F.when(F.col("ruled") == v, F.col("times") * F.col("weight")).otherwise(0))
    model = tokens.groupBy("word").agg(seen("allow").alias("allow"), seen("block").alias("block"))
    size = model.agg(F.coalesce(F.sum("allow"), F.lit(0)).alias("allow"), F.coalesce(F.sum("block"), F.lit(0)).alias("block"),
                     F.count("*").alias("words")).first()
    docs = {r["ruled"]: r["n"] for r in targets.groupBy("ruled").agg(F.sum("weight").alias("n")).collect()}
    prior = log((docs.get("allow", 0) + 1) / (docs.get("block", 0) + 1))
    rate = lambda c: F.log((F.col(c) + F.lit(1.0)) / F.lit(float(size[c] + size["words"] + 1)))
    # a word such as "com" stands in most urls: its rows meet one of SALTS copies of its model row
    copies = model.select("word", (rate("allow") - rate("block")).alias("odds"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    odds = (tokens.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).join(copies, ["word", "salt"])
            .groupBy("host", "path").agg(F.sum(F.col("times") * F.col("odds")).alias("odds")))
    judged = (targets.join(odds, ["host", "path"], "left")
              .select("host", "path", "rule", "ruled", F.round(F.coalesce("odds", F.lit(0.0)) + F.lit(prior), 9).alias("log_odds")))
    free = F.when(F.col("log_odds") >= 0, "allow").otherwise("block")
    return (parsed.join(judged, ["host", "path"])
            .select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", free).alias("verdict"), "log_odds"))
