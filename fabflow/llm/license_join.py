"""License scans: an exact set-similarity join of text blocks with notice templates. DataFrame functions only.

Blocks are runs of words over the whole text, line ends or not: each twice the longest template, one
starting every longest template, so any stretch of that many words stands whole in one. A block
matches a template when it holds at least ``threshold`` of the template's distinct words. The join
runs on tokens in one global order, rarest in the corpus first:

* prefix filter: a template of n words with needed overlap o shares at least one of its n - o + 1
  rarest words with every matching block, and a block one of its own such prefix;
* length filter: a block needs at least o words that any template has;
* positional filter: from the first shared word on, no more words can be shared than either side
  has left.

What passes is verified by the true overlap, and then by a reading of the block, since loose words of
unrelated sentences can add up to a short template, and notices of one family differ by one word:

* the needed words must stand in the template's order, within twice its length;
* where a text of another licence would hold enough words of the template (:func:`tell_apart`), the
  words that it lacks must be among them (``nc`` for CC BY-NC), or, where it lacks none, the words it
  has beyond the template must not stand in between (``nc`` for plain CC BY).

Only words of templates can be shared, so blocks are cut down to those first. The templates are a
parameter and small (``MAX_TEMPLATE_WORDS`` is checked), which bounds what is broadcast and the
counts that come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word once A-Z are lower-cased, as the fixed rule has it.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words as they stand in the text, and what is between them. Java looks up one named class per
#: character but goes through every range of a list, which takes ten times as long.
RAW_WORD = r"[\p{Alnum}\x{80}-\x{10FFFF}]+"
GAP = r"[^\p{Alnum}\x{80}-\x{10FFFF}]+"
#: The base phrases and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Notices as licences word them, one block each.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("this work is licensed under a creative commons attribution license", "cc-by"),
)
#: Least share of a template's distinct words in a matching block, and of them in order in a stretch of it.
THRESHOLD = 0.85
MAX_TEMPLATE_WORDS = 20_000


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(RAW_WORD), F.lit(0))


def _needed(template: str, threshold: float) -> int:
    return ceil(len(set(template.split())) * threshold - 1e-9)


def tell_apart(number: int, templates: Sequence[tuple[str, str]], threshold: float) -> tuple[list[str], list[str]]:
    """(words a match of the template must hold, words that must not stand in it), from templates of other labels.

    Another licence's text that holds the needed share of this template either lacks words of it,
    which are then required, or has all of them and more, which are then excluded.
    """
    own, need = set(templates[number][0].split()), _needed(templates[number][0], threshold)
    required, excluded = set(), set()
    for text, label in templates:
        other = set(text.split())
        if label != templates[number][1] and len(own & other) >= need:
            if own - other:
                required |= own - other
            else:
                excluded |= other - own
    return sorted(required), sorted(excluded)


def _in_order(words: Column, template: Column) -> Column:
    """Length of the longest common subsequence of two word arrays."""
    def row(above: Column, word: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.size(template)), F.array(F.lit(0)), lambda left, j: F.concat(left, F.array(
            F.when(F.get(template, j - 1) == word, F.get(above, j - 1) + 1).otherwise(F.greatest(F.get(above, j), F.get(left, j - 1))))))

    longest = F.array_max(F.aggregate(words, F.array_repeat(F.lit(0), F.size(template) + 1), row))
    return F.when(F.size(template) > 0, longest).otherwise(F.lit(0))


def _reads_as(run: Column, template: Column, need: Column, anchors: Column, excluded: Column) -> Column:
    """Whether some stretch of the run, up to twice the template, holds it in order and tells it from its like."""
    def stretch(start: Column) -> Column:
        whole = F.slice(run, start + 1, 2 * F.size(template))
        stop = F.array_position(F.transform(whole, lambda w: F.array_contains(excluded, w)), F.lit(True)).cast("int")
        return F.filter(F.when(stop > 0, F.slice(whole, 1, stop - 1)).otherwise(whole), lambda w: F.array_contains(template, w))

    def holds(words: Column) -> Column:
        def around(a: Column) -> Column:
            places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda p: F.get(words, p) == a["word"])
            return F.exists(places, lambda p: _in_order(F.slice(words, F.lit(1), p), a["before"]) + 1
                            + _in_order(F.slice(words, p + 2, F.size(words)), a["after"]) >= need)
        return (F.size(words) >= need) & F.when(F.size(anchors) > 0, F.forall(anchors, around)).otherwise(_in_order(words, template) >= need)

    starts = F.filter(F.sequence(F.lit(0), F.size(run) - 1), lambda i: F.array_contains(template, F.get(run, i)))
    return F.exists(starts, lambda i: holds(stretch(i)))


def base_places(df: DataFrame, keep: Sequence[str], text: str, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """``keep`` plus word count, places of the phrases' words standing together, first, last and labels."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    hint = "(?i)" + "|".join(GAP.join(p.split()) for p, _ in phrases)
    words = F.when(body.rlike(hint), words_of(body)).otherwise(F.array().cast("array<string>"))

    def places(phrase: str) -> Column:
        parts = phrase.split()
        last = F.size("words") - len(parts)
        starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))

        def here(i: Column) -> Column:
            found = F.get("words", i) == parts[0]
            for k, p in enumerate(parts[1:], 1):
                found = found & (F.get("words", i + k) == p)
            return found

        return F.filter(starts, here)

    found = (df.select(*[F.col(f"`{k}`") for k in keep], F.regexp_count(body, F.lit(RAW_WORD)).cast("long").alias("n_words"),
                       words.alias("words"))
             .withColumns({f"p{i}": places(p) for i, (p, _) in enumerate(phrases)}))
    every = F.concat(*[F.col(f"p{i}") for i in range(len(phrases))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]))
    return found.select(*[F.col(f"`{k}`") for k in keep], "n_words", F.size(every).cast("long").alias("n_base"),
                        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
                        F.array_sort(F.array_distinct(labels)).alias("base"))


def token_order(df: DataFrame, text: str, templates: Sequence[tuple[str, str]] = TEMPLATES) -> list[str]:
    """The templates' words, rarest in the whole corpus first (ties by the word)."""
    own = sorted({w for t, _ in templates for w in t.split()})
    if len(own) > MAX_TEMPLATE_WORDS:
        raise ValueError("more template words than may be broadcast")
    spark = df.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(w,) for w in own], "word string"))
    counted = (df.select(F.explode(F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(RAW_WORD), F.lit(0))).alias("raw"))
               .select(F.lower("raw").alias("word")).join(wanted, "word")
               .groupBy("word").agg(F.count("*").alias("n")))
    counts = {r["word"]: r["n"] for r in counted.collect()}
    return sorted(own, key=lambda w: (counts.get(w, 0), w))


def template_blocks(df: DataFrame, keep: Sequence[str], text: str, templates: Sequence[tuple[str, str]] = TEMPLATES,
                    threshold: float = THRESHOLD) -> DataFrame:
    """Every matching (block, template): ``keep``, ``block`` (the line it starts in), ``template``, ``label``, ``containment``.

    Blocks overlap, so one notice can be found in more than one.
    """
    spark, order = df.sparkSession, token_order(df, text, templates)
    place = {w: i for i, w in enumerate(order)}
    sides = []
    for number, (template, label) in enumerate(templates):
        own, need, said = sorted({place[w] for w in template.split()}), _needed(template, threshold), template.split()
        required, excluded = tell_apart(number, templates, threshold)
        anchors = [(w, said[:said.index(w)], said[said.index(w) + 1:]) for w in required]
        sides += [(order[p], at, number, label, len(own), need, [order[q] for q in own], said, anchors, excluded)
                  for at, p in enumerate(own[:len(own) - need + 1])]
    prefixes = F.broadcast(spark.createDataFrame(
        sides, "word string, t_at int, template int, label string, t_size int, need int, t_words array<string>, t_text array<string>, "
               "anchors array<struct<word:string,before:array<string>,after:array<string>>>, excluded array<string>"))
    least = min(s[5] for s in sides)
    rare = sorted({s[0] for s in sides})
    inside = RAW_WORD.rstrip("+")
    hint = rf"(?i)(?<!{inside})(?:{'|'.join(rare)})(?!{inside})"
    body = F.col(f"`{text}`").cast("string")
    span = max(len(t.split()) for t, _ in templates)
    lines = F.transform(F.split(body, "\n"), lambda line, i: F.transform(words_of(line), lambda w: F.struct(i.alias("at"), w.alias("w"))))
    last = F.greatest(F.ceil(F.size("words") / span).cast("int") - 2, F.lit(0))      # a later run adds no word
    runs = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice("words", k * span + 1, 2 * span))
    cut = (df.filter(body.rlike(hint)).select(*[F.col(f"`{k}`") for k in keep], F.flatten(lines).alias("words"))
           .filter(F.size("words") > 0).select(*[F.col(f"`{k}`") for k in keep], F.explode(runs).alias("run"))
           .select(*[F.col(f"`{k}`") for k in keep], F.get("run", F.lit(0))["at"].alias("block"), F.col("run")["w"].alias("run"))
           .filter(F.arrays_overlap("run", F.array(*[F.lit(w) for w in rare]))))
    # the block's template words in the global order: the order of the first array stays
    blocks = (cut.withColumn("b_words", F.array_intersect(F.array(*[F.lit(w) for w in order]), F.col("run")))
              .filter(F.size("b_words") >= least))
    prefix = F.slice("b_words", 1, F.size("b_words") - least + 1)
    pairs = blocks.select("*", F.posexplode(prefix).alias("b_at", "word")).join(prefixes, "word")
    ahead = 1 + F.least(F.size("b_words") - F.col("b_at") - 1, F.col("t_size") - F.col("t_at") - 1)
    first = F.size(F.array_intersect(F.slice("b_words", 1, F.col("b_at")), "t_words")) == 0   # each pair once
    share = F.size(F.array_intersect("b_words", "t_words"))
    return (pairs.filter((F.size("b_words") >= F.col("need")) & (ahead >= F.col("need")))
            .filter(first).filter(share >= F.col("need"))
            .filter(_reads_as(F.col("run"), F.col("t_text"), F.col("need"), F.col("anchors"), F.col("excluded")))
            .select(*[F.col(f"`{k}`") for k in keep], "block", "template", "label", (share / F.col("t_size")).alias("containment")))


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: counts and places of the base phrases, base labels, all labels and a score.

    The score is 1 where a base phrase stands, else the largest containment of a matching template,
    else 0. Null and empty texts have no words and no labels. Rows are told apart by id and text, so
    repeated rows (and rows that share an id but not the text) each keep their own result; null ids
    work like any other. An empty table gives an empty result.
    """
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body"),
                    F.xxhash64(F.col(f"`{text}`")).alias("mark"))
    base = base_places(src, ["id", "mark"], "body")
    hits = (template_blocks(src, ["id", "mark"], "body", templates, threshold)
            .groupBy(F.col("id").alias("hit_id"), F.col("mark").alias("hit_mark"))
            .agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment")))
    both = base.join(hits, base["id"].eqNullSafe(hits["hit_id"]) & (base["mark"] == hits["hit_mark"]), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.round(F.coalesce("containment", F.lit(0.0)), 6))
    return both.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
                       F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                       score.cast("double").alias("score"))


def oracle_sql() -> str:
    """The same rows in DuckDB SQL: containment by a plain join on words, order by the textbook table of common subsequences."""
    def listed(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]::VARCHAR[]"

    values, anchors = [], []
    for i, (t, label) in enumerate(TEMPLATES):
        required, excluded = tell_apart(i, TEMPLATES, THRESHOLD)
        values.append(f"({i}, {listed(t.split())}, '{label}', {len(set(t.split()))}, {_needed(t, THRESHOLD)}, {listed(excluded)}, {max(1, len(required))})")
        anchors += [f"({i}, '{w}', {listed(t.split()[:t.split().index(w)])}, {listed(t.split()[t.split().index(w) + 1:])})" for w in required]
    anchors.append("(-1, '', []::VARCHAR[], []::VARCHAR[])")
    phrase = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES)
    low = f"translate(%s, '{UPPER}', '{LOWER}')"
    span = max(len(t.split()) for t, _ in TEMPLATES)
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({low % "coalesce(text, '')"}, '{WORD}') AS w FROM documents),
ph(p, label, n) AS (VALUES {phrase}),
b AS (SELECT r, s, label FROM (SELECT r, w, p, label, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, ph WHERE len(w) >= n)
      WHERE array_to_string(w[s + 1:s + n], ' ') = p),
ba AS (SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word, list_sort(list_distinct(list(label))) AS base FROM b GROUP BY 1),
tp(i, t, label, n, need, no, kinds) AS (VALUES {", ".join(values)}),
an(i, word, before, after) AS (VALUES {", ".join(anchors)}),
tw AS (SELECT DISTINCT i, need, unnest(t) AS word FROM tp),
ru AS (SELECT r, k, w[k * {span} + 1:(k + 2) * {span}] AS run
       FROM (SELECT r, w, unnest(range(0, CAST(greatest(ceil(len(w) / {span}) - 2, 0) AS BIGINT) + 1)) AS k FROM d WHERE len(w) > 0)),
rw AS (SELECT DISTINCT r, k, unnest(run) AS word FROM ru),
m AS (SELECT r, k, i, count(*) AS c FROM rw JOIN tw USING (word) GROUP BY r, k, i, need HAVING count(*) >= need),
st AS (SELECT *, unnest(range(1, len(run) + 1)) AS f FROM (SELECT m.*, run, t, need, no FROM m JOIN ru USING (r, k) JOIN tp USING (i))),
sw AS (SELECT r, k, i, f, t, need, list_filter(CASE WHEN stop > 0 THEN x[1:stop - 1] ELSE x END, lambda v: list_contains(t, v)) AS x
       FROM (SELECT *, coalesce(list_position(list_transform(x, lambda v: list_contains(no, v)), true), 0) AS stop
             FROM (SELECT r, k, i, f, t, need, no, run[f:f + 2 * len(t) - 1] AS x FROM st WHERE list_contains(t, run[f])))),
pr AS (SELECT r, k, i, f, need, '' AS word, 0 AS a, 0 AS side, x, t FROM sw WHERE i NOT IN (SELECT i FROM an) AND len(x) >= need
       UNION ALL SELECT r, k, i, f, need, word, a, side, CASE WHEN side = 0 THEN x[1:a - 1] ELSE x[a + 1:] END, CASE WHEN side = 0 THEN before ELSE after END
       FROM (SELECT sw.*, word, before, after, unnest(range(1, len(x) + 1)) AS a FROM sw JOIN an USING (i) WHERE len(x) >= need), (VALUES (0), (1)) AS s(side) WHERE x[a] = word),
lc AS (SELECT r, k, i, f, need, word, a, side, x, t, 0 AS p, list_transform(range(0, len(t) + 1), lambda j: 0) AS v FROM pr
       UNION ALL SELECT r, k, i, f, need, word, a, side, x, t, p + 1,
              list_transform(range(0, len(t) + 1), lambda j: CASE WHEN j = 0 THEN 0 ELSE list_max(list_transform(range(1, j + 1),
                  lambda q: CASE WHEN t[q] = x[p + 1] THEN v[q] + 1 ELSE v[q + 1] END)) END) FROM lc WHERE p < len(x)),
an2 AS (SELECT r, k, i, f, need, word, a, sum(list_max(v)) + max(CASE WHEN word = '' THEN 0 ELSE 1 END) AS ordered FROM lc WHERE p = len(x) GROUP BY r, k, i, f, need, word, a),
ok AS (SELECT r, k, i, f, count(DISTINCT word) AS c FROM an2 WHERE ordered >= need GROUP BY ALL),
fo AS (SELECT DISTINCT m.r, m.k, m.i, m.c, label, n FROM ok JOIN tp USING (i) JOIN m USING (r, k, i) WHERE ok.c = kinds),
ma AS (SELECT r, list_distinct(list(label)) AS more, max(c / n) AS share FROM fo GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(base, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE round(coalesce(share, 0.0), 6) END AS DOUBLE) AS score
FROM d LEFT JOIN ba USING (r) LEFT JOIN ma USING (r)"""
