"""Suffix-array rules, licence join and URL filters against brute force."""

import os
import random
import re
import sys
from itertools import combinations
from math import log

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from pyspark.sql import functions as F  # noqa: E402
from llm_frames import DOCS, NAME_WORD, SPACE_WORD, empty, frame, lower  # noqa: E402

from fabflow.llm import license_join, suffix_rules, url_segments  # noqa: E402


def test_longest_repeats_equal_brute_force():
    rng = random.Random(1)
    for n in [0, 1, 2, 3, 17, 40, 64, 65] + [rng.randint(2, 60) for _ in range(60)]:
        ids = np.array([rng.randint(0, rng.choice([1, 2, 4])) for _ in range(n)], np.int64)
        want = [0] * n
        for i, j in combinations(range(n), 2):
            k = 0
            while j + k < n and ids[i + k] == ids[j + k]:
                k += 1
            want[i], want[j] = max(want[i], k), max(want[j], k)
        assert suffix_rules.longest_repeats(ids).tolist() == want if n else True


def brute_rules(text):
    t = text or ""
    words = SPACE_WORD.findall(t)
    lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]

    def inside(size):
        grams = {}
        for p in range(len(words) - size + 1):
            grams.setdefault(tuple(words[p:p + size]), []).append(p)
        return {p + k for ps in grams.values() if len(ps) > 1 for p in ps for k in range(size)}

    n, rep = len(words), len(inside(5))
    failed = n < 10 or 100 * rep > 20 * n
    kept = not failed and 100 * len(inside(suffix_rules.MIN_REPEAT)) <= suffix_rules.MAX_COVERED_PERCENT * n and not inside(suffix_rules.MAX_LONGEST + 1)
    return (n, len("".join(words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep, failed, kept)


def test_suffix_rule_rows(spark):
    line = " ".join(f"v{i}" for i in range(12))
    long = " ".join(f"u{i}" for i in range(110))
    filler = " ".join(f"t{i}" for i in range(900))
    docs = [*DOCS, (20, f"{line}\n{filler}\n{line}\n{line} "), (21, f"{long} {filler} {long}"), (22, "#*$ |x|\n\n#*$ |x|\n" + line),
            (23, " ".join(f"s{i}" for i in range(35)) + f" {line[:34]} q {line[:34]}")]
    rows = suffix_rules.judge(frame(spark, docs)).drop("n_covered", "longest").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(((i, *brute_rules(t)) for i, t in docs), key=str)
    assert not {r["doc_id"]: r["kept"] for r in rows}[21]
    assert suffix_rules.judge(empty(spark)).count() == 0


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def brute_match(run, number):
    """Whether the run reads as the template, by trying every stretch and every place of every required word."""
    text = license_join.TEMPLATES[number][0].split()
    need = license_join._needed(" ".join(text), license_join.THRESHOLD)
    required, excluded = license_join.tell_apart(number, license_join.TEMPLATES, license_join.THRESHOLD)
    if len(set(run) & set(text)) < need:
        return False
    for i, w in enumerate(run):
        if w not in text:
            continue
        stretch = run[i:i + 2 * len(text)]
        stretch = stretch[:next((k for k, x in enumerate(stretch) if x in excluded), len(stretch))]
        good = [any(x == r and common(stretch[:p], text[:text.index(r)]) + 1 + common(stretch[p + 1:], text[text.index(r) + 1:]) >= need
                    for p, x in enumerate(stretch)) for r in required]
        if all(good) and (required or common(stretch, text) >= need):
            return True
    return False


def brute_license(text):
    words = NAME_WORD.findall(lower(text))
    places, base, more, share = [], set(), set(), 0.0
    for phrase, label in license_join.PHRASES:
        parts = phrase.split()
        for p in range(len(words) - len(parts) + 1):
            if words[p:p + len(parts)] == parts:
                places.append(p)
                base.add(label)
    span = max(len(t.split()) for t, _ in license_join.TEMPLATES)
    for k in range(max(-(-len(words) // span) - 2, 0) + 1):
        run = words[k * span:(k + 2) * span]
        for number, (template, label) in enumerate(license_join.TEMPLATES):
            if brute_match(run, number):
                more.add(label)
                share = max(share, len(set(run) & set(template.split())) / len(set(template.split())))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | more)), 1.0 if base else round(share, 6))


def test_license_rows(spark):
    rng = random.Random(4)
    docs = list(DOCS)
    for i in range(60):        # template words dropped, doubled, shuffled, mixed with others and with other scripts
        words = rng.choice(license_join.TEMPLATES)[0].split()
        words = [w for w in words if rng.random() > 0.12] + rng.choices(["the", "K", "İmit", "étude", "of", "nc", "sa"], k=rng.randint(0, 3))
        if rng.random() < 0.4:
            rng.shuffle(words)
        docs.append((100 + i, "x y\n" + rng.choice([" ", ", ", "--"]).join(w.upper() if rng.random() < 0.3 else w for w in words) + "\nz"))
    docs += [(200, "Cc\n\nBY cc-by"), (201, "no licence at all"), (201, "cc by")]
    rows = license_join.scan(frame(spark, docs)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(((i, *brute_license(t)) for i, t in docs), key=str)
    assert license_join.scan(empty(spark)).count() == 0


def test_license_notices_that_wrap(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that"
    filler = "\n".join(f"line{i} of nothing" for i in range(40))
    narrow = "\n".join("Permission is hereby granted, free of charge, to any person obtaining a copy of this software".split())
    spread = "you may not use " + " ".join(f"s{i}" for i in range(60)) + " this file except in compliance with the license"
    apart = "licensed under\n" + " ".join(f"s{i}" for i in range(60)) + "\nthe mit license"
    docs = [(1, bsd), *[(10 + k, "w " * k + f"\n{filler}\n{narrow}\n{filler}") for k in range(0, 34, 3)], (2, spread), (3, apart), (4, filler),
            (5, "Der schheitau der den mit.\nLicensed under the Apache License, Version 2.0.")]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_join.scan(frame(spark, docs)).collect()}
    assert got[1] == ("bsd", 1.0) and all(got[10 + k] == ("mit", 1.0) for k in range(0, 34, 3))
    assert got[2] == got[3] == got[4] == ("", 0.0)
    assert got[5] == ("apache-2.0", 1.0)
    assert license_join.template_blocks(frame(spark, [(1, f"\n\n{bsd}")], False), ["doc_id"], "text").first()["block"] == 2


#: (text, labels): notices as people write them, and prose that holds the same words.
NOTICES = [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"), ("licensed under\nCC-BY-SA 4.0", "cc-by,cc-by-sa-4.0"), ("Licensed under CC BY 4.0", "cc-by,cc-by-4.0"),
    ("Text is licensed under CC BY-NC 4.0. Pictures are licensed under CC BY-SA 4.0.", "cc-by,cc-by-nc-4.0,cc-by-sa-4.0"),
    ("Text licensed under CC BY 4.0; data licensed under CC BY-NC 4.0", "cc-by,cc-by-4.0,cc-by-nc-4.0"),
    ("Released under the MIT License.", "mit"), ("This library is licensed under the terms of the MIT license", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\n of this software", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the License);", "apache-2.0"),
    ("you may not use this file except in compliance with the License.", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl,gpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under", "gpl"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("This work is licensed under a Creative Commons Attribution license", "cc-by"),
    ("She was released from MIT in June. A search began under the bridge; a driving license was found under her desk.", ""),
    ("the license under which mit was released", ""), ("A license of 2 parts by 4 poets, under 0 laws, cc nobody: licensed", ""),
    ("Der schheitau der den mit.\nThe licensed under writer had a license", ""), ("version 2 of the apache tale was licensed, under 0 license", ""),
    ("free software person, granted a copy: permission to charge is hereby any", ""), ("Licensed under CC BY 4.0 in Raleigh, NC", "cc-by,cc-by-4.0"),
    ("released " + "x " * 30 + "under the mit " + "y " * 30 + "license", ""),
]


def test_license_labels_are_right_on_notices_and_prose(spark):
    filler = "word " * 40
    docs = [(i, t) for i, (t, _) in enumerate(NOTICES)] + [(100 + i, filler + t + " " + filler) for i, (t, _) in enumerate(NOTICES)]
    got = {r["doc_id"]: r["labels"] for r in license_join.scan(frame(spark, docs)).collect()}
    want = {k + i: labels for i, (_, labels) in enumerate(NOTICES) for k in (0, 100)}
    found = {(i, x) for i, labels in got.items() for x in labels.split(",") if x}
    true = {(i, x) for i, labels in want.items() for x in labels.split(",") if x}
    assert found == true, (found - true, true - found)              # precision and recall are both 1


def test_words_that_tell_licences_apart():
    told = {t: license_join.tell_apart(i, license_join.TEMPLATES, license_join.THRESHOLD) for i, (t, _) in enumerate(license_join.TEMPLATES)}
    assert told["licensed under cc by nc 4 0"] == (["nc"], []) and told["licensed under cc by 4 0"] == ([], ["nc", "sa"])
    assert told["licensed under the mit license"] == ([], [])


def test_license_plan_runs_no_python(spark):
    df = license_join.scan(frame(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def all_splits(name):
    if not name:
        yield []
    for k in range(1, len(name) + 1):
        for rest in all_splits(name[k:]):
            yield [name[:k], *rest]


def test_viterbi_finds_the_best_split():
    rng = random.Random(6)
    counts = {"the": 50, "he": 9, "t": 3, "news": 20, "new": 8, "s": 4, "a": 30, "day": 12, "today": 5, "to": 40}
    total = float(sum(counts.values()))

    def score(split):
        return sum(log(counts[w]) - log(total) if w in counts else log(10) - log(max(total, 100)) - len(w) * log(10) for w in split)

    for _ in range(150):
        name = "".join(rng.choice([*counts, "x", "q"]) for _ in range(rng.randint(1, 4)))[:11]
        words = {(i, k): log(counts[name[i:i + k]]) - log(total) for i in range(len(name)) for k in range(1, len(name) - i + 1)
                 if name[i:i + k] in counts}
        got = url_segments.viterbi(name, words, total)
        assert "".join(got) == name
        assert score(got) == pytest.approx(max(map(score, all_splits(name))))


URLS = ["https://www.Example.org/es/12", "https://example.org/en/1x", "http://example.org/en/2", "https://a.example.com/fr/1?x=/de/",
        "https://b.net/de/3#top", "https://b.net/fr/3", "https://badexample.org.net/es/", "nothing here", None, "", "://", "x://org", "x://org/",
        "http://com/de/", "http://xcom/de/9", "http://host.com?/fr/", "http://A.B.C/%20/Ünï/42", "https://b.net/de/3#top", "ftp://u@h.org:80/a://b"]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = [(len(h + p), h + p, v) for v, h, p in url_segments.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def test_url_rows(spark):
    many = [f"http://site{'news' if i % 3 else 'spam'}.com/{'fr' if i % 3 else 'de'}/{i}" for i in range(60)] + ["http://news.net/x", "http://spam.net/x"]
    rows = [(i if i != 4 else None, u, f"<p>the news {'spam' if i % 2 else 'site'} site</p>" if i % 7 else None) for i, u in enumerate(URLS + many)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 as host", "2 as path", "3 as rule", "4 as verdict", "5 as name", "6 as odds", "7 as id", "8 as weight")
    got = url_segments.judge(pages).collect()
    assert len(got) == len(rows)
    by_url = {(r["host"], r["path"]): r for r in got}
    for _, u, _ in rows:
        host, path, rule, verdict = brute_url(u)
        r = by_url[host, path]
        assert r["rule"] == rule and r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
    assert sorted(str(r["page_id"]) for r in got) == sorted(str(i) for i, _, _ in rows)
    # words of allowed hosts and paths pull to allow, those of blocked ones to block
    assert by_url["news.net", "/x"]["verdict"] == "allow" and by_url["spam.net", "/x"]["verdict"] == "block"


def test_url_odds_equal_brute_force(spark):
    urls = ["http://com/fr/a", "http://x.com/fr/a1", "http://x.com/fr/a1", "http://y.com/de/b", "http://y.net/a/b/b", "http://z.net", "odd"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r["log_odds"] for r in url_segments.judge(pages).collect()}

    def tokens(u):
        host, path, _, verdict = brute_url(u)
        found = re.findall(r"[0-9]+|[^\x00-\x2F0-9\x3A-\x60\x7B-\x7F]+", f"{host} {lower(path)}")
        return [f"#{len(t)}" if t.isdigit() else t for t in found], verdict

    seen = {"allow": {}, "block": {}, None: {}}
    docs = {"allow": 0, "block": 0, None: 0}
    for u in urls:
        ts, v = tokens(u)
        docs[v] += 1
        for t in ts:
            seen[v][t] = seen[v].get(t, 0) + 1
    vocabulary = {t for v in seen.values() for t in v}
    size = {v: sum(seen[v].values()) + len(vocabulary) + 1 for v in seen}
    for i, u in enumerate(urls):
        want = log((docs["allow"] + 1) / (docs["block"] + 1)) + sum(
            log((seen["allow"].get(t, 0) + 1) / size["allow"]) - log((seen["block"].get(t, 0) + 1) / size["block"]) for t in tokens(u)[0])
        assert got[i] == pytest.approx(want, abs=1e-8)


def test_words_of_any_count_and_length_split_names(spark):
    long = "pneumonoultramicroscopicsilicovolcanoconiosis"
    pages = spark.createDataFrame([("the blue garden a Blue garden " + long + " " + long[:20] + " äöü ab",), ("blue<b>x</b> nothing",)], "html string")
    counts = url_segments.unigrams(pages, "html")
    assert {r["word"]: r["n"] for r in counts.collect()} == {"the": 1, "blue": 3, "garden": 2, "a": 1, long: 1, long[:20]: 1, "äöü": 1, "ab": 1, "x": 1, "nothing": 1}
    names = spark.createDataFrame([("bluegarden",), ("the" + long + "garden",), (long[:20] + "blue",), ("zzz",), ("abx",)], "name string")
    places = {(r["name"], r["start"], r["size"], r["n"]) for r in url_segments.word_places(names, counts).collect()}
    words = {r["word"]: r["n"] for r in counts.collect()}
    assert places == {(n, i + 1, k, words[n[i:i + k]]) for (n,) in names.collect() for i in range(len(n)) for k in range(1, len(n) - i + 1) if n[i:i + k] in words}
    got = {r["name"]: r["words"] for r in url_segments.segment(names, counts).collect()}
    assert got["bluegarden"] == ["blue", "garden"] and got["the" + long + "garden"] == ["the", long, "garden"]
    assert got[long[:20] + "blue"] == [long[:20], "blue"] and got["zzz"] == ["zzz"]


def test_url_odds_with_split_names_equal_brute_force(spark):
    rng = random.Random(9)
    words = ["blue", "garden", "news", "the", "a", "s", "new", "day", "unseen"]
    urls = [f"http://{''.join(rng.choices(words, k=rng.randint(1, 3)))}.{rng.choice(['com', 'net', 'org'])}/"
            f"{rng.choice(['fr/', 'de/', ''])}{''.join(rng.choices(words, k=2))}" for _ in range(60)]
    html = [" ".join(rng.choices(words[:-1], k=5)) + (" äß " if i % 9 == 0 else "") for i in range(60)]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(zip(urls, html, strict=True))], "page_id long, url string, html string")
    got = {r["page_id"]: r["log_odds"] for r in url_segments.judge(pages).collect()}
    counts = {}
    for w in " ".join(html).split():
        counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())

    def split(name):
        def score(parts):
            return sum(log(counts[w]) - log(total) if w in counts else log(10) - log(max(total, 100)) - len(w) * log(10) for w in parts)
        best = [(0.0, [])]                                       # plain dynamic programme over all pieces
        for end in range(1, len(name) + 1):
            best.append(max((best[i][0] + score([name[i:end]]), best[i][1] + [name[i:end]]) for i in range(end)))
        return best[-1]

    def tokens(u):
        host, path, _, verdict = brute_url(u)
        out = []
        for t in re.findall(r"[0-9]+|[^\x00-\x2F0-9\x3A-\x60\x7B-\x7F]+", f"{host} {lower(path)}"):
            parts = url_segments.viterbi(t, {(i, k): log(counts[t[i:i + k]]) - log(total) for i in range(len(t))
                                             for k in range(1, len(t) - i + 1) if t[i:i + k] in counts}, float(total))
            best = split(t)[0]
            mine = sum(log(counts[w]) - log(total) if w in counts else log(10) - log(max(total, 100)) - len(w) * log(10) for w in parts)
            assert mine == pytest.approx(best)
            out += parts
        return out, verdict

    seen, docs = {"allow": {}, "block": {}, None: {}}, {"allow": 0, "block": 0, None: 0}
    for u in urls:
        ts, v = tokens(u)
        docs[v] += 1
        for t in ts:
            seen[v][t] = seen[v].get(t, 0) + 1
    assert all(docs.values())
    vocabulary = {t for v in seen.values() for t in v}
    size = {v: sum(seen[v].values()) + len(vocabulary) + 1 for v in seen}
    for i, u in enumerate(urls):
        want = log((docs["allow"] + 1) / (docs["block"] + 1)) + sum(
            log((seen["allow"].get(t, 0) + 1) / size["allow"]) - log((seen["block"].get(t, 0) + 1) / size["block"]) for t in tokens(u)[0])
        assert got[i] == pytest.approx(want, abs=1e-8)


def test_url_empty_table(spark):
    assert url_segments.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_words_are_found_by_a_cheap_pattern_that_equals_the_fixed_one(spark):
    import time
    points = [c for c in (*range(0x300), *range(0x2000, 0x2100), 0xD7FF, 0xE000, 0xFEFF, 0xFFFF, *range(0x10000, 0x10010), 0x1F600, 0x10FFFF)]
    text = "".join(f"a{chr(c)}Z{chr(c)}" for c in points)
    df = spark.createDataFrame([(text,)], "text string")
    found, fixed = df.select(license_join.words_of(F.col("text")), F.regexp_extract_all(license_join.lowered(F.col("text")), F.lit(license_join.WORD), F.lit(0))).first()
    assert found == fixed and len(found) > 100
    long = spark.range(8).select(F.concat(F.col("id").cast("string"), F.repeat(F.lit("é license ü "), 100_000)).alias("text")).cache()
    long.count()

    def seconds(pattern: str) -> float:
        at = time.monotonic()
        assert long.select(F.sum(F.regexp_count("text", F.lit(pattern)))).first()[0] == 8 * 300_000
        return time.monotonic() - at

    ranges = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"             # the same class as a list of ranges
    assert 1.5 * min(seconds(license_join.RAW_WORD) for _ in range(3)) < min(seconds(ranges) for _ in range(3))
