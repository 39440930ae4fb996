"""SimHash components, substring dedup and decontamination against brute force."""

import hashlib
import os
import random
import sys

import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from llm_frames import DOCS, LONG, NAME_WORD, SHARED, SPACE_WORD, empty, frame, lower  # noqa: E402

import corpus_pipeline  # noqa: E402
from fabflow.llm import decontaminate, graph, simhash_grid, substring_blocks  # noqa: E402


def brute_print(text):
    words = SPACE_WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    """Smallest id of each component; prints: list of (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(prints):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    return [least.get(find(i)) for i in range(len(prints))]


def test_simhash_rows(spark):
    rows = simhash_grid.near_duplicates(frame(spark)).select("doc_id", simhash_grid.hex_of("fp"), "component").collect()
    prints = [(i, brute_print(t)) for i, t in DOCS]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints, 2), strict=True)]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert simhash_grid.near_duplicates(empty(spark)).count() == 0


def clusters(seed, n):
    """Fingerprints in tight and chained groups, many per grid cell, plus lone ones and the extremes."""
    rng = random.Random(seed)
    found = {0, 1, 3, (1 << 64) - 1, (1 << 63)}
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(n):
            found.add(at)
            for _ in range(rng.randint(0, 3)):
                at ^= 1 << rng.randrange(64)
    found |= {rng.getrandbits(64) for _ in range(n)}
    return sorted(found)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_find_every_component_crowded_or_not(spark):
    for bits in (1, 2):
        prints = clusters(bits, 25)
        df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
        want = brute_components([(signed(p), p) for p in prints], bits)
        for crowd in (1, 24):
            found = {r["node"]: r["root"] for r in graph.components(simhash_grid.links(df, bits, crowd)).collect()}
            assert [found.get(signed(p), signed(p)) for p in prints] == want, (bits, crowd)


def test_no_table_of_all_fingerprints_is_broadcast(spark, monkeypatch):
    from fabflow.llm import rows
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    found = {}

    def noted(df, name):
        found[name] = plan(df)
        return rows.staged(df, name)

    monkeypatch.setattr(simhash_grid, "staged", noted)
    simhash_grid.near_duplicates(frame(spark))
    found["one bit"] = plan(simhash_grid.links(spark.createDataFrame([(i,) for i in range(64)], "fp long"), bits=1, crowd=4))
    docs = frame(spark, clashes=False).selectExpr("doc_id", "text", "'en' lang", "'s' source", "1L n_chars")
    op3, found["last"] = found["cells"], plan(corpus_pipeline.drop_near_copies(spark, docs, ""))
    found |= {"op3": op3, "last": found["last"][found["last"].index("Join") - 9:][:13]}
    for name in ("op3", "cells", "one bit", "last"):
        assert "SortMergeJoin" in found[name] and "Broadcast" not in found[name], name


def test_links_at_one_bit_in_a_crowded_cell(spark):
    df = spark.createDataFrame([(0b0100,), (0b1100,), (0b1101,), (0b1001,)], "fp long")
    found = {r["node"]: r["root"] for r in graph.components(simhash_grid.links(df, 1, 1)).collect()}
    assert found == dict.fromkeys((0b0100, 0b1100, 0b1101, 0b1001), 0b0100)


def test_pipeline_keeps_different_texts_of_one_id(spark):
    texts = [" ".join(f"{c}{i * 31 % 97}" for i in range(60)) for c in "abcd"]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (3, texts[0]), (8, texts[2]), (9, texts[2]), (9, texts[3]),
            (None, texts[3]), (None, None), (None, "alone here"), (None, "alone here")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_copies(spark, docs, "").select("doc_id", "text").collect()
    want = [(3, texts[0]), (7, texts[1]), (8, texts[2]), (9, texts[3]), (None, None), (None, "alone here")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_segment_counts_are_a_lower_bound(spark):
    prints = clusters(9, 10)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for fp, packed in df.select("fp", simhash_grid.counts_of(F.col("fp"))).collect():
        u = fp & (1 << 64) - 1
        assert [packed >> 4 * k & 15 for k in range(16)] == [(u >> 4 * k & 15).bit_count() for k in range(16)]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (205, 200), (200, 205), (100, 220)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(60))
    assert got[205] == got[200] == 200 and got[220] == 100
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_cut(docs, width):
    big = float("inf")
    first = {}
    split = [(i, SPACE_WORD.findall(t or "")) for i, t in docs]
    for i, w in split:
        for p in range(len(w) - width + 1):
            g = tuple(w[p:p + width])
            first[g] = min(first.get(g, big), big if i is None else i)
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - width + 1):
            if first[tuple(w[p:p + width])] < (big if i is None else i):
                gone.update(range(p, p + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def cut_rows(df, **more):
    rows = substring_blocks.remove_repeats(df, **more).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    return sorted(map(tuple, rows), key=str)


def test_substring_rows(spark):
    assert cut_rows(frame(spark)) == sorted(brute_cut(DOCS, 13), key=str)
    assert substring_blocks.remove_repeats(empty(spark)).count() == 0


def test_substring_random_passages(spark):
    rng = random.Random(2)
    passages = [[f"p{k}_{j}" for j in range(rng.randint(5, 40))] for k in range(12)]
    docs = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += [rng.choice("xyz") for _ in range(rng.randint(0, 9))]
            p = rng.choice(passages)
            a = rng.randint(0, 6)
            words += p[a:rng.randint(a, len(p))]
        docs.append((rng.randint(0, 90), " ".join(words)))
    for width, size in ((13, 1 << 20), (6, 600), (1, 900)):
        got = cut_rows(frame(spark, docs), width=width, chunk_bytes=size, bucket_bytes=size)
        assert got == sorted(brute_cut(docs, width), key=str), width


def test_substring_keeps_white_space_where_nothing_goes(spark):
    rows = substring_blocks.remove_repeats(frame(spark, [(1, "a  b\nc"), (2, None)]), tidy=False).collect()
    assert {r["doc_id"]: bytes(r["kept"]) for r in rows} == {1: b"a  b\nc", 2: b""}


ITEMS = [("i1", SHARED), ("i2", "nothing of the kind is anywhere in these documents at all ever"), ("i10", "Single!"), ("i3", None),
         ("i4", ""), ("i1", SHARED), (None, "ten ELEVEN, twelve thirteen fourteen fifteen and then the end"), ("i5", "hé")]


def brute_hits(docs, items, width=10):
    windows = {}
    for name, t in items:
        w = NAME_WORD.findall(lower(t))
        n = min(width, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[p:p + n]), set()).add(name)
    out = []
    for i, t in docs:
        w, hit, names = NAME_WORD.findall(lower(t)), set(), set()
        for n in {len(g) for g in windows}:
            for p in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[p:p + n]))) is not None:
                    hit.update(range(p, p + n))
                    names |= got
        names = sorted(x for x in names if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), len(hit) > 0))
    return out


def test_decontamination_rows(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id string, text string").selectExpr("*", "1 as pattern", "2 as n", "3 as items")
    want = sorted(brute_hits(DOCS, ITEMS), key=str)
    assert sorted(map(tuple, decontaminate.digests(decontaminate.contaminated(frame(spark), items)).collect()), key=str) == want
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 150)      # several automata give the same rows
    assert sorted(map(tuple, decontaminate.digests(decontaminate.contaminated(frame(spark), items)).collect()), key=str) == want


def test_decontamination_of_random_overlaps(spark, monkeypatch):
    rng = random.Random(12)
    items = [(f"i{i}", " ".join(rng.choice("abc") for _ in range(rng.choice([1, 2, 4, 6, 7, 9, 12, 17, 30])))) for i in range(40)] + [("far", "q " * 40)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice("abcz") for _ in range(rng.randint(0, 12))]
            w = rng.choice(items)[1].split()
            a = rng.randint(0, len(w))
            words += w[a:rng.randint(a, len(w))]
        docs.append((i, " ".join(words)))
    table = spark.createDataFrame(items, "item_id string, text string")
    for width, limit in ((7, 1 << 20), (10, 200), (2, 300), (1, 1 << 20)):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", limit)
        got = decontaminate.digests(decontaminate.contaminated(frame(spark, docs), table, width=width)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute_hits(docs, items, width), key=str), width


def test_a_large_benchmark_is_one_pass_over_the_texts(spark):
    rng = random.Random(13)
    items = [(f"i{i}", " ".join(f"w{rng.randrange(200_000)}" for _ in range(120))) for i in range(3000)]       # 2.5 MB; its windows are 25 MB
    docs = [(1, "before " + items[77][1] + " after"), (2, "nothing at all"), (3, " ".join(items[5][1].split()[50:59])), (4, " ".join(items[5][1].split()[50:60]))]
    found = decontaminate.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id string, text string"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    got = {r["doc_id"]: (r["n_hit"], list(r["items"])) for r in found.collect()}
    assert got == {1: (120, ["i77"]), 2: (0, []), 3: (0, []), 4: (10, ["i5"])}


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.contaminated(frame(spark), none).filter("n_hit > 0").count() == 0
    assert decontaminate.contaminated(empty(spark), none).count() == 0


def test_decontamination_offsets_point_into_the_original(spark):
    docs = [(1, f"Ünïcode, before! {SHARED.upper().replace(' ', ' - ')}? after")]
    items = spark.createDataFrame([("i1", SHARED)], "item_id string, text string")
    r = decontaminate.contaminated(frame(spark, docs), items).first()
    a, e = r["from_chars"][0], r["to_chars"][0]
    assert docs[0][1][a:e] == SHARED.upper().replace(" ", " - ")
    assert LONG not in docs[0][1]
