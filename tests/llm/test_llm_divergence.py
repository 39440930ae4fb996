"""Source divergence and its perfect hashes against plain dictionaries."""

import os
import random
import re
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from llm_frames import CLASHES, DOCS, lower  # noqa: E402

from fabflow.llm import source_divergence as sd  # noqa: E402

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def docs_frame(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    return df.selectExpr("*", *[f"{i} as `{c}`" for i, c in enumerate([*CLASHES, "slot", "n", "shard", "size", "term", "value", "doc_id"]) if c != "item"])


def brute(rows, top=200):
    docs = [(TERM.findall(lower(t)), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == lang]
        seen = {}
        for words, _, _ in mine:
            for w in set(words):
                seen[w] = seen.get(w, 0) + 1
        kept = sorted(w for w, n in seen.items() if n >= 3)
        counts = {s: dict.fromkeys(kept, 0) for s in {d[2] for d in mine}}
        for words, _, s in mine:
            for w in words:
                if w in counts[s]:
                    counts[s][w] += 1
        whole = {w: sum(c[w] for c in counts.values()) for w in kept}

        def share(c, w):
            return 1 + 10 ** 9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        def gap(a, b, w):
            p, q = share(a, w), share(b, w)
            return (p - q) ** 2 // q

        for s, c in counts.items():
            pair = [(-sum(gap(c, o, w) for w in kept), x.encode(), x) for x, o in counts.items() if x != s]
            term = [(-gap(c, whole, w), w.encode(), w) for w in kept if c[w] > 0 and share(c, w) > share(whole, w)]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, x, -v, i + 1) for i, (v, _, x) in enumerate(found)]
    return sorted(out)


def corpus(rng, n):
    words = [f"{a}{b}" for a in "abcdeéß漢" for b in "fghijklmnop"] + ["x" * 200, "x" * 201, "y" * 129]
    rows = []
    for i in range(n):
        some = rng.sample(words, 30) if i % 3 else words
        text = " ".join(rng.choice(some).title() if i % 2 else rng.choice(some) for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "en", "de", None, ""]), rng.choice(["web", "books", None, "", "Zeitung", "é"])))
    return rows + [(t, "en", "odd") for _, t in DOCS] + [(None, None, None), ("1 2 3", "numbers", "a"), ("", "numbers", "b"), ("alone", "one", "a")]


def test_audit_equals_brute_force(spark):
    rows = corpus(random.Random(4), 120)
    want = brute(rows)
    assert sorted(map(tuple, sd.audit(docs_frame(spark, rows)).collect())) == want
    # many shards in many blocks, so that languages are read several times
    assert sorted(map(tuple, sd.audit(docs_frame(spark, rows), block_bytes=700, shard_terms=5).collect())) == want
    assert {r[2] for r in want} == {"pair", "term"}


def test_audit_of_a_hot_source_and_a_top_limit(spark):
    rng = random.Random(6)
    rows = [(" ".join(rng.choices([f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500)], k=300)), "en", "hot" if i % 3 else f"s{i % 4}")
            for i in range(60)]
    got = sorted(map(tuple, sd.audit(docs_frame(spark, rows), top=20).collect()))
    assert got == brute(rows, 20) and max(r[5] for r in got) == 20


def test_audit_of_nothing(spark):
    assert sd.audit(docs_frame(spark, [])).count() == 0


def slots_of(terms, total, monkeypatch=None):
    """Slots over every shard of ``terms`` dealt the way the operator deals them."""
    h = sd.hashes(terms)
    dealt = {}
    for t, x in zip(terms, h.tolist(), strict=True):
        dealt.setdefault((x >> 40) % total, []).append(t)
    rows = []
    for shard in range(total):
        mine = sorted(dealt.get(shard, []))
        sizes, bits, slot = sd.perfect_hash(sd.hashes(mine))
        assert sorted(slot.tolist()) == list(range(len(mine)))
        ordered = sd.stored([mine[i] for i in np.argsort(slot).tolist()])
        ends = np.cumsum([0, *map(len, ordered)]).astype(np.int32)
        rows.append((shard, len(mine), sizes, np.packbits(bits).tobytes(), b"".join(ordered), ends.tobytes()))
    return sd.Slots([r for r in rows if r[1]], total)


def test_perfect_hash_is_minimal_and_verified():
    rng = random.Random(8)
    terms = list({bytes(rng.choices(b"abcdefgh", k=rng.randint(1, 12))) for _ in range(5000)} | {b"q" * 300, b"q" * 301})
    kept, foreign = terms[:3000], terms[3000:]
    at = slots_of(kept, 1)
    found = at.find(kept)
    assert sorted(found.tolist()) == list(range(len(kept))) and at.n == len(kept)
    assert (at.find(foreign) == -1).all() and len(foreign) > 500
    for total in (4, 2000):                                    # many of 2000 shards are empty
        some = slots_of(kept, total)
        assert sorted(some.find(kept).tolist()) == list(range(len(kept))) and (some.find(foreign) == -1).all()


def test_keys_of_equal_hashes_keep_their_own_slots(monkeypatch):
    plain = sd.hashes
    monkeypatch.setattr(sd, "hashes", lambda terms: plain(terms) & np.uint64(0xFF0000000000001F))
    kept, foreign = [f"k{i}".encode() for i in range(400)], [f"f{i}".encode() for i in range(400)]
    at = slots_of(kept, 3)
    assert sorted(at.find(kept).tolist()) == list(range(400)) and (at.find(foreign) == -1).all()


def test_words_of_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(sd, "PIECE_BYTES", 7)
    data = "Abc defghijklmnop é1é  q,r\0s " * 9
    assert [w for part in sd.pieces(data.encode()) for w in part] == [w.encode() for w in TERM.findall(lower(data))]


def test_shares_are_exact_beyond_sums_of_64_bits():
    rng = random.Random(2)
    for _ in range(300):
        total = rng.randint(1, 9 * 10 ** 15)
        count = rng.randint(0, total - 1)
        assert sd.shares(np.array([count]), np.array([total])).tolist() == [1 + 10 ** 9 * (count + 1) // total]
