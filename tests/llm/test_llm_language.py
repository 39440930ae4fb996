"""Language identification: n-grams, training, calibration, odd rows, held-out accuracy."""

import os
import random
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from llm_frames import CLASHES, DOCS, frame  # noqa: E402

from fabflow.llm import language_id as li  # noqa: E402
from fabflow.llm import labels as L  # noqa: E402
from fabflow.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.01"
SOUNDS = {"a": ["ba", "ra", "ma", "sha"], "b": ["né", "ré", "té", "çé"], "c": ["漢", "字", "語", "文"], "d": ["ba", "ro", "mo", "sho"]}


def speak(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def docs_frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", *[f"{i} as `{c}`" for i, c in enumerate([*CLASHES, "id", "draw", "rank", "mark", "bucket", "n", "lang_pred", "held_out"])
                                if c not in ("score",)])


def spoken(n=400, seed=1):
    rng = random.Random(seed)
    return [(i, speak(rng, lang := "abcd"[i % 4 if i % 3 else 0], rng.randint(3, 30)), lang, "s") for i in range(n)]


def brute_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    words = " " + " ".join(letters.split()) + (" " if letters.endswith(" ") else "")
    return [words[i - k + 1:i + 1] for i in range(1, len(words)) for k in (1, 2, 3) if i - k + 1 >= 0]


def bucket(gram):
    key = 0
    for c in gram:
        key = key << 21 | ord(c)
    return int(li._buckets(np.array([key], np.uint64))[0])


def test_grams_equal_brute_force_at_any_cut(monkeypatch):
    letters = li.letter_table()
    for text in ["Abc", "a", " é1É ", "漢字 🎉 it's  twice", "x" * 50 + " yz" * 9, "Ünï, cödé!" * 7]:
        want = {}
        for g in brute_grams(text):
            want[bucket(g)] = want.get(bucket(g), 0) + 1
        for size in (1 << 20, 1, 2, 5, 16):
            monkeypatch.setattr(li, "PIECE_BYTES", size)
            ids, counts = li.grams(text.encode(), letters)
            assert dict(zip(ids.tolist(), counts.tolist(), strict=True)) == want, (text, size)
    assert not len(li.grams("12 — 🎉 _".encode(), letters)[0]) and not len(li.grams(b"", letters)[0])


def test_document_frequencies_cover_every_text(spark):
    texts = [f"ab {chr(97 + i % 5)}z" for i in range(50)] + ["", None, "12"]
    df, n = li.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    assert n == 50 and df[bucket("ab ")] == 50 and df[bucket(" cz")] == 10


def test_learns_sparse_calibrated_weights(spark):
    docs = docs_frame(spark, spoken())
    model = li.train(docs)
    rows = li.predictions(li.score(docs, model)).collect()
    truth = {i: lang for i, _, lang, _ in spoken()}
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(held) > 60 and np.mean(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"] for r in rows if r["held_out"]} == {r[0] for r in docs.select("doc_id", L.fold("doc_id", 4)).collect() if r[1] == 2}
    assert 0 < (model["weights"] != 0).sum() < model["weights"].size and len(model["weights"]) < (model["place"].size // 4)


def test_held_out_languages_teach_nothing(spark):
    rows = spoken(120)
    held = {r[0] for r in docs_frame(spark, rows).select("doc_id", L.fold("doc_id", 4)).collect() if r[1] == 2}
    other = [(i, t, "wrong" if i in held else lang, "x") for i, t, lang, _ in rows]
    answers = []
    for some in (rows, other):
        docs = docs_frame(spark, some)
        answers.append(sorted(map(tuple, li.score(docs, li.train(docs)).collect())))
    assert answers[0] == answers[1]


def test_temperature_has_the_least_log_loss():
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 3, 400)
    logits = 9 * rng.normal(size=(400, 3))
    logits[np.arange(400), labels] += 4

    def loss(t):
        z = logits / t
        return (np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1)) + z.max(axis=1) - z[np.arange(400), labels]).mean()

    best = li.temperature(logits, labels)
    assert best > 1 and all(loss(best) <= loss(best * f) + 1e-9 for f in (0.5, 0.9, 0.99, 1.01, 1.1, 2))
    assert li.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_sample_is_bounded_and_counts_repeated_rows_once(spark):
    rows = [(i, f"text {i}", "x", "s") for i in range(500)] + [(1, "text 1", "x", "s")] * 700 + [(9, "y", "y", "s")]
    df = spark.createDataFrame(rows, "id long, text string, lang string, source string").select("id", "lang", "text")
    few, langs = li.sample(df, 20)
    got = few.collect()
    assert langs == ["x", "y"] and 15 <= len([r for r in got if r["lang"] == "x"]) <= 20
    assert len({(r["id"], r["lang"], r["mark"]) for r in got}) == len(got)


def test_odd_rows_and_no_model(spark):
    rows = [(i, t, lang, None) for (i, t), lang in zip(DOCS, ["en", None, "en", "en", "", "de"] * 3, strict=True)]
    docs = docs_frame(spark, [*rows, *[(100 + i, "ab cd" * 9, "de", "s") for i in range(9)], (None, "12 34", "en", "s")])
    for model in (li.train(docs), li.train(docs.filter("doc_id is null")), li.train(docs.limit(0))):
        got = li.predictions(li.score(docs, model)).collect()
        assert len(got) == len(rows) + 10 and all(0 <= r["score"] <= 1 and r["lang_pred"] is not None and r["held_out"] is not None for r in got)
        for r in li.score(docs, model, keep=["doc_id", "text"]).collect():
            if not any(c.isalpha() for c in r["text"] or ""):
                assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        same = {(r["lang_pred"], r["score"]) for r in got if r["doc_id"] == 9}
        assert len(same) == 1
    assert li.score(docs.limit(0), model).count() == 0
    assert li.train(docs.filter("doc_id is null"))["langs"] == []


def test_held_out_accuracy_on_the_test_table(spark):
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_language_id(spark, SF).collect()
    held = [r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert len(rows) == len(truth) and np.mean(held) > 0.97
