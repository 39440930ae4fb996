"""Quality and toxicity models: held-out accuracy, folds, odd inputs; the pipeline against its operators."""

import os
import sys
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from llm_frames import DOCS, empty, frame  # noqa: E402

import corpus_pipeline  # noqa: E402
from fabflow.llm import labels as L  # noqa: E402
from fabflow.llm import pairwise_quality, queries, simhash_grid, toxicity_mil  # noqa: E402

SF = "/root/testdata/sf0.01"


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "1 as id", "2 as label", "3 as text")


def test_fold_is_crc32(spark):
    rows = spark.createDataFrame([(0,), (7,), (12345,), (None,)], "doc_id long").select("doc_id", L.fold("doc_id", 4)).collect()
    assert all(r[1] == zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 4 for r in rows)


def test_sample_leaves_the_held_out_fold(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(200)])
    sample, counts = L.training_sample(docs, labels_frame(spark, [(i, 1, i % 2) for i in range(200)] + [(5, 1, None), (None, 1, 1)]),
                                       "toxic", 3, 1, 20)
    got = [int(r["text"].split()[1]) for r in sample.collect()]
    assert len(got) == 40 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in got)
    assert sum(counts.values()) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(200))


def test_training_sample_counts_only_labels_of_rows_that_are_there(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)] + [(3, "text 3")] * 30 + [(4, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    every, counts = L.training_sample(docs, labels, "toxic", 3, 1, 50)
    taught = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1]
    want = [(f"text {i}", i % 2) for i in taught] + [("other", 0)] * (4 in taught)
    assert sorted(map(tuple, every.collect())) == sorted(want)
    assert counts == {v: sum(x == v for _, x in want) for v in (0, 1)}
    few, again = L.training_sample(docs, labels, "toxic", 3, 1, 2)
    assert again == counts and sorted(r["label"] for r in few.collect()) == [0, 0, 1, 1]


def synthetic(spark):
    """Toxic words in a few sentences of long texts; shouting and symbols in bad ones."""
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(500):
        text = " ".join(rng.choice(words, rng.integers(5, 120)))
        text = ". ".join(text[k:k + 60] for k in range(0, len(text), 60))
        toxic, good = int(i % 6 == 0), int(i % 5 != 0)
        if toxic:
            text += ". you are a vile" + "abcdefgh"[i % 8] + " thing. ok"
        if not good:
            text = " ".join(w + "%%% $$" for w in text.split())
        docs.append((i, text))
        labels.append((i, good, toxic))
    return frame(spark, docs), labels_frame(spark, labels), docs, labels


def test_toxicity_learns_from_document_labels_and_locates(spark):
    docs, labels, texts, truth = synthetic(spark)
    model = toxicity_mil.train(docs, labels)
    scored = toxicity_mil.score(docs, model)
    rows = {r["doc_id"]: r for r in toxicity_mil.predictions(scored, "doc_id", 3, 1).collect()}
    held = [(rows[i]["predicted"], t) for i, _, t in truth if rows[i]["held_out"]]
    assert len(held) > 100 and np.mean([p == t for p, t in held]) > 0.97
    found = {r["doc_id"]: [dict(texts)[r["doc_id"]].encode()[a:b] for a, b in zip(r["from_bytes"], r["to_bytes"], strict=True)]
             for r in scored.collect()}
    located = [any(b"vile" in s for s in found[i]) for i, _, t in truth if t]
    assert np.mean(located) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_quality_learns_from_pairs(spark):
    docs, labels, _, truth = synthetic(spark)
    model = pairwise_quality.train(docs, labels)
    rows = {r["doc_id"]: r for r in pairwise_quality.predictions(pairwise_quality.score(docs, model)).collect()}
    held = [(rows[i]["predicted"], q) for i, q, _ in truth if rows[i]["held_out"]]
    assert len(held) > 80 and np.mean([p == q for p, q in held]) > 0.97


def test_models_on_odd_rows_and_without_labels(spark):
    none = labels_frame(spark, [])
    for module, score in ((toxicity_mil, toxicity_mil.score), (pairwise_quality, pairwise_quality.score)):
        for labels in (none, labels_frame(spark, [(1, 1, 1), (1, 0, 0), (2, None, None), (8, 0, 1), (8, 0, 1)])):
            model = module.train(frame(spark), labels)
            rows = score(frame(spark), model).collect()
            assert len(rows) == len(DOCS) and all(0 <= r["score"] <= 1 for r in rows)
            same = [r["score"] for r in rows if r["doc_id"] == 9]
            assert same[0] == same[1]
        assert score(empty(spark), model).count() == 0
        assert module.train(empty(spark), none)


def test_classifiers_on_held_out_rows_of_the_test_tables(spark):
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, label, least in (("op2_pairwise_quality", "quality", 0.95), ("op8_toxicity_mil", "toxic", 0.88)):
        rows = queries.QUERIES[name](spark, SF).collect()
        held = [(r["predicted"], truth[r["doc_id"]][label]) for r in rows if r["held_out"] and r["doc_id"] in truth]
        assert np.mean([p == t for p, t in held]) > least, name


def test_pipeline_stages_keep_and_drop_what_their_operators_say(spark, tmp_path):
    docs, labels, _, truth = synthetic(spark)
    base = docs.select("doc_id", "text").selectExpr("*", "'en' as lang", "'s' as source", "cast(length(text) as bigint) as n_chars")
    passage = " ".join(f"leak{i}" for i in range(14))
    shared = " ".join(f"pass{i}" for i in range(30))
    far = [" ".join(f"{c}{i}" for i in range(60)) for c in "pqr"]
    extra = [(900, far[0]), (901, far[0]), (902, far[1] + " " + passage), (903, far[2] + " " + shared),
             (904, " ".join(f"z{i}" for i in range(60)) + " " + shared), (None, far[0]), (None, "lonely text of no id"), (None, None)]
    docs = base.unionByName(spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in extra], base.schema))
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    labels.select("doc_id", "quality", "toxic").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([("b1", passage)], "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, texts = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = spark.createDataFrame(stage(spark, kept, sf).collect(), stage(spark, kept, sf).schema)
        texts[name] = {r["doc_id"]: r for r in kept.collect()}
        if name != "tokens":
            assert kept.columns == corpus_pipeline.COLUMNS
    toxic = {i for i, _, t in truth if t}
    assert len(toxic & set(texts["toxicity"])) < 0.15 * len(toxic)
    assert len({i for i, _, t in truth if not t} - set(texts["toxicity"])) < 0.02 * len(truth)
    near = texts["near_copies"]
    assert 900 in near and 901 not in near and None in near
    groups = simhash_grid.near_duplicates(spark.createDataFrame(list(texts["near_copies"].values()), base.schema))
    assert groups.filter("doc_id is not null and doc_id <> component").count() == 0
    assert near.keys() == texts["repeats"].keys()
    assert shared in texts["repeats"][903]["text"] and shared not in texts["repeats"][904]["text"]
    assert texts["repeats"][904]["n_chars"] == len(texts["repeats"][904]["text"])
    assert set(texts["leaks"]) == set(texts["repeats"]) - {902}
    assert set(texts["tokens"]) == set(texts["leaks"])
    assert corpus_pipeline.run(spark, sf).count() == kept.count()


def test_quality_is_fitted_on_every_labelled_row_and_pair(spark):
    x = np.array([[-3], [0], [5], [64]])
    good, bad = np.array([1.0, 2, 0, 4]), np.array([3.0, 0, 2, 1])
    up, down = pairwise_quality.pulls(x.ravel(), good, bad)
    missed = 1 / (1 + np.exp((x - x.T) / pairwise_quality.GRID))
    assert np.allclose(up, (missed * bad).sum(axis=1) / bad.sum()) and np.allclose(down, (missed * good[:, None]).sum(axis=0) / good.sum())
    n = len(pairwise_quality.statistics(b""))
    values = [float(i) for i in range(9000)]                                   # more than any sample of 4000 a class
    rows = spark.createDataFrame([([v] * n, int(v >= 6000)) for v in values], "stats array<double>, label int")
    cuts = pairwise_quality.quantile_cuts(rows, n)
    assert np.allclose(cuts, [9000 * k / 13 for k in range(1, 13)], rtol=1 / 128)
    one, two = (pairwise_quality.fit(rows.repartition(k), rounds=2) for k in (2, 5))
    assert (one["w"] == two["w"]).all() and (one["cuts"] == two["cuts"]).all() and one["cut"] == two["cut"]
    docs = frame(spark, [(i, "w " * i) for i in range(40)])
    ids = [i for i in range(40) if i % 3]
    every = L.training_rows(docs.unionByName(docs), labels_frame(spark, [(i, 1, 0) for i in ids]), "quality", 4, 2)
    assert every.count() == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)
