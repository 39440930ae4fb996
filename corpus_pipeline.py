"""A training corpus from ``documents``: toxic texts out, one of each near-copy group, repeats cut,
benchmark leaks out, tokens.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and returns the columns of
``documents`` for the rows it keeps; the last returns the tokens. ``run`` writes every stage's result
as Parquet to the shared folder and hands the reread table to the next.

In every stage an empty table gives an empty result, columns other than those of ``documents`` are
neither read nor returned, whatever their names, and texts are read whole, however long. A stage
sets ``spark.sql.execution.arrow.maxRecordsPerBatch`` to BATCH_ROWS in its session unless it is
smaller already: the setting counts when the result is computed, after the stage has returned, so
it cannot be put back there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabflow.llm import bpe_tree, decontaminate, simhash_grid, substring_blocks, toxicity_mil
from fabflow.llm.rows import join_sorted, read_table, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Toxicity scores from which a document is rejected.
TOXIC = 0.7
#: Documents in one batch between Spark and a Python worker, at most.
BATCH_ROWS = 2000


def _documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of documents, in batches small enough for whole texts to pass through the workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score stays under TOXIC; the model is fitted on this stage's own input.

    Null, empty and wordless texts score the model's leak, so they stay unless nearly every labelled
    text is toxic; rows without an id are judged like others; repeated rows get one verdict and stay.
    Without labels of both kinds nothing can be learnt and all texts score alike.
    """
    docs = _documents(spark, docs)
    model = toxicity_mil.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity_mil.score(docs, model, keep=COLUMNS).filter(F.col("score") < TOXIC).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (3-word shingles, 2 bits) the row least by (doc_id, hash of the text).

    Rows without an id come last. Rows equal in id and text are one document; rows that share an id
    but not the text are different documents. Null, empty and wordless texts have one fingerprint, so
    one of them stays.
    """
    docs = _documents(spark, docs)
    key = F.struct(F.isnull("doc_id").alias("nameless"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("mark"))
    keyed = docs.withColumn("key", key)
    near = simhash_grid.near_duplicates(keyed, id_col="key", width=3, bits=2)
    first = near.filter(F.col("key") == F.col("component")).select("key").distinct()
    # repeated rows fall together before they are dealt by key, one per task
    return join_sorted(keyed.dropDuplicates(["key"]), first, "key").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words or more that an earlier document has; no row goes.

    Null texts come out empty; texts from which nothing is cut keep their white space; documents
    without an id come after all others. Repeated rows stay, each cut alike. ``n_chars`` is
    counted anew where something was cut.
    """
    cut = substring_blocks.remove_repeats(_documents(spark, docs), keep=["lang", "source", "n_chars"], width=13, tidy=False)
    text = F.col("kept").cast("string")
    return cut.select("doc_id", text.alias("text"), "lang", "source",
                      F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any 10-word window of a benchmark item.

    Null and empty texts have no words and stay; repeated rows get one verdict. An empty benchmark
    drops nothing.
    """
    found = decontaminate.contaminated(_documents(spark, docs), read_table(spark, sf_dir, "benchmark"), keep=COLUMNS, width=10)
    return found.filter(F.col("n_hit") == 0).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian uint32), their count, and digests of the ids and of the decoded bytes.

    Null and empty texts have no tokens; repeated rows stay.
    """
    keep = [c for c in COLUMNS if c != "text"]
    encoded = bpe_tree.encode_decode(_documents(spark, docs), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                     public_tokenizers.PATTERN, keep=keep)
    return bpe_tree.digests(encoded, [*keep, "ids"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("leaks", drop_leaks),
    ("tokens", tokenize),
]

#: The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
