"""Labelled training rows for the classifiers: which rows may be learnt from, all of them or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null ids: fold of the empty text)."""
    c = F.col(f"`{id_col}`") if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def labelled(labels: DataFrame, label: str, folds: int, held_out: int, id_col: str = "doc_id") -> DataFrame:
    """``(id, label)`` of every labelled id outside the held-out fold: the mean label, ties as 1; nulls teach nothing."""
    return (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (fold(id_col, folds) != held_out))
            .groupBy(F.col(id_col).alias("id")).agg((F.avg(label) >= 0.5).cast("int").alias("label")))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                  id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(text, label)`` of every labelled row outside the held-out fold; rows equal in id and text count once."""
    body = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).withColumn("mark", F.xxhash64("text"))
    return body.join(labelled(labels, label, folds, held_out, id_col), "id").dropDuplicates(["id", "mark"]).select("text", "label")


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int,
                    id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """``(text, label)`` of up to ``per_class`` labelled rows of either class, and the full class counts.

    Only rows outside the held-out fold are read. Ids labelled more than once or in two ways count
    by their mean label, ties as 1; null ids and null labels teach nothing. Rows equal in id and text
    count once; labels of ids that are not in ``docs`` do not count. The sample takes the rows least
    by hash, so it is the same on every run and every partitioning.
    """
    ids = labelled(labels, label, folds, held_out, id_col)
    body = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).withColumn("mark", F.xxhash64("text"))
    present = body.select("id", "mark").distinct().join(ids, "id")
    counts = {r["label"]: r["n"] for r in present.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("id"), F.col("id"), F.col("mark")]
    sample = [present.filter(F.col("label") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    wanted = F.broadcast(sample[0].unionByName(sample[1]))       # at most 2 * per_class rows of three numbers
    rows = body.join(wanted, ["id", "mark"]).dropDuplicates(["id", "mark"])
    return rows.select("text", "label"), counts
