"""Exact duplicates: groups of one 128-bit hash, compared byte by byte.

Spark functions only. Texts are equal if they are identical once each run of
white space has become one space; null counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.scratch import written

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE, " ")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows are grouped by the MD5 of their normalised text together with the
    text, so that Spark compares the bytes of all rows of a hash; copies meet
    before the shuffle, so a text with a third of all rows arrives as one row
    per task. The row with the smallest id stays. Groups of several rows are
    written without their texts and go back to the rows by MD5 and SHA-256; a
    pair of digests that two different texts share, which the comparison of
    bytes would show, stops the job. Adaptive execution can split a crowded
    group in that join.

    Rows without an id count, and stay only if their whole group has none. Rows
    that repeat the smallest id stay together. Other columns are not read. An
    empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("doc_id"), normalised(text).alias("body"))
    hashed = rows.select("doc_id", "body", F.unhex(F.md5("body")).alias("hash"))
    same_bytes = hashed.groupBy("hash", "body").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    by_digest = (
        same_bytes.withColumn("digest", F.unhex(F.sha2("body", 256)))
        .groupBy("hash", "digest")
        .agg(
            F.min("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
            F.count("*").alias("texts"),
        )
    )
    shared = F.raise_error(F.lit("different texts share both digests"))
    groups = written(
        by_digest.where(F.col("group_size") > 1).select(
            "hash",
            "digest",
            "keep_id",
            F.when(F.col("texts") == 1, F.col("group_size")).otherwise(shared).alias("group_size"),
        ),
        "copies",
    )
    known = hashed.select("doc_id", "hash", F.unhex(F.sha2("body", 256)).alias("digest"))
    copied = F.col("group_size").isNotNull()
    keep_id = F.when(copied, F.col("keep_id")).otherwise(F.col("doc_id"))
    return known.join(groups, ["hash", "digest"], "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are found again by id and text, so the id need not be unique.
    """
    found = exact_duplicates(docs, key, text)
    copies = found.where(~F.col("kept")).select("doc_id", "text_sha256").distinct()
    same = docs[key].eqNullSafe(copies["doc_id"]) & (
        F.sha2(normalised(text), 256) == copies["text_sha256"]
    )
    return docs.join(copies, same, "left_anti")
