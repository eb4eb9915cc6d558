"""Exact dedup by distributed MSD radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesflow.llm.common import ascii_lower, materialize

FIRST_DIGIT, GROWTH = 64, 16


def radix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                first_digit: int = FIRST_DIGIT, growth: int = GROWTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_digits.

    Texts are equal when identical after lower-casing A-Z. All documents start
    in one group; each round splits every open group by its texts' next bytes
    (the digit: 64 bytes, then 16 times as many each round, so a text of a
    megabyte takes five rounds) and by whether the text ends there. A group is
    done when it has one member, or when its texts have ended: then they are
    equal byte by byte. Only open groups go on, without the bytes already read.
    A split is a count per (group, digit), combined before the shuffle, and a
    join back that adaptive execution can split; no group meets in one task.
    The SHA-256 is output only; no comparison uses it.

    Null and empty texts are equal to each other. Of equal texts the row with
    the largest doc_id stays; a null doc_id is smaller than any other; of
    repeated rows (same id and text) one stays. Other columns are ignored.
    An empty table gives an empty result.
    """
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lit(0).cast("long").alias("gid"), text.alias("rest"))
    rows = rows.withColumn("sha", F.sha2("rest", 256))
    width, rounds, done = first_digit, 0, []
    while True:
        rounds += 1
        split = rows.select("doc_id", "gid", "sha", F.expr(f"substring(rest, 1, {width})").alias("digit"),
                            (F.octet_length("rest") <= width).alias("ended"),
                            F.expr(f"substring(rest, {width + 1})").alias("rest"))
        groups = (split.groupBy("gid", "digit", "ended")
                  .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"), F.max("sha").alias("sha"))
                  .withColumn("gid2", F.monotonically_increasing_id())
                  .withColumn("digit", F.when(F.col("n") > 1, F.col("digit"))))
        groups = materialize(groups, "radix-groups")
        alone = groups.where("n = 1").select(F.col("keep_id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
                                             F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"),
                                             F.lit(rounds).alias("n_digits"))
        done.append(alone)
        shared = groups.where("n > 1").select("gid", "digit", "ended", "n", "keep_id", "gid2")
        members = materialize(split.join(shared, ["gid", "digit", "ended"])
                              .select("doc_id", "sha", "ended", "rest", "n", "keep_id", F.col("gid2").alias("gid")),
                              "radix-members")
        # Repeats of the row that stays: one of them is kept.
        equal = members.where("ended").select("doc_id", "sha", "n", "keep_id", "gid")
        best = (equal.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("gid")
                .agg(F.count(F.lit(1)).alias("m"), F.max("doc_id").alias("keep_id"), F.max("n").alias("n"), F.max("sha").alias("sha"))
                .withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
                .select(F.col("keep_id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
                        (F.col("i") == 1).alias("kept"), F.col("sha").alias("text_sha256"), F.lit(rounds).alias("n_digits")))
        rest = (equal.where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
                .select("doc_id", "keep_id", F.col("n").alias("group_size"), F.lit(False).alias("kept"),
                        F.col("sha").alias("text_sha256"), F.lit(rounds).alias("n_digits")))
        done += [best, rest]
        rows = members.where("not ended").select("doc_id", "gid", "rest", "sha")
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, done)
        width *= growth


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows (same id and text), one.

    Null and empty texts are one group, of which the largest id stays; a null id is smaller than any other. An
    empty table stays empty; texts of any length are compared whole."""
    decided = materialize(radix_dedup(docs).select("doc_id", F.col("text_sha256").alias("__sha"), "keep_id", "kept"), "radix-decided")
    kept = decided.where("kept").select("doc_id", "__sha")
    repeated = decided.where(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "__sha").distinct()
    sha = F.sha2(ascii_lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary"), 256)
    rows = docs.withColumn("__sha", sha)

    def among(ids: DataFrame, how: str) -> DataFrame:
        return rows.alias("d").join(ids.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.__sha") == F.col("k.__sha")), how)

    if repeated.isEmpty():
        return among(kept, "left_semi").drop("__sha")
    return (among(kept.exceptAll(repeated), "left_semi").unionByName(among(repeated, "left_semi").dropDuplicates(["doc_id", "__sha"]))
            .drop("__sha"))
