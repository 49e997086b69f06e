"""Queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import encoding, formatting, leaks, mixing, neardup, spans, splits, truncation
from lexmill.runtime import materialize, read_table, spread


def _files(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "split_db_foss_licenses")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of labels that must share a split."""
    return splits.label_pairs(_files(spark, d), read_table(spark, d, "spdxregex"))


def p1_labels(spark: SparkSession, d: str) -> DataFrame:
    """Each label with the smallest label that must share its split, and its rows."""
    return splits.label_groups(_files(spark, d), read_table(spark, d, "spdxregex"))


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    """A split for every row of both tables."""
    return splits.grouped_splits(_files(spark, d), read_table(spark, d, "spdxregex"))


def p1_parted(spark: SparkSession, d: str) -> DataFrame:
    """What the splits hold: rows of both tables, different labels, authors and origins, and how many of each lie in several splits (none may)."""
    files, rules = _files(spark, d), read_table(spark, d, "spdxregex")
    split = splits.grouped_splits(files, rules)
    keys = files.select(F.lit("split_db_foss_licenses").alias("tab"), F.col("file_id").alias("row_id"), splits.label_key(F.col("dirname")).alias("lk"), splits.author_key(F.col("author")).alias("ak"), splits.origin_key(F.col("origin")).alias("ok"))
    none = F.lit(None).cast("string")
    keys = keys.unionByName(rules.select(F.lit("spdxregex").alias("tab"), F.col("regex_id").alias("row_id"), splits.label_key(F.col("licenses")).alias("lk"), none.alias("ak"), none.alias("ok")))
    placed = materialize(keys.join(split, ["tab", "row_id"]).select("lk", "ak", "ok", "split"), "placed")
    out = placed.agg(F.count("*").alias("rows"), F.count(F.when(F.col("split").isNull(), 1)).alias("unplaced"))
    for key, name in (("lk", "labels"), ("ak", "authors"), ("ok", "origins")):
        ways = placed.where(F.col(key).isNotNull()).groupBy(key, "split").agg(F.count("*").alias("n")).groupBy(key).agg(F.count("*").alias("n"))
        out = out.join(F.broadcast(ways.agg(F.count("*").alias(name), F.count(F.when(F.col("n") > 1, 1)).alias(f"parted_{name}"))))  # one row
    return out


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows that hold misread text."""
    return encoding.garbled(spread(_files(spark, d))).select(F.col("id").alias("file_id"))


def p3_restored(spark: SparkSession, d: str) -> DataFrame:
    """Misread rows with the restored text."""
    return encoding.garbled(spread(_files(spark, d))).withColumnRenamed("id", "file_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of records equal but for formatting."""
    return formatting.formatting_pairs(spread(_files(spark, d)))


def p4_copies(spark: SparkSession, d: str) -> DataFrame:
    """Distinct records and their numbers of copies."""
    return formatting.copies_report(spread(_files(spark, d)))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Records with a span of 160 characters that stands in another record too."""
    return spans.SharedSpans(_files(spark, d)).found()


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    """How much of each record stands elsewhere too."""
    return spans.SharedSpans(_files(spark, d)).shares()


def p5_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Records tied by shared spans."""
    return spans.SharedSpans(_files(spark, d)).clusters()


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Records tied by alike paragraphs, and which of them are removable."""
    return spans.paragraph_clusters(spread(_files(spark, d)))


def _near(spark: SparkSession, d: str) -> neardup.NearDuplicates:
    rows = neardup.with_ngram_files(spread(_files(spark, d)), spread(read_table(spark, d, "ngramfiles")))
    return neardup.NearDuplicates(rows, words=3, similarity=0.6, min_words=20)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of records alike enough."""
    return _near(spark, d).pairs()


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """Class, group and links of each record."""
    return _near(spark, d).groups()


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with 15 consecutive words of an item."""
    return _leaks(spark, d).where("exact_words >= 15").select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """All leaks, those with single words changed included."""
    return _leaks(spark, d)


def _mix(spark: SparkSession, d: str) -> mixing.Mix:
    return mixing.Mix(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources that can't reach their target."""
    return _mix(spark, d).report().where(~F.col("reachable")).select("source")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached shares of the mix."""
    return _mix(spark, d).report()


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the mix."""
    return _mix(spark, d).rows()


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that were cut."""
    return truncation.truncation_verdicts(read_table(spark, d, "documents")).where("cut").select("doc_id")


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    """The rate of cuts for each source."""
    return truncation.truncation_rates(read_table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries of this subpackage by name."""
    own = (
        p1_found, p1_labels, p1_splits, p1_parted, p3_found, p3_restored, p4_found, p4_copies, p5_found, p5_shares, p5_clusters, p5_paragraphs, p6_found, p6_groups,
        p7_found, p7_leaks, p8_found, p8_report, p8_mix, p9_found, p9_rates,
    )
    return {f.__name__: f for f in own}
