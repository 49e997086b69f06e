"""Counts, collisions, lookups and even shares of labelled rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators.prefix import running_total


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """(``label``, ``count``)."""
    return df.groupBy(label).agg(F.count("*").alias("count"))


def label_collisions(df: DataFrame, label: str, text: str) -> DataFrame:
    """Texts that stand under several labels: ``text``, ``labels``, ``rows``. Null texts are none, a null label isn't a label.

    Labels are counted by a digest of the text first; only texts whose digest has several labels are then grouped by
    themselves, so the result doesn't hang on the digest and most texts are never shuffled.
    """
    keyed = df.where(F.col(text).isNotNull()).select(F.col(text).alias("_t"), F.col(label).alias("_l"), F.md5(F.col(text)).alias("_d"))
    several = keyed.groupBy("_d", "_l").agg(F.count("*").alias("_n")).groupBy("_d").agg(F.count("_l").alias("_labels")).where("_labels > 1").select("_d")
    pairs = keyed.join(several, "_d", "left_semi").groupBy("_t", "_l").agg(F.count("*").alias("_n"))
    return pairs.groupBy(F.col("_t").alias(text)).agg(F.count("_l").alias("labels"), F.sum("_n").alias("rows")).where("labels > 1")


def lookup_exact(df: DataFrame, table: DataFrame, key: str, table_key: str, value: str, order: list[str], default: str = "") -> DataFrame:
    """The first value (by ``order``) of each key, ``default`` where there is none. Rows of ``df`` stay as many."""
    first = table.where(F.col(table_key).isNotNull()).groupBy(F.col(table_key).alias(key)).agg(F.min_by(F.struct(F.col(value)), F.struct(*order)).alias("_v"))
    return df.join(first, key, "left").withColumn(value, F.coalesce(F.col(f"_v.{value}"), F.lit(default))).drop("_v")


def lookup_all(keys: DataFrame, table: DataFrame, key: str, table_key: str, literal: bool = True, gram: int = 3, block: int = 10_000) -> DataFrame:
    """Pairs where the table's key contains the key, as text or (``literal=False``) as a regex search.

    Both sides are taken as distinct values. They meet on a ``gram``-character piece of the key: of its pieces the one that the
    fewest of the table's values hold, so that no common piece gathers rows; no cross product is formed. Keys without a sure
    piece (shorter ones, or regexes with alternatives, groups or classes) go over all distinct values as a broadcast, in
    blocks of about ``block`` keys. Null keys on either side match nothing.
    """
    plain = F.col("_k")
    if not literal:
        # The longest piece of literal characters; one before a quantifier isn't sure.
        bare = F.when(plain.rlike(r"[\\|(\[{^$]"), "").otherwise(F.regexp_replace(plain, r".[*?]", "."))
        pieces = F.split(F.regexp_replace(bare, r"\+", "."), r"\.")
        plain = F.element_at(F.array_sort(pieces, lambda a, b: F.length(b) - F.length(a)), 1)
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - gram + 1), lambda i: F.substring(c, i, F.lit(gram))))
    asked = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("_k")).distinct().withColumn("_p", plain)
    values = table.where(F.col(table_key).isNotNull()).select(F.col(table_key).alias("_v")).distinct()
    cut = values.where(F.length("_v") >= gram).select("_v", F.explode(grams(F.col("_v"))).alias("_g"))
    known = cut.groupBy("_g").agg(F.count("*").alias("_n"))
    own = asked.where(F.length("_p") >= gram).select("_k", F.explode(grams(F.col("_p"))).alias("_g"))
    rarest = own.join(known, "_g", "left").groupBy("_k").agg(F.min_by("_g", F.struct(F.coalesce("_n", F.lit(0)), F.col("_g"))).alias("_g"))
    holds = F.col("_v").contains(F.col("_k")) if literal else F.expr("_v rlike _k")
    pairs = rarest.join(cut, "_g").where(holds).select("_k", "_v")
    rest = asked.where(F.length("_p") < gram).select("_k")
    blocks = math.ceil(rest.count() / block)
    for k in range(blocks):
        part = rest if blocks == 1 else rest.where(F.pmod(F.xxhash64("_k"), F.lit(blocks)) == k)
        pairs = pairs.unionByName(values.join(F.broadcast(part), holds).select("_k", "_v"))  # about block keys
    return keys.join(pairs.withColumnRenamed("_k", key), key).join(table, F.col("_v") == table[table_key]).drop("_v")


def chunk_assign(df: DataFrame, order: list[str], chunks: int) -> DataFrame:
    """Add ``rn`` (from 0 in the order) and ``chunk``: even, contiguous chunks. ``order`` ends in a unique column.

    Positions come from running totals over ranges, not from one sorted task.
    """
    total = df.count()
    placed = running_total(df.withColumn("_one", F.lit(1)), order, "_one", "_upto")
    return placed.withColumn("rn", F.col("_upto") - 1).withColumn("chunk", F.floor((F.col("_upto") - 1) * chunks / max(total, 1)).cast("int")).drop("_one", "_upto")


def thirds_assign(df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``rn`` and ``part``: rows before n div 3, before 2n div 3, and the rest."""
    n = df.count()
    placed = running_total(df.withColumn("_one", F.lit(1)), order, "_one", "_upto").withColumn("rn", F.col("_upto") - 1)
    return placed.withColumn("part", F.when(F.col("rn") < n // 3, 0).when(F.col("rn") < 2 * n // 3, 1).otherwise(2)).drop("_one", "_upto")


def by_label(df: DataFrame, label: str, n: int) -> DataFrame:
    """Physical distribution by label, for work that goes label by label."""
    return df.repartition(n, label)


def labelled_paths(df: DataFrame, path: str) -> DataFrame:
    """Add ``label``: the parent folder of each path."""
    return df.withColumn("label", T.label_of_path(F.col(path)))


def next_numbers(existing: DataFrame, label: str) -> DataFrame:
    """(``label``, ``next_seq``): where numbering goes on."""
    return existing.groupBy(label).agg((F.max("seq") + 1).alias("next_seq"))


def first_rows(df: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group (a limit that is the feature)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rn") <= most).drop("_rn")
