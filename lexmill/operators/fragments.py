"""Fragments of texts: windows of sentences, growing splits, paragraphs, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T


def _units(text: Column, unit: str) -> Column:
    if unit not in ("sentence", "paragraph"):
        raise ValueError("unit is sentence or paragraph")
    return T.sentences(text) if unit == "sentence" else T.paragraphs(text)


def sliding_windows(df: DataFrame, text: str = "text", unit: str = "sentence", sep: str = ". ", max_width: int | None = None) -> DataFrame:
    """All windows of neighbouring sentences (or paragraphs), of every width: adds ``width``, ``start_at``, ``fragment``.

    A text of n units gives n(n+1)/2 windows; ``max_width`` bounds the width before anything is built. Null texts
    give no row.
    """
    units = df.where(F.col(text).isNotNull()).withColumn("_u", _units(F.col(text), unit)).withColumn("_n", F.size("_u"))
    most = F.col("_n") if max_width is None else F.least(F.col("_n"), F.lit(max_width))
    # Widths, then places, are generated row by row: no array of all windows is ever held.
    wide = units.select("*", F.explode(F.sequence(F.lit(1), most)).alias("width"))
    placed = wide.select("*", F.explode(F.sequence(F.lit(1), F.col("_n") - F.col("width") + 1)).alias("_i"))
    return placed.select(*df.columns, "width", (F.col("_i") - 1).alias("start_at"), F.array_join(F.slice("_u", F.col("_i"), F.col("width")), sep).alias("fragment"))


def cumulative_splits(df: DataFrame, text: str = "text", most: int | None = 1001) -> DataFrame:
    """The growing concatenations of sentences: adds ``pos`` and ``fragment``.

    For each stride 1..n-1 the sentences 0, stride, 2*stride, .. n-stride are appended in turn, and what has been
    gathered so far is a fragment each time. White space is collapsed. An empty sentence adds nothing and gives no fragment of its own,
    so the fragments of a text all differ. A text of one sentence gives none. ``most`` (the feature of this operator) stops
    after that many fragments of a text; None lifts it.
    """
    units = df.where(F.col(text).isNotNull()).withColumn("_u", T.sentences(F.col(text))).withColumn("_n", F.size("_u")).where("_n >= 2")
    strides = F.transform(F.sequence(F.lit(1), F.col("_n") - 1), lambda c: F.sequence(F.lit(0), F.col("_n") - c, c))
    filled = F.filter(F.flatten(strides), lambda i: F.element_at("_u", (i + 1).cast("int")) != "")
    order = filled if most is None else F.slice(filled, 1, most)
    picked = units.withColumn("_o", F.transform(order, lambda i: F.element_at("_u", (i + 1).cast("int")))).drop("_u")
    rows = picked.where(F.size("_o") > 0).select(*df.columns, "_o", F.explode(F.sequence(F.lit(1), F.size("_o"))).alias("pos"))
    joined = T.strip(T.collapse(F.array_join(F.slice("_o", F.lit(1), F.col("pos")), " ")))
    return rows.select(*df.columns, "pos", joined.alias("fragment"))


def paragraph_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """A row for each paragraph: adds ``pos`` from 0 and ``fragment``; empty paragraphs are kept."""
    return df.where(F.col(text).isNotNull()).select(*df.columns, F.posexplode(T.paragraphs(F.col(text))).alias("pos", "fragment"))


def all_fragments(df: DataFrame, keys: list[str], text: str = "text", max_width: int | None = None) -> DataFrame:
    """Windows and paragraphs together: ``keys``, ``kind``, ``start_at``, ``width``, ``fragment``."""
    base = df.select(*keys, F.col(text).alias("_t"))
    windows = sliding_windows(base, "_t", max_width=max_width).select(*keys, F.lit("window").alias("kind"), "start_at", "width", "fragment")
    pieces = paragraph_rows(base, "_t").select(*keys, F.lit("paragraph").alias("kind"), F.col("pos").alias("start_at"), F.lit(None).cast("int").alias("width"), "fragment")
    return windows.unionByName(pieces)


def numbered(fragments: DataFrame, label: str, order: list[str], after: DataFrame | None = None) -> DataFrame:
    """Add ``seq`` within the label, in the order given, and ``name``; numbers go on after those of ``after`` (label, seq)."""
    out = fragments.withColumn("seq", F.row_number().over(Window.partitionBy(label).orderBy(*order)))
    if after is not None:
        last = after.groupBy(F.col(label)).agg(F.max("seq").alias("_last"))
        out = out.join(last, label, "left").withColumn("seq", F.col("seq") + F.coalesce("_last", F.lit(0))).drop("_last")
    return out.withColumn("name", T.file_name(F.col(label), F.col("seq")))
