"""Seeded generation from models, and its assembly into expansions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lexmill.functions import text as T
from lexmill.operators.models import START
from lexmill.runtime import materialize


def _picked(u: Column) -> Column:
    """The first of a state's successors whose running count exceeds the number drawn."""
    return F.get(F.filter("_succ", lambda x: x["cum"] > u), F.lit(0))["token"]


def generate_ngrams(model: DataFrame, states: DataFrame, label: str, n: int, length: int, cut_every: int = 6) -> DataFrame:
    """Walk an n-gram model: ``states`` (label, ``seed``) plus ``phrase`` of ``length`` tokens.

    A context is one row with its successors and their running counts, so each step joins a walk with one row; the draw
    picks the token whose share of the running count holds it. After a full stop the context starts anew. A walk whose
    context the model lacks ends. ``model``: as ngram_model gives it, for this n.
    """
    own = model.where(F.col("n") == n).groupBy(label, "context").agg(F.array_sort(F.collect_list(F.struct("cum", "token"))).alias("_succ"), F.max("ctx_cnt").alias("ctx_cnt"))
    fresh = " ".join([START] * (n - 1))
    walk = states.select(label, "seed", F.lit(fresh).alias("context"), F.lit("").alias("phrase"))
    for step in range(length):
        u = F.floor(T.draw(F.col(label), F.col("seed"), step) * F.col("ctx_cnt"))
        nxt = walk.join(own, [label, "context"]).withColumn("token", _picked(u))
        parts = F.split("context", " ", -1)
        pushed = F.array_join(F.slice(F.concat(parts, F.array("token")), 2, n - 1), " ") if n > 1 else F.lit("")
        walk = nxt.select(label, "seed", F.when(F.col("token") == ".", fresh).otherwise(pushed).alias("context"), F.when(F.col("phrase") == "", F.col("token")).otherwise(F.concat_ws(" ", "phrase", "token")).alias("phrase"))
        if step % cut_every == cut_every - 1 and step < length - 1:
            walk = materialize(walk, "walk")
    return walk.select(label, "seed", "phrase")


def generate_chain(chain: DataFrame, states: DataFrame, label: str, steps: int, cut_every: int = 6) -> DataFrame:
    """Walk a chain of words: ``states`` (label, ``seed``) plus ``phrase``.

    The first word is drawn from the label's first words by their counts; each step draws a successor; a word without
    successors stays and adds nothing. A word is one row with its successors. ``chain``: as transitions gives it.
    """
    heads = chain.groupBy(label, "w1").agg(F.sum("cnt").alias("cnt"))

    def listed(counts: DataFrame, by: list[str], token: str) -> DataFrame:
        run = Window.partitionBy(*by).orderBy(token).rowsBetween(Window.unboundedPreceding, 0)
        return counts.withColumn("cum", F.sum("cnt").over(run)).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("cum", F.col(token).alias("token")))).alias("_succ"), F.sum("cnt").alias("_all"))

    u0 = F.floor(T.draw(F.col(label), F.col("seed"), "first") * F.col("_all"))
    walk = states.select(label, "seed").join(listed(heads, [label], "w1"), label).withColumn("word", _picked(u0)).select(label, "seed", "word", F.col("word").alias("phrase"))
    own = listed(chain, [label, "w1"], "w2").withColumnRenamed("w1", "word")
    for step in range(steps):
        u = F.floor(T.draw(F.col(label), F.col("seed"), step) * F.col("_all"))
        joined = walk.join(own, [label, "word"], "left").withColumn("_next", F.when(F.col("_all").isNotNull(), _picked(u)))
        walk = joined.select(label, "seed", F.coalesce("_next", "word").alias("word"), F.when(F.col("_next").isNull(), F.col("phrase")).otherwise(F.concat(F.col("phrase"), F.lit(" "), F.col("_next"))).alias("phrase"))
        if step % cut_every == cut_every - 1 and step < steps - 1:
            walk = materialize(walk, "walk")
    return walk.select(label, "seed", "phrase")


def phrase_pool(phrases: DataFrame, label: str) -> DataFrame:
    """Distinct cleaned phrases in lower case: (``label``, ``phrase``)."""
    return phrases.select(label, F.lower(T.clean_text(F.col("phrase"))).alias("phrase")).where("phrase <> ''").distinct()


def assemble(prefix: Column, phrase: Column, suffix: Column, key: Column, style: str = "ngram") -> Column:
    """An expansion: the phrase one to four times (drawn by ``key``) between prefix and suffix; n-gram style adds (and|or)."""
    times = (F.lit(1) + F.floor(T.draw(key, "times") * 4)).cast("int")
    if style == "ngram":
        body = F.concat(F.lit(" "), F.repeat(F.concat(phrase, F.lit(" (and|or) ")), times), F.lit(" "))
    elif style == "chain":
        body = F.repeat(F.concat(phrase, F.lit(" ")), times)
    else:
        raise ValueError("style is ngram or chain")
    return T.erase_macros(F.concat(prefix, body, suffix))


def augment(fragments: DataFrame, expansions: DataFrame, label: str, text: str, sep: str = ".") -> DataFrame:
    """Fragments with each expansion of their label appended: adds ``expansion`` and ``augmented``.

    ``expansion`` may hold lists: then a list goes through the join as one row and its texts are told apart behind it.
    An equi-join on the label; skew of the fragments' side is left to adaptive execution, as the result itself is
    their product within a label.
    """
    joined = fragments.join(expansions.select(label, "expansion"), label)
    if isinstance(expansions.schema["expansion"].dataType, ArrayType):
        joined = joined.withColumn("expansion", F.explode("expansion"))
    return joined.withColumn("augmented", F.concat(F.col(text), F.lit(sep), F.col("expansion")))
