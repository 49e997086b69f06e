"""N-gram models and chains of words, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T

START = "<START>"


def ngram_rows(df: DataFrame, n: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """A row for each n-gram of the training sentences: ``keep``, ``context`` (n-1 tokens joined by a blank), ``token``.

    Each sentence begins with n-1 start marks. n = 1 has an empty context.
    """
    if n < 1:
        raise ValueError("n is at least 1")
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    sents = df.where(F.col(text).isNotNull()).select(*keep, F.explode(T.train_sentences(F.col(text))).alias("_s"))
    toks = sents.select(*keep, T.tokenize(F.col("_s")).alias("_k")).where(F.size("_k") > 0)
    padded = F.concat(F.array_repeat(F.lit(START), n - 1), F.col("_k")) if n > 1 else F.col("_k")
    rows = toks.select(*keep, padded.alias("_p")).select("*", F.posexplode("_p").alias("_i", "token")).where(F.col("_i") >= n - 1)
    context = F.array_join(F.slice("_p", F.col("_i") - (n - 2), F.lit(n - 1)), " ") if n > 1 else F.lit("")
    return rows.select(*keep, context.alias("context"), "token")


def ngram_counts(df: DataFrame, n: int, label: str, text: str = "text") -> DataFrame:
    """(``label``, ``n``, ``context``, ``token``, ``cnt``); counted on the map side first."""
    rows = ngram_rows(df, n, text, [label])
    return rows.groupBy(label, "context", "token").agg(F.count("*").alias("cnt")).select(label, F.lit(n).alias("n"), "context", "token", "cnt")


def ngram_orders(df: DataFrame, orders: list[int], label: str, text: str = "text") -> DataFrame:
    """The counts of several orders together: the texts are read and tokenised once, and one shuffle counts all orders."""
    if min(orders) < 1:
        raise ValueError("n is at least 1")
    most = max(orders)
    sents = df.where(F.col(text).isNotNull()).select(label, F.explode(T.train_sentences(F.col(text))).alias("_s"))
    toks = sents.select(label, T.tokenize(F.col("_s")).alias("_k")).where(F.size("_k") > 0)
    padded = toks.select(label, F.concat(F.array_repeat(F.lit(START), most - 1), F.col("_k")).alias("_p") if most > 1 else F.col("_k").alias("_p"))

    def gram(i: Column, n: int) -> Column:
        context = F.array_join(F.slice("_p", i + (most - n), F.lit(n - 1)), " ") if n > 1 else F.lit("")
        return F.struct(F.lit(n).alias("n"), context.alias("context"), F.element_at("_p", i + (most - 1)).alias("token"))

    places = F.sequence(F.lit(1), F.size("_p") - (most - 1))
    rows = padded.select(label, F.explode(F.flatten(F.transform(places, lambda i: F.array(*(gram(i, n) for n in orders))))).alias("_g"))
    return rows.groupBy(label, "_g.n", "_g.context", "_g.token").agg(F.count("*").alias("cnt")).select(label, "n", "context", "token", "cnt")


def ngram_model(counts: DataFrame, label: str) -> DataFrame:
    """Counts with ``ctx_cnt``, ``prob``, ``cum`` and ``cdf``: tokens of a context in the order of their bytes.

    One window over (label, n, context) serves total and running sum; the running sum is of integers, so the result
    doesn't depend on the order of addition. The rows are the distinct n-grams, not their occurrences.
    """
    by = Window.partitionBy(label, "n", "context")
    run = by.orderBy("token").rowsBetween(Window.unboundedPreceding, 0)
    out = counts.withColumn("cum", F.sum("cnt").over(run)).withColumn("ctx_cnt", F.sum("cnt").over(by))
    return out.withColumn("prob", F.col("cnt") / F.col("ctx_cnt")).withColumn("cdf", F.col("cum") / F.col("ctx_cnt"))


def context_successors(counts: DataFrame, label: str) -> DataFrame:
    """Contexts with their number of different successors, their occurrences, and the first and last successor."""
    return counts.groupBy(label, "n", "context").agg(F.count("*").alias("tokens"), F.sum("cnt").alias("ctx_cnt"), F.min("token").alias("first_token"), F.max("token").alias("last_token"))


def successor_lists(counts: DataFrame, label: str) -> DataFrame:
    """Contexts with all their successors in the order of their bytes, each with how often it follows: ``successors`` (array of token, cnt).

    The lists hold counts in place of repeats, so that a context as frequent as a start of sentence has a row as long as its
    vocabulary and not as its occurrences.
    """
    return counts.groupBy(label, "n", "context").agg(F.array_sort(F.collect_list(F.struct("token", "cnt"))).alias("successors"))


def probabilities(asked: DataFrame, model: DataFrame, label: str) -> DataFrame:
    """Probability of each asked (label, n, context, token); 0.0 if it was never seen."""
    return asked.join(model.select(label, "n", "context", "token", "prob"), [label, "n", "context", "token"], "left").withColumn("prob", F.coalesce("prob", F.lit(0.0)))


def transitions(df: DataFrame, label: str, text: str = "text") -> DataFrame:
    """(``label``, ``w1``, ``w2``, ``cnt``): neighbouring words. A first word that holds a digit counts as empty."""
    words = df.where(F.col(text).isNotNull()).select(label, F.split(text, " ", -1).alias("_w"))
    clean = lambda w: F.lower(F.translate(w, T.CHAIN_MARKS, ""))
    pairs = F.zip_with(F.slice("_w", F.lit(1), F.size("_w") - 1), F.slice("_w", F.lit(2), F.size("_w")), lambda a, b: F.struct(clean(T.drop_digit_words(a)).alias("w1"), clean(b).alias("w2")))
    rows = words.where(F.size("_w") > 1).select(label, F.explode(pairs).alias("p")).select(label, "p.*")
    return rows.groupBy(label, "w1", "w2").agg(F.count("*").alias("cnt"))
