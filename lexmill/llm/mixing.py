"""Problem 8: mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.prefix import running_total
from lexmill.runtime import materialize

#: Where the public tokenizers' files lie; a parameter of every function that counts tokens.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published split pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def token_counts(df: DataFrame, id_col: str, text_col: str, keep: list[str], vocabulary: str = TOKENIZER) -> DataFrame:
    """``id_col``, the ``keep`` columns and ``tokens``: the length of the text in tokens; 0 for null and empty texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64

        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encode = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for pdf in batches:
            pdf["tokens"] = [len(encode(t)) if t else 0 for t in pdf["_text"].array]
            yield pdf.drop(columns="_text")

    chosen = df.select(id_col, *keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{c}` {chosen.schema[c].dataType.simpleString()}" for c in [id_col, *keep])
    return chosen.mapInPandas(run, f"{kinds}, tokens long")


def source_key(source: Column) -> Column:
    """A source's name without outer blanks, in lower case, each run of ``-``, ``_``, ``.`` or blank as one ``_``."""
    return F.regexp_replace(F.lower(F.regexp_replace(source, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), r"[-_.\s\p{Z}]+", "_")


class Mix:
    """A mix and its report, from documents and targets.

    ``targets``: ``source``, ``weight`` (share of all tokens), ``max_repeats``. Every document of a source gets a
    place in the source's shuffled order by hash; copy ``r`` of it has the virtual finish time
    ``((r - 1) * tokens of the source + tokens up to it) / weight``. All copies are range-sorted by finish time and
    taken as long as the running total stays within ``budget`` (by default the tokens of all documents). Copies that finish
    after a time by which more than the budget has surely been served are never built: that time follows from the sources'
    totals. Sources that run dry leave their share to the others. A source can't reach its target if it ran dry, all its
    copies being in the mix, below the target. Weights are taken as they are if they sum to 1 or less, else as shares of
    their sum. A source of a third of all rows is spread over the ranges of one global sort. Documents without text have no
    tokens and are never drawn, sources without target are left out, a null or repeated target source is dropped,
    weights of 0 or less and null weights draw nothing, empty tables give an empty mix and a report of zeros.
    """

    def __init__(self, docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int | None = None, seed: int = 11, vocabulary: str = TOKENIZER) -> None:
        counted = token_counts(docs, id_col, text_col, ["source"], vocabulary)
        counted = counted.select(F.col(id_col).alias("doc_id"), source_key(F.col("source")).alias("key"), "tokens")
        self.counted = materialize(counted, "tokens")
        weight = F.col("weight").cast("double")
        wanted = targets.where("source IS NOT NULL").select("source", source_key(F.col("source")).alias("key"), weight.alias("weight"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats")).dropDuplicates(["key"])
        per_source = self.counted.groupBy("key").agg(F.sum("tokens").alias("source_tokens"), F.count(F.when(F.col("tokens") > 0, 1)).alias("filled"), F.count("*").alias("documents"), F.max("tokens").alias("longest"))
        self.totals = materialize(per_source, "totals")
        self.all_tokens = self.totals.agg(F.sum("source_tokens")).first()[0] or 0
        self.budget = self.all_tokens if budget is None else budget
        whole = wanted.agg(F.sum(F.greatest("weight", F.lit(0.0))).alias("_w"))  # one row
        self.targets = materialize(wanted.join(F.broadcast(whole)).withColumn("pace", F.col("weight") / F.greatest(F.coalesce("_w", F.lit(1.0)), F.lit(1.0))).drop("_w"), "targets")
        self.seed = seed
        self._rows: DataFrame | None = None

    def last_time(self) -> float:
        """A virtual time by which copies of more than the budget have finished, or infinity if all copies are less than that.

        By time t a source has finished at least ``min(pace * t, its tokens * max_repeats)`` less its longest document.
        """
        has = self.targets.where("pace > 0 AND max_repeats > 0").join(self.totals, "key").where("source_tokens > 0")
        cap = has.select((F.col("source_tokens") * F.col("max_repeats")).alias("cap"), "pace", F.col("longest").alias("slack"))
        # A row for each time at which sources run dry, and what is served up to it; two sums for each, worked out over the targets only.
        times = materialize(cap.withColumn("t", F.col("cap") / F.col("pace")), "caps")
        if times.isEmpty():
            return float("inf")
        need = self.budget + times.agg(F.sum("slack")).first()[0] + 1.0
        low, high = 0.0, times.agg(F.max("t")).first()[0]
        served = lambda t: times.agg(F.sum(F.least(F.col("pace") * t, F.col("cap")))).first()[0]
        if served(high) < need:
            return float("inf")
        for _ in range(6):  # a bound is enough, so the time is halved down only so far
            middle = (low + high) / 2
            low, high = (low, middle) if served(middle) >= need else (middle, high)
        return high

    def rows(self) -> DataFrame:
        """(``doc_id``, ``source``, ``copy``, ``tokens``, ``finish``), in the order of the mix's finish times."""
        if self._rows is None:
            drawn = self.counted.where("tokens > 0").join(self.targets.where("pace > 0 AND max_repeats > 0"), "key")
            placed = drawn.withColumn("_h", F.xxhash64("doc_id", F.lit(self.seed)))
            placed = running_total(placed, ["key", "_h", "doc_id"], "tokens", "_upto")
            # The total up to a source's first document is that of the sources before it in the order of the sort.
            first = placed.groupBy("key").agg(F.min(F.col("_upto") - F.col("tokens")).alias("_before"), F.sum("tokens").alias("_own"))
            timed = placed.join(first, "key").select("doc_id", "source", "tokens", "pace", "max_repeats", "_own", (F.col("_upto") - F.col("_before")).alias("_cum"))
            # Copy r finishes at ((r - 1) * own + cum) / pace: those after the last time aren't built.
            most = F.least(F.col("max_repeats").cast("double"), F.floor((F.lit(self.last_time()) * F.col("pace") - F.col("_cum")) / F.col("_own")).cast("double") + 1).cast("int")
            timed = timed.where(most >= 1).withColumn("copy", F.explode(F.sequence(F.lit(1), most)))
            timed = timed.withColumn("finish", ((F.col("copy") - 1) * F.col("_own") + F.col("_cum")) / F.col("pace"))
            ordered = running_total(timed.select("doc_id", "source", "copy", "tokens", "finish"), ["finish", "source", "doc_id", "copy"], "tokens", "_total")
            self._rows = ordered.where(F.col("_total") <= self.budget).drop("_total")
        return self._rows

    def report(self) -> DataFrame:
        """One row for each target: tokens there, tokens mixed, target and reached share, and whether it can be reached."""
        mixed = self.rows().groupBy("source").agg(F.sum("tokens").alias("mixed_tokens"), F.count("*").alias("mixed_documents"), F.max("copy").alias("most_repeats"))
        mixed = materialize(mixed, "mixed")
        whole = mixed.agg(F.sum("mixed_tokens").alias("_mixed"))  # one row
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
        base = self.targets.join(self.totals, "key", "left").join(mixed, "source", "left").join(F.broadcast(whole))
        base = base.select("source", "weight", "pace", "max_repeats", zero("source_tokens"), zero("documents"), zero("filled"), zero("mixed_tokens"), zero("mixed_documents"), zero("most_repeats"), F.coalesce("_mixed", F.lit(0)).alias("_mixed"))
        target = F.coalesce("weight", F.lit(0.0)) * F.lit(float(self.budget))
        dry = F.col("mixed_documents") >= F.col("filled") * F.greatest("max_repeats", F.lit(0))
        return base.select(
            "source", "weight", "max_repeats", F.col("source_tokens").alias("available_tokens"), "documents", "mixed_tokens", "mixed_documents", "most_repeats", target.alias("target_tokens"),
            F.when(F.col("_mixed") > 0, F.col("mixed_tokens") / F.col("_mixed")).otherwise(F.lit(0.0)).alias("reached_share"),
            (~dry | (F.col("mixed_tokens") >= target)).alias("reachable"),
        )
