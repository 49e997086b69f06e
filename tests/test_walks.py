"""Phrases of each text from its own models."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators import models, walks
from lexmill.plans import queries

TEXTS = [("A", "spdx", "the holder, a person, may copy 2 works. the author may sell each copy v2. a holder may not sell"), ("A", "x", "b c. d"), ("B", "spdx", ""), (None, "spdx", "one"), ("C", "spdx", None)]


def tables(spark, path):
    spark.createDataFrame(TEXTS, "license string, source string, text string").repartition(3).write.mode("overwrite").parquet(f"{path}/licenses.parquet")
    return str(path)


def test_ngram_walks_of_every_text(spark, tmp_path):
    d = tables(spark, tmp_path)
    rows = queries.queries()["ngram_generate"](spark, d).collect()
    want = {(lic, src, n, k) for lic, src, t in TEXTS if t for n in range(2, 8) for k in range(1, len(t))}
    assert {(r.license, r.source, r.n, r.seed) for r in rows} == want and len(rows) == len(want)
    sizes = {len(r.phrase.split(" ")) for r in rows}
    assert min(sizes) == 6 and max(sizes) == 30 and len(sizes) == 25
    df = spark.createDataFrame(TEXTS[:2], "license string, source string, text string")
    for n in (2, 4, 7):
        seen = {(r.source, r.context, r.token) for r in models.ngram_rows(df, n, "text", ["source"]).collect()}
        for r in (r for r in rows if r.n == n and r.license == "A"):
            fresh = context = [models.START] * (n - 1)
            for w in r.phrase.split(" "):
                assert (r.source, " ".join(context), w) in seen
                context = fresh if w == "." else [*context[1:], w]


def test_chain_walks_of_every_text(spark, tmp_path):
    rows = queries.queries()["markov_generate"](spark, tables(spark, tmp_path)).collect()
    want = {(lic, src, k) for lic, src, t in TEXTS if t for k in range(1, len(t))}
    assert {(r.license, r.source, r.seed) for r in rows} == want and len(rows) == len(want)
    df = spark.createDataFrame(TEXTS[:1], "license string, source string, text string")
    seen = {(r.w1, r.w2) for r in models.transitions(df, "source").collect()}
    long = [r.phrase.split(" ") for r in rows if (r.license, r.source) == ("A", "spdx")]
    assert all(p in seen for w in long for p in zip(w, w[1:])) and len({len(w) for w in long}) > 5 and max(map(len, long)) <= 31
    assert {r.phrase for r in rows if r.license is None} == {"one"}


def test_pool_is_the_walks_cleaned(spark, tmp_path):
    d = tables(spark, tmp_path)
    got = queries.queries()["phrase_pool"](spark, d).collect()
    cleaned = F.lower(T.clean_text(F.col("phrase"))).alias("phrase")
    want = queries.queries()["ngram_generate"](spark, d).select("license", "source", cleaned).where("phrase <> ''").distinct().collect()
    assert set(got) == set(want) and len(got) == len(want)
    df = spark.createDataFrame(TEXTS, "license string, source string, text string")
    assert set(walks.phrase_pool(df.repartition(7), ["license", "source"]).collect()) == set(got)
