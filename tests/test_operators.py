"""Fragments, models, generation, labels, signatures."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions.sampling import sample_regex

from lexmill.operators import fragments as fr
from lexmill.operators import generate as gen
from lexmill.operators import labels as lab
from lexmill.operators import models, signatures
from lexmill.operators.prefix import running_total


def docs(spark, *texts, schema="license string, text string"):
    return spark.createDataFrame([("L", t) for t in texts], schema)


def test_sliding_windows(spark):
    got = [(r.width, r.start_at, r.fragment) for r in fr.sliding_windows(docs(spark, "a. b. c")).orderBy("width", "start_at").collect()]
    assert got == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "a. b"), (2, 1, "b. c"), (3, 0, "a. b. c")]
    assert fr.sliding_windows(docs(spark, None)).count() == 0
    assert fr.sliding_windows(docs(spark, "a. b. c"), max_width=1).count() == 3
    assert fr.sliding_windows(docs(spark, "a. b\n\nc"), unit="paragraph").count() == 3
    with pytest.raises(ValueError):
        fr.sliding_windows(docs(spark, "a"), unit="word")


def test_cumulative_splits(spark):
    got = [r.fragment for r in fr.cumulative_splits(docs(spark, "a. b. c")).orderBy("pos").collect()]
    assert got == ["a", "a b", "a b c", "a b c a"]
    assert fr.cumulative_splits(docs(spark, "only", None, "")).count() == 0
    assert fr.cumulative_splits(docs(spark, ". ".join("ab" for _ in range(300)))).count() == 1001
    assert fr.cumulative_splits(docs(spark, "a. b. c"), most=2).count() == 2
    assert [r.fragment for r in fr.cumulative_splits(docs(spark, ". a. . b")).orderBy("pos").collect()] == ["a", "a b"]
    assert fr.cumulative_splits(docs(spark, ". . ", ". . . ")).count() == 0


def test_fragments_and_numbers(spark):
    rows = fr.all_fragments(docs(spark, "a. b\n\nc"), ["license"])
    assert rows.where("kind = 'paragraph'").count() == 2 and rows.where("kind = 'window'").count() == 3
    named = fr.numbered(rows.select("license", "fragment").distinct(), "license", ["fragment"], spark.createDataFrame([("L", 4)], "license string, seq int"))
    assert sorted(r.seq for r in named.collect())[0] == 5
    assert {r.name for r in named.collect()} >= {"L-5.txt"}


def test_ngrams(spark):
    rows = lambda n: [(r.context, r.token) for r in models.ngram_rows(docs(spark, "a b "), n).collect()]
    assert rows(2) == [("<START>", "a"), ("a", "b"), ("b", ".")]
    assert rows(1) == [("", "a"), ("", "b"), ("", ".")]
    assert rows(3)[0] == ("<START> <START>", "a")
    with pytest.raises(ValueError):
        models.ngram_rows(docs(spark, "a"), 0)
    model = models.ngram_model(models.ngram_counts(docs(spark, "a b. a b. a c", None, ""), 2, "license"), "license")
    got = {(r.context, r.token): round(r.prob, 3) for r in model.collect()}
    assert got[("a", "b")] == 0.667 and got[("a", "c")] == 0.333
    for r in model.groupBy("context").agg(F.sum("prob").alias("p"), F.max("cdf").alias("c")).collect():
        assert abs(r.p - 1) < 1e-9 and r.c == 1.0
    asked = spark.createDataFrame([("L", 2, "a", "zzz")], "license string, n int, context string, token string")
    assert models.probabilities(asked, model, "license").first()["prob"] == 0.0


def test_transitions(spark):
    got = {(r.w1, r.w2): r.cnt for r in models.transitions(docs(spark, "A1 b b", None, "one"), "license").collect()}
    assert got == {("", "b"): 1, ("b", "b"): 1}


def test_generation_follows_the_model(spark):
    text = docs(spark, "the holder may copy the work. the author may sell the copy. a holder may not sell")
    model = models.ngram_model(models.ngram_counts(text, 2, "license"), "license")
    states = spark.createDataFrame([("L", k) for k in range(8)], "license string, seed int")
    phrases = {r.seed: r.phrase for r in gen.generate_ngrams(model, states, "license", 2, 8, cut_every=3).collect()}
    assert len(phrases) == 8 and all(len(p.split()) == 8 for p in phrases.values())
    pairs = {(r.context, r.token) for r in model.collect()}
    for p in phrases.values():
        before = "<START>"
        for w in p.split():
            assert (before, w) in pairs
            before = "<START>" if w == "." else w
    again = {r.seed: r.phrase for r in gen.generate_ngrams(model.repartition(3), states.repartition(5), "license", 2, 8).collect()}
    assert again == phrases
    chain = models.transitions(text, "license")
    walks = [r.phrase for r in gen.generate_chain(chain, states, "license", 5, cut_every=2).collect()]
    assert len(walks) == 8 and all(walks)


def test_assembly(spark):
    row = spark.range(1).select(gen.assemble(F.lit("pre"), F.lit("ph"), F.lit("suf"), F.lit("k"))).first()[0]
    assert row.startswith("pre ph (and|or) ") and row.endswith(" suf")
    with pytest.raises(ValueError):
        gen.assemble(F.lit("a"), F.lit("b"), F.lit("c"), F.lit("k"), "other")


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "id int, key string")
    table = spark.createDataFrame([("a", "second", 2), ("a", "first", 1), (None, "x", 3)], "k string, regex string, n int")
    got = {r.id: r.regex for r in lab.lookup_exact(df, table, "key", "k", "regex", ["n"]).collect()}
    assert got == {1: "first", 2: "", 3: "", 4: "first"}
    keys = spark.createDataFrame([("GPL",), ("a.c+",), ("x",), (None,), ("C++-1",), ("(MI|BS)T",)], "key string")
    wide = spark.createDataFrame([("LGPL-2",), ("abccd",), ("xy",), ("C++-1.0",), (None,), ("MIT",)], "lic string")
    pairs = {(r.key, r.lic) for r in lab.lookup_all(keys, wide, "key", "lic").collect()}
    assert pairs == {("GPL", "LGPL-2"), ("x", "xy"), ("C++-1", "C++-1.0")}
    assert {(r.key, r.lic) for r in lab.lookup_all(keys, wide, "key", "lic", block=1).collect()} == pairs
    pairs = {(r.key, r.lic) for r in lab.lookup_all(keys.where("key <> 'C++-1'"), wide, "key", "lic", literal=False).collect()}
    assert pairs == {("GPL", "LGPL-2"), ("x", "xy"), ("a.c+", "abccd"), ("(MI|BS)T", "MIT")}


def test_chunks(spark):
    ids = spark.createDataFrame([(i,) for i in random.Random(1).sample(range(100), 10)], "doc_id int")
    sizes = sorted(r["count"] for r in lab.chunk_assign(ids, ["doc_id"], 3).groupBy("chunk").count().collect())
    assert sizes == [3, 3, 4]
    assert sorted(r["count"] for r in lab.thirds_assign(ids, ["doc_id"]).groupBy("part").count().collect()) == [3, 3, 4]
    assert lab.chunk_assign(ids.limit(1), ["doc_id"], 6).first()["chunk"] == 0
    assert lab.chunk_assign(ids.limit(0), ["doc_id"], 6).count() == 0


def test_running_total(spark):
    df = spark.createDataFrame([(k, k % 5 if k % 7 else None) for k in range(200)], "k int, v int").repartition(7)
    total = 0
    for r in running_total(df, ["k"], "v", "t", 5).orderBy("k").collect():
        total += r.v or 0
        assert r.t == total


def test_counts_and_collisions(spark):
    df = spark.createDataFrame([("a", "t"), ("b", "t"), ("a", "u"), (None, "u"), ("c", None)], "dirname string, content string")
    assert {r.dirname: r["count"] for r in lab.label_counts(df, "dirname").collect()} == {"a": 2, "b": 1, "c": 1, None: 1}
    assert [(r.content, r.labels, r.rows) for r in lab.label_collisions(df, "dirname", "content").collect()] == [("t", 2, 2)]


def test_catalogue(spark):
    text = ["# head", "%ENTRY% _LT_AA", "# note", "%KEY% =NULL=", '%STR% "one =FEW= two"', "", "%ENTRY% _SPDX_B_1", '%KEY% "gnu"', "%NOCHECK%", '%?STR% "x"', "%ALIAS% c", "%DEF% n 3", ""]
    lines = spark.createDataFrame([(1, k, v) for k, v in enumerate(text, 1)] + [(2, 1, None), (2, 2, "no entry")], "doc int, line int, value string")
    got = {r.entry_id: r for r in signatures.parse_catalogue(lines).collect()}
    assert got["_LT_AA"].key_regex is None and got["_LT_AA"].str_regex == "one =FEW= two" and got["_LT_AA"].license == "AA"
    b = got["_SPDX_B_1"]
    assert (b.family, b.license, b.key_regex, b.str_regex, b.nocheck, b.optional_str, b.aliases) == ("SPDX", "B_1", "gnu", "x", True, True, ["c"])
    assert len(got) == 2


def test_transpile():
    assert signatures.transpile(r"\<gnu\>") == r"\bgnu\b"
    assert signatures.transpile("a[[:space:]]b") == r"a[\s]b"
    assert signatures.transpile("[[]3") == r"[\[]3"
    assert signatures.transpile("a)") is None and signatures.transpile(None) is None and signatures.transpile(" ") is None
    assert signatures.transpile("=YEAR= =FEW=") == "[0-9]{4} .{1,32}"


def test_scan(spark):
    d = spark.createDataFrame([(1, "Licensed under the GNU, General-Public terms"), (2, None), (3, ""), (4, "gnu  general public term " + "z" * 20_000)], "doc_id int, text string")
    s = spark.createDataFrame([(10, "gnu general public terms?"), (11, "(under|over)"), (12, None), (13, "a("), (14, "gnu .{1,20} terms?"), (10, "gnu general public terms?")], "regex_id int, regex string")
    for block in (20_000, 1):
        got = {tuple(r) for r in signatures.scan(d, s, "doc_id", "text", "regex_id", "regex", block_rows=block).collect()}
        assert got == {(1, 10), (4, 10), (1, 11), (1, 14), (4, 14)}
    assert signatures.scan(d, s.limit(0), "doc_id", "text", "regex_id", "regex").count() == 0
    assert signatures.scan(d.limit(0), s, "doc_id", "text", "regex_id", "regex").count() == 0


def test_scan_with_keys(spark):
    d = spark.createDataFrame([(1, "Granted by Acme Corp. (C) 2001"), (2, "granted by acme corp"), (3, "granted, by-acme CORP (c)")], "doc_id int, text string")
    rows = [("a", "granted .{1,60}rp", r"\(c\)"), ("b", ".{1,60}rp", None), ("c", "granted by", "=YEAR="), ("d", "acme", " "), ("e", "acme", "("), ("f", r"\<granted\>", r"acme corp")]
    s = spark.createDataFrame(rows, "sig string, rx string, kx string")
    got = {tuple(r) for r in signatures.scan(d, s, "doc_id", "text", "sig", "rx", "kx").collect()}
    assert got == {(1, "a"), (3, "a"), (1, "b"), (2, "b"), (3, "b"), (1, "c"), (1, "d"), (2, "d"), (3, "d"), (1, "f"), (2, "f"), (3, "f")}


def _wide_case(spark):
    texts = [(1, "Acme shall pay fees in 2001"), (1, "acme shall pays Fees"), (2, "ACME SHALL PAY"), (3, "we, acme-shall pay a fee \u0130n \u017fums"), (None, "acme shall pay"), (None, "acme shall pay"), (4, "nothing"), (5, None), (6, "pay pay acme shall pay")]
    rows = [("a", r"\<shall pays?\>", "(fees|=YEAR=)"), ("a", r"\<acme shall\>", None), ("b", r"\<shall pays?\>", "(in|sums)"), ("c", r"\<shall pays?\>", None), ("d", r".{0,3}shall pay\>", "x|[f]e{1,2}(s|t)?"), ("e", r"\<a(c|k)me shall", r"\(|fee")]
    return spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(rows, "sig string, rx string, kx string")


def _by_hand(spark, d, s):
    from lexmill.functions import text as T

    got = set()
    for t in d.where("text IS NOT NULL").select("id", "text", T.for_scan(F.col("text")).alias("t")).collect():
        for sig, rx, kx in s.collect():
            if re.search(signatures.transpile(rx), t.t, re.I) and (kx is None or re.search(signatures.transpile(kx), t.text, re.I)):
                got.add((t.id, sig))
    return got


def test_scan_of_shared_regexes_and_repeated_ids(spark):
    d, s = _wide_case(spark)
    for block in (200_000, 2):
        rows = [tuple(r) for r in signatures.scan(d, s, "id", "text", "sig", "rx", "kx", block_rows=block).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == _by_hand(spark, d, s) and len(rows) > 15
    once = signatures.scan(d.where("id > 1"), s, "id", "text", "sig", "rx", "kx")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in once and "Join" not in once, "matches of ids that stand once aren't shuffled"


def test_match_counts(spark):
    d, s = _wide_case(spark)
    listed = signatures.scan(d, s, "id", "text", "sig", "rx", "kx").groupBy("id").count()
    for block in (200_000, 2):
        got = signatures.match_counts(d, s, "id", "text", "sig", "rx", "kx", block_rows=block)
        assert sorted(map(str, got.collect())) == sorted(str(r).replace("count", "n") for r in listed.collect()), block
    assert signatures.match_counts(d.limit(0), s, "id", "text", "sig", "rx", "kx").count() == 0


@pytest.mark.parametrize("pattern, want", [("(fees|[0-9]{4})", ["fees", "[0-9]{4}"]), ("a|b(c|d)", ["a", "b(c|d)"]), ("(a)|(b)", ["(a)", "(b)"]), ("(a|b)c", ["(a|b)c"]), (r"(a\|b|[|)]x)", [r"a\|b", "[|)]x"]), (r"(a|b)\1", [r"(a|b)\1"]), ("(?:a|b)", ["(?:a|b)"]), ("", [""])])
def test_alternatives(pattern, want):
    assert signatures.alternatives(pattern) == want


@pytest.mark.parametrize("pattern, want", [(".{1,60}ab", "ab"), ("[0-9]{4}", ""), ("=YEAR=.{1,32}of", "of"), ("(AND|OR){1,4}mit", "mit"), ("ab?cd", "cd"), ("(abc)?x", "x"), ("(abc)+x", "abc"), ("a|b", ""), ("gr\u00e4nt all", "nt all")])
def test_needle(pattern, want):
    assert signatures.needle(signatures.transpile(pattern)) == want


@settings(max_examples=150, deadline=None)
@given(st.from_regex(r"\A([a-c]{1,3}|x\?|y\*|\(ab\|c\)|\(ba\)\+|[a-b]\{0,2\}|\.|\[bc\]|\{){1,6}\Z"))
def test_needle_is_in_every_word(pattern):
    ready = signatures.transpile(pattern)
    sure = signatures.needle(ready) if ready else ""
    assert all(sure in w.lower() for w in sample_regex(ready or "a", 20)) if sure else True


def test_definitions_and_scores(spark):
    lines = spark.createDataFrame([(1, 1, "%DEF% NA\t_b+1"), (1, 2, "#%DEF% NB 2"), (1, 3, None), (1, 4, "%DEFX% N 1"), (1, 5, " %DEF% NC  (a - b) ")], "doc int, line int, value string")
    assert {tuple(r) for r in signatures.parse_definitions(lines).collect()} == {(1, 1, "NA", "_b+1"), (1, 5, "NC", "(a - b)")}
    scores = spark.createDataFrame([(9,), (8,), (4,), (3,), (None,)], "score int")
    assert [r[0] for r in scores.select(signatures.score_class(F.col("score"))).collect()] == ["license", "unsure", "unsure", "none", None]


def test_orders_in_one_pass(spark):
    text = docs(spark, "a b. a c", None, "", "x")
    for n in (1, 2, 3):
        alone = {tuple(r) for r in models.ngram_counts(text, n, "license").collect()}
        assert {tuple(r) for r in models.ngram_orders(text, [1, 2, 3], "license").where(f"n = {n}").collect()} == alone
    assert {tuple(r) for r in models.ngram_orders(text, [1], "license").collect()} == {tuple(r) for r in models.ngram_counts(text, 1, "license").collect()}
    lists = {r.context: [tuple(x) for x in r.successors] for r in models.successor_lists(models.ngram_counts(text, 2, "license"), "license").collect()}
    assert lists["a"] == [("b", 1), ("c", 1)] and lists["<START>"] == [(".", 1), ("a", 2), ("x", 1)]
