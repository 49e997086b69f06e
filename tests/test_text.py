"""Text functions on hand-made cases."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions import sampling
from lexmill.functions import text as T
from lexmill.functions.escapes import decode_escapes


def one(spark, f, *texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [r[0] for r in df.orderBy("k").select(f(F.col("t"))).collect()]


def test_clean_text(spark):
    got = one(spark, T.clean_text, "(a) Version v2.0, x-ray\n\nfoo_bar", "añ3o ok", None, "", "A b c d e", "x" * 50_000)
    assert got == [" Version xray foobar", "ok", None, "", " ", "x" * 50_000]


def test_clean_text_beyond_ascii(spark):
    texts = ["Élan 3rd. a-b c d", "один 2два три", "a.b.c", "日本 x 7", " p ", "_a_ b"]
    assert one(spark, T.clean_text, *texts) == ["Élan ab ", "один три", "abc", "日本 ", "", " "]


def test_tokens_sentences_paragraphs(spark):
    assert one(spark, T.tokenize, "Don't do, x.", None, "") == [["Don", "'", "t", "do", ",", "x", "."], None, []]
    assert one(spark, T.sentences, "a. b\nc. d", "") == [["a", "b\n c", "d"], [""]]
    assert one(spark, T.train_sentences, "a. b", "a.") == [["a.", " b."], ["a.", "."]]
    assert one(spark, T.paragraphs, "p1\n\np2\n\n", None) == [["p1", "p2", ""], None]
    assert one(spark, T.joined_paragraphs, "p1\n\np2") == ["p1. p2"]
    assert one(spark, T.blank_lines, "a\n\nb\n", "\n\n", "") == [2, 3, 1]
    assert one(spark, T.blank_characters, "a b\tc") == [3]
    assert one(spark, T.chain_words, "Don't A+b  c") == [["don't", "ab", "", "c"]]


def test_regex_texts(spark):
    group = "x (.{1,32} (AND|OR)){1,4} y"
    assert one(spark, T.wildcard_kind, group, "a =FEW= b", "a =SOME= =SOME=", "a =ANY= b", "plain", None) == ["group", "few", "some", "any", "none", None]
    assert one(spark, T.wildcard_count, "a =SOME= =SOME=", "plain", None) == [2, 0, None]
    assert one(spark, T.expand_macros, "a =FEW= =ANY=") == ["a .{1,32} .{1,60}"]
    assert one(spark, T.erase_macros, "a =FEW= b=ANY=") == ["a  b"]
    assert one(spark, T.regex_prefix, "a =FEW= b =FEW= c", "plain") == ["a ", "plain"]
    assert one(spark, T.regex_last_suffix, "a =FEW= b =FEW= c", "plain", None, "=FEW=") == [" c", "", None, ""]
    assert one(spark, T.regex_suffix, "a =FEW= b =FEW= c", "plain") == [" b =FEW= c", ""]
    assert one(spark, T.unquote, ' "ab" ', '"', '""', "ab") == ["ab", '"', "", "ab"]
    assert one(spark, T.label_of_path, "r/MIT/MIT-1.txt", "x") == ["MIT", None]
    assert one(spark, lambda c: T.absolute_url(c, "https://b/"), "./x", "y/./z") == ["https://b/x", "y/./z"]
    assert one(spark, T.for_scan, "It's  (GNU)-x") == ["it s gnu x"]


def test_draw_is_stable(spark):
    got = [r[0] for r in spark.range(3).select(T.draw("k", F.col("id"), 1)).collect()]
    assert got == [r[0] for r in spark.range(3).repartition(3).orderBy("id").select(T.draw("k", F.col("id"), 1)).collect()]
    assert all(0 <= x < 1 for x in got)


def test_decode_escapes(spark):
    texts = [r"Pr\xe4ambel", r"a\nb’\101\q", "plain", None, "\\", r"\ud83d"]
    assert one(spark, decode_escapes, *texts) == ["Präambel", "a\nb’A\\q", "plain", None, "\\", "�"]


def test_sample_regex():
    assert sorted(sampling.sample_regex("colou?r")) == ["color", "colour"]
    for pattern in ("a (.{1,32} (AND|OR)){1,4} b", r"licen[cs]e\s+v\d", "x{2,3}y*", "(a|b|)c", "[^a-y]"):
        words = sampling.sample_regex(pattern)
        assert words and len(words) == len(set(words)) and len(words) <= 11
        assert all(re.fullmatch(pattern, w) for w in words), pattern
    assert sampling.sample_regex("a(") == [] and sampling.sample_regex(r"(a)\1") == []
    assert sampling.sample_regex("ab.{1,32}", seed=1) == sampling.sample_regex("ab.{1,32}", seed=1)


def test_sample_regexes_nulls(spark):
    df = spark.createDataFrame([(1, "a|b", "x"), (2, None, "y"), (3, "(", "z")], "regex_id int, rx string, expansion_note string")
    got = {(r.regex_id, r.expansion) for r in sampling.sample_regexes(df, "rx").collect()}
    assert got == {(1, "a"), (1, "b")}


@settings(max_examples=60, deadline=None)
@given(st.from_regex(r"\A([a-c]{1,3}|x\?|\(ab\|c\)|[a-b]\{1,2\}){1,4}\Z"))
def test_sampled_words_match(pattern):
    assert all(re.fullmatch(pattern, w) for w in sampling.sample_regex(pattern, 20))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_language_size(n):
    assert sampling.Language("[ab]{%d}" % n).size == 2**n
