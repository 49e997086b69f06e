"""Expansions of regexes from their licence's phrases."""

from __future__ import annotations

import re

from lexmill.functions import sampling
from lexmill.functions.sampling import sample_regex
from lexmill.operators import walks
from lexmill.operators.expansions import _frame, _sampled, assembled, chain_strings, ngram_strings
from lexmill.plans import queries

TEXT = "the holder may copy works, pass them on to others without fee. the author can sell each copy of those works to any buyer"
RULES = [(1, "A-1.0", '"grant (.{1,32} (AND|OR)){1,4} licen[cs]e"'), (2, "a 1.0", "terms =SOME= end"), (3, "A-1.0", "colou?r"), (4, "none", "x =FEW= y"), (5, "A-1.0", " "), (6, None, "a.c"), (7, "A-1.0", "(?=a) =FEW= b")]


def tables(spark, path):
    spark.createDataFrame([("A-1.0", "spdx", TEXT), ("A-1.0", "x", None)], "license string, source string, text string").write.parquet(f"{path}/licenses.parquet")
    spark.createDataFrame(RULES, "regex_id long, licenses string, regex string").write.parquet(f"{path}/spdxregex.parquet")
    spark.createDataFrame([(10, "A-1.0", "text"), (11, "other", "text"), (12, "A-1.0", "")], "file_id long, dirname string, content string").write.parquet(f"{path}/split_db_foss_licenses.parquet")
    return str(path)


def test_expansions(spark, tmp_path):
    d = tables(spark, tmp_path)
    rows = queries.queries()["assemble_expansions"](spark, d).collect()
    got: dict = {}
    for r in sorted(rows, key=lambda r: r.rank):
        got.setdefault((r.regex_id, r.algo), []).append(r.expansion)
    assert set(got) == {(1, "ngram"), (1, "markov"), (2, "ngram"), (2, "markov"), (3, "sample"), (4, "sample"), (6, "sample")}
    assert all(200 <= len(got[k, "ngram"]) < 211 and 100 <= len(got[k, "markov"]) < 111 and len(set(got[k, "markov"])) == len(got[k, "markov"]) for k in (1, 2))
    assert set(got[3, "sample"]) == {"color", "colour"} and len(got[4, "sample"]) == 200 and len(got[6, "sample"]) == len(sample_regex("a.c"))
    pool = {r.phrase.strip() for r in queries.queries()["phrase_pool"](spark, d).collect()}
    bodies = {re.fullmatch("grant (.*) licen[cs]e", x)[1] for x in got[1, "ngram"]}
    drawn = [[p.strip() for p in re.split(" (?:and|or)(?: |$)", b) if p.strip()] for b in bodies]
    assert all(p in pool for phrases in drawn for p in phrases) and {len(x) for x in drawn} == {1, 2, 3, 4} and len({p for x in drawn for p in x}) > 20
    assert not any("some phrase" in r.expansion or "=" in r.expansion for r in rows)
    assert set(queries.queries()["assemble_expansions"](spark, d).repartition(3).collect()) == set(rows)


def test_augmented_with_generated_expansions(spark, tmp_path):
    d = tables(spark, tmp_path)
    made = [r.expansion for r in queries._expansions(spark, d).collect() if r.licenses == "A-1.0"]
    got = queries.queries()["augment_fragment"](spark, d).collect()
    assert sorted(r.augmented for r in got) == sorted(f"text.{x}" for x in made) and {r.file_id for r in got} == {10} and len(made) > 300
    assert sorted(r.augmented for r in queries.queries()["augment_cross"](spark, d).collect()) == sorted(f"{TEXT} {x}" for x in made)


def test_assembled(spark, tmp_path):
    d = tables(spark, tmp_path)
    rows = queries.queries()["assembled_regexes"](spark, d).collect()
    assert {(r.regex_id, r.kind) for r in rows} == {(1, "group"), (2, "some"), (7, "few")} and all(sum(r.regex_id == k for r in rows) == 20 for k in (1, 2, 7))
    pool = {r.phrase for r in queries.queries()["phrase_pool"](spark, d).collect()}
    counts = set()
    for r in rows:
        begin, end = {1: ("grant  ", "  licen[cs]e"), 2: ("terms  ", "  end"), 7: ("(?=a)  ", "  b")}[r.regex_id]
        assert r.assembled.startswith(begin) and r.assembled.endswith(" (and|or) " + end)
        drawn = r.assembled[len(begin) : -len(end)].split(" (and|or) ")[:-1]
        counts.add(len(drawn))
        assert r.regex_id == 2 or all(p in pool for p in drawn), r
    assert counts == {1, 2, 3, 4}
    assert set(queries.queries()["assembled_regexes"](spark, d).repartition(3).collect()) == set(rows)
    none = spark.createDataFrame([], "regex_id long, licenses string, regex string")
    assert assembled(none, spark.createDataFrame([("A", "s", TEXT)], "license string, source string, text string")).count() == 0


def test_pool_of_numbers(spark):
    texts = [("A", "s", TEXT), ("A", "t", "a1 b2 c3. the (c) 5 -- x; y2k a. ... ??? z1. one Two 3rd. 9 8 7. " + TEXT), ("B", "s", "- - -. a"), ("C", "s", "x\u001fy b\u0001c. d e. A b"), ("D", "s", "..")]
    rows = walks.prepared(spark.createDataFrame(texts, "license string, source string, text string"), ["license", "source"]).select("_t").collect()
    known = [r._t.asDict(True) for r in rows]
    for group in ([known[0]], known[:2], known[1:3], [known[3]], [known[4]], known):
        for lengths in ((6, 30), (12, 59), (1, 3)):
            pool = walks.Pool(group, lengths)
            assert [pool[k] for k in range(len(pool))] == walks.pool_of(group, lengths)


def test_assembled_without_a_table_of_phrases(spark, tmp_path):
    plan = queries.queries()["assembled_regexes"](spark, tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ranged" not in plan, "only drawn phrases leave a label's row"


def test_frames_give_the_words_of_the_whole_regex():
    parts = [("grant ", " licen[cs]e"), ("a?b", "terms?"), ("", ""), ("x{1,3}", "y{2}"), ("a|b", "c"), ("(a", "b)"), ("(?x) a", " b"), ("(?i)a", "b"), ("a\\", "b"), ("[a-", "z]"), ("", "*c"), ("a ", "+ (b|c  d)?"), ("(?=a)", "b"), ("a.b", ""), ("(x|y  )", "\t z")]
    for before, after in parts:
        for drawn in (["one two"], [" one", "two ", " "], ["a", "b", "c", "d"], ["", "x\ny"], ["a.b", "c"], ["*", "2)"]):
            for k in (0, 7):
                plain = not any(map(sampling.Frame.marks.search, drawn))
                pieces = [f"{drawn[0]} ", *(f" {x} " for x in drawn[1:]), " "]
                want = [re.sub(r"\s+", " ", x) for x in sample_regex(f"{before} {''.join(f'{x} (and|or) ' for x in drawn)} {after}", seed=k)]
                assert _sampled(_frame(f"{before} ", f" {after}"), f"{before} ", f" {after}", pieces, plain, k) == want, (before, after, drawn)
                body = " ".join(drawn)
                want = [re.sub(r"\s+", " ", x) for x in sample_regex(f"{before}{body} {after}", seed=k)]
                assert _sampled(_frame(before, f" {after}"), before, f" {after}", [body], plain, k) == want, (before, after, drawn)


def test_regex_is_parsed_once_for_all_rounds(monkeypatch):
    parsed = []
    real = sampling._parser.parse
    monkeypatch.setattr(sampling._parser, "parse", lambda *x: parsed.append(x) or real(*x))
    assert len(ngram_strings("grant ", " licen[cs]e", ["one two", "three"], 1)) >= 200 and len(chain_strings("grant ", " licen[cs]e", lambda rng: rng.choice("abcdefghijklmnop"), 1)) >= 100
    assert len(parsed) == 2


def test_only_labels_of_fragments_are_expanded_and_lists_are_joined(spark, tmp_path):
    plan = queries.queries()["augment_fragment"](spark, tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.index("Generate explode(expansion") < plan.index("MapInArrow") and plan.count("LeftSemi") >= 2
