"""Training-data operators against brute force, on fixtures with nulls, long texts, ties, repeats and clashing names."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.llm import encoding, formatting, leaks, mixing, neardup, spans, splits, truncation
from lexmill.llm.components import components

#: Columns beyond those asked for, whose names the operators use inside.
EXTRA = "id long, text string, rep long, vertex string, source string, digest string, canon string, component string"
CLASH = (7, "clash", 8, "v", "s", "d", "c", "p")


def table(spark, rows, schema):
    """A table with clashing columns; those of the schema win."""
    own = {c.split()[0] for c in schema.split(", ")}
    extra = [(k, v) for k, v in zip(EXTRA.split(", "), CLASH) if k.split()[0] not in own]
    full = ", ".join([schema, *(k for k, _ in extra)])
    return spark.createDataFrame([(*r, *(v for _, v in extra)) for r in rows], full)


def files(spark, rows):
    return table(spark, rows, "file_id long, content string")


def words(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


# -- components and splits ------------------------------------------------------------------------------------------


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    return {x: find(x) for x in parent}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100, k) for k in range(101, 140)] + [(5, 5), (200, 200)] + [(k, k + 1) for k in range(300, 330)]
    df = spark.createDataFrame([*edges, *edges[:5], (None, 3), (4, None)], "src long, dst long")
    got = {r.vertex: r.component for r in components(df).collect()}
    want = union_find(edges)
    assert set(got) == set(want)
    pairs = lambda m: {(a, b) for a in m for b in m if a < b and m[a] == m[b]}
    assert pairs(got) == pairs(want)
    assert components(df.limit(0)).count() == 0


LABELLED = [
    (1, "MIT-1.0", "Acme  Guild", None), (2, "mit_1.0", None, "n/a"), (3, "GPL 2", "guild, ACME.", None), (4, "BSD", "Unknown", "https://Host.example/a/b.git"),
    (5, "Zlib", "(none)", "http://host.example/A/B/?x#y"), (6, "Free", "the authors", ""), (7, None, "Solo", "host.example/a/b"), (8, None, None, None), (8, None, None, None), (9, "Solo-1", "solo", "-"),
]


def labelled(spark):
    rows = table(spark, LABELLED, "file_id long, dirname string, author string, origin string")
    rules = table(spark, [(1, "MIT.1.0"), (2, None), (3, "Alone"), (3, "Alone")], "regex_id long, licenses string")
    return rows, rules


def test_label_pairs(spark):
    got = {tuple(r) for r in splits.label_pairs(*labelled(spark)).collect()}
    groups = ({"MIT-1.0", "mit_1.0", "MIT.1.0", "GPL 2"}, {"BSD", "Zlib", "Solo-1"})
    assert got == {(a, b) for g in groups for a in g for b in g if a < b}
    told = {r.label: (r.tied_to, r.rows) for r in splits.label_groups(*labelled(spark)).collect()}
    assert {k: v[0] for k, v in told.items()} == {x: min(g) for g in (*groups, {"Free"}, {"Alone"}) for x in g} and told["Alone"][1] == 2 and told["BSD"][1] == 1
    rows, rules = labelled(spark)
    assert splits.label_groups(rows.limit(0), rules.limit(0)).count() == 0
    assert splits.label_pairs(rows.limit(0), rules.limit(0)).count() == 0


def test_grouped_splits(spark):
    rows, rules = labelled(spark)
    got = splits.grouped_splits(rows, rules).collect()
    assert len(got) == rows.count() + rules.count()
    by = {}
    for r in got:
        assert r.split in ("train", "validation", "test")
        by.setdefault(r.component, set()).add(r.split)
    assert all(len(s) == 1 for s in by.values())
    many = table(spark, [(k, f"L{k % 400}", None, None) for k in range(4000)], "file_id long, dirname string, author string, origin string")
    share = {r.split: r["count"] / 4000 for r in splits.grouped_splits(many, rules.limit(0)).groupBy("split").count().collect()}
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["test"] - 0.1) < 0.02


# -- misread text ---------------------------------------------------------------------------------------------------

SOUND = ["La déclaration à l’œuvre", "Größe der Übersetzung", "Часть лицензии № 7", "共通の記録を確認する。", "CONDIÇÕES ÂGE ÀÉÎÕÜ", "5 µm ±5 ×3 © § ™ €", "clé\xa0\xa0fin", "Część własny", "caf\\xe9 d\\u00e9j\\xe0", "", "plain"]


def test_sound_text_is_no_case():
    for text in SOUND:
        found = encoding.restore(text)
        assert not found.garbled and found.text == text and found.before < encoding.GARBLED, text


@pytest.mark.parametrize("through", ["cp1252", "mac_roman", "cp437", "cp850", "koi8_r", "cp1251", "latin-1"])
def test_restores(through):
    text = "La société d’été déjà créée"
    try:
        bad = text.encode().decode(through)
    except UnicodeDecodeError:
        pytest.skip("bytes without a character")
    found = encoding.restore(bad)
    assert found.garbled and found.before >= encoding.GARBLED and found.text == text and found.after == 0 and found.way


def test_restores_twice_escaped_and_swapped():
    text = "señal pequeño artículo"
    assert encoding.restore(text.encode().decode("cp1252", "replace").encode().decode("cp1252", "replace")).garbled
    assert encoding.restore(text.encode().decode("latin-1").encode("unicode_escape").decode()).text == text
    russian = "условие после передача текст"
    for through in ("cp1251", "koi8_r"):
        assert encoding.restore(russian.encode(through).decode("latin-1")).text == russian
    lost = "La cl� sans le r�seau"
    found = encoding.restore(lost)
    assert found.text == lost and found.after > 0 and found.garbled and not found.way
    mixed = "lost � here, " + "déjà créé".encode().decode("cp1252", "replace")
    found = encoding.restore(mixed)
    assert found.text == "lost � here, déjà créé" and found.garbled and found.after > 0


def test_search_goes_as_deep_as_it_must():
    text = bad = "Größe der Übersetzung für alle"
    for _ in range(4):
        bad = bad.encode().decode("latin-1")
    found = encoding.restore(bad.encode("unicode_escape").decode())
    assert found.text == text and len(found.way) == 5 and found.garbled


def test_restored_texts_equal_their_originals():
    """Planted damage of every kind, in whole texts and in places: how many come back letter by letter."""
    rng, good, all_ = random.Random(12), 0, 0
    phrases = ["La société d’été déjà créée", "Größe der Übersetzung für Ämter", "Условие лицензии после передачи", "señal pequeño artículo", "część własny źródło"]
    for text in phrases:
        for through in ("cp1252", "latin-1", "cp1251", "mac_roman", "cp437", "cp850", "koi8_r"):
            for places in (False, True):
                try:
                    bad = text.encode().decode(through)
                except UnicodeDecodeError:
                    continue
                given = f"{text}. {bad} " + " ".join(words(rng, 4)) if places else bad
                want = given.replace(bad, text)
                all_ += 1
                good += encoding.restore(given).text == want
    assert all_ > 40 and good >= 0.95 * all_, (good, all_)


def test_garbled_rows(spark):
    rows = [(k, t) for k, t in enumerate(SOUND)] + [(100, "cafÃ© noir"), (100, "cafÃ© noir"), (101, None), (102, "x" * 100_000 + " Ã¼ber"), (None, "Ã¼")]
    got = encoding.garbled(files(spark, rows), "file_id", "content").collect()
    assert sorted(r.id for r in got) == [100, 100, 102] and {r.restored for r in got if r.id == 100} == {"café noir"}
    assert encoding.garbled(files(spark, rows).limit(0)).count() == 0


# -- formatting -----------------------------------------------------------------------------------------------------


def test_fields():
    a = '{"Filed under": "Item 4.2", "title": "Terms 1", "steward": "Acme Guild"}'
    b = "STEWARD:  ACME GUILD\nTITLE:  TERMS 1\nFILED UNDER:  ITEM 4.2\n"
    c = "filed_under=Item 4.2; steward=Acme Guild; title=Terms 1"
    assert formatting.canonical(a)[0] == formatting.canonical(b)[0] == formatting.canonical(c)[0]
    assert formatting.fields("a: 1\nb: 2") is None and formatting.fields("{bad") is None and formatting.fields('{"a": 1, "b": 2}') is None


def test_trie():
    rng, trie, want = random.Random(1), formatting.Trie(), {}
    for k in range(3000):
        key = bytes(rng.choice(b"ab") for _ in range(rng.randrange(9)))
        trie.add(key, 1, k)
        n, least = want.get(key, (0, k))
        want[key] = (n + 1, min(least, k))
    assert {k: (n, i) for k, n, i in trie.terminals()} == want


def test_formatting(spark, monkeypatch):
    base = "The licensee may copy the covered work in any medium"
    rec = "Title: Terms of the great work\nSteward: Acme Guild of works\nScope: all of it"
    rows = [(5, base), (3, base.upper() + "!"), (9, base.replace(" ", "\n\n")), (9, base.replace(" ", "\n\n")), (4, base + "s"), (1, rec), (8, '{"scope": "All of it", "title": "Terms of the great work", "steward": "Acme Guild of works"}')]
    rows += [(11, "short text"), (12, "short  text"), (13, None), (14, ""), (2, re.sub(r"[^\w]", "", rec).lower()), (20, "x" * 200_000), (21, "X " * 200_000)]
    df = files(spark, rows)
    got = {tuple(r) for r in formatting.formatting_pairs(df).collect()}
    assert got == {(3, 5), (3, 9), (1, 2), (1, 8), (20, 21)}
    assert {(r.file_id, r.copies) for r in formatting.copies_report(df).collect()} == {(3, 4), (4, 1), (1, 3), (20, 2)}
    assert formatting.formatting_pairs(df.limit(0)).count() == 0


def test_radix_splits_large_buckets(spark):
    rng = random.Random(3)
    stem = "a" * 50
    rows = [(k, stem + "".join(rng.choice("abc") for _ in range(6))) for k in range(600)]
    want = {}
    for k, t in rows:
        want.setdefault(t, []).append(k)
    _, groups = formatting.formatting_groups(files(spark, rows), fit_bytes=500)
    assert {(r.least, r.copies) for r in groups.collect()} == {(min(v), len(v)) for v in want.values()}


# -- shared spans ---------------------------------------------------------------------------------------------------


def brute_spans(rows, span):
    owner = {}
    for i, t in rows:
        for k in range(len(t or "") - span + 1):
            owner.setdefault(t[k : k + span], set()).add(i)
    out = {}
    for i, t in rows:
        if t is None:
            continue
        last = covered = 0
        for k in range(len(t) - span + 1):
            if len(owner[t[k : k + span]]) > 1:
                covered += k + span - max(k, last)
                last = k + span
        out[i] = covered
    return out


@pytest.mark.parametrize("limit", [2000, 2])
def test_spans(spark, limit):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh é文") for _ in range(n))
    shared, near = text(40), text(39)
    rows = [(k, text(60)) for k in range(10)] + [(20, text(30) + shared + text(5)), (21, shared + text(50)), (22, text(9) + shared), (23, near + "1" + text(20)), (24, "2" + near + text(4)), (25, shared * 2)]
    rows += [(30, None), (31, ""), (32, "-" * 500), (33, "=" + "-" * 300), (34, rows[0][1]), (35, shared), (36, text(20_000) + shared + text(7))]
    found = spans.SharedSpans(files(spark, rows), span=40, shingle=12, group_limit=limit)
    want = brute_spans(rows, 40)
    assert {r.file_id for r in found.found().collect()} == {i for i, n in want.items() if n}
    got = {r.file_id: r for r in found.shares().collect()}
    assert {i: r.shared_chars for i, r in got.items()} == want and got[31].share == 0
    if limit == 2000:
        tied = {r.file_id: r.cluster for r in found.clusters().collect()}
        assert {i for i, c in tied.items() if c == 20} == {20, 21, 22, 25, 35, 36} and tied[34] == tied[0] == 0
        empty = spans.SharedSpans(files(spark, rows).limit(0), span=40, shingle=12)
        assert empty.found().count() == 0 and empty.shares().count() == 0


def test_bands():
    assert spans.tune_bands(0.8, 0.999) == 10 and 1 - (1 - 0.8**3) ** 10 >= 0.999 > 1 - (1 - 0.8**3) ** 9
    with pytest.raises(ValueError):
        spans.tune_bands(0.3, 0.999)


def test_paragraph_clusters(spark):
    rng = random.Random(8)
    para = [words(rng, 60) for _ in range(30)]
    edited = list(para[1])
    edited[30] = "changed"
    join = lambda *p: "\n\n".join(" ".join(x) for x in p)
    rows = [(1, join(para[0], para[1])), (2, join(para[2], edited)), (3, join(para[3])), (4, "short one\n \n" + " ".join(para[2])), (5, join(para[4], para[4])), (6, None), (7, ""), (8, "too short"), (9, join(para[5])), (9, join(para[5]))]
    rows += [(20 + k, join(para[10 + k], para[9])) for k in range(8)]
    got = {r.file_id: r for r in spans.paragraph_clusters(files(spark, rows)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 9, *range(20, 28)}
    assert [got[k].cluster for k in (1, 2, 3, 4, 5, 9, 20, 27)] == [1, 1, 3, 1, 5, 9, 20, 20]
    assert (got[1].paragraphs, got[1].shared, got[2].shared, got[3].shared, got[4].paragraphs) == (2, 1, 2, 0, 1)
    assert got[2].removable and not got[1].removable
    assert spans.paragraph_clusters(files(spark, rows).limit(0)).count() == 0


# -- near duplicates ------------------------------------------------------------------------------------------------


def jaccard_pairs(rows, n, least, similarity):
    sets = {}
    for i, t in rows:
        w = re.findall("[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
        if len(w) >= least:
            sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9}


def test_near_duplicates(spark, monkeypatch):
    rng = random.Random(7)
    rows, k = [], 0
    for _ in range(40):
        base = words(rng, rng.randrange(25, 120))
        for _ in range(4):
            edited = list(base)
            for _ in range(rng.randrange(0, 5)):
                edited[rng.randrange(len(edited))] = "new"
            rows.append((k, " ".join(edited)))
            k += 1
    rows += [(900, None), (901, ""), (902, "too short"), (903, rows[0][1].upper()), (904, rows[0][1].replace(" ", " - ")), (905, " ".join(words(rng, 30_000, 10_000)))]
    df = files(spark, rows)
    near = neardup.NearDuplicates(df, words=3, similarity=0.6)
    got = {tuple(r) for r in near.pairs().collect()}
    want = jaccard_pairs(rows, 3, 20, 0.6)
    assert got <= want and len(got) >= 0.98 * len(want)
    groups = {r.file_id: r for r in near.groups().collect()}
    assert set(groups) == {i for i, t in rows if t and len(t.split()) >= 20} and groups[903].class_id == groups[0].class_id == 0
    assert all(groups[a].group_id == groups[b].group_id for a, b in got)
    # Groups beyond the limit take the salted way and give the same pairs.
    sketches = near.rows.select("id", "sketch")
    thresholds = [0] * neardup.PARTS
    one = {tuple(r) for r in neardup.candidate_pairs(sketches, thresholds)[1].collect()}
    assert {tuple(r) for r in neardup.candidate_pairs(sketches, thresholds, group_limit=1)[1].collect()} == one
    # So do hot signatures, wherever their counters lie.
    every = {(p, 0, 0, b) for p in range(neardup.PARTS) for b in range(0, neardup._BUCKETS, 2)}
    assert {tuple(r) for r in neardup.candidate_pairs(sketches, thresholds, hot=every)[1].collect()} == one
    assert sorted(near.order) == list(range(neardup.PARTS * neardup.WIDTH))
    counts, hot = neardup.estimate_candidates(sketches.limit(1).crossJoin(spark.range(600).withColumnRenamed("id", "_n")).select("id", "sketch"), near.order, 600, 2)
    assert len(hot) == neardup.PARTS * 4 and all(abs(c - (600 * 600 - 600) / 2 * (3 if t else 1)) < 1 for (_, t), c in counts.items())
    empty = neardup.NearDuplicates(df.limit(0))
    assert empty.pairs().count() == 0 and empty.groups().count() == 0


def test_allocation():
    cheap = {(p, t): (10.0 if p < 20 else 1e6) * (1 + 5 * t) for p in range(neardup.PARTS) for t in (0, 1)}
    chosen = neardup.allocate(cheap, 100, 0.8, 0.99)
    assert all(t == -1 for t in chosen[20:]) and any(t >= 0 for t in chosen)
    with pytest.raises(ValueError):
        neardup.allocate({}, 1, 0.2, 0.999)


# -- leaks ----------------------------------------------------------------------------------------------------------


def test_leaks(spark):
    rng = random.Random(9)
    items = [(k, " ".join(words(rng, 60, 5000))) for k in range(12)] + [(50, None), (51, "a b c"), (52, "")]
    items.append((60, items[3][1].upper()))
    passage = items[3][1].split()
    exact, short = passage[10:25], passage[10:24]
    swapped = passage[5:40]
    swapped[10], swapped[20] = "changed", "changed"
    noise = lambda n: words(rng, n, 5000)
    docs = [(k, " ".join(noise(80))) for k in range(20)]
    docs += [(100, " ".join(noise(5) + exact + noise(5))), (101, " ".join(noise(5) + short + noise(5))), (102, "_,_ ".join(swapped)), (103, None), (104, ""), (105, " ".join(noise(30_000) + passage)), (100, "again")]
    d = table(spark, docs, "doc_id long, text string")
    i = table(spark, items, "item_id long, text string")
    for block in (8_000_000, 900):
        got = {(r.doc_id, r.item_id): r for r in leaks.leaks(d, i, block_chars=block).collect()}
        assert set(got) == {(x, y) for x in (100, 102, 105) for y in (3, 60)}
        assert got[100, 3].exact_words == 15 and got[105, 3].exact_words == 60 and got[105, 3].item_share == 1.0
        assert got[102, 3].exact_words == 14 and got[102, 3].tolerant_words == 35 and got[102, 3].substitutions == 2
    assert leaks.leaks(d.limit(0), i).count() == 0 and leaks.leaks(d, i.limit(0)).count() == 0
    with pytest.raises(ValueError):
        leaks.leaks(d, i, min_words=5)


# -- mixing ---------------------------------------------------------------------------------------------------------


def test_mix(spark):
    rng = random.Random(4)
    docs = [(k, " ".join(words(rng, 30)), ["big", " BIG ", "b-i", "small"][rng.choice([0, 0, 0, 1, 2, 3])]) for k in range(300)]
    docs += [(900, None, "big"), (901, "", "small"), (902, "text", None), (903, "stray text", "no target")]
    d = table(spark, docs, "doc_id long, text string, source string")
    t = table(spark, [("big", 0.4, 1), ("B_I", 0.2, 2), ("small", 0.4, 3), ("none", 0.0, 1), (None, 0.1, 1), ("small", 0.4, 3)], "source string, weight double, max_repeats int")
    mix = mixing.Mix(d, t)
    rows = mix.rows().collect()
    assert len({(r.doc_id, r.copy) for r in rows}) == len(rows) and sum(r.tokens for r in rows) <= mix.budget
    report = {r.source: r for r in mix.report().collect()}
    assert set(report) == {"big", "B_I", "small", "none"} and abs(sum(r.reached_share for r in report.values()) - 1) < 1e-9
    for r in report.values():
        assert r.mixed_tokens <= r.available_tokens * r.max_repeats and r.most_repeats <= r.max_repeats
        if r.reachable and r.weight:
            assert r.mixed_tokens >= r.target_tokens - 200
    assert report["none"].mixed_tokens == 0
    assert {(r.doc_id, r.copy) for r in mixing.Mix(d.repartition(7), t).rows().collect()} == {(r.doc_id, r.copy) for r in rows}
    # Of each source the copies come in rounds, and what isn't in the mix finishes no earlier than what is.
    assert {r.source: r.reachable for r in report.values()} == {r.source: r.available_tokens * r.max_repeats >= r.target_tokens for r in report.values()}
    many = spark.createDataFrame([("big", 0.4, 1000), ("B_I", 0.2, 2), ("small", 0.4, 1000)], "source string, weight double, max_repeats int")
    often = mixing.Mix(d, many)
    assert often.last_time() < float("inf")
    counts = often.rows().groupBy("source").agg(F.sum("tokens").alias("t"), F.max("finish").alias("f")).collect()
    assert sum(r.t for r in counts) > often.budget - 200 and max(r.f for r in counts) <= often.last_time()
    half = mixing.Mix(d, t, budget=mix.budget // 2)
    assert sum(r.tokens for r in half.rows().collect()) <= mix.budget // 2
    empty = mixing.Mix(d.limit(0), t)
    assert empty.rows().count() == 0 and empty.report().agg(F.sum("mixed_tokens")).first()[0] == 0


# -- cut texts ------------------------------------------------------------------------------------------------------

WHOLE = [
    "All is said.", "Is it? “Yes.”", "終わりである。", "Text ends here.\n\nEND OF TERMS", "Text ends.\n\n* one entry\n* another entry", "Text ends.\n\nSee https://a.example/b", "Text ends.\n-- \nAcme Guild",
    "Text.\n\nSigned, the Acme Guild", "Text.\n\nPrinted on day 6 of 2001", "Text.\n\nVersion 1.8", "Code.\n */", "Text.\n\nand the like ...", "Text (Section 3.2) ends.", "// Comment text\n// goes on.\n\n[9] Item 2.1",
    "Text.\n\nHeading", "", "   ", "<p>The licence <b>applies</b> to you.<br>", "See <year> (or \"<name>\") here.", "A 10\" disk is meant. So it is.", "“First part\n\n“second part” ends.",
]
CUT = [
    "All is said. The next sentence sto", "All is said and the rest...", "The owner may copy [...]", "The owner may (more)", "The owner may …", "Der Eigentümer grö�", "The owner (Section 3.", "// The owner of the\n// covered wor", "He wrote \"the owner may",
    "He said (this is the whole of it and so on.", "He said \"this is the whole.", "<p>The licence <b>applies to you.", "<!-- The licence applies.", "/* The licence applies.", "The owner (see [1] applies.",
    "The owner may use \\u00", "任意の権利者は共通の記録を通じ", "Done. See <a href=\"x", "The owner of the covered work may never again copy", "One. Two; the owner,",
]


def test_endings(spark):
    others = [(500 + k, f"Heading\n\nThe text number {k} ends well. It does.", "s") for k in range(3)]
    # What closes whole texts elsewhere: first words of lone lines that begin no sentence.
    closings = ["Signed, the Other Guild", "Printed on day 5 of 2002", "Version 2.0", "END OF TERMS", "See https://b.example/c"]
    others += [(600 + k, f"The text number {k} ends well.\n\n{c}", "s") for k, c in enumerate(closings)]
    rows = [(k, t, "A-b") for k, t in enumerate(WHOLE)] + [(100 + k, t, " a_B ") for k, t in enumerate(CUT)] + [(300, None, "x"), (301, "word " * 50_000, None), (0, WHOLE[0], "A-b")] + others
    d = table(spark, rows, "doc_id long, text string, source string")
    got = truncation.truncation_verdicts(d).collect()
    assert len(got) == len(rows) - 1
    cut = {r.doc_id for r in got if r.cut}
    assert cut == {100 + k for k in range(len(CUT))} | {301}, (sorted({k for k in range(len(WHOLE))} & cut), sorted({100 + k for k in range(len(CUT))} - cut))
    rates = {r.source: r for r in truncation.truncation_rates(d).collect()}
    assert rates["a_b"].cut == len(CUT) and rates["a_b"].documents == len(WHOLE) + len(CUT) + 1
    assert truncation.truncation_verdicts(d.limit(0)).count() == 0 and truncation.truncation_rates(d.limit(0)).count() == 0


def test_length_limit(spark):
    rng = random.Random(6)
    rows = [(k, "The text. " + " ".join(words(rng, rng.randrange(20, 60))) + ".", "s") for k in range(60)]
    rows += [(200 + k, ("Term. " + " ".join(words(rng, 80)))[:120].ljust(120, "x"), "s") for k in range(20)]
    got = {r.doc_id: r for r in truncation.truncation_verdicts(table(spark, rows, "doc_id long, text string, source string")).collect()}
    assert all(got[200 + k].cut and got[200 + k].at_limit for k in range(20)) and not any(got[k].cut for k in range(60))


def test_queries_have_names():
    from lexmill.llm import oracles, queries

    names = set(queries.queries())
    assert set(oracles.oracle_sql()) <= names and {f"p{n}_found" for n in (1, 3, 4, 5, 6, 7, 8, 9)} <= names
