"""Problem 9: texts cut off by a field limit or a broken transfer, by a structural check with a stack."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.mixing import source_key
from lexmill.runtime import materialize

_CLOSERS = "\"'”’»›)\\]}」』）】*_`~"
_TERMINATED = regex.compile(rf"(?:[.!?。！？։؟।]|[」』])[{_CLOSERS}]*$")
_MARK = regex.compile(r"(?:\s*(?:\[\s*(?:\.\.\.|…|snip|cut|truncated)\s*\]|\(\s*(?:more|\.\.\.|…|continued|cont\.?|truncated)\s*\)|\.{3,}|…|(?:read|show|see) more|<more>))$", regex.IGNORECASE)
_BROKEN = regex.compile(r"(?:�+|\\x[0-9a-fA-F]?|\\u[0-9a-fA-F]{0,3}|&(?:#\d{0,6}|#x[0-9a-fA-F]{0,5}|[a-z]{2,6})|%[0-9A-F]?|</?[a-zA-Z][^<>\n]{0,200}|<!--[^>]{0,200})$")
_SIGN = regex.compile(r"(?:\*/|-->|#>|\*\)|%>|\?>|```|={3,}|-{3,}|\*{3,}|~{3,}|_{3,})$")
_LINK = regex.compile(r"(?:https?|ftp|git|mailto)(?:://|:)\S+$|\bwww\.\S+$|\S+@\S+\.\w+>?$", regex.IGNORECASE)
_PREFIX = regex.compile(r"^(?:\s*(?://+|#+|>+|;+|%+|--(?=\s)|\|)\s?|\s+\*(?:\s|$))+")
_ITEM = regex.compile(r"^\s*(?:[*•·–—+-]|\(?\d{1,3}[.)]|\[\d+\]|\(?[a-zA-Z][.)])\s+(?=\S)")
_NUMBERED = regex.compile(r"^(?:\d+(?:\.\d+)*[.)]?|\[\d+\])\s+")
_DATED = regex.compile(r"(?:\b(?:1[89]|20)\d\d|\d{1,2}[:/.-]\d{1,2}(?:[:/.-]\d{1,4})?|\b[vV]?\d+(?:\.\d+)+)[)\]]?$")
_INNER = regex.compile(r"[.!?。！？][" + _CLOSERS + r"]*(?:\s+(?=\S)|(?<=[。！？])(?=\S))")
_TOKEN = regex.compile(r"<!--|-->|(?<!\S)/\*|\*/|</?[a-zA-Z][\w:-]*(?:\s[^<>]*)?>|(?<!\d)\"|[“”„«»()\[\]{}（）「」『』]|\n[ \t\r#*/>;%|]*(?=\n)")
_PAIRS = {")": "(", "]": "[", "}": "{", "”": "“„", "»": "«", "）": "（", "」": "「", "』": "『", "-->": ("<!--",), "*/": ("/*",)}
#: Elements that must be closed; other names count as elements if the text closes them somewhere.
_ELEMENTS = frozenset("a abbr article b blockquote body code div em font h1 h2 h3 h4 h5 h6 head html i ol pre script section small span strong style sub sup table title tt u ul".split())
_CLOSED = regex.compile(r"</([a-zA-Z][\w:-]*)\s*>")
_TAGS = regex.compile(r"(?:\s*</?[a-zA-Z][^<>]*>)+$")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")

COMPLETE, CUT, OPEN = "complete", "cut", "open"


def open_marks(text: str) -> list[tuple[str, int]]:
    """Quotes, brackets, comments and elements still open at the end of a text, with their place: a stack automaton.

    It runs over the whole text. A closing mark closes its nearest opener and what was left open inside; one without an opener
    is passed over. Quotes and brackets end with their paragraph (quotes that run on are opened anew in each, and a bracket
    forgotten pages before says nothing of the end); comments and elements run on.
    """
    stack: list[tuple[str, int]] = []
    closed: frozenset | None = None
    for found in _TOKEN.finditer(text):
        mark = found.group()
        if mark[0] == "\n":
            stack = [x for x in stack if x[0][0] in "</"]
        elif mark in _PAIRS or mark[:2] == "</" or mark in ('"', "“") and any(x[0] == ('"' if mark == '"' else "„") for x in stack):
            openers = ("<" + mark[2:-1].strip().lower(),) if mark[:2] == "</" else _PAIRS.get(mark, '"' if mark == '"' else "„")
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in openers), None)
            if at is not None:
                del stack[at:]
        elif mark[0] == "<" and mark != "<!--":
            closed = frozenset(x.lower() for x in _CLOSED.findall(text)) if closed is None else closed
            name = regex.match(r"<([\w:-]+)", mark)[1].lower()
            if mark[-2:] != "/>" and (name in _ELEMENTS or name in closed):
                stack.append(("<" + name, found.start()))
        else:
            stack.append((mark, found.start()))
    return stack


def _line_key(line: str) -> int:
    """A line without numbers, case, and signs."""
    plain = regex.sub(r"\d+", "0", regex.sub(r"[^\p{L}\p{N}]+", " ", unicodedata.normalize("NFKC", line).lower())).strip()
    return xxhash.xxh3_64_intdigest(plain) - (1 << 63)


def _start_key(line: str) -> int | None:
    """A line's first word; of a script without blanks its first two characters."""
    found = regex.match(r"\W*([\p{L}\p{M}’']+)", line)
    if not found:
        return None
    word = found[1][:2] if _CJK.match(found[1]) else found[1]
    return xxhash.xxh3_64_intdigest("\0" + word.lower()) - (1 << 63)


def _words(line: str) -> int:
    """Words of a line; two characters of a script without blanks count as one."""
    return len(line.split()) + len(_CJK.findall(line)) // 2


def ending(text: str) -> tuple[str, str, str]:
    """State, reason and last line of a text. ``open`` leaves a lone last line to what other texts show."""
    body = text.rstrip()
    if not body:
        return COMPLETE, "blank", ""
    if _BROKEN.search(body[-220:]):
        return CUT, "broken sequence", ""
    mark = _MARK.search(body[-60:])
    if mark:
        before = body[: len(body) - len(mark.group())].rstrip()
        own = _PREFIX.sub("", before.rsplit("\n", 1)[-1]).strip()
        above = before[: len(before) - len(before.rsplit("\n", 1)[-1])].rstrip()
        # Dots after a line of their own that begins in lower case close a list; a cut text goes on from its sentence.
        alone = own[:1].islower() and (not above or bool(_TERMINATED.search(above[-8:])))
        return (COMPLETE, "list closed", "") if not own or alone and mark.group().strip()[0] in ".…" else (CUT, "mark", "")
    if open_marks(body):
        return CUT, "open mark", ""
    lines = [_PREFIX.sub("", x).strip() for x in body.split("\n")[-4:]]
    last, earlier = lines[-1], lines[:-1]
    if _TERMINATED.search(_TAGS.sub("", body[-200:])[-12:]):
        return COMPLETE, "terminated", ""
    if _SIGN.search(body[-8:]) or not last:
        return COMPLETE, "comment sign", ""
    raw_last = body.rsplit("\n", 1)[-1]
    before = earlier[-1] if earlier else ""
    if len(lines) > 1 and body.split("\n")[-2].strip() == "--":
        return COMPLETE, "signature", ""
    if _ITEM.match(raw_last) or _ITEM.match(last):
        rest = _ITEM.sub("", raw_last if _ITEM.match(raw_last) else last)
        if _INNER.search(rest) or rest.endswith((",", ";")):
            return CUT, "unfinished item", last
        return OPEN, "list entry", last
    # A line that goes on from an unfinished one, or that holds finished sentences, ends inside a sentence.
    lone_before = not before or bool(_TERMINATED.search(before)) or before.endswith(":")
    short_before = bool(before) and (bool(_ITEM.match(body.split("\n")[-2])) or len(before) < 40 and len(earlier) > 1 and (not earlier[-2] or bool(_TERMINATED.search(earlier[-2]))))
    if not lone_before and not short_before or _INNER.search(_NUMBERED.sub("", last)):
        return CUT, "unfinished sentence", last
    if _LINK.search(last):
        return COMPLETE, "link", last
    if last.endswith((",", ";", "-", "–", "(", ":", "、", "，")) and not last.endswith("--"):
        return CUT, "unfinished sentence", last
    return OPEN, "date" if _DATED.search(last) else "lone line", last


def _inner_lines(text: str) -> tuple[dict[int, tuple[int | None, int]], set[int]]:
    """The lone unterminated lines inside a text (key: start key and words), and the keys of the first words of its sentences."""
    lines = [_PREFIX.sub("", x).strip() for x in text.split("\n")]
    longest = max(map(len, lines))
    lone, starts = {}, set()
    for k, line in enumerate(lines[:-1]):
        if not line or k and lines[k - 1] and not _TERMINATED.search(lines[k - 1][-8:]):
            continue
        # What is as long as the text's lines are is wrapped and goes on, whatever its next line begins with.
        alone = not lines[k + 1] or len(line) < 0.6 * longest and (lines[k + 1][:1].isupper() or not lines[k + 1][:1].isalpha())
        if _TERMINATED.search(line[-8:]) or not alone or _INNER.search(line):
            start = _start_key(line)
            if start is not None:
                starts.add(start)
        else:
            lone[_line_key(line)] = (_start_key(line), _words(line))
    return lone, starts


def endings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row a document: state and reason of its end, lengths, its last line if that is open, and what its inner lines are."""
    schema = "doc_id long, source string, chars int, bytes int, state string, reason string, last_key long, start_key long, last_words int, inner array<struct<key: bigint, start: bigint, words: int>>, starts array<long>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, source, text in zip(pdf["doc_id"].to_numpy(), pdf["source"].array, pdf["text"].array):
                state, reason, last = ending(text)
                inner, starts = _inner_lines(text)
                own = state == OPEN
                lone = [{"key": k, "start": s, "words": n} for k, (s, n) in inner.items()]
                out.append((i, source, len(text), len(text.encode("utf-8", "replace")), state, reason, _line_key(last) if own else None, _start_key(last) if own else None, _words(last), lone, list(starts)))
            names = ["doc_id", "source", "chars", "bytes", "state", "reason", "last_key", "start_key", "last_words", "inner", "starts"]
            # Keys with gaps become nullable integers at once: by way of floats they'd lose their last digits.
            columns = dict(zip(names, map(list, zip(*out)))) if out else {c: [] for c in names}
            yield pd.DataFrame({c: pd.array(v, dtype="Int64") if c in ("last_key", "start_key") else pd.Series(v, dtype=None if v else "object") for c, v in columns.items()})

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), source_key(F.col("source")).alias("source"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    return wanted.mapInPandas(run, schema)


def length_limits(ends: DataFrame, chance: float = 1e-7, times: float = 8.0, width: int = 50) -> DataFrame:
    """(``source``, ``unit``, ``limit``, ``hits``): lengths that a source shows far more often than those around them.

    A length counts if its hits are over ``times`` those usual around it and if as many would come about with less than
    ``chance``, taken as Poisson (bounded by the Chernoff inequality); so neither needs a source of a certain size. What is usual
    is read off the lengths in the same and the two neighbouring stretches of ``width``.
    """
    sizes = ends.select("source", F.explode(F.create_map(F.lit("chars"), "chars", F.lit("bytes"), "bytes")).alias("unit", "limit"))
    counted = sizes.groupBy("source", "unit", "limit").agg(F.count("*").alias("hits")).withColumn("_b", F.floor(F.col("limit") / width))
    near = F.explode(F.array(*(F.col("_b") + k for k in (-1, 0, 1)))).alias("_b")
    around = counted.groupBy("source", "unit", "_b").agg(F.sum("hits").alias("_n")).select("source", "unit", near, "_n").groupBy("source", "unit", "_b").agg(F.sum("_n").alias("_n"))
    around = around.select(F.col("source").alias("_s"), F.col("unit").alias("_u"), F.col("_b").alias("_c"), "_n")
    joined = counted.join(around, F.col("source").eqNullSafe(F.col("_s")) & (F.col("unit") == F.col("_u")) & (F.col("_b") == F.col("_c"))).select("source", "unit", "limit", "hits", "_n")
    usual = F.greatest((F.col("_n") - F.col("hits")) / (3 * width - 1), F.lit(1e-3))
    rare = F.col("hits") - usual - F.col("hits") * F.log(F.col("hits") / usual)  # logarithm of the bound
    return joined.where((F.col("hits") > times * usual) & (rare < F.log(F.lit(chance)))).select("source", "unit", "limit", "hits")


def baselines(ends: DataFrame) -> DataFrame:
    """(``source``, ``missing``, ``heading_words``): each source's share of cut ends among those that are told without doubt, and how many words 99 of 100 of its lone inner lines have at most."""
    sure = ends.where(F.col("state") != OPEN).groupBy("source").agg(F.avg(F.when(F.col("state") == CUT, 1.0).otherwise(0.0)).alias("missing"))
    words = ends.select("source", F.explode("inner.words").alias("_w")).groupBy("source").agg(F.percentile_approx("_w", 0.99).alias("_most"))
    sure = sure.select(F.col("source").alias("_s"), "missing")
    return sure.join(words, F.col("_s").eqNullSafe(F.col("source")), "left").select(F.col("_s").alias("source"), "missing", F.coalesce("_most", F.lit(0)).alias("heading_words"))


def truncation_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``source``, ``cut``, ``reason``, ``at_limit``) for every document with a text.

    A stack automaton runs over the whole text: what is left open at its end (quotes, brackets, comments, elements)
    makes it cut, whatever its last sign; so do broken sequences, marks of a cut and sentences without an end. A lone
    last line (heading, list entry, date, signature) is compared with the corpus: it is whole if the same line
    (numbers aside) stands alone inside a document; else its first word decides, by whether more documents begin
    sentences or lone lines with it; a first word that no other document shows leaves it to the source's baseline: cut if most
    of the source's sure ends are, or if it has more words than the source's lone lines have. At a length where its source's
    lengths pile up a lone last line is cut unless it is a heading. All of these are shares and not counts, so that
    a text's verdict doesn't drift with the size of the corpus. Null texts get no row, blank ones are complete; repeated rows are
    judged each; an empty table gives an empty table.
    """
    ends = materialize(endings(docs, id_col, text_col), "endings")
    limits = materialize(length_limits(ends), "limits")
    base = materialize(baselines(ends), "baselines")
    # Only lone last lines are looked up: the corpus' lines are cut down to their keys before they are counted.
    unsure = ends.where(F.col("state") == OPEN).select("doc_id", "source", "chars", "bytes", "reason", "last_key", "start_key", "last_words")
    asked_lines = unsure.select(F.col("last_key").alias("key")).distinct()
    asked_words = unsure.where("start_key IS NOT NULL").select(F.col("start_key").alias("start")).distinct()
    inner = ends.select(F.explode("inner").alias("x")).select("x.*")
    lone = inner.select("key").join(asked_lines, "key", "left_semi").distinct().select(F.col("key").alias("last_key"), F.lit(True).alias("is_heading"))
    shown = ends.select(F.explode("starts").alias("start"), F.lit(1).alias("p"), F.lit(0).alias("l")).unionByName(inner.select("start", F.lit(0).alias("p"), F.lit(1).alias("l")))
    shown = shown.unionByName(unsure.select(F.col("start_key").alias("start"), F.lit(0).alias("p"), F.lit(1).alias("l")))
    starts = shown.join(asked_words, "start", "left_semi").groupBy("start").agg(F.sum("p").alias("n_prose"), (F.sum("l") - 1).alias("n_lone")).withColumnRenamed("start", "start_key")
    looked = unsure.join(lone, "last_key", "left").join(starts, "start_key", "left")
    looked = looked.join(base.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    heading = F.coalesce("is_heading", F.lit(False))
    known = F.coalesce(F.col("n_prose") + F.col("n_lone") > 0, F.lit(False))
    unknown_cut = (F.col("last_words") > F.coalesce("heading_words", F.lit(0))) | (F.coalesce("missing", F.lit(0.0)) > 0.5)
    # A list entry has its sign, and a line that ends in a date or number its number: only a sentence's word speaks against these.
    marked = F.col("reason").isin("list entry", "date")
    cut = ~heading & F.when(known, F.col("n_prose") >= F.col("n_lone")).otherwise(~marked & unknown_cut) & ~(F.col("reason") == "list entry")
    looked = looked.select("doc_id", "source", "chars", "bytes", F.when(heading, "heading").otherwise(F.col("reason")).alias("reason"), cut.alias("cut"), heading.alias("heading"))
    sure = ends.where(F.col("state") != OPEN).select("doc_id", "source", "chars", "bytes", "reason", (F.col("state") == CUT).alias("cut"), F.lit(True).alias("heading"))
    by_chars = limits.where("unit = 'chars'").select("source", F.col("limit").alias("chars"), F.lit(True).alias("_c"))
    by_bytes = limits.where("unit = 'bytes'").select("source", F.col("limit").alias("bytes"), F.lit(True).alias("_b"))
    # Sources and limits are few beside the documents; equal pairs of source and length meet by hash.
    both = sure.unionByName(looked).join(by_chars, ["source", "chars"], "left").join(by_bytes, ["source", "bytes"], "left")
    at_limit = F.coalesce("_c", F.lit(False)) | F.coalesce("_b", F.lit(False))
    late = at_limit & ~F.col("heading")
    return both.select("doc_id", "source", (F.col("cut") | late).alias("cut"), F.when(late & ~F.col("cut"), "length limit").otherwise(F.col("reason")).alias("reason"), at_limit.alias("at_limit"))


def truncation_rates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a source: documents, cut ones, their rate, the rate with a mark, and those at one of the source's limits."""
    found = truncation_verdicts(docs, id_col, text_col)
    ones = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return found.groupBy("source").agg(
        F.count("*").alias("documents"), ones(F.col("cut")).alias("cut"), (ones(F.col("cut")) / F.count("*")).alias("rate"),
        ones(F.col("cut") & (F.col("reason") == "mark")).alias("marked"), ones(F.col("cut") & F.col("at_limit")).alias("at_limit"),
    )
