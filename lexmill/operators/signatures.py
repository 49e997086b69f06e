"""The signature catalogue: parsing, dialect, and scanning of texts."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexmill.functions import text as T
from lexmill.functions.sampling import _parser
from lexmill.runtime import known_rows, materialize


def parse_catalogue(lines: DataFrame, doc: str = "doc", line: str = "line", value: str = "value") -> DataFrame:
    """Entries of catalogue texts given by line: (``doc``, ``entry_id``, ``family``, ``license``, ``key_regex``, ``str_regex``, ``nocheck``, ``optional_str``, ``aliases``, ``line``).

    An entry runs from its ``%ENTRY%`` line to the next one of its document; a state is carried forward over the
    lines, comments are dropped. ``=NULL=`` keys become null; one outer pair of quotes goes. A document without
    entries gives no row.
    """
    rows = lines.where(F.col(value).isNotNull()).select(doc, line, T.strip(F.col(value)).alias("v")).where(~F.col("v").startswith("#"))
    tag = F.regexp_extract("v", r"^%(\??[A-Z]+)%", 1)
    rows = rows.withColumn("_tag", tag).withColumn("_rest", T.strip(F.regexp_replace("v", r"^%\??[A-Z]+%", "")))
    carried = Window.partitionBy(doc).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    start = F.last(F.when(F.col("_tag") == "ENTRY", F.col(line)), ignorenulls=True).over(carried)
    rows = rows.withColumn("_entry", start).where("_entry IS NOT NULL AND _tag <> ''")
    pick = lambda *tags: F.max_by(F.when(F.col("_tag").isin(*tags), F.col("_rest")), F.when(F.col("_tag").isin(*tags), -F.col(line)))
    entries = rows.groupBy(doc, F.col("_entry").alias("line")).agg(
        pick("ENTRY").alias("entry_id"), pick("KEY").alias("_key"), pick("STR", "?STR").alias("_str"),
        F.max(F.col("_tag") == "NOCHECK").alias("nocheck"), F.max(F.col("_tag") == "?STR").alias("optional_str"),
        F.array_sort(F.collect_list(F.when(F.col("_tag") == "ALIAS", F.col("_rest")))).alias("aliases"),
    )
    family = F.regexp_extract("entry_id", r"^_([A-Z]+)_", 1)
    return entries.select(
        doc, "entry_id", family.alias("family"), F.regexp_replace("entry_id", r"^_(LT|SPDX)_", "").alias("license"),
        F.when(F.col("_key") == "=NULL=", None).otherwise(T.unquote(F.col("_key"))).alias("key_regex"), T.unquote(F.col("_str")).alias("str_regex"),
        "nocheck", "optional_str", "aliases", "line",
    )


def parse_definitions(lines: DataFrame, doc: str = "doc", line: str = "line", value: str = "value") -> DataFrame:
    """Derived counts of catalogue texts: (``doc``, ``line``, ``name``, ``value``) for each ``%DEF% name value`` line; comments are none."""
    v = T.strip(F.col(value))
    rows = lines.where(v.rlike(r"^%DEF%\s")).select(doc, line, T.strip(F.regexp_replace(v, "^%DEF%", "")).alias("_d"))
    return rows.select(doc, line, F.regexp_extract("_d", r"^(\S+)", 1).alias("name"), T.strip(F.regexp_replace("_d", r"^\S+", "")).alias("value"))


#: From the first score on a text is surely a licence, below the second one it is probably none.
SURE_SCORE, LEAST_SCORE = 9, 4


def score_class(score: Column) -> Column:
    """What a number of licence signs says of a text: license, unsure or none; null for a null score."""
    return F.when(score >= SURE_SCORE, "license").when(score >= LEAST_SCORE, "unsure").when(score.isNotNull(), "none")


#: POSIX classes and what they are in a class here; word bounds; the year word.
POSIX = {"[:space:]": r"\s", "[:digit:]": r"\d", "[:alpha:]": r"a-zA-Z", "[:alnum:]": r"a-zA-Z0-9", "[:punct:]": r"!-/:-@\[-`{-~", "[:upper:]": "A-Z", "[:lower:]": "a-z"}
YEAR = r"[0-9]{4}"


def _escape_open(pattern: str) -> str:
    """``[`` inside a class is literal in the catalogue's dialect."""
    out, inside, k = [], False, 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\" and k + 1 < len(pattern):
            out.append(pattern[k : k + 2])
            k += 2
            continue
        if inside and c == "[":
            out.append("\\[")
        elif not inside and c == "[":
            inside = True
            out.append(c)
            if pattern[k + 1 : k + 2] in ("]", "^"):
                out.append(pattern[k + 1] if pattern[k + 1] == "^" else "\\]")
                k += 1
        else:
            if inside and c == "]":
                inside = False
            out.append(c)
        k += 1
    return "".join(out)


def transpile(pattern: str | None) -> str | None:
    """A catalogue regex in the dialect used here; None where it can't be read (it is quarantined)."""
    if pattern is None or not pattern.strip():
        return None
    out = pattern.replace(r"\<", r"\b").replace(r"\>", r"\b").replace("=YEAR=", YEAR)
    for macro, width in T.MACROS.items():
        out = out.replace(macro, width)
    for posix, own in POSIX.items():
        out = out.replace(posix, own)
    out = _escape_open(out)
    try:
        re.compile(out)
    except re.error:
        return None
    return out


def scan_form(c: Column) -> Column:
    """A signature as it is matched against text of for_scan: macros expanded, hyphens between letters as blanks, blanks collapsed."""
    c = T.expand_macros(T.unquote(c))
    return T.strip(T.collapse(F.regexp_replace(c, r"(?<=\p{L})-(?=\p{L})", " ")))


def _sure(pattern: str) -> tuple[str, int, int | None]:
    """needle, and how many characters at least and at most stand before it in a match; None where that isn't known."""
    best: tuple[str, int, int | None] = ("", 0, None)

    def walk(items, top: bool) -> None:
        nonlocal best
        run = ""
        for k, (op, arg) in enumerate([*items, (None, None)]):
            c = chr(arg).lower() if str(op) == "LITERAL" else ""
            if len(c) == 1 and c.isascii() and (c.isalnum() or c == " "):
                run += c
                continue
            if len(run) > len(best[0]):
                low, high = items[: k - len(run.lstrip())].getwidth() if top else (0, None)
                best = (run, low, high)
            run = ""
            if str(op) == "SUBPATTERN":
                walk(arg[3], False)
            elif str(op) in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] >= 1:
                walk(arg[2], False)

    walk(_parser.parse(pattern, re.IGNORECASE), True)
    return best[0].strip(), *best[1:]


def needle(pattern: str) -> str:
    """The longest run of ASCII letters, digits and blanks that every match holds as it stands, lower-cased; empty if there is none.

    Read off the parsed regex: only literal characters outside alternatives, classes and repetitions count, and a part
    that must occur at least once counts by itself.
    """
    return _sure(pattern)[0]


def alternatives(pattern: str) -> list[str]:
    """Regexes of which one is found just where ``pattern`` is found: the alternatives of a pattern that is one plain list of them, else itself."""
    if "(?" in pattern or re.search(r"\\[0-9]", pattern):
        return [pattern]

    def split(text: str) -> list[str] | None:
        parts, depth, inside, k, begin = [], 0, False, 0, 0
        while k < len(text):
            c = text[k]
            if c == "\\":
                k += 1
            elif inside:
                inside = c != "]"
            elif c == "[":
                inside = True
                k += text[k + 1 : k + 2] == "^"
                k += text[k + 1 : k + 2] == "]"  # literal at this place
            elif c in "()":
                depth += 1 if c == "(" else -1
                if depth < 0:
                    return None
            elif c == "|" and not depth:
                parts.append(text[begin:k])
                begin = k + 1
            k += 1
        return [*parts, text[begin:]]

    found = split(pattern[1:-1]) if pattern.startswith("(") and pattern.endswith(")") and not pattern.endswith("\\)") else split(pattern)
    found = found or split(pattern) or [pattern]
    try:
        for x in found:
            re.compile(x)
    except re.error:
        return [pattern]
    return found


def _ready(signatures: DataFrame, sig_col: str, regex_col: str, key_col: str | None) -> DataFrame:
    """(``sig``, ``key``, ``regex``, ``needle``) of the signatures that can be read, each once."""
    key = F.col(key_col) if key_col else F.lit(None).cast("string")
    given = signatures.where(F.col(regex_col).isNotNull() & F.col(sig_col).isNotNull()).select(F.col(sig_col).alias("sig"), key.alias("key"), F.col(regex_col).alias("regex")).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for sig, key, pattern in zip(pdf["sig"].array, pdf["key"].array, pdf["regex"].array):
                blank = key is None or pd.isna(key) or not str(key).strip()
                regex, own = transpile(pattern), None if blank else transpile(key)
                if regex is not None and (blank or own is not None):
                    out.append((sig, own, regex, needle(regex)))
            yield pd.DataFrame(out, columns=["sig", "key", "regex", "needle"]).astype({"key": "object"})

    return given.mapInPandas(run, f"sig {given.schema['sig'].dataType.simpleString()}, key string, regex string, needle string")


#: What stands for an ASCII letter without regard to case, but isn't lower-cased to one character of ASCII.
_FOLDED = str.maketrans({"\u0130": "i", "\u0131": "i", "\u017f": "s", "\u212a": "k"})
#: Starts of a match that are tried for each place of its sure literal; beyond that the whole text is searched. Texts at a time, rows sent at a time.
_STARTS, _TEXTS, _SENT = 8, 256, 200_000


def _expanded(begin: np.ndarray, size: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of the groups ``x``, and by which place of ``x`` each comes."""
    many = size[x]
    by = np.repeat(np.arange(len(x)), many)
    return np.arange(len(by)) + (begin[x] - np.cumsum(many) + many)[by], by


def _groups(pairs: list[tuple[int, int]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs by their first number: where each of ``n`` groups begins and its size; the order of the pairs."""
    first = np.array([a for a, _ in pairs], np.int64)
    size = np.bincount(first, minlength=n)
    return np.cumsum(size) - size, size, np.argsort(first, kind="stable")


class _Block:
    """A block of signatures, ready to be tried on texts: each regex is tried once a text, however many signatures and keys it has.

    Regexes are compiled when they are first needed. Keys are split into their alternatives; plain words among these are found by one automaton.
    """

    def __init__(self, rows: list[tuple]) -> None:
        number = lambda values: {v: k for k, v in enumerate(dict.fromkeys(values))}
        sigs, keys, regexes = number(r[0] for r in rows), number(r[1] for r in rows if r[1] is not None), number(r[2] for r in rows)
        self.sigs, self.regexes, self.keys, self.once = list(sigs), list(regexes), len(keys), len(sigs) == len(rows)
        self.begin, self.size, order = _groups([(regexes[r[2]], 0) for r in rows], len(regexes))
        self.sig = np.array([sigs[r[0]] for r in rows], np.int64)[order]
        self.key = np.array([len(keys) if r[1] is None else keys[r[1]] for r in rows], np.int64)[order]  # the last one stands for none
        self.always: list[int] = []
        near: dict[str, list[tuple]] = {}
        for regex, sure in dict.fromkeys((r[2], r[3]) for r in rows):
            if sure:
                _, low, high = _sure(regex)
                near.setdefault(sure, []).append((regexes[regex], low, high if high is not None and high - low < _STARTS else None))
            else:
                self.always.append(regexes[regex])
        self.near = self._automaton(near)

        parts = {k: alternatives(k) for k in keys}
        parted = number(x for p in parts.values() for x in p)
        pairs = [(parted[x], keys[k]) for k, p in parts.items() for x in dict.fromkeys(p)]
        self.alt_begin, self.alt_size, order = _groups(pairs, len(parted))
        self.alt_key = np.array([k for _, k in pairs], np.int64)[order]
        self.alts = list(parted)
        plain = {x for x in parted if re.fullmatch("[A-Za-z0-9 ]+", x)}
        self.words = self._automaton({x.lower(): [] for x in plain})
        self.word_alts: dict[str, list[int]] = {}
        for x in plain:
            self.word_alts.setdefault(x.lower(), []).append(parted[x])
        asked: dict[int, set[int]] = {}
        for _, key, regex, _ in rows:
            if key is not None:
                asked.setdefault(regexes[regex], set()).update(parted[x] for x in parts[key] if x not in plain)
        self.asked = {r: frozenset(x) for r, x in asked.items()}
        self.compiled: dict[str, re.Pattern] = {}

    @staticmethod
    def _automaton(words: dict[str, list]):
        import ahocorasick

        if not words:
            return None
        out = ahocorasick.Automaton()
        for w, told in words.items():
            out.add_word(w, (w, len(w), told))
        out.make_automaton()
        return out

    def _pattern(self, regex: str) -> re.Pattern:
        if regex not in self.compiled:
            self.compiled[regex] = re.compile(regex, re.IGNORECASE)
        return self.compiled[regex]

    def _found(self, text: str) -> list[int]:
        """The regexes that match a normalised text."""
        found: dict[int, bool] = {r: self._pattern(self.regexes[r]).search(text) is not None for r in self.always}
        # The long s matches s without regard to case, but isn't lower-cased to it.
        for end, (_, length, told) in self.near.iter(text.replace("\u017f", "s")) if self.near else ():
            for r, low, high in told:
                if high is None:
                    if r not in found:
                        found[r] = self._pattern(self.regexes[r]).search(text) is not None
                elif not found.get(r):
                    at, match = end - length + 1, self._pattern(self.regexes[r]).match
                    if low == high:
                        found[r] = at >= low and match(text, at - low) is not None
                    else:
                        found[r] = any(match(text, k) for k in range(max(0, at - high), at - low + 1))
        return [r for r, yes in found.items() if yes]

    def _keys(self, raw: str, found: list[int]) -> list[int]:
        """The alternatives of the keys of these regexes that stand in a raw text."""
        asked = {self.asked[r] for r in found if r in self.asked}
        if not asked:
            return []
        out = [a for a in frozenset().union(*asked) if self._pattern(self.alts[a]).search(raw)]
        if self.words:
            for w in {w for _, (w, _, _) in self.words.iter(raw.translate(_FOLDED).lower() if not raw.isascii() else raw.lower())}:
                out += self.word_alts[w]
        return out

    def matches(self, raws: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of texts and of signatures whose KEY stands in the raw text and whose STR stands in the normalised one, each pair once."""
        t, r, kt, k = [], [], [], []
        for i, (raw, text) in enumerate(zip(raws, texts)):
            if found := self._found(text):
                t += [i] * len(found)
                r += found
                if stands := self._keys(raw, found):
                    kt += [i] * len(stands)
                    k += stands
        ok = np.zeros((len(texts), self.keys + 1), bool)
        ok[:, -1] = True
        if k:
            member, by = _expanded(self.alt_begin, self.alt_size, np.array(k, np.int64))
            ok[np.array(kt, np.int64)[by], self.alt_key[member]] = True
        row, by = _expanded(self.begin, self.size, np.array(r, np.int64))
        at = np.array(t, np.int64)[by]
        keep = ok[at, self.key[row]]
        at, sig = at[keep], self.sig[row[keep]]
        if not self.once and len(at):
            at, sig = np.divmod(np.unique(at * len(self.sigs) + sig), len(self.sigs))
        return at, sig


#: The block that a worker process used last, by the name of what was sent.
_LAST: dict[str, _Block] = {}


def _block(name: str, sent) -> _Block:
    """The block of the rows sent, built once a process and not once a task."""
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = _Block(sent.value)
    return _LAST[name]


def _scanned(docs: DataFrame, signatures: DataFrame, id_col: str, text_col: str, sig_col: str, regex_col: str, key_col: str | None, block_rows: int, counted: bool) -> list[DataFrame]:
    """A table for each block: (``id``, ``sig``), or (``id``, ``n``) if ``counted``. No signature is in two blocks; an id's texts may be several rows."""
    spark = docs.sparkSession
    ready = materialize(_ready(signatures, sig_col, regex_col, key_col), "signatures", counted=True)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("raw"), T.for_scan(F.col(text_col)).alias("text"))
    kind = to_arrow_type(ready.schema["sig"].dataType)
    schema = f"id {texts.schema['id'].dataType.simpleString()}, " + ("n bigint" if counted else f"sig {ready.schema['sig'].dataType.simpleString()}")
    blocks = max(1, math.ceil(known_rows(ready) / block_rows))
    found: list[DataFrame] = []
    for k in range(blocks):
        rows = [tuple(r) for r in ready.where(F.pmod(F.xxhash64("sig"), F.lit(blocks)) == k).collect()]  # about block_rows
        sent, name = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], sent=sent, name=name) -> Iterator[pa.RecordBatch]:
            block = _block(name, sent)
            sigs = pa.array(block.sigs, kind)
            for batch in batches:
                for first in range(0, batch.num_rows, _TEXTS):
                    part = batch.slice(first, _TEXTS)
                    at, sig = block.matches(part.column(1).to_pylist(), part.column(2).to_pylist())
                    if counted:
                        many = np.bincount(at, minlength=part.num_rows)
                        own = np.flatnonzero(many)
                        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own)), pa.array(many[own], pa.int64())], names=["id", "n"])
                        continue
                    for k in range(0, len(at), _SENT):
                        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at[k : k + _SENT])), sigs.take(pa.array(sig[k : k + _SENT]))], names=["id", "sig"])

        part = texts.mapInArrow(run, schema)
        if blocks > 1:
            part = materialize(part, "matches")
            sent.destroy()
        found.append(part)
    return found


def _by_rows_of_id(docs: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose id stands once, and those whose id stands several times, if there are any; only ids are shuffled."""
    ids = docs.select(F.col(id_col).alias("_again")).groupBy("_again").agg(F.count("*").alias("_n")).where("_n > 1").select("_again")
    again = materialize(ids, "again", compact=False, counted=True)
    if not known_rows(again):
        return docs, None
    same = F.col(id_col).eqNullSafe(F.col("_again"))
    return docs.join(again, same, "left_anti"), docs.join(again, same, "left_semi")


def scan(docs: DataFrame, signatures: DataFrame, id_col: str, text_col: str, sig_col: str, regex_col: str, key_col: str | None = None, block_rows: int = 200_000) -> DataFrame:
    """(``id_col``, ``sig_col``): which signatures match which texts.

    A signature matches if its KEY (``key_col``; none where null or blank) is found in the text as it is and its regex
    in the normalised text. Every text is normalised once a block and run through one automaton over the regexes' sure
    literals; only regexes whose literal occurs are tried, where it occurs, each once a text, and the keys after them. The texts aren't
    shuffled, nor are the matches, but for those of repeated ids. The signatures are sent in blocks of about ``block_rows``, one after the other: if there are several, a block's result is
    written and its rows are let go before the next one is fetched. Null regexes and those that can't be read match
    nothing; repeated signatures and texts count once an id.
    """
    alone, again = _by_rows_of_id(docs, id_col)
    out = [_scanned(x, signatures, id_col, text_col, sig_col, regex_col, key_col, block_rows, False) for x in (alone, again) if x is not None]
    parts = [reduce(DataFrame.unionByName, x) for x in out]
    parts[1:] = [x.distinct() for x in parts[1:]]
    return reduce(DataFrame.unionByName, parts).toDF(id_col, sig_col)


def match_counts(docs: DataFrame, signatures: DataFrame, id_col: str, text_col: str, sig_col: str, regex_col: str, key_col: str | None = None, block_rows: int = 200_000) -> DataFrame:
    """(``id_col``, ``n``): how many signatures match each text, as scan would list them; ids without a match have no row."""
    alone, again = _by_rows_of_id(docs, id_col)
    counts = _scanned(alone, signatures, id_col, text_col, sig_col, regex_col, key_col, block_rows, True)
    out = counts[0] if len(counts) == 1 else reduce(DataFrame.unionByName, counts).groupBy("id").agg(F.sum("n").alias("n"))
    if again is not None:
        listed = reduce(DataFrame.unionByName, _scanned(again, signatures, id_col, text_col, sig_col, regex_col, key_col, block_rows, False))
        out = out.unionByName(listed.distinct().groupBy("id").agg(F.count("*").alias("n")))
    return out.toDF(id_col, "n")
