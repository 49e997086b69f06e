"""Problem 3: text from a wrong decoding, found and restored by best-first search over conversions."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Encodings through which UTF-8 bytes are often misread.
MISREAD_UTF8 = ("cp1252", "cp1251", "mac_roman", "cp437", "cp850", "koi8_r", "cp1250", "iso8859_2")
#: Encodings whose bytes are often misread as Latin-1 or Windows-1252.
MISREAD_AS_LATIN = ("cp1251", "koi8_r", "cp1250", "iso8859_2", "shift_jis", "euc_jp")

_ESCAPE = regex.compile(r"\\x([0-9a-fA-F]{2})|\\u([0-9a-fA-F]{4})")
_MULTI = regex.compile("[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf4][\x80-\xbf]{3}")
#: What UTF-8 sequences of licence text stand for: letters of the languages' scripts, typographic signs, currency, symbols.
_PLAUSIBLE = regex.compile(r"[\u0080-ſƒȘ-țˆ˜Ά-ώЀ-џҐґא-תء-يẞẠ-ỹ‐-‧‰-›⁰-₎₠-₿℀-⅏⅐-↋←-⇿∀-⋿─-◿☀-➿　-ヿ㐀-鿿가-힣！-ﾟﬀ-ﬆ﻿�\U0001f300-\U0001faff]")
_NONASCII = regex.compile(r"[^\x00-\x7f]")

#: Marks of a wrong decoding and what one costs. Sound text of any language has none.
_SIGNS: tuple[tuple[regex.Pattern, float], ...] = tuple(
    (regex.compile(p), c)
    for p, c in (
        (r"�", 5.0),
        (r"[\x80-\x84\x86-\x9f]", 4.0),
        (r"[-]", 3.0),
        (r"[─-▟](?=[\p{L}])|(?<=[\p{L}])[─-▟]", 2.0),
        (r"â€|вЂ", 4.0),
        (r"[ВГ](?=[\xa1-\xbf])", 3.0),
        (r"Ã(?=[^\p{L}\s.,;:!?)\"'”’»-])", 3.0),
        (r"Â(?=[\xa1-\xbf])", 3.0),
        (r"(?<=\p{Ll})[ÃÂ](?=[^\p{L}])", 3.0),
        (r"[ÃÂ](?=[\u0100-\uffff])|[ÃÂ](?=[ß-ÿ])", 3.0),
        (r"\p{Script=Latin}(?=\p{Script=Cyrillic})|\p{Script=Cyrillic}(?=\p{Script=Latin})", 0.7),
        (r"[à-öø-ÿ]{4,}|(?<=[^\p{L}])[à-öø-ÿ]{3,}(?=[^\p{L}])", 4.0),
        (r"(?<=\p{L})[¡-©«¬®-¶¸¹»-¿](?=\p{Ll})", 3.0),
        (r"(?<=[a-z])[£¥¦¨¯±³´¶¸¹¼-¿](?=[\s.,;]|$)", 1.0),
        (r"(?<=\b\p{Script=Cyrillic}*[а-я])[А-Я]{2,}", 3.0),
        (r"[ЂЃЉ-ЌЎЏђѓљ-ќўџ](?=[^\p{Script=Cyrillic}])", 1.0),
        (r"[¤¡-¿]{2}[À-ÿ]{2}|[À-ÿ]{2}[¤¡-©«-¿]{1,2}[À-ÿ]{2}", 3.0),
        (r"[｡-ﾟ]", 1.0),
    )
)
_CAPITALS = regex.compile(r"(?<![\p{L}])[À-ÖØ-Þà-öø-ÿ×÷]{3,}(?![\p{L}])")
#: A difference in cost that tells a garbled text from a sound one: a single trifling sign isn't enough.
GARBLED = 2.0


@lru_cache(maxsize=None)
def _byte_view(encoding: str) -> dict[int, int]:
    """Each character that the encoding gives for a byte from 0x80 on -> that byte; C1 controls stand for themselves."""
    view = {}
    for byte in range(0x80, 0x100):
        try:
            view[ord(bytes([byte]).decode(encoding))] = byte
        except UnicodeDecodeError:
            pass
    if encoding in ("cp1252", "cp1251", "cp1250", "iso8859_2"):  # undefined bytes pass through many decoders as controls
        for byte in range(0x80, 0xA0):
            view.setdefault(byte, byte)
    if encoding == "cp1252":
        for byte in range(0xA0, 0x100):
            view.setdefault(byte, byte)
    return view


class _Table(dict):
    """A translation that turns characters without a byte into a zero, so that places stay."""

    def __init__(self, encoding: str) -> None:
        super().__init__(_byte_view(encoding))

    def __missing__(self, key: int) -> int:
        self[key] = out = key if key < 0x80 else 0
        return out


@lru_cache(maxsize=None)
def _table(encoding: str) -> _Table:
    return _Table(encoding)


_LATIN = ("cp1252", "cp1250", "iso8859_2")


def _sequences(text: str, encoding: str) -> Iterator[tuple[int, int, str]]:
    """Where the bytes behind a text hold UTF-8 sequences of plausible characters: start, end, character."""
    for found in _MULTI.finditer(text.translate(_table(encoding))):
        try:
            char = found.group().encode("latin-1").decode("utf-8")
        except UnicodeDecodeError:
            continue
        if encoding in _LATIN and "à" <= text[found.start()] <= "ï" and not text[found.start() + 1 : found.end()].strip("\xa0\xad“”‘’»…–—™®©"):
            continue  # a letter before hard blanks, soft hyphens, closing quotes, dashes or marks
        if _PLAUSIBLE.match(char) or "\x80" <= char <= "\x9f":
            yield found.start(), found.end(), char


@lru_cache(maxsize=200_000)
def _run_cost(run: str) -> float:
    """What a run of non-ASCII characters costs for the UTF-8 sequences that it hides under one of the encodings."""
    if len(run) < 2:
        return 0.0
    most = 0.0
    for encoding in MISREAD_UTF8:
        cost = 0.0
        for a, b, char in _sequences(run, encoding):
            piece = run[a:b]
            sure = encoding == "cp1252" or any(not c.isalpha() for c in piece) or b - a > 2 or regex.search(r"\p{Lu}", piece) is not None
            # Two plain letters of the run's own language that happen to make a sequence prove nothing.
            if sure and not (piece[0] in "’“”«»„‘–—…" and encoding != "cp1252"):
                cost += 2.0 * (b - a - 1)
        most = max(most, cost)
    return most


_RUN = regex.compile(r"[^\x00-\x7f]{2,}")


def cost(text: str) -> float:
    """Character plausibility: 0 for sound text, more the more of it looks misread; a trifle for each character beyond ASCII."""
    if text.isascii():
        return 0.0
    total = 0.0
    for run in _RUN.finditer(text):
        total += _run_cost(run.group())
    for pattern, worth in _SIGNS:
        n = sum(1 for _ in pattern.finditer(text))
        total += worth * n
    words = _CAPITALS.findall(text)
    if len(words) >= 2 and sum(map(len, words)) > 0.2 * sum(c.isalpha() for c in text):
        total += 2.0 * len(words)
    return total


def _unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)), text)


def _repair(text: str, encoding: str) -> str:
    """All plausible UTF-8 sequences under one encoding put right, the rest left as it is."""
    out, at = [], 0
    for a, b, char in _sequences(text, encoding):
        out.append(text[at:a])
        out.append(char)
        at = b
    return "".join(out) + text[at:] if out else text


def _reread(text: str, encoding: str) -> str:
    """Lines whose characters are bytes read as Latin-1 or Windows-1252, read again under another encoding."""
    lines = []
    for line in text.split("\n"):
        if not line.isascii():
            view = line.translate(_table("cp1252"))
            if "\0" not in view:
                try:
                    line = view.encode("latin-1").decode(encoding)
                except (UnicodeDecodeError, UnicodeEncodeError):
                    pass
        lines.append(line)
    return "\n".join(lines)


OPERATIONS = (
    [("unescape", _unescape)]
    + [(f"utf-8 read as {e}", lambda t, e=e: _repair(t, e)) for e in MISREAD_UTF8]
    + [(f"{e} read as latin", lambda t, e=e: _reread(t, e)) for e in MISREAD_AS_LATIN]
)


_SHOUTED = regex.compile(r"[А-ЯЁ]{3,}")


def _priority(text: str) -> float:
    return cost(text) + 0.3 * len(_SHOUTED.findall(text)) + 0.01 * len(_NONASCII.findall(text)) + 0.02 * len(_ESCAPE.findall(text))


_LOST = regex.compile("�")
#: What no conversion takes away: a lost character's cost. A conversion itself costs one.
LOST_COST, STEP_COST = 5.0, 1.0


class Found(NamedTuple):
    """Outcome of a search: the cheapest text, its cost, the cost of the text itself, the way, and whether the text is garbled."""

    text: str
    after: float
    before: float
    way: list[str]
    garbled: bool


def restore(text: str) -> Found:
    """Search the texts that conversions lead to for the cheapest one, by plausibility and number of conversions.

    Best-first: the cheapest state not yet opened is opened next; states are known again by hash. A state's cost is its
    implausibility and ``STEP_COST`` for each conversion. No conversion brings back a lost character, so all that can follow a
    state costs at least its lost characters and one conversion more; the search ends when that is no less than the best state
    for every state that is left, so nothing cheaper is missed and no number of states is set. The text is garbled if the search
    leads to another text that is cheaper by ``GARBLED`` or more, or if even the cheapest text that it reaches shows lost
    characters or costs ``GARBLED`` or more.
    """
    plain = _unescape(text)
    before = max(cost(text), cost(plain))
    if before == 0.0:
        return Found(text, 0.0, 0.0, [], False)

    def real(state: str, steps: int) -> float:
        """An escaped text costs what it stands for."""
        return _priority(state) + (cost(_unescape(state)) if _ESCAPE.search(state) else 0.0) + STEP_COST * steps

    heap: list[tuple[float, int, str, list[str]]] = [(real(text, 0), 0, text, [])]
    seen = {text}
    best = (heap[0][0], text, [])
    while heap:
        value, _, state, way = heapq.heappop(heap)
        if value < best[0]:
            best = (value, state, way)
        if LOST_COST * len(_LOST.findall(state)) + STEP_COST * (len(way) + 1) >= best[0]:
            continue
        for name, operation in OPERATIONS:
            after = operation(state)
            if after not in seen:
                seen.add(after)
                heapq.heappush(heap, (real(after, len(way) + 1), len(seen), after, [*way, name]))
    left = max(cost(best[1]), cost(_unescape(best[1])))
    return Found(best[1], left, before, best[2], before - left >= GARBLED or left >= GARBLED)


SCHEMA = "id long, restored string, cost_before double, cost_after double, way string"


def garbled(df: DataFrame, id_col: str = "file_id", text_col: str = "content") -> DataFrame:
    """(``id``, ``restored``, ``cost_before``, ``cost_after``, ``way``) for every row whose text, or part of it, is misread.

    The search decides (see restore). The scan drops pure ASCII without escapes before Python sees it. ``restored`` is the cheapest text found, which
    keeps what can't be restored (lost bytes) as it stands; ``cost_after`` above 0 says so. Null, empty and sound texts
    give no row, repeated rows a row each. No shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, text in zip(pdf["id"].to_numpy(), pdf["text"].array):
                found = restore(text)
                if found.garbled:
                    out.append((i, found.text, found.before, found.after, " > ".join(found.way)))
            yield pd.DataFrame(out, columns=["id", "restored", "cost_before", "cost_after", "way"]).astype({"id": "int64", "cost_before": "float64", "cost_after": "float64"})

    beyond = F.col(text_col).rlike(r"[^\x00-\x7F]|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}")
    return df.where(F.col(id_col).isNotNull() & beyond).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(run, SCHEMA)
