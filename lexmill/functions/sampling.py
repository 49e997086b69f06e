"""Distinct strings that a regex matches: parse, count the language, draw ranks, write them out."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

try:
    import re._parser as _parser
except ImportError:  # before Python 3.11
    import sre_parse as _parser

#: Open repetitions go on at most so far, and the any-character stands for these.
OPEN_END = 3
ALPHABET = "abcdefghijklmnopqrstuvwxyz "


class Language:
    """A finite language: its size, and its members by rank."""

    def __init__(self, pattern: str) -> None:
        self.groups: dict[int, object] = {}
        self.tree = self._sequence(list(_parser.parse(pattern)))

    @classmethod
    def of(cls, items) -> Language:
        """The language of parsed items."""
        made = cls.__new__(cls)
        made.groups, made.tree = {}, None
        made.tree = made._sequence(items)
        return made

    def _sequence(self, items) -> tuple:
        parts = [self._node(op, arg) for op, arg in items]
        size = 1
        for p in parts:
            size *= p[1]
        return ("seq", size, parts)

    def _node(self, op, arg) -> tuple:
        name = str(op)
        if name == "LITERAL":
            return ("text", 1, chr(arg))
        if name == "ANY":
            return ("set", len(ALPHABET), ALPHABET)
        if name == "IN":
            chars = self._class(arg)
            return ("set", len(chars), chars)
        if name == "NOT_LITERAL":
            chars = "".join(c for c in ALPHABET if c != chr(arg))
            return ("set", len(chars), chars)
        if name == "BRANCH":
            options = [self._sequence(list(x)) for x in arg[1]]
            return ("alt", sum(o[1] for o in options), options)
        if name == "SUBPATTERN":
            return self._sequence(list(arg[3]))
        if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = arg
            body = self._sequence(list(inner))
            high = low + OPEN_END if high == _parser.MAXREPEAT else high
            options = [("seq", body[1] ** k, [body] * k) for k in range(low, high + 1)]
            return ("alt", sum(o[1] for o in options), options)
        if name == "AT":
            return ("text", 1, "")
        if name in ("ASSERT", "ASSERT_NOT", "GROUPREF", "GROUPREF_EXISTS"):
            raise ValueError("look-around and back references can't be sampled")
        raise ValueError(f"unknown part {name}")

    @staticmethod
    def _class(items) -> str:
        chars: list[str] = []
        negated = False
        named = {"CATEGORY_DIGIT": "0123456789", "CATEGORY_SPACE": " ", "CATEGORY_WORD": "abcdefghijklmnopqrstuvwxyz0123456789_", "CATEGORY_NOT_SPACE": "abcdefghijklmnopqrstuvwxyz", "CATEGORY_NOT_DIGIT": ALPHABET, "CATEGORY_NOT_WORD": " -"}
        for op, arg in items:
            kind = str(op)
            if kind == "NEGATE":
                negated = True
            elif kind == "LITERAL":
                chars.append(chr(arg))
            elif kind == "RANGE":
                chars.extend(chr(c) for c in range(arg[0], min(arg[1], arg[0] + 255) + 1))
            elif kind == "CATEGORY":
                chars.extend(named[str(arg)])
        if negated:
            chars = [c for c in ALPHABET if c not in chars]
        return "".join(dict.fromkeys(chars))

    @property
    def size(self) -> int:
        """Number of ranks (words reached in several ways count as often)."""
        return self.tree[1]

    def word(self, rank: int) -> str:
        """The word of a rank from 0."""
        out: list[str] = []
        stack: list[tuple[tuple, int]] = [(self.tree, rank)]
        while stack:
            (kind, _, arg), r = stack.pop()
            if kind == "text":
                out.append(arg)
            elif kind == "set":
                out.append(arg[r])
            elif kind == "alt":
                for option in arg:
                    if r < option[1]:
                        stack.append((option, r))
                        break
                    r -= option[1]
            else:
                todo = []
                for part in arg:
                    r, own = divmod(r, part[1])
                    todo.append((part, own))
                stack.extend(reversed(todo))
        return "".join(out)


def sample_regex(pattern: str, most: int = 11, seed: int = 0) -> list[str]:
    """Up to ``most`` distinct words of a regex's language, drawn by hash; all of them if it has no more."""
    try:
        language = Language(pattern)
    except (re.error, ValueError, OverflowError, KeyError):
        return []
    found: dict[str, None] = {}
    if language.size <= most * 4:
        ranks = range(language.size)
    else:
        ranks = (int.from_bytes(hashlib.md5(f"{seed}|{pattern}|{k}".encode()).digest() * 4, "big") % language.size for k in range(most * 20))
    for rank in ranks:
        found.setdefault(language.word(rank))
        if len(found) >= most:
            break
    return list(found)


class Frame:
    """A regex around a gap that is parsed once. ``ValueError`` if text in the gap could change how the rest is read.

    The gap holds pieces of plain text with ``(and|or)`` between them, so a word is one of what stands before the gap, the
    pieces with a choice between each two, and one of what stands after it; ranks and draws are those of sample_regex.
    """

    _GAP = "\x01"
    #: Characters that aren't plain text in a regex.
    marks = re.compile(r"[.\\\[{()*+?^$|]")

    def __init__(self, before: str, after: str) -> None:
        if self._GAP in before + after or "\\" in before + after or "{" in before or not after.startswith(" "):
            raise ValueError("the gap may change how the rest is read")
        parsed = _parser.parse(before + self._GAP + after)
        items = list(parsed)
        at = [k for k, (op, arg) in enumerate(items) if str(op) == "LITERAL" and arg == ord(self._GAP)]
        if len(at) != 1 or parsed.state.flags != re.UNICODE:
            raise ValueError("the gap is not between the parts of the regex")
        self.before, self.after = before, after
        self.sides = Language.of(items[: at[0]]), Language.of(items[at[0] + 1 :])
        self.known: tuple[dict[int, tuple[str, str]], ...] = {}, {}

    def _side(self, k: int, rank: int) -> tuple[str, str]:
        found = self.known[k].get(rank)
        if found is None:
            word = self.sides[k].word(rank)
            found = self.known[k][rank] = word, one_blank(word)
        return found

    def sample(self, pieces: list[str], most: int = 11, seed: int = 0) -> list[str]:
        """sample_regex of the regex with these pieces in its gap, each run of white space as one blank."""
        first, last = self.sides[0].size, self.sides[1].size
        choices = 1 << len(pieces) - 1
        size, draws = first * choices * last, None
        if size <= most * 4:
            ranks = range(size)
        else:
            draws = hashlib.md5(f"{seed}|{self.before}{'(and|or)'.join(pieces)}{self.after}|".encode())
            ranks = (self._rank(draws, k, size) for k in range(most * 20))
        begin, *inner, end = pieces if len(pieces) > 1 else (pieces[0], "")
        neat = [one_blank(p) for p in inner]
        heads: dict[int, tuple[str, str]] = {}
        tails: dict[int, tuple[str, str]] = {}
        found: dict[str, str] = {}
        for rank in ranks:
            rank, own = divmod(rank, first)
            if own not in heads:
                heads[own] = self._joined(self._side(0, own), (begin, one_blank(begin)))
            (raw, made), (rank, own) = heads[own], divmod(rank, choices)
            if rank not in tails:
                tails[rank] = self._joined((end, one_blank(end)), self._side(1, rank))
            if len(pieces) == 1:
                key, value = self._joined((raw, made), tails[rank])
            else:
                words = ["or" if own >> k & 1 else "and" for k in range(len(pieces) - 1)]
                middle = "".join([x + y for x, y in zip(words, inner)]) + words[-1]
                key = raw + middle + tails[rank][0]
                value = made + (middle if neat == inner else "".join([x + y for x, y in zip(words, neat)]) + words[-1]) + tails[rank][1]
            found.setdefault(key, value)
            if len(found) >= most:
                break
        return list(found.values())

    @staticmethod
    def _joined(left: tuple[str, str], right: tuple[str, str]) -> tuple[str, str]:
        """Two texts joined, as they are and with each run of white space as one blank."""
        raw = left[0] + right[0]
        return raw, one_blank(raw) if left[0][-1:].isspace() and right[0][:1].isspace() else left[1] + right[1]

    @staticmethod
    def _rank(draws, k: int, size: int) -> int:
        own = draws.copy()
        own.update(b"%d" % k)
        return int.from_bytes(own.digest() * 4, "big") % size


def one_blank(text: str) -> str:
    """Each run of white space as one blank."""
    inner = " ".join(text.split())
    if not inner:
        return " " if text else ""
    return " " * text[0].isspace() + inner + " " * text[-1].isspace()


def sample_regexes(df: DataFrame, pattern: str, most: int = 11, seed: int = 0) -> DataFrame:
    """A row for each sampled string: the columns of ``df``, ``rank`` and ``expansion``. Null or unreadable regexes give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["_x"] = [sample_regex(p, most, seed) if p is not None else [] for p in pdf[pattern].array]
            yield pdf

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    out = df.mapInPandas(run, f"{kinds}, _x array<string>")
    return out.select(*df.columns, F.posexplode("_x").alias("rank", "expansion"))
