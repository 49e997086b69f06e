"""Column expressions on text. A null text gives null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII punctuation, as a string and as a class; white space and word characters beyond ASCII.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PUNCT = r"[!-/:-@\[-`{-~]"
WS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
#: The marks that are dropped from the words of a chain; quotes stay.
CHAIN_MARKS = "!@#$%^&*()[]{};:,./<>?\\|`~-=_+"
#: Widths of the catalogue's wildcards.
MACROS = {"=FEW=": ".{1,32}", "=SOME=": ".{1,60}", "=ANY=": ".{1,60}"}


def strip(c: Column) -> Column:
    """Without outer white space."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def collapse(c: Column) -> Column:
    """Each run of white space as one blank."""
    return F.regexp_replace(c, f"{WS}+", " ")


def clean_text(c: Column) -> Column:
    """Without words that hold digits, ASCII punctuation and single ASCII letters; white space collapsed.

    Outer blanks go before punctuation does, so one may remain. Case is kept.
    """
    c = strip(F.regexp_replace(F.regexp_replace(c, rf"{WORD}*\p{{Nd}}{WORD}*", ""), r"\n+", "\n"))
    c = F.translate(c, PUNCTUATION, "")
    return collapse(F.regexp_replace(c, rf"(?<!{WORD})[a-zA-Z](?!{WORD})", ""))


def tokenize(c: Column) -> Column:
    """Tokens: each ASCII punctuation character, and what stands between those and white space."""
    return F.regexp_extract_all(c, F.lit(rf"({PUNCT}|[^!-/:-@\[-`{{-~\s\x0B\x1C-\x1F\x85\p{{Z}}]+)"), F.lit(1))


def newlines(c: Column) -> Column:
    """Line ends of all kinds as a line feed."""
    return F.regexp_replace(c, r"\r\n?", "\n")


def sentences(c: Column) -> Column:
    """Pieces between ``". "``, stripped; a line end counts as a line feed and a blank."""
    return F.transform(F.split(F.regexp_replace(newlines(c), "\n", "\n "), r"\. ", -1), strip)


def train_sentences(c: Column) -> Column:
    """Pieces between full stops, each with its full stop; the rest after the last one gets one too."""
    return F.transform(F.split(c, r"\.", -1), lambda s: F.concat(s, F.lit(".")))


def paragraphs(c: Column) -> Column:
    """Pieces between double line feeds, empty ones included."""
    return F.split(newlines(c), "\n\n", -1)


def joined_paragraphs(c: Column) -> Column:
    """Paragraphs joined by ``". "``."""
    return F.array_join(paragraphs(c), ". ")


def blank_lines(c: Column) -> Column:
    """Number of blank lines and one; what follows a closing line feed is no line."""
    pieces = F.split(newlines(c), "\n", -1)
    blank = F.size(F.filter(pieces, lambda x: x.rlike(f"^{WS}*$")))
    return blank - F.when(F.element_at(pieces, -1) == "", 1).otherwise(0) + 1


def blank_characters(c: Column) -> Column:
    """Number of white-space characters and one."""
    return F.regexp_count(c, F.lit(WS)) + 1


def drop_digit_words(c: Column) -> Column:
    """Without words that hold a digit."""
    return F.regexp_replace(c, rf"{WORD}*\p{{Nd}}{WORD}*", "")


def chain_words(c: Column) -> Column:
    """Words between single blanks, without marks, in lower case; line ends stay inside words."""
    return F.transform(F.split(c, " ", -1), lambda w: F.lower(F.translate(w, CHAIN_MARKS, "")))


def unquote(c: Column) -> Column:
    """Stripped, and without one outer pair of double quotes."""
    s = strip(c)
    return F.when((F.length(s) >= 2) & s.startswith('"') & s.endswith('"'), F.substring(s, F.lit(2), F.length(s) - 2)).otherwise(s)


def expand_macros(c: Column) -> Column:
    """Wildcard words of the catalogue as bounded wildcards."""
    for macro, width in MACROS.items():
        c = F.replace(c, F.lit(macro), F.lit(width))
    return c


def erase_macros(c: Column) -> Column:
    """Without wildcard words."""
    return F.regexp_replace(c, "=FEW=|=SOME=|=ANY=", "")


def _times(c: Column, mark: str) -> Column:
    return ((F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) / len(mark)).cast("int")


#: Wildcard kinds in the order in which they are looked for.
KINDS = (
    ("group", "(.{1,32} (AND|OR)){1,4}"), ("few", "=FEW="), ("few", ".{1,32}"), ("some", "=SOME="), ("any", "=ANY="), ("some", ".{1,60}"),
)


def wildcard_kind(c: Column) -> Column:
    """The first kind of wildcard in a regex: group, few, some, any or none."""
    out = F.lit("none")
    for kind, mark in reversed(KINDS):
        out = F.when(c.contains(mark), kind).otherwise(out)
    return F.when(c.isNotNull(), out)


def wildcard_mark(c: Column) -> Column:
    """The mark of the first kind of wildcard in a regex, null if there is none."""
    out = F.lit(None).cast("string")
    for _, mark in reversed(KINDS):
        out = F.when(c.contains(mark), mark).otherwise(out)
    return out


def wildcard_count(c: Column) -> Column:
    """How often the mark of the first kind stands in a regex; 0 if there is none."""
    out = F.lit(0)
    for _, mark in reversed(KINDS):
        out = F.when(c.contains(mark), _times(c, mark)).otherwise(out)
    return F.when(c.isNotNull(), out)


def regex_prefix(c: Column) -> Column:
    """What stands before the first wildcard mark; all of it if there is none."""
    mark = wildcard_mark(c)
    return F.when(mark.isNull(), c).otherwise(F.substring(c, F.lit(1), F.position(mark, c) - 1))


def regex_suffix(c: Column) -> Column:
    """What stands after the first wildcard mark; empty if there is none."""
    mark = wildcard_mark(c)
    rest = F.substring(c, F.position(mark, c) + F.length(mark), F.length(c))
    return F.when(c.isNotNull(), F.when(mark.isNull(), "").otherwise(rest))


def regex_last_suffix(c: Column) -> Column:
    """What stands after the last wildcard mark of the first kind; empty if there is none."""
    mark = wildcard_mark(c)
    return F.when(c.isNotNull(), F.when(mark.isNull(), "").otherwise(F.call_function("substring_index", c, mark, F.lit(-1))))


def normal_label(c: Column) -> Column:
    """A licence label with each of ``-``, ``.`` and ``+`` as ``_``."""
    return F.regexp_replace(c, "[-.+]", "_")


def label_prefix(c: Column) -> Column:
    """What stands before the first ``-`` of a label."""
    return F.substring_index(c, "-", 1)


def label_of_path(c: Column) -> Column:
    """Parent folder of a path."""
    return F.try_element_at(F.split(c, "/"), F.lit(-2))


def file_name(label: Column, seq: Column) -> Column:
    """``<label>-<seq>.txt``."""
    return F.format_string("%s-%d.txt", label, seq)


def absolute_url(c: Column, base: str) -> Column:
    """A URL whose leading ``./`` stands for a base."""
    return F.regexp_replace(c, r"^\./", base)


def for_scan(c: Column) -> Column:
    """Text as signatures are matched against it: punctuation as blanks, blanks collapsed, lower case."""
    return F.trim(F.lower(F.regexp_replace(c, f"[{PUNCT[1:-1]}{WS[1:-1]}]+", " ")))


def draw(*parts: Column | str | int) -> Column:
    """A number in [0, 1) derived from a key by MD5, the same on every engine and in every run."""
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
