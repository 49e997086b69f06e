"""Problem 4: duplicates hidden by formatting, counted by radix partitioning on canonical bytes."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.runtime import discard, materialize

_NOT_WORD = regex.compile(r"[^\p{L}\p{N}]+")
_LINE = regex.compile(r"^\s*([^:\n]{1,60}?)\s*:(?:\s+(.*))?$")
_PAIR = regex.compile(r"^\s*([^=;\n]{1,60}?)\s*=(.*)$", regex.DOTALL)


def letters(text: str) -> str:
    """The letters and digits of a text, lower-cased."""
    return _NOT_WORD.sub("", text.lower())


def fields(text: str) -> list[tuple[str, str]] | None:
    """The fields of a record of three or more in one of the three notations, else None. Names and values as letters."""
    body = text.strip()
    if body[:1] == "{" and body[-1:] == "}":
        try:
            found = json.loads(body, object_pairs_hook=list)
        except ValueError:
            return None
        if len(found) < 3 or not all(isinstance(p, tuple) and len(p) == 2 for p in found):
            return None
        return [(letters(k), letters(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False))) for k, v in found]
    if body.count("=") >= 3 and body.count(";") >= 2:
        pairs = [_PAIR.match(p) for p in body.split(";") if p.strip()]
        if len(pairs) >= 3 and all(pairs):
            return [(letters(m[1]), letters(m[2])) for m in pairs]
    if body.count(":") >= 3:
        pairs = [_LINE.match(p) for p in body.splitlines() if p.strip()]
        if len(pairs) >= 3 and all(pairs):
            return [(letters(m[1]), letters(m[2] or "")) for m in pairs]
    return None


def canonical(text: str) -> tuple[str, int]:
    """Canonical text and its number of letters and digits: sorted fields of a record, else the letters in order."""
    plain = letters(text)
    record = fields(text)
    if record is None:
        return plain, len(plain)
    return "\x02".join(f"{k}\x01{v}" for k, v in sorted(record)), len(plain)


class Trie:
    """A byte trie with compressed edges; a terminal holds a counter and the smallest id."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, key: bytes, count: int, least: int) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                end = node.get(-1)
                if end is None:
                    node[-1] = [count, least]
                else:
                    end[0] += count
                    end[1] = min(end[1], least)
                return
            edge = node.get(key[at])
            if edge is None:
                node[key[at]] = (key[at:], {-1: [count, least]})
                return
            label, child = edge
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            rest = key[at : at + len(label)]
            low, high = 0, min(len(rest), len(label))  # the common part, by halving
            while low < high:
                mid = (low + high + 1) // 2
                if rest[:mid] == label[:mid]:
                    low = mid
                else:
                    high = mid - 1
            middle = {label[low]: (label[low:], child)}
            node[key[at]] = (label[:low], middle)
            node, at = middle, at + low

    def terminals(self) -> Iterator[tuple[bytes, int, int]]:
        """Every key with its counter and smallest id."""
        stack = [(self.root, b"")]
        while stack:
            node, prefix = stack.pop()
            for byte, entry in node.items():
                if byte == -1:
                    yield prefix, entry[0], entry[1]
                else:
                    stack.append((entry[1], prefix + entry[0]))


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def canonical_rows(df: DataFrame, id_col: str, text_col: str, min_letters: int) -> DataFrame:
    """(``id``, ``canon`` bytes, ``plain`` digest, ``digest``) of the rows that count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, canons, digests, plains = [], [], [], []
            for i, text in zip(pdf["id"].to_numpy(), pdf["text"].array):
                canon, n = canonical(text)
                if n >= min_letters:
                    raw = canon.encode()
                    ids.append(i)
                    canons.append(raw)
                    digests.append(_digest(raw))
                    plains.append(_digest(letters(text).encode()) if b"\x01" in raw else digests[-1])
            yield pd.DataFrame({"id": pd.Series(ids, dtype="int64"), "canon": canons, "digest": digests, "plain": plains})

    wanted = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull() & (F.length("text") >= min_letters) & F.col("id").isNotNull())
    return wanted.mapInPandas(run, "id long, canon binary, digest binary, plain binary")


def _counted(rows: DataFrame) -> DataFrame:
    """Tries over a bucket each: (``canon``, ``digest``, ``copies``, ``least``). Rows arrive sorted by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, trie = None, Trie()

        def out(trie: Trie) -> Iterator[pd.DataFrame]:
            found = list(trie.terminals())
            for k in range(0, len(found), 20_000):
                part = found[k : k + 20_000]
                yield pd.DataFrame({"digest": [_digest(p[0]) for p in part], "copies": [p[1] for p in part], "least": [p[2] for p in part]})

        for pdf in batches:
            for bucket, canon, copies, least in zip(pdf["bucket"].array, pdf["canon"].array, pdf["copies"].to_numpy(), pdf["least"].to_numpy()):
                if bucket != now:
                    yield from out(trie)
                    now, trie = bucket, Trie()
                trie.add(bytes(canon), int(copies), int(least))
        yield from out(trie)

    return rows.mapInPandas(run, "digest binary, copies long, least long")


def _combined(rows: DataFrame) -> DataFrame:
    """One row for each canonical text of a task's batch: a hot text shrinks before anything is shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            trie = Trie()
            for i, canon in zip(pdf["id"].to_numpy(), pdf["canon"].array):
                trie.add(bytes(canon), 1, int(i))
            found = list(trie.terminals())
            yield pd.DataFrame({"canon": [f[0] for f in found], "copies": [f[1] for f in found], "least": [f[2] for f in found]})

    return rows.select("id", "canon").mapInPandas(run, "canon binary, copies long, least long")


def radix_buckets(rows: DataFrame, fit_bytes: int, step: int = 4) -> DataFrame:
    """Add ``bucket``: a prefix of the canonical bytes such that a bucket holds at most ``fit_bytes``.

    All rows start in buckets of ``step`` bytes; the rows of a bucket that is too large go on with twice as many bytes,
    until each fits or holds a single text (whose rows were combined before, a row for each task's batch). The table
    of buckets stays distributed; what goes on is written each round, so no round repeats those before it.
    """
    depth, parts, left = step, [], rows
    while True:
        prefix = F.substring("canon", 1, depth)
        sized = left.select(prefix.alias("bucket"), F.length("canon").alias("n"), F.xxhash64("canon").alias("h"))
        sizes = sized.groupBy("bucket").agg(F.sum("n").alias("bytes"), F.min("h").alias("h0"), F.max("h").alias("h1"), F.max("n").alias("longest"))
        large = materialize(sizes.where((F.col("bytes") > fit_bytes) & (F.col("h0") != F.col("h1")) & (F.col("longest") > depth)).select("bucket"), "large")
        if large.isEmpty():
            parts.append(left.withColumn("bucket", prefix))
            break
        parts.append(left.withColumn("bucket", prefix).join(large, "bucket", "left_anti"))
        left = materialize(left.withColumn("bucket", prefix).join(large, "bucket", "left_semi").drop("bucket"), "oversized")
        depth *= 2
    out = parts[0].select("bucket", *rows.columns)
    for part in parts[1:]:
        out = out.unionByName(part.select("bucket", *rows.columns))
    return out


def formatting_groups(df: DataFrame, id_col: str = "file_id", text_col: str = "content", min_letters: int = 40, fit_bytes: int = 8_000_000) -> tuple[DataFrame, DataFrame]:
    """Groups of records equal but for layout, case, punctuation or order of fields.

    Gives ``members`` (``id``, ``digest``), one row for each record that counts, and ``groups`` (``digest``, ``copies``,
    ``least``), one row for each distinct record with the number of its copies and the smallest id. Records equal by
    letters are equal even if only one of them reads as a field record. Null texts and texts with fewer than
    ``min_letters`` letters and digits don't count; ids may repeat; an empty table gives empty tables. A text that a
    third of all rows share is combined in every task first, so its bucket gets one row for each batch.
    """
    rows = materialize(canonical_rows(df, id_col, text_col, min_letters), "canonical")
    combined = materialize(_combined(rows), "combined")
    buckets = radix_buckets(combined, fit_bytes)
    sorted_buckets = buckets.repartition("bucket").sortWithinPartitions("bucket")
    counted = _counted(sorted_buckets)
    # A plain text with the letters of a field record takes the record's place: few rows, those of records only.
    records = rows.where(F.col("digest") != F.col("plain")).groupBy("plain").agg(F.min("digest").alias("record"))
    members = rows.select("id", "digest", "plain").join(records, "plain", "left").select("id", "digest", F.when(F.col("record").isNotNull() & (F.col("digest") == F.col("plain")), F.col("record")).otherwise(F.col("digest")).alias("group"))
    renamed = records.select(F.col("plain").alias("digest"), "record")
    groups = counted.join(renamed, "digest", "left").groupBy(F.coalesce("record", "digest").alias("digest")).agg(F.sum("copies").alias("copies"), F.min("least").alias("least"))
    return members.select("id", F.col("group").alias("digest")), materialize(groups, "groups")


def copies_report(df: DataFrame, id_col: str = "file_id", text_col: str = "content", min_letters: int = 40) -> DataFrame:
    """One row for each distinct record: ``file_id`` (the smallest) and ``copies``. See formatting_groups."""
    _, groups = formatting_groups(df, id_col, text_col, min_letters)
    return groups.select(F.col("least").alias("file_id"), "copies")


def formatting_pairs(df: DataFrame, id_col: str = "file_id", text_col: str = "content", min_letters: int = 40, hot_share: int = 1000) -> DataFrame:
    """(``file_id_a``, ``file_id_b``): the smallest id of each group with each of the others.

    Groups of more than ``1/hot_share`` of all members are fewer than ``hot_share``, so they are broadcast; all
    others are joined by digest.
    """
    members, groups = formatting_groups(df, id_col, text_col, min_letters)
    several = groups.where("copies > 1")
    whole = groups.agg(F.sum("copies").alias("n")).first()["n"] or 0
    hot = several.where(F.col("copies") > whole / hot_share)
    cold = several.where(F.col("copies") <= whole / hot_share)
    is_pair: Column = F.col("id") != F.col("least")
    by_hot = members.join(F.broadcast(hot), "digest").where(is_pair)
    by_key = members.join(cold, "digest").where(is_pair)
    return by_hot.unionByName(by_key).select(F.col("least").alias("file_id_a"), F.col("id").alias("file_id_b")).distinct()
