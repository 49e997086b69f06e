"""Problem 7: evaluation texts in training text, by spaced-seed hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.vec import Codes, alnum_table, chunks, grams
from lexmill.runtime import materialize

#: Word positions that count, two masks of eight in a span of at most 13: a run of 15 words holds each whole three times.
MASKS = ((0, 1, 3, 4, 6, 9, 11, 12), (0, 2, 3, 5, 7, 8, 9, 12))
SCHEMA = "doc_id long, item_id long, exact_words int, tolerant_words int, substitutions int, item_share double"


def _runs(same: np.ndarray, gap: int) -> tuple[int, int, int]:
    """The longest run of equal words; the longest stretch whose mismatches are single words ``gap`` apart, and its mismatches."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    first, last = edge[0::2], edge[1::2]
    if not len(first):
        return 0, 0, 0
    size = last - first
    best, best_off, start, off = 0, 0, 0, 0
    for k in range(len(first)):
        if k and first[k] - last[k - 1] == 1 and size[k - 1] >= gap and size[k] >= gap:
            off += 1
        else:
            start, off = k, 0
        if last[k] - first[start] > best:
            best, best_off = int(last[k] - first[start]), off
    return int(size.max()), best, best_off


class _Items:
    """The hashes of a block of items, sorted, and their words."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        texts = [t.lower() for _, t in items]
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        hashes, _, _, owner = Codes(texts).words(alnum_table())
        at = np.searchsorted(owner, np.arange(len(items) + 1))
        self.words = [hashes[at[k] : at[k + 1]] for k in range(len(items))]
        keys, who, where = [], [], []
        for m, mask in enumerate(MASKS):
            for k, words in enumerate(self.words):
                g = grams(words, mask) ^ np.uint64(m)
                keys.append(g)
                who.append(np.full(len(g), k))
                where.append(np.arange(len(g)))
        key = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        order = np.argsort(key, kind="stable")
        self.key, self.who, self.where = key[order], np.concatenate(who)[order] if keys else key, np.concatenate(where)[order] if keys else key
        self.filter = np.zeros(1 << 22, dtype=bool)
        self.filter[(self.key >> np.uint64(42)).astype(np.int64)] = True


def _search(items: _Items, ids: np.ndarray, texts: list[str], min_words: int, gap: int) -> list[tuple]:
    out = []
    table = alnum_table()
    for a, b in chunks(texts):
        words, _, _, owner = Codes([t.lower() for t in texts[a:b]]).words(table)
        found = []
        for m, mask in enumerate(MASKS):
            g = grams(words, mask) ^ np.uint64(m)
            pos = np.flatnonzero(items.filter[(g >> np.uint64(42)).astype(np.int64)])
            pos = pos[owner[pos] == owner[pos + mask[-1]]]
            left, right = np.searchsorted(items.key, g[pos], "left"), np.searchsorted(items.key, g[pos], "right")
            n = right - left
            pos, left, n = pos[n > 0], left[n > 0], n[n > 0]
            slot = np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            p = np.repeat(pos, n)
            found.append(np.stack([owner[p], items.who[slot].astype(np.int64), p - items.where[slot].astype(np.int64)], axis=1))
        lines = np.unique(np.concatenate(found), axis=0) if found else []
        first = np.searchsorted(owner, np.arange(b - a + 1))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, shift in lines:  # a diagonal each: all words of the item against the document's at this shift
            iw = items.words[item]
            lo, hi = max(first[doc], shift), min(first[doc + 1], shift + len(iw))
            got = _runs(words[lo:hi] == iw[lo - shift : hi - shift], gap)
            key = (int(doc), int(item))
            old = best.get(key, (0, 0, 0))
            best[key] = (max(old[0], got[0]), *max(old[1:], got[1:], key=lambda x: x[0]))
        for (doc, item), (exact, tolerant, off) in best.items():
            if max(exact, tolerant - off) >= min_words:
                out.append((int(ids[a + doc]), int(items.ids[item]), exact, tolerant, off, tolerant / len(items.words[item])))
    return out


def leaks(docs: DataFrame, items: DataFrame, min_words: int = 15, gap: int = 4, block_chars: int = 8_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``item_id``, ``exact_words``, ``tolerant_words``, ``substitutions``, ``item_share``) of every leak.

    ``exact_words`` is the longest run of words that document and item share; ``tolerant_words`` the longest stretch
    in which single words may differ between runs of at least ``gap`` equal ones. A pair is a leak from ``min_words``
    equal words on in either. Every word position of every document is hashed under each mask and joined with the
    items' hashes; hits are verified word by word along the whole diagonal, a word standing as a 64-bit hash. The documents
    aren't shuffled: the items are sent to the tasks in blocks of at most about ``block_chars`` characters, one after the
    other; a block's result is written and the block is let go before the next one is fetched. Null
    and short texts leak nothing; items with one passage are all reported; repeated documents give a row each
    ``doc_id`` (the best). Empty tables give an empty table.
    """
    if min_words < max(m[-1] for m in MASKS) + 1:
        raise ValueError("min_words must cover a mask")
    spark = docs.sparkSession
    usable = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    size = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_chars))
    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    out = None
    for k in range(blocks):
        rows = [(r.item_id, r.text) for r in usable.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()]  # about block_chars
        if not rows:
            continue
        sent = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            block = _Items(sent.value)
            for pdf in batches:
                found = _search(block, pdf["doc_id"].to_numpy(), list(pdf["text"].array), min_words, gap)
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "exact_words", "tolerant_words", "substitutions", "item_share"]).astype({"doc_id": "int64", "item_id": "int64", "exact_words": "int32", "tolerant_words": "int32", "substitutions": "int32", "item_share": "float64"})

        part = wanted.mapInPandas(run, SCHEMA)
        if blocks > 1:
            part = materialize(part, "hits")
            sent.destroy()
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], SCHEMA)
    best = F.max(F.struct("exact_words", "tolerant_words", "substitutions", "item_share"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
