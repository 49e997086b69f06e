"""Seeded phrases of each text from its own models: one seed per character, drawn lengths, all orders."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T

#: The features of these operators: orders, least and most tokens of a phrase, most words of a chain's phrase.
ORDERS = tuple(range(2, 8))
LENGTHS = (6, 30)
WORDS = 32
_CHUNK = 20_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def prepared(df: DataFrame, keep: list[str], text: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """What the walks need of each text: ``also``, ``keep`` and ``_t``; draws are keyed by ``keep`` and the text. A text of fewer than two characters has no seed and gives no row.

    Tokens and words come from the same expressions as the models; sentences and words are joined by a blank, which
    neither holds.
    """
    t = F.col(text)
    rows = df.where(F.length(t) > 1).select(*also, *keep, t.alias("_x"), F.filter(F.transform(T.train_sentences(t), lambda s: F.array_join(T.tokenize(s), " ")), lambda s: s != "").alias("_s"))
    rows = rows.select("*", F.array_distinct(F.split(F.array_join("_s", " "), " ", -1)).alias("_v"))
    clean = F.transform("_v", lambda v: F.lower(T.clean_text(v)))
    x = F.col("_x")
    parts = [
        F.md5(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keep), x)).alias("key"), (F.length(x) - 1).alias("seeds"), F.col("_s").alias("sents"), F.col("_v").alias("vocab"),
        F.transform("_v", lambda v: T.drop_digit_words(v) != "").alias("kept"), clean.alias("clean"), F.array_join(T.chain_words(T.drop_digit_words(x)), " ").alias("w1"), F.array_join(T.chain_words(x), " ").alias("w2"),
    ]
    return rows.select(*also, *keep, F.struct(*parts).alias("_t"))


def _draws(base: np.uint64, seeds: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) by seed and step: splitmix64 from a base that is hashed from the key."""
    with np.errstate(over="ignore"):
        return _mixed(base + (seeds.astype(np.uint64) * np.uint64(64) + np.uint64(step)) * _GOLDEN)


def _mixed(z: np.ndarray) -> np.ndarray:
    """Splitmix64's mixing of its states, in place; numbers in [0, 1)."""
    with np.errstate(over="ignore"):
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        z >>= np.uint64(11)
    return z.astype(np.float64) * 2.0**-53


def _base(*key) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.md5("|".join(map(str, key)).encode()).digest()[:8], "big"))


def _table(successors: list[list[int]], after: Callable[[int, int], int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each state: where its successors begin and how many; the successors, as often as they occur, and their states."""
    sizes = np.array([len(s) for s in successors], np.int64)
    flat = [(t, after(k, t)) for k, s in enumerate(successors) for t in s]
    both = np.array(flat, np.int64).reshape(-1, 2)
    return np.cumsum(sizes) - sizes, sizes, both[:, 0], both[:, 1]


def _ngram_table(sents: list[list[int]], n: int, stop: int):
    fresh = (-1,) * (n - 1)
    found: dict[tuple, list[int]] = {fresh: []}
    for s in sents:
        context = fresh
        for t in s:
            found.setdefault(context, []).append(t)
            context = (*context[1:], t)
    number = {c: k for k, c in enumerate(found)}
    contexts = list(found)
    # Every sentence ends with a full stop, so each other context that is reached has a successor.
    return _table([sorted(s) for s in found.values()], lambda k, t: 0 if t == stop else number[(*contexts[k][1:], t)])


def ngram_phrases(t: dict, n: int, lengths: tuple[int, int] = LENGTHS) -> Iterator[tuple[np.ndarray, list[list[int]], list[bytes]]]:
    """Chunks of seeds, and the token numbers of their phrases, with the vocabulary in the order of its bytes."""
    vocab = sorted(t["vocab"], key=str.encode)
    ids = {v: k for k, v in enumerate(vocab)}
    begin, size, token, after = _ngram_table([[ids[x] for x in s.split(" ")] for s in t["sents"]], n, ids["."])
    base = _base(t["key"], n, lengths[0])
    for first in range(1, t["seeds"] + 1, _CHUNK):
        seeds = np.arange(first, min(first + _CHUNK, t["seeds"] + 1))
        many = lengths[0] + np.floor(_draws(base, seeds, 63) * (lengths[1] - lengths[0] + 1)).astype(np.int64)
        state, out = np.zeros(len(seeds), np.int64), np.empty((len(seeds), lengths[1]), np.int64)
        for step in range(lengths[1]):
            at = begin[state] + np.floor(_draws(base, seeds, step) * size[state]).astype(np.int64)
            out[:, step], state = token[at], after[at]
        yield seeds, [row[:m] for row, m in zip(out.tolist(), many.tolist())], vocab


def chain_phrases(t: dict, words: int = WORDS) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Chunks of seeds, and their phrases: a first word and up to ``words`` - 2 steps; a dead end adds nothing."""
    w1, w2 = t["w1"].split(" "), t["w2"].split(" ")
    vocab = list(dict.fromkeys(w1 + w2))
    ids = {v: k for k, v in enumerate(vocab)}
    successors: list[list[int]] = [[] for _ in vocab]
    for a, b in zip(w1, w2[1:]):
        successors[ids[a]].append(ids[b])
    begin, size, token, _ = _table(successors, lambda k, x: x)
    heads, base = np.array([ids[w] for w in w1], np.int64), _base(t["key"], "chain")
    for first in range(1, t["seeds"] + 1, _CHUNK):
        seeds = np.arange(first, min(first + _CHUNK, t["seeds"] + 1))
        steps = np.floor(_draws(base, seeds, 63) * words).astype(np.int64) - 1  # 1..words, less two
        state = heads[np.floor(_draws(base, seeds, 62) * len(heads)).astype(np.int64)]
        out, many = np.zeros((len(seeds), max(words - 1, 1)), np.int64), np.ones(len(seeds), np.int64)
        out[:, 0] = state
        for step in range(words - 2):
            live = np.flatnonzero((steps > step) & (size[state] > 0))
            at = begin[state[live]] + np.floor(_draws(base, seeds[live], step) * size[state[live]]).astype(np.int64)
            state[live] = out[live, step + 1] = token[at]
            many[live] += 1
        yield seeds, [" ".join([vocab[k] for k in row[:m]]) for row, m in zip(out.tolist(), many.tolist())]


def _cleaned(row: list[int], kept: list[bool], clean: list[str]) -> str:
    """clean_text of a phrase, from its tokens: it strips blanks once words with digits are gone, but before punctuation goes."""
    i, j = 0, len(row)
    while i < j and not kept[row[i]]:
        i += 1
    while i < j and not kept[row[j - 1]]:
        j -= 1
    parts = [clean[k] for k in row[i:j]]
    words = " ".join([p for p in parts if p])
    if not words:
        return " " if j - i > 1 else ""
    return " " * (not parts[0]) + words + " " * (not parts[-1])


def pool_of(texts: list[dict], lengths: tuple[int, int] = LENGTHS, orders: tuple[int, ...] = ORDERS) -> list[str]:
    """Distinct cleaned phrases of some texts in the order of their code points."""
    out: set[str] = set()
    for t in texts:
        by = {v: (k, c) for v, k, c in zip(t["vocab"], t["kept"], t["clean"])}
        for n in orders:
            for _, rows, vocab in ngram_phrases(t, n, lengths):
                kept, clean = [by[v][0] for v in vocab], [by[v][1] for v in vocab]
                out.update(_cleaned(r, kept, clean) for r in rows)
    return sorted(out - {""})


def _tables(sents: list[list[int]], orders: tuple[int, ...], stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """_ngram_table of all orders in one table, and each order's first state."""
    flat = np.array([x for s in sents for x in s], np.int64)
    lengths = np.array([len(s) for s in sents], np.int64)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ends = np.append(place[1:] == 0, True) | (flat == stop)
    context, made, states, rows = np.zeros(len(flat), np.int64), [], 0, 0
    first: list[int] = []
    for n in range(2, max(orders) + 1):
        before = np.where(place >= n - 1, np.roll(flat, n - 1), -1) + 1
        context = np.unique(context * (flat.max() + 2) + before, return_inverse=True)[1]
        if n in orders:
            order, size = np.lexsort((flat, context)), np.bincount(context)
            after = np.where(ends, context[0], np.roll(context, -1))[order]
            made.append((np.cumsum(size) - size + rows, size, flat[order], after + states))
            first.append(int(context[0]) + states)
            states, rows = states + len(size), rows + len(flat)
    return *(np.concatenate(x) for x in zip(*made)), first


def _walked(t: dict, ids: dict[str, int], code: np.ndarray, lengths: tuple[int, int], orders: tuple[int, ...]) -> Iterator[np.ndarray]:
    """The cleaned phrases of a text for all orders at once, by the draws of ngram_phrases and as _cleaned has them.

    ``code`` of a token: 0 if _cleaned drops it at an end, 1 if nothing is left of it, else its word's rank. A row: ranks of the
    words, a 1 for a blank at an end, then 0.
    """
    if ("tables", orders) not in t:  # they are the same for all lengths
        t["tables", orders] = _tables([[ids[x] for x in s.split(" ")] for s in t["sents"]], orders, ids["."])
    begin, size, token, after, starts = t["tables", orders]
    size, code = size.astype(np.float64), code[token]
    bases = np.array([_base(t["key"], n, lengths[0]) for n in orders], np.uint64)
    width = lengths[1] + 1
    for k in range(1, t["seeds"] + 1, _CHUNK):
        own = np.arange(k, min(k + _CHUNK, t["seeds"] + 1))
        seeds, base, state = np.tile(own, len(orders)), np.repeat(bases, len(own)), np.repeat(np.array(starts, np.int64), len(own))
        many = lengths[0] + np.floor(_draws(base, seeds, 63) * (lengths[1] - lengths[0] + 1)).astype(np.int64)
        order = np.argsort(-many, kind="stable")  # walks that have ended are the last ones
        seeds, base, state, many = seeds[order], base[order], state[order], many[order]
        live = np.searchsorted(-many, -np.arange(lengths[1]), side="left")
        rows = np.zeros((len(seeds), width), code.dtype)
        flat, at_row = rows.reshape(-1), np.arange(len(seeds)) * width
        first, end, last = at_row, at_row.copy(), np.zeros(len(seeds), code.dtype)
        begun, kept = np.zeros(len(seeds), bool), np.zeros(len(seeds), np.int64)
        with np.errstate(over="ignore"):
            base = base + seeds.astype(np.uint64) * np.uint64(64) * _GOLDEN  # _draws but for the step
        for step in range(lengths[1]):
            n = live[step]
            at = begin.take(state[:n])
            at += (_mixed(base[:n] + np.uint64(step * int(_GOLDEN) % 2**64)) * size.take(state[:n])).astype(np.int64)
            state[:n], own_code = after.take(at), code.take(at)
            flat[end[:n]] = own_code
            stays = own_code > 0
            np.copyto(last[:n], own_code, where=stays)
            kept[:n] += stays
            end[:n] += own_code > begun[:n]  # the first token that stays may be a blank; later on only words count
            begun[:n] |= stays
        none = (end == first) | ((end == first + 1) & (rows[:, 0] == 1))
        flat[end] = (last == 1) & ~none
        rows[none, :2] = (kept[none] > 1)[:, None]
        yield rows


class Pool:
    """pool_of as numbers: how many phrases it has, and the phrase of a place in its order. A phrase's tokens stand as their ranks, so that no string is made or sorted."""

    def __init__(self, texts: list[dict], lengths: tuple[int, int] = LENGTHS, orders: tuple[int, ...] = ORDERS) -> None:
        words = sorted({c for t in texts for c in t["clean"]} | {""})
        self.words, self.plain = words, None
        if any(" " >= ch for w in words for ch in w):  # a word that sorts before the blank
            self.plain = pool_of(texts, lengths, orders)
            return
        rank = {w: k + 1 for k, w in enumerate(words)}  # 0 ends a phrase, 1 is a word that is cleaned away
        kind, seen = (("u2", ">u2") if len(words) < 65_000 else ("u4", ">u4")), []
        for t in texts:
            by = sorted(zip(t["vocab"], t["kept"], t["clean"]), key=lambda x: x[0].encode())  # successors are drawn in this order
            ids = {v: k for k, (v, _, _) in enumerate(by)}
            code = np.array([rank[c] if k else 0 for _, k, c in by], kind[0])
            seen += [self._unique(rows.astype(kind[1])) for rows in _walked(t, ids, code, lengths, orders)]
        self.rows = (seen[0] if len(seen) == 1 else self._unique(np.concatenate(seen).astype(kind[1]))) if seen else np.zeros((0, 1), kind[1])
        if len(self.rows) and not self.rows[0].any():
            self.rows = self.rows[1:]

    @staticmethod
    def _unique(rows: np.ndarray) -> np.ndarray:
        """Distinct rows in the order of their bytes, the high one first."""
        whole = np.sort(np.ascontiguousarray(rows).view(f"S{rows.itemsize * rows.shape[1]}").ravel())
        return whole[np.concatenate([np.ones(min(len(whole), 1), bool), whole[1:] != whole[:-1]])].view(rows.dtype).reshape(-1, rows.shape[1])

    def __len__(self) -> int:
        return len(self.rows) if self.plain is None else len(self.plain)

    def __getitem__(self, k: int) -> str:
        if self.plain is not None:
            return self.plain[k]
        return " ".join([self.words[x - 1] for x in self.rows[k].tolist() if x])


def mapped(df: DataFrame, make: Callable[[dict], Iterator[dict[str, list]]], keep: list[str], schema: str) -> DataFrame:
    """Rows that ``make`` gives, as columns, for each row of ``df``, behind that row's columns ``keep``."""
    kinds = ", ".join([f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep] + [schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [pa.field(k, batch.schema.field(k).type) for k in keep]
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                for made in make(row):
                    size = len(next(iter(made.values())))
                    fixed = [pa.array([row[f.name]] * size, f.type) for f in own]
                    rest = [x if isinstance(x, pa.Array) else pa.array(x) for x in made.values()]
                    yield pa.RecordBatch.from_arrays(fixed + rest, names=[*keep, *made])

    return df.mapInArrow(run, kinds)


def walk_ngrams(df: DataFrame, keep: list[str], text: str = "text", orders: tuple[int, ...] = ORDERS, lengths: tuple[int, int] = LENGTHS) -> DataFrame:
    """A phrase for each text, order and seed 1..characters - 1: ``keep``, ``n``, ``seed``, ``phrase``."""

    def make(row: dict) -> Iterator[dict[str, list]]:
        for n in orders:
            for seeds, rows, vocab in ngram_phrases(row["_t"], n, lengths):
                yield {"n": pa.array([n] * len(seeds), pa.int32()), "seed": pa.array(seeds, pa.int32()), "phrase": [" ".join([vocab[k] for k in r]) for r in rows]}

    return mapped(prepared(df, keep, text), make, keep, "n int, seed int, phrase string")


def walk_chain(df: DataFrame, keep: list[str], text: str = "text", words: int = WORDS) -> DataFrame:
    """A phrase of each text's chain for each seed 1..characters - 1: ``keep``, ``seed``, ``phrase``."""

    def make(row: dict) -> Iterator[dict[str, list]]:
        for seeds, phrases in chain_phrases(row["_t"], words):
            yield {"seed": pa.array(seeds, pa.int32()), "phrase": phrases}

    return mapped(prepared(df, keep, text), make, keep, "seed int, phrase string")


def phrase_pool(df: DataFrame, keep: list[str], text: str = "text", orders: tuple[int, ...] = ORDERS, lengths: tuple[int, int] = LENGTHS) -> DataFrame:
    """Distinct cleaned phrases in lower case of each ``keep``: the texts are gathered, so that no phrase is shuffled."""
    texts = prepared(df, keep, text).groupBy(*keep).agg(F.collect_list("_t").alias("_t"))

    def make(row: dict) -> Iterator[dict[str, list]]:
        found = pool_of(row["_t"], lengths, orders)
        for k in range(0, len(found), _CHUNK):
            yield {"phrase": found[k : k + _CHUNK]}

    return mapped(texts, make, keep, "phrase string")
