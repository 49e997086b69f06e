"""Problem 6: near-duplicate records by the generalised pigeonhole principle over sketches."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import components
from lexmill.llm.vec import Codes, ascii_word_table, chunks, grams, mix
from lexmill.runtime import discard, materialize

#: A sketch has PARTS partitions of WIDTH min-hash values of 16 bits: first the lowest four bits of all, two values to a byte, then the next four, then the high bytes.
PARTS, WIDTH = 24, 3
_SEEDS = mix(np.arange(1, PARTS * WIDTH + 1, dtype=np.uint64)) | np.uint64(1)
_BUCKETS = 1024
#: What a candidate costs beside a signature, in bytes moved: both sketches and four times the pair, against one row.
CANDIDATE_WEIGHT = 10.0
#: A partition's threshold: skipped, no value may differ, one may.
THRESHOLDS = (-1, 0, 1)


def _subsets(threshold: int) -> list[tuple[int, ...]]:
    """Which values of a partition make up its signatures at a threshold."""
    return [] if threshold < 0 else list(itertools.combinations(range(WIDTH), WIDTH - threshold))


def _upper_half(hashes: np.ndarray) -> np.ndarray:
    """The upper 32 bits of sorted hashes, each once."""
    out = (hashes >> np.uint64(32)).astype(np.uint32)
    return out[np.concatenate([[True], out[1:] != out[:-1]])].view(np.int32)


def shingle_rows(df: DataFrame, id_col: str, text_col: str, words: int, min_words: int) -> DataFrame:
    """(``id``, ``digest``, ``n``, ``sketch`` bytes, ``shingles`` as sorted ints) of the rows with enough words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = ascii_word_table()
        for pdf in batches:
            ids, texts = pdf["id"].to_numpy(), list(pdf["text"].array)
            for a, b in chunks(texts):
                hashes, _, _, owner = Codes([t.lower() for t in texts[a:b]]).words(table)
                at = np.searchsorted(owner, np.arange(b - a + 1))
                g = grams(hashes, tuple(range(words)))
                out = []
                for k in range(b - a):
                    n = at[k + 1] - at[k]
                    if n < max(min_words, words):
                        continue
                    out.append((ids[a + k], np.unique(g[at[k] : at[k + 1] - words + 1])))
                if not out:
                    continue
                flat = np.concatenate([s for _, s in out])
                starts = np.cumsum([0] + [len(s) for _, s in out])[:-1]
                values = np.empty((len(out), PARTS * WIDTH), dtype=np.uint16)
                for j, seed in enumerate(_SEEDS):
                    values[:, j] = mix(np.minimum.reduceat(flat * seed, starts)) & np.uint64(0xFFFF)
                half = PARTS * WIDTH // 2
                fours = [(values >> shift) & 15 for shift in (0, 4)]
                sketch = np.concatenate([*(f[:, :half] | f[:, half:] << 4 for f in fours), values >> 8], axis=1).astype(np.uint8)
                yield pd.DataFrame({
                    "id": [i for i, _ in out], "digest": [xxhash.xxh3_128_digest(s.tobytes()) for _, s in out], "n": [len(s) for _, s in out],
                    "sketch": [r.tobytes() for r in sketch], "shingles": [_upper_half(s) for _, s in out],
                })

    wanted = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    return wanted.mapInPandas(run, "id long, digest binary, n int, sketch binary, shingles array<int>")


def _signature(values: np.ndarray, part: int, subset: tuple[int, ...]) -> np.ndarray:
    """A 64-bit signature of some values of a partition, for all rows of a batch."""
    out = np.full(len(values), np.uint64((part * 8 + sum(1 << s for s in subset) + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    for s in subset:
        out = mix(out ^ (values[:, part * WIDTH + s] + np.uint64(0x51ED2701)))
    return out


def _bytes(sketches, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, sketches)), dtype=np.uint8).reshape(-1, width)


def _matrix(sketches, order: list[int]) -> np.ndarray:
    """The min-hash values of some sketches, those of a partition side by side."""
    raw, half = _bytes(sketches, 2 * PARTS * WIDTH), PARTS * WIDTH // 2
    low, mid, high = raw[:, :half], raw[:, half : 2 * half], raw[:, 2 * half :]
    fours = lambda x: np.concatenate([x & 15, x >> 4], axis=1).astype(np.uint64)
    return (fours(low) | fours(mid) << np.uint64(4) | high.astype(np.uint64) << np.uint64(8))[:, order]


def correlated_order(sketches: DataFrame) -> list[int]:
    """The values in an order that puts those whose bits change together into one partition, measured over all rows.

    The bits of one value always go together. Between values, the correlation of their lowest bits is summed over the
    rows (a fixed table of values by values); partitions are then filled greedily: the two most correlated values that are
    left, and the values most correlated with those chosen. Ties go by number.
    """
    values = PARTS * WIDTH

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((values, values), np.int64)
        for pdf in batches:
            if len(pdf):
                bits = 2.0 * (_matrix(pdf["sketch"].array, list(range(values))) & np.uint64(1)).astype(np.float32) - 1.0
                total += (bits.T @ bits).astype(np.int64)
        i, j = np.triu_indices(values, 1)
        yield pd.DataFrame({"i": i, "j": j, "v": total[i, j]})

    summed = sketches.select("sketch").mapInPandas(run, "i int, j int, v long").groupBy("i", "j").agg(F.sum("v").alias("v"))
    together = np.zeros((values, values))
    for r in summed.collect():  # values * (values - 1) / 2 rows
        together[r.i, r.j] = together[r.j, r.i] = abs(r.v)
    left, order = list(range(values)), []
    while left:
        part = list(max(itertools.combinations(left, 2), key=lambda p: (together[p], -p[0], -p[1])))
        while len(part) < WIDTH:
            part.append(max((x for x in left if x not in part), key=lambda x: (together[x, part].sum(), -x)))
        order += part
        left = [x for x in left if x not in part]
    return order


def estimate_candidates(sketches: DataFrame, order: list[int], rows: int, hot_share: int = 200) -> tuple[dict[tuple[int, int], float], set[tuple[int, int, int, int]]]:
    """Pairs that would share a signature, for each partition and threshold, over all rows; and where hot signatures lie.

    The number of pairs is half the second moment of the signatures' counts less the rows; it is estimated with a
    signed counter sketch of fixed size (two counters a row and signature, summed), so nothing grows with the data. A
    counter of over ``1/hot_share`` of the rows tells of a hot signature: (partition, threshold, subset, counter).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int, int], np.ndarray] = {}
        for pdf in batches:
            values = _matrix(pdf["sketch"].array, order)
            for part in range(PARTS):
                for threshold in THRESHOLDS[1:]:
                    for k, subset in enumerate(_subsets(threshold)):
                        s = _signature(values, part, subset)
                        sign = 1.0 - 2.0 * (s >> np.uint64(63)).astype(np.float64)
                        got = np.bincount((s & np.uint64(_BUCKETS - 1)).astype(np.int64), weights=sign, minlength=_BUCKETS)
                        key = (part, threshold, k)
                        total[key] = total.get(key, 0) + got
        for (part, threshold, k), counters in total.items():
            at = np.flatnonzero(counters)
            yield pd.DataFrame({"part": part, "threshold": threshold, "k": k, "bucket": at, "value": counters[at].astype(np.int64)})

    counters = sketches.select("sketch").mapInPandas(run, "part int, threshold int, k int, bucket int, value long")
    summed = counters.groupBy("part", "threshold", "k", "bucket").agg(F.sum("value").alias("v"))
    high = F.when(F.abs("v") > max(rows / hot_share, 256), F.struct("k", "bucket"))
    moments = summed.groupBy("part", "threshold").agg(F.sum(F.col("v").cast("double") * F.col("v")).alias("f2"), F.collect_list(high).alias("hot"))
    # At most PARTS * 2 rows come back, each with at most the fixed number of counters.
    found = moments.collect()
    pairs = {(r.part, r.threshold): max(0.0, (r.f2 - rows * len(_subsets(r.threshold))) / 2) for r in found}
    return pairs, {(r.part, r.threshold, x.k, x.bucket) for r in found for x in r.hot}


def allocate(candidates: dict[tuple[int, int], float], rows: int, similarity: float, recall: float) -> list[int]:
    """A threshold for each partition, by dynamic programming: least cost at the recall wanted for pairs just at ``similarity``.

    A pair of that similarity agrees in a value with probability ``similarity``, so a partition finds it with a known
    probability at each threshold; the logarithms of the chances to miss it add up. The cost of a choice is its
    estimated candidates and the signatures that it has to shuffle.
    """
    unit = 0.005

    def gain(threshold: int) -> int:
        agree = WIDTH - threshold
        p = 0.0 if threshold < 0 else sum(math.comb(WIDTH, k) * similarity**k * (1 - similarity) ** (WIDTH - k) for k in range(agree, WIDTH + 1))
        return int(-math.log(max(1e-12, 1 - p)) / unit)

    goal = math.ceil(-math.log(1 - recall) / unit)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in range(PARTS):
        after: dict[int, tuple[float, list[int]]] = {}
        for reached, (cost, chosen) in best.items():
            for threshold in THRESHOLDS:
                to = min(goal, reached + gain(threshold))
                worth = cost + CANDIDATE_WEIGHT * candidates.get((part, threshold), 0.0) + rows * len(_subsets(threshold))
                if to not in after or worth < after[to][0]:
                    after[to] = (worth, [*chosen, threshold])
        best = after
    if goal not in best:
        raise ValueError(f"{PARTS} partitions of {WIDTH} values can't reach a recall of {recall} at a similarity of {similarity}")
    return best[goal][1]


def candidate_pairs(sketches: DataFrame, thresholds: list[int], order: list[int] | None = None, hot: set[tuple[int, int, int, int]] | None = None, group_limit: int = 256) -> tuple[DataFrame, DataFrame]:
    """The written table of pairs as found, and (``a``, ``b``), ``a < b``: the pairs that share a signature, each once.

    Signatures are grouped by one shuffle; a group of up to ``group_limit`` rows gives its pairs where it lies; the
    rows of larger groups are joined in salted blocks, so that no task holds such a group. Signatures whose counter is
    ``hot`` go there at once and never meet in a task of that shuffle.
    """
    order = order or list(range(PARTS * WIDTH))
    chosen = [(part, subset) for part, t in enumerate(thresholds) for subset in _subsets(t)]
    counters = [[b for p, t, k, b in hot or () if p == part and t == thresholds[part] and k == _subsets(t).index(subset)] for part, subset in chosen]

    def signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values, ids = _matrix(pdf["sketch"].array, order), pdf["id"].to_numpy()
            sig = [_signature(values, part, subset) for part, subset in chosen]
            high = [np.isin((s & np.uint64(_BUCKETS - 1)).astype(np.int64), c) if c else np.zeros(len(s), bool) for s, c in zip(sig, counters)]
            flat = np.concatenate(sig).view(np.int64) if chosen else np.zeros(0, np.int64)
            yield pd.DataFrame({"sig": flat, "id": np.tile(ids, len(chosen)), "hot": np.concatenate(high) if chosen else np.zeros(0, bool)})

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def emit(sig: np.ndarray, ids: np.ndarray) -> Iterator[pd.DataFrame]:
            """Pairs of whole groups; sig is sorted."""
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.concatenate([first, [len(sig)]]))
            for n in np.unique(size[(size > 1) & (size <= group_limit)]):
                rows = ids[first[size == n][:, None] + np.arange(n)]
                i, j = np.triu_indices(n, 1)
                a, b = rows[:, i].ravel(), rows[:, j].ravel()
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield pd.DataFrame({"sig": np.zeros(len(both), np.int64), "a": both[:, 0], "b": both[:, 1]})
            for f, n in zip(first[size > group_limit], size[size > group_limit]):
                yield pd.DataFrame({"sig": sig[f : f + n], "a": ids[f : f + n], "b": -1})

        held_sig, held_ids, large = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for pdf in batches:
            sig, ids = np.concatenate([held_sig, pdf["sig"].to_numpy()]), np.concatenate([held_ids, pdf["id"].to_numpy()])
            if not len(sig):
                continue
            if large is not None:  # the group that was too large goes on
                upto = int(np.searchsorted(sig, large, side="right"))
                yield pd.DataFrame({"sig": sig[:upto], "a": ids[:upto], "b": -1})
                sig, ids = sig[upto:], ids[upto:]
                if not len(sig):
                    held_sig, held_ids = sig, ids
                    continue
                large = None
            tail = int(np.searchsorted(sig, sig[-1], side="left"))
            yield from emit(sig[:tail], ids[:tail]) if tail else ()
            held_sig, held_ids = sig[tail:], ids[tail:]
            if len(held_sig) > group_limit:
                large = held_sig[0]
                yield pd.DataFrame({"sig": held_sig, "a": held_ids, "b": -1})
                held_sig, held_ids = held_sig[:0], held_ids[:0]
        if len(held_sig):
            yield from emit(held_sig, held_ids)

    signed = sketches.select("id", "sketch").mapInPandas(signatures, "sig long, id long, hot boolean")
    grouped = (signed.where("NOT hot") if hot else signed).select("sig", "id").repartition("sig").sortWithinPartitions("sig")
    met = grouped.mapInPandas(pairs, "sig long, a long, b long")
    found = materialize(met.unionByName(signed.where("hot").select("sig", F.col("id").alias("a"), F.lit(-1).cast("long").alias("b"))) if hot else met, "pairs")
    small = found.where("b <> -1").select("a", "b")
    blocks = 16
    heavy = found.where("b = -1").select("sig", F.col("a").alias("id"))
    left = heavy.select("sig", F.col("id").alias("a"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
    right = heavy.select("sig", F.col("id").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    large = left.join(right, ["sig", "block"]).where("a < b").select("a", "b")
    return found, small.unionByName(large).distinct()


class NearDuplicates:
    """Links between the classes of equal records, and the classes' members.

    Records are compared by the sets of ``words`` consecutive words of their texts; ``similarity`` is the least Jaccard
    similarity. Records with the same set form a class, named by its smallest id. Each class has a sketch of 72
    min-hash values. The bits of one value change together, so they are grouped; a partition is three values whose bits
    are most correlated over all rows, and the distance counts values. Each partition gets its own threshold (skipped,
    none or one value may differ) by dynamic programming over the candidates that all rows are estimated to give, such
    that a pair just at the similarity is found with probability ``recall``, and more similar ones with more. Candidates
    are pruned by the distance of the sketches where it rules them out by over four deviations, then verified by the
    Jaccard similarity of their whole sets; a shingle stands there as the upper 32 bits of its 64-bit hash, so a pair of
    sets of n shingles is misjudged with a chance of about n * n / 2**32 times that of lying within a shingle of the threshold.

    ``thresholds`` sets the partitions' thresholds from outside. Null texts and texts with fewer than ``min_words`` words have no class; ids are taken as unique (a repeated id
    counts once); an empty table gives empty tables.
    """

    def __init__(self, df: DataFrame, id_col: str = "file_id", text_col: str = "content", words: int = 5, similarity: float = 0.8, min_words: int = 20, recall: float = 0.999, thresholds: list[int] | None = None) -> None:
        self.rows = materialize(shingle_rows(df, id_col, text_col, words, min_words), "shingles")
        classes = self.rows.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
        several = materialize(classes.where("copies > 1").select("digest", "rep"), "classes")
        # Most classes have one member: only the others' members are joined.
        self.copies = materialize(self.rows.select("id", "digest").join(several, "digest").select("id", "rep").distinct(), "copies")
        spare = self.copies.where("id <> rep").select("id")
        distinct = materialize(self.rows.select("id", "sketch").join(spare, "id", "left_anti"), "sketches")
        n = distinct.count()
        self.order = correlated_order(distinct)
        counts, hot = estimate_candidates(distinct, self.order, n)
        self.thresholds = thresholds or allocate(counts, n, similarity, recall)
        raw, pairs = candidate_pairs(distinct, self.thresholds, self.order, hot)
        found = materialize(pairs, "candidates")
        discard(raw)
        discard(distinct)
        discard(several)
        self.links = self._verified(found, similarity)

    def _verified(self, found: DataFrame, similarity: float) -> DataFrame:
        # Four bits of a value also agree by chance, once in 16 times.
        values, agree = PARTS * WIDTH, similarity + (1 - similarity) / 16
        least = values * agree - 4.5 * math.sqrt(values * agree * (1 - agree))

        def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                differ = _bytes(pdf["sa"].array, values // 2) ^ _bytes(pdf["sb"].array, values // 2)
                same = ((differ & 15) == 0).sum(axis=1) + ((differ >> 4) == 0).sum(axis=1)
                yield pdf.loc[same >= least, ["a", "b"]]

        side = lambda name, cols: self.rows.select(F.col("id").alias(name), *cols)
        brief = F.substring("sketch", 1, values // 2)  # the lowest bits are enough to rule a pair out
        sketched = found.join(side("a", [brief.alias("sa")]), "a").join(side("b", [brief.alias("sb")]), "b")
        kept = materialize(sketched.mapInPandas(near, "a long, b long"), "kept")
        discard(found)
        ends = kept.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = materialize(self.rows.select("id", "shingles").join(ends, "id"), "sets")
        pick = lambda name, as_: sets.select(F.col("id").alias(name), F.col("shingles").alias(as_))
        both = kept.join(pick("a", "xa"), "a").join(pick("b", "xb"), "b")
        common = F.size(F.array_intersect("xa", "xb"))
        joined = both.select("a", "b", (common / (F.size("xa") + F.size("xb") - common)).alias("jaccard"))
        links = materialize(joined.where(F.col("jaccard") >= similarity - 1e-12).dropDuplicates(["a", "b"]), "links")
        discard(kept)
        discard(sets)
        return links

    def members(self) -> DataFrame:
        """(``id``, ``rep``) for each record that has a class."""
        return self.rows.select("id").distinct().join(self.copies, "id", "left").select("id", F.coalesce("rep", "id").alias("rep"))

    def groups(self) -> DataFrame:
        """One row a record: ``file_id``, ``class_id`` (equal sets), ``group_id`` (linked classes), ``copies``, ``links`` of its class."""
        parts = components(self.links, "a", "b").select(F.col("vertex").alias("rep"), F.col("component").alias("_g"))
        named = parts.join(parts.groupBy("_g").agg(F.min("rep").alias("group_id")), "_g").select("rep", "group_id")
        degree = self.links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
        sizes = self.copies.groupBy("rep").agg(F.count("*").alias("copies"))
        about = self.members().join(named, "rep", "left").join(degree, "rep", "left").join(sizes, "rep", "left")
        return about.select(F.col("id").alias("file_id"), F.col("rep").alias("class_id"), F.coalesce("group_id", "rep").alias("group_id"), F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("links", F.lit(0)).alias("links"))

    def pairs(self) -> DataFrame:
        """(``file_id_a``, ``file_id_b``): all pairs of records, those of equal sets included; the links with their classes written out."""
        several = self.copies
        full = lambda end: F.coalesce(F.col(f"id_{end}"), F.col(end))
        a = several.select(F.col("rep").alias("a"), F.col("id").alias("id_a"))
        b = several.select(F.col("rep").alias("b"), F.col("id").alias("id_b"))
        across = self.links.select("a", "b").join(a, "a", "left").join(b, "b", "left").select(full("a").alias("x"), full("b").alias("y"))
        # A class of many copies is joined in blocks of one side.
        blocks = 16
        left = a.withColumn("_k", F.pmod(F.xxhash64("id_a"), F.lit(blocks)))
        right = b.select(F.col("b").alias("a"), "id_b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_k"))
        within = left.hint("merge").join(right, ["a", "_k"]).where("id_a < id_b").select(F.col("id_a").alias("x"), F.col("id_b").alias("y"))
        return across.unionByName(within).select(F.least("x", "y").alias("file_id_a"), F.greatest("x", "y").alias("file_id_b"))


def with_ngram_files(files: DataFrame, generated: DataFrame) -> DataFrame:
    """Fragments and generated files together: (``file_id``, ``content``)."""
    return files.select("file_id", "content").unionByName(generated.select("file_id", "content"))
