"""Problem 5: long exact spans shared between records, by min-hash banding of sliding paragraphs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm import neardup
from lexmill.llm.components import components
from lexmill.llm.vec import Codes, chunks
from lexmill.runtime import discard, materialize

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each ``width`` neighbours, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(codes: Codes, span: int, shingle: int) -> np.ndarray:
    """Places whose shingle is the min-hash of a window of ``span`` code points within one text.

    Two equal windows have the same min-hash at the same place, wherever they stand.
    """
    n, width = len(codes.codes), span - shingle + 1
    if n < span:
        return np.zeros(0, dtype=np.int64)
    starts = np.arange(n - shingle + 1)
    grams = codes.spans(starts, starts + shingle)
    least = _sliding(grams, width, np.minimum)  # one for each window start
    end = np.repeat(codes.bounds[1:], np.diff(codes.bounds))[: len(least)]
    least = np.where(np.arange(len(least)) + span <= end, least, np.uint64(0))  # windows across two texts don't count
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero(grams == _sliding(padded, width, np.maximum)[: len(grams)])


def anchor_rows(distinct: DataFrame, span: int, shingle: int) -> DataFrame:
    """(``fp``, ``rep``, ``at``): the different anchors of each text and their places; no text is sent."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, texts = pdf["rep"].to_numpy(), list(pdf["text"].array)
            for a, b in chunks(texts):
                codes = Codes(texts[a:b])
                places = anchors(codes, span, shingle)
                if not len(places):
                    continue
                owner = np.searchsorted(codes.bounds, places, side="right") - 1
                fp = codes.spans(places, places + shingle).view(np.int64)
                order = np.lexsort((places, fp, owner))
                fp, owner, places = fp[order], owner[order], (places - codes.bounds[owner])[order].astype(np.int32)
                first = np.flatnonzero(np.concatenate([[True], (fp[1:] != fp[:-1]) | (owner[1:] != owner[:-1])]))
                yield pd.DataFrame({"fp": fp[first], "rep": ids[a + owner[first]], "at": np.split(places, first[1:])})

    return distinct.select("rep", "text").mapInPandas(run, "fp long, rep long, at array<int>")


CONTEXT = "fp long, heavy boolean, rep long, at array<int>, left int, ctx string"


def context_rows(asked: DataFrame, span: int, shingle: int) -> DataFrame:
    """The text of all windows around each anchor asked for. ``asked``: ``rep``, ``text``, ``own`` (anchors of it: ``fp``, ``heavy``, ``at``).

    ``at`` becomes the places where the context begins. A context that a text repeats (a ruled line, say) is sent once,
    with all its places.
    """
    reach = span - shingle

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple] = []
            for rep, text, own in zip(pdf["rep"].to_numpy(), pdf["text"].array, pdf["own"].array):
                for anchor in own:
                    met: dict[tuple[str, int], list[int]] = {}
                    for place in anchor["at"]:
                        low = max(0, place - reach)
                        met.setdefault((text[low : place + span], place - low), []).append(low)
                    out += [(anchor["fp"], anchor["heavy"], rep, at, left, ctx) for (ctx, left), at in met.items()]
            yield pd.DataFrame(out, columns=["fp", "heavy", "rep", "at", "left", "ctx"]).astype({"fp": "int64", "heavy": "bool", "rep": "int64", "left": "int32"})

    return asked.select("rep", "text", "own").mapInPandas(run, CONTEXT)


def _windows(ctx: list[str], left: np.ndarray, span: int, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, context number and start of all windows around the anchors of some contexts."""
    codes = Codes(ctx)
    size = np.diff(codes.bounds)
    low = np.maximum(0, left + shingle - span)
    high = np.minimum(left, size - span)
    n = np.maximum(0, high - low + 1)
    which = np.repeat(np.arange(len(ctx)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[which]
    begin = codes.bounds[which] + start
    return codes.spans(begin, begin + span), which, start


OUT = "rep long, first int, last int, to long"


def _exact_keys(ctx: list[str], which: np.ndarray, start: np.ndarray, span: int) -> np.ndarray:
    """A number for each different window, by its text."""
    seen: dict[str, int] = {}
    return np.array([seen.setdefault(ctx[w][s : s + span], len(seen)) for w, s in zip(which, start)], dtype=np.uint64)


def _group_windows(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: whether another record has its key, the smallest record with it, and a window of that record."""
    order = np.lexsort((owner, key))
    edge = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    group = np.repeat(np.arange(len(edge)), np.diff(np.concatenate([edge, [len(key)]])))
    last = np.concatenate([edge[1:], [len(key)]]) - 1
    shared, to, twin = np.zeros(len(key), bool), np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    shared[order] = (owner[order][edge] != owner[order][last])[group]
    to[order], twin[order] = owner[order][edge][group], order[edge][group]
    return shared, to, twin


def shared_stretches(contexts: DataFrame, span: int, shingle: int) -> DataFrame:
    """Stretches of shared windows: ``rep``, ``first``, ``last`` and ``to``, the smallest record that shares them.

    Groups of one anchor meet in a task. Windows are sorted by hash; each run of windows is then compared with the run
    it equals, text by text, and should a hash ever lie, the windows of that block are told apart by their texts.
    """
    block = 4000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def stretches(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
            rep, at, ctx = part["rep"].to_numpy(), part["at"].array, list(part["ctx"].array)
            key, which, start = _windows(ctx, part["left"].to_numpy(), span, shingle)
            if not len(key):
                return
            for exact in (False, True):
                shared, to, twin = _group_windows(_exact_keys(ctx, which, start, span) if exact else key, rep[which])
                at_run = np.flatnonzero(shared)
                if not len(at_run):
                    return
                w, s, t, u = which[at_run], start[at_run], to[at_run], twin[at_run]
                # A run: neighbouring windows of one context that equal neighbouring windows of one other.
                new = np.concatenate([[True], (w[1:] != w[:-1]) | (s[1:] != s[:-1] + 1) | (t[1:] != t[:-1]) | (which[u[1:]] != which[u[:-1]]) | (start[u[1:]] != start[u[:-1]] + 1)])
                f = np.flatnonzero(new)
                l = np.concatenate([f[1:], [len(w)]]) - 1
                size = s[l] - s[f] + span
                if exact or all(ctx[a][i : i + n] == ctx[b][j : j + n] for a, i, b, j, n in zip(w[f], s[f], which[u[f]], start[u[f]], size)):
                    break
            repeats = np.array([len(at[x]) for x in w[f]])
            places = np.concatenate([np.asarray(at[x], dtype=np.int64) for x in w[f]]) + np.repeat(s[f], repeats)
            yield pd.DataFrame({"rep": np.repeat(rep[w[f]], repeats), "first": places.astype(np.int32), "last": (places + np.repeat(size, repeats)).astype(np.int32), "to": np.repeat(t[f], repeats)})

        held: list[pd.DataFrame] = []
        for pdf in batches:  # sorted by anchor; the last group of a batch may go on in the next
            if not len(pdf):
                continue
            pdf = pd.concat([*held, pdf], ignore_index=True) if held else pdf
            fp = pdf["fp"].to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
            done, held = 0, [pdf.iloc[edges[-1] :]]
            for e in edges[1:]:
                if e - done >= block:
                    yield from stretches(pdf.iloc[done:e])
                    done = e
            if edges[-1] > done:
                yield from stretches(pdf.iloc[done : edges[-1]])
        if held:
            yield from stretches(held[0])

    return contexts.where("NOT heavy").drop("heavy").repartition("fp").sortWithinPartitions("fp").mapInPandas(run, OUT)


def heavy_stretches(contexts: DataFrame, span: int, shingle: int) -> DataFrame:
    """The same for anchors with too many rows for a task: every window is a row, told by a 128-bit hash of its text and counted with partial aggregation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 2000):
                part = pdf.iloc[k : k + 2000]
                ctx, rep, at = list(part["ctx"].array), part["rep"].to_numpy(), part["at"].array
                _, which, start = _windows(ctx, part["left"].to_numpy(), span, shingle)
                key = [xxhash.xxh3_128_digest(ctx[w][s : s + span].encode("utf-8", "surrogatepass")) for w, s in zip(which, start)]
                repeats = np.array([len(at[x]) for x in which], dtype=int)
                places = np.concatenate([np.asarray(at[x], dtype=np.int64) for x in which]) if len(which) else np.zeros(0, np.int64)
                yield pd.DataFrame({"h": np.repeat(np.array(key, dtype=object), repeats), "rep": np.repeat(rep[which], repeats), "first": places + np.repeat(start, repeats)})

    windows = materialize(contexts.where("heavy").select("rep", "at", "left", "ctx").mapInPandas(run, "h binary, rep long, first long"), "windows")
    several = windows.groupBy("h").agg(F.min("rep").alias("to"), F.max("rep").alias("_high")).where(F.col("to") != F.col("_high"))
    return windows.join(several.select("h", "to"), "h").select("rep", F.col("first").cast("int"), (F.col("first") + span).cast("int").alias("last"), "to").distinct()


class SharedSpans:
    """Spans of at least ``span`` code points that stand in more than one record.

    Every window of ``span`` code points is taken as a paragraph. Its signature is one band of one min-hash over its
    ``shingle``-character shingles, the banding of highest recall: equal windows always collide. Neighbouring windows
    mostly share their min-hash, so a record has about ``2 / (span - shingle)`` anchors a character. Anchors are
    counted before any text is sent: only those that stand in two records or more get their context, and those with more
    than ``group_limit`` rows, known from the count, are spread window by window over the cluster; so a task of the
    others holds groups of bounded size. Colliding windows are compared as texts. Records with equal texts (by a
    128-bit digest) are collapsed before and count as each other's partners.

    Null texts and texts shorter than ``span`` share nothing; a record's own repeats don't count; ids are taken as
    unique; an empty table gives an empty table.
    """

    def __init__(self, df: DataFrame, id_col: str = "file_id", text_col: str = "content", span: int = 160, shingle: int = 32, group_limit: int = 2000) -> None:
        self.span = span
        self.all = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
        long = self.all.where(F.length("text") >= span)
        keyed = long.select("id", F.md5("text").alias("d"))
        several = keyed.groupBy("d").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).where("copies > 1").select("d", "rep")
        self.copies = materialize(keyed.join(several, "d").select("id", "rep").distinct(), "copies")
        distinct = long.join(self.copies.where("id <> rep").select("id"), "id", "left_anti").select(F.col("id").alias("rep"), "text")
        places = materialize(anchor_rows(distinct, span, shingle), "anchors")
        met = places.groupBy("fp").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high"), F.count("*").alias("_n")).where("_low <> _high")
        met = met.select("fp", (F.col("_n") > group_limit).alias("heavy"))
        own = places.join(met, "fp").groupBy("rep").agg(F.collect_list(F.struct("fp", "heavy", "at")).alias("own"))
        contexts = materialize(context_rows(long.select(F.col("id").alias("rep"), "text").join(own, "rep"), span, shingle), "contexts")
        discard(places)
        self.stretches = shared_stretches(contexts, span, shingle).unionByName(heavy_stretches(contexts, span, shingle))
        self.stretches = materialize(self.stretches, "stretches")
        discard(contexts)

    def covered(self) -> DataFrame:
        """(``rep``, ``shared``): the characters of each distinct text that shared windows cover."""
        before = Window.partitionBy("rep").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
        fresh = F.col("last") - F.greatest(F.col("first"), F.coalesce(F.max("last").over(before), F.lit(0)))
        return self.stretches.select("rep", "first", "last").distinct().withColumn("_new", F.greatest(F.lit(0), fresh)).groupBy("rep").agg(F.sum("_new").alias("shared"))

    def found(self) -> DataFrame:
        """(``file_id``): records with a shared span."""
        whole = self.copies.select("id")
        return self.stretches.select(F.col("rep").alias("id")).distinct().unionByName(whole).distinct().select(F.col("id").alias("file_id"))

    def shares(self) -> DataFrame:
        """One row for each record with a text: ``file_id``, ``n_chars``, ``shared_chars``, ``share``."""
        parts = self.covered().select(F.col("rep").alias("id"), "shared")
        same = self.copies.select("id", F.lit(True).alias("_whole"))
        rows = self.all.select("id", F.length("text").alias("n_chars")).join(parts, "id", "left").join(same, "id", "left")
        shared = F.when(F.col("_whole"), F.col("n_chars")).otherwise(F.coalesce("shared", F.lit(0)))
        rows = rows.withColumn("shared_chars", shared)
        return rows.select(F.col("id").alias("file_id"), "n_chars", "shared_chars", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(F.lit(0.0)).alias("share"))

    def clusters(self) -> DataFrame:
        """(``file_id``, ``cluster``, ``removable``): records tied by shared spans; all but the smallest id of a cluster are removable.

        Each window's class is a star around its smallest id, so the number of edges follows the text, not its pairs.
        """
        edges = self.stretches.select("rep", "to").unionByName(self.copies.select(F.col("id").alias("rep"), F.col("rep").alias("to"))).distinct()
        parts = components(edges, "rep", "to")
        least = parts.groupBy("component").agg(F.min("vertex").alias("cluster"))
        return parts.join(least, "component").select(F.col("vertex").alias("file_id"), "cluster", (F.col("vertex") != F.col("cluster")).alias("removable"))


def tune_bands(similarity: float, recall: float) -> int:
    """The fewest bands of WIDTH min-hash values that show a pair of that similarity with probability ``recall``; more than there are is an error."""
    bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**neardup.WIDTH))
    if bands > neardup.PARTS:
        raise ValueError(f"{bands} bands are needed, a sketch has {neardup.PARTS}")
    return bands


def paragraph_clusters(df: DataFrame, id_col: str = "file_id", text_col: str = "content", words: int = 5, similarity: float = 0.8, min_words: int = 20, recall: float = 0.999) -> DataFrame:
    """Removals by alike paragraphs: one row for each record that has a paragraph of ``min_words`` words or more.

    Gives ``file_id``, ``paragraphs``, ``shared`` (those alike to a paragraph of another place), ``cluster`` (the smallest id of the records
    tied by alike paragraphs) and ``removable``. Paragraphs are what stands between blank lines. Each has a sketch; bands are
    tuned so that a pair just at ``similarity`` collides with probability ``recall``; paragraphs with the same set of shingles are one
    class, colliding classes are joined, their exact Jaccard similarity is taken, and the components of records and classes
    are the clusters. A paragraph that a third of all records hold is one class, so it is compared once. Null, empty and short texts have no
    row; an empty table gives an empty table.
    """
    rows = df.select(F.col(id_col).cast("long").alias("file_id"), F.explode(F.split(F.col(text_col), r"\r?\n[ \t\r]*\n")).alias("text")).where("file_id IS NOT NULL AND length(text) > 0")
    parts = materialize(rows.withColumn("pid", F.monotonically_increasing_id()), "paragraphs")
    bands = tune_bands(similarity, recall)
    near = neardup.NearDuplicates(parts, "pid", "text", words, similarity, min_words, thresholds=[0] * bands + [-1] * (neardup.PARTS - bands))
    linked = near.links.select(F.explode(F.array("a", "b")).alias("rep")).distinct().withColumn("_linked", F.lit(True))
    several = near.copies.select("rep").distinct().withColumn("_several", F.lit(True))
    classes = near.members().join(parts.select(F.col("pid").alias("id"), "file_id"), "id").join(linked, "rep", "left").join(several, "rep", "left")
    classes = materialize(classes.select("file_id", "rep", F.coalesce("_linked", "_several", F.lit(False)).alias("shared")), "members")
    record, group = (lambda c: F.concat(F.lit("r"), F.col(c))), (lambda c: F.concat(F.lit("p"), F.col(c)))
    edges = classes.where("shared").select(record("file_id").alias("src"), group("rep").alias("dst")).union(near.links.select(group("a"), group("b"))).distinct()
    tied = components(edges).where(F.col("vertex").startswith("r")).select(F.substring("vertex", 2, 20).cast("long").alias("file_id"), "component")
    named = tied.join(tied.groupBy("component").agg(F.min("file_id").alias("cluster")), "component").select("file_id", "cluster")
    own = classes.groupBy("file_id").agg(F.count("*").alias("paragraphs"), F.sum(F.col("shared").cast("int")).alias("shared"))
    out = own.join(named, "file_id", "left").select("file_id", "paragraphs", "shared", F.coalesce("cluster", "file_id").alias("cluster"))
    return out.withColumn("removable", F.col("file_id") != F.col("cluster"))
