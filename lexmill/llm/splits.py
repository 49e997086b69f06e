"""Problem 1: train, validation and test splits that keep related records together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import components
from lexmill.operators.prefix import running_total
from lexmill.runtime import materialize

#: Names that name nobody, as sorted lower-case words.
PLACEHOLDERS = (
    "", "a n", "na", "none", "null", "nil", "unknown", "author unknown", "anonymous", "anon", "various", "authors various",
    "authors", "authors the", "author", "author the", "contributors", "contributors the", "contributor", "all contributors",
    "nobody", "not specified", "unspecified", "undefined", "available not", "tba", "tbd", "misc", "others", "et al",
    "authors see", "file see", "maintainers", "maintainers the", "community the", "team the", "x", "xxx", "test",
)
#: What stands in an origin for none.
NO_ORIGIN = ("", "-", "--", "n/a", "na", "none", "(none)", "null", "nil", "unknown", "unspecified", "local", "tbd", "?", "http:", "https:")


def label_key(label: Column) -> Column:
    """Lower case, each run of ``-``, ``.``, ``_`` or blank as one separator; outer blanks don't count."""
    return F.regexp_replace(F.lower(F.regexp_replace(label, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), r"[-._\s\p{Z}]+", "-")


def author_key(author: Column) -> Column:
    """The sorted lower-case words of a name; null for a placeholder."""
    words = F.array_sort(F.filter(F.split(F.lower(author), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != ""))
    key = F.array_join(words, " ")
    return F.when(key.isin(*PLACEHOLDERS), None).otherwise(key)


def origin_key(origin: Column) -> Column:
    """Host and path in lower case, without scheme, query, fragment, closing ``/`` or ``.git``; null for a placeholder."""
    low = F.lower(F.regexp_replace(origin, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    bare = F.regexp_replace(F.regexp_replace(low, r"[?#].*$", ""), r"^(?:[a-z][a-z0-9+.-]*:)?//", "")
    key = F.regexp_replace(bare, r"(?:/|\.git)+$", "")
    return F.when(low.isin(*NO_ORIGIN) | key.isin(*NO_ORIGIN), None).otherwise(key)


def _clean(files: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = files.select(
        F.col("file_id").alias("row_id"), F.col("dirname").alias("label"), label_key(F.col("dirname")).alias("lk"),
        author_key(F.col("author")).alias("ak"), origin_key(F.col("origin")).alias("ok"),
    )
    regexes = rules.select(F.col("regex_id").alias("row_id"), F.col("licenses").alias("label"), label_key(F.col("licenses")).alias("lk"))
    return rows, regexes


def label_components(files: DataFrame, rules: DataFrame, seed: int = 17) -> DataFrame:
    """(``vertex``, ``component``) over labels ``L:``, authors ``A:`` and origins ``O:`` of the two tables."""
    rows, regexes = _clean(files, rules)
    lk, ak, ok = (F.concat(F.lit(p), F.col(c)) for p, c in (("L:", "lk"), ("A:", "ak"), ("O:", "ok")))
    # A row ties its label to its author and origin; without a label it ties these two to each other.
    tied = rows.select(F.explode(F.array(F.struct(lk.alias("a"), ak.alias("b")), F.struct(lk.alias("a"), ok.alias("b")), F.struct(ak.alias("a"), ok.alias("b")), F.struct(lk.alias("a"), lk.alias("b")), F.struct(ak.alias("a"), ak.alias("b")), F.struct(ok.alias("a"), ok.alias("b")))).alias("e")).select("e.*")
    edges = tied.union(regexes.select(lk.alias("a"), lk.alias("b"))).where("a IS NOT NULL AND b IS NOT NULL").distinct()
    # Where the label stands, the edge between author and origin adds nothing but is true as well.
    return components(edges, "a", "b", seed)


def grouped_splits(
    files: DataFrame,
    rules: DataFrame,
    shares: tuple[tuple[str, float], ...] = (("train", 0.8), ("validation", 0.1), ("test", 0.1)),
    seed: int = 17,
) -> DataFrame:
    """(``tab``, ``row_id``, ``component``, ``split``): a split for every row of both tables.

    Rows tied by label, author or origin, directly or through others, have one component and so one split. Components
    are laid out by weight (rows), heaviest first and ties by hash, and cut at the cumulative shares; a component goes
    where its middle falls. A row without label, author and origin is a component of its own. Nulls, empty strings and
    placeholders tie nothing; repeated rows are kept; empty tables give an empty table.
    """
    total_share = sum(s for _, s in shares)
    known = label_components(files, rules, seed)
    rows, regexes = _clean(files, rules)
    p = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    keyed = rows.select(F.lit("split_db_foss_licenses").alias("tab"), "row_id", F.coalesce(p("L:", "lk"), p("A:", "ak"), p("O:", "ok")).alias("vertex"))
    keyed = keyed.unionByName(regexes.select(F.lit("spdxregex").alias("tab"), "row_id", p("L:", "lk").alias("vertex")))
    # Rows are counted before the join, so a label with a third of all rows is one row of it.
    weights = keyed.where("vertex IS NOT NULL").groupBy("vertex").count()
    named = materialize(weights.join(known, "vertex").select("vertex", "component", "count"), "named", compact=False)
    alone = F.concat(F.lit("R:"), F.substring("tab", 1, 2), F.col("row_id").cast("string"))
    sizes = named.groupBy("component").agg(F.sum("count").alias("weight"))
    sizes = sizes.unionByName(keyed.where("vertex IS NULL").select(alone.alias("component")).groupBy("component").agg(F.count("*").alias("weight")))
    sizes = sizes.select("component", "weight", (-F.col("weight")).alias("_w"), F.xxhash64("component", F.lit(seed)).alias("_h"))
    placed = running_total(sizes, ["_w", "_h", "component"], "weight", "_upto")
    whole = sizes.agg(F.sum("weight").alias("_all"))  # one row
    middle = (F.col("_upto") - F.col("weight") / 2) / F.col("_all") * total_share
    split, bound = F.lit(shares[-1][0]), total_share - shares[-1][1]
    for name, share in reversed(shares[:-1]):
        split = F.when(middle < bound, name).otherwise(split)
        bound -= share
    decided = materialize(placed.join(F.broadcast(whole)).select("component", split.alias("split")), "decided", compact=False)
    by_vertex = named.join(decided, "component").select("vertex", "component", "split")
    tied = keyed.where("vertex IS NOT NULL").join(by_vertex, "vertex").select("tab", "row_id", "component", "split")
    single = keyed.where("vertex IS NULL").withColumn("component", alone).join(decided, "component").select("tab", "row_id", "component", "split")
    return tied.unionByName(single)


def label_groups(files: DataFrame, rules: DataFrame, seed: int = 17) -> DataFrame:
    """(``label``, ``tied_to``, ``rows``): one row for each label string, with the smallest label that must share its split and its number of rows.

    The same ties as label_pairs in a form that grows with the labels and not with their pairs. Null labels are none;
    empty tables give an empty table.
    """
    known = label_components(files, rules, seed)
    rows, regexes = _clean(files, rules)
    counted = rows.select("label", "lk").unionByName(regexes.select("label", "lk")).where("label IS NOT NULL").groupBy("label", "lk").agg(F.count("*").alias("rows"))
    comp = materialize(counted.withColumn("vertex", F.concat(F.lit("L:"), F.col("lk"))).join(known, "vertex").select("label", "component", "rows"), "labels", compact=False)
    least = comp.groupBy("component").agg(F.min("label").alias("tied_to"))
    return comp.join(least, "component").select("label", "tied_to", "rows")


def label_pairs(files: DataFrame, rules: DataFrame, seed: int = 17) -> DataFrame:
    """(``label_a``, ``label_b``): the pairs of different label strings that must share a split, ``label_a < label_b``.

    The pairs of a component are the result itself; the join runs on a component, split by the labels' hash, so that
    a large component isn't one task's.
    """
    known = label_components(files, rules, seed)
    rows, regexes = _clean(files, rules)
    labels = rows.select("label", "lk").union(regexes.select("label", "lk")).where("label IS NOT NULL").distinct()
    comp = materialize(labels.select("label", F.concat(F.lit("L:"), F.col("lk")).alias("vertex")).join(known, "vertex").select("label", "component"), "labels", compact=False)
    salts = 32
    a = comp.select(F.col("label").alias("label_a"), "component", F.pmod(F.xxhash64("label"), F.lit(salts)).alias("salt"))
    b = comp.select(F.col("label").alias("label_b"), "component", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("salt"))
    return a.join(b, ["component", "salt"]).where("label_a < label_b").select("label_a", "label_b")
