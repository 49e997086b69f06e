"""Expansions of regexes: drawn phrases of their licence between their parts, and strings sampled from what that gives."""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.sampling import Frame, one_blank, sample_regex
from lexmill.operators import walks

#: The features of this operator: strings for each regex, and the phrase lengths of its long wildcards.
NGRAM_STRINGS, CHAIN_STRINGS, LONG = 200, 100, (12, 59)
#: Rounds without a new string after which a chain is taken to have no more.
_IDLE = 1000


def _random(*key) -> random.Random:
    return random.Random(int.from_bytes(hashlib.md5("|".join(map(str, key)).encode()).digest(), "big"))


def _draw(*key) -> float:
    """The same number as T.draw."""
    return int(hashlib.md5("|".join(map(str, key)).encode()).hexdigest()[:8], 16) / 4294967296.0


def _choice(rng: random.Random, n: int) -> int:
    """A place below ``n``, as rng.choice draws it, in fewer calls."""
    bits = n.bit_length()
    k = rng.getrandbits(bits)
    while k >= n:
        k = rng.getrandbits(bits)
    return k


def _frame(before: str, after: str) -> Frame | None:
    try:
        return Frame(before, after)
    except (re.error, ValueError, OverflowError, KeyError):
        return None


def _sampled(frame: Frame | None, before: str, after: str, pieces: list[str], plain: bool, round_: int) -> list[str]:
    """Strings of the regex with the pieces and (and|or) between them in its gap; it is only parsed anew if text in the gap may change how it is read."""
    if frame and plain:
        return frame.sample(pieces, seed=round_)
    return [one_blank(x) for x in sample_regex(f"{before}{'(and|or)'.join(pieces)}{after}", seed=round_)]


def ngram_strings(prefix: str, suffix: str, pool: Sequence[str], key, least: int = NGRAM_STRINGS) -> list[str]:
    """At least ``least`` strings, repeats kept: one to four drawn phrases, each with (and|or), stand between the parts."""
    rng, out, k = _random(key, "ngram"), [], 0
    before, after = f"{prefix} ", f" {suffix}"
    frame = _frame(before, after)
    while len(out) < least:
        drawn = [pool[_choice(rng, len(pool))] for _ in range(rng.randint(1, 4))]
        pieces = [f"{drawn[0]} ", *(f" {x} " for x in drawn[1:]), " "]
        found = _sampled(frame, before, after, pieces, not any(map(Frame.marks.search, drawn)), k)
        if not found:  # phrases hold no marks, so the parts can't be read in any round
            break
        out += found
        k += 1
    return out


def chain_strings(prefix: str, suffix: str, sentence: Callable[[random.Random], str], key, least: int = CHAIN_STRINGS) -> list[str]:
    """At least ``least`` distinct strings with one to four sentences of the chain between the parts; fewer only if there are no more."""
    rng, out, k, idle = _random(key, "markov"), {}, 0, 0
    after = f" {suffix}"
    frame = _frame(prefix, after)
    while len(out) < least and idle < _IDLE:
        body = " ".join([sentence(rng) for _ in range(rng.randint(1, 4))])
        found = _sampled(frame, prefix, after, [body], not Frame.marks.search(body), k)
        if not found:
            break
        before = len(out)
        out.update(dict.fromkeys(found))
        k, idle = k + 1, idle + 1 if len(out) == before else 0
    return list(out)


def _chain(texts: list[dict], most: int = walks.WORDS) -> Callable[[random.Random], str]:
    heads: list[str] = []
    after: dict[str, list[str]] = {}
    for t in texts:
        w1, w2 = t["w1"].split(" "), t["w2"].split(" ")
        heads += w1
        for a, b in zip(w1, w2[1:]):
            after.setdefault(a, []).append(b)

    counted = {a: (b, len(b), len(b).bit_length()) for a, b in after.items()}

    def sentence(rng: random.Random) -> str:
        bits, words = rng.getrandbits, [heads[_choice(rng, len(heads))]]
        for _ in range(rng.randint(1, most) - 2):
            found = counted.get(words[-1])
            if found is None:
                break
            k = bits(found[2])  # _choice
            while k >= found[1]:
                k = bits(found[2])
            words.append(found[0][k])
        return " ".join(words)

    return sentence


def _label_key(c):
    """A label without its spelling: lower case, each run of separators as one blank."""
    return F.lower(F.regexp_replace(c, "[-._ ]+", " "))


def expansions(rules: DataFrame, texts: DataFrame) -> DataFrame:
    """Strings of each regex that isn't blank: ``licenses``, ``regex_id``, ``algo``, ``rank``, ``expansion``."""
    return expansion_lists(rules, texts).select("licenses", "regex_id", "algo", F.posexplode("expansion").alias("rank", "expansion"))


def expansion_lists(rules: DataFrame, texts: DataFrame) -> DataFrame:
    """The strings of each regex that isn't blank in one list: ``licenses``, ``regex_id``, ``algo``, ``expansion``.

    ``rules``: ``regex_id``, ``licenses``, ``regex``; ``texts``: ``license``, ``source``, ``text``. A regex with a
    wildcard takes phrases from the texts of its label, however spelled: algo ngram from their pool, markov from their
    chain. Without a wildcard it is sampled as it is (algo sample); so is one whose label has no text, with its
    wildcards expanded and up to the n-gram number of strings. A label's texts and regexes meet in one row; texts of labels
    without a wildcard are not walked. The work on a row far outweighs its bytes, so rows go to a fixed number of tasks.
    """
    spark = rules.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    rx = T.unquote(F.col("regex"))
    # A regex without a label stands alone.
    label = F.coalesce(_label_key(F.col("licenses")), F.concat(F.lit("\0"), F.col("regex_id").cast("string")))
    r = rules.where(T.strip(F.col("regex")) != "").select("regex_id", "licenses", label.alias("_k"), rx.alias("rx")).withColumn("kind", T.wildcard_kind(F.col("rx")))
    own = F.struct("regex_id", "licenses", T.expand_macros(F.col("rx")).alias("rx"), T.erase_macros(T.regex_prefix(F.col("rx"))).alias("p"), T.erase_macros(T.regex_suffix(F.col("rx"))).alias("s"), "kind")
    asked = r.select("_k", own.alias("_r")).repartition(parts, "_k").groupBy("_k").agg(F.collect_list("_r").alias("_r"))
    labelled = texts.where("license IS NOT NULL").withColumn("_k", _label_key(F.col("license"))).repartition(parts, "_k")
    wanted = asked.where(F.exists("_r", lambda x: x["kind"] != "none")).select("_k")
    known = walks.prepared(labelled.join(wanted, "_k", "left_semi"), ["license", "source"], also=("_k",)).groupBy("_k").agg(F.collect_list("_t").alias("_t"))

    def make(row: dict) -> Iterator[dict[str, list]]:
        given = sorted(row["_t"] or [], key=lambda t: t["key"])
        pools: dict[tuple[int, int], walks.Pool] = {}
        sentence = _chain(given)
        made: list[tuple] = []
        for x in row["_r"]:
            lengths = LONG if x["kind"] in ("some", "any") else walks.LENGTHS
            if x["kind"] != "none" and lengths not in pools:
                pools[lengths] = walks.Pool(given, lengths)
            if x["kind"] == "none":
                parts = {"sample": sample_regex(x["rx"])}
            elif not len(pools[lengths]):
                parts = {"sample": sample_regex(x["rx"], NGRAM_STRINGS)}
            else:
                parts = {"ngram": ngram_strings(x["p"], x["s"], pools[lengths], x["regex_id"]), "markov": chain_strings(x["p"], x["s"], sentence, x["regex_id"])}
            made += [(x["licenses"], x["regex_id"], algo, found) for algo, found in parts.items() if found]
        if made:
            licenses, ids, algos, found = zip(*made)
            yield {"licenses": walks.pa.array(licenses, walks.pa.string()), "regex_id": walks.pa.array(ids, walks.pa.int64()), "algo": list(algos), "expansion": walks.pa.array(found, walks.pa.list_(walks.pa.string()))}

    return walks.mapped(asked.join(known, "_k", "left").select("_r", "_t"), make, [], "licenses string, regex_id bigint, algo string, expansion array<string>")


def assembled(rules: DataFrame, texts: DataFrame, rounds: int = 20) -> DataFrame:
    """Regexes with drawn phrases between their parts, before anything is sampled: ``regex_id``, ``kind``, ``round``, ``assembled``.

    Dispatch is by the first kind of wildcard: group and few take phrases of the usual lengths, some and any long ones, each from the
    pool of distinct phrases of the regex's licence, however spelled; one to four phrases a round, each chosen uniformly by
    hash and followed by (and|or). A label's texts and regexes meet in one row and only drawn phrases leave it; texts of labels
    without such a regex are not walked. Regexes without a wildcard, without a label or whose label has no text give no row.
    """
    rx = T.unquote(F.col("regex"))
    r = rules.where("regex IS NOT NULL AND licenses IS NOT NULL").select("regex_id", _label_key(F.col("licenses")).alias("_k"), rx.alias("rx")).withColumn("kind", T.wildcard_kind(F.col("rx"))).where("kind <> 'none'")
    own = F.struct("regex_id", "kind", T.erase_macros(T.regex_prefix(F.col("rx"))).alias("p"), T.erase_macros(T.regex_suffix(F.col("rx"))).alias("s"))
    asked = r.groupBy("_k").agg(F.collect_list(own).alias("_r"))
    labelled = texts.where("license IS NOT NULL").withColumn("_k", _label_key(F.col("license"))).join(asked.select("_k"), "_k", "left_semi")
    known = walks.prepared(labelled, ["license", "source"]).groupBy(_label_key(F.col("license")).alias("_k")).agg(F.collect_list("_t").alias("_t"))

    def make(row: dict) -> Iterator[dict[str, list]]:
        for kinds, lengths in ((("group", "few"), walks.LENGTHS), (("some", "any"), LONG)):
            here = [x for x in row["_r"] if x["kind"] in kinds]
            pool = walks.Pool(row["_t"], lengths) if here else []
            if not len(pool):
                continue
            for x in here:
                made = []
                for k in range(1, rounds + 1):
                    times = 1 + int(_draw(x["regex_id"], k, "times") * 4)
                    body = "".join(f"{pool[int(_draw(x['regex_id'], k, j) * len(pool))]} (and|or) " for j in range(1, times + 1))
                    made.append(f"{x['p']} {body} {x['s']}")
                yield {"regex_id": walks.pa.array([x["regex_id"]] * rounds, walks.pa.int64()), "kind": [x["kind"]] * rounds, "round": walks.pa.array(range(1, rounds + 1), walks.pa.int32()), "assembled": made}

    return walks.mapped(asked.join(known, "_k").select("_r", "_t"), make, [], "regex_id bigint, kind string, round int, assembled string")
