"""Queries of the core, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import sampling
from lexmill.functions import text as T
from lexmill.functions.escapes import decode_escapes as decoded
from lexmill.operators import fragments as fr
from lexmill.operators import generate as gen
from lexmill.operators import labels as lab
from lexmill.operators import models, signatures, walks
from lexmill.operators.expansions import assembled, expansion_lists, expansions
from lexmill.runtime import new_path, read_table, spread
from lexmill.sources import catalogs, compaction

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}


def query(f: Query) -> Query:
    """Register a query under its name."""
    _ALL[f.__name__] = f
    return f


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: read_table(spark, d, name)


def wide(table: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The table spread over all cores, for costly work on each row."""
    return lambda spark, d: spread(table(spark, d))


docs, files, licenses, rules, landed, generated = map(_table, ("documents", "split_db_foss_licenses", "licenses", "spdxregex", "landed_files", "ngramfiles"))


@query
def p2_found(spark, d):
    """Records read back from the consolidated files."""
    return compaction.consolidated_records(landed(spark, d)).select("file_id")


@query
def p2_validation(spark, d):
    """Records and bytes of the consolidated files, what the source files hold, and whether the two agree."""
    told = compaction.consolidate(landed(spark, d))[1]
    return told.select("records", "bytes", "files", "source_bytes", "wrong_length", "complete_lines", "torn_lines", "torn_bytes", "blank_lines", "valid")


@query
def p2_frames(spark, d):
    """The payloads as zstandard frames, joined to few files and read back: files, bytes and line feeds."""
    joined = compaction.join_frame_files(compaction.as_frames(landed(spark, d)))
    return compaction.split_frames(joined).agg(F.sum("n_files").alias("files"), F.sum("n_bytes").alias("bytes"), F.sum("n_lines").alias("lines"))


def _scalar(name: str, table, key: str, text: str, **columns) -> None:
    """A query of one scan: the key and some expressions of the text column."""

    def run(spark, d):
        return table(spark, d).select(key, *(f(F.col(text)).alias(c) for c, f in columns.items()))

    run.__name__ = name
    query(run)


_scalar("clean_text", wide(docs), "doc_id", "text", cleaned=T.clean_text)
_scalar("para_join", docs, "doc_id", "text", joined=T.joined_paragraphs)
_scalar("blank_lines", docs, "doc_id", "text", blank_lines=T.blank_lines)
_scalar("ws_count", docs, "doc_id", "text", ws_count=T.blank_characters)
_scalar("scan_text", wide(docs), "doc_id", "text", scanned=T.for_scan)
_scalar("drop_digit_words", wide(docs), "doc_id", "text", kept=T.drop_digit_words)
_scalar("collapse_blanks", wide(docs), "doc_id", "text", collapsed=lambda c: T.strip(T.collapse(c)))
_scalar("normalize_license_id", files, "file_id", "dirname", label_key=T.normal_label, prefix=T.label_prefix)
_scalar("decode_escapes", wide(files), "file_id", "content", decoded=decoded)
_scalar("macro_expand", rules, "regex_id", "regex", expanded=lambda c: T.expand_macros(T.unquote(c)))
_scalar("macro_erase", rules, "regex_id", "regex", erased=lambda c: T.erase_macros(T.unquote(c)))
_scalar("wildcard_class", rules, "regex_id", "regex", kind=T.wildcard_kind, marks=T.wildcard_count)
_scalar(
    "regex_parts", rules, "regex_id", "regex", prefix=lambda c: T.regex_prefix(T.unquote(c)), suffix=lambda c: T.regex_suffix(T.unquote(c)),
    last_suffix=lambda c: T.regex_last_suffix(T.unquote(c)),
)
_scalar("path_label", landed, "file_path", "file_path", label=T.label_of_path, is_txt=lambda c: F.lower(c).endswith(".txt"))
_scalar("src_url_rewrite", files, "file_id", "filename", url=lambda c: T.absolute_url(F.concat(F.lit("./"), c), "https://base.example/"))


def _rows(name: str, table, key: str, text: str, column: str, split) -> None:
    """A query that makes a row of each element."""

    def run(spark, d):
        return table(spark, d).where(F.col(text).isNotNull()).select(key, F.posexplode(split(F.col(text))).alias("pos", column))

    run.__name__ = name
    query(run)


_rows("tokenize", wide(docs), "doc_id", "text", "token", T.tokenize)
_rows("sentence_split", wide(docs), "doc_id", "text", "sentence", T.sentences)
_rows("train_sentences", docs, "doc_id", "text", "sentence", T.train_sentences)
_rows("paragraph_split", docs, "doc_id", "text", "paragraph", T.paragraphs)
_rows("markov_words", wide(docs), "doc_id", "text", "word", T.chain_words)


@query
def token_freq(spark, d):
    """Tokens and how often they stand in documents."""
    return wide(docs)(spark, d).where("text IS NOT NULL").select(F.explode(T.tokenize(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("cnt"))


@query
def filter_nonempty(spark, d):
    """Fragments whose content isn't empty or blank."""
    return files(spark, d).where(T.strip(F.col("content")) != "").select("file_id", F.length("content").alias("n_chars"))


@query
def sliding_windows(spark, d):
    """All windows of sentences of the licence texts."""
    return fr.sliding_windows(licenses(spark, d)).select("license", "source", "width", "start_at", "fragment")


@query
def paragraph_windows(spark, d):
    """All windows of paragraphs of the licence texts."""
    return fr.sliding_windows(licenses(spark, d), unit="paragraph", sep="\n\n").select("license", "source", "width", "start_at", "fragment")


@query
def cumulative_splits(spark, d):
    """Growing concatenations of the fragments' sentences."""
    return fr.cumulative_splits(wide(files)(spark, d).select("file_id", "content"), "content").select("file_id", "pos", "fragment")


def _fragments(spark, d):
    return fr.all_fragments(licenses(spark, d).where("license IS NOT NULL"), ["license", "source"])


@query
def fragments_all(spark, d):
    """Windows and paragraphs together."""
    return _fragments(spark, d)


@query
def fragment_distinct(spark, d):
    """Distinct fragments of each licence."""
    return _fragments(spark, d).select("license", "fragment").distinct()


@query
def fragment_numbering(spark, d):
    """Numbers and names of the distinct fragments of each licence."""
    shortest = _fragments(spark, d).groupBy("license", "fragment").agg(F.min("kind").alias("kind"), F.min(F.coalesce("width", F.lit(0))).alias("width"), F.min("start_at").alias("start_at"))
    return fr.numbered(shortest, "license", ["kind", "width", "start_at", "fragment"]).select("license", "fragment", "seq", "name")


@query
def next_numbers(spark, d):
    """Where the numbering of a label goes on."""
    return lab.next_numbers(files(spark, d).select("dirname", "seq"), "dirname")


@query
def ngram_extract(spark, d):
    """Trigrams of the licence texts, with their contexts."""
    return models.ngram_rows(licenses(spark, d), 3, "text", ["license", "source"])


@query
def ngram_counts(spark, d):
    """Counts of n-grams of the orders 1 to 7 of the licence texts by source."""
    return models.ngram_orders(licenses(spark, d), list(range(1, 8)), "source")


def _model(spark, d, n=2):
    return models.ngram_model(models.ngram_counts(wide(docs)(spark, d), n, "source"), "source")


@query
def ngram_context(spark, d):
    """Contexts of bigrams of documents by source, and their successors."""
    return models.context_successors(models.ngram_counts(wide(docs)(spark, d), 2, "source"), "source")


@query
def ngram_successors(spark, d):
    """Contexts of bigrams of documents by source, and all their successors with their counts."""
    listed = models.successor_lists(models.ngram_counts(wide(docs)(spark, d), 2, "source"), "source")
    return listed.select("source", "context", F.array_join(F.transform("successors", lambda x: F.concat(x["token"], F.lit("="), x["cnt"].cast("string"))), " ").alias("successors"))


@query
def ngram_prob(spark, d):
    """Conditional probabilities of bigrams of documents by source."""
    return _model(spark, d).select("source", "context", "token", "cnt", "ctx_cnt", "prob")


@query
def ngram_cdf(spark, d):
    """Cumulative distributions of bigrams of documents by source."""
    return _model(spark, d).select("source", "context", "token", "cnt", "prob", "cdf")


@query
def ngram_prob_lookup(spark, d):
    """Probability of the generated files' bigrams under the model of the licence texts; 0 where unseen."""
    model = models.ngram_model(models.ngram_counts(licenses(spark, d).withColumn("lab", F.lit("all")), 2, "lab"), "lab")
    asked = models.ngram_rows(wide(generated)(spark, d).withColumn("lab", F.lit("all")), 2, "content", ["lab"]).distinct().withColumn("n", F.lit(2))
    return models.probabilities(asked, model, "lab").select("context", "token", "prob")


@query
def markov_transitions(spark, d):
    """Neighbouring words of documents by source."""
    return models.transitions(wide(docs)(spark, d), "source")


@query
def ngram_generate(spark, d):
    """Phrases of each licence text from its models of the orders 2 to 7, a seed for each character."""
    return walks.walk_ngrams(wide(licenses)(spark, d), ["license", "source"])


@query
def markov_generate(spark, d):
    """Phrases of each licence text from the chain of its words, a seed for each character."""
    return walks.walk_chain(wide(licenses)(spark, d), ["license", "source"])


@query
def phrase_pool(spark, d):
    """Distinct cleaned phrases of each licence from models of the orders 2 to 7."""
    return walks.phrase_pool(wide(licenses)(spark, d), ["license", "source"])


def _expansions(spark, d):
    return expansions(rules(spark, d), licenses(spark, d))


@query
def assemble_expansions(spark, d):
    """Expansions of each regex: strings sampled from it with drawn phrases of its licence between its parts."""
    return _expansions(spark, d).select("regex_id", "algo", "rank", "expansion")


@query
def assembled_regexes(spark, d):
    """Twenty rounds of each regex with drawn phrases of its licence in place of its wildcard."""
    return assembled(rules(spark, d), licenses(spark, d))


@query
def lookup_exact(spark, d):
    """The first regex of each fragment's label, empty where there is none."""
    table = rules(spark, d).select("licenses", F.coalesce("regex", F.lit("")).alias("regex"), "regex_id")
    return lab.lookup_exact(files(spark, d).select("file_id", "dirname"), table, "dirname", "licenses", "regex", ["regex_id"]).select("file_id", "regex")


@query
def lookup_contains(spark, d):
    """Regex rows whose label holds a licence's label, read as a regex."""
    keys = licenses(spark, d).select(F.col("license").alias("key")).where("key <> ''").distinct()
    return lab.lookup_all(keys, rules(spark, d).select("regex_id", "licenses"), "key", "licenses", literal=False).select("key", "regex_id")


@query
def lookup_prefix(spark, d):
    """Regex rows whose label holds the first part of a fragment's label."""
    keys = files(spark, d).select(T.label_prefix(F.col("dirname")).alias("key")).where("key <> ''").distinct()
    return lab.lookup_all(keys, rules(spark, d).select("regex_id", "licenses"), "key", "licenses").select("key", "regex_id")


@query
def vocab_join(spark, d):
    """Fragments with the full text of their label."""
    texts = licenses(spark, d).where("license IS NOT NULL AND text <> ''").select(F.col("license").alias("dirname"), "source", F.length("text").alias("vocab_chars"))
    return files(spark, d).select("file_id", "dirname").join(texts, "dirname").select("file_id", "source", "vocab_chars")


@query
def sig_parse(spark, d):
    """The regex table written as a catalogue, and parsed."""
    r = rules(spark, d).where("licenses IS NOT NULL")
    lines = F.array(
        F.lit("# a comment"), F.concat(F.lit("%ENTRY% _SPDX_"), T.normal_label(F.col("licenses"))), F.when(F.col("nocheck"), F.lit("%KEY% =NULL=")).otherwise(F.lit('%KEY% "terms"')),
        F.concat(F.lit("%STR% "), F.regexp_replace(F.coalesce("regex", F.lit('""')), "[\r\n]", " ")), F.when(F.col("nocheck"), F.lit("%NOCHECK%")).otherwise(F.lit("")), F.concat(F.lit("%ALIAS% "), F.col("licenses")),
    )
    text = r.select(F.col("regex_id").alias("doc"), F.posexplode(lines).alias("line", "value"))
    parsed = signatures.parse_catalogue(text)
    return parsed.select(F.col("doc").alias("regex_id"), "entry_id", "family", "license", "key_regex", "str_regex", "nocheck", F.array_join("aliases", "|").alias("aliases"))


def _catalogue(spark, d):
    """A catalogue for each label prefix, by line: many entries each, of two families in turn, with comments and definitions."""
    r = rules(spark, d).where("licenses IS NOT NULL").withColumn("_lt", F.col("regex_id") % 2 == 0)
    entry = F.concat(F.when(F.col("_lt"), "%ENTRY% _LT_").otherwise("%ENTRY% _SPDX_"), T.normal_label(F.col("licenses")))
    body = F.concat(F.when(F.col("regex_id") % 5 == 0, "%?STR% ").otherwise("%STR% "), F.regexp_replace(F.coalesce("regex", F.lit('""')), "[\r\n]", " "))
    lines = F.array(
        F.lit("#####"), F.lit("# %ENTRY% _LT_commented_out"), entry, F.lit("# prose between"), F.when(F.col("nocheck"), F.lit("%KEY% =NULL=")).otherwise(F.lit('%KEY% "terms"')), body,
        F.when(F.col("nocheck"), F.lit("%NOCHECK%")).otherwise(F.lit("")), F.concat(F.lit("%ALIAS% "), F.col("licenses")), F.concat(F.lit("%DEF% N"), F.col("regex_id"), F.lit("\t"), F.length("licenses"), F.lit("+1")),
    )
    text = r.select(F.lower(T.label_prefix(F.col("licenses"))).alias("doc"), "regex_id", F.posexplode(lines).alias("_pos", "value"))
    return text.select("doc", (F.col("regex_id") * 20 + F.col("_pos")).alias("line"), "value")


@query
def sig_parse_catalogue(spark, d):
    """Catalogues with many entries of two families, comments and definitions, parsed."""
    parsed = signatures.parse_catalogue(_catalogue(spark, d))
    return parsed.select("doc", "line", "entry_id", "family", "license", "key_regex", "str_regex", "nocheck", "optional_str", F.array_join("aliases", "|").alias("aliases"))


@query
def sig_definitions(spark, d):
    """Definitions of the same catalogues."""
    return signatures.parse_definitions(_catalogue(spark, d)).select("doc", "line", "name", "value")


@query
def union_families(spark, d):
    """Regexes of the SPDX entries and of the LT entries of the catalogues together, with expanded macros, without empty ones."""
    parsed = signatures.parse_catalogue(_catalogue(spark, d)).where("str_regex <> ''")
    one = lambda family: parsed.where(F.col("family") == family).select("license", F.lit(family).alias("family"), T.expand_macros(F.col("str_regex")).alias("regex"))
    return one("SPDX").unionByName(one("LT"))


@query
def sig_scan(spark, d):
    """Which signatures match which fragments and generated files."""
    r = rules(spark, d).where(T.strip(F.col("regex")) != "").select("regex_id", signatures.scan_form(F.col("regex")).alias("regex")).where("regex <> ''")
    texts = wide(files)(spark, d).select("file_id", "content").unionByName(wide(generated)(spark, d).select("file_id", "content"))
    return signatures.scan(texts, r, "file_id", "content", "regex_id", "regex")


def _sentence_signatures(spark, d):
    """A signature of each sentence of the licence texts: its third and fourth word; the KEY is its last word or a year, or there is none."""
    rows = licenses(spark, d).where("license IS NOT NULL AND text IS NOT NULL").select("license", F.explode(T.sentences(F.col("text"))).alias("s"))
    words = rows.select("license", F.split(T.for_scan(F.col("s")), " ").alias("w")).where(F.size("w") >= 6)
    plain = words.where(F.array_join(F.slice("w", 1, 4), "").rlike("^[a-z]+$") & F.element_at("w", -1).rlike("^[a-z]+$"))
    last = F.element_at("w", -1)
    two = F.concat(F.lit("\\<"), F.get("w", F.lit(2)), F.lit(" "), F.get("w", F.lit(3)), F.lit("s?\\>"))
    free = F.length(last) % 2 == 0
    return plain.select(two.alias("regex"), F.when(free, F.concat(F.lit("("), last, F.lit("|=YEAR=)"))).alias("key_regex")).distinct().withColumn("signature", F.concat_ws("/", "regex", "key_regex"))


@query
def sig_scan_keys(spark, d):
    """Which signatures drawn from the licence texts' sentences match which documents and generated files: KEY in the raw text, then STR."""
    texts = wide(docs)(spark, d).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("text"))
    texts = texts.unionByName(wide(generated)(spark, d).select(F.concat(F.lit("f"), F.col("file_id").cast("string")).alias("id"), F.col("content").alias("text")))
    return signatures.scan(texts, _sentence_signatures(spark, d), "id", "text", "signature", "regex", "key_regex")


@query
def license_scores(spark, d):
    """How many signatures each document shows, and what that says by the catalogue's limits."""
    found = signatures.match_counts(wide(docs)(spark, d), _sentence_signatures(spark, d), "doc_id", "text", "signature", "regex", "key_regex")
    scored = docs(spark, d).select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("score"))
    return scored.withColumn("verdict", signatures.score_class(F.col("score")))


@query
def union_regexes(spark, d):
    """Regexes as they are and with their macros expanded, by label."""
    r = rules(spark, d).where("licenses IS NOT NULL AND regex IS NOT NULL AND trim(regex) <> ''").select("licenses", T.unquote(F.col("regex")).alias("regex"))
    return r.unionByName(r.select("licenses", T.expand_macros(F.col("regex")).alias("regex")))


@query
def augment_fragment(spark, d):
    """Fragments with each expansion of their label appended."""
    base = files(spark, d).where("content <> ''").select("file_id", "dirname", "content")
    # Regexes of labels that no fragment has are not expanded: nothing would meet them.
    asked = rules(spark, d).join(files(spark, d).select(F.col("dirname").alias("licenses")).distinct(), "licenses", "left_semi")
    return gen.augment(base, expansion_lists(asked, licenses(spark, d)).withColumnRenamed("licenses", "dirname"), "dirname", "content").select("file_id", "augmented")


@query
def augment_cross(spark, d):
    """Paragraphs of the licence texts with each expansion of their licence."""
    pieces = fr.paragraph_rows(licenses(spark, d).select("license", "source", "text").where("license IS NOT NULL"))
    return gen.augment(pieces, expansion_lists(rules(spark, d), licenses(spark, d)).withColumnRenamed("licenses", "license"), "license", "fragment", " ").select("license", "source", "pos", "augmented")


@query
def regex_sample(spark, d):
    """Up to eleven strings that each regex matches."""
    r = rules(spark, d).where("regex IS NOT NULL").select("regex_id", T.expand_macros(T.unquote(F.col("regex"))).alias("regex"))
    return sampling.sample_regexes(r, "regex").select("regex_id", "rank", "expansion")


@query
def regex_language(spark, d):
    """All strings of the regexes without wildcards: their languages are finite and small."""
    r = rules(spark, d).select("regex_id", T.unquote(F.col("regex")).alias("regex")).where((F.col("regex") != "") & (T.wildcard_kind(F.col("regex")) == "none"))
    return sampling.sample_regexes(r, "regex").select("regex_id", "expansion")


@query
def label_counts(spark, d):
    """Files by label."""
    return lab.label_counts(files(spark, d), "dirname")


@query
def label_collisions(spark, d):
    """Contents under several labels."""
    return lab.label_collisions(files(spark, d), "dirname", "content").select(F.col("content"), "labels", "rows")


@query
def chunk_assign(spark, d):
    """Even chunks of the documents by id."""
    return lab.chunk_assign(docs(spark, d).select("doc_id"), ["doc_id"], 6)


@query
def thirds_assign(spark, d):
    """Thirds of the documents by id."""
    return lab.thirds_assign(docs(spark, d).select("doc_id"), ["doc_id"])


@query
def first_fragments(spark, d):
    """The first hundred fragments of each label by number (the operator's limit)."""
    return lab.first_rows(files(spark, d).select("dirname", "seq", "file_id"), ["dirname"], ["seq", "file_id"], 100)


@query
def json_field(spark, d):
    """Fields of the events' JSON column."""
    e = read_table(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.size(F.json_object_keys("props")).alias("keys"))


@query
def sink_by_license(spark, d):
    """Texts written below one folder a licence, read back and counted."""
    path = new_path(spark, "by-license")
    catalogs.write_by_license(licenses(spark, d).where("license IS NOT NULL AND text IS NOT NULL").select("license", "text"), path)
    return spark.read.schema("text STRING, license STRING").parquet(path).groupBy("license").agg(F.count("*").alias("texts"), F.sum(F.length("text")).alias("chars"))


def queries() -> dict[str, Query]:
    """All queries of the core by name."""
    return dict(_ALL)
