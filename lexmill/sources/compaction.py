"""Problem 2: many tiny files become few of good size, each record once, joined as bytes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.runtime import new_path

_FRAME = b"\x28\xb5\x2f\xfd"  # a zstandard frame's first bytes
#: A whole record line once its strings are each a mark: an object of strings, numbers and words, closed where it ends.
_WHOLE = r"^\s*\{\s*(?:s\s*:\s*(?:s|[-+.\w]+)\s*(?:,\s*(?=s)|(?=\})))*\}\s*$"
#: The key of a record: a quote inside a text is escaped, so no text can show this.
_KEY = r'(?<!\\)"file_id"\s*:\s*(-?\d+)\s*[,}]'


def _closed(line: Column) -> Column:
    """Whether a line is a whole object, told by its quotes and braces: escaped characters go, then each string becomes a mark."""
    bare = F.replace(F.replace(line, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    return F.regexp_replace(bare, '"[^"]*"', "s").rlike(_WHOLE)


def payload_lines(files: DataFrame, key: str = _KEY) -> DataFrame:
    """(``file_path``, ``landed_at``, ``line_no``, ``raw``, ``line``, ``key``, ``kind``): the lines of all payloads, cut at line feeds.

    ``kind``: blank; complete (closed by a line feed or a whole record without one); torn (what a transfer that broke
    off has left, and lines without key). Lines aren't parsed: where a line ends is told by its boundary, a missing line
    feed by the form of the bytes, and the key is picked from the bytes. A carriage return before a line feed isn't
    part of a line.
    """
    cut = files.select("landed_at", "file_path", F.posexplode(F.split("payload", "\n")).alias("line_no", "raw"), F.size(F.split("payload", "\n")).alias("_n"))
    cut = cut.withColumn("line", F.regexp_replace("raw", "\r$", "")).withColumn("key", F.regexp_extract("line", key, 1).try_cast("bigint"))
    # A break can be covered by a later line feed, so a line must close its object either way.
    closed = _closed(F.col("line"))
    kind = F.when(F.trim("line") == "", "blank").when(F.col("key").isNotNull() & closed, "complete").otherwise("torn")
    return cut.select("file_path", "landed_at", "line_no", "raw", "line", "key", kind.alias("kind"), (F.col("line_no") < F.col("_n") - 1).alias("fed"))


def _tally(line: str = "line") -> list:
    return [F.count("*").alias("records"), F.coalesce(F.sum(F.octet_length(line)), F.lit(0)).alias("bytes"), F.coalesce(F.sum(F.crc32(line)), F.lit(0)).alias("checksum")]


def source_tally(files: DataFrame) -> dict[str, int]:
    """What the source files hold: files, bytes, files whose length isn't the one recorded, and lines and bytes by kind; the number of different keys and their checksum."""
    whole = files.agg(
        F.count("payload").alias("files"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("source_bytes"),
        F.count(F.when(F.octet_length("payload") != F.col("n_bytes"), 1)).alias("wrong_length"),
    ).first().asDict()
    lines = payload_lines(files)
    ends = F.octet_length("raw") - F.octet_length("line") + F.col("fed").cast("int")
    n = lambda kind: F.count(F.when(F.col("kind") == kind, 1)).alias(f"{kind}_lines")
    size = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.octet_length("line"))), F.lit(0)).alias(f"{kind}_bytes")
    by_kind = lines.agg(*(f(k) for k in ("complete", "torn", "blank") for f in (n, size)), F.coalesce(F.sum(ends), F.lit(0)).alias("end_bytes")).first().asDict()
    keys = lines.where("kind = 'complete'").select("key").distinct().agg(F.count("*").alias("keys"), F.coalesce(F.sum(F.crc32(F.col("key").cast("string"))), F.lit(0)).alias("key_checksum")).first().asDict()
    return whole | by_kind | keys


def consolidate(files: DataFrame, target_bytes: int = 128 << 20, path: str | None = None, header: str | None = None) -> tuple[str, DataFrame]:
    """Write every landed record once, in files of about ``target_bytes``; gives the folder and a row of validation.

    Payloads are joined as bytes at their line boundaries: no record is parsed or written anew. The first landed copy of
    a key is kept, byte for byte, as one line; one shuffle by key both drops repeated records and joins the lines of an output
    file, and repeats are cut before it (a group limit on each side of the shuffle). ``header``: a line that every output file
    begins with.

    The validation row is worked out from the source by itself and from what is read back. It is ``valid`` if the lines'
    bytes by kind and the line ends add up to the source files' bytes, if the keys read back are those of the
    source's complete lines, each once (number and checksum), and if the bytes and CRC-32 sums read back are those
    that were written. ``wrong_length`` tells of source files whose length isn't the one recorded with them. Null and
    empty payloads hold no record; files listed twice, sent again in part or torn are allowed; an empty table writes
    no record.
    """
    from pyspark.sql import Observation

    spark = files.sparkSession
    out = path or new_path(spark, "consolidated")
    source = source_tally(files)
    count = max(1, math.ceil(source["complete_bytes"] / target_bytes))
    order = Window.partitionBy("key").orderBy(F.col("landed_at").asc_nulls_last(), "file_path", "line_no")
    complete = payload_lines(files).where("kind = 'complete'").select("key", "line", "landed_at", "file_path", "line_no")
    lines = complete.repartition(count, "key").withColumn("_n", F.row_number().over(order)).where("_n = 1").select("line")
    seen = Observation()
    # Counted while it is written, so that nothing is read twice.
    to_write = lines.observe(seen, *_tally())
    if header is not None:

        def with_header(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            first = True
            for pdf in batches:
                if first:
                    yield pd.DataFrame({"line": [header]})
                    first = False
                yield pdf

        to_write = to_write.mapInPandas(with_header, "line string")
    to_write.write.option("lineSep", "\n").text(out)
    written = seen.get
    back = read_consolidated(spark, out)
    if header is not None:
        back = back.where(F.col("line") != header)
    key = F.regexp_extract("line", _KEY, 1).try_cast("bigint")
    got = back.agg(*_tally(), F.coalesce(F.sum(F.crc32(key.cast("string"))), F.lit(0)).alias("_keys"))
    balanced = source["source_bytes"] == source["complete_bytes"] + source["torn_bytes"] + source["blank_bytes"] + source["end_bytes"]
    same = [F.col(c) == F.lit(written[c]) for c in ("records", "bytes", "checksum")] + [F.col("records") == F.lit(source["keys"]), F.col("_keys") == F.lit(source["key_checksum"]), F.lit(balanced)]
    valid = same[0]
    for more in same[1:]:
        valid = valid & more
    told = [F.lit(source[c]).cast("bigint").alias(c) for c in ("files", "source_bytes", "wrong_length", "complete_lines", "torn_lines", "torn_bytes", "blank_lines")]
    return out, got.select("records", "bytes", "checksum", valid.alias("valid"), F.lit(count).alias("most_files"), *told)


def read_consolidated(spark, path: str) -> DataFrame:
    """(``line``): the records of a consolidated folder."""
    return spark.read.option("lineSep", "\n").schema("line STRING").text(path)


def consolidated_records(files: DataFrame, target_bytes: int = 128 << 20) -> DataFrame:
    """Consolidate, validate, and give the records as read back: ``file_id``, ``dirname``, ``content``."""
    path, result = consolidate(files, target_bytes)
    if not result.first()["valid"]:
        raise RuntimeError("the consolidated files differ from what was written")
    return read_consolidated(files.sparkSession, path).select(F.from_json("line", "file_id BIGINT, dirname STRING, content STRING").alias("r")).select("r.*")


def join_frames(parts: list[bytes]) -> bytes:
    """Join complete zstandard frames as bytes; empty parts go, anything that isn't a run of whole frames is refused."""
    import zstandard

    out = bytearray()
    for part in parts:
        rest = part
        while rest:
            if rest[:4] != _FRAME:
                raise ValueError("not a zstandard frame")
            reader = zstandard.ZstdDecompressor().decompressobj()
            reader.decompress(rest)
            if not reader.eof:
                raise ValueError("a torn zstandard frame")
            done = len(rest) - len(reader.unused_data)
            out += rest[:done]
            rest = rest[done:]
    return bytes(out)


def split_frames(frames: DataFrame, payload: str = "payload") -> DataFrame:
    """What joined frames hold: adds ``n_bytes`` and ``n_lines`` of the contents, read as a stream, so that no content is held whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import zstandard

        for pdf in batches:
            sizes, lines = [], []
            for raw in pdf[payload].array:
                size = count = 0
                with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(bytes(raw)), read_across_frames=True) as stream:
                    while piece := stream.read(1 << 20):
                        size, count = size + len(piece), count + piece.count(b"\n")
                sizes.append(size)
                lines.append(count)
            yield pdf.drop(columns=payload).assign(n_bytes=sizes, n_lines=lines)

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema.fields if f.name not in (payload, "n_bytes", "n_lines")]
    chosen = frames.drop("n_bytes", "n_lines")
    return chosen.mapInPandas(run, ", ".join([*kept, "n_bytes long", "n_lines long"]))


def as_frames(files: DataFrame, payload: str = "payload") -> DataFrame:
    """(``file_path``, ``payload``): each text payload as one zstandard frame; null and empty ones go."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        for pdf in batches:
            yield pdf.assign(payload=[zstandard.ZstdCompressor().compress(t.encode("utf-8", "surrogatepass")) for t in pdf["payload"].array])

    return files.where(F.length(payload) > 0).select("file_path", F.col(payload).alias("payload")).mapInPandas(run, "file_path string, payload binary")


def join_frame_files(files: DataFrame, target_bytes: int = 128 << 20, payload: str = "payload") -> DataFrame:
    """Few rows of joined frames out of many small binary ones: (``bucket``, ``n_files``, ``n_bytes``, ``crc``, ``payload``).

    Files are cut into buckets by a hash of their path so that a bucket holds about ``target_bytes``; a task holds one
    bucket's bytes. Torn files raise an error, null and empty ones hold nothing.
    """
    import zlib

    total = files.agg(F.sum(F.octet_length(payload))).first()[0] or 0
    count = max(1, math.ceil(total / target_bytes))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        joined = join_frames([bytes(p) for p in pdf.sort_values("file_path")["payload"]])
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "n_files": [len(pdf)], "n_bytes": [len(joined)], "crc": [zlib.crc32(joined)], "payload": [joined]})

    cut = files.where(F.octet_length(payload) > 0).select("file_path", F.col(payload).alias("payload"), F.pmod(F.xxhash64("file_path"), F.lit(count)).alias("bucket"))
    return cut.groupBy("bucket").applyInPandas(run, "bucket long, n_files long, n_bytes long, crc long, payload binary")
