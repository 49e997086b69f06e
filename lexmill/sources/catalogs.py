"""Readers and writers of catalogues, folders of texts, regex tables and fragments."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.escapes import decode_escapes


def read_array_catalogue(spark: SparkSession, path: str, name: str = "rf_shortname", text: str = "rf_text", source: str = "licenseref") -> DataFrame:
    """(``license``, ``source``, ``text``) of a JSON array of objects."""
    rows = spark.read.schema(f"`{name}` STRING, `{text}` STRING").json(path, multiLine=True)
    return rows.select(F.col(name).alias("license"), F.lit(source).alias("source"), F.col(text).alias("text"))


def read_list_catalogue(spark: SparkSession, path: str, details: str, name: str = "licenseId", text: str = "licenseText", array: str = "licenses", source: str = "spdx") -> DataFrame:
    """(``license``, ``source``, ``text``): a JSON list joined with its detail files by id; entries without detail have a null text."""
    listed = spark.read.schema(f"`{array}` ARRAY<STRUCT<`{name}`: STRING>>").json(path, multiLine=True).select(F.explode(array).alias("e")).select(F.col(f"e.{name}").alias("license"))
    detail = spark.read.schema(f"`{name}` STRING, `{text}` STRING").json(details, multiLine=True).select(F.col(name).alias("license"), F.col(text).alias("text"))
    return listed.join(detail, "license", "left").select("license", F.lit(source).alias("source"), "text")


def exception_urls(spark: SparkSession, path: str, base: str, array: str = "exceptions", reference: str = "reference", name: str = "licenseExceptionId") -> DataFrame:
    """(``license``, ``url``) of a JSON list of exceptions; a leading ``./`` stands for the base."""
    rows = spark.read.schema(f"`{array}` ARRAY<STRUCT<`{reference}`: STRING, `{name}`: STRING>>").json(path, multiLine=True).select(F.explode(array).alias("e"))
    return rows.select(F.col(f"e.{name}").alias("license"), T.absolute_url(F.col(f"e.{reference}"), base).alias("url"))


def read_exceptions(spark: SparkSession, path: str, base: str, details: str, name: str = "licenseExceptionId", text: str = "licenseExceptionText", source: str = "exceptions") -> DataFrame:
    """(``license``, ``source``, ``url``, ``text``): a JSON list of exceptions joined with its detail files by id; without detail the text is null."""
    detail = spark.read.schema(f"`{name}` STRING, `{text}` STRING").json(details, multiLine=True).select(F.col(name).alias("license"), F.col(text).alias("text"))
    return exception_urls(spark, path, base, name=name).join(detail, "license", "left").select("license", F.lit(source).alias("source"), "url", "text")


def read_text_dict(spark: SparkSession, path: str, source: str = "dict") -> DataFrame:
    """(``license``, ``source``, ``text``) of one JSON object of texts by id."""
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("license", "text"))
    return whole.select("license", F.lit(source).alias("source"), "text")


def read_text_folder(spark: SparkSession, path: str, only_txt: bool = True, decode: bool = True) -> DataFrame:
    """(``path``, ``license``, ``text``) of every file below a folder; ``.txt`` in any case if ``only_txt``; escapes decoded."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if only_txt:
        reader = reader.option("pathGlobFilter", "*.[tT][xX][tT]")
    rows = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return rows.select("path", T.label_of_path(F.col("path")).alias("license"), (decode_escapes(F.col("text")) if decode else F.col("text")).alias("text"))


def read_regex_table(spark: SparkSession, path: str) -> DataFrame:
    """(``license``, ``regex``) of a CSV with a header of two columns."""
    return spark.read.schema("license STRING, regex STRING").csv(path, header=True, escape='"', multiLine=True, enforceSchema=True)


def read_catalogue_lines(spark: SparkSession, path: str) -> DataFrame:
    """(``doc``, ``line``, ``value``): a signature catalogue by line, ready to parse; each file is one document."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc"), F.posexplode(F.split(T.newlines(F.col("value")), "\n", -1)).alias("line", "value"))
    return rows.withColumn("line", F.col("line") + 1)


def write_by_license(df: DataFrame, path: str, label: str = "license") -> None:
    """Parquet below one folder a licence; rows are brought together by label first, so that files stay few."""
    df.repartition(label).write.mode("overwrite").partitionBy(label).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_fragment_files(df: DataFrame, root: str, label: str = "license", seq: str = "seq", text: str = "fragment") -> DataFrame:
    """Write ``<label>/<label>-<seq>.txt`` files in UTF-8 from the tasks, to any file system pyarrow knows; gives (``path``, ``n_bytes``).

    A repeated task writes the same files again. The result is lazy: it must be counted or written to run.
    """

    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(root)
        for pdf in batches:
            paths, sizes = [], []
            for lab, k, body in zip(pdf[label].array, pdf[seq].array, pdf[text].array):
                folder = PurePosixPath(base) / str(lab).replace("/", "_")
                target.create_dir(str(folder), recursive=True)
                name, raw = f"{folder}/{folder.name}-{k}.txt", (body or "").encode()
                with target.open_output_stream(name) as out:
                    out.write(raw)
                paths.append(name)
                sizes.append(len(raw))
            yield pd.DataFrame({"path": paths, "n_bytes": sizes})

    return df.select(label, seq, text).mapInPandas(run, "path string, n_bytes long")
