"""Landed feed files: zipped or plain, headerless, tab-separated."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvault.constants import PANDAS_NA_VALUES, RAW_WIDTH
from newsvault.schemas import RAW27

_CHUNK_LINES = 20_000
_BAD_CHAR = "�"


def read_tsv(spark: SparkSession, path: str | list[str], name_glob: str | None = None,
             with_source: bool = True) -> DataFrame:
    """27 text columns per line.

    Quoting is off, so one line is one record whatever quotes it holds. Short lines get a
    NULL tail. Unreadable or vanished files are skipped (see ``file_states``).
    """
    reader = (spark.read.schema(RAW27)
              .option("sep", "\t").option("header", False).option("quote", "")
              .option("mode", "PERMISSIVE").option("encoding", "UTF-8")
              .option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True))
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    raw = reader.csv(path)
    return with_source_file(raw) if with_source else raw


def with_source_file(df: DataFrame) -> DataFrame:
    """Adds the path of the file each row came from."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"))


def read_lines(spark: SparkSession, path: str | list[str],
               name_glob: str | None = None) -> DataFrame:
    """(source_file, line) of plain feed files, for width checks."""
    reader = (spark.read.option("ignoreCorruptFiles", True)
              .option("ignoreMissingFiles", True))
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return with_source_file(reader.text(path)).select(
        "source_file", F.col("value").alias("line"))


def _unzip_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams the lines of the first member of each archive, in bounded chunks.

    Whatever is wrong with an archive (no zip at all, a damaged stream or checksum, a password,
    an unknown compression) becomes an error row of that archive and ends no other one.
    """
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            name = path.as_py()
            lines: list[str | None] = []
            done = 0
            try:
                archive = zipfile.ZipFile(io.BytesIO(content.as_buffer()))
                names = archive.namelist()
                if not names:
                    raise zipfile.BadZipFile("no member")
                with archive.open(names[0]) as member:
                    for raw in member:
                        lines.append(raw.rstrip(b"\r\n").decode("utf-8", errors="ignore"))
                        if len(lines) >= _CHUNK_LINES:
                            yield _line_batch(name, done, lines, None)
                            done, lines = done + len(lines), []
                yield _line_batch(name, done, lines, None)
            except GeneratorExit:
                raise
            except Exception as broken:
                yield _line_batch(name, done, lines, None)
                kind = "not a readable zip archive" if isinstance(broken, zipfile.BadZipFile) \
                    and not lines else "damaged archive"
                yield _line_batch(name, done + len(lines), [None], f"{kind}: {broken}")


def _line_batch(name: str, done: int, lines: list, error: str | None) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([name] * len(lines), pa.string()),
         pa.array(range(done + 1, done + len(lines) + 1), pa.int64()), pa.array(lines, pa.string()),
         pa.array([error] * len(lines), pa.string())],
        names=["source_file", "line_no", "line", "error"])


def read_zip_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source_file, line_no, line, error) of zipped feed files.

    Python only unpacks; splitting happens in the JVM. A scan partition holds archives of
    ``spark.sql.files.maxPartitionBytes`` at most (or one larger one), which bounds what a
    worker receives at once; lines leave it in chunks.
    """
    archives = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
                .load(path).select("path", "content"))
    return archives.mapInArrow(_unzip_lines, "source_file string, line_no long, line string, error string")


def archive_outcomes(listing: DataFrame, lines: DataFrame) -> DataFrame:
    """(source_file, bytes, n_lines, error) of every listed archive; an empty one gave no rows at all."""
    seen = (lines.groupBy(_plain_path(F.col("source_file")).alias("_p"))
            .agg(F.count("line").alias("n_lines"), F.max("error").alias("error")))
    error = F.when(F.col("bytes") == 0, "empty file").otherwise(F.col("error"))
    return (listing.withColumn("_p", _plain_path(F.col("source_file"))).join(seen, "_p", "left")
            .select("source_file", "bytes", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), error.alias("error")))


def split_lines(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Lines to the 27 raw columns; short lines get a NULL tail, empty text is NULL."""
    parts = F.split(F.col("line"), "\t", -1)
    fields = [F.nullif(F.get(parts, F.lit(i)), F.lit("")).alias(f"_c{i}")
              for i in range(RAW_WIDTH)]
    return lines.where("line IS NOT NULL AND line <> ''").select(
        *fields, "source_file", *(keep or []))


def read_zip(spark: SparkSession, path: str) -> DataFrame:
    """Zipped feed files as 27 text columns plus ``source_file``."""
    return split_lines(read_zip_lines(spark, path))


def check_width(lines: DataFrame, width: int = RAW_WIDTH) -> DataFrame:
    """Adds ``fields`` and ``width_ok`` to every line; nothing is dropped."""
    fields = F.size(F.split(F.col("line"), "\t", -1))
    return lines.withColumns({"fields": fields, "width_ok": fields == width})


def _fields() -> Column:
    return F.size(F.split(F.col("line"), "\t", -1))


def accepted_lines(lines: DataFrame, width: int = RAW_WIDTH, allow_short: bool = True) -> DataFrame:
    """Lines that fit the columns. A short line ends in missing values if ``allow_short``; a longer
    one would lose its tail and is left to ``rejected_lines``."""
    return lines.where((_fields() <= width) if allow_short else (_fields() == width))


def rejected_lines(lines: DataFrame, width: int = RAW_WIDTH, allow_short: bool = True) -> DataFrame:
    """The other lines, whole, with the number of their fields, the reason and what tells their place."""
    fits = (F.col("fields") <= width) if allow_short else (F.col("fields") == width)
    reason = F.concat(F.lit(f"expected {width} fields, found "), F.col("fields").cast("string"))
    place = [c for c in lines.columns if c not in ("line", "error")]
    return (lines.where("line IS NOT NULL AND line <> ''").withColumn("fields", _fields()).where(~fits)
            .select(*place, "fields", reason.alias("reason"), "line"))


def require_width(lines: DataFrame, width: int = RAW_WIDTH) -> DataFrame:
    """Lines as they are; the job fails at the first one of another width."""
    fields = F.size(F.split(F.col("line"), "\t", -1))
    message = F.concat(F.lit(f"expected {width} fields, found "), fields.cast("string"))
    return lines.withColumn(
        "line", F.when(fields == width, F.col("line")).otherwise(F.raise_error(message)))


def blank_na(df: DataFrame, columns: list[str],
             na_values: list[str] = PANDAS_NA_VALUES) -> DataFrame:
    """Texts that stand for a missing value become NULL in the named columns."""
    return df.withColumns(
        {c: F.when(~F.col(c).isin(na_values), F.col(c)) for c in columns})


def drop_bad_chars(df: DataFrame, columns: list[str]) -> DataFrame:
    """Removes what the reader put in place of undecodable bytes."""
    return df.withColumns({c: F.translate(F.col(c), _BAD_CHAR, "") for c in columns})


def _plain_path(c: Column) -> Column:
    return F.regexp_replace(c, r"^file:/+", "/")


def listed_files(spark: SparkSession, path: str | list[str], name_glob: str | None = None) -> DataFrame:
    """(source_file, bytes) of a folder without reading contents.

    Scans leave empty files out, so the names come from the reader's own file list, which
    the driver holds anyway, and the sizes from a scan.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    found = reader.load(path)
    names = spark.createDataFrame([(n,) for n in found.inputFiles()], "source_file string")
    sizes = found.select(_plain_path(F.col("path")).alias("_p"), F.col("length").alias("bytes"))
    return (names.select(_plain_path(F.col("source_file")).alias("_p"), "source_file")
            .join(sizes, "_p", "left")
            .select("source_file", F.coalesce("bytes", F.lit(0)).alias("bytes")))


def file_coverage(spark: SparkSession, path: str | list[str], name_glob: str | None = None) -> DataFrame:
    """(source_file, bytes, n_lines, bytes_read) of every plain file that gave a line.

    Lines end in a newline only, so their bytes add up to the file's length if it was read to its
    end, and to one more if its last line has no end.
    """
    reader = (spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)
              .option("ignoreMissingFiles", True))
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return (reader.text(path)
            .groupBy(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("bytes"))
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum(F.octet_length("value") + 1).alias("bytes_read")))


def file_states(listing: DataFrame, coverage: DataFrame) -> DataFrame:
    """(source_file, bytes, n_lines, state) of every listed file: complete, cut (its last line has no
    end), partly read, unread or empty."""
    seen = coverage.select(_plain_path(F.col("source_file")).alias("_p"), "n_lines", "bytes_read")
    n, read = F.coalesce("n_lines", F.lit(0)), F.coalesce("bytes_read", F.lit(0))
    state = (F.when(F.col("bytes") == 0, "empty").when(n == 0, "unread")
             .when(read == F.col("bytes"), "complete").when(read == F.col("bytes") + 1, "cut")
             .otherwise("partly read"))
    return (listing.withColumn("_p", _plain_path(F.col("source_file"))).join(seen, "_p", "left")
            .select("source_file", "bytes", n.alias("n_lines"), state.alias("state")))
