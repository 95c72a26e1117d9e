"""Writes the demonstration feed as the files a feed server would have landed."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvault.constants import FEED_FILE_SUFFIX, RAW_WIDTH


def _tsv_line() -> list:
    return [F.coalesce(F.col(f"_c{i}"), F.lit("")) for i in range(RAW_WIDTH)]


def write_drop(raw: DataFrame, path: str) -> None:
    """Adds plain TSV files to a folder."""
    (raw.select(F.concat_ws("\t", *_tsv_line()).alias("value"))
     .write.mode("append").text(path))


class _Sink(io.RawIOBase):
    """Forward-only file object over an Arrow output stream, which zipfile can write to."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(data)
        return len(data)


def write_zip_drop(raw: DataFrame, path: str) -> int:
    """Adds zipped TSV files to a folder (see ``write_zip_lines``)."""
    return write_zip_lines(raw.select(F.concat_ws("\t", *_tsv_line()).alias("value")), path)


def tsv_line(width: int = RAW_WIDTH):
    """A record's line; with another width its last fields are missing or empty ones follow."""
    return F.concat_ws("\t", *_tsv_line()[:width], *[F.lit("more")] * (width - RAW_WIDTH))


def write_zip_lines(lines: DataFrame, path: str) -> int:
    """Adds zip files of lines to a folder, one per partition, streamed; returns their number.

    Files are named by partition, so a repeated task replaces its own file.
    """
    stem = uuid.uuid4().hex[:12]

    def write_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        files, folder = fs.FileSystem.from_uri(path.removeprefix("file:"))
        files.create_dir(folder, recursive=True)
        part = TaskContext.get().partitionId()
        with (files.open_output_stream(f"{folder}/{stem}-{part}{FEED_FILE_SUFFIX}") as out,
              zipfile.ZipFile(_Sink(out), "w", zipfile.ZIP_DEFLATED) as archive,
              archive.open("feed.csv", "w", force_zip64=True) as member):
            for batch in chain([first], batches):
                member.write("".join(f"{v}\n" for v in batch.column(0).to_pylist()).encode())
        yield pa.record_batch([pa.array([1], pa.int64())], names=["n"])

    return lines.select("value").mapInArrow(write_partition, "n long").agg(
        F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def put_file(spark: SparkSession, path: str, content: bytes) -> None:
    """A file of these bytes, wherever the path lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def cut_archive(lines: list[str]) -> bytes:
    """An archive whose compressed stream is damaged from its first byte on."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("feed.csv", "\n".join(lines))
        start = archive.infolist()[0]
    raw = bytearray(buffer.getvalue())
    at = 30 + len(start.filename)                     # after the local header and the name
    raw[at:at + 4] = b"\xff\xff\xff\xff"
    return bytes(raw)
