"""Random access to files from inside tasks: listing on Spark, byte ranges in the Python worker."""

from __future__ import annotations

import io
from typing import BinaryIO, Sequence
from urllib.parse import unquote, urlsplit

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: stores that a Python worker can open by itself; others are read through Spark's readers
SCHEMES = ("", "file", "hdfs", "s3", "s3a", "gs")


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, file, length): every file, from the listing alone; ``file`` is named as readers' ``_metadata`` does."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", F.col("_metadata.file_path").alias("file"), "length")


def can_open(path: str) -> bool:
    return urlsplit(path).scheme in SCHEMES


def open_ranged(path: str) -> BinaryIO:
    """A seekable file; reading fetches only what is asked for."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path) if parts.scheme == "file" and path.startswith("file:///") else path.removeprefix("file:"), "rb")
    store, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return store.open_input_file(name)


class Range(io.RawIOBase):
    """``length`` bytes of an open file from ``start`` as a file of its own."""

    def __init__(self, file: BinaryIO, start: int, length: int):
        self.file, self.start, self.length, self.at = file, start, length, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = max(0, offset + (0, self.at, self.length)[whence])
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, buffer) -> int:
        want = max(0, min(len(buffer), self.length - self.at))
        self.file.seek(self.start + self.at)
        data = self.file.read(want)
        buffer[:len(data)] = data
        self.at += len(data)
        return len(data)


def first_line(file: BinaryIO, step: int = 1 << 16) -> bytes:
    """The first line with content, read in steps until it ends."""
    held, data = b"", file.read(step)
    while data:
        held += data
        *whole, held = held.replace(b"\r\n", b"\n").split(b"\n")
        for line in whole:
            if line.strip(b"\xef\xbb\xbf \t\r"):
                return line
        data = file.read(step)
    return held if held.strip(b"\xef\xbb\xbf \t\r") else b""
