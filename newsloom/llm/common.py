"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Word characters are ASCII letters and digits and everything beyond ASCII. In UTF-8 every byte of
# a character beyond ASCII is at least 0x80, so one byte table lower-cases and separates.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_held: dict[str, Callable[[], None]] = {}


def hold_for(operator: str, release: Callable[[], None]) -> None:
    """A worker process, which Spark uses for one stage after another, holds the tables of one operator: others' go."""
    for other in [name for name in _held if name != operator]:
        _held.pop(other)()
    _held[operator] = release


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z in lower case. Null has none."""
    return text.translate(FOLD).split() if text else []


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay. A text of ASCII alone takes the faster function."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_LOWER))


def word_array(text: Column) -> Column:
    """The words of ``words_of`` as a column, JVM-side. Null has none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.array_remove(parts, "")


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """Values of a string column as UTF-8, without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def pieces(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20, max_rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``max_bytes`` of the column and ``max_rows`` each; one long text is a slice of its own."""
    sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)], dtype=np.int64) \
        if batch.num_rows else np.zeros(0, dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (total + size > max_bytes or i - start == max_rows):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % by


def share(bound: int) -> Column:
    """Of a frame with a column ``n_rows`` beside each row's key: the kept share, in 2**32 steps."""
    return F.least(F.lit(1.0), F.lit(float(bound)) / F.col("n_rows")) * float(1 << 32)


def hash_share(*columns: Column | str) -> Column:
    """A seeded hash of the columns, evenly spread over 0 .. 2**32 - 1."""
    return F.xxhash64(F.lit(7919), *columns).bitwiseAND(F.lit((1 << 32) - 1))
