"""Binary files in the shared folder, written and read by tasks.

Paths are URIs or absolute paths that ``pyarrow.fs`` knows on every executor. A task gives each
file a name of its own; only files that a finished task reports count, so a task that is repeated
after a lost executor leaves at most a file that nobody reads.
"""

from __future__ import annotations

import uuid

import zstandard
from pyarrow import fs


def create(folder: str, ending: str) -> tuple[str, object]:
    """A new file's path and its open stream. Bytes are written as they are, whatever the ending."""
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{ending}"
    where, local = fs.FileSystem.from_uri(path)
    where.create_dir(local.rpartition("/")[0], recursive=True)
    return path, where.open_output_stream(local, compression=None)


def open_stream(path: str):
    where, local = fs.FileSystem.from_uri(path)
    return where.open_input_stream(local, compression=None)


def open_random(path: str):
    where, local = fs.FileSystem.from_uri(path)
    return where.open_input_file(local)


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A Zstandard dictionary of at most ``size`` bytes; empty where the samples are too few or too alike."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def codec(dictionary: bytes, level: int) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    if not dictionary:
        return zstandard.ZstdCompressor(level=level), zstandard.ZstdDecompressor()
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=shared), zstandard.ZstdDecompressor(dict_data=shared)
