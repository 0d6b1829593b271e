"""Token ids as binary files with a shared Zstandard dictionary.

A store is a folder with one dictionary, trained on serialised id arrays, and data files:

    "TOKSTOR1" | frames | index | footer

Each frame is one document's ids, little-endian unsigned 32-bit, compressed on its own. The index
has, per document, ``<q?QQQI``: id, whether it is null, ids before it in the file, number of ids,
offset and length of its frame. The footer ``<QQ32s8s`` has the index's offset, the number of
documents, the dictionary's SHA-256 and the mark again. So one document costs a read of the index
and of its own frame, however long the file is.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsloom.llm.common import as_bytes, hash_share, hold_for, pieces
from newsloom.llm.files import codec, create, open_random, train_dictionary
from newsloom.session import shared_dir, stage

MARK = b"TOKSTOR1"
_ENTRY = struct.Struct("<q?QQQI")
_FOOTER = struct.Struct("<QQ32s8s")
# A full stop or comma that ends a word of letters or digits. Elsewhere it may belong to a longer
# run of marks, which the tokenizer takes as one.
_ODD_STOP = re.compile(rb"[,.](?<![0-9a-z].)(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].)[ \n]")


class WordEncoder:
    """Ids of whole texts by a tokenizer that never joins what white space parts.

    Words are encoded by the library once and remembered; about ``bound`` of them are held
    between texts. ASCII letters are lowered beforehand only where that cannot change the result:
    not beside combining marks, and not where a special token's mark stands in the text.
    """

    def __init__(self, path: str, bound: int = 1_000_000):
        self.tokenizer, self.bound, self.known = Tokenizer.from_file(path), bound, {}
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True

    def words(self, text: bytes) -> list[bytes]:
        if b"\xcc" in text or b"\xcd" in text or b"<|" in text:
            return text.split()
        text = text.lower()
        if not _ODD_STOP.search(text):
            text = text.replace(b", ", b" , ").replace(b". ", b" . ").replace(b".\n", b" .\n").replace(b",\n", b" ,\n")
        return text.split()

    def learn(self, words: set[bytes]) -> None:
        """Words of letters alone are encoded many at a time: each of their codes ends once."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > self.bound:
            self.known.clear()
            new = words
        letters = [w for w in new if w.decode("utf-8", "replace").isalpha()]
        single = list(new.difference(letters))
        for first in range(0, len(letters), 500):
            some = letters[first:first + 500]
            ids = np.array(self.ids([b" ".join(some)])[0], dtype="<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4 if len(ids) else []
            if len(cuts) == len(some):
                codes = ids.tobytes()
                self.known.update((w, codes[a:b]) for w, a, b in zip(some, [0, *cuts.tolist()], cuts.tolist()))
            else:  # some letter becomes more than one piece in lower case
                single += some
        self.known.update(zip(single, (struct.pack(f"<{len(x)}I", *x) for x in self.ids(single))))

    def ids(self, texts: list[bytes]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [f.ids for f in found]

    def encode_all(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. A null text has none."""
        words = [self.words(t) if t else [] for t in texts]
        new = set().union(*words).difference(self.known)
        if new:
            self.learn(set().union(*words) if len(self.known) + len(new) > self.bound else new)
        return [b"".join(map(self.known.__getitem__, w)) for w in words]

    def encode(self, text: bytes | None) -> bytes:
        return self.encode_all([text])[0]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encoder(path: str) -> WordEncoder:
    """One per worker process, which keeps its words from task to task, until another operator's tables take their place."""
    hold_for("words", _encoder.cache_clear)
    return _encoder(path)


class StoreWriter:
    """Files of one task, in the order the documents come; a new file after ``max_bytes``."""

    def __init__(self, folder: str, dictionary: bytes, level: int, max_bytes: int):
        self.folder, self.max_bytes, self.hash = folder, max_bytes, hashlib.sha256(dictionary).digest()
        self.compress, self.file, self.seq = codec(dictionary, level)[0].compress, None, 0

    def add(self, doc_id: int | None, ids: bytes) -> dict | None:
        if self.file is None:
            self.path, self.file = create(self.folder, ".tok")
            self.file.write(MARK)
            self.index, self.offset, self.tokens = [], len(MARK), 0
        frame, n = self.compress(ids), len(ids) // 4
        self.file.write(frame)
        self.index.append(_ENTRY.pack(doc_id or 0, doc_id is None, self.tokens, n, self.offset, len(frame)))
        self.offset, self.tokens = self.offset + len(frame), self.tokens + n
        return self.close() if self.offset >= self.max_bytes else None

    def close(self) -> dict | None:
        if self.file is None:
            return None
        self.file.write(b"".join(self.index))
        self.file.write(_FOOTER.pack(self.offset, len(self.index), self.hash, MARK))
        self.file.close()
        self.file, self.seq = None, self.seq + 1
        return {"path": self.path, "seq": self.seq, "n_docs": len(self.index), "n_tokens": self.tokens,
                "n_bytes": self.offset + len(self.index) * _ENTRY.size + _FOOTER.size}


class StoreReader:
    """One data file. The dictionary must be the one the file was written with."""

    def __init__(self, path: str, dictionary: bytes):
        self.file = open_random(path)
        self.file.seek(self.file.size() - _FOOTER.size)
        self.at, self.n_docs, known, mark = _FOOTER.unpack(self.file.read(_FOOTER.size))
        if mark != MARK:
            raise ValueError(f"{path} is no token file")
        if known != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} was written with another dictionary")
        self.decompress = codec(dictionary, 3)[1].decompress

    def entry(self, i: int) -> tuple:
        self.file.seek(self.at + i * _ENTRY.size)
        return _ENTRY.unpack(self.file.read(_ENTRY.size))

    def document(self, i: int) -> bytes:
        """Ids of the document at place ``i`` of the file, by one read of its frame."""
        *_, offset, length = self.entry(i)
        self.file.seek(offset)
        return self.decompress(self.file.read(length))

    def __iter__(self) -> Iterator[tuple[int | None, int, int, bytes]]:
        """Id, ids before it in the file, number of ids, ids; from first to last."""
        step = 10_000
        for first in range(0, self.n_docs, step):
            n = min(step, self.n_docs - first)
            self.file.seek(self.at + first * _ENTRY.size)
            index = self.file.read(n * _ENTRY.size)
            for doc_id, null, start, count, offset, length in _ENTRY.iter_unpack(index):
                self.file.seek(offset)
                yield None if null else doc_id, start, count, self.decompress(self.file.read(length))


def write_store(
    docs: DataFrame, tokenizer: str, folder: str, text: str = "text", id_col: str = "doc_id", end_id: int | None = 2,
    sample_docs: int = 1000, sample_ids: int = 16_384, dictionary_bytes: int = 65_536, level: int = 3,
    max_file_bytes: int = 256 << 20,
) -> tuple[DataFrame, bytes]:
    """Encode every row, write the store to ``folder``, and return its files and its dictionary.

    Documents lie in ascending order of their integer id, null first, in files whose order is
    ``part, seq``; ``start`` is the number of ids in all earlier files. A null text is empty; each
    document gets ``end_id`` appended. Rows that repeat an id stay, side by side. An empty table
    gives no files. The dictionary is trained on about ``sample_docs`` documents, chosen by a hash,
    of which at most ``sample_ids`` ids each; it has no other effect than the size of the files.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    tail = struct.pack("<I", end_id) if end_id is not None else b""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                ids = [x[:4 * sample_ids] for x in encoder(tokenizer).encode_all(as_bytes(piece.column("text")))]
                yield pa.RecordBatch.from_pydict({"ids": pa.array(ids, pa.binary())})

    kept = float(sample_docs) / max(1, rows.count()) * float(1 << 32)
    samples = rows.where(hash_share("id") < kept).select("text").limit(2 * sample_docs).mapInArrow(draw, "ids binary")
    dictionary = train_dictionary([r.ids for r in samples.collect()], dictionary_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, files = StoreWriter(folder, shared.value, level, max_file_bytes), []
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                for doc_id, ids in zip(piece.column("id").to_pylist(), encoder(tokenizer).encode_all(as_bytes(piece.column("text")))):
                    files.append(out.add(doc_id, ids + tail))
        files = [f for f in [*files, out.close()] if f]
        for f in files:
            f["part"] = TaskContext.get().partitionId()
        if files:
            yield pa.RecordBatch.from_pylist(files, schema=pa.schema(
                [("path", pa.string()), ("seq", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                 ("n_bytes", pa.int64()), ("part", pa.int64())]))

    files = stage(rows.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(
        write, "path string, seq long, n_docs long, n_tokens long, n_bytes long, part long"), "token-files")
    before = F.sum("n_tokens").over(W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1))  # one row per file
    return stage(files.withColumn("start", F.coalesce(before, F.lit(0))), "token-manifest"), dictionary


def read_store(files: DataFrame, dictionary: bytes, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of every document, read from the files one task each.

    ``start`` is the number of ids of all documents before it.
    """
    shared = files.sparkSession.sparkContext.broadcast(dictionary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                rows = []
                for doc_id, start, n, ids in StoreReader(f["path"], shared.value):
                    rows.append((doc_id, f["start"] + start, n, zlib.crc32(ids)))
                    if len(rows) == 10_000:
                        yield _rows(rows, id_col)
                        rows = []
                yield _rows(rows, id_col)

    n_files = max(1, files.count())
    return files.select("path", "start").repartition(n_files).mapInArrow(
        read, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple], id_col: str) -> pa.RecordBatch:
    names = [id_col, "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=names)


def op2_token_store(docs: DataFrame, tokenizer: str) -> DataFrame:
    files, dictionary = write_store(docs, tokenizer, shared_dir(docs.sparkSession, "token-store"))
    return read_store(files, dictionary)
