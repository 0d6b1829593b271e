"""WARC archives and the token store by exact round trips."""

import base64
import hashlib
import struct
import zlib

import public_tokenizers
import pytest
import zstandard
from pyspark.sql import types as T
from tokenizers import Tokenizer

from newsloom.llm import token_store, warc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      T.StructField("sha", T.StringType()), T.StructField("payload", T.LongType())])


def pages_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES).repartition(3)


def brute_warc(rows, least=0):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [x for x, _, y in rows if (y or "").encode() == data]
        top = max((x for x in same if x is not None), default=None)
        revisit = len(same) > 1 and len(data) >= least and i != top
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def warc_rows(frame):
    return sorted([tuple(r) for r in frame.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()], key=str)


@pytest.fixture(scope="module")
def page_rows(prose):
    rows = [(i, f"http://example.org/{i}?a=1", f"<html><p>{prose(i, 80)}</p>\r\n\r\n</html>") for i in range(60)]
    rows += [(100 + i, "http://example.org/same", rows[3][2]) for i in range(20)]
    rows += [(200, None, None), (201, "u", ""), (202, "a\r\nWARC-Type: x", "é€😀"), (None, "http://n", "no id"), (None, "http://n", rows[3][2]),
             (203, "http://l", prose(7, 60_000)), (204, "http://w", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (205, "t", "twice"), (205, "t", "twice")]
    return rows


def test_archives_give_back_every_record(spark, page_rows, tmp_path):
    archives = warc.write_archives(pages_table(spark, page_rows), str(tmp_path))
    assert warc_rows(warc.read_archives(archives)) == brute_warc(page_rows)
    urls = {r.page_id: r.url for r in warc.read_archives(archives).collect()}
    assert urls[200] is None and urls[202] == "a%0D%0AWARC-Type: x"


def test_short_payloads_may_be_kept_as_responses(spark, page_rows, tmp_path):
    archives = warc.write_archives(pages_table(spark, page_rows), str(tmp_path), min_revisit_bytes=10)
    assert warc_rows(warc.read_archives(archives)) == brute_warc(page_rows, 10)


def test_archives_follow_the_format(spark, page_rows, tmp_path):
    """A leading skippable frame with the dictionary, then one frame per record; files are rolled over."""
    archives = warc.write_archives(pages_table(spark, page_rows), str(tmp_path), max_file_bytes=20_000).collect()
    assert len(archives) > 3 and sum(a.n_records for a in archives) == len(page_rows)
    data = open(archives[0].path, "rb").read()
    assert len(data) == archives[0].n_bytes
    mark, size = struct.unpack("<II", data[:8])
    assert mark == 0x184D2A5D and size > 0
    shared, at, n = zstandard.ZstdCompressionDict(data[8:8 + size]), 8 + size, 0
    while at < len(data):
        one = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
        record = one.decompress(data[at:])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        at, n = len(data) - len(one.unused_data), n + 1
    assert n == archives[0].n_records


def test_archives_of_few_or_no_pages(spark, tmp_path):
    few = [(1, "u", "x"), (2, None, None)]
    assert warc_rows(warc.read_archives(warc.write_archives(pages_table(spark, few), str(tmp_path)))) == brute_warc(few)
    assert warc.read_archives(warc.write_archives(pages_table(spark, []), str(tmp_path))).count() == 0


def test_a_damaged_archive_is_an_error(tmp_path):
    path = tmp_path / "a.warc.zst"
    record = warc.make_record(1, "u", b"payload", "A" * 32, None, False, "2024-01-01T00:00:00Z")
    path.write_bytes(zstandard.ZstdCompressor().compress(record[:-30]))
    with pytest.raises(ValueError):
        for _ in warc.read_records(str(path)):
            pass


ODD = ["J̌, x.. y., don't, it's. Á.. <|ENDOFTEXT|> <|endoftext|>x. “q”, _, 3.5,  \x1c z\x85k, É, ×, ½. ǅ, İ. ΟΔΟΣ. a̧,", " ", "\n.\n, ,\n",
       "x,\ny.\n\nz. , . ", "ends.", "ÄÖÜ, SS. ÀÉ.\nT̈ x", "a.b,c. d", "\xa0.　, e", "The End, the END. the end,"]


def test_words_are_encoded_as_the_library_encodes_whole_texts(prose):
    library, own = Tokenizer.from_file(VOCABULARY), token_store.WordEncoder(VOCABULARY, bound=40)
    for text in [*ODD, *(prose(i, 60).capitalize() + ", " + prose(i, 9) for i in range(20))]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text.encode()) == struct.pack(f"<{len(ids)}I", *ids), text
        assert len(own.known) <= 120


def expected_tokens(rows):
    library, out, start = Tokenizer.from_file(VOCABULARY), [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_the_store_gives_back_every_document(spark, documents, prose, tmp_path):
    rows = [(i, prose(i, i % 90)) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(-5, None), (7000, ""), (7001, prose(3, 20_000))]
    rows += [(8000, "same row"), (8000, "same row"), (None, "no id")]
    files, dictionary = token_store.write_store(documents(rows), VOCABULARY, str(tmp_path), max_file_bytes=4000)
    assert files.count() > 3
    got = sorted([tuple(r) for r in token_store.read_store(files, dictionary).collect()], key=lambda r: r[1])
    assert got == expected_tokens(rows)


def test_one_document_by_its_place(spark, documents, prose, tmp_path):
    rows = [(i, prose(i, 40)) for i in range(200)]
    files, dictionary = token_store.write_store(documents(rows), VOCABULARY, str(tmp_path))
    assert len(dictionary) > 0
    file = files.orderBy("start").first()
    reader = token_store.StoreReader(file.path, dictionary)
    doc_id, *_ = reader.entry(reader.n_docs - 1)
    ids = Tokenizer.from_file(VOCABULARY).encode(rows[doc_id][1], add_special_tokens=False).ids + [2]
    assert reader.document(reader.n_docs - 1) == struct.pack(f"<{len(ids)}I", *ids)
    with pytest.raises(ValueError, match="another dictionary"):
        token_store.StoreReader(file.path, dictionary + b"x")


def test_an_empty_store(documents, tmp_path):
    files, dictionary = token_store.write_store(documents([]), VOCABULARY, str(tmp_path))
    assert files.count() == 0 and token_store.read_store(files, dictionary).count() == 0
