"""Token id files: equal to the library over whole texts, ordered, readable in part."""

import glob
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm import queries, token_files
from tidemart.llm.text import slices

SIGNS = ["a", "b", "Z", "é", "é", "İ", "Σ", "'s", "'t", "'", "’", ".", ",", "!", "?", ":", ";", "1", "22", "²", "<|endoftext|>",
         "<|startoftext|>", "<", ">", "|", " ", "\n", "\t", "\x0b", "\x0c", "\r", " ", " ", "\x85", "中", "한", "̸", "́", "=",
         "‍", "😀", "der", "éauß", "ÿ", "ж", "Ё", "ё", "÷", "ª", "H", "ẖ", "̱", "-", "_", "\x00", "\x1c", "ﬁ", "ς"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_files.TOKENIZER)


def test_words_give_what_the_library_gives_over_whole_texts(library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 50)
    draw = random.Random(5)
    texts = ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, 14))) for _ in range(4000)]
    texts += ["", "x" * 5000, "word. " * 900, None, " ", "it's.", "a,b,,c'll;'s"]
    encoder, got = token_files.Encoder(token_files.TOKENIZER), []
    for _, _, part in slices(pa.array(texts, pa.string()), 3000):
        ids, size = encoder.encode(part, 1)
        got += [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    want = [e.ids + [1] for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got == want


def test_words_end_at_signs_and_digits_after_letters_and_are_lowered(library):
    """Few distinct words, so that few are encoded; what is not surely one of the normaliser's letters stays as it is."""
    texts = pa.array(["Réré, ÉA&&& éa×b Ab12 x|Y, <|endoftext|>É", "e\u0301, \u00c9\u0323. É"], pa.string())
    (_, _, part), = slices(texts)
    words, per_row = token_files.chunks(part)
    assert [w.decode() for w in words.to_pylist()] == ["réré", ",", "éa", "&&&", "éa×b", "ab", "12", "x|Y", ",", "<|endoftext|>É",
                                                       "e\u0301,", "\u00c9\u0323.", "é"]
    assert per_row.tolist() == [10, 3]
    draw = random.Random(9)
    signs = ["É", "À", "Þ", "ß", "×", "÷", "ÿ", "&&", "#", "a", "K", "1", "'s", "\u0301", "|", "<|endoftext|>", " ", ",", "\u0338", "Ж", "Ÿ"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 12))) for _ in range(4000)]
    encoder, got = token_files.Encoder(token_files.TOKENIZER), []
    for _, _, part in slices(pa.array(texts, pa.string()), 3000):
        ids, size = encoder.encode(part, 1)
        got += [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    assert got == [e.ids + [1] for e in library.encode_batch(texts, add_special_tokens=False)]


def brute(library, rows):
    out, start = {}, 0
    for i, text in sorted(rows):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_hold_all_documents_in_order(spark, library, tmp_path, encoding):
    draw = random.Random(3)
    rows = [(i * 7 % 1009, " ".join(draw.choice(["alpha", "beta", "gamma", "Delta,", "x"]) + str(draw.randint(0, 99)) for _ in range(draw.randint(0, 60))))
            for i in range(1009)]
    rows[4], rows[5] = (rows[4][0], None), (rows[5][0], "")
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, part int, place int, _row int").repartition(5)
    path = str(tmp_path / encoding)
    token_files.write(docs, path, encoding=encoding, row_group_bytes=4096, page_bytes=512, page_rows=20, files=4)
    read = token_files.with_start(token_files.digests(token_files.read_documents(spark, path)), path)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in read.collect()}
    want = brute(library, rows)
    assert got == want
    assert {r["doc_id"]: r["start"] for r in token_files.read_meta(spark, path).collect()} == {i: w[0] for i, w in want.items()}

    # files, row groups and rows ascend; ids lie in the asked encoding, columns have page indexes
    seen, groups = [], 0
    for name in sorted(glob.glob(f"{path}/part-*.parquet")):
        file = pq.ParquetFile(name)
        seen += file.read(columns=["doc_id"])["doc_id"].to_pylist()
        for g in range(file.metadata.num_row_groups):
            groups += 1
            for c in range(5):
                column = file.metadata.row_group(g).column(c)
                assert column.has_offset_index and column.has_column_index
                if column.path_in_schema.startswith("ids"):
                    assert ("RLE_DICTIONARY" in column.encodings) == (encoding == "dictionary")
                    assert ("DELTA_BINARY_PACKED" in column.encodings) == (encoding == "delta")
    assert seen == sorted(i for i, _ in rows) and groups > 8


def test_reads_touch_what_is_asked_for(spark, tmp_path):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"))
    path = str(tmp_path / "ids")
    token_files.write(docs, path, files=3)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert not re.search(r"ReadSchema: \S*ids", plan(token_files.read_meta(spark, path)))
    some = token_files.read_documents(spark, path, 100, 120)
    assert "GreaterThanOrEqual(doc_id,100)" in plan(some) and [r[0] for r in some.select("doc_id").orderBy("doc_id").collect()] == list(range(100, 121))
    whole = token_files.with_start(token_files.read_documents(spark, path), path).orderBy("start").collect()
    flat = [x for r in whole for x in r["ids"]]
    for start, stop in ((0, 1), (0, len(flat)), (5, 17), (whole[200]["start"] - 3, whole[320]["start"] + 1), (len(flat) - 1, len(flat) + 9), (9, 9)):
        span = token_files.read_span(spark, path, start, stop).orderBy("start").collect()
        assert [x for r in span for x in r["ids"]] == flat[start:stop]
        assert not span or span[0]["start"] == start


def test_repeated_and_missing_ids_and_no_rows(spark, library, tmp_path):
    rows = [(2, "two"), (2, "two"), (2, "other two"), (None, "none"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    token_files.write(docs, str(tmp_path / "a"), files=2)
    got = token_files.with_start(token_files.read_documents(spark, str(tmp_path / "a")), str(tmp_path / "a")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 2, 2]
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    assert sorted(map(tuple, (r["ids"] for r in got))) == sorted((*library.encode(t or "", add_special_tokens=False).ids, 1) for _, t in rows)
    token_files.write(docs.limit(0), str(tmp_path / "b"))
    assert token_files.read_meta(spark, str(tmp_path / "b")).count() == 0
    assert token_files.read_span(spark, str(tmp_path / "b"), 0, 10).count() == 0


def test_query_equals_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op11_token_files(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute(library, [tuple(r) for r in docs])
