"""Token ids of documents in Parquet files that can be read in part.

The files hold one row per document in ascending id order: `part` (the file), `place` (ids before it in
its file), `doc_id`, `n_tokens` and the list `ids`, end id included. Ids lie dictionary encoded (bit
packed places in a page of the ids that occur) or as binary packed deltas; the three numbers are
delta encoded. Row groups and pages are kept small on purpose and every column has a page index, so

* `read_meta` reads the numbers and never touches the ids,
* `read_documents` and `read_span` hand bounds on `doc_id` or `part` and `place` to the scan, which opens the row
  groups and pages that can hold them only.

Rows are dealt to files by sampled splitters over the id and sorted with spilling. Encoding takes slices of
text and looks words up: between two white spaces, and between a letter and a following stop, the tokenizer
of TOKENIZER carries nothing over, so each distinct word is encoded once by the library and its ids are copied. Memory:
a slice of SLICE_BYTES or one longer text, and CACHE_WORDS words (with eight times as many ids) and those of a
slice; the words known only save time, results are those of the library over the whole text.

Defined results: null and empty texts hold the end id alone; rows without an id come first; rows of one id
lie behind one another, ordered by a hash of their text; other columns of the input are not stored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, pairwise, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import named, text_of
from tidemart.llm.text import _LOWER, Texts, list_array, slices

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1

SLICE_BYTES = 4 << 20
CACHE_WORDS = 400_000
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 2_000

_SPACE, _LETTER, _STOP, _LATIN = (np.zeros(256, bool) for _ in range(4))
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[[b for b in range(0x21, 0x7F) if not chr(b).isalpha() and chr(b) != "|"]] = True
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True     # after LATIN: letters of Latin-1
LATIN = 0xC3
_LOWER_LATIN = np.arange(256, dtype=np.uint8)
_LOWER_LATIN[0x80:0x9F] += 0x20


def _latin(data: np.ndarray) -> np.ndarray:
    """Which bytes are the second one of a letter of Latin-1."""
    out = np.zeros(len(data), bool)
    at = np.flatnonzero(data[:-1] == LATIN) + 1
    out[at] = _LATIN[data[at]]
    return out


def chunks(texts: Texts) -> tuple[pa.Array, np.ndarray]:
    """Words of a slice, and how many each row has. Capitals of words in ASCII and Latin-1 letters are lowered, as the
    normaliser will do, unless a `|` shows that they may be a special token's."""
    data = texts.data
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(texts), np.int64)
    inside = ~_SPACE[data]
    latin = _latin(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (_STOP[data[1:]] & (_LETTER[data[:-1]] | latin[:-1]))
    edge = texts.offsets[:-1][texts.offsets[:-1] < len(data)]
    first[edge] |= inside[edge]
    starts = np.flatnonzero(first)
    kept, latin = data[inside], latin[inside]
    offsets = np.append((np.cumsum(inside) - 1)[starts], len(kept)).astype(np.int64)
    if len(starts):
        other = (kept >= 0x80) & ~latin
        other[:-1] &= ~latin[1:]
        other |= kept == ord("|")
        lower = np.where(latin, _LOWER_LATIN[kept], _LOWER[kept])
        at = np.flatnonzero(other)
        if len(at):     # the words these bytes are in stay as they are
            words = np.unique(np.searchsorted(offsets, at, side="right") - 1)
            size = offsets[words + 1] - offsets[words]
            at = np.repeat(offsets[words] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            lower[at] = kept[at]
        kept = lower
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return words, np.diff(np.searchsorted(starts, texts.offsets))


def _byte_signs() -> str:
    """The signs a byte-level vocabulary writes the bytes as: itself if it prints, else the next free one from 256."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = count(256)
    return "".join(chr(b) if b in prints else chr(next(free)) for b in range(256))


# Small letters that the normaliser leaves as they are, and ideographs: a word of these is one piece for the model.
PLAIN = re.compile("(?:[a-z\u00df-\u00f6\u00f8-\u00ff\u0430-\u044f]|[\u4e00-\u9fff])+").fullmatch


@lru_cache(maxsize=2)
def _tokenizer(path: str):  # noqa: ANN202  a Tokenizer, read once by a process
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of texts by a tokenizer file of the `tokenizers` library, without special tokens.

    Words the normaliser and the splitter would hand on as they are go to the library's model at once; all
    others take the whole way.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.signs = _byte_signs()
        self._clear()

    def _clear(self) -> None:
        """Known words: their places in arrays of where their ids begin in `values` and how many there are."""
        self.place: dict[bytes, int] = {}
        self.begin, self.size, self.values = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))

    def _learn(self, words: list[bytes]) -> None:
        """Find the ids of new words."""
        tokenize, plain, rest = self.tokenizer.model.tokenize, [], []
        for word in words:
            (plain if PLAIN(word.decode()) else rest).append(word)
        ids, size = array("i"), array("i")
        for word in plain:
            found = tokenize(word.decode() if word.isascii() else word.decode("latin-1").translate(self.signs))
            ids.extend([t.id for t in found])
            size.append(len(found))
        for found in self.tokenizer.encode_batch([w.decode() for w in rest], add_special_tokens=False):
            ids.extend(found.ids)
            size.append(len(found.ids))
        size = np.frombuffer(size, np.int32)
        self.place.update(zip(chain(plain, rest), range(len(self.size), len(self.size) + len(size)), strict=True))
        self.begin = np.concatenate([self.begin, len(self.values) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.values = np.concatenate([self.values, np.frombuffer(ids, np.int32)])

    def _places(self, words: pa.Array) -> np.ndarray:
        if len(self.place) > CACHE_WORDS or len(self.values) > 8 * CACHE_WORDS:
            self._clear()
        if not len(words):
            return np.zeros(0, np.int64)
        ends = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1].tolist()
        data = words.buffers()[2].to_pybytes()
        keys = [data[a:b] for a, b in pairwise(ends)]
        out = np.fromiter(map(self.place.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(out < 0)
        if len(new):
            keys = [keys[i] for i in new.tolist()]
            self._learn(keys)
            out[new] = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))
        return out

    def encode(self, texts: Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice behind one another, `end_id` after each row's, and each row's number of them."""
        words, per_row = chunks(texts)
        coded = words.dictionary_encode()
        place = self._places(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        size = self.size[place]
        upto = np.cumsum(size, dtype=np.int64)
        total = int(upto[-1]) if len(upto) else 0
        # ids of words lie behind one another, with one place free after each row's
        free = np.concatenate([[0], upto])[np.cumsum(per_row)] + np.arange(len(per_row))
        out = np.full(total + len(per_row), end_id, np.int32)
        inside = np.ones(len(out), bool)
        inside[free] = False
        out[inside] = self.values[np.repeat(self.begin[place] - (upto - size), size) + np.arange(total)]
        return out, np.diff(np.concatenate([[-1], free]))


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID,
          encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
          page_rows: int = PAGE_ROWS, files: int | None = None) -> None:
    """Encode every text and write the files below `path`.

    `encoding` of the ids is "dictionary" or "delta". `files` is the number of files, as many as
    the input has splits unless given.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding must be dictionary or delta, not {encoding!r}")
    kind = docs.select(named(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, place = Encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, last, texts in slices(batch.column(1), SLICE_BYTES):
                values, size = encoder.encode(texts, end_id)
                before = place + np.cumsum(size) - size
                place += len(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(last - first, part, np.int32)), pa.array(before, pa.int64()), batch.column(0)[first:last],
                     pa.array(size, pa.int64()), list_array(values, size, pa.int32())],
                    ["part", "place", "doc_id", "n_tokens", "ids"])

    rows = docs.select(named(id_col).alias("doc_id"), text_of(named(text_col)).alias("text"))
    order = ["doc_id", "_hash", "_row"]
    rows = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(files or max(1, docs.rdd.getNumPartitions()), *order).sortWithinPartitions(*order)
    (dealt.select("doc_id", "text").mapInArrow(run, f"part int, place long, doc_id {kind}, n_tokens long, ids array<int>")
     .write.option("compression", "zstd").option("parquet.writer.version", "v2")
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", page_rows).option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", str(encoding == "dictionary").lower())
     .parquet(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _offsets(spark: SparkSession, path: str) -> DataFrame:
    """(part, before, n): ids in all earlier files and in the file. One row per file, so the sum over files fits one task."""
    totals = _files(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return totals.select("part", before.cast("long").alias("before"), "n")


def with_start(rows: DataFrame, path: str) -> DataFrame:
    """Rows of the files with `start`, the number of ids of all documents before, in place of `part` and `place`."""
    offsets = _offsets(rows.sparkSession, path).drop("n")
    return (rows.join(F.broadcast(offsets), "part").withColumn("start", F.col("before") + F.col("place"))
            .drop("part", "place", "before"))


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, start) of every document; the ids are not read."""
    return with_start(_files(spark, path).select("part", "place", "doc_id", "n_tokens"), path)


def read_documents(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(part, place, doc_id, n_tokens, ids) of the documents with ids from `first` to `last`."""
    rows = _files(spark, path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(doc_id, start, ids): what the ids at positions `start` up to `stop` of the whole sequence are, document by document."""
    edges = _offsets(spark, path).where((F.col("before") < stop) & (F.col("before") + F.col("n") > start)).agg(
        F.min(F.struct("part", "before")).alias("low"), F.max(F.struct("part", "before")).alias("high")).first()
    low, high = edges["low"] or (0, start), edges["high"] or (-1, stop)
    rows = _files(spark, path).where(
        F.col("part").between(low[0], high[0])
        & ((F.col("part") > low[0]) | (F.col("place") + F.col("n_tokens") > start - low[1]))
        & ((F.col("part") < high[0]) | (F.col("place") < stop - high[1])))
    found = with_start(rows, path)
    skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    take = F.least(F.lit(stop) - F.col("start"), F.col("n_tokens")) - skip
    return found.select("doc_id", (F.col("start") + skip).alias("start"),
                        F.slice("ids", (skip + 1).cast("int"), take.cast("int")).alias("ids"))


def digests(rows: DataFrame) -> DataFrame:
    """`ids` replaced by their number and the CRC-32 of them as little-endian unsigned 32-bit integers."""
    kept = [f for f in rows.schema.fields if f.name not in ("ids", "n_tokens")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            ends = lists.offsets.to_numpy().astype(np.int64)
            values = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            crc = [zlib.crc32(values[4 * a: 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
                                             [*(f.name for f in kept), "n_tokens", "ids_crc32"])

    return rows.select(*(named(f.name) for f in kept), "ids").mapInArrow(run, schema)
