"""What pieces ask of their tables, and what a task holds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemart.llm import pieces
from tidemart.llm import text as words_text
from tidemart.llm.common import BATCH_BYTES, bounded_batches


def test_beginnings_without_longer_pieces_are_not_looked_up():
    v = pieces.load()
    asked = []

    class Counting(pieces.Vocabulary):
        def find(self, h):
            asked.append(len(h))
            return super().find(h)

    counting = Counting(**vars(v))
    words = ["thingernd", "vichier", "x", "qqqq", "Erndly,"] * 40
    kinds, _ = pieces.Lattices(counting).add([pieces.symbols(" ".join(words))])
    assert len(set(kinds.tolist())) == 5
    live = 0
    begun = set(v.hashes[v.longer].tolist())
    units = {w: pieces.symbols(w) for w in set(words)}
    for code in units.values():
        for a in range(len(code)):
            h = np.zeros(1, np.uint64)
            for b in range(a, len(code)):
                live += 1
                h = pieces.mix(h * pieces._STEP + code[b: b + 1].astype(np.uint64))
                if int(h[0]) not in begun:
                    break
    assert sum(asked) == live


def test_rows_reach_python_by_bytes(spark):
    wide = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a word "), 20_000).alias("text")).coalesce(1)

    def largest(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    sizes = [r["n"] for r in bounded_batches(wide).mapInArrow(largest, "n long").collect()]
    assert sum(sizes) > 50_000_000
    assert max(sizes) < BATCH_BYTES + 300_000


def test_release_drops_the_powers_of_large_slices():
    data = np.frombuffer(b"some words " * 10, np.uint8)
    before = words_text.words(words_text.Texts(data, np.array([0, len(data)]))).hash
    assert len(words_text._POWERS["up"]) >= words_text.SLICE_BYTES
    words_text.release()
    assert sum(x.nbytes for x in words_text._POWERS.values()) < 100
    after = words_text.words(words_text.Texts(data, np.array([0, len(data)]))).hash
    assert (before == after).all()
