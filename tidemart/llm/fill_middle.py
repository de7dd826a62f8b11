"""Fill-in-the-middle texts by rotating blocks in place, and back.

A text is cut after two numbers of units (runs of letters, other signs one by one), which two groups of a
keyed hash of its id give. Sentinels are put before its three parts in one bytearray, `<P>`prefix`<M>`middle
`<S>`suffix, and two neighbouring segments of it are exchanged by three reversals: the last two for the form
psm, the first two together with the last for spm. Restoring finds the sentinels, rotates back and takes
them out. A text that is empty or holds a sentinel itself stays plain, so a sentinel found is always ours:
no sentinel begins with what another one ends with.

Units are found over the bytes of a slice of texts at once; memory is an Arrow batch of texts, its outputs and what a
slice needs (some fifty bytes a byte of text). Freed memory goes back to the system after every batch.

Defined results: null counts as the empty text and comes out empty; a row without an id takes the hash of
the bare seed; equal rows give equal results; other columns stay, those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import named, others, text_of
from tidemart.llm.text import Texts, release, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
SLICE = 1 << 20   # bytes of texts worked on at once
FIM_PERCENT = 90
SPM_PERCENT = 20

RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def rotate(buffer: bytearray, first: int, middle: int, last: int) -> None:
    """Exchange buffer[first:middle] and buffer[middle:last], each reversed and then both together."""
    for a, b in ((first, middle), (middle, last), (first, last)):
        buffer[a:b] = buffer[a:b][::-1]


def arrange(prefix: bytes, middle: bytes, suffix: bytes, form: str) -> bytes:
    buffer = bytearray(prefix + middle + suffix)
    cut = len(prefix), len(prefix) + len(middle)
    for at, sentinel in ((cut[1], SUFFIX), (cut[0], MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    rest = len(PREFIX) + len(prefix)
    rotate(buffer, rest if form == "psm" else 0, rest + len(MIDDLE) + len(middle), len(buffer))
    return bytes(buffer)


def restore(output: bytes, form: str) -> bytes:
    """The text an output was made of."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "psm":
        first = buffer.index(SUFFIX)
        rotate(buffer, first, buffer.index(MIDDLE, first), len(buffer))
    else:
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    middle = buffer.index(MIDDLE)
    suffix = buffer.index(SUFFIX, middle)
    for at, sentinel in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[at: at + len(sentinel)]
    return bytes(buffer)


def draws(key: str, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[i: i + 4], "big") for i in (0, 4, 8, 12))


def units(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where units start in a slice, which of them is each row's first (one more at the end), characters before each byte."""
    data = texts.data
    begins = (data & 0xC0) != 0x80
    letter = _LETTER[data]
    first = begins & ~letter
    first |= letter
    first[1:] &= ~(letter[1:] & letter[:-1])
    edge = texts.offsets[:-1][texts.offsets[:-1] < len(data)]
    first[edge] = True
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, texts.offsets), np.concatenate([[0], np.cumsum(begins)])


def transformed(keys: list, texts: Texts, seed: int, fim_percent: int, spm_percent: int) -> Iterator[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of each row."""
    starts, place, chars = units(texts)
    starts = np.append(starts, len(texts.data))
    for i, key in enumerate(keys):
        low, high = int(texts.offsets[i]), int(texts.offsets[i + 1])
        text, n = texts.data[low:high].tobytes(), int(place[i + 1] - place[i])
        h1, h2, h3, h4 = draws("" if key is None else str(key), seed)
        if not text or h3 % 100 >= fim_percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
            yield n, "plain", None, None, text
            continue
        a, b = (int(starts[place[i] + u]) if u < n else high for u in sorted((h1 % (n + 1), h2 % (n + 1))))
        form = "spm" if h4 % 100 < spm_percent else "psm"
        yield (n, form, int(chars[a] - chars[low]), int(chars[b] - chars[a]),
               arrange(text[: a - low], text[a - low: b - low], text[b - low:], form))


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """`df` with `n` (units), `form` (plain, psm or spm), `prefix_chars`, `middle_chars` (null if plain) and `output`."""
    result = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"

    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())

    @F.arrow_udf(result)
    def make(ids: pa.Array, text: pa.Array) -> pa.Array:
        parts = []
        for first, last, texts in slices(text, SLICE):
            rows = transformed(ids[first:last].to_pylist(), texts, seed, fim_percent, spm_percent)
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            parts.append(pa.StructArray.from_arrays([*arrays[:-1], arrays[-1].cast(pa.string())], list(RESULTS)))
        release()
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([*zip(RESULTS, (*kinds[:-1], pa.string()), strict=True)]))

    made = make(named(id_col).cast("string"), text_of(named(text_col)))
    return df.select(F.struct(*others(df, RESULTS)).alias("_row"), made.alias("_made")).select(
        "_row.*", *(F.col(f"_made.{c}") for c in RESULTS))


def restored(output, form):
    """The text of an output, as a column."""
    @F.arrow_udf("string")
    def back(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        parts = [pa.array([restore(texts.data[a:b].tobytes(), f) for a, b, f in
                           zip(texts.offsets[:-1], texts.offsets[1:], forms[first:last].to_pylist(), strict=True)],
                          pa.binary()).cast(pa.string()) for first, last, texts in slices(outputs, SLICE)]
        release()
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return back(output, form)


ORACLE = r"""
WITH cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u, sha256(concat('1:', doc_id)) AS h
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
num AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST(concat('0x', h[1:8]) AS BIGINT) AS h1, CAST(concat('0x', h[9:16]) AS BIGINT) AS h2,
         CAST(concat('0x', h[17:24]) AS BIGINT) AS h3, CAST(concat('0x', h[25:32]) AS BIGINT) AS h4
  FROM cut),
part AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM num),
seg AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM part)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m)
                        ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM seg
"""
