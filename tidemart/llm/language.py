"""Language of a text by spans: scripts narrow the candidates, Viterbi over words labels the spans.

A word is a run of letters. Its score in a language is the log probability of its letter trigrams
(hashed, with the word's ends as signs). Languages in whose training texts the word's script hardly
occurs are no candidates. The best path over the words pays a penalty at every switch of language;
its spans are the labels, and the language with most letters is the text's. A text for which no
stretch of words can win back a penalty has one span, which is tested first for all texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import id_remainder, named, text_of
from tidemart.llm.text import mix, slices

TRIGRAMS = 1 << 14      # hashed trigrams of a language
PENALTY = 12.0          # of a switch, in nats
SMOOTHING = 0.5
LEAST_SHARE = 0.001     # of a script among a language's letters
NO_CANDIDATE = -40.0    # score of a word in a language that does not use its script
FOLDS = 5
UNKNOWN = "und"

# First code points of blocks and their scripts; a block ends where the next one starts (fixed values).
SCRIPTS = [(0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
           (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "other"),
           (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "other"), (0x0E00, "Thai"), (0x0E80, "other"),
           (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1E00, "Latin"),
           (0x1F00, "Greek"), (0x2000, "other"), (0x2C60, "Latin"), (0x2C80, "other"), (0x3040, "Kana"),
           (0x3100, "other"), (0x3400, "Han"), (0xA000, "other"), (0xA720, "Latin"), (0xA800, "other"),
           (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "other"), (0x20000, "Han"), (0x30000, "other")]
SCRIPT_NAMES = sorted({s for _, s in SCRIPTS})


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, its small letter, its script."""
    letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            letter[c] = True
            small = s.lower()
            lower[c] = ord(small) if len(small) == 1 else c
    place = np.searchsorted([a for a, _ in SCRIPTS], np.arange(0x110000), side="right") - 1
    script = np.array([SCRIPT_NAMES.index(s) for _, s in SCRIPTS], np.uint8)[place]
    return letter, lower, script


class Letters:
    """The words of a slice of texts: trigram of each letter, and each word's row, place, size and script."""

    def __init__(self, texts: list[str]) -> None:
        letter, lower, script = _tables()
        joined = "\n".join(texts) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(t) + 1 for t in texts])
        begin = np.concatenate([[0], np.cumsum(size)])
        is_letter = letter[code]
        at = np.flatnonzero(is_letter)
        c = lower[code].astype(np.uint64)
        c[~is_letter] = 0
        before = np.where(at > 0, c[at - 1], 0)
        after = c[np.minimum(at + 1, len(c) - 1)]
        self.trigram = (mix((before << np.uint64(42)) ^ (c[at] << np.uint64(21)) ^ after) % np.uint64(TRIGRAMS)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1] + 1
        self.first = np.flatnonzero(new)
        self.start = at[self.first]
        self.length = np.diff(np.append(self.first, len(at)))
        self.row = np.searchsorted(begin, self.start, side="right") - 1
        self.begin = begin
        self.script = script[code[self.start]]
        self.letter_row = np.repeat(self.row, self.length)
        self.letter_script = script[code[at]]


def _strings(column: pa.Array, first: int, last: int) -> list[str]:
    return [x or "" for x in column[first:last].to_pylist()]


class Model:
    """Log probabilities of trigrams by language, and which scripts a language uses."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray) -> None:
        self.langs = langs
        self.logp = np.log((counts + SMOOTHING) / (counts.sum(1, keepdims=True) + SMOOTHING * TRIGRAMS)).T.astype(np.float32).copy()
        share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
        self.uses = (share >= LEAST_SHARE).T

    def word_scores(self, w: Letters) -> np.ndarray:
        if not len(w.first):
            return np.zeros((0, len(self.langs)))
        s = np.add.reduceat(self.logp[w.trigram], w.first, axis=0).astype(np.float64)
        uses = self.uses[w.script]
        none = ~uses.any(1)
        s[~uses] += NO_CANDIDATE
        s[none] = 0
        return s

    def label(self, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """Language, score and spans (first character, character after the last, language) of each text."""
        w = Letters(texts)
        n, k = len(texts), len(self.langs)
        edge = np.searchsorted(w.row, np.arange(n + 1))
        if not k or not len(w.row):
            return [(UNKNOWN, 0.0, [])] * n
        s = self.word_scores(w)
        total = np.zeros((n, k))
        np.add.at(total, w.row, s)
        best = total.argmax(1)
        gain = s.max(1) - s[np.arange(len(s)), best[w.row]]
        upto = np.cumsum(gain)
        offset = (upto[-1] + 1.0) * w.row
        low = np.minimum.accumulate(upto - gain - offset) + offset
        most = np.zeros(n)
        np.maximum.at(most, w.row, upto - low)
        path = best[w.row]
        mixed = np.flatnonzero(most > PENALTY)
        if len(mixed):
            self._best_paths(s, edge, mixed, path)
        out = []
        weight = np.zeros((n, k))
        np.add.at(weight, (w.row, path), w.length)
        turn = np.ones(len(path), bool)
        turn[1:] = (path[1:] != path[:-1]) | (w.row[1:] != w.row[:-1])
        turns = np.flatnonzero(turn)
        spans_edge = np.searchsorted(w.row[turns], np.arange(n + 1))
        last = np.append(turns[1:], len(path)) - 1
        for i in range(n):
            if edge[i] == edge[i + 1]:
                out.append((UNKNOWN, 0.0, []))
                continue
            a = int(weight[i].argmax())
            share = weight[i, a] / weight[i].sum()
            words = edge[i + 1] - edge[i]
            sure = 1 / np.exp(np.clip((total[i] - total[i].max()) / np.sqrt(words), -60, 0)).sum() if len(turns) else 1.0
            spans = [(int(w.start[turns[j]] - w.begin[i]), int(w.start[last[j]] + w.length[last[j]] - w.begin[i]), self.langs[path[turns[j]]])
                     for j in range(spans_edge[i], spans_edge[i + 1])]
            out.append((self.langs[a], float(share * sure), spans))
        return out

    def _best_paths(self, s: np.ndarray, edge: np.ndarray, rows: np.ndarray, path: np.ndarray) -> None:
        """Viterbi for the given rows side by side, word by word; writes the best labels into `path`."""
        length = edge[rows + 1] - edge[rows]
        rows, length = rows[np.argsort(-length)], np.sort(length)[::-1]
        begin = edge[rows]
        value = s[begin].copy()
        came = np.zeros((len(s), s.shape[1]), np.int16)
        own = np.arange(s.shape[1], dtype=np.int16)
        for t in range(1, int(length[0])):
            active = int(np.searchsorted(-length, -t))
            v = value[:active]
            top = v.argmax(1)
            jump = v[np.arange(active), top] - PENALTY
            stay = v >= jump[:, None]
            at = begin[:active] + t
            came[at] = np.where(stay, own[None], top[:, None])
            value[:active] = s[at] + np.where(stay, v, jump[:, None])
        state = value.argmax(1)
        for t in range(int(length[0]) - 1, -1, -1):
            active = int(np.searchsorted(-length, -t))
            at = begin[:active] + t
            path[at] = state[:active]
            if t:
                state[:active] = came[at, state[:active]]

    def column(self, text: Column) -> Column:
        """struct(lang, score, spans) of a text."""
        model = self
        kind = "lang string, score double, spans array<struct<start:int,stop:int,lang:string>>"
        arrow = pa.struct([("lang", pa.string()), ("score", pa.float64()),
                           ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())])))])

        @F.arrow_udf("struct<" + kind.replace(" string", ":string").replace(" double", ":double").replace("spans array", "spans:array") + ">")
        def label(batch: pa.Array) -> pa.Array:
            found = []
            for first, last, _ in slices(batch):
                found += [{"lang": a, "score": b, "spans": [{"start": x, "stop": y, "lang": z} for x, y, z in c]}
                          for a, b, c in model.label(_strings(batch, first, last))]
            return pa.array(found, arrow)

        return label(text_of(text))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all documents with a language whose crc32(id) mod 5 is not 0.

    They are summed in each task and then by Spark; languages times TRIGRAMS sums come to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, last, _ in slices(batch.column(1)):
                w = Letters(_strings(batch.column(1), first, last))
                names, which = np.unique(langs[first:last], return_inverse=True)
                tri = np.bincount(which[w.letter_row] * TRIGRAMS + w.trigram, minlength=len(names) * TRIGRAMS).reshape(-1, TRIGRAMS)
                scr = np.bincount(which[w.letter_row] * len(SCRIPT_NAMES) + w.letter_script, minlength=len(names) * len(SCRIPT_NAMES))
                both = np.hstack([tri, scr.reshape(-1, len(SCRIPT_NAMES))])
                for name, row in zip(names, both, strict=True):
                    sums[str(name)] = sums.get(str(name), 0) + row
        for name, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at])],
                                             ["lang", "feature", "n"])

    known = docs.where(named(lang_col).isNotNull() & (id_remainder(named(id_col), FOLDS) != 0))
    found = (known.select(named(lang_col).cast("string").alias("lang"), text_of(named(text_col)).alias("text"))
             .mapInArrow(count, "lang string, feature int, n long")
             .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(found["lang"].unique())
    sums = np.zeros((len(langs), TRIGRAMS + len(SCRIPT_NAMES)))
    sums[np.searchsorted(langs, found["lang"]) if langs else [], found["feature"].to_numpy(int)] = found["n"].to_numpy(float)
    return Model(langs, sums[:, :TRIGRAMS], sums[:, TRIGRAMS:])


def label(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) of every row; und without letters or languages."""
    return (docs.select(named(id_col).alias("doc_id"), model.column(named(text_col)).alias("_found"))
            .select("doc_id", (id_remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
                    F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"), F.col("_found.spans").alias("spans")))
