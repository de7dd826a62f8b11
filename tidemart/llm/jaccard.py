"""Near copies by a Jaccard join on five-word shingles, with token-combination prefixes.

A document is a set of shingle hashes (64 bits; two different shingles of a pair of documents agree
with a chance of about size^2 / 2^64). All documents order shingles alike, in three classes:

1. shingles with a word that is rare in the corpus, single,
2. other shingles, single, if few documents that reach this class hold them,
3. the rest, in pairs.

Two sets that link share at least o = 3 (m + n) / 7 shingles, so a set of n lacks at most t = n - o of
its own in the other. Its prefix takes shingles in order until the classes' credits exceed t: a single
counts 1, and a sub-class of c frequent shingles counts c - 1. If all shared prefix shingles were at most
one per sub-class and none single, more than t would be lacking; so linked sets share a single shingle or
a pair of one sub-class, and these are the index keys. Class 3 keys also name the two sets' bands of
sizes, whose bounds set t more tightly, so that copies of a common text that have drifted too far apart
do not meet. Classes only steer the work; whatever they are, no linking pair escapes.

Keys are sorted by ranges, so that a key of any frequency is spread over tasks. In a range each key
links its documents to the most central one (a star); stars are verified on whole sets, and connected
components formed. Only documents of one key that are then in different components are paired, verified
and joined: within a component no further pair can change the component, so groups of copies need not be
expanded. Equal sets are one node from the start.

Every link lies inside a component, so the links of each row are counted there: all distinct sets of a
component are compared in blocks, by exact intersection sizes. Only sums leave a block, and a set
counts as often as rows have it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import free_names, named, text_of, written
from tidemart.llm.components import components
from tidemart.llm.text import Counter, Members, Texts, Words, bounds, find, list_array, mix, number_hash, release, slices, words

WORDS = 5
LEAST_RARE = 32         # a word or shingle with at most so many occurrences is rare
MOST_COMMON = 2_000_000  # or with at most 1/MOST_COMMON of all: so many common ones at most are looked up
BAND = 1.05             # ratio of a size band's bounds
BROADCAST_IDS = 1_000_000  # ids looked up by broadcast at most; more are joined by shuffle
NO_ID = 2**63 - 1       # stands for a missing id
LINK_BLOCK = 128        # sets in a block of a large component, about
LINK_BYTES = 4 << 20    # and bytes of their hashes
LINK_BAND = 1.34        # ratio of a link band's bounds; above 4/3, so linked sets are at most one band apart
MOST_BANDS = 100        # link bands of sets of up to 10^12 shingles, about
PAIR_BIT = np.int64(1)  # lowest bit of a key made of two frequent shingles

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: Texts, common: Members | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row its distinct shingle hashes in order, and which contain a word not in `common`."""
    w = words(texts)
    return _shingles(w, len(texts), np.ones(len(w.hash), bool) if common is None else ~common.holds(w.hash))


def _shingles(w: Words, n_rows: int, rare: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    edge = bounds(w.row, n_rows)
    n = max(len(w.hash) - WORDS + 1, 0)
    whole, has_rare = np.zeros(n, np.uint64), np.zeros(n, bool)
    for k in range(WORDS):
        whole = mix(whole * _STEP + w.hash[k: k + n])
        has_rare |= rare[k: k + n]
    out = []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        if b - a >= WORDS:
            h, at = np.unique(whole[a: b - WORDS + 1], return_index=True)
            out.append((h, has_rare[a: b - WORDS + 1][at]))
        elif b > a:
            h = number_hash(np.array([b - a]))
            for x in w.hash[a:b]:
                h = mix(h * _STEP + x)
            out.append((h, np.array([rare[a:b].any()])))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, bool)))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """For each set two 64-bit sums that tell sets apart."""
    h = np.concatenate([np.zeros(0, np.uint64), *sets])
    ends = np.cumsum([0, *map(len, sets)])
    sums = np.zeros((len(h) + 1, 2), np.uint64)
    np.cumsum(mix(h), out=sums[1:, 0])
    np.cumsum(mix(h * _STEP ^ np.uint64(0x5BF03635)), out=sums[1:, 1])
    return (sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of distinct hashes have a Jaccard similarity of 0.75 or more."""
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)) or not len(a):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= 75 * (len(a) + len(b) - shared)


def sketch(h: np.ndarray) -> bytes:
    """A bitmap of as many bits as a power of two at or above the set's size, at least 64."""
    bits = np.zeros(max(64, 1 << (len(h) - 1).bit_length() if len(h) else 0), bool)
    bits[(mix(h ^ np.uint64(0x1F2E3D)) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_link(a: bytes, n_a: int, b: bytes, n_b: int) -> bool:
    """False only if the bitmaps show that too many shingles of a set are not in the other."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2:]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2:]
    need = -(-3 * (n_a + n_b) // 7)
    return int(np.bitwise_count(x & ~y).sum()) <= n_a - need and int(np.bitwise_count(y & ~x).sum()) <= n_b - need


def _band_starts(most: int = 1 << 40) -> np.ndarray:
    starts, x = [1], 1.0
    while x < most:
        x = max(x * BAND, x + 1)
        starts.append(int(x))
    return np.array(starts)


_BANDS = _band_starts()


def prefix_keys(h: np.ndarray, rare: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """Index keys of a set, and its number of single shingles if they do not fill the prefix (else 0).

    `frequent` has the shingles of class 3, sorted. Keys of two shingles have PAIR_BIT set, others do
    not. A set of one shingle links only with its equals and needs no key.
    """
    n = len(h)
    if n < 2:
        return np.zeros(0, np.int64), 0
    lack = n // 4
    single = h[rare]
    often = np.zeros(0, np.uint64)
    if len(single) <= lack:
        other = h[~rare]
        is_often = find(frequent, other.view(np.int64)) >= 0
        single, often = np.concatenate([single, other[~is_often]]), other[is_often]
    keys = single[: lack + 1].view(np.int64) & ~PAIR_BIT
    if len(single) > lack:
        return keys, 0
    pairs = [k.view(np.int64) | PAIR_BIT for k in _pair_keys(n, len(single), often)]
    return np.concatenate([keys, *pairs]), len(single)


def _pair_keys(n: int, n_single: int, often: np.ndarray) -> Iterator[np.ndarray]:
    """Keys of frequent shingles, two by two, for every band of sizes a partner may have."""
    own = int(np.searchsorted(_BANDS, n, side="right")) - 1
    least, most = -(-3 * n // 4), 4 * n // 3
    for band in range(int(np.searchsorted(_BANDS, least, side="right")) - 1, int(np.searchsorted(_BANDS, most, side="right"))):
        partner = max(int(_BANDS[band]), least)
        need = n + 1 - -(-3 * (n + partner) // 7) - n_single
        if need <= 0:
            continue
        low, high = min(own, band), max(own, band)
        group = mix(often ^ np.uint64(0xA5A5)) % np.uint64(max(1, int(_BANDS[low]) // 8))
        _, begins = np.unique(group, return_index=True)
        credit = np.ones(len(often), np.int64)
        credit[begins] = 0
        stop = int(np.searchsorted(np.cumsum(credit), need)) + 1
        order = np.argsort(group[:stop], kind="stable")
        token, part = often[:stop][order], group[:stop][order]
        salt = number_hash(np.array([(low << 20) + high]))
        for step in range(1, stop):
            same = part[step:] == part[:-step]
            if not same.any():
                break
            yield mix(mix(token[:-step][same] * _STEP + token[step:][same]) ^ salt)


def _rows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, s1, s2, bits): size, signature and bitmap of each document's set; and (value, n): counts of the words.
    One pass over the texts makes both."""
    names = ["doc_id", "n", "s1", "s2", "bits", "value", "times"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            for first, last, texts in slices(batch.column(1)):
                w = words(texts)
                seen.add(w.hash.view(np.int64))
                sets = [h for h, _ in _shingles(w, len(texts), np.ones(len(w.hash), bool))]
                signs = signatures(sets)
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], pa.array([len(h) for h in sets], pa.int64()),
                                                  pa.array(signs[:, 0]), pa.array(signs[:, 1]), pa.array([sketch(h) for h in sets], pa.binary()),
                                                  *[pa.nulls(last - first, pa.int64())] * 2], names)
        value, times = seen.merge()
        none = [pa.nulls(len(value), kind) for kind in (*[pa.int64()] * 4, pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(value), pa.array(times)], names)
        del seen
        release()

    both = written(docs.mapInArrow(read, "doc_id long, n long, s1 long, s2 long, bits binary, value long, times long"), "jaccard-rows")
    return (both.where("n IS NOT NULL").select("doc_id", "n", "s1", "s2", "bits"),
            both.where("value IS NOT NULL").select("value", F.col("times").alias("n")))


def _common(counts: DataFrame, least: float) -> np.ndarray:
    """Values counted more than `least` times, sorted; at most MOST_COMMON by the choice of `least`."""
    found = counts.groupBy("value").agg(F.sum("n").alias("n")).where(F.col("n") > least).select("value").toPandas()
    return np.sort(found["value"].to_numpy(np.int64))


def _new_sets(batches: Iterator[pa.RecordBatch], common: Members) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Id, set and rare shingles of each row whose set this task has not met before."""
    met = set()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for first, _, texts in slices(batch.column(1)):
            sets = shingles(texts, common)
            for i, ((h, rare), sign) in enumerate(zip(sets, map(tuple, signatures([h for h, _ in sets]).tolist()), strict=True)):
                if len(h) > 1 and sign not in met:
                    met.add(sign)
                    yield ids[first + i], h, rare


def _shingle_counts(docs: DataFrame, common) -> DataFrame:  # noqa: ANN001  a broadcast array
    """(value, n): counts of shingles without rare words, from documents whose prefix needs some of them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for _, h, rare in _new_sets(batches, common.value):
            if rare.sum() <= len(h) // 4:
                seen.add(h[~rare].view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in seen.merge()], ["value", "n"])
        del seen
        release()

    return docs.mapInArrow(count, "value long, n long")


def _entries(docs: DataFrame, common, frequent) -> DataFrame:  # noqa: ANN001  broadcast arrays
    """(key, wn, id): index keys; wn has the number of singles above the set's size in its low half."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wns, keys = [], [], []
        size = 0
        for doc_id, h, rare in _new_sets(batches, common.value):
            k, n_single = prefix_keys(h, rare, frequent.value)
            ids.append(doc_id)
            wns.append((n_single << 32) + len(h))
            keys.append(k)
            size += len(k)
            if size > 200_000:
                yield _entry_batch(ids, wns, keys)
                ids, wns, keys, size = [], [], [], 0
        if ids:
            yield _entry_batch(ids, wns, keys)
        release()

    return (docs.mapInArrow(index, "id long, wn long, keys array<long>")
            .select(F.explode("keys").alias("key"), "wn", "id"))


def _entry_batch(ids: list[int], wns: list[int], keys: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(wns, pa.int64()), list_array(
        np.concatenate(keys), np.array([len(k) for k in keys]), pa.int64())], ["id", "wn", "keys"])


def _can_link(key: np.ndarray, wn_a: np.ndarray, wn_b: np.ndarray) -> np.ndarray:
    """Whether two sets that meet in a key can link, by their sizes; in a pair key, also if they share
    no single shingle (sets that share one meet in its key too)."""
    n_a, n_b = wn_a & 0xFFFFFFFF, wn_b & 0xFFFFFFFF
    most = np.minimum(n_a, n_b)
    alone = np.minimum(n_a - (wn_a >> 32), n_b - (wn_b >> 32))
    return 7 * np.where((key & PAIR_BIT) == 1, alone, most) >= 3 * (n_a + n_b)


_STAR = "kind int, key long, wn long, id long, hub long"
_CANDIDATE, _MEMBER, _HEAD = 0, 1, 2


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, wn, id) in order: candidates (id, hub) with each key's first row as hub, the
    members of keys with two rows or more, and the hubs of the range's first and last key, which other
    ranges may hold too."""
    key, wn, ids, old = (np.zeros(0, np.int64) for _ in range(4))
    started = False
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [np.asarray(batch.column(i)) for i in range(3)]
        key, wn, ids = (np.concatenate([a, b]) for a, b in zip((key, wn, ids), new, strict=True))
        old = np.concatenate([old, np.zeros(batch.num_rows, np.int64)])   # 1: a hub carried over, its member row sent
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(first)
        size = np.diff(np.append(begin, len(key)))
        hub = np.repeat(begin, size)
        other = ~first & _can_link(key, wn, wn[hub])
        member = (np.repeat(size, size) > 1) & (old == 0)
        if not started:
            member[0] |= old[0] == 0
        yield from _star_rows(_CANDIDATE, key[other], wn[other], ids[other], ids[hub[other]])
        yield from _star_rows(_MEMBER, key[member], wn[member], ids[member], ids[hub[member]])
        if not started:
            yield from _star_rows(_HEAD, key[:1], wn[:1], ids[:1], ids[:1])
            started = True
        last = begin[-1]
        sent = old[last] | member[last]
        key, wn, ids, old = key[last: last + 1], wn[last: last + 1], ids[last: last + 1], np.array([int(sent)])
    if len(key):
        yield from _star_rows(_HEAD, key, wn, ids, ids)
        if not old[0]:
            yield from _star_rows(_MEMBER, key, wn, ids, ids)


def _star_rows(kind: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(columns[0]):
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32))] + [pa.array(c) for c in columns],
                                         ["kind", "key", "wn", "id", "hub"])


def _possible(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that their bitmaps do not rule out; these are a fiftieth of the texts in size."""
    side = lambda x: rows.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where("7 * least(n_a, n_b) >= 3 * (n_a + n_b)")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, n_a, bits_a, n_b, bits_b = (c.to_pylist() for c in batch.columns)
            keep = pa.array([may_link(*x) for x in zip(bits_a, n_a, bits_b, n_b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], ["a", "b"])

    return written(both.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(compare, "a long, b long").distinct(), "jaccard-possible")


def _verified(docs: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of documents whose whole sets link."""
    spark = docs.sparkSession
    pairs = _possible(rows, pairs)
    ids = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "jaccard-ids")
    few = ids.count() <= BROADCAST_IDS
    texts = docs.withColumnRenamed("doc_id", "id").join(F.broadcast(ids) if few else ids, "id", "left_semi")
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, left in slices(batch.column(2)):
                sets = [h for h, _ in shingles(left)]
                for a, b, right in slices(batch.column(3)[first:last]):
                    same = [links(x, y) for x, (y, _) in zip(sets[a:b], shingles(right), strict=True)]
                    keep = pa.array(same, pa.bool_())
                    yield pa.RecordBatch.from_arrays([batch.column(i)[first + a: first + b].filter(keep) for i in (0, 1)], ["a", "b"])
        release()

    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "500")   # rows carry two texts
    try:
        return written(both.mapInArrow(compare, "a long, b long").distinct(), "jaccard-links")
    finally:
        spark.conf.set(limit, before)


def shared_sizes(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of `a` has in common with each of `b`."""
    n_a, n_b = (np.array([len(h) for h in x], np.int64) for x in (a, b))
    _, at, times = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(a) + len(b)), np.concatenate([n_a, n_b]))
    row, at = row[times[at] > 1], (np.cumsum(times > 1) - 1)[at[times[at] > 1]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out = np.zeros((len(a), len(b)), np.int64)
    for first in range(0, int(at[-1]) + 1 if len(at) else 0, 4096):
        x, y = np.searchsorted(at, [first, first + 4096])
        held = np.zeros((len(a) + len(b), 4096), np.float32)
        held[row[x:y], at[x:y] - first] = 1
        out += (held[: len(a)] @ held[len(a):].T).astype(np.int64)
    return out


def _count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks (alone, sets), each set's links to the other side, or within the block if it is alone."""
    for batch in batches:
        ids, counts = [], []
        for alone, sets in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            left = [x for x in sets if x["side"] == 0]
            right = left if alone else [x for x in sets if x["side"] == 1]
            if not left or not right:
                continue
            a, b = ([np.frombuffer(x["h"], np.uint64) for x in side] for side in (left, right))
            shared = shared_sizes(a, b)
            n_a, n_b = (np.array([len(h) for h in x], np.int64) for x in (a, b))
            linked = 100 * shared >= 75 * (n_a[:, None] + n_b[None] - shared)
            if alone:
                np.fill_diagonal(linked, False)
            for mine, theirs, link in [(left, right, linked)] + ([] if alone else [(right, left, linked.T)]):
                ids.append(np.array([x["sid"] for x in mine], np.int64))
                counts.append(link.astype(np.int64) @ np.array([x["copies"] for x in theirs], np.int64))
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, counts)], ["sid", "linked"])


def _link_counts(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(sid, linked): for sets (sid, n, component, copies, rep), the rows of the other sets that link with it.

    A small component is one block. The sets of a large one are cut into blocks by size band and hash,
    and every two blocks of the same or adjacent bands meet.
    """
    spark = docs.sparkSession
    several = sets.groupBy("component").agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("all")).where("g > 1")
    wanted = written(sets.join(several, "component"), "jaccard-several")
    ids = wanted.select(F.col("rep").alias("doc_id")).distinct()
    few = wanted.count() <= BROADCAST_IDS

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in slices(batch.column(0)):
                sets = [h for h, _ in shingles(texts)]
                signs = signatures(sets)
                yield pa.RecordBatch.from_arrays([pa.array([len(h) for h in sets], pa.int64()), pa.array(signs[:, 0]), pa.array(signs[:, 1]),
                                                  pa.array([h.tobytes() for h in sets], pa.binary())], ["n", "s1", "s2", "h"])

    hashes = (docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").select("text").mapInArrow(read, "n long, s1 long, s2 long, h binary")
              .select(_set_id().alias("sid"), "h").groupBy("sid").agg(F.first("h").alias("h")))
    held = written(wanted.join(hashes, "sid").withColumn("band", F.floor(F.log(F.col("n").cast("double")) / float(np.log(LINK_BAND))).cast("int")), "jaccard-sets")

    known = lambda frame: F.broadcast(frame) if frame.count() <= BROADCAST_IDS // MOST_BANDS else frame
    large = held.where((F.col("g") > LINK_BLOCK) | (F.col("all") * 8 > LINK_BYTES))
    blocks = written(large.groupBy("component", "band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / LINK_BLOCK), F.ceil(F.sum("n") * 8 / LINK_BYTES)).cast("int").alias("blocks"))
              .groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("blocks")), "jaccard-blocks")
    upto = lambda c: F.when(F.col(c) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))
    place = lambda low, i, high, j, side: F.struct(low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"), F.lit(side).alias("side") if isinstance(side, int) else side.alias("side"))
    at, band = F.col("at"), F.col("band")
    of = lambda k: F.coalesce(F.element_at("blocks", k), F.lit(0))
    spread = (held.join(known(blocks), "component", "left")
              .withColumn("same", F.when(F.col("blocks").isNull(), 1).otherwise(of(band))).withColumn("above", of(band + 1)).withColumn("below", of(band - 1))
              .withColumn("band", F.when(F.col("blocks").isNull(), 0).otherwise(band))
              .withColumn("at", F.pmod(F.xxhash64("sid", F.lit(7)), F.col("same")).cast("int"))
              .withColumn("to", F.explode(F.concat(
                  F.transform(upto("same"), lambda j: place(band, F.least(at, j), band, F.greatest(at, j), F.when(at <= j, 0).otherwise(1))),
                  F.transform(upto("above"), lambda j: place(band, at, band + 1, j, 0)),
                  F.transform(upto("below"), lambda j: place(band - 1, j, band, at, 1))))))
    pairs = (spread.groupBy("component", "to.low", "to.i", "to.high", "to.j")
             .agg(F.collect_list(F.struct(F.col("to.side").alias("side"), "sid", "copies", "h")).alias("sets"))
             .select(((F.col("low") == F.col("high")) & (F.col("i") == F.col("j"))).alias("alone"), "sets"))
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "16")   # rows carry up to two blocks of sets
    try:
        return written(pairs.mapInArrow(_count_links, "sid long, linked long").groupBy("sid").agg(F.sum("linked").alias("linked")), "jaccard-counts")
    finally:
        spark.conf.set(limit, before)


def _set_id():  # noqa: ANN202  a Column
    return F.xxhash64("n", "s1", "s2")


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row.

    The component is the smallest id reachable by links; a row without words is alone in its own. Rows
    that repeat an id count as one document that has all their links. Null ids count as the greatest
    one; their component is null unless it has another id. n_links is the number of other rows whose
    text links with this row's. An empty table gives an empty one.
    """
    docs, found = _with_components(df, id_col, text_col)
    found = written(found.withColumn("sid", _set_id()), "jaccard-found")
    sets = (found.where("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.first("component").alias("component"),
                                                    F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep")))
    sets = written(sets, "jaccard-copies")
    links_of = sets.join(_link_counts(docs, sets), "sid", "left").select("sid", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    known = lambda c: F.when(c != NO_ID, c)
    return found.join(links_of, "sid", "left").select(
        known(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), known(F.col("component")).alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def _with_components(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, text), and (doc_id, n, s1, s2, component) of each, NO_ID for a missing id."""
    spark = df.sparkSession
    docs = df.select(F.coalesce(named(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), text_of(named(text_col)).alias("text"))
    rows, word_counts = _rows(docs)
    classes = rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("node"))
    nodes = written(rows.join(classes, ["n", "s1", "s2"], "left")
                    .select("doc_id", "n", "s1", "s2", F.coalesce("node", "doc_id").alias("node")), "jaccard-nodes")
    node_of = nodes.select("doc_id", "node").distinct()

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = max(LEAST_RARE, size / 2 / MOST_COMMON)   # words take two bytes at least, with their space
    common = spark.sparkContext.broadcast(Members(_common(word_counts, least)))
    frequent = spark.sparkContext.broadcast(_common(_shingle_counts(docs, common), least))
    found = written(_entries(docs, common, frequent).repartitionByRange("key", "wn", "id")
                    .sortWithinPartitions("key", "wn", "id").mapInArrow(_stars, _STAR), "jaccard-stars")

    heads = found.where(F.col("kind") == _HEAD).select("key", "wn", "id").distinct()   # two for each range
    top = F.first("id").over(Window.partitionBy("key").orderBy("wn", "id"))
    met = (found.where(F.col("kind") == _CANDIDATE).select("id", "hub")
           .union(heads.select("id", top.alias("hub")).where("id <> hub")).distinct())
    as_node = lambda frame, name, to: frame.join(node_of.select(F.col("doc_id").alias(name), F.col("node").alias(to)), name)
    tested = as_node(as_node(met, "id", "x"), "hub", "y")
    tested = written(tested.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct(), "jaccard-pairs")
    # A class whose id also stands for another class joins both.
    linked = _verified(docs, rows, tested).union(node_of.where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b")))
    group = components(linked)

    members = as_node(found.where(F.col("kind") == _MEMBER).select("key", "wn", "id").distinct(), "id", "node")
    members = (members.join(group.select(F.col("id").alias("node"), "component"), "node", "left")
               .select("key", "wn", "node", F.coalesce("component", "node").alias("component")).distinct())
    members = written(members, "jaccard-members")
    open_keys = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    left = members.join(open_keys, "key")
    n = lambda side: F.col(f"{side}.wn").bitwiseAND(F.lit(0xFFFFFFFF))
    alone = lambda side: n(side) - F.shiftright(f"{side}.wn", 32)
    shared = F.when(F.col("l.key").bitwiseAND(F.lit(1)) == 1, F.least(alone("l"), alone("r"))).otherwise(F.least(n("l"), n("r")))
    across = (left.alias("l").join(left.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.component") < F.col("r.component"))
                                   & (shared * 7 >= (n("l") + n("r")) * 3))
              .select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct())
    rest = written(across.join(tested, ["a", "b"], "left_anti"), "jaccard-rest")
    group = components(linked.union(_verified(docs, rows, rest)))
    return docs, (nodes.join(group.withColumnRenamed("id", "node"), "node", "left")
                  .select("doc_id", "n", "s1", "s2", F.coalesce("component", "node").alias("component")))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is the smallest of their component, with the columns of `df`; rows without id stay."""
    _, found = _with_components(df, id_col, text_col)
    gone, = free_names(df, "_gone")
    found = found.where((F.col("doc_id") != F.col("component")) & (F.col("doc_id") != NO_ID)).select(F.col("doc_id").alias(gone)).distinct()
    return df.join(found, named(id_col).cast("long") == F.col(gone), "left_anti")
