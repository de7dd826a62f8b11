"""Each operator on small rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.llm import exact_dedup, jaccard, language, mixing, pieces, pii, quality, sharding, suffix_tree, text, topk

SCHEMA = "doc_id long, text string, lang string, source string, keep_id string, shard string"
LONG = " ".join(f"w{i % 97}x{i}" for i in range(3000))
ROWS = [(1, "The quick brown fox jumps over the lazy dog today", "en", "a", "x", "y"),
        (2, "The  quick\tbrown fox jumps over the lazy dog today", "en", "a", None, None),
        (3, "the quick brown fox jumps over the lazy dog today", "en", "b", None, None),
        (4, "", "en", "b", None, None), (5, None, None, None, None, None), (6, None, "de", None, None, None),
        (7, "eins zwei", "de", "a", None, None), (8, "eins  zwei ", "de", "a", None, None),
        (9, LONG, "en", "c", None, None), (10, LONG + " tail", "en", "c", None, None),
        (11, " \n ", "de", "c", None, None), (12, "mail bo@ex.org or 10.1.2.3", "en", "a", None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_exact_copies(docs, none):
    found = exact_dedup.mark_copies(docs)
    assert set(found.columns) == {"doc_id", "text", "lang", "source", "shard", *exact_dedup.RESULTS}
    keep = by_id(found, "keep_id", "group_size", "kept")
    assert keep[1] == (1, 2, True) and keep[2] == (1, 2, False) and keep[3] == (3, 1, True)
    assert keep[4] == (4, 3, True) and keep[6] == (4, 3, False) and keep[11] == (11, 1, True)
    assert exact_dedup.mark_copies(none).count() == 0
    twice = docs.union(docs)
    assert sorted(r[0] for r in exact_dedup.drop_copies(twice).select("doc_id").collect()) == [1, 3, 4, 7, 8, 9, 10, 11, 12]
    assert exact_dedup.drop_copies(docs).columns == docs.columns


def test_hot_copies_are_split(spark):
    hot = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    found = exact_dedup.mark_copies(hot).where("group_size > 1")
    assert found.count() == 300 and found.where("kept").select("doc_id").first()[0] == 0


def brute_components(rows):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    comp = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                comp[a] = comp[b] = min(comp[a], comp[b])
    return {i: (len(sets[i]), comp[i]) for i in sets}


def test_near_copies_equal_brute_force(spark, docs, none):
    assert by_id(jaccard.near_copies(docs), "n_shingles", "component_id") == brute_components([(r[0], r[1]) for r in ROWS])
    assert jaccard.near_copies(none).count() == 0
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(250):    # one large family whose members drift apart, over common shingles
        w = list(base)
        for j in rng.integers(0, 60, rng.integers(0, 5)):
            w[j] = f"n{rng.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    found = by_id(jaccard.near_copies(spark.createDataFrame(rows, "doc_id long, text string")), "n_shingles", "component_id")
    assert found == brute_components(rows)


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return [sum(bool(x) and i != j and 100 * len(x & y) >= 75 * len(x | y) for j, y in enumerate(sets)) for i, x in enumerate(sets)]


def test_near_copies_count_all_links(spark, docs, none):
    found = by_id(jaccard.near_copies(docs), "n_links")
    assert [found[r[0]] for r in ROWS] == brute_links([(r[0], r[1]) for r in ROWS])
    assert "n_links" in jaccard.near_copies(none).columns
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):    # a large family of many sizes, more than two blocks, some of it copies
        w = [f"t{j}" for j in range(int(rng.integers(50, 70)))]
        for j in rng.integers(0, 50, rng.integers(0, 4)):
            w[j] = f"n{rng.integers(0, 9)}"
        rows.append((i, " ".join(w)))
    rows += [(300 + i, rows[i][1]) for i in range(20)] + [(5, "a b c d e f g"), (330, "a b c d e f g"), (331, "x")]
    got = jaccard.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_links"]) for r in got) == sorted((r[0], n) for r, n in zip(rows, brute_links(rows), strict=True))


def test_prefix_keys_meet_for_all_linking_sets():
    rng = np.random.default_rng(5)
    pool = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    frequent = pool[:300].view(np.int64)
    for _ in range(400):
        n = int(rng.integers(2, 80))
        a = np.sort(rng.choice(pool, n, replace=False))
        b = np.unique(np.concatenate([a[rng.random(n) > 0.12], rng.choice(pool, int(rng.integers(0, max(1, n // 8)) + 0))]))
        if len(b) > 1 and jaccard.links(a, b) and not np.array_equal(a, b):
            rare = lambda h: ~np.isin(h, pool[:350])
            (x, n_a), (y, n_b) = jaccard.prefix_keys(a, rare(a), frequent), jaccard.prefix_keys(b, rare(b), frequent)
            shared = np.intersect1d(x, y)
            wn = np.array([(n_a << 32) + len(a)]), np.array([(n_b << 32) + len(b)])
            assert any(jaccard._can_link(np.array([k]), *wn)[0] for k in shared)
            assert jaccard.may_link(jaccard.sketch(a), len(a), jaccard.sketch(b), len(b))


def test_surrogates(docs, none):
    found = by_id(pii.with_surrogates(docs), "text", "n_entities")
    assert found[12][1] == 2 and "bo@ex.org" not in found[12][0] and "10.1.2.3" not in found[12][0]
    assert found[5] == (None, 0) and all(found[r[0]][0] == r[1] for r in ROWS if r[0] != 12)
    assert pii.with_surrogates(none).count() == 0


def test_surrogates_keep_format_gender_and_stay_distinct(spark):
    text, kinds = pii.replace("Mr. John Smith, Mrs Smith; +1 (017) 555-7713; 4111 1111 1111 1111", "k", {})
    assert kinds == ["given-m", "surname", "phone", "card"]
    assert re.match(r"Mr\. (\w+) (\w+), Mrs \2; \+1 \(\d{3}\) \d{3}-\d{4}; ", text)
    assert pii.luhn(re.sub(r"\D", "", text[-19:])) == 0
    rows = [(i, f"Mr {n} Smith") for i, n in enumerate(pii.GIVEN["Latin", "m"])]
    new = [r["text"] for r in pii.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(set(new)) == len(rows) and not {r[1] for r in rows} & set(new)


def test_fast_test_of_numbers_skips_none():
    for secret in ("AKIA" + "QWERTYUIOPASDFGH", "+٩٦٦ ٥٠ ١٢٣ ٤٥٦٧", "abcdef" * 6, "ABCDEF" * 6, "sk-" + "a" * 20):
        for text in (secret, f"the key {secret} here"):
            assert pii.NUMBERS.search(text) and [text[a:b] for a, b, _ in pii.entities(text)] == [secret]
    for long_key in ("0a" * 128, "AB" * 200):
        assert [a for _, _, a in pii.entities(f"key {long_key}.")] == [[("secret", long_key, "")]]
        assert long_key not in pii.replace(f"key {long_key}.", "k", {})[0]


def test_shards(docs, none):
    slotted = sharding.with_slots(docs, 4)
    totals = sharding.slot_totals(slotted)
    owner = sharding.rebalance(sharding.first_map(4), {s: t[0] for s, t in totals.items()}, 4)
    spark = docs.sparkSession
    rows = [(1, s, k, *totals[s]) for s, k in owner.items()]
    placed = sharding.place(slotted, spark.createDataFrame(rows, sharding.MAP_SCHEMA)).collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in placed} == {(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS}
    for k in range(4):
        mine = sorted(r["slot"] for r in placed if r["shard"] == k)
        assert mine == list(range(len(mine)))
    assert sharding.with_slots(none, 4).count() == 0


def test_rebalance_evens_out_and_keeps_most_slots():
    rng = np.random.default_rng(1)
    size = {s: int(x) for s, x in enumerate(rng.pareto(1.5, 4096) * 1000)}
    first = sharding.first_map(16)
    owner = sharding.rebalance(first, size, 16)
    load = [sum(size[s] for s in owner if owner[s] == k) for k in range(16)]
    assert max(load) - min(load) <= 0.01 * sum(load) / 16
    assert sharding.rebalance(owner, size, 16) == owner


def test_mix(docs, none):
    found = by_id(mixing.mix(docs), "size", "source_size", "target", "taken")
    total = sum(x[0] for x in found.values())
    assert found[5] == (0, 0, 0.0, 0) and found[9][0] == 3000
    assert all(x[3] <= 2 * x[0] and x[2] <= 2 * x[1] for x in found.values())
    assert found == by_id(mixing.mix(docs), "size", "source_size", "target", "taken") and total == 6039
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(docs).columns == docs.columns


def test_quality(spark, docs, none):
    rows = [(i, ("good calm words here " if i % 2 else "BAD!! BAD!! $$$ ") * (1 + i % 5)) for i in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, quality int")
    found = quality.score(train, quality.fit(train, labels)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 and 0 <= r["score"] <= 1 for r in found if r["held_out"])
    model = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.keep_good(docs, model).columns == docs.columns and quality.score(none, model).count() == 0


def test_language_spans():
    counts, scripts = np.zeros((2, language.TRIGRAMS)), np.ones((2, len(language.SCRIPT_NAMES)))
    en, de = "the cat and the dog went there with them", "der hund und die katze gehen nicht dorthin"
    for i, t in enumerate((de, en)):
        counts[i] = np.bincount(language.Letters([t]).trigram, minlength=language.TRIGRAMS)
    model = language.Model(["de", "en"], counts, scripts)
    texts = [de, en, f"{de} {de} {en} {en}", "", "12 34", LONG]
    found = model.label(texts)
    assert [f[0] for f in found[:2]] == ["de", "en"] and [f[0] for f in found[3:5]] == ["und", "und"]
    assert [s[2] for s in found[2][2]] == ["de", "en"] and all(0 <= f[1] <= 1 for f in found)


def test_language_of_rows(docs, none):
    model = language.fit(docs)
    assert {r["lang_pred"] for r in language.label(docs, model).collect()} <= {"de", "en", "und"}
    assert language.label(none, language.fit(none)).count() == 0


def test_pieces(docs, none):
    found = pieces.sample(docs, 3).collect()
    assert all(r["round_trip"] and 0 <= r["inclusion"] <= 1 for r in found)
    for doc_id in {r["doc_id"] for r in found}:
        mine = [tuple(r["ids"]) for r in found if r["doc_id"] == doc_id]
        assert len(set(mine)) == len(mine)
    assert sorted(map(str, found)) == sorted(map(str, pieces.sample(docs, 3).collect())) and pieces.sample(none).count() == 0


def test_pieces_are_a_sample_without_replacement():
    v = pieces.load()
    lattices = pieces.Lattices(v)
    kinds, _ = lattices.add([pieces.symbols("end▁ \U0001F600\n")])
    tally = {}
    for seed in range(1500):
        found = pieces.segmentations(lattices, [kinds], 2, [np.random.default_rng(seed)])[0]
        for edges, logp, _, inclusion in found:
            n, p = tally.get(tuple(edges), (0.0, 0))
            tally[tuple(edges)] = (n + 1 / inclusion, np.exp(logp))
        assert v.decode(pieces._ids(v, lattices.piece[found[0][0]]).tolist()) == "end▁ \U0001F600\n"
    assert sum(p for _, p in tally.values()) == pytest.approx(1, abs=0.05)
    assert all(abs(n / 1500 - 1) < 0.2 for n, p in tally.values() if p > 0.2)


def test_suffix_tree(docs, none):
    found = suffix_tree.score(docs, suffix_tree.fit(docs)).collect()
    assert len(found) == len(ROWS) and all(r["score"] <= 0 and r["n_known"] == r["n_tokens"] for r in found)
    assert suffix_tree.score(docs, suffix_tree.fit(none)).where("n_known > 0").count() == 0


def _plain_suffix_tree(texts, least):
    """The tree in plain Python: {context: {symbol: p}}, what is left to the suffix, the root's counts."""
    counts = {}
    for text in texts:
        symbols = ["<end>", *text.split(), "<end>"]
        for i in range(1, len(symbols)):
            for d in range(1, i + 1):
                after = counts.setdefault(tuple(symbols[i - d:i]), {})
                after[symbols[i]] = after.get(symbols[i], 0) + 1
    root = {}
    for context, after in counts.items():
        if len(context) == 1:
            for symbol, n in after.items():
                root[symbol] = root.get(symbol, 0) + n
    total = sum(root.values()) + len(root) + 1
    stated, rest, depth = {}, {}, 1
    while True:
        tried = [c for c, after in counts.items() if len(c) == depth and sum(after.values()) >= least and (depth == 1 or c[1:] in stated)]
        kept = 0
        for c in tried:
            after = counts[c]
            below = {s: stated[c[1:]][s] if depth > 1 else (root[s] + 1) / total for s, n in after.items() if n > 1}
            occurs, once, gain = sum(after.values()), sum(n == 1 for n in after.values()), 0.0
            if not below:
                continue
            free = 0.75 * len(below) + once
            for s, n in after.items():
                if n == 1:
                    gain += math.log((free - 1) / (occurs - 1))
                else:
                    own = n - 1.75 + free * below[s] if n > 2 else (free - 0.75 + 1) * below[s]
                    gain += n * math.log(own / (occurs - 1) / below[s])
            if gain > 0.5 * math.log(occurs):
                stated[c] = {s: (after[s] - 0.75 + free * below[s]) / occurs for s in below}
                rest[c] = free / occurs
                kept += 1
        if not kept:
            return stated, rest, root, total
        depth += 1


def _plain_p(tree, context, symbol):
    stated, rest, root, total = tree
    while context and context not in stated:
        context = context[1:]
    p = 1.0
    while context:
        if symbol in stated[context]:
            return p * stated[context][symbol]
        p *= rest[context]
        context = context[1:]
    return p * (root.get(symbol, 0) + 1) / total


def _chained_texts(n):
    """Texts of words that depend on up to four words before them, and passages that many share."""
    rng = random.Random(7)
    out = []
    for i in range(n):
        w = ["a", "b"]
        while len(w) < 5 + i % 40:
            deep = len(w) > 3 and w[-3:] == ["b", "b", "a"] and w[-4] in "abc" and rng.random() < 0.9
            w.append({"a": "x", "b": "y", "c": "z"}[w[-4]] if deep else rng.choice("abc") if rng.random() < 0.997 else f"w{rng.randrange(50)}")
        out.append(" ".join(w + "one shared passage of words in a row".split() * (i % 3 == 0)))
    return [*out, "", "x", "never seen words"]


@pytest.mark.parametrize("cached, bits", [(0, 26), (60, 8), (suffix_tree.CACHED, 26)])
def test_suffix_tree_as_in_plain_python(spark, cached, bits, monkeypatch):
    texts = _chained_texts(400)
    if cached < suffix_tree.CACHED:
        monkeypatch.setattr(suffix_tree, "COMMON", 50)      # most words then come by the join
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    model = suffix_tree.fit(df.where("doc_id % 5 <> 0"), least=5, bits=bits)      # with few bits most contexts look kept
    tree = _plain_suffix_tree([t for i, t in enumerate(texts) if i % 5], 5)
    depth = max(map(len, tree[0]))
    assert model.depth == depth >= 4
    assert model.kept.count() == len(tree[0]) and model.pairs.count() == sum(map(len, tree[0].values()))
    for r in suffix_tree.score(df, model, cached=cached).collect():
        symbols = ["<end>", *texts[r["doc_id"]].split(), "<end>"]
        base = sum(math.log10((tree[2].get(s, 0) + 1) / tree[3]) for s in symbols[1:])
        p = sum(math.log10(_plain_p(tree, tuple(symbols[max(0, i - depth):i]), symbols[i])) for i in range(1, len(symbols)))
        assert r["base_score"] == pytest.approx(base, abs=1e-9) and r["score"] == pytest.approx(p, abs=1e-9)
        assert r["n_tokens"] == len(symbols) - 1 and r["n_known"] == sum(s in tree[2] for s in symbols[1:])
    for context in list(tree[0])[:50]:
        assert sum(_plain_p(tree, context, s) for s in tree[2]) + _plain_p(tree, context, "new") == pytest.approx(1)


def test_suffix_tree_grows_with_the_input(spark):
    """A context is kept for what follows it, however much other text there is."""
    rng = random.Random(3)
    phrase = ["red green blue stop"] * 30
    other = [" ".join("w%d" % rng.randrange(300) for _ in range(100)) for _ in range(400)]
    sizes = []
    for texts in (phrase + other[:40], phrase + other):
        model = suffix_tree.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
        kept = {r["context"] for r in model.kept.collect()}
        red = suffix_tree.words(suffix_tree.Texts(np.frombuffer(b"red", np.uint8), np.array([0, 3]))).hash.view(np.int64)
        assert suffix_tree.coded(model.common, red)[0] in kept
        sizes.append(model.n_tokens)
    assert sizes[1] > 5 * sizes[0]


def test_top_k(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(300, 8)).astype(np.float32)
    m[100:160] = m[100]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(900, None), (901, [float("nan")] * 8), (902, [None] + [1.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, block=64).collect()}
    x = np.floor(m.astype(float) * 256).astype(int)
    for q in range(0, 300, 50):
        best = sorted((-int(x[q] @ x[i]), i) for i in range(300) if i != q)[:5]
        assert [found[q, r] for r in range(1, 6)] == [(i, -s) for s, i in best]
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_piece_draws_do_not_depend_on_the_other_texts(monkeypatch):
    v = pieces.load()
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split()
    texts = [" ".join(words[(i * j) % 11] for j in range(i % 17)) + "é\u2581 x" * (i % 3) for i in range(60)]
    keys = list(range(60))

    def drawn(parts):
        lattices = pieces.Lattices(v)
        return [[(ids.tolist(), round(a, 9), round(b, 9)) for ids, a, b, _ in found]
                for part in parts for _, found in pieces.encode(lattices, keys[part], texts[part], 3, 17)]
    alone = drawn([slice(i, i + 1) for i in range(60)])
    assert drawn([slice(0, 60)]) == alone and drawn([slice(0, 7), slice(7, 60)]) == alone
    monkeypatch.setattr(pieces, "KEPT_UNITS", 5)
    assert drawn([slice(i, i + 10) for i in range(0, 60, 10)]) == alone
    assert all(len({tuple(ids) for ids, _, _ in found}) == len(found) for found in alone)


def test_surrogates_of_all_short_values_end_and_are_distinct(spark):
    import itertools
    import string
    letters = string.ascii_lowercase
    locals_ = [*letters, *("".join(p) for p in itertools.product(letters, repeat=2))]
    rows = [(i, f"{x}@example.org") for i, x in enumerate(locals_)] + [(1000, None), (1001, "a@example.org"), (1001, "a@example.org")]
    new = pii.with_surrogates(spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, _row int, _attempts int"))
    assert new.columns == ["doc_id", "_row", "_attempts", "text", "kinds", "n_entities"]
    found = {}
    for r in new.collect():
        found.setdefault(r["doc_id"], set()).add(r["text"])
    assert all(len(v) == 1 for v in found.values()) and found[1001] == found[0]
    made = [next(iter(found[i])).split("@")[0] for i in range(len(locals_))]
    assert len(set(made)) == len(locals_) and not set(made) & set(locals_)


def test_a_full_format_is_left_after_the_last_round(spark, monkeypatch):
    monkeypatch.setattr(pii, "ROUNDS", 2)
    monkeypatch.setattr(pii, "_surrogate", lambda kind, value, d, attempt: f"{d.below(3)}")
    new = pii.with_surrogates(spark.createDataFrame([(i, f"{i}@example.org") for i in range(3)], "doc_id long, text string")).collect()
    assert len({r["text"] for r in new}) == 3


def test_names_of_several_words_and_their_bare_mentions():
    for text, left in [("John Smith met Mary Jones. Smith paid Jones.", "Smith Jones John Mary"), ("Sarah Connor", "Sarah Connor"),
                       ("JOHN SMITH", "JOHN SMITH"), ("Mr Paul Smith came. Smith said so; Paul left.", "Paul Smith"),
                       ("Anna Maria Schmidt", "Anna Maria Schmidt"), ("Dr. Michael O'Brien and Jean-Luc", "Michael O'Brien"),
                       ("Frau Müller-Lüdenscheidt", "Müller Lüdenscheidt"), ("at 2001:db8:85a3:0:0:8a2e:370:7334", "8a2e"),
                       ("at fe80::1ff:fe23:4567:890a", "fe23"), ("mac 00:1B:44:11:3A:B7.", "1B:44")]:
        new, kinds = pii.replace(text, "k", {})
        assert kinds and not [w for w in left.split() if re.search(rf"(?<!\w){re.escape(w)}(?!\w)", new)], (text, new)
    new, _ = pii.replace("Mr Paul Smith came. Smith said so.", "k", {})
    surname = re.match(r"Mr \w+ (\w+) came\. (\w+) said so\.", new)
    assert surname and surname[1] == surname[2]
    for plain in ("A Smith is a trade. Time 10:20:30, a::b? No: std::vector at 3:4", "The Paul", "mary jones"):
        assert pii.replace(plain, "k", {}) == (plain, [])


def brute_top_k(rows, asked, k=5):
    import math
    vectors = {}
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = set()
    for q in vectors:
        if asked(q):
            mine = min(vectors[q])
            scores = sorted((-max(sum(a * b for a, b in zip(mine, v)) for v in vs), i) for i, vs in vectors.items() if i != q)
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("block, pivots", [(4, 2), (64, 8)])
def test_top_k_with_repeated_ids_and_large_components(spark, block, pivots):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(7, [9.0, 9.0, 9.0, 9.0])] * 6 + [(8, [-3.0, 1.0, 0.0, 2.0]), (10, [0.5, 0.5, 0.5, 0.5]), (20, [3e7, 1.0, 1.0, 1.0]),
             (21, [-3e7, 2.0, 0.0, 1.0]), (30, None), (31, [float("inf"), 0.0, 0.0, 0.0]), (32, [1.0, None, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    found = topk.top_k(df.repartition(3), F.col("vec_id") % 10 == 0, pivots=pivots, annuli=2, block=block).collect()
    assert {tuple(r) for r in found} == brute_top_k(rows, lambda i: i % 10 == 0) and len(found) == len({tuple(r) for r in found})


def test_top_k_of_copies_in_the_querys_own_block(spark):
    rows = [(i, [4.0, 0.0]) for i in range(6)] + [(i, [-1.0, -float(i)]) for i in range(6, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(df, F.col("vec_id") == 2, pivots=1, annuli=2)
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found.collect()) == [(i + 1, v, 16 * 256**2) for i, v in enumerate((0, 1, 3, 4, 5))]


def test_pipeline(spark):
    import corpus_pipeline
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = corpus_pipeline.run(spark, folder)
    ids = {r[0] for r in found.select("doc_id").distinct().collect()}
    assert found.where("NOT round_trip").count() == 0 and ids and ids <= {r[0] for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_helper_columns_give_way_to_those_of_the_input(docs):
    """A caller's columns named like an operator's own stay as they are, and results do not change."""
    names = ["whole", "cut", "extra", "_hash", "_source", "_text_hash", "_heavy", "_before", "_inside", "_sha", "_salt", "_salts",
             "_norm", "_place", "_first", "_count", "_hot_size", "_hot_id", "_prefix", "_gone", "_row", "_attempts", "_new", "Whole_"]
    more = docs.drop("keep_id", "shard").select("*", *[F.lit(f"mine {n}").alias(n) for n in names])
    slotted = sharding.with_slots(more, 4)
    totals = sharding.slot_totals(slotted)
    slot_map = more.sparkSession.createDataFrame([(1, s, s % 4, *totals[s]) for s in sorted(totals)], sharding.MAP_SCHEMA)
    for found, plain, results in [
            (mixing.mix(more), mixing.mix(docs), ["size", "target", "taken"]),
            (exact_dedup.mark_copies(more), exact_dedup.mark_copies(docs), ["keep_id", "group_size", "kept"]),
            (slotted, sharding.with_slots(docs, 4), ["size", "text_crc32", "virtual_slot"]),
            (sharding.place(slotted, slot_map), None, ["shard", "slot"]),
            (jaccard.keep_first(more), jaccard.keep_first(docs), ["text", "lang"]),
            (pii.with_surrogates(more), pii.with_surrogates(docs), ["text", "n_entities"])]:
        rows = found.collect()
        assert all(r[n] == f"mine {n}" for r in rows for n in names)
        assert plain is None or by_id(found, *results) == by_id(plain, *results)


def test_a_text_of_many_rows_and_few_bytes_is_spread_over_slots(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("some longer text "), "id")).alias("text"))
    slotted = sharding.with_slots(rows, 16)
    assert slotted.groupBy("virtual_slot").count().agg(F.max("count")).first()[0] < 30
    assert slotted.count() == 3000 and slotted.select("text").where("text IS NULL").count() == 1000


def test_one_pass_gives_sets_and_word_counts_and_members_are_found(spark):
    draw = random.Random(4)
    texts = [" ".join(draw.choice("Ab c dd eee Ü 中 f1".split()) for _ in range(draw.randint(0, 30))) for _ in range(60)] + [None, "", "  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows, counts = jaccard._rows(docs)
    (_, _, part), = text.slices(pa.array(texts, pa.string()))
    sets = [h for h, _ in jaccard.shingles(part)]
    signs = jaccard.signatures(sets).tolist()
    assert [(r.doc_id, r.n, [r.s1, r.s2], r.bits) for r in rows.orderBy("doc_id").collect()] == [
        (i, len(h), s, jaccard.sketch(h)) for i, (h, s) in enumerate(zip(sets, signs, strict=True))]
    assert signs[-1] == signs[-2] == [0, 0]
    value, n = np.unique(text.words(part).hash.view(np.int64), return_counts=True)
    assert sorted(map(tuple, counts.groupBy("value").sum("n").collect())) == sorted(zip(value.tolist(), n.tolist(), strict=True))
    many = text.number_hash(np.arange(5000)).view(np.int64)
    for held in (many[:0], many[:1], many[::3], np.concatenate([many[:9], many[:9] + 1, np.array([0, -1])])):
        asked = np.concatenate([many, many + 1, np.array([0, -1, 2**63 - 1, -2**63])])
        assert (text.Members(held).holds(asked) == np.isin(asked, held)).all()
