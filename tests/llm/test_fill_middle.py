"""Fill-in-the-middle texts: equal to plain Python, restored exactly."""

import hashlib
import re

import duckdb
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from check import collected, normal
from tidemart.llm import fill_middle, queries

FOLDER = "/root/testdata/sf0.001"


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i: i + 8], 16) for i in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ROWS = [(1, "The quick brown fox, 12 times."), (2, ""), (3, None), (4, "holds <P> itself"), (5, "<S"), (6, "ends with <S"), (7, "S>M><<P"),
        (8, "éàü中文😀 mixed Ünits"), (9, "x" * 20000), (10, "a b " * 9000), (None, "no id at all"), (12, "\n\r\n  \t"), (13, "<M><P>"),
        (1, "The quick brown fox, 12 times."), (-5, "negative id")] + [(100 + i, f"Text {i}: some <words> & more{'!' * (i % 5)}") for i in range(60)]


def test_equals_plain_python_and_comes_back(spark):
    docs = spark.createDataFrame([(*r, 7, "old", "kept") for r in ROWS], "doc_id long, text string, n int, Output string, extra string")
    made = fill_middle.transform(docs.repartition(3))
    assert made.columns == ["doc_id", "text", "extra", *fill_middle.RESULTS]
    rows = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert tuple(r[c] for c in fill_middle.RESULTS) == brute(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "") and r["extra"] == "kept"
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.transform(docs.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("<>PSMé a"), max_size=8), min_size=3, max_size=3), st.sampled_from(["psm", "spm"]))
def test_rotation_is_undone(parts, form):
    text = "".join(parts)
    if re.search("<[PSM]>", text):
        return
    p, m, s = (x.encode() for x in parts)
    output = fill_middle.arrange(p, m, s, form)
    assert output == (b"<P>%b<S>%b<M>%b" % (p, s, m) if form == "psm" else b"<S>%b<P>%b<M>%b" % (s, p, m))
    assert fill_middle.restore(output, form) == text.encode()


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    got = normal(collected(queries.op13_rotated_middle(spark, FOLDER)))
    assert got.equals(normal(duck.execute(fill_middle.ORACLE).df()))


def test_a_batch_of_texts_is_worked_on_in_small_slices():
    """Beside the texts and the outputs a slice's arrays are all that is held, however many texts a batch has."""
    import tracemalloc

    import pyarrow as pa

    from tidemart.llm.text import slices

    column = pa.array(["some words, and 12 signs. " * 100] * 3000)
    tracemalloc.start()
    n = 0
    for first, last, texts in slices(column, fill_middle.SLICE):
        n += sum(1 for _ in fill_middle.transformed([*range(first, last)], texts, 1, 90, 20))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 3000 and peak < 64 << 20
