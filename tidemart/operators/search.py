"""Document lookup and paged search.

A sort order is given as columns for short pages, and for deep ones as names with their direction (True is
ascending); it must be total. Null is the smallest value, as in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.functions.text import highlight, matches_any_word, terms_of, terms_of_query
from tidemart.operators.dims import broadcast_if_few

TERM_BUCKETS = 64


def get_by_id(docs: DataFrame, key: str, value) -> DataFrame:
    return docs.where(F.col(key) == F.lit(value))


def has_nested(column: str, values: dict[str, object]) -> Column:
    """True where one entry of an array of records has all the given values."""
    def same(entry: Column) -> Column:
        out = F.lit(True)
        for name, value in values.items():
            out = out & entry[name].eqNullSafe(F.lit(value))
        return out
    return F.coalesce(F.exists(column, same), F.lit(False))


def search(docs: DataFrame, text: str, query: str, exact: dict[str, object],
           nested: dict[str, dict[str, object]] | None = None) -> DataFrame:
    """Documents with a word of the query whose other fields equal the given values; `nested` names arrays of
    records of which one must have given values."""
    hits = docs
    for name, value in exact.items():
        hits = hits.where(F.col(name) == F.lit(value))
    for name, values in (nested or {}).items():
        hits = hits.where(has_nested(name, values))
    return hits.where(matches_any_word(F.col(text), query))


# --- term index ---------------------------------------------------------------

def term_index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, bucket): each document's distinct terms."""
    rows = docs.select(F.explode(F.array_distinct(terms_of(F.col(text)))).alias("term"), F.col(key))
    return rows.withColumn("bucket", _term_bucket(F.col("term")))


def _term_bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")


def write_term_index(index: DataFrame, path: str) -> None:
    """Folders by term bucket, files sorted by term, so that a lookup opens the folders of its terms and in them only
    the row groups that can hold one. A term of very many documents is split over several files."""
    (index.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term")
     .write.partitionBy("bucket").parquet(path))


def search_index(spark: SparkSession, path: str, docs: DataFrame, key: str, text: str, query: str,
                 exact: dict[str, object], nested: dict[str, dict[str, object]] | None = None) -> DataFrame:
    """`search` over the documents that the index names for one of the query's words; other texts are not read
    through. The index proposes (all terms of a word), the words themselves are then looked for."""
    words = terms_of_query(query)
    wanted = sorted({t for terms in words for t in terms})
    kind = docs.schema[key].dataType
    index = spark.read.schema(f"term string, {key} {kind.simpleString()}, bucket int").parquet(path)
    terms = spark.createDataFrame([(t,) for t in wanted], "term string")
    buckets = [r[0] for r in terms.select(_term_bucket(F.col("term"))).distinct().collect()]
    rows = index.where(F.col("bucket").isin(buckets) & F.col("term").isin(wanted))
    held = rows.groupBy(key).agg(*[F.max(F.col("term") == t).alias(f"_t{i}") for i, t in enumerate(wanted)])
    some = F.lit(False)
    for found in words:
        all_of = F.lit(True)
        for t in found:
            all_of = all_of & F.col(f"_t{wanted.index(t)}")
        some = some | all_of
    keys = broadcast_if_few(held.where(some).select(key))
    return search(docs.join(keys, key, "left_semi"), text, query, exact, nested)


# --- pages --------------------------------------------------------------------

def page(hits: DataFrame, order: list[Column], start: int, size: int) -> DataFrame:
    """`size` rows from position `start`; the order must be total. Each task keeps start + size rows: for pages
    far back use `page_deep` or `page_after`."""
    return hits.orderBy(*order).offset(start).limit(size)


def page_with_total(hits: DataFrame, order: list[Column], start: int, size: int) -> DataFrame:
    """A page with the number of all hits on each row."""
    total = hits.agg(F.count("*").alias("total"))
    return page(hits, order, start, size).select("*", total.scalar().alias("total"))


def search_page(docs: DataFrame, text: str, query: str, exact: dict[str, object],
                order: list[Column], start: int = 0, size: int = 20,
                nested: dict[str, dict[str, object]] | None = None) -> DataFrame:
    """Search, sort, cut the page, then mark the matched words of that page only."""
    rows = page(search(docs, text, query, exact, nested), order, start, size)
    return rows.withColumn("highlight", highlight(F.col(text), query))


def sorting(order: dict[str, bool]) -> list[Column]:
    return [F.asc(name) if up else F.desc(name) for name, up in order.items()]


def comes_after(order: dict[str, bool], at: dict[str, object]) -> Column:
    """True for rows that stand behind the given key in the order."""
    after, equal = F.lit(False), F.lit(True)
    for name, up in order.items():
        column, value = F.col(name), at[name]
        if value is None:
            further = column.isNotNull() if up else F.lit(False)
        else:
            further = column > F.lit(value) if up else (column < F.lit(value)) | column.isNull()
        after = after | (equal & F.coalesce(further, F.lit(False)))
        equal = equal & column.eqNullSafe(F.lit(value))
    return after


def page_after(hits: DataFrame, order: dict[str, bool], last: dict[str, object] | None, size: int) -> DataFrame:
    """The `size` rows behind the last key a reader has seen (from the start without one), however far back that is.
    Each task keeps `size` rows."""
    rows = hits if last is None else hits.where(comes_after(order, last))
    return rows.orderBy(*sorting(order)).limit(size)


def _splitters(keys: DataFrame, order: dict[str, bool], n: int, ranges: int, sample: int) -> list[dict]:
    """About `ranges - 1` keys that part the rows evenly, from a sample of bounded size."""
    found = [r.asDict() for r in keys.sample(min(1.0, sample / n), seed=17).limit(4 * sample).collect()]
    for name, up in reversed(order.items()):
        found.sort(key=lambda r: (r[name] is not None, r[name]) if r[name] is not None else (False,), reverse=not up)
    step = max(1, len(found) // ranges)
    out = []
    for key in found[step - 1::step]:
        if not out or out[-1] != key:
            out.append(key)
    return out


def page_deep(hits: DataFrame, order: dict[str, bool], start: int, size: int, most: int = 100_000,
              ranges: int = 64, sample: int = 4_096) -> DataFrame:
    """`size` rows from position `start`, by counting: the rows are cut into ranges of the order at sampled keys, each
    range's rows are counted, and only the ranges the page lies in are looked at further, until they hold `most`
    rows or so. Only keys are read on the way, and no task keeps more than these rows, however deep the page.
    """
    rows, before = hits, 0
    n = rows.count()
    while n > most:
        keys = rows.select(*order)
        cuts = _splitters(keys, order, n, ranges, sample)
        number = F.lit(0)
        for cut in cuts:
            number = number + comes_after(order, cut).cast("int")
        counts = dict(keys.select(number.alias("r")).groupBy("r").count().collect())
        upto, low, high = before, None, None
        for r in range(len(cuts) + 1):
            here = counts.get(r, 0)
            if upto + here > start and low is None:
                low, skipped = r, upto
            if upto < start + size:
                high = r
            upto += here
        if low is None:
            return hits.limit(0)
        inside = sum(counts.get(r, 0) for r in range(low, high + 1))
        if inside == n:
            break
        if low > 0:
            rows = rows.where(comes_after(order, cuts[low - 1]))
        if high < len(cuts):
            rows = rows.where(~comes_after(order, cuts[high]))
        n, before = inside, skipped
    return rows.orderBy(*sorting(order)).offset(start - before).limit(size)
