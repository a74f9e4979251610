"""Benchmark decontamination as a prefix-filtered set join on word shingles.

Every benchmark item gives windows of ``window`` consecutive words (one window
of the whole item when it has fewer). A window is a set of shingles of
``shingle`` words. Shingles are ordered by rarity over all documents; as a
document must contain a window whole, the necessary prefix of a window is its
single rarest shingle, and only documents with that shingle can contain it.

1. Count, over all documents, the shingles that occur in the benchmark.
2. Keep each window's rarest shingle and its place in the window.
3. Join the documents' shingles with these on the shingle's hash. The place
   gives the only start the window can have there; the positional bound
   (start at least 0) and the length bound (start plus length within the
   document) drop the others.
4. Verify: read the documents with candidates again; the words from that start
   on must equal the window's words.
5. Verified starts are merged per document into covered words.

Shingles of documents exist as hashes inside tasks; only partial counts,
candidates and the texts that have candidates are shuffled. Shingles and windows of the
benchmark are broadcast when a count bounds them, and shuffled otherwise.

Defined cases: null texts and texts without words have no words; items without
words have no window; items that share a window are all counted; rows with a
null item id are searched like others, but the null is no item to count; rows that repeat an id are told apart by their text; an
empty document or benchmark table gives no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstats.llm.common import ascii_lower, row_key, small_or_shuffled
from lapstats.session import materialize

#: What separates words: ASCII other than digits and letters.
_NOT_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def cased_words(text: Column) -> Column:
    """The words of a text in order, in their own case; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _NOT_WORD), "")


def word_list(text: Column) -> Column:
    """The words of a text in order, A-Z in lower case."""
    return cased_words(ascii_lower(text))


def loose_hashes(words: Column) -> Column:
    """A hash per word that equal words share; words that differ in case beyond A-Z may share it too.

    It only finds candidates: lower-casing a word is much cheaper than mapping
    A-Z alone, and the words themselves are compared afterwards.
    """
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def shingle_hashes(hashes: Column, size: int) -> Column:
    """Hashes of all shingles of ``size`` words, in order."""
    starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - size + 1, F.lit(0)))
    return F.transform(starts, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, size))))


def benchmark_windows(benchmark: DataFrame, window: int, shingle: int,
                      id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words, size, shingle size) and the items that hold them."""
    items = benchmark.select(
        F.col(id_col).cast("string").alias("item"), word_list(F.col(text_col)).alias("words"))
    items = items.filter(F.size("words") > 0).withColumn("start", F.explode(
        F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))))
    cut = items.select("item", F.slice("words", F.col("start"), F.lit(window)).alias("words"))
    cut = materialize(cut.withColumn("window_id", F.sha2(F.array_join("words", " "), 256)).distinct(), "bench-windows")
    windows = cut.groupBy("window_id").agg(F.first("words").alias("words")).select(
        "window_id", "words", F.size("words").alias("size"), F.least(F.size("words"), F.lit(shingle)).alias("width"))
    return materialize(windows, "bench-distinct"), cut.filter("item IS NOT NULL").select("window_id", "item").distinct()


def _shingles(rows: DataFrame, widths: list[int], at: str) -> DataFrame:
    """One row per shingle: its hash ``token``, ``width`` and place, and the columns of ``rows`` but ``hashes``."""
    keep = [c for c in rows.columns if c != "hashes"]
    out = None
    for width in widths:
        part = rows.select(*keep, F.lit(width).alias("width"),
                           F.posexplode(shingle_hashes(F.col("hashes"), width)).alias(at, "token"))
        out = part if out is None else out.unionByName(part)
    return out


def window_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Verified occurrences (__key, start, size, window_id) of windows in ``docs`` (__key, __text)."""
    none = windows.filter(F.lit(False)).select(F.lit(0).cast("long").alias("__key"), F.lit(0).alias("start"), "size", "window_id")
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())  # at most the shingle size
    if not widths:
        return none
    # Shingles of each window with their places.
    parts = [_shingles(windows.filter(F.col("width") == w).select(
        "window_id", "size", loose_hashes(F.col("words")).alias("hashes")), [w], "place") for w in widths]
    tokens = parts[0]
    for part in parts[1:]:
        tokens = tokens.unionByName(part)
    tokens = materialize(tokens, "bench-tokens")
    wanted = small_or_shuffled(materialize(tokens.select("width", "token").distinct(), "bench-shingles"))
    hashed = docs.select("__key", cased_words(F.col("__text")).alias("words")).select(
        "__key", F.size("words").alias("n"), loose_hashes(F.col("words")).alias("hashes"))
    seen = (_shingles(hashed.select("hashes"), widths, "at").join(wanted, ["width", "token"])
            .groupBy("width", "token").agg(F.count(F.lit(1)).alias("seen")))
    counted = tokens.join(seen, ["width", "token"], "left").fillna(0, "seen")
    rarest = Window.partitionBy("window_id").orderBy("seen", "token", "place")
    # A window with a shingle that no document has needs no search.
    prefix = counted.withColumn("__rank", F.row_number().over(rarest)).filter("__rank = 1 AND seen > 0")
    prefix = small_or_shuffled(materialize(prefix.select("token", "width", "window_id", "size", "place"), "bench-prefix"))
    start = F.col("at") - F.col("place")
    found = (_shingles(hashed, widths, "at").join(prefix, ["width", "token"])
             .filter((start >= 0) & (start + F.col("size") <= F.col("n")))
             .select("__key", start.alias("start"), "size", "window_id"))
    found = materialize(found.distinct(), "bench-candidates")
    # Only documents with a candidate are read again, for their words.
    keys = small_or_shuffled(materialize(found.select("__key").distinct(), "bench-keys"))
    texts = docs.join(keys, "__key").dropDuplicates(["__key"]).select("__key", word_list(F.col("__text")).alias("words"))
    exact = F.slice("words", F.col("start") + 1, F.col("size")) == F.col("window_words")
    # Documents share few windows, so candidates take little room in a file: their size says nothing about their rows.
    return (small_or_shuffled(found).join(texts, "__key")
            .join(small_or_shuffled(windows.select("window_id", F.col("words").alias("window_words"))), "window_id")
            .filter(exact).select("__key", "start", "size", "window_id"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and __key for every row of ``docs``."""
    windows, items = benchmark_windows(benchmark, window, shingle, item_col, item_text_col)
    hits = materialize(window_hits(docs.select(row_key(id_col, text_col).alias("__key"), F.col(text_col).alias("__text")),
                                   windows), "bench-hits")
    # Covered words: of each start, what reaches beyond all earlier windows of the document.
    spans = hits.groupBy("__key", "start").agg(F.max("size").alias("size"))
    before = Window.partitionBy("__key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    spans = spans.withColumn("__from", F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))))
    covered = spans.groupBy("__key").agg(F.sum(F.greatest(end - F.col("__from"), F.lit(0))).alias("n_hit"))
    named = (hits.select("__key", "window_id").distinct().join(small_or_shuffled(items), "window_id")
             .groupBy("__key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    result = materialize(covered.join(named, "__key", "left").withColumnRenamed("__key", "__hit_key"), "bench-result")
    counted = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("__key"),
                          F.size(cased_words(F.col(text_col))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (counted.join(small_or_shuffled(result), F.col("__key") == F.col("__hit_key"), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated"), "__key"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns."""
    windows, _ = benchmark_windows(benchmark, window, shingle)
    texts = docs.select(row_key(id_col, text_col).alias("__key"), F.col(text_col).alias("__text"))
    hit = materialize(window_hits(texts, windows).select(F.col("__key").alias("__hit_key")).distinct(), "bench-hit")
    return docs.join(small_or_shuffled(hit), row_key(id_col, text_col) == F.col("__hit_key"), "left_anti")
