"""Spelling variants: groups of words that differ by one letter, by reduced-alphabet generation.

Every letter is hashed to one of a few symbols, which turns a word into a reduced
word. Words one edit apart have reduced words that are equal or one edit apart,
so the neighbourhood of each reduced word (itself, and every word that one edit
makes of it) is generated over the few symbols, not over all letters, and joined
with the reduced vocabulary by equality. The pairs found are verified on the
original strings.

An edit and its inverse link the same two words, so each is generated from one
side: deletions from the longer word (its partner's insertions), and of
replacements those by a higher symbol. Reduced words are never strings: numpy
makes a 64-bit hash of each neighbour from the hashes of what stands before and
after the edit, so a word of any length costs one number per neighbour. Hashes
that meet by chance fail the verification.

Words are counted with partial sums before any shuffle, and numbered; only
numbers and hashes are shuffled for the join. A word's form is its most frequent
neighbour if that is ``ratio`` times as frequent, so forms grow along a chain,
which has at most log(largest count) / log(ratio) steps; its end is the root.

Defined cases: null and empty texts have no words; a null id is the empty string
where ids matter; rows that repeat an id or a text count each; ties between
forms go to the first in code-point order; a word without neighbours has n_near
0, a null form and itself as root; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstats.llm.common import ascii_lower, text_or_empty
from lapstats.llm.hashing import mix
from lapstats.session import materialize

LETTERS = "A-Za-zÀ-ÿ"
#: Odd base of the hash of a reduced word, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Code points of words that are worked on together; scratch arrays take about 200 bytes for each.
_PIECE = 100_000


def runs(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and word (A-Z in lower case) for each maximal run of at least ``least`` letters."""
    found = F.regexp_extract_all(text_or_empty(F.col(text_col)), F.lit(f"[{LETTERS}]{{{max(least, 1)},}}"), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(found).alias("word")).withColumn("word", ascii_lower(F.col("word")))


def with_slips(words: DataFrame, every: int = 31) -> DataFrame:
    """``words`` with one letter left out where crc32 of "id:word" is a multiple of ``every``, at that number modulo the length."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (F.col("__h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return words.withColumn("__h", h).select("id", F.when(F.col("__h") % every == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, least: int, count: int) -> DataFrame:
    """wid (a number of its own), word and n of the words of at least ``least`` code points that occur ``count`` times or more."""
    n = words.filter(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)
    return materialize(n.select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "spelling-words")


def symbols_of(points: np.ndarray, symbols: int) -> np.ndarray:
    """Symbol of each code point."""
    return (mix(points.astype(np.uint64) + np.uint64(1)) % np.uint64(symbols)).astype(np.int64)


def _values(symbols: int) -> np.ndarray:
    return mix(np.arange(1, symbols + 1, dtype=np.uint64) << np.uint64(20))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _BASE, np.uint64))), dtype=np.uint64)


def neighbourhoods(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each reduced word; word number and hash of its neighbours, those of one word distinct and sorted."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    symbol, value, power = symbols_of(points, symbols), _values(symbols), _powers(int(size.max(initial=0)) + 1)
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
    term = value[symbol] * power[place]
    upto = np.cumsum(term, dtype=np.uint64)  # over all words; sums wrap, differences stay right
    ends = np.concatenate(([np.uint64(0)], upto))[np.concatenate(([0], np.cumsum(size)))]
    whole = ends[1:] - ends[:-1]
    before, after = upto - term - ends[:-1][word], ends[1:][word] - upto
    finish = lambda h, length: mix(h + length.astype(np.uint64) * np.uint64(_INVERSE))
    own = finish(whole, size)
    numbers, hashes = [np.arange(len(words)), word], [own, finish(before + after * np.uint64(_INVERSE), size[word] - 1)]
    for s in range(1, symbols):
        at = symbol < s  # replacements by a higher symbol
        numbers.append(word[at])
        hashes.append(finish(whole[word[at]] - term[at] + value[s] * power[place[at]], size[word[at]]))
    number, h = np.concatenate(numbers), np.concatenate(hashes)
    order = np.lexsort((h, number))
    number, h = number[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (number[1:] != number[:-1]) | (h[1:] != h[:-1])
    return own, number[first], h[first]


def _hashed(words: DataFrame, symbols: int, near: bool) -> DataFrame:
    """wid and key: the hash of the reduced word, or with ``near`` those of its neighbourhood."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, ids = b.column(1).to_pylist(), b.column(0).to_numpy()
            ends = np.flatnonzero(np.diff(np.cumsum([len(t) for t in text]) // _PIECE, prepend=0)).tolist()
            for at, end in zip([0, *ends], [*ends, len(text)]):
                own, number, h = neighbourhoods(text[at:end], symbols)
                wid, key = (ids[at:end][number], h) if near else (ids[at:end], own)
                yield pa.RecordBatch.from_arrays([pa.array(wid), pa.array(key.view(np.int64))], names=["wid", "key"])

    return words.select("wid", "word").mapInArrow(hashed, "wid long, key long")


def near_pairs(words: DataFrame, symbols: int = 8) -> DataFrame:
    """a, b and their words and counts, once for each two words that differ by exactly one letter."""
    near = _hashed(words, symbols, near=True).withColumnRenamed("wid", "a")
    reduced = _hashed(words, symbols, near=False).withColumnRenamed("wid", "b")
    # Words of one reduced word find each other from both sides: one stays.
    found = near.join(reduced, "key").filter(F.col("a") != F.col("b")).select("a", "b")
    found = materialize(found, "spelling-candidates")
    of = lambda c: words.select(F.col("wid").alias(c), F.col("word").alias(f"{c}_word"), F.col("n").alias(f"{c}_n"))
    pairs = found.join(of("a"), "a").join(of("b"), "b")
    return pairs.filter(F.levenshtein("a_word", "b_word", 1) == 1)


def _roots(links: DataFrame) -> DataFrame:
    """wid and root for each wid of ``links`` (wid, form): doubling along the chain, whose length is bounded."""
    to = materialize(links.select("wid", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = to.select(F.col("wid").alias("root"), F.col("root").alias("ahead"))
        step = materialize(to.join(ahead, "root", "left").select("wid", F.coalesce("ahead", "root").alias("root"),
                                                                 F.col("ahead").isNotNull().alias("moved")), "spelling-roots")
        to = step.select("wid", "root")
        if step.filter("moved").isEmpty():
            return to


def group_variants(words: DataFrame, ratio: int = 10, symbols: int = 8) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of ``words`` (wid, word, n)."""
    pairs = near_pairs(words, symbols)
    side = lambda w, o: F.struct(F.col(w).alias("wid"), (-F.col(f"{o}_n")).alias("minus"), F.col(f"{o}_word").alias("word"),
                                 F.col(o).alias("other"))
    # Once per direction; equal reduced words were found from both sides.
    both = materialize(pairs.select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("s")).select("s.*").distinct(),
                       "spelling-near")
    best = both.groupBy("wid").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("minus", "word", "other")).alias("best"))
    known = words.join(best, "wid", "left").withColumn("form_n", -F.col("best.minus"))
    has = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    known = materialize(known.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(has, F.col("best.word")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"),
                                     F.when(has, F.col("best.other")).alias("form_id")), "spelling-forms")
    roots = _roots(known.filter("form_id IS NOT NULL").select("wid", F.col("form_id").alias("form")))
    named = roots.join(words.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root").select("wid", "root_word")
    return known.join(named, "wid", "left").select("word", "n", "n_near", "form", "form_n",
                                                   F.coalesce("root_word", "word").alias("root"))


def spelling_variants(docs: DataFrame, least: int = 7, count: int = 2, ratio: int = 10, symbols: int = 8,
                      id_col: str = "doc_id", text_col: str = "text", slip_every: int | None = None) -> DataFrame:
    """``group_variants`` of the words of ``docs``; with ``slip_every``, of the words of ``with_slips``."""
    words = runs(docs, least, id_col, text_col)
    return group_variants(vocabulary(with_slips(words, slip_every) if slip_every else words, least, count), ratio, symbols)
