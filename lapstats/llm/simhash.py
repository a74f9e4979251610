"""SimHash near-duplicates: one-wildcard segment variants, equality join, verification.

Fingerprint: each 4-word shingle is hashed to 64 bits; a bit of the fingerprint
is set when it is set in more than half of the hashes. Two fingerprints link
when at most ``distance`` bits differ.

Search: with 4 bits and 3 segments (22, 21 and 21 bits) one segment of a linked
pair differs in one bit at most, so the pair agrees on that segment with some
single bit masked. Every distinct fingerprint is indexed under its 64 masked
segments; fingerprints that share an entry are candidates and are verified by
their whole bit distance.

Large groups: exact copies share a fingerprint and are indexed once. In an entry
with many fingerprints, each is first compared with three fixed members (hubs),
which is linear; components of these links then leave only members outside their
hub's component, and those are compared with all members of other components.
Two fingerprints of one entry are thus either connected already or compared, so
no link that matters for a component is lost, and a tight group of near copies
never emits its square.

Joins: tables that a count proves small are broadcast, all others shuffled. The
entries are 64 times the fingerprints, which Spark's expected sizes do not know.

Defined cases: null and empty texts have fingerprint zero and link like any
other; a text of fewer words is one shingle; rows with equal ids or texts are
rows of their own; null ids are ignored for the smallest id (a component of null
ids only has id null); an empty table gives an empty result; columns other than
id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.llm.common import SLICE, gives_back, parts_of, shuffled, small_or_shuffled, text_or_empty
from lapstats.llm.graph import components
from lapstats.session import materialize

SEED = 42
#: Hashes of which the bits are added up at a time.
_BLOCK = 1 << 15
#: Turns the order of fingerprints around, for a third hub.
_FLIP = 0x5555555555555555


def fingerprint(text: str, width: int = 4) -> int:
    """Unsigned 64-bit SimHash of a text."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    data = b" ".join(found)
    size = np.fromiter(map(len, found), np.int64, len(found)) + 1
    start = np.cumsum(size) - size
    first = start[:max(len(found) - width + 1, 1)].tolist()
    last = (start + size - 1)[min(width, len(found)) - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), _BLOCK):
        h = np.array([digest(data[i:j], SEED) for i, j in zip(first[at:at + _BLOCK], last[at:at + _BLOCK])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long) and a hash of the text for every row."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, width) for p in parts_of(b, 2, SLICE) for t in p.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    text = text_or_empty(F.col(text_col))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("__text"))
    out = T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType),
                        T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])
    return narrow.mapInArrow(gives_back(hashed), out)


def _segments(distance: int) -> list[tuple[int, int]]:
    """Lowest bit and width of as few segments as make one differ by one bit at most."""
    n = max(distance // 2 + 1, 1)
    sizes = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(sizes[:i]), w) for i, w in enumerate(sizes)]


def _variants(fp: Column, distance: int) -> Column:
    """Array of entry keys: a hash of the masked segment and the place of the masked bit."""
    mask = (1 << 64) - 1
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    keys = []
    for at, w in _segments(distance):
        bits = ((1 << w) - 1) << at
        keys += [F.xxhash64(fp.bitwiseAND(F.lit(signed(bits & ~(1 << (at + i)) & mask)).cast("long")), F.lit(at + i))
                 for i in range(w)]
    return F.array(*keys)


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def link_components(prints: DataFrame, distance: int = 4) -> DataFrame:
    """fp and root for the distinct fingerprints of ``prints`` that have a link."""
    entries = prints.select("fp", F.explode(_variants(F.col("fp"), distance)).alias("entry"))
    hubs = entries.groupBy("entry").agg(
        F.count(F.lit(1)).alias("members"), F.max("fp").alias("h1"), F.min("fp").alias("h2"),
        F.max(F.col("fp").bitwiseXOR(F.lit(_FLIP))).alias("h3")).filter("members > 1")
    hubs = hubs.withColumn("h3", F.col("h3").bitwiseXOR(F.lit(_FLIP))).withColumnRenamed("entry", "__entry")
    # The distance is checked in the join: of small entries only members that link to a hub come out.
    links = [(F.col("fp") != F.col(h)) & (_differ("fp", h) <= distance) for h in ("h1", "h2", "h3")]
    shared = materialize(entries.join(shuffled(hubs), (F.col("entry") == F.col("__entry"))
                                      & ((F.col("members") > 3) | links[0] | links[1] | links[2])).drop("__entry"),
                         "simhash-entries")
    star = (shared.select("fp", F.explode(F.array("h1", "h2", "h3")).alias("hub"))
            .filter((F.col("fp") != F.col("hub")) & (_differ("fp", "hub") <= distance)).distinct())
    first = materialize(components(star, "fp", "hub"), "simhash-first")
    # Entries of three members or fewer had all their pairs compared with the hubs.
    large = shared.filter("members > 3").select("entry", "fp", "h1")
    near = small_or_shuffled(first)
    of = lambda c, name: near.select(F.col("node").alias(c), F.col("root").alias(name))
    large = (large.join(of("fp", "r"), "fp", "left").join(of("h1", "hr"), "h1", "left")
             .select("entry", "fp", F.coalesce("r", "fp").alias("root"), F.coalesce("hr", "h1").alias("hub_root")))
    large = materialize(large, "simhash-large")
    apart = small_or_shuffled(large.filter("root <> hub_root").select("entry", F.col("fp").alias("a"), F.col("root").alias("ra")))
    rest = large.select("entry", F.col("fp").alias("b"), F.col("root").alias("rb"), (F.col("root") != F.col("hub_root")).alias("also"))
    more = (apart.join(rest, "entry").filter((F.col("ra") != F.col("rb")) & (~F.col("also") | (F.col("a") < F.col("b")))
                                             & (_differ("a", "b") <= distance))
            .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    more = materialize(more, "simhash-more")
    if more.isEmpty():
        return first
    joined = components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    return materialize(joined, "simhash-joined")


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id, keep (one row of each component) and text_hash per row."""
    rows = materialize(fingerprints(docs, width, id_col, text_col), "simhash-rows")
    # The row that stays: smallest id, then smallest text hash.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    prints = materialize(rows.groupBy("fp").agg(F.min(order).alias("least")), "simhash-prints")
    linked = small_or_shuffled(link_components(prints.select("fp"), distance))
    roots = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("least").alias("stays"))
    of_print = small_or_shuffled(materialize(roots.join(least, "root").select("fp", "stays"), "simhash-roots"))
    return rows.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("stays.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_hash") == F.col("stays.text_hash"))).alias("keep"),
        "text_hash")


def keep_one(docs: DataFrame, width: int = 4, distance: int = 4,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document per component, with all their columns.

    Rows that repeat both id and text of the one that stays are the same document.
    """
    gone = near_duplicates(docs, width, distance, id_col, text_col).filter("NOT keep").select(
        F.col("doc_id").alias("__gone_id"), F.col("text_hash").alias("__gone_hash")).distinct()
    gone = small_or_shuffled(materialize(gone, "simhash-gone"))
    hit = F.col(id_col).eqNullSafe(F.col("__gone_id")) & (F.xxhash64(text_or_empty(F.col(text_col))) == F.col("__gone_hash"))
    return docs.join(gone, hit, "left_anti")
