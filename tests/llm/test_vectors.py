"""Vector codes and top-k search against brute force, and on awkward and empty tables."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapstats.llm import queries, topk, vector_codes
from lapstats.llm.common import table

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
#: Nulls, non-finite components, ties, repeated rows, short vectors; columns with clashing names.
ROWS = [(1, [0.5, -0.25, 0.0], 1), (2, [0.5, -0.25, 0.0], None), (2, [0.5, -0.25, 0.0], None), (3, None, 1), (4, [NAN, 1.0, 1.0], 2),
        (5, [1.0, INF, 0.0], 2), (6, [1.0, None, 0.0], 2), (7, [], 3), (8, [2.0], 3), (None, [0.1, 0.2, 0.3], 1),
        (10, [-3.0, 1e-9, -1e-9], None), (50, [0.5, 0.5, 0.5], 1), (100, [-1.0, -1.0, 4.0], 2)]


def awkward(spark):
    return spark.createDataFrame(ROWS, "vec_id long, embedding array<double>, label int").selectExpr(
        "*", "1 AS v", "2 AS vid", "3 AS ids", "'c' AS code", "4 AS error", "5 AS rank", "6 AS block", "7 AS __n", "8 AS query")


def _usable(rows, scale):
    width = max([len(r[1]) for r in rows if r[1] is not None], default=0)
    return [(r[0], [int(np.floor(scale * x)) for x in r[1]] + [0] * (width - len(r[1])), r[2]) for r in rows
            if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]


def _codes(rows, scale, parts, entries, rounds):
    """(id, code, error) sorted, and the digest of the codebooks, one part and one entry at a time."""
    rows = _usable(rows, scale)
    width = -(-max((len(r[1]) for r in rows), default=0) // parts)
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[tuple((r[1] + [0] * (parts * width - len(r[1])))[p * width:(p + 1) * width]) for p in range(parts)] for r in rows]
    books = [[cut[i][p] for i in range(min(entries, len(rows)))] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for c in cut:
                held.setdefault(near(c[p], books[p])[1], []).append(c[p])
            for e, xs in held.items():
                books[p][e] = tuple(sum(x[d] for x in xs) // len(xs) for d in range(width))
    out = []
    for r, c in zip(rows, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), r[2]))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    of_label = {}
    for r in out:
        of_label[r[3]] = of_label.get(r[3], 0) + r[2]
    return sorted([(r[0], r[1], r[2], of_label[r[3]]) for r in out], key=str), digest


@pytest.mark.parametrize("entries,parts", [(16, 8), (3, 2), (5, 1)])
def test_codes_of_awkward_rows(spark, entries, parts):
    coded, books = vector_codes.compress(awkward(spark), 64, parts, entries, 4)
    want, digest = _codes(ROWS, 64, parts, entries, 4)
    assert sorted([(r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()], key=str) == want
    assert books.sha256 == digest


def test_codes_query_matches_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in table(spark, SF, "embeddings").collect()]
    want, digest = _codes(rows, 4096, 8, 16, 6)
    got = queries.op11_vector_codes(spark, SF).collect()
    assert sorted([(r.vec_id, r.code, r.error, r.label_error) for r in got], key=str) == want
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_codes_of_nothing(spark):
    coded, _ = vector_codes.compress(awkward(spark).limit(0))
    assert coded.collect() == []


@pytest.mark.parametrize("m,dims,radius", [(1, 3, 0), (16, 8, 5), (70, 4, None), (130, 2, 1)])
def test_nearest_entry_is_exact_for_any_radius(m, dims, radius):
    rng = np.random.default_rng(m)
    entries, rows = rng.integers(-20, 20, (m, dims)), rng.integers(-40, 40, (500, dims))
    chosen, distance = vector_codes.Codebook(entries).nearest(rows, radius)
    every = ((rows[:, None] - entries) ** 2).sum(2)
    assert (chosen == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_masks_hold_the_entries_of_the_cube():
    rng = np.random.default_rng(1)
    entries, rows = rng.integers(0, 9, (70, 3)), rng.integers(0, 9, (50, 3))
    mask = vector_codes.Codebook(entries).inside(rows, np.full(50, 2))
    inside = (np.abs(rows[:, None] - entries) <= 2).all(2)
    bits = (mask[:, np.arange(70) // 64] >> (np.arange(70) % 64).astype(np.uint64)) & np.uint64(1)
    assert (bits.astype(bool) == inside).all()


def test_codes_decode_to_their_entries(spark):
    df = table(spark, SF, "embeddings")
    coded, books = vector_codes.compress(df, rounds=2)
    rows = {r.vec_id: np.floor(4096 * np.array(r.embedding, float)) for r in df.collect()}
    for r, v in zip(got := coded.collect(), vector_codes.decode([r.code for r in got], books), strict=True):
        assert ((rows[r.vec_id] - v) ** 2).sum() == r.error


# --- top-k ---

def _search(rows, is_query, k, scale):
    held = sorted({(r[0], tuple(r[1])) for r in _usable(rows, scale) if r[0] is not None})
    out = []
    for q, x in held:
        if is_query(q):
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in held if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def _found(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_topk_query_matches_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in table(spark, SF, "embeddings").collect()]
    assert _found(queries.op13_topk(spark, SF)) == _search(rows, lambda i: i % 50 == 0, 5, 256)


@pytest.mark.parametrize("k", [1, 3, 20])
def test_topk_of_awkward_rows(spark, k):
    assert _found(topk.search(awkward(spark), F.col("vec_id") % 2 == 0, k, 16)) == _search(ROWS, lambda i: i % 2 == 0, k, 16)


def test_topk_over_many_blocks_with_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 20)
    monkeypatch.setattr(topk, "QUERIES", 3)
    monkeypatch.setattr(topk, "CHUNK", 2)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * 40).tolist() if i % 3 else [9.0, -3.0, 1.0, 0.0, 2.0, 5.0], 0) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert _found(topk.search(df, F.col("vec_id") % 5 == 0, 4, 100)) == _search(rows, lambda i: i % 5 == 0, 4, 100)


def test_topk_of_nothing(spark):
    assert _found(topk.search(awkward(spark).limit(0), F.col("vec_id") % 2 == 0)) == []
    assert _found(topk.search(awkward(spark), F.col("vec_id") < 0)) == []


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, q = rng.integers(-900, 900, (400, 7)), rng.integers(-900, 900, (30, 7))
    spread = np.stack([x.min(0), x.max(0)])
    low, step = topk._cells(spread)
    cells = ((x - low) // step).astype(np.uint8)
    up, wide = topk.upper_bounds(q, cells, spread)
    assert (up >= q @ x.T).all() and (up - wide[:, None] <= q @ x.T).all()


def test_arrow_batches_of_blocks_are_bounded_in_bytes(spark):
    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [b.nbytes]})

    big = spark.range(0, 300, 1, 1).selectExpr("repeat('x', 1000000) AS s")
    assert max(r.bytes for r in big.mapInArrow(sizes, "bytes long").collect()) < 80_000_000
