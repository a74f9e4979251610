import numpy as np
import pytest
from pyspark.sql import functions as F

from lapstats.functions.ranking import hash_piece, row_numbers, running_sums
from lapstats.operators import evaluate as EV


def _rows(spark, n=3000):
    rng = np.random.default_rng(11)
    rows = [("hot" if i % 10 else "cold", i, float(rng.integers(0, 50)), int(rng.integers(0, 5))) for i in range(n)]
    return spark.createDataFrame(rows + [(None, n, 1.0, 2), (None, n + 1, None, 3)], "k string, i int, v double, c int")


@pytest.mark.parametrize("by_hash", [False, True])
def test_row_numbers_equal_a_sort_of_each_key(spark, by_hash):
    df = _rows(spark)
    digest = F.md5(F.col("i").cast("string"))
    order = [digest, F.col("i")] if by_hash else [F.desc("v"), F.col("i")]
    got = row_numbers(df, ["k"], order, "rn", hash_piece(digest) if by_hash else None, "n")
    assert got.columns == ["k", "i", "v", "c", "rn", "n"]
    pdf = got.withColumn("h", digest).toPandas()
    assert len(pdf) == 3002
    for _, g in pdf.groupby("k", dropna=False):
        g = g.sort_values(["h"] if by_hash else ["v", "i"], ascending=[True] if by_hash else [False, True])
        assert g.rn.tolist() == list(range(1, len(g) + 1)) and set(g.n) == {len(g)}


def test_running_sums_and_empty_table(spark):
    df = _rows(spark)
    out = running_sums(df, ["k"], [F.col("v"), F.col("i")], {"s": "c"}, totals={"t": "c"})
    for _, g in out.where("k IS NOT NULL").toPandas().sort_values(["v", "i"]).groupby("k"):
        assert g.s.tolist() == g.c.cumsum().tolist() and set(g.t) == {g.c.sum()}
    assert row_numbers(df.where("i < 0"), ["k"], [F.col("i")], "rn").count() == 0


def test_a_hot_key_is_ranked_in_pieces(spark):
    out = row_numbers(_rows(spark), ["k"], [F.col("i")], "rn")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    inside = [line for line in plan.splitlines() if "Window" in line]
    assert inside and all("_piece" in line for line in inside)


def test_auc_with_ties_equals_pairs(spark):
    rng = np.random.default_rng(5)
    rows = [("r", int(y), float(s)) for y, s in zip(rng.integers(0, 2, 300), rng.integers(0, 12, 300))]
    df = spark.createDataFrame(rows + [("r", 1, None)], "race string, label int, s double")
    pos, neg = ([s for _, y, s in rows if y == c] for c in (1, 0))
    want = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert EV.auc(df, ["race"], "s").first().auc == pytest.approx(want)
