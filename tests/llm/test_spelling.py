"""Spelling variants against brute force over all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lapstats.llm import queries, spelling
from lapstats.llm.common import table
from tests.llm.helpers import awkward

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    p = next((i for i in range(len(b)) if a[i] != b[i]), len(b))
    return a[p + 1:] == (b[p + 1:] if len(a) == len(b) else b[p:])


def _words(docs, least, every=31):
    count = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += len(run) >= least
    return {w: n for w, n in count.items() if n >= 2}


def _grouped(n, ratio=10):
    # Words one edit apart share a string with one letter left out, or are one apart in length.
    holes = {}
    for w in n:
        for k in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            holes.setdefault(k, set()).add(w)
    near = {w: {o for k in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} for o in holes[k] if _one_edit(w, o)} for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None))
    return out


def _rows(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = _rows(queries.op12_spelling(spark, SF))
    assert got == _grouped(_words(docs, 7)) and any(r[1] is not None for r in got)


@pytest.mark.parametrize("symbols", [2, 5, 8])
def test_any_number_of_symbols_gives_the_same_groups(spark, symbols):
    rng = np.random.default_rng(symbols)
    base = ["".join(rng.choice(list("abcdé"), 8)) for _ in range(12)]
    text = " ".join([w for w in base for _ in range(40)] + [w[:i] + c + w[i + 1:] for w in base for i in range(8) for c in "ax"] * 2
                    + [w[:i] + w[i + 1:] for w in base for i in range(8)] * 3)
    docs = [(1, text), (None, text), (2, None), (3, ""), (3, "é" * 3000 + " " + "é" * 2999), (4, "é" * 3000 + " " + "é" * 2999)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _rows(spelling.spelling_variants(df, least=3, ratio=4, symbols=symbols)) == _grouped(_words(docs, 3, 0), 4)
    assert _rows(spelling.spelling_variants(df, least=3, symbols=symbols, slip_every=3)) == _grouped(_words(docs, 3, 3))


def test_neighbourhoods_hold_every_word_one_edit_away():
    rng = np.random.default_rng(0)
    for _ in range(300):
        w = "".join(rng.choice(list("abcdefgh"), rng.integers(1, 12)))
        p, c = rng.integers(len(w)), rng.choice(list("abcdefgh"))
        for o in (w[:p] + w[p + 1:], w[:p] + c + w[p + 1:], w[:p] + c + w[p:]):
            if o and o != w:
                own, number, h = spelling.neighbourhoods([w, o], 5)
                assert own[1] in h[number == 0] or own[0] in h[number == 1]


def test_awkward_and_empty(spark):
    rows = _rows(spelling.spelling_variants(awkward(spark), least=1, count=1))
    assert {r[0]: r[3] for r in rows}["alpha"] == 2
    assert _rows(spelling.spelling_variants(awkward(spark).limit(0))) == set()
