"""Each operator against brute force, and on awkward and empty inputs."""

import base64
import hashlib
import json
import re
import zlib
from collections import Counter
from importlib import metadata

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from lapstats.llm import (bpe, decontaminate, exact_dedup, licenses, quality_nbsvm, queries, secrets, sharding, simhash,
                          toxicity_cnn, training_order)
from lapstats.llm.common import table
from lapstats.llm.feistel import invert_int, permute, permute_int
from lapstats.llm.graph import components
from lapstats.llm.labels import fold, labelled_sample
from tests.llm.helpers import ROWS, awkward, on_disk

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


# --- exact dedup ---

def _groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    return groups


def test_exact_dedup_matches_brute_force(docs, texts):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {i: (min(v), len(v), i == min(v), hashlib.sha256(k.encode()).hexdigest())
                   for k, v in _groups(texts.items()).items() for i in v}


def test_exact_dedup_compares_whole_texts_when_digests_collide(docs, texts):
    weak = exact_dedup.exact_dedup(docs, digest=lambda t: F.substring(exact_dedup.sha256(t), 1, 1))
    got = {r.doc_id: (r.keep_id, r.group_size) for r in weak.collect()}
    assert got == {i: (min(v), len(v)) for v in _groups(texts.items()).values() for i in v}


def test_exact_dedup_over_several_micro_batches(docs, texts):
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(docs.repartition(4), files_per_batch=1).collect()}
    assert got == {i: (min(v), len(v)) for v in _groups(texts.items()).values() for i in v}


def test_exact_dedup_awkward(spark):
    rows = exact_dedup.exact_dedup(awkward(spark)).collect()
    assert len(rows) == len(ROWS) and sum(r.kept for r in rows) == len(_groups([r[:2] for r in ROWS]))
    assert {r.doc_id: r.keep_id for r in rows}[4] == 3 and {r.doc_id: r.keep_id for r in rows}[2] == 1
    kept = exact_dedup.keep_first(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.count() == sum(r.kept for r in rows)


# --- shards and permutation ---

@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1001])
def test_feistel_is_a_permutation_and_agrees_with_columns(spark, n):
    want = [permute_int(i, n, 9) for i in range(n)]
    assert sorted(want) == list(range(n)) and [invert_int(s, n, 9) for s in want] == list(range(n))
    assert [r.p for r in spark.range(n).select("id", permute("id", n, 9).alias("p")).orderBy("id").collect()] == want


def test_shards(docs, texts):
    rows = sharding.assign_shards(docs, 8).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
    count = Counter(r.shard for r in rows)
    assert set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    assert {(r.shard, r.slot) for r in rows} == {(s, k) for s, n in count.items() for k in range(n)}
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.assign_shards(docs.repartition(5), 8).collect()} == {
        r.doc_id: (r.shard, r.slot) for r in rows}


def test_write_shards_keeps_all_rows(spark, tmp_path):
    out = sharding.write_shards(awkward(spark), str(tmp_path / "s"), 3)
    assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(str(r[:2]) for r in ROWS)
    assert len({(r["__shard"], r["__slot"]) for r in out.collect()}) == len(ROWS)


# --- decontamination ---

def _contaminated(docs, items, window=10):
    wins = {}
    for item, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        for i in range(max(len(w) - window + 1, 1)) if w and item is not None else []:
            wins.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    out = []
    for i, t in docs:
        w, hit, names = WORD.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(k) for k in wins}:
            for s in range(len(w) - n + 1):
                if found := wins.get(tuple(w[s:s + n])):
                    hit.update(range(s, s + n))
                    names |= found
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def test_decontamination_matches_brute_force(spark, docs, texts):
    bench = table(spark, SF, "benchmark")
    want = _contaminated(texts.items(), [(r.item_id, r.text) for r in bench.collect()])
    assert _got(decontaminate.contamination(docs, bench)) == want and any(r[-1] for r in want)
    assert decontaminate.keep_clean(docs, bench).count() == sum(not r[-1] for r in want)


def test_decontamination_short_items_case_and_awkward_rows(spark):
    items = [(1, "ALPHA beta"), (2, "alpha Beta"), (3, None), (4, "..."), (None, "gamma delta"), (5, "mit"),
             (6, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (7, "Été"), (8, "été")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS words", "2 AS size")
    assert _got(decontaminate.contamination(awkward(spark), bench)) == _contaminated([r[:2] for r in ROWS], items)
    none = decontaminate.contamination(awkward(spark), bench.filter("item_id > 99"))
    assert none.count() == len(ROWS) and none.filter("contaminated").count() == 0


def test_decontamination_searches_items_without_id(spark):
    bench = spark.createDataFrame([(None, "kappa lambda"), (1, "alpha beta"), (None, "no id here")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.contamination(awkward(spark), bench).collect()}
    assert (rows[1].n_hit, rows[1].n_items, rows[1].contaminated) == (4, 1, True)
    assert (rows[None].n_hit, rows[None].n_items, rows[None].contaminated) == (3, 0, True)
    assert rows[None].items_sha256 == hashlib.sha256(b"").hexdigest() and not rows[8].contaminated
    assert {r.doc_id for r in decontaminate.keep_clean(awkward(spark), bench).collect()} == {r[0] for r in ROWS} - {1, 2, None}


# --- SimHash ---

def _fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", text.translate(LOWER))
    grams = [" ".join(w[i:i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _linked(prints, distance):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_simhash_matches_brute_force(docs, texts):
    rows = sorted(simhash.near_duplicates(docs).collect(), key=lambda r: r.doc_id)
    ids = sorted(texts)
    prints = [_fingerprint(texts[i]) for i in ids]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in rows] == [ids[k] for k in _linked(prints, 4)]


def test_simhash_links_within_crowded_entries(spark):
    """Many prints that share segments: nothing may be lost behind the hubs."""
    pick = np.random.default_rng(5)
    base = [int(x) for x in pick.integers(0, 1 << 63, 3)]
    prints = {b ^ sum(1 << int(k) for k in pick.choice(64, pick.integers(0, 8), replace=False)) for b in base for _ in range(120)}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    got = {r.node: r.root for r in simhash.link_components(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()}
    want = _linked([p & ((1 << 64) - 1) for p in prints], 4)
    mine = [got.get(p, p) for p in prints]
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_simhash_awkward(spark):
    rows = simhash.near_duplicates(awkward(spark)).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[3].fingerprint == by[4].fingerprint == "0" * 16 and by[4].component_id == 3 and by[2].component_id == 1
    assert simhash.keep_one(awkward(spark)).columns == awkward(spark).columns


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i * 37 % 101, (i + 1) * 37 % 101) for i in range(100)], "a long, b long")
    assert {r.root for r in components(links).collect()} == {0}


# --- BPE ---

@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_the_library_on_odd_texts(encoding):
    pick = np.random.default_rng(3)
    odd = ["", " ", "  a  b", "a \n b ", "\n", "it's 's  'S", "a  b　", "x" * 3000 + " " + "ab" * 500, "aaaa aaaaaaa", "\0 a \0", "\0 "]
    odd += ["".join(pick.choice(list("ab \n\t'se1.éſ中"), pick.integers(0, 30))) for _ in range(3000)]
    coded = bpe.Encoder(bpe.vocabulary(open(RANKS, "rb").read()), public_tokenizers.PATTERN).block(odd)
    assert [np.frombuffer(c, "<i4").tolist() for c in coded] == [encoding.encode_ordinary(t) for t in odd]


def test_bpe_one_by_one_equals_all_at_once():
    vocab = bpe.vocabulary(open(RANKS, "rb").read())
    words = [b" theaterwh", b"aaaaaaa", b"", b"\xff\xfe", b" anonouedtion"]
    assert vocab.replay(words) == vocab.replay(words, one_by_one=True)


def test_bpe_query_and_round_trip(spark, docs, texts, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 50_000)
    ids = {i: encoding.encode_ordinary(t) for i, t in texts.items()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op4_bpe(spark, SF).collect()}
    assert got == {i: (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(),
                       hashlib.sha256(texts[i].encode()).hexdigest()) for i, x in ids.items()}
    awk = bpe.decode(bpe.encode(awkward(spark), RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert sorted(bytes(r.decoded) for r in awk) == sorted((t or "").encode() for _, t, _ in ROWS)


# --- classifiers ---

def _held_out(scored, spark, label, modulus, rest, threshold):
    rows = scored.join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").filter(fold(modulus) == rest).collect()
    return [(r.score >= threshold, r[label] == 1) for r in rows]


def test_quality_held_out(spark):
    big = "/root/testdata/sf0.1"
    rows = _held_out(queries.op1_quality_nbsvm(spark, big), spark, "quality", 5, 0, queries.GOOD)
    assert sum(p == y for p, y in rows) / len(rows) > 0.95
    assert sum(p for p, y in rows if y) / sum(y for _, y in rows) > 0.98


def test_toxicity_held_out(spark):
    big = "/root/testdata/sf0.1"
    rows = _held_out(queries.op5_toxicity_cnn(spark, big), spark, "toxic", 3, 1, queries.TOXIC)
    assert sum(p == y for p, y in rows) / len(rows) > 0.95
    assert sum(p for p, y in rows if not y) / sum(not y for _, y in rows) < 0.02


@pytest.mark.parametrize("op,label", [(quality_nbsvm, "quality"), (toxicity_cnn, "toxic")])
def test_classifiers_awkward(spark, op, label):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (5, 1), (6, 0), (7, 1), (9, 0)], f"doc_id long, {label} int")
    model = op.fit(docs, labels, label, F.lit(True))
    assert [0 <= r.score <= 1 for r in op.score(docs, model).collect()] == [True] * len(ROWS)
    for bad in (labels.filter("doc_id > 99"), labels.filter(f"{label} = 1 AND doc_id > 1")):
        scores = {round(r.score, 6) for r in op.score(docs, op.fit(docs, bad, label, F.lit(True))).collect()}
        assert len(scores) == 1
    assert op.score(docs.filter("doc_id > 99"), model).count() == 0


def test_toxicity_trains_away_from_the_driver(spark, monkeypatch):
    """The texts' words stay in the task: nothing but the model may come to the driver."""
    def no_arrow(*_):
        raise AssertionError("rows collected")

    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.toArrow", no_arrow)
    docs = spark.createDataFrame([(i, ("bad" if i % 2 else "good") + f" words {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity_cnn.fit(docs, labels, "toxic", F.lit(True))
    scores = {r.doc_id: r.score for r in toxicity_cnn.score(docs, model).collect()}
    assert min(scores[i] for i in range(1, 60, 2)) > max(scores[i] for i in range(0, 60, 2))


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Several tasks train, every row is in one of them, and what few rows alone tell is learned."""
    monkeypatch.setattr(toxicity_cnn, "TASK_ROWS", 700)
    rare = range(0, 12000, 150)  # 80 rows of a word that no other toxic row has
    docs = spark.createDataFrame([(i, ("vile" if i in rare else "bad" if i % 2 else "good") + f" words {i % 50}") for i in range(12000)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in rare or i % 2)) for i in range(12000)], "doc_id long, toxic int")
    seen = []
    whole = toxicity_cnn._round

    def counted(rows, *rest):
        seen.append((rows.count(), rows.select("__part").distinct().count()))
        return whole(rows, *rest)

    monkeypatch.setattr(toxicity_cnn, "_round", counted)
    model = toxicity_cnn.fit(docs, labels, "toxic", F.lit(True))
    assert len(seen) == toxicity_cnn.ROUNDS and all(n > 9000 and parts > 10 for n, parts in seen)
    got = toxicity_cnn.score(docs, model).drop("toxic").join(labels, "doc_id").groupBy("toxic").agg(
        F.min("score").alias("lo"), F.max("score").alias("hi")).collect()
    got = {r.toxic: (r.lo, r.hi) for r in got}
    assert got[1][0] > 0.7 > 0.3 > got[0][1]


def test_sample_holds_each_id_once(spark):
    docs = spark.createDataFrame([(i, f"text {k % 7} of {i}", "en") for i in range(6) for k in range(20)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    for rows in (3, 6, 50):
        got = labelled_sample(docs, labels, "quality", F.lit(True), rows, docs["lang"].alias("__lang")).collect()
        assert len({r["__id"] for r in got}) == len(got) == min(rows, 6)
        for r in got:
            texts = [f"text {k} of {r['__id']}" for k in range(7)]
            assert r["__text"] == min(texts, key=lambda t: np.array(xxhash.xxh64_intdigest(t.encode(), 42), np.uint64).astype(np.int64))


def test_quality_keeps_columns(spark):
    docs = awkward(spark)
    model = quality_nbsvm.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), "quality", F.lit(True))
    assert quality_nbsvm.keep_good(docs, model, 0.0).collect() == docs.collect()


# --- secrets ---

def _base(text):
    out = [("assign", m) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) > 5]
    out += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) > 19]
    out += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) > 23]
    order = ["assign", "access", "hex"]
    return sorted(((k, m.start(), m.end()) for k, m in out), key=lambda x: (x[1], order.index(x[0])))


def test_secret_query_matches_brute_force(spark, texts):
    for r in queries.op6_secrets(spark, SF).collect():
        base = _base(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in secrets.BASE)
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_secret_base_semantics():
    for t in ("secret: token: abcdefgh", "API_KEY='a==bcdef' paSSwd=x", "toKen=abcdefg", "AKIA" + "A" * 16, "\U0001f600 token=abcdef1"):
        assert [s for s in secrets.find(t) if s[0] in secrets.BASE] == _base(t)


def _der(tag, body):
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


def test_secrets_are_confirmed_by_structure():
    key = _der(0x30, _der(2, b"\0") + _der(2, bytes(range(1, 129))) + _der(2, b"\1\0\1"))
    text = base64.b64encode(key).decode()
    assert ("der", 2, 2 + len(text)) in secrets.find("k " + text)
    broken = base64.b64encode(key[:-1]).decode()
    assert not [s for s in secrets.find(broken) if s[0] == "der"]
    assert [s[0] for s in secrets.find(f"-----BEGIN RSA PRIVATE KEY-----\n{text}\n-----END RSA PRIVATE KEY-----")][0] == "pem"
    assert "hexder" in [s[0] for s in secrets.find(key.hex().upper())]
    part = lambda x: base64.urlsafe_b64encode(x).rstrip(b"=").decode()
    head, body = part(json.dumps({"alg": "HS256"}).encode()), part(json.dumps({"sub": "1"}).encode())
    assert [s[0] for s in secrets.find(f"{head}.{body}.{part(bytes(32))}")][:1] == ["jwt"]
    assert not [s for s in secrets.find(f"{head}.{body}.{part(bytes(31))}") if s[0] == "jwt"]
    blob = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", bytes(32)))
    assert [s[0] for s in secrets.find(base64.b64encode(blob).decode())] == ["ssh"]


def test_hex_keys_behind_a_prefix():
    key = _der(0x30, _der(2, b"\0") + _der(2, bytes(range(1, 129))) + _der(2, b"\1\0\1"))
    for digits in (key.hex(), key.hex().upper()):
        for before in ("0x", "key_", "id-", "path/", "Key=", "\\x", "abc", "0030"):
            spans = [s for s in secrets.find(before + digits + " end") if s[0] == "hexder"]
            assert spans == [("hexder", len(before), len(before) + len(digits))], before
    assert not [s for s in secrets.find("0x" + key.hex()[:-2]) if s[0] == "hexder"]


def _wrapped(text, width, between="\n"):
    return between.join(text[i:i + width] for i in range(0, len(text), width))


def test_base64_keys_that_are_not_one_clean_run():
    rsa = _der(0x30, _der(2, b"\0") + _der(2, bytes(range(1, 200)) + bytes(57)) + _der(2, b"\1\0\1") + _der(2, bytes(range(90, 190))))
    field = lambda *xs: b"".join(len(x).to_bytes(4, "big") + x for x in xs)
    blob = field(b"ssh-rsa", b"\1\0\1", bytes(range(1, 250)) + bytes(8))
    box = b"openssh-key-v1\0" + field(b"none", b"none", b"") + b"\0\0\0\1" + field(blob, bytes(range(200)))
    for kind, data in (("der", rsa), ("ssh", blob), ("ssh", box)):
        key = base64.b64encode(data).decode()
        forms = [(b, key, a) for b in ("key-", "path/", "+", "a", "ab", "abc", "id_") for a in ("", " end", "\nend")]
        forms += [("x: ", _wrapped(key, w, s), a) for w in (64, 76) for s in ("\n", "\r\n", "\n  ", "\\n", "\\r\\n", '" +\n  "', "\n> ")
                  for a in (" end", "\nend", "\n")]
        forms += [('"\\n', _wrapped(key, 64, "\\n"), '\\n"'), ("+", _wrapped(key, 64, "\n+"), "\n }"), ("-", _wrapped(key, 64, "\n-"), "\n+x")]
        for before, body, after in forms:
            spans = [s for s in secrets.find(before + body + after) if s[0] in ("der", "ssh")]
            assert spans == [(kind, len(before), len(before) + len(body))], (kind, before, body[60:90], after)
        if data is blob:
            continue
        for s in ("\n", "\\n", "\\\\n", "\\r\\n", '\\n" +\n    "', "\n+", "\n-", "\n> ", "\n# ", "\\n\\\n"):
            pem = s.join(["-----BEGIN PRIVATE KEY-----", *_wrapped(key, 64).split("\n"), "-----END PRIVATE KEY-----"])
            assert [x for x in secrets.find('k = "' + pem + '"') if x[0] == "pem"] == [("pem", 5, 5 + len(pem))], s
        assert not [s for s in secrets.find("key-" + _wrapped(key[:-8], 64)) if s[0] in ("der", "ssh", "pem")]


# --- licenses ---

def test_licenses_on_documents(spark, texts):
    rows = {r.doc_id: {(m.license, m.start) for m in r.matches} for r in licenses.scan(table(spark, SF, "documents")).collect()}
    for i, t in texts.items():
        want = {(k, m.start()) for k, v in licenses.TEMPLATES.items() for m in re.finditer(re.escape(v), t)}
        assert want <= rows[i], i
        assert bool(rows[i]) == bool(want)


def test_license_alignment_survives_edits():
    index = licenses.Index(licenses.TEMPLATES)
    text = licenses.TEMPLATES["MIT-text"].replace("free of charge", "wholly free of any charge").replace("publish, ", "")
    (name, cover, matched, start, end), = index.match("É " + text + " tail", 0.8)
    assert name == "MIT-text" and 0.9 < cover < 1 and start == 2 and ("É " + text)[start:end] == text.rstrip(":")
    assert index.match("Permission is hereby granted to leave early.", 0.8) == []
    assert len(index.match("Released under the MIT License. " * 50, 0.8)) == 50
    with pytest.raises(ValueError):
        licenses.Index({"x": "two words"})


def test_licenses_of_installed_packages():
    """An independent list: packages name their license in their metadata and carry its text."""
    family = {"MIT": "MIT", "MIT License": "MIT", "BSD-3-Clause": "BSD-3-Clause", "BSD-2-Clause": "BSD-2-Clause",
              "Apache-2.0": "Apache-2.0", "Apache Software License": "Apache-2.0", "MPL-2.0": "MPL-2.0",
              "Mozilla Public License 2.0 (MPL 2.0)": "MPL-2.0"}
    index = licenses.Index(licenses.TEMPLATES)
    seen = Counter()
    for d in metadata.distributions():
        named = [x.split(" :: ")[-1] for x in d.metadata.get_all("Classifier") or [] if x.startswith("License")]
        want = {family[x] for x in [*named, d.metadata.get("License-Expression") or ""] if x in family}
        files = [f for f in d.files or [] if re.fullmatch(r"LICENSE(\.txt|\.md)?", f.name) and ".dist-info" in str(f) and f.locate().exists()]
        if len(want) != 1 or not files:
            continue
        found = {m[0] for f in files for m in index.match(f.read_text(encoding="utf-8"), 0.8)}
        assert any(f.startswith(w) for f in found for w in want), (d.metadata["Name"], want, found)
        seen.update(want)
    assert not seen or sum(seen.values()) > 5


def test_whole_licenses_and_headers():
    index = licenses.Index(licenses.TEMPLATES)
    assert {"MPL-2.0", "LGPL-2.1", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense", "BSL-1.0", "Apache-2.0", "GPL-3.0"} <= set(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        (best, *_), *_ = sorted(index.match("Head. " + text + " Tail.", 0.8), key=lambda m: (-m[2], -m[1], m[0]))
        assert best == name
    best = lambda t: max(index.match(t, 0.8), key=lambda m: m[1:3])[0]
    assert best("(c) 2020 A. All rights reserved.") == "All-rights-reserved-notice"
    header = licenses.TEMPLATES["GPL-text"].replace("General", "{} General")
    assert best(header.format("Lesser")) == "LGPL-3.0-header" and best(header.format("Affero")) == "AGPL-3.0-header"
    # The words of a text in another order are no match.
    assert not index.match(" ".join(sorted(licenses.TEMPLATES["MPL-2.0"].split())), 0.8)


def test_short_licenses_with_a_word_replaced_or_put_in():
    index = licenses.Index(licenses.TEMPLATES)
    for name in ("MIT-notice", "CC-BY-NC-4.0-notice", "Apache-2.0-notice", "GPL-3.0-notice", "CC-BY-4.0-text", "BSD-text"):
        own = WORD.findall(licenses.TEMPLATES[name].translate(LOWER))
        for i in range(len(own)):
            for changed in (own[:i] + ["other"] + own[i + 1:], own[:i] + ["other"] + own[i:], own[:i] + own[i + 1:]):
                assert name in [m[0] for m in index.match("Note: " + " ".join(changed) + " Then more.", 0.8)], (name, changed)
    assert [m[0] for m in index.match("Released under an MIT License", 0.8)] == ["MIT-notice"]
    with pytest.raises(ValueError):
        index.match("Released under an MIT License", 0.5)


def test_license_candidates_miss_nothing_that_alignment_finds():
    pick = np.random.default_rng(7)
    for n in (5, 9, 20, 32, 33, 60):
        own = [f"w{k}" for k in range(n)]
        index = licenses.Index({"t": " ".join(own)})
        for _ in range(60):
            text = list(own)
            for k in pick.choice(n, n // 5, replace=False):
                text[k] = "other"
            (name, cover, *_), = index.match("before " * 9 + " ".join(text) + " after" * 9, 0.8)
            assert cover == (n - n // 5) / n


def test_scans_awkward(spark):
    for op in (secrets, licenses):
        assert op.scan(awkward(spark)).count() == len(ROWS) and op.scan(awkward(spark).filter("doc_id > 99")).count() == 0


# --- training order ---

def test_training_order_round_trip(spark, tmp_path):
    docs = on_disk(awkward(spark).repartition(3), tmp_path)
    out = tmp_path / "shards"
    rows = training_order.materialise(docs, training_order.byte_ids(F.col("text")), str(out), length=64, per_shard=100, key=5).collect()
    n = len(rows)
    shard = {k: b"".join(p.read_bytes() for p in sorted(out.glob(f"shard={k}/part-*"))) for k in {r.shard for r in rows}}
    assert sum(map(len, shard.values())) == n * 65 and {r.slot for r in rows} == set(range(n))
    parts = {}
    for r in sorted(rows, key=lambda r: r.seq_no):
        record = shard[r.shard][r.byte_offset:r.byte_offset + 64]
        assert zlib.crc32(record) == r.record_crc32 and permute_int(r.seq_no, n, 5) == r.slot
        if r.part == 0:
            parts[r.seq_no] = last = bytearray()
        last += record[:r.n_tokens]
    assert sorted(map(bytes, parts.values())) == sorted((t or "").encode() + b"\xff" for _, t, _ in ROWS)
    none = training_order.materialise(docs.filter("doc_id > 99"), training_order.byte_ids(F.col("text")), str(tmp_path / "e"))
    assert none.count() == 0


def test_signed_tokens_are_found_in_linear_time():
    import time

    rng = np.random.default_rng(2)
    old = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
    for _ in range(2000):
        t = "".join(rng.choice(["eyJ", "eyJ", "a", ".", ".", " ", "-", "x.y"], 30))
        assert list(secrets._tokens(t)) == [m.span() for m in old.finditer(t)]
    began = time.time()
    assert secrets.find("eyJ" * 200_000) == [] and secrets.find("eyJa." * 100_000) == []
    assert time.time() - began < 60


@pytest.mark.parametrize("name", ["MIT", "BSD-3-Clause", "ISC", "Apache-2.0", "GPL-3.0"])
def test_licenses_with_words_put_in_are_found(name):
    index = licenses.Index(licenses.TEMPLATES)
    words = licenses.TEMPLATES[name].split()
    rng = np.random.default_rng(len(words))
    few = len(words) > 1000  # the long ones take seconds each
    for k in (8, 200) if few else (5, 8, 14, 20, 60, 200):
        for share in (0.5,) if few else (0.2, 0.5, 0.9):
            at = int(len(words) * share)
            put_in = [f"zq{i}{k}" for i in rng.integers(0, 10**6, k)]
            text = " ".join(["before"] * 7 + words[:at] + put_in + words[at:] + ["after"] * 7)
            found = {m[0]: m for m in index.match(text, 0.8)}
            # A part that covers enough alone is a match of its own; two halves are chained.
            assert name in found and found[name][1] >= (0.97 if share == 0.5 else 0.8), (k, share, found.get(name))
            assert found[name][2] <= licenses._hashes(licenses.TEMPLATES[name]).size
    # In several places at once.
    parts = np.array_split(np.array(words, object), 4)
    text = " ".join(" ".join([*p, *[f"yy{i}" for i in range(30)]]) for p in parts)
    assert name in {m[0] for m in index.match(text, 0.8)}


def test_keep_first_keeps_a_column_of_the_locators_name(spark):
    df = awkward(spark).withColumn("__at", F.lit("mine"))
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns and {r["__at"] for r in kept.collect()} == {"mine"}
