"""Byte-level BPE encoding by corpus-level merge replay, and decoding.

A task takes a block of texts and works on its distinct pre-tokens together. All
their bytes lie in one linked list; an inverted index maps the rank of a token
pair to the positions in all words where it stands. Merges are replayed in rank
order over the whole block: the positions of the lowest rank are merged from
left to right, and only the pairs next to a merge leave or enter the index. If a
merge makes a pair of lower rank, that pair goes first. Each word thus sees its
merges in the order in which it would see them alone.

Texts are cut at single spaces first, and each distinct piece is pre-tokenised
once; a piece at whose edge other white space stands sends its text to the
pattern as a whole, as the pattern looks across such white space.

The rank file is read on the driver and broadcast (a file of fixed size), so
executors need no copy. A task holds one Arrow batch, a block's index and a
bounded memory of pieces (``_REMEMBER``, which only saves work).

Defined cases: a null text is an empty one, with no ids; a decoded empty list is
the empty byte string; repeated rows are encoded alike; an empty table gives an
empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.llm.common import gives_back, parts_of, text_or_empty

#: UTF-8 bytes of the texts that are replayed together.
BLOCK = 4_000_000
#: Pieces that a task remembers between blocks; they go when it ends.
_REMEMBER = 200_000


class Vocabulary:
    """Token bytes by id, and the id that a pair of ids merges to."""

    def __init__(self, rank_file: bytes) -> None:
        rank = {base64.b64decode(t): int(r) for t, r in (line.split() for line in rank_file.splitlines() if line)}
        self.rank, self.width = rank, max(rank.values()) + 1
        self.token = [b""] * self.width
        for t, r in rank.items():
            self.token[r] = t
        self.byte = np.array([rank[bytes([i])] for i in range(256)], np.int32)
        # A pair merges when its joined bytes are a token, however that token first came about.
        merged = sorted((rank[t[:i]] * self.width + rank[t[i:]], r) for t, r in rank.items()
                        for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank)
        self.pair, self.to = np.array([*merged, (1 << 62, -1)], np.int64).T.copy()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id that each pair merges to, -1 for none; negative ids are no tokens."""
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.pair, key)
        return np.where((self.pair[at] == key) & (left >= 0) & (right >= 0), self.to[at], -1)

    def replay(self, words: list[bytes], one_by_one: bool = False) -> list[bytes]:
        """Ids of each word as little-endian 32-bit bytes.

        All places of a rank are merged at once, as a rank's merges in other words
        don't touch and in one word go from left to right. That is the words' own
        order as long as no merge makes a pair of lower rank; should one, the
        block is replayed again ``one_by_one``, lowest rank and leftmost place first.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.full(int(size.sum()) + len(words) + 1, -1, np.int32)
        first = np.cumsum(size + 1) - size  # -1 stands before each word and at the end
        inside = np.ones(len(ids), bool)
        inside[first - 1] = inside[-1] = False
        ids[inside] = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, len(ids) + 1, dtype=np.int32), np.arange(-1, len(ids) - 1, dtype=np.int32)
        after[-1] = len(ids) - 1
        to = np.full(len(ids), -1, np.int32)
        to[:-1] = self.ranks(ids[:-1], ids[1:])
        index: defaultdict[int, list[np.ndarray]] = defaultdict(list)

        def enter(places: np.ndarray) -> None:
            found = to[places]
            places, found = places[found >= 0], found[found >= 0]
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            ends = [0, *cuts.tolist(), len(found)]
            for r, s, e in zip(found[ends[:-1]].tolist() if len(found) else (), ends, ends[1:]):
                if r not in index:
                    heappush(heap, r)
                index[r].append(places[s:e])

        heap: list[int] = []
        enter(np.flatnonzero(to >= 0).astype(np.int32))
        while heap:
            rank = heappop(heap)
            if rank not in index:
                continue
            lists = index.pop(rank)
            p = np.concatenate(lists) if len(lists) > 1 else lists[0]
            p = np.sort(p[to[p] == rank])
            if len(p) > 1:
                p = p[np.concatenate(([True], p[1:] != p[:-1]))]
            if not len(p):
                continue
            if one_by_one and len(p) > 1:
                index[rank].append(p[1:])
                heappush(heap, rank)
                p = p[:1]
            q = after[p]
            if len(p) > 1 and (meets := q[:-1] == p[1:]).any():
                # Of places that overlap in a row, every other one from the left.
                at = np.arange(len(p))
                run = np.maximum.accumulate(np.where(np.concatenate(([False], meets)), 0, at))
                p = p[(at - run) % 2 == 0]
                q = after[p]
            ids[p], ids[q], to[q] = rank, -2, -1
            follow = after[q]
            after[p] = follow
            before[follow] = p
            left = before[p]
            touched = np.concatenate((p, left[ids[left] >= 0]))  # a place may be there twice, which the index allows
            to[touched] = new = self.ranks(ids[touched], ids[after[touched]])
            if not one_by_one and ((new >= 0) & (new < rank)).any():
                return self.replay(words, one_by_one=True)
            enter(touched)
        stays = ids >= 0
        flat, ends = ids[stays].astype("<i4").tobytes(), (np.cumsum(stays, dtype=np.int64) * 4).tolist()
        return [flat[ends[s - 1]:ends[s + n - 1]] for s, n in zip(first.tolist(), size.tolist())]


@lru_cache(maxsize=1)
def vocabulary(rank_file: bytes) -> Vocabulary:
    return Vocabulary(rank_file)


class Encoder:
    """Encodes blocks of texts to ids (little-endian 32-bit) by merge replay."""

    def __init__(self, vocab: Vocabulary, pattern: str) -> None:
        self.vocab, self.find = vocab, regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def block(self, texts: list[str]) -> list[bytes]:
        known, find = self.known, self.find
        seen: set[str] = set()
        for t in texts:
            seen.update(self._pieces(t))
        new = seen.difference(known)
        if len(known) + len(new) > _REMEMBER:
            known = self.known = {p: known[p] for p in seen.intersection(known)}
        # Other white space at an edge, and an empty piece, concern the pieces beside it too.
        bare = ((p, p[1:] if p[:1] == " " else p) for p in new)
        edges = {p for p, body in bare if not body or body[0].isspace() or body[-1].isspace()}
        new -= edges
        odd = {k: find(t) for k, t in enumerate(texts) if t and not edges.isdisjoint(self._pieces(t))} if edges else {}
        parts = {p: tuple(find(p[1:] if p[0] == " " else " " + p)) for p in new}
        distinct = list({w for x in parts.values() for w in x}.union(*odd.values()))
        ids = dict(zip(distinct, self.vocab.replay([w.encode("utf-8", "surrogatepass") for w in distinct]), strict=True))
        known.update((p, ids[x[0]] if len(x) == 1 else b"".join([ids[w] for w in x])) for p, x in parts.items())
        del seen, new, parts, distinct
        return [b"".join([ids[w] for w in odd[k]]) if k in odd else b"".join(map(known.__getitem__, self._pieces(t)))
                if t else b"" for k, t in enumerate(texts)]

    @staticmethod
    def _pieces(text: str) -> list[str]:
        row = text.split(" ")
        row[0] = " " + row[0]
        return row


def decode_ids(token: list[bytes], flat: np.ndarray) -> bytes:
    return b"".join(map(token.__getitem__, flat.tolist()))


def _coded(batches: Iterator[pa.RecordBatch], encoder: Encoder, with_bytes: bool) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to (id, ids), and the bytes that the ids decode to."""
    token = encoder.vocab.token
    for b in batches:
        for part in parts_of(b, 1, BLOCK):
            rows = encoder.block(part.column(1).to_pylist())
            flat = np.frombuffer(b"".join(rows), "<i4")
            cuts = np.cumsum([0, *(len(r) // 4 for r in rows)])
            columns = [part.column(0),
                       pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat))]
            if with_bytes:
                columns.append(pa.array([decode_ids(token, flat[s:e]) for s, e in zip(cuts, cuts[1:])], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][:len(columns)])


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_bytes: bool = False) -> DataFrame:
    """doc_id and ids (array of int) of every row; ``with_bytes``: also what the ids decode to, in column ``decoded``.

    Decoding in the same pass saves a second Python process per task, and the ids' way there.
    """
    with open(rank_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _coded(batches, Encoder(vocabulary(shared.value), pattern), with_bytes)

    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("__text"))
    fields = [T.StructField("doc_id", narrow.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
              T.StructField("decoded", T.BinaryType())]
    return narrow.mapInArrow(gives_back(encoded), T.StructType(fields[:2 + with_bytes]))


def decode(encoded: DataFrame, rank_file: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the bytes of its ids in column ``decoded`` (null ids give null)."""
    with open(rank_file, "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())
    at = encoded.columns.index(ids_col)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = vocabulary(shared.value).token
        for b in batches:
            ids = b.column(at)
            flat, ends, missing = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_pylist(), ids.is_null().to_pylist()
            out = [None if no else decode_ids(token, flat[s:e]) for s, e, no in zip(ends, ends[1:], missing)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(gives_back(decoded), T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))
