"""Substring dedup: seeds from winnowed anchors, extended both ways to maximal repeats.

Words are ``[^\\x20\\x09-\\x0D]+``.  A repeat is a run of at least ``LENGTH`` words that also starts earlier
(in a document of smaller id, or earlier in the same one).

1. Anchors: of the ``LENGTH - SEED + 1`` seeds (``SEED`` words each) in every window of ``LENGTH`` words the one
   with the smallest hash is chosen, the rightmost of ties.  Equal windows choose the same anchor, so
   every repeat contains a shared anchor.
2. Anchors meet at the owners of their hash ranges, each part sending an anchor once; owners answer which of them occur again.
3. Each shared anchor is extended to both sides over every window that it stands for.  The windows are compared by
   two hashes, 96 bits together, at their owners, which answer whether a part holds the first place.
   A part sends a window once, so a passage that a third of all documents share meets
   its owner as often as there are parts, and no pairs of documents are made.
4. Windows that start earlier elsewhere cover the words to remove; adjacent ones join to maximal repeats.

Null texts have no words.  A null id comes after all others.  Rows with the same id and text are the same
document: none of them is earlier.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.llm.parts import ids_of, owner_cuts, owners, pack_counts, pack_sorted, parted, runs, texts_of, unpack_counts, unpack_sorted, written
from yearring.llm.words import grams, hashed

LENGTH = 20
SEED = 8
_LAST = np.iinfo(np.int64).max


def _anchors(flat: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the place of each one's anchor, and the seeds' hashes."""
    width = length - seed + 1
    hashes = grams(flat, seed)
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(offsets, offsets[1:])] or [np.empty(0)]).astype(np.int64)
    places = np.arange(len(hashes), dtype=np.int32 if len(hashes) < 2**31 else np.int64)
    least, reach = hashes, 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = least[:-step], least[step:]
        later = right <= left
        places = np.where(later, places[step:], places[:-step])
        least = np.where(later, right, left)
        reach += step
    return starts, places[starts] if len(starts) else np.empty(0, np.int64), hashes


def _words(table: pa.Table) -> list[list[bytes]]:
    return [t.split() for t in texts_of(table["text"])]


def _send_anchors(n_owners: int, length: int, seed: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, places, hashes = _anchors(*hashed(_words(table)), length, seed)
        anchors, counts = np.unique(hashes[np.unique(places)], return_counts=True)
        cuts = owner_cuts(anchors, n_owners)
        there = np.flatnonzero(np.diff(cuts))
        spans = [slice(cuts[o], cuts[o + 1]) for o in there]
        return pa.table(
            {
                "owner": pa.array(there, pa.int32()),
                "part": pa.array([key[0].as_py()] * len(there), pa.int64()),
                "hashes": pa.array([pack_sorted(anchors[s]) for s in spans], pa.binary()),
                "again": pa.array([np.packbits(counts[s] > 1).tobytes() for s in spans], pa.binary()),
            }
        )

    return send


def _messages(table: pa.Table) -> tuple[np.ndarray, list[int]]:
    lists = [unpack_sorted(b) for b in table["hashes"].to_pylist()]
    return np.concatenate(lists), [len(x) for x in lists]


def _bits(blobs: list[bytes], sizes: list[int]) -> np.ndarray:
    return np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8))[:n] for b, n in zip(blobs, sizes)])


def _reply(key: tuple[pa.Scalar, ...], table: pa.Table, bits: np.ndarray, sizes: list[int]) -> pa.Table:
    return pa.table(
        {
            "part": table["part"].combine_chunks(),
            "owner": pa.array([key[0].as_py()] * table.num_rows, pa.int32()),
            "bitmap": pa.array([np.packbits(b).tobytes() for b in np.split(bits, np.cumsum(sizes)[:-1])], pa.binary()),
        }
    )


def _shared_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    hashes, sizes = _messages(table)
    again = _bits(table["again"].to_pylist(), sizes)
    order = np.argsort(hashes, kind="stable")
    group = runs(hashes[order])
    shared = (np.bincount(group) > 1) | (np.bincount(group, weights=again[order]) > 0)
    bits = np.empty(len(hashes), bool)
    bits[order] = shared[group]
    return _reply(key, table, bits, sizes)


def _answered(cuts: np.ndarray, answers: pa.Table) -> np.ndarray:
    out = np.zeros(int(cuts[-1]), bool)
    for owner, bitmap in zip(answers["owner"].to_pylist(), answers["bitmap"].to_pylist()):
        a, b = cuts[owner], cuts[owner + 1]
        out[a:b] = np.unpackbits(np.frombuffer(bitmap, np.uint8))[: b - a]
    return out


class _Windows:
    """The windows around a part's shared anchors, and which of the equal ones in the part comes first."""

    def __init__(self, table: pa.Table, shared: pa.Table | None, bitmap: bytes | None, n_owners: int, length: int, seed: int):
        self.words = _words(table)
        flat, self.offsets = hashed(self.words)
        starts, places, hashes = _anchors(flat, self.offsets, length, seed)
        if bitmap is None:
            anchors = np.unique(hashes[np.unique(places)])
            marked = _answered(owner_cuts(anchors, n_owners), shared)
            chosen = marked[np.searchsorted(anchors, hashes[places])] if len(starts) else np.empty(0, bool)
            self.bitmap = np.packbits(chosen).tobytes()
        else:
            chosen = np.unpackbits(np.frombuffer(bitmap, np.uint8))[: len(starts)].astype(bool)
        self.starts = starts[chosen]
        document = np.searchsorted(self.offsets, self.starts, "right") - 1
        self.ids = ids_of(table["doc_id"], _LAST)[document]
        self.at = self.starts - self.offsets[document]
        self.hash = grams(flat, length)[self.starts]
        self.check = grams(flat, length, 0xD6E8FEB86659FD93)[self.starts].astype(np.uint32)
        self.order = np.lexsort((self.at, self.ids, self.check, self.hash))
        self.group = runs(self.hash[self.order], self.check[self.order])
        self.first = self.order[np.unique(self.group, return_index=True)[1]]
        self.cuts = owner_cuts(self.hash[self.first], n_owners)


def _send_windows(n_owners: int, length: int, seed: int):
    def send(table: pa.Table, shared: pa.Table) -> pa.Table:
        w = _Windows(table, shared, None, n_owners, length, seed)
        there = np.flatnonzero(np.diff(w.cuts))
        spans = [w.first[w.cuts[o] : w.cuts[o + 1]] for o in there]
        parts = table["part"][:1].to_pylist()
        # Owner -1 is the part itself: which windows stand around shared anchors, so that nobody works it out again.
        return pa.table(
            {
                "owner": pa.array(np.append(there, -1), pa.int32()),
                "part": pa.array(parts * (len(there) + 1), pa.int64()),
                "hashes": pa.array([w.hash[s].tobytes() for s in spans] + [w.bitmap], pa.binary()),
                "checks": pa.array([w.check[s].tobytes() for s in spans] + [b""], pa.binary()),
                "ids": pa.array([w.ids[s].astype("<i8").tobytes() for s in spans] + [b""], pa.binary()),
                "places": pa.array([pack_counts(w.at[s]) for s in spans] + [b""], pa.binary()),
            }
        )

    return send


def _first_windows(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each window that a part sent: is that place the first of all?"""
    column = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in table[name].to_pylist()])
    hashes, checks, ids = column("hashes", "<u8"), column("checks", "<u4"), column("ids", "<i8")
    counts = [unpack_counts(b) for b in table["places"].to_pylist()]
    places = np.concatenate(counts)
    order = np.lexsort((places, ids, checks, hashes))
    group = runs(hashes[order], checks[order])
    first = order[np.unique(group, return_index=True)[1]][group]
    bits = np.empty(len(hashes), bool)
    bits[order] = (ids[order] == ids[first]) & (places[order] == places[first])
    return _reply(key, table, bits, [len(c) for c in counts])


def _removed(n_owners: int, length: int, seed: int):
    def removed(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = pa.compute.equal(answers["owner"], -1)
        w = _Windows(table, None, answers.filter(own)["bitmap"][0].as_py(), n_owners, length, seed)
        is_first = _answered(w.cuts, answers.filter(pa.compute.invert(own)))
        best = w.first[w.group]
        gone = np.empty(len(w.starts), bool)
        gone[w.order] = ~(is_first[w.group] & (w.ids[w.order] == w.ids[best]) & (w.at[w.order] == w.at[best]))
        edges = np.zeros(int(w.offsets[-1]) + 1, np.int32)
        np.add.at(edges, w.starts[gone], 1)
        np.add.at(edges, w.starts[gone] + length, -1)
        covered = np.cumsum(edges[:-1]) > 0
        counts, digests, repeats = [], [], []
        for words, a, b in zip(w.words, w.offsets, w.offsets[1:]):
            out = covered[a:b]
            n = int(out.sum())
            counts.append(n)
            digests.append(hashlib.sha256(b" ".join(compress(words, ~out) if n else words)).hexdigest())
            turns = np.flatnonzero(np.diff(out, prepend=False, append=False)) if n else np.empty(0, np.int64)
            repeats.append([{"start": int(x), "end": int(y)} for x, y in turns.reshape(-1, 2)])
        return pa.table(
            {
                "doc_id": table["doc_id"].combine_chunks(),
                "n_words": pa.array(np.diff(w.offsets), pa.int64()),
                "n_removed": pa.array(counts, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "repeats": pa.array(repeats, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            }
        )

    return removed


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_sha256`` and ``repeats``, the word ranges that go."""
    n = owners(df.sparkSession)
    data = F.col("data")
    table = parted(df.select(id_col, text_col), text_col, "substring").select(
        "part", data.getField(id_col).alias("doc_id"), data.getField(text_col).alias("text")
    )
    bitmap = "part long, owner int, bitmap binary"
    anchors = table.groupBy("part").applyInArrow(_send_anchors(n, length, seed), "owner int, part long, hashes binary, again binary")
    shared = anchors.groupBy("owner").applyInArrow(_shared_anchors, bitmap)
    sent = written(
        table.groupBy("part")
        .cogroup(shared.groupBy("part"))
        .applyInArrow(_send_windows(n, length, seed), "owner int, part long, hashes binary, checks binary, ids binary, places binary"),
        "windows",
    )
    own = sent.filter("owner = -1").select("part", "owner", F.col("hashes").alias("bitmap"))
    first = sent.filter("owner >= 0").groupBy("owner").applyInArrow(_first_windows, bitmap).union(own)
    return (
        table.groupBy("part")
        .cogroup(first.groupBy("part"))
        .applyInArrow(
            _removed(n, length, seed),
            "doc_id long, n_words long, n_removed long, kept_sha256 string, repeats array<struct<start: long, end: long>>",
        )
    )
