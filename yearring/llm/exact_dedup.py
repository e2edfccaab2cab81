"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Documents are written in parts, with a 64-bit fingerprint and the SHA-256 of the text, A-Z lower-cased.
2. Each part sends its sorted distinct fingerprints, Golomb-coded, to the owners of the hash ranges.
3. Owners answer with a bitmap of the fingerprints that more than one row has.
4. Suspects only travel on: their texts are grouped by their bytes, so equal fingerprints of different
   texts part again.  Each part sends a text once, and a salted first step
   keeps a text that fills a third of the corpus from meeting in one task as often as there are parts.
5. The verdict of each group goes back to the parts under the digest.

Null texts are empty texts and equal each other.  A null id counts as smaller than any other; of rows
with equal text and equal id exactly one stays.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.llm import golomb
from yearring.llm.parts import ids_of, owner_cuts, owners, parted, runs, texts_of, written

SALTS = 64


def _digests(texts: pa.Array) -> dict[str, pa.Array]:
    lowered = [t.lower() for t in texts_of(texts)]  # bytes.lower touches A-Z only
    fingerprints = np.fromiter((xxhash.xxh64_intdigest(t) for t in lowered), np.uint64, len(lowered))
    return {
        "fp": pa.array(fingerprints.view(np.int64)),
        "sha": pa.array([hashlib.sha256(t).hexdigest() for t in lowered], pa.string()),
    }


def _send(n_owners: int):
    """Fingerprints of a part to their owners; ``twice`` marks those that the part itself has twice."""

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hashes, counts = np.unique(table["fp"].to_numpy().view(np.uint64), return_counts=True)
        cuts = owner_cuts(hashes, n_owners)
        there = np.flatnonzero(np.diff(cuts))
        spans = [slice(cuts[o], cuts[o + 1]) for o in there]
        return pa.table(
            {
                "owner": pa.array(there, pa.int32()),
                "part": pa.array([key[0].as_py()] * len(there), pa.int64()),
                "coded": pa.array([golomb.encode(hashes[s]) for s in spans], pa.binary()),
                "twice": pa.array([np.packbits(counts[s] > 1).tobytes() for s in spans], pa.binary()),
            }
        )

    return send


def _answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Which fingerprints of each message have more than one row."""
    coded = [golomb.decode(b) for b in table["coded"].to_pylist()]
    sizes = [len(c) for c in coded]
    hashes = np.concatenate(coded)
    twice = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8))[:n] for b, n in zip(table["twice"].to_pylist(), sizes)])
    order = np.argsort(hashes, kind="stable")
    group = runs(hashes[order])
    shared = (np.bincount(group) > 1) | (np.bincount(group, weights=twice[order]) > 0)
    bits = np.empty(len(hashes), np.uint8)
    bits[order] = shared[group]
    return pa.table(
        {
            "part": table["part"].combine_chunks(),
            "owner": pa.array([key[0].as_py()] * table.num_rows, pa.int32()),
            "bitmap": pa.array([np.packbits(b).tobytes() for b in np.split(bits, np.cumsum(sizes)[:-1])], pa.binary()),
        }
    )


def _suspects(id_col: str, text_col: str, n_owners: int):
    """Each suspect text of a part once, with its best row and its number of rows."""

    def suspects(table: pa.Table, answers: pa.Table) -> pa.Table:
        prints = table["fp"].to_numpy().view(np.uint64)
        hashes = np.unique(prints)
        cuts = owner_cuts(hashes, n_owners)
        shared = np.zeros(len(hashes), bool)
        for owner, bitmap in zip(answers["owner"].to_pylist(), answers["bitmap"].to_pylist()):
            a, b = cuts[owner], cuts[owner + 1]
            shared[a:b] = np.unpackbits(np.frombuffer(bitmap, np.uint8))[: b - a]
        chosen = table.filter(pa.array(shared[np.searchsorted(hashes, prints)]))
        data = chosen["data"].combine_chunks()
        data = data if isinstance(data, pa.StructArray) else data.chunk(0) if data.num_chunks else None
        ids = ids_of(data.field(id_col), np.iinfo(np.int64).min) if chosen.num_rows else []
        texts = texts_of(data.field(text_col)) if chosen.num_rows else []
        best: dict[bytes, list] = {}
        for i, row, sha, text in zip(ids, chosen["row"].to_pylist(), chosen["sha"].to_pylist(), texts):
            text = text.lower()
            mine = best.setdefault(text, [i, row, sha, 0])
            mine[3] += 1
            if i > mine[0]:
                mine[:2] = i, row
        part = table["part"][0].as_py() if table.num_rows else 0
        return pa.table(
            {
                "part": pa.array([part] * len(best), pa.int64()),
                "sha": pa.array([b[2] for b in best.values()], pa.string()),
                "text": pa.array(list(best), pa.binary()),
                "best_id": pa.array([int(b[0]) for b in best.values()], pa.int64()),
                "best_row": pa.array([b[1] for b in best.values()], pa.int32()),
                "n": pa.array([b[3] for b in best.values()], pa.int64()),
            }
        )

    return suspects


def judged(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as ``data`` (all columns of ``df``) with ``sha``, ``keep_id``, ``group_size`` and ``kept``."""
    n_owners = owners(df.sparkSession)
    table = parted(df, text_col, "exact", _digests, "fp long, sha string")
    messages = table.select("part", "fp").groupBy("part").applyInArrow(_send(n_owners), "owner int, part long, coded binary, twice binary")
    answers = messages.groupBy("owner").applyInArrow(_answer, "part long, owner int, bitmap binary")
    suspects = written(
        table.groupBy("part")
        .cogroup(answers.groupBy("part"))
        .applyInArrow(_suspects(id_col, text_col, n_owners), "part long, sha string, text binary, best_id long, best_row int, n long"),
        "suspects",
    )
    best = F.max(F.struct("best_id", F.col("part").alias("best_part"), "best_row")).alias("best")
    groups = (
        suspects.groupBy((F.col("part") % SALTS).alias("salt"), "sha", "text")
        .agg(best, F.sum("n").alias("n"))
        .groupBy("sha", "text")
        .agg(F.max("best").alias("best"), F.sum("n").alias("n"))
        .filter("n > 1")
        .select("sha", "best", "n")
    )
    verdicts = suspects.select("part", "sha").join(groups, "sha")
    alone = F.col("best").isNull()
    return table.join(verdicts, ["part", "sha"], "left").select(
        "data",
        "sha",
        F.when(alone, F.col("data").getField(id_col).cast("long"))
        .otherwise(F.nullif(F.col("best.best_id"), F.lit(np.iinfo(np.int64).min)))
        .alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | ((F.col("part") == F.col("best.best_part")) & (F.col("row") == F.col("best.best_row")))).alias("kept"),
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return judged(df.select(id_col, text_col), id_col, text_col).select(
        F.col("data").getField(id_col).alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with its own columns."""
    out = judged(df, id_col, text_col).filter("kept")
    return out.select(*[F.col("data").getField(c).alias(c) for c in df.columns])
