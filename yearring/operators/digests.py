"""Digests of an archive that say where it differs from what was once written.

A leaf stands for a block of consecutive ids: the number of its versions and order-free sums over the hashes of their data, worked out
anew from the columns.  History columns are left out, so loads and clustering don't change a leaf.  Sums add, so a node of the
next level is the sum of ``FAN`` nodes, up to the root; all levels are rows of one plain table.

* :meth:`DigestTree.refresh` adds the leaves of new versions and reads nothing else.
* :meth:`DigestTree.verify` works the leaves of an id range out again, reading that range only, and names the blocks that differ.
* :func:`differing_blocks` compares two trees from the root down, reading only children of nodes that differ.

One of the sums weighs each hash by the place of its row.  If exactly one row of a block was altered or lost, the quotient of the two
differences is its place, so the row is named although only sums were kept.  The sums show damage and mistakes, not an
attacker who can choose many rows at will.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.functions.hashing import row_hash
from yearring.operators.scd import HISTORY_COLUMNS
from yearring.operators.sidetable import SideTable, Span, any_of, block_of, few, spans
from yearring.sources.store import Archive

BLOCK, FAN = 4096, 64
#: Levels above the leaves that are stored; one node of the last stands for 2.8e14 ids.
TOP = 6
SUMS = ["versions", "mismatches", "d0", "d1", "d2", "d3", "placed"]


def leaves(versions: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(node, versions, mismatches, d0 .. d3, placed)`` for each block; ``mismatches`` counts stored hashes that don't fit their row."""
    again = versions.select(
        block_of(block).alias("node"),
        F.expr(f"(_archive_id - 1) % {block} + 1").alias("place"),
        row_hash(versions.schema, HISTORY_COLUMNS).alias("h"),
        F.col("_row_hash").alias("stored"),
    )
    parts = [F.conv(F.substring("h", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)").alias(f"d{i}") for i in range(4)]
    wrong = F.when(F.col("h") == F.col("stored"), 0).otherwise(1).alias("mismatches")
    placed = (F.col("d0") * F.col("place").cast("decimal(10,0)")).alias("placed")
    rows = again.select("node", "place", wrong, *parts).select("node", F.lit(1).alias("versions"), "mismatches", "d0", "d1", "d2", "d3", placed)
    return _added(rows)


def _added(rows: DataFrame, *more: str) -> DataFrame:
    sums = [F.sum(c).cast("bigint" if c in SUMS[:2] else "decimal(38,0)").alias(c) for c in SUMS]
    return rows.groupBy(*more, "node").agg(*sums)


class DigestTree(SideTable):
    """The digests of one archive."""

    def __init__(self, archive: Archive, block: int = BLOCK):
        super().__init__(archive, f"digests-{block}")
        self.block = block

    def build(self, versions: DataFrame) -> DataFrame:
        """All levels of the new versions; nodes that earlier versions share are added up on read."""
        # one leaf stands for many versions: its row is copied to the nodes above it, and all are added up in one shuffle
        path = F.expr(f"transform(sequence(0, {TOP}), k -> struct(k AS level, shiftright(node, {FAN.bit_length() - 1} * k) AS node))")
        rows = leaves(versions, self.block).select(F.explode(path).alias("at"), *SUMS).select("at.level", "at.node", *SUMS)
        return _added(rows, "level").repartitionByRange("level", "node").sortWithinPartitions("level", "node")

    def stored(self) -> DataFrame:
        rows = self.read()
        if rows is None:
            raise ValueError("no digests are stored yet: refresh first")
        return rows

    def level(self, level: int, ranges: list[Span] | None = None) -> DataFrame:
        """Nodes of a level; only those in the closed ranges, if there are any given."""
        stored = self.stored().filter(F.col("level") == level)
        return _added(stored if ranges is None else stored.filter(any_of("node", ranges)))

    def root(self) -> DataFrame:
        return self.level(TOP)

    def verify(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """Blocks that touch the ids above ``after`` up to ``upto`` and differ from their stored digest.

        Gives ``(node, stored_versions, versions, mismatches, suspect)``; ``suspect`` is the id of the row that explains the
        difference if one altered or lost row does, else NULL.
        """
        covered, manifest = self.covered(), self.archive.manifest()
        upto = min(covered, covered if upto is None else upto)
        low, high = after // self.block, (upto - 1) // self.block
        inside = F.col("_archive_id").between(low * self.block + 1, min(covered, (high + 1) * self.block))
        found = leaves(self.versions(manifest).filter(inside), self.block)
        stored = _added(self.stored().filter((F.col("level") == 0) & F.col("node").between(low, high)))
        return differences(stored, found, self.block)


def differences(stored: DataFrame, found: DataFrame, block: int) -> DataFrame:
    """Nodes of two lists of leaves that differ."""
    both = stored.alias("s").join(found.alias("f"), "node", "full")
    changed = reduce(lambda a, b: a | b, [~F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in SUMS])

    def change(name: str):
        zero = F.lit(0).cast("decimal(38,0)")
        return F.coalesce(F.col(f"f.{name}"), zero) - F.coalesce(F.col(f"s.{name}"), zero)

    place = both.filter(changed).select(
        "node",
        F.coalesce("s.versions", F.lit(0)).alias("stored_versions"),
        F.coalesce("f.versions", F.lit(0)).alias("versions"),
        F.coalesce("f.mismatches", F.lit(0)).alias("mismatches"),
        change("d0").alias("_d"),
        change("placed").alias("_p"),
    )
    q = place.withColumn("_q", F.expr("try_cast(round(CAST(_p AS DOUBLE) / nullif(CAST(_d AS DOUBLE), 0)) AS INT)"))
    exact = F.expr(f"_q BETWEEN 1 AND {block} AND CAST(_q AS DECIMAL(10,0)) * CAST(_d AS DECIMAL(28,0)) = _p")
    one = F.abs(F.col("stored_versions") - F.col("versions")) <= 1
    return q.withColumn("suspect", F.when(exact & one, F.col("node") * block + F.col("_q"))).drop("_d", "_p", "_q")


def differing_blocks(one: DigestTree, other: DigestTree) -> DataFrame:
    """Blocks in which two archives, such as a copy and its original, hold different data.

    Level by level only children of nodes that differ are read.  If more nodes differ than may come to the driver, all leaves are compared.
    """
    if one.block != other.block:
        raise ValueError("trees of different blocks can't be compared")
    ranges: list[Span] | None = None
    for level in range(TOP, 0, -1):
        found = few(differences(one.level(level, ranges), other.level(level, ranges), one.block).select("node"))
        if found is None:
            ranges = None
            break
        ranges = [(low * FAN, high * FAN + FAN - 1) for low, high in spans(found)]
        if not ranges:
            break
    return differences(one.level(0, ranges), other.level(0, ranges), one.block)
