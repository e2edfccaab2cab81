"""Plain tables beside an archive that follow its ids.

Ids only grow and versions are never rewritten, so such a table covers the ids up to one and is extended by what lies above:

    <archive>/side/<name>/after=<id>,upto=<id>-<token>/*.parquet

A folder counts once it is complete (``_SUCCESS``).  Of folders that overlap, because two refreshes raced, the longest chain without
overlap counts.  Reads of an id range reach the Parquet scan as comparisons, so files, row groups and pages outside it are skipped.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearring.sources.store import CLOSED, OPEN, Archive, Manifest

#: Most comparisons that are put into one filter; nearer blocks are merged beyond it.
MAX_RANGES = 64
#: Most block numbers that come to the driver (8 bytes each).
MAX_BLOCKS = 100_000

Span = tuple[int, int]


def block_of(block: int, column: str = "_archive_id") -> Column:
    """Number of the block of ``block`` consecutive ids in which an id lies; ids start at 1."""
    return F.expr(f"(`{column}` - 1) div {int(block)}")


def few(numbers: DataFrame) -> list[int] | None:
    """The numbers in order, or None if there are more than ``MAX_BLOCKS``."""
    found = [row[0] for row in numbers.limit(MAX_BLOCKS + 1).collect()]
    return None if len(found) > MAX_BLOCKS else sorted(found)


def spans(numbers: Sequence[int], most: int = MAX_RANGES) -> list[Span]:
    """Ascending numbers as closed ranges; beyond ``most`` the ones with the smallest gaps between them are merged."""
    if not numbers:
        return []
    gaps = sorted((b - a for a, b in zip(numbers, numbers[1:]) if b - a > 1), reverse=True)[: most - 1]
    # of equal gaps only as many as there is room for are kept
    room = {gap: gaps.count(gap) for gap in gaps}
    found = [[numbers[0], numbers[0]]]
    for a, b in zip(numbers, numbers[1:]):
        if room.get(b - a, 0):
            room[b - a] -= 1
            found.append([b, b])
        else:
            found[-1][1] = b
    return [tuple(s) for s in found]


def any_of(column: str, ranges: Sequence[Span]) -> Column:
    """Whether the column lies in one of the closed ranges."""
    tests = [F.col(column).between(low, high) for low, high in ranges] or [F.lit(False)]
    while len(tests) > 1:  # a balanced tree stays shallow
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]


class SideTable:
    """One such table; ``build`` of a subclass makes its rows from versions."""

    def __init__(self, archive: Archive, name: str):
        self.archive, self.path = archive, f"{archive.path}/side/{name}"

    def build(self, versions: DataFrame) -> DataFrame:
        raise NotImplementedError

    def folders(self) -> list[tuple[int, int, str]]:
        """What counts, as (after, upto, folder), without gaps from id 1."""
        found = []
        for name in self.archive.fs.names(self.path):
            match = re.fullmatch(r"after=(\d+),upto=(\d+)-\w+", name)
            if match and self.archive.fs.exists(f"{self.path}/{name}/_SUCCESS"):
                found.append((int(match[1]), -int(match[2]), name))
        chain, reached = [], 0
        for after, upto, name in sorted(found):
            if after == reached:
                chain.append((after, -upto, f"{self.path}/{name}"))
                reached = -upto
        return chain

    def covered(self) -> int:
        """The id up to which the table stands for the archive."""
        folders = self.folders()
        return folders[-1][1] if folders else 0

    def versions(self, manifest: Manifest, after: int = 0) -> DataFrame:
        """Versions above an id, with the validity they were written with: ends are of no interest here and not joined."""
        both = self.archive.stored(OPEN, manifest).unionByName(self.archive.stored(CLOSED, manifest))
        return both.filter(F.col("_archive_id") > after)

    def refresh(self) -> int:
        """Add what was loaded since the last refresh; returns the id that is covered then."""
        manifest, done = self.archive.manifest(), self.covered()
        if manifest is None or manifest.max_id <= done:
            return done
        target = f"{self.path}/after={done:019d},upto={manifest.max_id:019d}-{uuid.uuid4().hex[:12]}"
        self.build(self.versions(manifest, done)).write.parquet(target)
        return self.covered()

    def read(self) -> DataFrame | None:
        paths = [path for _, _, path in self.folders()]
        return self.archive.spark.read.parquet(*paths) if paths else None
