"""Finding text by a pattern without reading every text.

For each trigram the index holds the blocks of consecutive ids in which it occurs, sorted by trigram.  A search reads the few
trigrams of its pattern, takes the blocks that have them all, and reads those blocks of the archive only; the pattern itself is then tested
on the rows, so the answer is that of a plain ``ilike``.

* Case: trigrams are taken from ``lower(text)``, which is what ``ilike`` compares.
* Letters beyond ASCII are not indexed; they split a pattern into shorter pieces.
* A pattern without three plain characters in a row prunes nothing, and every text is read.
* NULL and texts under three characters are in no block, as no pattern with a trigram can match them.
* A text of n characters takes about 50 n bytes in a task while it is taken apart.
* Rows loaded after the last refresh are read without pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearring.operators.sidetable import SideTable, any_of, block_of, few, spans
from yearring.sources.store import Archive

BLOCK = 4096
#: Trigrams that are looked up; a longer IN list would not be pushed to the scan value by value.
MOST_GRAMS = 10


def literal_runs(pattern: str, escape: str = "\\") -> list[str]:
    """Stretches of a LIKE pattern that a matching text holds as they are, in lower case and ASCII only."""
    runs, run, i = [], "", 0
    while i < len(pattern):
        char = pattern[i]
        if char == escape and i + 1 < len(pattern):
            i += 1
            char = pattern[i]
        elif char in "%_":
            char = ""
        if char and char.isascii():
            run += char.lower()
        else:
            runs, run = [*runs, run], ""
        i += 1
    return [r for r in [*runs, run] if r]


def wanted_grams(pattern: str, most: int = MOST_GRAMS) -> list[str]:
    """Trigrams that a matching text must have; of more than ``most``, some that are spread over the pattern."""
    grams = list(dict.fromkeys(run[i : i + 3] for run in literal_runs(pattern) for i in range(len(run) - 2)))
    return [grams[i * len(grams) // most] for i in range(most)] if len(grams) > most else grams


def grams_of(text: Column) -> Column:
    """The different trigrams of a text, in time linear in it."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(?=([\x00-\x7f]{3}))"), F.lit(1)))


class TextIndex(SideTable):
    """The trigrams of one text column of an archive."""

    def __init__(self, archive: Archive, column: str, block: int = BLOCK):
        super().__init__(archive, f"trigrams-{column}-{block}")
        self.column, self.block = column, block

    def build(self, versions: DataFrame) -> DataFrame:
        grams = versions.select(F.explode(grams_of(F.col(self.column))).alias("gram"), block_of(self.block).alias("block")).distinct()
        # by both columns, so that a trigram of every text spreads over tasks
        return grams.repartitionByRange("gram", "block").sortWithinPartitions("gram", "block")

    def blocks(self, pattern: str) -> DataFrame | None:
        """Numbers of the indexed blocks that may hold a match; None if all may."""
        grams, stored = wanted_grams(pattern), self.read()
        if not grams or stored is None:
            return None
        # loads may meet inside a block, so a pair can be stored twice
        hits = stored.filter(F.col("gram").isin(grams)).distinct().groupBy("block").count()
        return hits.filter(F.col("count") == len(grams)).select("block")

    def search(self, pattern: str, state: str | None = None) -> DataFrame:
        """Rows of the archive whose text matches, ignoring case."""
        manifest, covered = self.archive.manifest(), self.covered()
        rows = self.archive.read(state, manifest).filter(F.col(f"`{self.column}`").ilike(pattern))
        blocks = self.blocks(pattern)
        if blocks is None:
            return rows
        later = [(covered + 1, manifest.max_id)] if manifest.max_id > covered else []
        numbers = few(blocks)
        if numbers is not None:
            ids = [(low * self.block + 1, (high + 1) * self.block) for low, high in spans(numbers)]
            return rows.filter(any_of("_archive_id", ids + later))
        # a pattern of very many blocks: the join is exact and needs no numbers on the driver
        numbered = rows.withColumn("_block", block_of(self.block))
        some = numbered.join(blocks, F.col("_block") == F.col("block"), "left_semi").drop("_block")
        return some.filter(F.col("_archive_id") <= covered).unionByName(rows.filter(any_of("_archive_id", later)))
