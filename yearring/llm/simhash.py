"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints are 64 majority votes over the XXH64 hashes (seed 42) of 3-word shingles, A-Z lower-cased.
Two fingerprints link when they differ in at most ``RADIUS`` bits; documents of linked fingerprints form a component.

1. Equal fingerprints are grouped first, with map-side combining, so copies cost one row.
2. The upper nodes of the index are ranges of Gray ranks: the fingerprints of a range agree on their first bits.  A fingerprint
   descends into its own range and into all later ones whose pattern it differs from by at most ``RADIUS`` bits, with the
   number of differing bits so far.  A range with more than ``GROUP`` rows is cut by ``STEP`` more bits, and its rows go
   on with what is left of the radius, until it fits.  No range has a cap and no pair is lost.
3. Each range sorts its fingerprints by Gray rank.  Neighbours in that order share long bit patterns, so runs of
   them form leaves, and runs of nodes form upper nodes, each with the mask of bits on which all below agree and
   those bits.  A search walks the levels from the top, adds up the differing bits of each level, and prunes a node with all
   below it once the sum exceeds the radius.
4. A range returns fewer links than it has rows, the nearest that connect what is connected, never all pairs.
5. Components over all ranges: alternating large-star and small-star steps on the links, written to the shared folder
   after each round.  A hub's links are combined before the shuffle.

Texts are read whole, however long.  Null texts and texts without words have fingerprint zero.  Rows with a null id have a component like any others but do not
name it; a component of null ids alone has a null ``component_id``.  Equal rows are linked.  An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearring.llm.parts import (
    owner_cuts,
    owners,
    pack_counts,
    pack_sorted,
    parted,
    row_number,
    runs,
    texts_of,
    unpack_counts,
    unpack_sorted,
    written,
)
from yearring.llm.words import grams, hashed

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Rows of one range (its fingerprints, and others that search in it) before it is cut again, by so many bits.
GROUP = 500_000
STEP = 4
#: Ranges are no smaller than this on average, but for more than ``2**SPREAD`` of them; at ``DEEPEST`` bits a range can't be large.
RANGE = 4_096
SPREAD = 8
DEEPEST = 60
#: Low bits of a shingle's hash that counting leaves out.
SKETCH = 24
#: Bytes of text, about, whose words are held at once.
SLICE = 1 << 20
#: Rows of one shingle in a block, and rows, over all blocks, that one Python call takes on average.
BLOCK = 2_000
PAIR_BUCKET = 20_000
#: Rows, over all ranges, that one Python call takes on average.
BUCKET = 50_000
#: Fingerprints in a leaf, and children of an upper node.
FAN = 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is 1 if it is set in over half of the shingles' hashes, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-shingle].tolist()]
    ends = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], "<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        votes += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long), one row per row of ``df``."""

    def each(batches):
        for batch in batches:
            values = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return df.select(F.col(id_col).cast("long"), text_col).mapInArrow(each, "doc_id long, fp long")


# The index


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each value in the reflected Gray sequence."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of (mask, bits) patterns over fingerprints in Gray order; the last level holds the fingerprints."""

    def __init__(self, values: np.ndarray, fan: int = FAN):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        self.fan = fan
        masks, bits = np.full(len(values), ~np.uint64(0)), self.values
        self.levels = [(masks, bits)]
        while len(bits) > fan:
            cuts = np.arange(0, len(bits), fan)
            ones = np.bitwise_and.reduceat(bits & masks, cuts)
            zeros = np.bitwise_and.reduceat(~bits & masks, cuts)
            masks, bits = ones | zeros, ones
            self.levels.append((masks, bits))
        self.levels.reverse()
        # A node keeps only what its parent does not already say; so sums over the levels count each bit once.
        above = np.zeros(len(self.levels[0][0]), np.uint64)
        for i, (masks, bits) in enumerate(self.levels):
            own = masks & ~above
            self.levels[i] = (own, bits & own)
            if i + 1 < len(self.levels):
                above = np.repeat(masks, fan)[: len(self.levels[i + 1][0])]

    def near(self, queries: np.ndarray, radius: int, pairs: int = 4_000_000):
        """Positions in ``queries`` and in ``values`` with at most ``radius`` differing bits, and their number.

        Queries go in batches, so that one holds ``pairs`` candidates even if everything is near everything.
        """
        size = max(16, pairs // len(self.values))
        for at in range(0, len(queries), size):
            batch = queries[at : at + size]
            top = len(self.levels[0][0])
            query = np.repeat(np.arange(len(batch), dtype=np.int32), top)
            node = np.tile(np.arange(top, dtype=np.int32), len(batch))
            spent = np.zeros(len(query), np.uint8)
            for depth, (masks, bits) in enumerate(self.levels):
                if depth:
                    width = len(masks)
                    query, spent = np.repeat(query, self.fan), np.repeat(spent, self.fan)
                    node = (node[:, None] * self.fan + np.arange(self.fan, dtype=np.int32)).ravel()
                    inside = node < width
                    query, node, spent = query[inside], node[inside], spent[inside]
                spent = spent + np.bitwise_count((batch[query] & masks[node]) ^ bits[node])
                close = spent <= radius
                query, node, spent = query[close], node[close], spent[close]
            yield query + at, node, spent

    def links(self, radius: int):
        """Pairs of positions in ``values``, the smaller one first, with at most ``radius`` differing bits."""
        for query, node, spent in self.near(self.values, radius):
            later = node > query
            yield query[later], node[later], spent[later]


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of the links, earlier ones first, that connect all that the links connect without a cycle."""
    parent, waiting, kept = np.arange(n), np.arange(len(left)), []
    while True:
        while (parent[parent] != parent).any():
            parent = parent[parent]
        a, b = parent[left[waiting]], parent[right[waiting]]
        apart = a != b
        waiting, a, b = waiting[apart], a[apart], b[apart]
        if not len(waiting):
            return np.concatenate([np.empty(0, np.int64), *kept])
        roots, first = np.unique(np.maximum(a, b), return_index=True)
        parent[roots] = np.minimum(a, b)[first]
        kept.append(waiting[first])


def spanning_links(values: np.ndarray, radius: int, visitors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct values, and of visitors to values, nearest first, that connect all that any of these links connect.

    There are fewer of them than values and visitors.
    """
    index = GrayIndex(values)
    visitors = np.empty(0, np.uint64) if visitors is None else visitors
    nodes = np.concatenate([index.values, visitors])
    left, right, distance = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    from_visitors = ((query + len(values), node, spent) for query, node, spent in index.near(visitors, radius))
    for more in itertools.chain(index.links(radius), from_visitors):
        if not len(more[0]):
            continue
        left, right, distance = (np.concatenate([x, y]) for x, y in zip((left, right, distance), more))
        order = np.argsort(distance, kind="stable")
        order = order[_forest(len(nodes), left[order], right[order])]
        left, right, distance = left[order], right[order], distance[order]
    return nodes[left], nodes[right]


# Ranges of Gray ranks: the upper nodes of the index


def _depth(fingerprints: int, radius: int, group: int) -> int:
    """Leading bits that the ranges fix at first."""
    for depth in range(DEEPEST):
        small = fingerprints >> depth <= RANGE or depth >= SPREAD
        visits = sum(math.comb(depth, k) for k in range(radius + 1))  # half of them go to later ranges
        if small and fingerprints * visits >> depth <= group:
            return depth
    return DEEPEST


def _descend(rows: DataFrame, depth: int, more: int, radius: int) -> DataFrame:
    """Rows ``fp, range, spent`` in the ranges of ``more`` further bits that are near enough, a fingerprint's own and later ones only.

    Equal leading bits are equal leading Gray ranks, so ``range`` names the range by those bits.
    """
    if not more:
        return rows
    flips = [f for f in range(1 << more) if f.bit_count() <= radius]
    own = F.shiftrightunsigned("fp", 64 - depth - more)
    into = F.shiftleft("range", more).bitwiseOR(own.bitwiseAND(F.lit((1 << more) - 1)).bitwiseXOR(F.col("flip")))
    return (
        rows.withColumn("flip", F.explode(F.array(*[F.lit(f).cast("long") for f in flips])))
        .select("fp", into.alias("range"), (F.col("spent") + F.bit_count("flip")).alias("spent"))
        .filter((F.col("spent") <= radius) & (F.col("range") >= own))
    )


def links(prints: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """Links ``a, b`` among distinct fingerprints ``fp`` that connect all within ``radius`` bits."""

    def within(table: pa.Table) -> pa.Table:
        """The ranges of one bucket.  Fingerprints that spent nothing on the way are the range's own, the others visit."""
        values, ranges, spent = (table[c].to_numpy() for c in ("fp", "range", "spent"))
        order = np.lexsort((spent > 0, ranges))
        values, visits, number = values[order].view(np.uint64), spent[order] > 0, runs(ranges[order])
        sizes, owned = np.bincount(number), np.bincount(number, weights=~visits).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for k in np.flatnonzero((owned > 0) & (sizes > 1)):
            start, middle, end = starts[k], starts[k] + owned[k], starts[k] + sizes[k]
            x, y = spanning_links(values[start:middle], radius, values[middle:end])
            a.append(x)
            b.append(y)
        return pa.table({"a": pa.array(np.concatenate(a).view(np.int64)), "b": pa.array(np.concatenate(b).view(np.int64))})

    depth = _depth(prints.count(), radius, group)
    whole = prints.select("fp", F.lit(0).cast("long").alias("range"), F.lit(0).alias("spent"))
    waiting, found = _descend(whole, 0, depth, radius), None
    while True:
        sizes = written(waiting.groupBy("range").agg(F.count("*").alias("rows")), "ranges")
        large = sizes.filter(F.col("rows") > group).select("range")
        more = min(STEP, DEEPEST - depth) if large.limit(1).count() else 0
        fits = waiting.join(large, "range", "left_anti") if more else waiting
        buckets = (sizes.agg(F.sum("rows")).first()[0] or 0) // BUCKET + 1
        bucket = F.pmod(F.xxhash64("range"), F.lit(buckets))
        linked = fits.groupBy(bucket.alias("bucket")).applyInArrow(within, "a long, b long")
        found = linked if found is None else found.union(linked)
        if not more:
            return found.distinct()
        waiting = written(_descend(waiting.join(large, "range", "left_semi"), depth, more, radius), "deeper")
        depth += more


# Components


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected edges ``a, b``; the root is the smallest node reachable.

    Alternates large-star and small-star steps until the edges no longer change.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = written(small.filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, component_id`` of the distinct fingerprints of ``doc_id, fp`` rows."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = connected(links(distinct.select("fp"), radius))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return named.select("fp", "root").join(ids, "root").select("fp", "component_id")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``df``: ``doc_id, fingerprint`` (16 hex digits) ``, component_id``."""
    prints = written(fingerprints(df, id_col, text_col), "simhash")
    out = prints.join(components(prints, radius), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Near copies by exact similarity


def _shingles(text: Column, shingle: int) -> Column:
    """Hashes of the distinct shingles of a text; of a shorter text its words as one."""
    trimmed = F.btrim(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(trimmed, r"[\x20\x09-\x0D]+")
    each = lambda w: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - shingle, F.lit(0))), lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, shingle), " "))
    )
    return F.array_distinct(F.transform(F.array(words), each)[0])


def _sets(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text (of a shorter text its words as one), sorted, and the number of each one's text."""
    ends = np.cumsum([len(t) for t in texts]) // SLICE
    cuts = [*np.flatnonzero(np.diff(ends, prepend=-1)).tolist(), len(texts)]
    slices = [_sets_of_slice(texts[a:b], shingle) for a, b in zip(cuts, cuts[1:])]
    if not slices:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate([d + a for (d, _), a in zip(slices, cuts)]), np.concatenate([h for _, h in slices])


def _sets_of_slice(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    flat, offsets = hashed([t.lower().split() for t in texts], remember=False)
    sizes = np.diff(offsets)
    counts = np.maximum(sizes - shingle + 1, 0)
    documents, hashes = [np.repeat(np.arange(len(texts)), counts)], []
    starts = np.repeat(offsets[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    hashes.append(grams(flat, shingle)[starts])
    for n in range(shingle):
        short = np.flatnonzero(sizes == n)
        documents.append(short)
        hashes.append(grams(flat, n)[offsets[short]] if n else np.zeros(len(short), np.uint64))
    documents, hashes = np.concatenate(documents), np.concatenate(hashes)
    order = np.lexsort((hashes, documents))
    documents, hashes = documents[order], hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (documents[1:] != documents[:-1]) | (hashes[1:] != hashes[:-1])
    return documents[fresh], hashes[fresh]


def _signatures(shingle: int):
    def signatures(texts: pa.Array) -> dict[str, pa.Array]:
        """128 bits of each text's set of shingles."""
        documents, hashes = _sets(texts_of(texts), shingle)
        cuts = np.searchsorted(documents, np.arange(len(texts) + 1))
        return {"sig": pa.array([xxhash.xxh3_128_digest(hashes[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])], pa.binary())}

    return signatures


def _sketched(hashes: np.ndarray) -> np.ndarray:
    """The bits by which shingles are counted.  Where two meet, both count as more frequent, which changes the order alike for all."""
    return hashes & ~np.uint64((1 << SKETCH) - 1)


def _send_shingles(n_owners: int, shingle: int):
    """Shingles of a part to the owners of their hashes, with the number of texts that have each."""

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sketches, counts = np.unique(_sketched(_sets(texts_of(table["text"]), shingle)[1]), return_counts=True)
        cuts = owner_cuts(sketches, n_owners)
        there = np.flatnonzero(np.diff(cuts))
        spans = [slice(cuts[o], cuts[o + 1]) for o in there]
        return pa.table(
            {
                "owner": pa.array(there, pa.int32()),
                "part": pa.array([key[0].as_py()] * len(there), pa.int64()),
                "hashes": pa.array([pack_sorted(sketches[s] >> np.uint64(SKETCH)) for s in spans], pa.binary()),
                "counts": pa.array([pack_counts(counts[s]) for s in spans], pa.binary()),
            }
        )

    return send


def _levels(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each shingle of a message how many texts have it, as eight times the logarithm: 0 for a single one."""
    hashes = [unpack_sorted(b) for b in table["hashes"].to_pylist()]
    counts = np.concatenate([unpack_counts(b) for b in table["counts"].to_pylist()])
    _, place = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.bincount(place, weights=counts)
    levels = np.minimum(8 * np.log2(totals), 255).astype(np.uint8)[place]
    return pa.table(
        {
            "part": table["part"].combine_chunks(),
            "owner": pa.array([key[0].as_py()] * table.num_rows, pa.int32()),
            "levels": pa.array([x.tobytes() for x in np.split(levels, np.cumsum([len(h) for h in hashes])[:-1])], pa.binary()),
        }
    )


def _prefixes(n_owners: int, shingle: int, similarity: float):
    """The rarest shingles of each text, as many as a like text can't lack altogether, but for those that no other text has.

    ``at`` is the place of a shingle among the ``n`` of its text, rare ones first, equally frequent ones by hash; ``typical`` is
    the mean level of the text's shingles.
    """

    def prefixes(table: pa.Table, answers: pa.Table) -> pa.Table:
        documents, hashes = _sets(texts_of(table["text"]), shingle)
        sketches, place = np.unique(_sketched(hashes), return_inverse=True)
        cuts = owner_cuts(sketches, n_owners)
        levels = np.zeros(len(sketches), np.uint8)
        for owner, blob in zip(answers["owner"].to_pylist(), answers["levels"].to_pylist()):
            levels[cuts[owner] : cuts[owner + 1]] = np.frombuffer(blob, np.uint8)
        levels = levels[place]
        order = np.lexsort((hashes, levels, documents))
        documents, hashes, levels = documents[order], hashes[order], levels[order]
        sizes = np.bincount(documents, minlength=table.num_rows)
        typical = np.bincount(documents, weights=levels, minlength=table.num_rows) / sizes
        at = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        sizes = sizes[documents]
        kept = (levels > 0) & (at <= sizes - np.ceil(similarity * sizes - 1e-9))
        nodes = table["node"].to_numpy()
        return pa.table(
            {
                "token": pa.array(hashes[kept].view(np.int64)),
                "node": pa.array(nodes[documents[kept]]),
                "n": pa.array(sizes[kept].astype(np.int32)),
                "at": pa.array(at[kept].astype(np.int32)),
                "typical": pa.array(typical[documents[kept]].astype(np.float32)),
            }
        )

    return prefixes


def _pairs_between(share: float, chunk: int = 2_000_000):
    """Pairs of unlike ``root`` within the groups of a bucket that can still share enough."""

    def pairs(table: pa.Table) -> pa.Table:
        token, one, two, block, node, root, n, at = (table[c].to_numpy() for c in ("token", "one", "two", "block", "node", "root", "n", "at"))
        order = np.lexsort((node, block, two, one, token))
        one, two, block, node, root, n, at = (v[order] for v in (one, two, block, node, root, n, at))
        number = runs(token[order], one, two)
        starts = np.searchsorted(number, np.arange(number[-1] + 2))
        found = [np.empty((0, 2), np.int64)]
        for a, b in zip(starts, starts[1:]):
            # Of two blocks, rows of the first meet those of the second; within one block, all later ones.
            cross = one[a] != two[a]
            middle = a + int(np.searchsorted(block[a:b], two[a])) if cross and one[a] < two[a] else b
            right = np.arange(middle if cross else a, b)
            for x in range(a, middle, max(1, chunk // max(1, len(right)))):
                left = np.arange(x, min(middle, x + max(1, chunk // max(1, len(right)))))
                rest = np.minimum((n[left] - at[left])[:, None], (n[right] - at[right])[None, :])
                near = (rest >= share * (n[left][:, None] + n[right][None, :]) - 1e-9) & (root[left][:, None] != root[right][None, :])
                if not cross:
                    near &= left[:, None] < right[None, :]
                i, j = np.nonzero(near)
                found.append(np.stack([np.maximum(node[left[i]], node[right[j]]), np.minimum(node[left[i]], node[right[j]])], axis=1))
        found = np.unique(np.concatenate(found), axis=0)
        return pa.table({"x": pa.array(found[:, 0].copy()), "y": pa.array(found[:, 1].copy())})

    return pairs


def _cross_pairs(mixed: DataFrame, share: float) -> DataFrame:
    """Pairs ``x, y`` of all rows of ``token, node, root, n, at`` with the same token, in blocks of bounded size."""
    sizes = mixed.groupBy("token").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = mixed.join(sizes, "token").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = written(other.select("token", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "root", "n", "at"), "blocks")
    buckets = both.count() // PAIR_BUCKET + 1
    bucket = F.pmod(F.xxhash64("token", "one", "two"), F.lit(buckets))
    return both.groupBy(bucket.alias("bucket")).applyInArrow(_pairs_between(share), "x long, y long").distinct()


def drop_near_copies(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8
) -> DataFrame:
    """The rows of ``df`` but for near copies: of each group the row with the smallest id stays (ids of null come last).

    Rows link when the Jaccard index of their sets of ``shingle``-word shingles is ``similarity`` or more; a group is what links connect.
    No link is missed but such as do not change the groups:

    1. Rows with equal sets are linked; the first of them stands for all.
    2. Parts send their shingles to hash owners and get back how many texts have each.
    3. With shingles ordered rare ones first, two like rows share one of the first ``n - ceil(similarity * n) + 1`` of each (the prefix filter).
       Shingles that a single text has are left out, so most rows meet no other.
    4. Rows that share such a shingle are first compared with the one whose shingles are the most frequent: edited copies with their original.  What this links needs no further comparison.
    5. All other pairs that share one are compared, in blocks, unless their places rule the similarity out.
       Each comparison is of whole texts.
    """
    n_owners, share = owners(df.sparkSession), similarity / (1 + similarity)
    table = parted(df, text_col, "near", _signatures(shingle), "sig binary")
    text = F.coalesce(F.col("data").getField(text_col), F.lit(""))
    node = row_number(F.col("part"), F.col("row"))
    nodes = table.select(node.alias("node"), "sig", F.col("data").getField(id_col).cast("long").alias("id"))

    def rows_by_part(some: DataFrame) -> DataFrame:
        """At most as many rows as the part has.  Joined by part, texts stay where they are."""
        row = F.col("node").bitwiseAND(F.lit((1 << 20) - 1)).cast("int")
        return some.groupBy(F.shiftright("node", 20).alias("part")).agg(F.collect_list(row).alias("rows"))

    def without(some: DataFrame) -> DataFrame:
        return table.join(rows_by_part(some), "part", "left").filter(F.col("rows").isNull() | ~F.array_contains("rows", F.col("row")))

    def alike(pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``x, y`` that are similar, as ``a, b``."""
        pairs = written(pairs, "pairs")
        involved = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
        chosen = table.join(rows_by_part(involved), "part").filter(F.array_contains("rows", F.col("row")))
        sets = written(chosen.select(node.alias("node"), _shingles(text, shingle).alias("s")), "shingles")
        sides = pairs.join(sets.withColumnRenamed("node", "x").withColumnRenamed("s", "sx"), "x").join(sets.withColumnRenamed("node", "y").withColumnRenamed("s", "sy"), "y")
        common = F.size(F.array_intersect("sx", "sy"))
        near = sides.filter(common >= similarity * (F.size("sx") + F.size("sy") - common))
        return written(near.select(F.col("x").alias("a"), F.col("y").alias("b")), "alike")

    firsts = nodes.groupBy("sig").agg(F.min("node").alias("b"), F.count("*").alias("rows")).filter("rows > 1")
    equal = written(nodes.select(F.col("node").alias("a"), "sig").join(firsts.select("sig", "b"), "sig").filter("a <> b").select("a", "b"), "equal")
    fresh = without(equal.select(F.col("a").alias("node"))).select("part", node.alias("node"), text.alias("text"))
    sent = fresh.groupBy("part").applyInArrow(_send_shingles(n_owners, shingle), "owner int, part long, hashes binary, counts binary")
    answers = sent.groupBy("owner").applyInArrow(_levels, "part long, owner int, levels binary")
    prefixes = written(
        fresh.groupBy("part")
        .cogroup(answers.groupBy("part"))
        .applyInArrow(_prefixes(n_owners, shingle, similarity), "token long, node long, n int, at int, typical float"),
        "prefixes",
    )
    possible = lambda n, at: F.least(F.col("n") - F.col("at"), F.col(n) - F.col(at)) >= share * (F.col("n") + F.col(n)) - 1e-9
    pivots = prefixes.groupBy("token").agg(F.max(F.struct("typical", "node", "n", "at")).alias("pivot"), F.count("*").alias("rows")).filter("rows > 1")
    met = prefixes.join(pivots.select("token", "pivot"), "token").filter(F.col("node") != F.col("pivot.node")).filter(possible("pivot.n", "pivot.at"))
    met = met.select(F.greatest("node", "pivot.node").alias("x"), F.least("node", "pivot.node").alias("y")).distinct()
    found = alike(met).union(equal)
    groups = connected(found)
    rooted = prefixes.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = written(rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token"), "apart")
    if not apart.isEmpty():
        mixed = written(rooted.join(apart, "token", "left_semi"), "mixed")
        more = alike(_cross_pairs(mixed, share))
        groups = connected(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    groups = groups.union(groups.select("root", "root").distinct()).toDF("node", "root")
    members = written(groups.join(nodes, "node").select("node", "root", F.coalesce("id", F.lit(np.iinfo(np.int64).max)).alias("id")), "members")
    keep = members.groupBy("root").agg(F.min(F.struct("id", "node")).alias("keep"))
    gone = members.join(keep, "root").filter(F.col("node") != F.col("keep.node"))
    return without(gone).select(*[F.col("data").getField(c).alias(c) for c in df.columns])
