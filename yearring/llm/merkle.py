"""Merkle manifest of a dataset by time-forward processing.

Leaves of a tree lie in key order; every two consecutive nodes of a level have one parent, a last single one too.  A node's label
is (last leaf below it, level), so children come before their parents, and the nodes that a run of leaves completes have
labels next to each other.

*Forward.*  A task sweeps over a run of leaves by label.  Each digest is sent to its parent through a priority queue ordered
by label, which holds a message for each level at most.  A parent with all its children gets its digest and is sent on; messages to
parents that reach beyond the run leave the task.  Spark's shuffle is the external part of the queue: it delivers
those messages to blocks of ``2**26``, ``2**36``, ... leaves (parameters), whose tasks sweep over them in the same way.  After the block that holds a
whole tree, its root is left.

*Backward.*  The sweep runs from the largest label to the smallest.  A node has the proof suffix from itself to the root, and sends it,
with the digest of the other child in front, to each child.  Blocks hand suffixes to the runs below them, down to the leaves.

The trees of all values of ``lang`` grow side by side, however many leaves each has; their roots are the leaves of one more tree.
Runs are at most ``2**16`` leaves, so memory does not depend on sizes of trees.  Texts are read once, for their leaves.

Nulls: a null field is ``-`` in its leaf; null ``lang`` is a tree of its own, the first; null ``doc_id`` comes first and is never tampered
with.  Equal ``doc_id`` go by leaf digest; repeated rows are leaves of their own.  Very long texts are hashed by Spark in one pass.
An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from yearring.llm.parts import written

#: Leaves of a run, and levels that each later round of blocks adds.
RUN_LEVELS, BLOCK_LEVELS = 16, 10

Node = tuple[int, int]  # level, index in its level

FRONTIER = "tree string, n long, part long, seq long, level int, idx long, digest binary"


def h(*parts: bytes) -> bytes:
    """Lowercase hex SHA-256."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


# One task: sweeps over labelled nodes


def height(n: int) -> int:
    """Level of the root over n leaves."""
    return (n - 1).bit_length()


def _label(level: int, idx: int, n: int) -> tuple[int, int]:
    return min((idx + 1) << level, n) - 1, level


def _children(level: int, idx: int, n: int) -> list[Node]:
    right = 2 * idx + 1
    return [(level - 1, 2 * idx)] + ([(level - 1, right)] if right << (level - 1) < n else [])


def forward(nodes: dict[Node, bytes], n: int) -> tuple[dict[Node, bytes], list[Node]]:
    """Digests of all nodes that ``nodes``, in label order, complete; and those whose parent they don't."""
    known, frontier, top = dict(nodes), [], height(n)
    queue: list[tuple[tuple[int, int], int, int]] = []  # label of the parent, level and index of the child

    def send(level: int, idx: int) -> None:
        if level == top:
            frontier.append((level, idx))
        else:
            heappush(queue, (_label(level + 1, idx >> 1, n), level, idx))

    def receive() -> None:
        label, level, idx = heappop(queue)
        arrived = [(level, idx)]
        while queue and queue[0][0] == label:
            arrived.append(heappop(queue)[1:])
        parent = (level + 1, idx >> 1)
        if len(arrived) == len(_children(*parent, n)):
            known[parent] = h(*[known[child] for child in arrived])
            send(*parent)
        else:
            frontier.extend(arrived)

    for node in nodes:
        label = _label(*node, n)
        while queue and queue[0][0] < label:
            receive()
        send(*node)
    while queue:
        receive()
    return known, sorted(frontier, key=lambda node: node[1] << node[0])


def backward(known: dict[Node, bytes], given: dict[Node, bytes], inputs: dict[Node, bytes], n: int) -> Iterator[tuple[Node, bytes]]:
    """Proof suffixes of ``inputs``, from those of the nodes that left the forward sweep."""
    queue = []

    def send(node: Node, suffix: bytes) -> None:
        last, level = _label(*node, n)
        heappush(queue, (-last, -level, node, suffix))

    for node, suffix in given.items():
        send(node, suffix)
    while queue:
        _, _, node, suffix = heappop(queue)
        if node in inputs:
            yield node, suffix
            continue
        children = _children(*node, n)
        for at, child in enumerate(children):
            send(child, known[children[1 - at]] + suffix if len(children) == 2 else suffix)


def folded(digest: bytes, proof: bytes, *places: tuple[int, int]) -> bytes:
    """Root recomputed from a leaf and its siblings, through trees in which it has place ``idx`` of ``n``."""
    at = 0
    for idx, n in places:
        while n > 1:
            if idx & 1:
                digest, at = h(proof[at : at + 64], digest), at + 64
            elif idx + 1 < n:
                digest, at = h(digest, proof[at : at + 64]), at + 64
            else:
                digest = h(digest)
            idx, n = idx >> 1, (n + 1) >> 1
    if at != len(proof):
        raise ValueError("a proof has too many siblings")
    return digest


# All tasks: runs, blocks and the messages between them


@dataclass
class Forest:
    """Leaves in runs, and what each round of sweeps left over, up to the roots."""

    runs: DataFrame
    places: DataFrame
    rounds: list[DataFrame]
    shifts: list[int]

    @property
    def roots(self) -> DataFrame:
        return self.rounds[-1]


def _cut(items: DataFrame, order: list[str], limit: int, name: str) -> DataFrame:
    """Items of each tree, ordered, as runs: ``part, seq, tree, size, items array<struct>``."""
    data = [f for f in items.schema.fields if f.name != "tree"]
    schema = T.StructType(
        [
            *T.StructType.fromDDL("part long, seq long, tree string, size long").fields,
            T.StructField("items", T.ArrayType(T.StructType(data))),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        tree, held, rows = None, [], 0

        def run() -> pa.RecordBatch:
            whole = pa.concat_arrays(held)
            items = pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)
            columns = [pa.array([v], t) for v, t in ((part, pa.int64()), (seq, pa.int64()), (tree, pa.string()), (len(whole), pa.int64()))]
            return pa.RecordBatch.from_arrays([*columns, items], names=schema.names)

        for batch in batches:
            trees, values, at = batch.column(0), batch.column(1), 0
            while at < batch.num_rows:
                name = trees[at].as_py()
                if rows and (name != tree or rows == limit):
                    yield run()
                    seq, held, rows = seq + 1, [], 0
                tree = name
                same = batch.num_rows - at if trees[-1].as_py() == tree else int(pc.sum(pc.equal(trees.slice(at), tree)).as_py())
                take = min(same, limit - rows)
                held.append(values.slice(at, take))
                rows, at = rows + take, at + take
        if rows:
            yield run()

    # Rows that are repeated a billion times are split by their number in the input.
    numbered = items.withColumn("_nth", F.monotonically_increasing_id())
    keys = ["tree", *order, "_nth"]
    packed = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return written(packed.select("tree", F.struct(*[f.name for f in data]).alias("items")).mapInArrow(cut, schema), name)


def _places(runs: DataFrame) -> DataFrame:
    """For each run, the index of its first leaf and the number of leaves in its tree."""
    sizes = runs.select("part", "seq", "tree", "size")
    parts = sizes.groupBy("tree", "part").agg(F.sum("size").alias("size"))
    before_part = F.sum("size").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("tree", "part", F.coalesce(before_part, F.lit(0)).alias("start"))
    trees = parts.groupBy("tree").agg(F.sum("size").alias("n"))
    inside = F.sum("size").over(Window.partitionBy("tree", "part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    runs_inside = sizes.select("part", "seq", "tree", F.coalesce(inside, F.lit(0)).alias("inside"))
    placed = runs_inside.join(starts, ["tree", "part"]).join(trees, "tree")
    return placed.select("part", "seq", "tree", (F.col("start") + F.col("inside")).alias("first"), "n")


def _batch(rows: list[tuple], schema: T.StructType) -> pa.Table:
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[]] * len(arrow)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _hex(digests: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [d.hex().encode() for d in digests.to_pylist()]


def _leaves(runs: pa.Table, first: int) -> dict[Node, bytes]:
    items = runs.column("items").combine_chunks().flatten()
    return {(0, first + k): d for k, d in enumerate(_hex(items.field("digest")))}


def _messages(table: pa.Table) -> dict[Node, bytes]:
    """Nodes of a block in label order."""
    nodes = zip(table.column("level").to_pylist(), table.column("idx").to_pylist(), _hex(table.column("digest")))
    return {(level, idx): d for level, idx, d in sorted(nodes, key=lambda x: x[1] << x[0])}


def _block(shift: int) -> Column:
    """Block of ``2**shift`` leaves that a node lies in."""
    return F.expr(f"shiftright(shiftleft(idx, level), {shift})")


def grow(items: DataFrame, order: list[str], name: str, run_levels: int = RUN_LEVELS, block_levels: int = BLOCK_LEVELS) -> Forest:
    """Forward sweeps over ``items`` (``tree string, digest binary`` and others, ``order`` among them)."""
    runs, frontier = _cut(items, order, 1 << run_levels, f"{name}-runs"), T.StructType.fromDDL(FRONTIER)
    places = written(_places(runs), f"{name}-places")

    def over_run(run: pa.Table, place: pa.Table) -> pa.Table:
        n, tree = place.column("n")[0].as_py(), place.column("tree")[0].as_py()
        part, seq = place.column("part")[0].as_py(), place.column("seq")[0].as_py()
        known, left = forward(_leaves(run, place.column("first")[0].as_py()), n)
        return _batch([(tree, n, part, seq, *node, bytes.fromhex(known[node].decode())) for node in left], frontier)

    narrow = runs.select("part", "seq", F.transform("items", lambda x: F.struct(x["digest"].alias("digest"))).alias("items"))
    left = narrow.groupBy("part", "seq").cogroup(places.groupBy("part", "seq")).applyInArrow(over_run, frontier)
    rounds, shifts = [written(left, f"{name}-round")], []
    largest = places.agg(F.max("n")).first()[0] or 0
    while not shifts or 1 << shifts[-1] < largest:
        shifts.append(run_levels + block_levels * (len(shifts) + 1))

        def over_block(key: tuple, table: pa.Table) -> pa.Table:
            n = table.column("n")[0].as_py()
            known, left = forward(_messages(table), n)
            block = (key[0].as_py(), n, key[1].as_py(), 0)
            return _batch([(*block, *node, bytes.fromhex(known[node].decode())) for node in left], frontier)

        left = rounds[-1].withColumn("block", _block(shifts[-1])).groupBy("tree", "block").applyInArrow(over_block, frontier)
        rounds.append(written(left, f"{name}-round"))
    return Forest(runs, places, rounds, shifts)


def descend(forest: Forest, tops: DataFrame, emit: Callable, schema: str, name: str) -> DataFrame:
    """Backward sweeps.  ``tops`` has ``tree string, suffix binary, more struct`` for each tree; ``emit(items, suffixes, first, n, more)``
    makes rows of ``schema`` from a run's leaves, their suffixes and ``more`` of their tree."""
    handed = T.StructType([*T.StructType.fromDDL("tree string, part long, seq long, level int, idx long, suffix binary").fields, tops.schema["more"]])
    given = forest.roots.select("tree", "part", "seq", "level", "idx").join(tops, "tree").select(*handed.names)

    def suffixes(table: pa.Table) -> tuple[dict[Node, bytes], dict]:
        nodes = zip(table.column("level").to_pylist(), table.column("idx").to_pylist())
        return dict(zip(nodes, table.column("suffix").to_pylist())), table.column("more")[0].as_py()

    def over_block(key: tuple, messages: pa.Table, above: pa.Table) -> pa.Table:
        n, tree = messages.column("n")[0].as_py(), key[0].as_py()
        inputs, (tops_of, more) = _messages(messages), suffixes(above)
        nodes = zip(messages.column("level").to_pylist(), messages.column("idx").to_pylist())
        homes = dict(zip(nodes, zip(messages.column("part").to_pylist(), messages.column("seq").to_pylist())))
        known, _ = forward(inputs, n)
        return _batch([(tree, *homes[node], *node, suffix, more) for node, suffix in backward(known, tops_of, inputs, n)], handed)

    for shift, messages in zip(reversed(forest.shifts), reversed(forest.rounds[:-1])):
        blocks = messages.withColumn("block", _block(shift)).groupBy("tree", "block")
        above = given.withColumnRenamed("part", "block").groupBy("tree", "block")
        given = written(blocks.cogroup(above).applyInArrow(over_block, handed), f"{name}-proofs")

    def over_run(run: pa.Table, handed_down: pa.Table) -> pa.Table:
        first, n = handed_down.column("first")[0].as_py(), handed_down.column("n")[0].as_py()
        inputs, (tops_of, more) = _leaves(run, first), suffixes(handed_down)
        known, _ = forward(inputs, n)
        found = dict(backward(known, tops_of, inputs, n))
        items = run.column("items").combine_chunks().flatten()
        return _batch(emit(items, [found[node] for node in inputs], first, n, more), out)

    out = T.StructType.fromDDL(schema)
    placed = given.join(forest.places.drop("tree"), ["part", "seq"])
    runs = forest.runs.groupBy("part", "seq")
    return runs.cogroup(placed.groupBy("part", "seq")).applyInArrow(over_run, out)


# The manifest of documents


def field(value: Column) -> Column:
    """A leaf's field: ``-`` for null, else its UTF-8 length and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(n_chars: Column) -> Column:
    fields = [field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(n_chars), field(F.col("text"))]
    return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, digest, tampered``; the last null where the row is not tampered with."""
    docs = docs.select("doc_id", "source", "lang", "n_chars", "text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(F.col("n_chars")).alias("digest"),
        F.when(hit & F.col("n_chars").isNotNull(), leaf_digest(more)).alias("tampered"),
    )


def merkle_manifest(docs: DataFrame, run_levels: int = RUN_LEVELS, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per document: its leaf, its tree's root, the root of all, its proof's digest, and the check of its tampered form."""
    forest = grow(written(leaves(docs), "merkle-leaves"), ["doc_id", "digest"], "merkle", run_levels, block_levels)
    top = grow(forest.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"], "merkle-top", run_levels, block_levels)

    def hand_down(items, suffixes, first, n, more):
        subroots = _hex(items.field("digest"))
        rows = zip(items.field("name").to_pylist(), suffixes, subroots)
        return [
            (name, suffix, {"subroot": sub, "root": more["root"], "at": first + k, "trees": n})
            for k, (name, suffix, sub) in enumerate(rows)
        ]

    whole = top.roots.select("tree", F.lit(b"").alias("suffix"), F.struct(F.encode(F.lower(F.hex("digest")), "UTF-8").alias("root")).alias("more"))
    tops_schema = "tree string, suffix binary, more struct<subroot: binary, root: binary, at: bigint, trees: bigint>"
    tops = written(descend(top, whole, hand_down, tops_schema, "merkle-top"), "merkle-tops")

    def prove(items, suffixes, first, n, more):
        subroot, root = more["subroot"].decode(), more["root"].decode()
        rows = zip(items.field("doc_id").to_pylist(), _hex(items.field("digest")), items.field("tampered").to_pylist(), suffixes)
        out = []
        for k, (doc_id, leaf, tampered, proof) in enumerate(rows):
            seen = leaf if tampered is None else tampered.hex().encode()
            again = folded(seen, proof, (first + k, n), (more["at"], more["trees"])).decode()
            out.append((doc_id, leaf.decode(), subroot, root, h(proof).decode(), again, again == root))
        return out

    columns = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return descend(forest, tops, prove, columns, "merkle")
