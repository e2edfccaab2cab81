"""Clustering an archive by (current or not, load time), and removing what no manifest needs."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import functions as F

from yearring.sources.store import CLOSED, COMPRESSION, ENDS, OPEN, Archive, Manifest, key_options

FILE_BYTES = 256 << 20


def cluster_archive(archive: Archive, now: str, files: int | None = None, file_bytes: int = FILE_BYTES, everything: bool = False) -> Manifest:
    """Rewrite the parts that are not clustered yet in ``_loaded_at`` order, and commit them as one part of each state.

    Open and closed rows stay in separate folders, so current-state queries read
    one of them; inside, file ranges and row-group statistics on ``_loaded_at``
    let time filters skip data.  The id breaks ties, because one load stamps all
    its rows with the same time and they could not be split over tasks.

    The number of files follows the bytes of the parts.  A clustered part is only taken again with ``everything``, or, if it holds open
    versions, when there are ends: they are folded into the parts, and what they end moves to the closed side.
    """
    old = archive.manifest()
    version = old.version + 1
    parts, ends = [], [p for p in old.parts if p.state == ENDS]
    for state in (OPEN, CLOSED):
        mine = [p for p in old.parts if p.state == state]
        settled = [] if everything or (ends and state == OPEN) else [p for p in mine if p.clustered]
        loose = [p for p in mine if p not in settled]
        parts += settled
        if ends:  # the versions that they end lie among the open ones
            loose += [p for p in old.parts if p not in loose and p.state in (OPEN, ENDS)]
        taken = replace(old, parts=tuple(loose))
        rows, size = taken.rows(state), sum(p.bytes for p in mine if p in loose)
        if not rows:
            continue
        if ends and state == CLOSED:  # their share of the parts they still lie in
            lying = [p for p in loose if p.state == OPEN]
            size += sum(p.bytes for p in lying) * sum(p.rows for p in ends) // max(1, sum(p.rows for p in lying))
        directory = f"{archive.run_dir(version)}/clustered/{state}"
        keys = [F.col("_loaded_at"), F.col("_archive_id")]
        count = files or max(1, -(-size // file_bytes))
        data = archive.read(state, taken)
        data.repartitionByRange(count, *keys).sortWithinPartitions(*keys).write.options(**COMPRESSION, **key_options(old.key)).parquet(f"{archive.path}/{directory}")
        parts.append(replace(archive.part(directory, state, rows), clustered=True))
    return archive.commit(replace(old, version=version, parts=tuple(parts), modified=now))


def vacuum(archive: Archive, keep_versions: int = 1) -> int:
    """Delete what the newest ``keep_versions`` manifests do not name; returns the number of deleted files and folders.

    Goes: older manifests, parts that only they name, and staging of loads that never
    committed.  Folders of versions above the newest belong to loads under way and stay.  Readers that still use an older
    version fail, so ``keep_versions`` has to cover the longest query.
    """
    if keep_versions < 1:
        raise ValueError("at least one version must stay")
    fs, root = archive.fs, archive.path
    logs = [n for n in fs.names(f"{root}/_log") if n.endswith(".json")]
    kept = [Manifest.from_text(fs.read_text(f"{root}/_log/{n}")) for n in logs[-keep_versions:]]
    if not kept:
        return 0
    newest, gone = kept[-1].version, 0
    named = {part.dir for manifest in kept for part in manifest.parts}
    for name in logs[:-keep_versions]:
        fs.drop_dir(f"{root}/_log/{name}")
        gone += 1
    for top in ("data", "staging"):
        for run in fs.names(f"{root}/{top}"):
            found = re.match(r"run=(\d+)", run)
            if not found or int(found[1]) > newest:
                continue
            if not any(d.startswith(f"{top}/{run}/") for d in named):
                fs.drop_dir(f"{root}/{top}/{run}")
                gone += 1
    return gone
