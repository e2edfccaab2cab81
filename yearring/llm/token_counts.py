"""Token counts by section, from one encoding of the whole document.

The document is encoded once; the offset table of the vocabulary gives each token's bytes, and the text their characters.  A
token covers every character that it holds a byte of.  Token spans are then joined to the sections' character intervals.

Rule for tokens that cross a border: such a token goes, as a whole, to the section that holds most of its characters; of
equal shares to the first.  So the counts of all sections and the rest add up to the document's tokens, which counting each section
on its own does not give.

Sections are the lines of a text (each with its line feed) or, if ``sections_col`` is given, an array of ``start, end`` in characters, end
exclusive; empty ones hold no token.  Characters in several sections belong to the one that starts first, of equal starts to
the first given.  A null section, or one with a null border, holds no token and is reported with null borders.  Tokens outside all sections are counted in a row with a null ``section``.
Null texts are empty texts; an empty text has one empty line, or the sections given, without tokens.  A null array counts as none.  Very long texts are encoded in time and memory linear in their length.  Sections
beyond the text end with it.  Repeated rows are counted alike; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.llm.bpe import Encoder, _encoder
from yearring.llm.parts import texts_of

SCHEMA = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long"


def spans(encoder: Encoder, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of every token."""
    ids = encoder.ids(text.decode())
    ends = np.cumsum(encoder.vocabulary.sizes[ids])
    letters = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1
    return letters[ends - encoder.vocabulary.sizes[ids]], letters[ends - 1]


def lines(text: bytes) -> np.ndarray:
    """Borders of the lines in characters: 0, after each line feed, and the end."""
    data = np.frombuffer(text, np.uint8)
    letters = np.cumsum((data & 0xC0) != 0x80)
    total = int(letters[-1]) if len(letters) else 0
    after = letters[data == 10]
    return np.unique(np.concatenate([[0], after, [total]])) if total else np.zeros(2, np.int64)


def allotted(first: np.ndarray, last: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval of each token among those between ``borders``, and whether the token crosses a border."""
    one = np.searchsorted(borders, first, "right") - 1
    two = np.searchsorted(borders, last, "right") - 1
    crossing = one != two
    for k in np.flatnonzero(crossing):
        inside = borders[one[k] : two[k] + 2].clip(first[k], last[k] + 1)
        one[k] += int(np.argmax(np.diff(inside)))
    return one, crossing


def _count(encoder: Encoder, text: bytes, given: list | None) -> tuple[np.ndarray, ...]:
    """Columns section (-1: none), start, end, tokens, crossing tokens of one document."""
    first, last = spans(encoder, text) if text else (np.empty(0, np.int64),) * 2
    if given is None:
        borders = lines(text)
        names = np.arange(len(borders) - 1)
        starts, ends = borders[:-1], borders[1:]
        inner = borders[:-1]
        place = names
    else:
        total = int(last[-1]) + 1 if len(last) else 0
        whole = [s if s is not None and s["start"] is not None and s["end"] is not None else None for s in given]
        starts, ends = (np.array([-1 if s is None else min(max(s[k], 0), total) for s in whole], np.int64) for k in ("start", "end"))
        ends = np.maximum(starts, ends)
        order = np.argsort(starts, kind="stable")
        # What an earlier section holds is taken from the later ones.
        held = np.concatenate([[0], np.maximum.accumulate(ends[order])[:-1]]) if len(order) else np.empty(0, np.int64)
        own = np.maximum(starts[order], held)
        some = own < ends[order]
        order, own = order[some], own[some]
        # Gaps are intervals too, of no section.
        inner = np.unique(np.concatenate([[0], own, ends[order]]))
        place = np.full(len(inner), len(given))
        place[np.searchsorted(inner, own)] = order
        names = np.append(np.arange(len(given)), -1)
        starts, ends = np.append(starts, 0), np.append(ends, total)
    interval, crossing = allotted(first, last, np.append(inner, np.iinfo(np.int64).max))
    counts = np.bincount(place[interval], minlength=len(names))
    crossed = np.bincount(place[interval[crossing]], minlength=len(names))
    return names, starts, ends, counts, crossed


def token_counts(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None) -> DataFrame:
    """Per document and section: ``doc_id, section, start, end, n_tokens, n_crossing``."""

    def each(batches):
        encoder = _encoder(tokenizer)
        for batch in batches:
            given = batch.column(2).to_pylist() if sections_col else None
            found, ids = [], []
            for i, text in enumerate(texts_of(batch.column(1))):
                one = _count(encoder, text, (given[i] or []) if sections_col else None)
                found.append(one)
                ids.append(np.full(len(one[0]), i))
            if not found:
                continue
            columns = [np.concatenate(c) for c in zip(*found)]
            section = pa.array(columns[0], pa.int32(), mask=columns[0] < 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.concatenate(ids))), section, *[pa.array(c, pa.int64(), mask=c < 0) for c in columns[1:]]],
                names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
            )

    chosen = [F.col(id_col).cast("long"), F.col(text_col)] + ([F.col(sections_col)] if sections_col else [])
    return df.select(*chosen).mapInArrow(each, SCHEMA)
