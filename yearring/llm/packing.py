"""Best-fit packing with a swap-based local search.

Documents become token pieces of at most ``CAP`` tokens (only longer documents are cut).  Pieces are dealt at random into groups of
about ``GROUP``.  Each group places its pieces, longest first, into the fullest sequence with room; then it
searches among all underfull sequences for the change that fills one most: move one piece in, exchange one for one, two for one or one
for two.  Each change raises the sum of squared fills, so the emptiest sequences run dry and disappear; the search ends when no
sequence has such a change left.  Sequences still loosely filled are opened again and packed together with those of other groups,
round after round, while their number falls or until one group holds them.

Null texts are empty texts; an empty document has its end token.  Very long texts are encoded word by word and cut into pieces.  Repeated rows
are packed as often as they occur.  An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import heapq
import string
import struct
import unicodedata
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.llm.parts import texts_of, written

CAP = 4096
END = 1
GROUP = 20_000
#: Sequences filled below this share are opened again in the next round.
LOOSE = 0.97
#: The emptiest of so many oldest holders of a length is preferred; if none of them serves, all holders count.
LOOKS = 17
#: Memory of words in a Python worker: longest word kept, and bytes after which it starts anew, checked at each word.
WORD_BYTES, MEMORY_BYTES = 64, 320 << 20

#: ASCII signs that are neither letters nor digits.
_MARKS = string.punctuation.encode()

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


# Tokens


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _stays_letters(text: str) -> bool:
    """Whether the tokenizer's normaliser leaves nothing but letters: some letters turn into a letter and a mark."""
    return text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


class WordTokens(dict):
    """Token ids of white-space separated words, as little-endian uint32 bytes.

    The tokenizer drops white space and never joins across it, so words can be encoded one by one.  Words of lower-case letters
    skip its normaliser, which leaves them as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.held = 0

    def __missing__(self, word: bytes) -> bytes:
        head = word.rstrip(_MARKS)
        if head and len(head) < len(word) and (head.isalpha() or _stays_letters(head.decode())):
            # The tokenizer splits between letters and the signs that follow them.
            found = self[head] + self[word[len(head) :]]
        else:
            if word.isalpha() and word.islower():  # ASCII letters stand for themselves
                ids = [token.id for token in self.model.tokenize(word.decode())]
            else:
                text = word.decode()
                if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
                    ids = [token.id for token in self.model.tokenize(word.decode("latin-1").translate(self.letters))]
                else:
                    ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= WORD_BYTES:
            # Two bytes objects and a place in the table take about 230 bytes besides their content.
            self.held += len(word) + len(found) + 230
            if self.held > MEMORY_BYTES:
                self.clear()
                self.held = 0
            self[word] = found
        return found

    def encode(self, text: bytes) -> bytes:
        # A special token's name counts as written; all else is lower-cased anyway.
        words = (text if b"<|" in text else text.lower()).split()
        return b"".join(map(self.__getitem__, words))


_encoders: dict[str, WordTokens] = {}


def token_pieces(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", cap: int = CAP, end: int = END) -> DataFrame:
    """Pieces of at most ``cap`` tokens: ``uid, doc_id, piece, start, length, ids_crc32``."""
    tail = np.array([end], "<u4").tobytes()

    def each(batches):
        uid = TaskContext.get().partitionId() << 36
        if tokenizer not in _encoders:
            _encoders[tokenizer] = WordTokens(tokenizer)
        encode = _encoders[tokenizer].encode
        for batch in batches:
            index, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(texts_of(batch.column(1))):
                ids = encode(text) + tail
                for k, at in enumerate(range(0, len(ids), 4 * cap)):
                    cut = ids[at : at + 4 * cap]
                    index.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
            columns = [
                pa.array(np.arange(uid, uid + len(index))),
                batch.column(0).take(pa.array(index, pa.int64())),
                pa.array(piece, pa.int32()),
                *[pa.array(x, pa.int64()) for x in (start, length, crc)],
            ]
            uid += len(index)
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    return df.select(F.col(id_col).cast("long"), text_col).mapInArrow(each, PIECES)


# Packing


def best_fit(lengths: list[int], cap: int) -> list[list[int]]:
    """Sequences as lists of piece numbers: longest pieces first, each into the fullest sequence with room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (space left, sequence), sorted
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect.bisect_left(room, (lengths[i], -1))
        if at < len(room):
            left, number = room.pop(at)
            bins[number].append(i)
        else:
            left, number = cap, len(bins)
            bins.append([i])
        if left > lengths[i]:
            bisect.insort(room, (left - lengths[i], number))
    return bins


class _Pool:
    """Which sequences hold a piece, or a pair of pieces, of which length; the longest up to a limit is found in a bit set.

    The holders of a length lie in a heap by fill, so that the emptiest of all is found; entries that are out of date go when they come up.
    """

    def __init__(self, fill: list[int]):
        self.fill = fill
        self.at: dict[int, dict[int, int]] = {}
        self.heaps: dict[int, list[tuple[int, int]]] = {}
        self.lengths = 0

    def add(self, length: int, n: int) -> None:
        at = self.at.get(length)
        if not at:
            at = self.at[length] = {}
            self.heaps[length] = []
            self.lengths |= 1 << length
        if n not in at:
            heapq.heappush(self.heaps[length], (self.fill[n], n))
        at[n] = at.get(n, 0) + 1

    def remove(self, length: int, n: int) -> None:
        at = self.at[length]
        at[n] -= 1
        if not at[n]:
            del at[n]
            if not at:
                del self.at[length], self.heaps[length]
                self.lengths &= ~(1 << length)

    def longest(self, limit: int) -> int:
        """The greatest length up to ``limit``, or -1."""
        return (self.lengths & ((1 << (limit + 1)) - 1)).bit_length() - 1

    def emptiest(self, length: int, but: int) -> int | None:
        """Of all holders of a length other than ``but`` the one with the lowest fill."""
        at, heap, own = self.at[length], self.heaps[length], None
        while heap:
            fill, m = heap[0]
            if m in at and self.fill[m] == fill and m != but:
                break
            if m == but and m in at and self.fill[m] == fill:
                own = heap[0]
            heapq.heappop(heap)
        found = heap[0][1] if heap else None
        if own:
            heapq.heappush(heap, own)
        return found


class _Search:
    """Underfull sequences with their pieces and pairs of pieces by length."""

    def __init__(self, bins: list[list[int]], lengths: list[int], cap: int):
        self.bins, self.lengths, self.cap = [list(b) for b in bins], lengths, cap
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.pools = (_Pool(self.fill), _Pool(self.fill))
        for n in range(len(bins)):
            self._list(n, _Pool.add)

    def _pairs(self, n: int) -> dict[int, tuple[int, int]]:
        """One pair of pieces for each sum of lengths; at most 90 distinct lengths fit into a sequence of 4096."""
        of: dict[int, list[int]] = {}
        for i in self.bins[n]:
            of.setdefault(self.lengths[i], []).append(i)
        own, pairs = list(of), {}
        for k, a in enumerate(own):
            for b in own[:k]:
                pairs[a + b] = (of[a][0], of[b][0])
            if len(of[a]) > 1:
                pairs[2 * a] = (of[a][0], of[a][1])
        return pairs

    def _list(self, n: int, change) -> None:
        if 0 < self.fill[n] < self.cap:
            singles, pairs = self.pools
            for i in self.bins[n]:
                change(singles, self.lengths[i], n)
            for length in self._pairs(n):
                change(pairs, length, n)

    def _partner(self, pool: _Pool, n: int, give: int, least: int) -> tuple[int, int, int] | None:
        """Gain, sequence and length of what to take for ``give`` tokens: the longest that any other sequence can give.

        The sum of squares rises if the filled sequence ends up fuller than the other one was.  The oldest holders of a length come
        first, as taking always from the emptiest ends in worse packings; if none of them is empty enough, the emptiest of all
        decides: if it is not either, no holder is.
        """
        fill = self.fill
        length = pool.longest(give + self.cap - fill[n])
        while length - give > least:
            below = fill[n] + length - give
            best = min((m for m in islice(pool.at[length], LOOKS) if m != n and fill[m] < below), key=fill.__getitem__, default=None)
            if best is None and (m := pool.emptiest(length, n)) is not None and fill[m] < below:
                best = m
            if best is not None:
                return length - give, best, length
            length = pool.longest(length - 1)
        return None

    def _change(self, n: int) -> tuple | None:
        """The change that fills ``n`` most: gain, other sequence, length taken, number of pieces taken, pieces given."""
        best, gain, seen = None, 0, set()
        gives = [(), *[(i,) for i in self.bins[n]], *self._pairs(n).values()]
        for give in gives:
            size = sum(self.lengths[i] for i in give)
            if (len(give), size) in seen:
                continue
            seen.add((len(give), size))
            for taken, pool in enumerate(self.pools, 1):
                if taken == 2 and len(give) != 1:
                    continue
                found = self._partner(pool, n, size, gain)
                if found:
                    gain, best = found[0], (*found, taken, give)
            if gain == self.cap - self.fill[n]:
                break
        return best

    def _apply(self, n: int, gain: int, m: int, length: int, taken: int, give: tuple[int, ...]) -> None:
        for k in (n, m):
            self._list(k, _Pool.remove)
        if taken == 1:
            take = (next(i for i in self.bins[m] if self.lengths[i] == length),)
        else:
            take = self._pairs(m)[length]
        self.bins[n] = [i for i in self.bins[n] if i not in give] + list(take)
        self.bins[m] = [i for i in self.bins[m] if i not in take] + list(give)
        self.fill[n] += gain
        self.fill[m] -= gain
        for k in (n, m):
            self._list(k, _Pool.add)

    def run(self) -> list[list[int]]:
        moved = True
        while moved:
            moved = False
            for n in sorted((n for n, f in enumerate(self.fill) if 0 < f < self.cap), key=lambda n: -self.fill[n]):
                while 0 < self.fill[n] < self.cap and (change := self._change(n)):
                    self._apply(n, *change)
                    moved = True
        return [b for b in self.bins if b]


def local_search(bins: list[list[int]], lengths: list[int], cap: int) -> list[list[int]]:
    """Fill underfull sequences from others while the sum of squared fills rises."""
    return _Search(bins, lengths, cap).run()


def _pack_group(cap: int, number: int):
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("uid").drop_columns(["group"])
        lengths = table["length"].to_pylist()
        bins = local_search(best_fit(lengths, cap), lengths, cap)
        rows, sequence, offset, fill = [], [], [], []
        for n, pieces in enumerate(bins):
            ends = np.cumsum([lengths[i] for i in pieces]).tolist()
            rows += pieces
            sequence += [number << 56 | key[0].as_py() << 20 | n] * len(pieces)
            offset += [0, *ends[:-1]]
            fill += [ends[-1]] * len(pieces)
        out = table.take(pa.array(rows, pa.int64()))
        for name, values in (("sequence_id", sequence), ("offset", offset), ("fill", fill)):
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out

    return pack


def pack(pieces: DataFrame, cap: int = CAP, group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    columns = [c for c in pieces.columns]
    schema = f"{PIECES}, sequence_id long, offset long, fill long"
    whole = pieces.filter(F.col("length") == cap).select(*columns, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done = [whole]
    waiting, sequences, number = pieces.filter(F.col("length") < cap).select(*columns), None, 1
    placed_before, n = None, waiting.count()
    while n:
        groups = -(-n // group)
        dealt = waiting.withColumn("group", F.pmod(F.xxhash64("uid", F.lit(number)), F.lit(groups)))
        placed = written(dealt.groupBy("group").applyInArrow(_pack_group(cap, number), schema), f"packed{number}")
        loose = F.col("fill") < LOOSE * cap
        first = F.col("offset") == 0  # one in each sequence
        counts = placed.agg(F.count_if(first).alias("all"), F.count_if(first & loose).alias("loose"), F.count_if(loose).alias("pieces")).first()
        if sequences is not None and counts["all"] >= sequences:
            done.append(placed_before)
            break
        if groups == 1 or not counts["pieces"]:
            done.append(placed.select(*columns, "sequence_id", "offset"))
            break
        done.append(placed.filter(~loose).select(*columns, "sequence_id", "offset"))
        left = placed.filter(loose)
        placed_before, waiting = left.select(*columns, "sequence_id", "offset"), left.select(*columns)
        n, sequences, number = counts["pieces"], counts["loose"], number + 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.drop("uid")


def best_fit_packing(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", cap: int = CAP, end: int = END) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(written(token_pieces(df, tokenizer, id_col, text_col, cap, end), "pieces"), cap)
