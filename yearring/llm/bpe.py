"""Byte-level BPE: a backtracking encoder with exact merges, and an offset-table decoder.

Encoding a piece: an Aho-Corasick pass finds the longest token at every byte.  Tokens are taken from left to
right; a token may follow another only if the pair is compatible, that is, if applying the merges in rank order would not
have joined bytes across their border.  Where it may not, the next shorter token is tried, and where none is
left the last token is taken back.  A border found dead is never tried again, so the work is linear.

Texts are cut by the vocabulary's pre-tokenizer pattern first, special tokens before that, and the ids of pieces
are remembered by the worker, in bounded memory that is checked at each new piece.  Null texts are empty texts with no tokens; an empty table gives an empty result; repeated rows
are coded alike.  Very long texts and pieces need memory in proportion to their length only.
"""

from __future__ import annotations

import hashlib
import json

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.llm.packing import _byte_letters
from yearring.llm.parts import texts_of

#: The pattern that splits text before byte-level merges (white space spelled out as in Unicode's property).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Pieces up to so many bytes are remembered by a Python worker, in about so much memory; beyond it the memory starts anew.
PIECE_BYTES, MEMORY_BYTES = 64, 256 << 20
#: What a remembered piece takes besides its own bytes and ids, and pairs of tokens whose compatibility is remembered.
ENTRY_BYTES, PAIRS = 350, 500_000
#: Tokens decoded at a time.
CHUNK = 1 << 16


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        to_byte = {letter: byte for byte, letter in _byte_letters().items()}
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.token: list[bytes] = [b""] * size
        for letters, i in model["vocab"].items():
            self.token[i] = bytes(to_byte[c] for c in letters)
        for content, i in self.special.items():
            self.token[i] = content
        self.length = [len(t) for t in self.token]
        # How each token is made: rank of its merge, and what it is made of.  Bytes are not made.
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, made = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.merge[x, y] = rank
            self.rank[made], self.left[made], self.right[made] = rank, x, y
        # Tokens that merges can make, in the automaton; the longest proper prefix of each that is a token.
        ids = {self.token[i]: i for i in model["vocab"].values() if self.rank[i] >= 0 or self.length[i] == 1}
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = [-1] * size
        for token, i in ids.items():
            self.shorter[i] = next((ids[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ids), -1)
        # The offset table: where the bytes of each token lie in one string.
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self.sizes = np.array(self.length, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes


class Encoder(dict):
    """Pieces (as text) to their ids, in decimal with commas and as little-endian uint32 bytes."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pieces = regex.compile(SPLIT).findall
        self.specials = regex.compile("|".join(regex.escape(s.decode()) for s in self.vocabulary.special) or r"(?!)")
        self.fits: dict[tuple[int, int], bool] = {}
        self.held = 0

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a and b can stand side by side: looked up, or found by undoing merges from the last one on."""
        pair = (a, b)
        known = self.fits.get(pair)
        if known is None:
            v = self.vocabulary
            known, limit = True, len(v.merge)
            while True:
                if v.merge.get((a, b), limit) < limit:
                    known = False
                    break
                if v.rank[a] > v.rank[b]:
                    limit, a = v.rank[a], v.right[a]  # merges of equal rank go left to right: this one came before a merge over the border
                elif v.rank[b] >= 0:
                    limit, b = v.rank[b] + 1, v.left[b]
                else:
                    break
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[pair] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        v = self.vocabulary
        n, length, shorter, compatible = len(piece), v.length, v.shorter, self.compatible
        longest = [-1] * n
        for end, token in v.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length[token]] = token
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + length[token]
            if not dead[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return out

    def __missing__(self, piece: str) -> tuple[bytes, bytes]:
        raw = piece.encode()
        ids = self.encode_piece(raw)
        found = b",".join([b"%d" % i for i in ids]), np.array(ids, "<u4").tobytes()
        if len(raw) <= PIECE_BYTES:
            if self.held > MEMORY_BYTES:
                self.clear()
                self.held = 0
            self[piece] = found
            self.held += ENTRY_BYTES + len(raw) + len(found[0]) + len(found[1])
        return found

    def _found(self, text: str) -> list[tuple[bytes, bytes]]:
        get = self.__getitem__
        if "<" not in text or not self.specials.search(text):
            return list(map(get, self.pieces(text)))
        found, at = [], 0
        for match in self.specials.finditer(text):
            found += map(get, self.pieces(text[at : match.start()]))
            i = self.vocabulary.special[match.group().encode()]
            found.append((b"%d" % i, np.array([i], "<u4").tobytes()))
            at = match.end()
        found += map(get, self.pieces(text[at:]))
        return found

    def encode(self, text: str) -> tuple[bytes, np.ndarray]:
        """Ids of a text, in decimal joined by commas and as an array."""
        found = self._found(text)
        return b",".join([f[0] for f in found]), np.frombuffer(b"".join([f[1] for f in found]), "<u4")

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([f[1] for f in self._found(text)]), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        v, out = self.vocabulary, []
        for at in range(0, len(ids), CHUNK):
            some = ids[at : at + CHUNK]
            sizes = v.sizes[some]
            ends = np.cumsum(sizes)
            out.append(v.bytes[np.repeat(v.starts[some] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes())
        # Ids cut between the bytes of a letter decode to the replacement character.
        return b"".join(out).decode("utf-8", "replace").encode()


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int), one row per row of ``df``."""

    def each(batches):
        encoder = _encoder(tokenizer)
        for batch in batches:
            ids = [encoder.encode(t.decode())[1].astype(np.int32) for t in texts_of(batch.column(1))]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int32), *ids])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "ids"])

    return df.select(F.col(id_col).cast("long"), text_col).mapInArrow(each, "doc_id long, ids array<int>")


def decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``; null ids give an empty text."""

    def each(batches):
        decoder = _encoder(tokenizer)
        for batch in batches:
            texts = [decoder.decode(np.array(ids or [], np.int64)).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return df.select(F.col(id_col).cast("long"), ids_col).mapInArrow(each, "doc_id long, text string")


def round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass, returning digests: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""

    def each(batches):
        coder = _encoder(tokenizer)
        for batch in batches:
            counts, ids_sha, texts_sha = [], [], []
            for text in texts_of(batch.column(1)):
                decimal, ids = coder.encode(text.decode())
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(decimal).hexdigest())
                texts_sha.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(texts_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select(F.col(id_col).cast("long"), text_col).mapInArrow(each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
