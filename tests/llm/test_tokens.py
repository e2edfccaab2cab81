"""Byte-level BPE and packing against the tokenizers library and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from yearring.llm import bpe, packing
from yearring.llm.queries import tokenizer

BYTES, WORDS = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json")


def library(path):
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(BYTES)


@pytest.fixture(scope="module")
def theirs():
    return library(BYTES)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aethrsin '\t\n<|>dx.,!0123éñß"), st.characters(codec="utf-8")), max_size=60))
def test_encodes_like_the_library(text):
    coder, theirs = bpe._encoder(BYTES), _theirs()
    decimal, ids = coder.encode(text)
    assert ids.tolist() == theirs.encode(text, add_special_tokens=False).ids
    assert decimal.decode() == ",".join(map(str, ids))
    assert coder.decode(ids) == text.encode()


def _theirs(kept=[]):  # noqa: B006
    if not kept:
        kept.append(library(BYTES))
    return kept[0]


def test_special_and_long_pieces(coder, theirs):
    for text in ("a<|endoftext|>b<|endoftext|>", "<|endoftext|>", "<|endoftex|>", "a" * 20_000, "ab" * 9_000, " " * 5_000, "the" * 5_000):
        assert coder.encode(text)[1].tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_every_token_encodes_to_itself(coder):
    v = coder.vocabulary
    assert all(coder.encode_piece(v.token[i]) == [i] for i in range(len(v.token)) if v.token[i] not in v.special)


def test_broken_letters_decode_like_the_library(coder, theirs):
    ids = [i for i in range(256)] + theirs.encode("日本", add_special_tokens=False).ids[:2]
    assert coder.decode(np.array(ids)).decode() == theirs.decode(ids, skip_special_tokens=False)


def test_round_trip(nasty, theirs):
    rows, df = nasty
    want = Counter()
    for i, t in rows:
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = bpe.round_trip(df, BYTES).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    back = bpe.decode(bpe.encode(df, BYTES), BYTES).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t or "") for i, t in rows)


def pieces_of(rows, cap):
    theirs, want = library(WORDS), Counter()
    for i, t in rows:
        ids = np.array(theirs.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), cap)):
            want[i, k, at, len(ids[at : at + cap]), zlib.crc32(ids[at : at + cap].tobytes())] += 1
    return want


@pytest.mark.parametrize("cap", [4096, 100])
def test_packing(nasty, cap):
    rows, df = nasty
    extra = [(900, "Special <|endoftext|> and <|ENDOFTEXT|> İstanbul Σίσυφος ﬁne é 1,000.5 don't"), (901, "A B c")]
    df = df.select("doc_id", "text").union(df.sparkSession.createDataFrame(extra, "doc_id long, text string"))
    got = packing.best_fit_packing(df, WORDS, cap=cap).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces_of(rows + extra, cap)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for found in sequences.values():
        found.sort()
        assert [at for at, _ in found] == [0, *np.cumsum([n for _, n in found]).tolist()[:-1]]
        assert sum(n for _, n in found) <= cap
    total = sum(r.length for r in got)
    assert len(sequences) <= 1.02 * total / cap + 1


def test_the_memory_of_pieces_is_bounded(monkeypatch):
    """Within one text as well; long pieces are not kept, and the ids stay the same."""
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(10**9)}q" for _ in range(3_000)) + " " + "ab" * 400 + " " + "ab" * 400
    plain = bpe.Encoder(BYTES)
    want = plain.ids(text).tolist()
    assert 0 < plain.held < bpe.MEMORY_BYTES and all(len(piece.encode()) <= bpe.PIECE_BYTES for piece in plain)
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 100 * bpe.ENTRY_BYTES)
    monkeypatch.setattr(bpe, "PAIRS", 50)
    small = bpe.Encoder(BYTES)
    assert small.ids(text).tolist() == want
    assert len(small) <= 102 and len(small.fits) <= 50
    assert small.decode(small.ids(text)) == text.encode()


def test_many_groups_meet_again(spark, monkeypatch):
    """Small groups leave loose sequences; the rounds join them."""
    rng = random.Random(4)
    rows = [(n, n, 0, 0, rng.randrange(1, 101), 0) for n in range(3000)]
    out = packing.pack(spark.createDataFrame(rows, packing.PIECES), cap=100, group=600).collect()
    assert Counter(r.doc_id for r in out) == Counter(range(3000))
    fill = Counter()
    for r in out:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 100
    together = packing.best_fit([r[4] for r in rows], 100)
    assert len(fill) <= 1.01 * len(together) + 1


def test_long_pieces_only(spark):
    rows = [(n, n, 0, 0, 60, 0) for n in range(500)]
    out = packing.pack(spark.createDataFrame(rows, packing.PIECES), cap=100, group=50).collect()
    assert len({r.sequence_id for r in out}) == 500


def test_local_search_empties_a_sequence():
    lengths = [6, 4, 5, 4, 1, 3, 3, 4]
    bins = [[0], [2, 3], [1, 5], [6, 4, 7]]  # 30 tokens in four sequences of ten
    out = packing.local_search(bins, lengths, 10)
    assert sorted(i for b in out for i in b) == list(range(8))
    assert all(sum(lengths[i] for i in b) <= 10 for b in out)
    assert len(out) == 3


def thirds():
    """6000 full sequences cut in three, each piece 1250 to 1500 long or so: they fit into 6000."""
    rng, lengths = random.Random(9), []
    for _ in range(6000):
        a, b = rng.randrange(1100, 1500), rng.randrange(1100, 1500)
        lengths += [a, b, 4096 - a - b]
    return lengths


MIXES = {
    "thirds": (thirds, 6000, 0.5),
    # One of each fills a sequence exactly.
    "exact": (lambda: random.Random(3).choices([1000, 1366, 1730], k=20_000), None, 0.5),
}


def test_partners_are_sought_among_all_holders():
    """Forty sequences that are too full hold the length before the one that fits; pairs are found in sequences of many pieces, too."""
    lengths = [60] + [30, 65] * 40 + [30, 55]
    search = packing._Search([[0], *[[i, i + 1] for i in range(1, 83, 2)]], lengths, 100)
    assert search._partner(search.pools[0], 0, 0, 0) == (30, 41, 30)
    many = packing._Search([[0], list(range(1, 31))], [88] + [3] * 29 + [4], 100)
    assert many._partner(many.pools[1], 0, 0, 0) == (7, 1, 7)


@pytest.mark.parametrize("name", MIXES)
def test_local_search_on_hard_lengths(name):
    """Best fit leaves hundreds of sequences too many; the search removes at least half of them."""
    make, possible, share = MIXES[name]
    lengths = make()
    bins = packing.best_fit(lengths, 4096)
    possible = possible or -(-sum(lengths) // 4096)
    out = packing.local_search(bins, lengths, 4096)
    assert sorted(i for b in out for i in b) == list(range(len(lengths)))
    assert max(sum(lengths[i] for i in b) for b in out) <= 4096
    assert len(bins) - len(out) >= share * (len(bins) - possible) > 50


def test_rounds_end_when_the_number_stays(spark):
    """Three lengths over several groups: what is opened again is packed in fewer sequences, or stays as it was."""
    lengths = random.Random(5).choices([1000, 1366, 1730], k=6000)
    rows = [(n, n, 0, 0, size, 0) for n, size in enumerate(lengths)]
    out = packing.pack(spark.createDataFrame(rows, packing.PIECES), group=1000).collect()
    assert Counter(r.doc_id for r in out) == Counter(range(6000))
    fill, places = Counter(), {}
    for r in out:
        fill[r.sequence_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert max(fill.values()) <= 4096 and all(sum(n for _, n in sorted(p)[:k]) == sorted(p)[k][0] for p in places.values() for k in range(len(p)))
    best = len(packing.best_fit(lengths, 4096))
    assert len(fill) <= best - 0.5 * (best - -(-sum(lengths) // 4096))


def test_word_memory_is_bounded_by_bytes(monkeypatch):
    words = packing.WordTokens(WORDS)
    monkeypatch.setattr(packing, "MEMORY_BYTES", 50_000)
    for i in range(2000):
        words.encode(f"word{i} {'x' * 5000}{i}".encode())
        assert words.held <= 50_000 and len(words) < 300 and all(len(w) <= packing.WORD_BYTES for w in words)


def test_empty_tables(empty):
    assert bpe.round_trip(empty, BYTES).collect() == []
    assert bpe.encode(empty, BYTES).collect() == []
    assert packing.best_fit_packing(empty, WORDS).collect() == []


def test_letters_and_the_signs_after_them_are_encoded_apart():
    words = packing.WordTokens(WORDS)
    whole, library = [], words.tokenizer

    class Counting:
        def encode(self, text, **options):
            whole.append(text)
            return library.encode(text, **options)

    words.tokenizer = Counting()
    # capitals and accents, signs in runs, a quote, letters whose lower case or normal form has a mark
    for text in ("lenden###", "lenden!!", "straße&&&", "Éa%%", "it's", "lls'", "İ###", "aİ!", "שׁ##", "a1##", "##", "<|endoftext|>", "x<|"):
        ids = library.encode(text, add_special_tokens=False).ids
        assert words.encode(text.encode()) == np.array(ids, "<u4").tobytes(), text
    assert not {"lenden###", "lenden!!", "straße&&&"} & set(whole)
