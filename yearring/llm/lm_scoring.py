"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of a word given the word before it, of the word alone, and a uniform share:

    p(w | v) = a2[b] c(v,w) / c(v)  +  a1[b] c(w) / N  +  a0[b] / (V + 1),        b = bucket of c(v)

Contexts fall in buckets by the power of two of their frequency.  The weights of each bucket are learned by expectation-maximisation
on the counts of a tuning fold of the training rows, against estimates from which that fold's counts are deleted.  Scores use
the counts of all training rows.

1. Documents are written in parts.  Each part sends its sorted distinct word and word-pair hashes with its own counts to
   the owners of the hash ranges, once each, however often they occur.
2. Owners add up and answer each part in the order that it sent, so answers are counts only.
3. Parts with tuning rows return a histogram of (bucket, pair estimate, word estimate) at two steps an octave: at most 34 x 81 x 81 cells
   at any input size.  The weights are fitted on it.
4. Parts score all of their documents.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; each text has one end token more, which is also the context of its first word.
Null texts are empty texts.  Rows with a null id get the remainder of the empty string.  Repeated rows count as often as they
occur.  Without training rows every word has probability 1; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearring.llm.parts import owner_cuts, owners, pack_counts, pack_sorted, parted, runs, texts_of, unpack_counts, unpack_sorted, written
from yearring.llm.words import hashed, mixed

#: No word contains white space, so this never equals a word's hash but by chance.
END = b"\n"
STEPS = 2
LEVELS = 81
EM_ROUNDS = 200


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % by).cast("int")


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all documents, pair hashes (context and word), and where documents begin."""
    words, offsets = hashed([[*t.lower().split(), END] for t in texts_of(table["text"])])
    before = np.empty_like(words)
    before[1:] = words[:-1]
    if len(words):
        before[offsets[:-1]] = words[offsets[1:] - 1]  # the end token
    return words, mixed(before * np.uint64(0x9E3779B97F4A7C15) + words), offsets


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted values, and the place of each value among them."""
    order = np.argsort(values)
    group = runs(values[order])
    place = np.empty(len(values), np.int64)
    place[order] = group
    first = np.flatnonzero(np.diff(group, prepend=-1))
    return values[order][first], place


def _send(n_owners: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        words, pairs, offsets = _tokens(table)
        lengths = np.diff(offsets)
        fold = table["fold"].to_numpy()  # 0 scored only, 1 training, 2 training and tuning
        train, tune = np.repeat(fold > 0, lengths), np.repeat(fold > 1, lengths)
        rows: dict[str, list] = {"owner": [], "order": [], "hashes": [], "train": [], "tune": []}
        for order, values in ((1, words), (2, pairs)):
            distinct, place = _ranked(values)
            counts = [np.bincount(place, weights=w, minlength=len(distinct)).astype(np.int64) for w in (train, tune)]
            cuts = owner_cuts(distinct, n_owners)
            for owner in np.flatnonzero(np.diff(cuts)):
                s = slice(cuts[owner], cuts[owner + 1])
                for name, value in zip(rows, (owner, order, pack_sorted(distinct[s]), *[pack_counts(c[s]) for c in counts])):
                    rows[name].append(value)
        return pa.table(
            {
                "owner": pa.array(rows["owner"], pa.int32()),
                "part": pa.array([key[0].as_py()] * len(rows["owner"]), pa.int64()),
                "order": pa.array(rows["order"], pa.int32()),
                **{name: pa.array(rows[name], pa.binary()) for name in ("hashes", "train", "tune")},
            }
        )

    return send


def _add_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Total counts for each message, and for the whole range tokens and known words, with and without the tuning fold."""
    lists = [unpack_sorted(b) for b in table["hashes"].to_pylist()]
    ends = np.cumsum([len(x) for x in lists])[:-1]
    hashes = np.concatenate(lists)
    order = np.argsort(hashes, kind="stable")
    group = runs(hashes[order])
    totals, blobs = [], []
    for name in ("train", "tune"):
        own = np.concatenate([unpack_counts(b) for b in table[name].to_pylist()])
        total = np.bincount(group, weights=own[order]).astype(np.int64)
        back = np.empty(len(order), np.int64)
        back[order] = total[group]
        totals.append(total)
        blobs.append([pack_counts(x) for x in np.split(back, ends)])
    rest = totals[0] - totals[1]
    sums = [int(totals[0].sum()), int(rest.sum()), int((totals[0] > 0).sum()), int((rest > 0).sum())]
    n = table.num_rows
    return pa.table(
        {
            "part": table["part"].combine_chunks(),
            "owner": pa.array([key[0].as_py()] * n, pa.int32()),
            "order": pa.array([key[1].as_py()] * n, pa.int32()),
            "train": pa.array(blobs[0], pa.binary()),
            "tune": pa.array(blobs[1], pa.binary()),
            "sums": pa.array([sums] + [None] * (n - 1), pa.list_(pa.int64())),
        }
    )


def _answers(distinct: np.ndarray, answers: pa.Table, order: int, names: tuple[str, ...], n_owners: int) -> list[np.ndarray]:
    cuts = owner_cuts(distinct, n_owners)
    mine = answers.filter(pa.compute.equal(answers["order"], order))
    out = [np.zeros(len(distinct), np.int64) for _ in names]
    for owner, *blobs in zip(mine["owner"].to_pylist(), *[mine[n].to_pylist() for n in names]):
        for total, blob in zip(out, blobs):
            total[cuts[owner] : cuts[owner + 1]] = unpack_counts(blob)
    return out


def _estimates(offsets, word_counts, pair_counts, tokens: int):
    """Bucket of each token's context, and the two maximum-likelihood estimates of the token."""
    context = np.empty_like(word_counts)
    context[1:] = word_counts[:-1]
    if len(context):
        context[offsets[:-1]] = word_counts[offsets[1:] - 1]
    bucket = np.frexp(context.astype(np.float64))[1]  # 0 for no occurrence, else 1 + floor(log2)
    return bucket, pair_counts / np.maximum(context, 1), word_counts / max(tokens, 1)


def _levels(p: np.ndarray) -> np.ndarray:
    """0 for zero, else 1 + steps below one."""
    out = np.zeros(len(p), np.int64)
    some = p > 0
    out[some] = np.clip(1 + np.rint(-STEPS * np.log2(p[some])), 1, LEVELS - 1)
    return out


def _histogram(n_owners: int, tokens: int):
    """Cells of the tuning rows, against counts without them."""

    def histogram(table: pa.Table, answers: pa.Table) -> pa.Table:
        words, pairs, offsets = _tokens(table)
        tune = np.repeat(table["fold"].to_numpy() > 1, np.diff(offsets))
        cells, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        if tune.any():
            found = []
            # Only tuning tokens are looked up, and the contexts of their pairs with them: whole documents tune or do not.
            own = np.concatenate([[0], np.cumsum(np.diff(offsets)[table["fold"].to_numpy() > 1])])
            for order, values in ((1, words), (2, pairs)):
                distinct = np.unique(values)
                train, tuned = _answers(distinct, answers, order, ("train", "tune"), n_owners)
                found.append((train - tuned)[np.searchsorted(distinct, values[tune])])
            bucket, pair, word = _estimates(own, *found, tokens)
            cells = (bucket * LEVELS + _levels(pair)) * LEVELS + _levels(word)
            cells, counts = np.unique(cells, return_counts=True)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(counts, pa.int64())})

    return histogram


def fit_weights(cells: np.ndarray, counts: np.ndarray, uniform: float, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights of pair, word and uniform share by bucket, by expectation-maximisation.

    A bucket without tuning tokens has the weights of the bucket below it; contexts never seen have no pair share.
    """
    bucket, pair, word = cells // LEVELS**2, cells // LEVELS % LEVELS, cells % LEVELS
    value = np.concatenate([[0.0], 0.5 ** (np.arange(LEVELS - 1) / STEPS)])
    p = np.stack([value[pair], value[word], np.full(len(cells), uniform)], axis=1)
    size = 65
    weights = np.full((size, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    for _ in range(rounds):
        share = weights[bucket] * p
        share *= (counts / share.sum(axis=1))[:, None]
        sums = np.stack([np.bincount(bucket, weights=share[:, k], minlength=size) for k in range(3)], axis=1)
        total = sums.sum(axis=1, keepdims=True)
        # Half a token for the uniform share keeps every word possible.
        new = (sums + [0, 0, 0.5]) / (total + 0.5)
        weights = np.where(total > 0, new, weights)
    seen = np.bincount(bucket, minlength=size) > 0
    for b in range(2, size):
        if not seen[b] and seen[1:b].any():
            weights[b] = weights[b - 1]
    return weights


def _score(n_owners: int, tokens: int, known: int, weights: np.ndarray):
    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        words, pairs, offsets = _tokens(table)
        found = []
        for order, values in ((1, words), (2, pairs)):
            distinct, place = _ranked(values)
            found.append(_answers(distinct, answers, order, ("train",), n_owners)[0][place])
        bucket, pair, word = _estimates(offsets, *found, tokens)
        w = weights[bucket]
        model = np.log10(w[:, 0] * pair + w[:, 1] * word + w[:, 2] / (known + 1)) if tokens else np.zeros(len(words))
        base = np.log10((found[0] + 1) / (tokens + known + 1))
        by_text = lambda x: pa.array(np.add.reduceat(x, offsets[:-1]) if len(offsets) > 1 else x)  # noqa: E731  no text is without a token
        return pa.table(
            {
                "doc_id": table["doc_id"].combine_chunks(),
                "held_out": pa.array(table["fold"].to_numpy() == 0),
                "n_tokens": pa.array(np.diff(offsets)),
                "n_known": by_text((found[0] > 0).astype(np.int64)),
                "train_tokens": pa.array([tokens] * table.num_rows, pa.int64()),
                "base_score": by_text(base),
                "score": by_text(model),
            }
        )

    return score


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_out: int = 2, tuning: int = 6) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Rows whose ``remainder`` of ``folds`` is ``held_out`` are scored only; of the others those with ``tuning`` fit the weights.
    """
    n = owners(df.sparkSession)
    chosen = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), remainder(id_col, folds).alias("fold_of_id"))
    table = parted(chosen, "text", "lm").select(
        "part",
        F.col("data.doc_id"),
        F.col("data.text"),
        F.when(F.col("data.fold_of_id") == held_out, 0).when(F.col("data.fold_of_id") == tuning, 2).otherwise(1).alias("fold"),
    )
    messages = table.groupBy("part").applyInArrow(_send(n), "owner int, part long, order int, hashes binary, train binary, tune binary")
    answers = written(
        messages.groupBy("owner", "order").applyInArrow(_add_up, "part long, owner int, order int, train binary, tune binary, sums array<long>"), "counts"
    )
    sums = answers.filter("order = 1 AND sums IS NOT NULL").select(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(4)]).first()
    tokens, rest_tokens, known, rest_known = (s or 0 for s in sums)
    both = table.groupBy("part").cogroup(answers.groupBy("part"))
    cells = both.applyInArrow(_histogram(n, rest_tokens), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    weights = fit_weights(np.array([c["cell"] for c in cells], np.int64), np.array([c["n"] for c in cells], np.float64), 1 / (rest_known + 1))
    return both.applyInArrow(
        _score(n, tokens, known, weights),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
