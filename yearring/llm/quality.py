"""Quality classifier: a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes slide over the whole text.  A filter is a table of weights by place and byte, so it
is applied by looking bytes up.  Windows are pooled in chunks of ``CHUNK`` starts (chunks overlap by ``WIDTH - 1`` bytes, so
every window is in one): the maximum of each filter in a chunk, then its maximum and its mean over the document's chunks.
A logistic unit combines these into one probability.

Training takes a bounded sample of the labelled rows: ``PER_CLASS`` of each label, in the order of a hash of the id, as far as
``SAMPLE_BYTES`` of text reach; both bounds hold at any input size.  It runs on the driver, in a fixed order with a fixed
seed.  Scoring runs in the tasks, on whole texts.

Null and empty texts are scored as one window of padding.  A label table without both classes gives a model that
answers 0.5.  Rows repeated in the documents are scored alike; labels repeated for an id count once; null labels are left out.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearring.llm.lm_scoring import remainder
from yearring.llm.parts import texts_of

WIDTH = 8
FILTERS = 16
CHUNK = 256
PER_CLASS = 1_500
SAMPLE_BYTES = 24 << 20
EPOCHS = 6
THRESHOLD = 0.3


class ByteCNN:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        # Byte 256 is the padding.
        self.table = rng.normal(0, 0.25, (WIDTH, 257, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.weights = rng.normal(0, 0.2, 2 * FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)
        self.trained = False

    @staticmethod
    def padded(text: bytes) -> np.ndarray:
        codes = np.full(max(len(text), 1) + WIDTH - 1, 256, np.int16)
        codes[: len(text)] = np.frombuffer(text, np.uint8)
        return codes

    def pooled(self, text: bytes, places: bool = False):
        """Each chunk's maxima, and if asked for, the windows where they are."""
        codes = self.padded(text)
        n = len(codes) - WIDTH + 1
        starts = np.arange(0, n, CHUNK)
        tops, at = np.empty((len(starts), FILTERS), np.float32), []
        block = 64 * CHUNK  # windows at a time, so that a long text needs no more memory
        for a in range(0, n, block):
            b = min(n, a + block)
            out = self.table[0][codes[a:b]]
            for j in range(1, WIDTH):
                out += self.table[j][codes[a + j : b + j]]
            cuts = starts[a // CHUNK : -(-b // CHUNK)] - a
            tops[a // CHUNK : a // CHUNK + len(cuts)] = np.maximum.reduceat(out, cuts)
            if places:
                ends = np.append(cuts[1:], b - a)
                at += [out[c:d].argmax(axis=0) + c + a for c, d in zip(cuts, ends)]
        hidden = np.maximum(tops + self.bias, 0)
        return (hidden, codes, np.array(at)) if places else hidden

    @staticmethod
    def combined(hidden: np.ndarray) -> np.ndarray:
        return np.concatenate([hidden.max(axis=0), hidden.mean(axis=0)])

    def score(self, text: bytes) -> float:
        if not self.trained:
            return 0.5
        z = float(self.combined(self.pooled(text)) @ self.weights + self.shift[0])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def train(self, texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = 7, rate: float = 0.02, batch: int = 16) -> None:
        """Adam on the log loss, classes weighed alike; gradients pass through the places of the maxima only."""
        y = np.array(labels, np.float32)
        if len(set(labels)) < 2:
            return
        share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        params = [self.table, self.bias, self.weights, self.shift]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        rng, step = np.random.default_rng(seed), 0
        for epoch in range(epochs):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), batch):
                grads = [np.zeros_like(p) for p in params]
                some = order[a : a + batch]
                for i in some:
                    hidden, codes, at = self.pooled(texts[i], places=True)
                    features = self.combined(hidden)
                    z = float(features @ self.weights + self.shift[0])
                    error = np.float32((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) * share[i] / len(some))
                    grads[2] += error * features
                    grads[3] += error
                    down = np.repeat(error * self.weights[None, FILTERS:] / len(hidden), len(hidden), axis=0)
                    down[hidden.argmax(axis=0), np.arange(FILTERS)] += error * self.weights[:FILTERS]
                    down *= hidden > 0
                    grads[1] += down.sum(axis=0)
                    filters = np.broadcast_to(np.arange(FILTERS), at.shape)
                    for j in range(WIDTH):
                        np.add.at(grads[0][j], (codes[at + j], filters), down)
                grads[2] += 1e-4 * self.weights
                step += 1
                speed = rate * (1 - 0.8 * epoch / epochs)
                for p, g, (m, v) in zip(params, grads, moments):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        self.trained = True


def sample(df: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str, per_class: int, max_bytes: int):
    """Texts and labels of at most ``per_class`` rows of each class and ``max_bytes`` altogether, half of them for each class.

    Labels of ids without a row are left out first.  A text that does not fit is passed over.  If this leaves a class without texts, there is nothing to learn from, which is an error.
    """
    known = labels.filter(learn).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).filter("id IS NOT NULL")
    # Only labels of rows that are here: others would take the places of the sample and leave nothing to learn from.
    here = df.select(F.col(id_col).cast("long").alias("id"))
    one = known.filter("y IN (0, 1)").groupBy("id").agg(F.min("y").alias("y")).join(here, "id", "left_semi")
    order = F.xxhash64("id", F.lit(1))
    chosen = [one.filter(F.col("y") == y).orderBy(order, "id").limit(per_class) for y in (0, 1)]
    ids = chosen[0].union(chosen[1])
    # At most 2 * per_class ids, so the broadcast has a fixed bound.
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(ids), "id").select("id", "y", "text", F.octet_length("text").alias("size"))
    sizes = found.groupBy("id", "y").agg(F.max("size").alias("size")).orderBy(F.xxhash64("id", F.lit(1)), "id").collect()
    small, room = {0: [], 1: []}, {0: max_bytes // 2, 1: max_bytes // 2}
    for r in sizes:
        if r["size"] <= room[r["y"]]:
            room[r["y"]] -= r["size"]
            small[r["y"]].append(r["id"])
    for y in {r["y"] for r in sizes}:
        if not small[y]:
            raise ValueError(f"no text of class {y} fits into {max_bytes // 2} bytes, so the classifier can't be trained")
    if not small[0] or not small[1]:
        warnings.warn("no labelled rows of both classes: the classifier stays untrained and scores every text 0.5", stacklevel=2)
    small = small[0] + small[1]
    if not small:
        return [], []
    rows = found.filter(F.col("id").isin(small)).groupBy("id").agg(F.min(F.struct("text", "y")).alias("r")).select("id", "r.text", "r.y")
    rows = sorted(rows.collect(), key=lambda r: r["id"])
    return [r["text"].encode() for r in rows], [r["y"] for r in rows]


def fit(
    df: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = PER_CLASS,
    max_bytes: int = SAMPLE_BYTES,
) -> ByteCNN:
    """A network trained on the labels of rows for which ``learn`` holds."""
    model = ByteCNN()
    model.train(*sample(df, labels, learn, id_col, text_col, label_col, per_class, max_bytes))
    return model


def scored(df: DataFrame, model: ByteCNN, text_col: str = "text") -> DataFrame:
    """``data`` (all columns of ``df``) and ``score``."""
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("data"))

    def each(batches):
        for batch in batches:
            scores = [model.score(t) for t in texts_of(batch.column(0).field(text_col))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["data", "score"])

    schema = T.StructType([*packed.schema.fields, T.StructField("score", T.DoubleType())])
    return packed.mapInArrow(each, schema)


def quality_scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; labels of rows with remainder 0 of ``folds`` are never read."""
    held_out = remainder(id_col, folds) == 0
    model = fit(df, labels, ~held_out, id_col, text_col)
    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return scored(narrow, model).select(
        F.col("data.doc_id"), (remainder("data.doc_id", folds) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that are not rejected, with its own columns."""
    model = fit(df, labels, remainder(id_col, folds) != 0, id_col, text_col)
    good = scored(df, model, text_col).filter(F.col("score") >= threshold)
    return good.select(*[F.col("data").getField(c).alias(c) for c in df.columns])
