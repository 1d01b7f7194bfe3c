"""Quality classifier: averaged hashed word and character n-gram vectors, softmax, numpy SGD."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_ import Words, bucket, gram_spans, grams, text_blocks
from .common import pick

BITS = 15
GRAMS = (3, 4, 5)
#: A word's shape is how many words back it last occurred, up to this; 0 if further.
BACK = 8
KINDS = 2 + len(GRAMS)
DIMENSIONS = 10
#: Labelled rows that the model learns from at most, chosen by a hash of the id.
MAX_TRAIN = 4000


class _Features:
    """Words, pairs of word shapes, and character n-grams.

    A shape abstracts a word n-gram to where it repeats a word, so "a a a"
    and "b b b" have a feature in common. A text's vector is the mean over
    the kinds of the mean of their features.
    """

    def __init__(self):
        self.words = Words(lower=False)

    def parts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Buckets of all features of one kind, with each text's first and last + 1."""
        hashes, upto = self.words(data, offsets)
        yield bucket(hashes, BITS, 1), upto[:-1], upto[1:]
        place = np.arange(len(hashes)) - np.repeat(upto[:-1], np.diff(upto))
        shape = np.zeros(len(hashes), dtype=np.uint64)
        for back in range(min(BACK, len(hashes) - 1), 0, -1):
            shape[back:][(hashes[back:] == hashes[:-back]) & (place[back:] >= back)] = back
        pair = shape * np.uint64(BACK + 1)
        pair[1:] += np.where(place[1:] > 0, shape[:-1], 0).astype(np.uint64)
        yield bucket(pair, BITS, 2), upto[:-1], upto[1:]
        for n in GRAMS:
            yield bucket(grams(data, n), BITS, n), *gram_spans(offsets, n)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, buckets, weights) of each row of (text, label)."""
    features = _Features()
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(0)):
            parts = [(b.astype(np.uint16), s, e) for b, s, e in features.parts(data, offsets)]
            idx, weight = [], []
            for i in range(hi - lo):
                mine = [b[min(s[i], len(b)) : e[i]] for b, s, e in parts]
                u, where = np.unique(np.concatenate(mine), return_inverse=True)
                w = np.concatenate([np.full(len(m), 1 / max(len(m), 1) / KINDS) for m in mine])
                idx.append(u.tobytes())
                weight.append(np.bincount(where, w, minlength=len(u)).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(lo, hi - lo).cast(pa.int32()), pa.array(idx, type=pa.binary()), pa.array(weight, type=pa.binary())],
                names=["label", "idx", "weight"],
            )


def train(bags: list[tuple[int, bytes, bytes]], epochs: int = 10, rate: float = 0.5, seed: int = 0) -> tuple[np.ndarray, float]:
    """Value of each bucket and a bias: the log odds of label 1 are bias + the mean over kinds of the mean value of features.

    Learns an embedding per bucket and a softmax layer by stochastic gradient
    descent, a document at a time at a falling rate, then folds the layer
    into the embeddings: averaging is linear, so scoring needs one number per
    feature. With one class only (or none) every score is its smoothed share.
    """
    rng = np.random.default_rng(seed)
    labels = np.array([b[0] for b in bags], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1.0) / (len(labels) + 2.0) if len(labels) else 0.5
        return np.zeros(1 << BITS, dtype=np.float32), float(np.log(share / (1 - share)))
    idx = [np.frombuffer(b[1], dtype=np.uint16) for b in bags]
    share = [np.frombuffer(b[2], dtype=np.float32) for b in bags]
    norms = [max(float(np.linalg.norm(x)), 1e-6) for x in share]
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    step, steps = 0, epochs * len(bags)
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            lr = np.float32(rate * (1 - step / steps))
            step += 1
            hidden = share[i] @ vectors[idx[i]]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= lr * np.outer(hidden, p)
            bias -= lr * np.float32(0.1) * p
            # a document's features share its gradient; divided by their norm, a long document's many move too
            vectors[idx[i]] -= (lr / norms[i]) * share[i][:, None] * back
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value of each bucket, bias) of the model that all bags train, in whatever order they come."""
    bags = sorted(bag for batch in batches for bag in zip(*(c.to_pylist() for c in batch.columns)))
    values, bias = train(bags)
    yield pa.RecordBatch.from_arrays([pa.array([values.astype(np.float32).tobytes()]), pa.array([bias])], names=["value", "bias"])


def fit(docs: DataFrame, labels: DataFrame, learn: str, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Model from the labelled rows for which the SQL condition ``learn`` on ``id`` holds.

    Of these, the ``max_train`` ids with the smallest hash are used; an id
    with several labels counts as 1 if any is. Null ids and labels are left out.
    A task trains it: the driver gets the model, never the rows' features.
    """
    known = pick(labels, id=id_col, label=label_col).filter("id is not null and label is not null")
    known = known.groupBy("id").agg(F.max("label").cast("int").alias("label")).filter(learn)
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_train)
    rows = chosen.collect()  # max_train ids and labels
    if not rows:
        return train([])
    small = docs.sparkSession.createDataFrame(rows, chosen.schema)
    joined = pick(docs, id=id_col, text=text_col).join(F.broadcast(small), "id").select("text", "label")
    bags = joined.mapInArrow(_bags, "label int, idx binary, weight binary")
    found = bags.repartition(1).mapInArrow(_learned, "value binary, bias double").first()  # max_train rows meet in a task
    return (np.frombuffer(bytes(found["value"]), dtype=np.float32), found["bias"]) if found else train([])


def _scores(features: _Features, texts: pa.Array, values: np.ndarray, bias: float) -> np.ndarray:
    out = np.zeros(len(texts))
    for lo, hi, data, offsets in text_blocks(texts):
        for buckets, first, last in features.parts(data, offsets):
            upto = np.concatenate([[0.0], np.cumsum(values[buckets], dtype=np.float64)])
            first = np.minimum(first, len(buckets))
            last = np.maximum(np.minimum(last, len(buckets)), first)
            out[lo:hi] += (upto[last] - upto[first]) / np.maximum(last - first, 1) / KINDS
    return 1 / (1 + np.exp(-np.clip(out + bias, -500, 500)))


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; the score of label 1 is 0 to 1.

    Null and empty texts have no features and score by the bias alone. Whole
    texts are scored, in blocks of about a megabyte.
    """
    values, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features()
        for batch in batches:
            scores = _scores(features, batch.column(1), values, bias)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    rows = pick(docs, id=id_col, text=text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`classify` predicts as 1, with all their columns, in one pass."""
    values, bias = fit(docs, labels, f"crc32(cast(id as string)) % {folds} != {held_out}")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features()
        for batch in batches:
            yield batch.filter(pa.array(_scores(features, batch.column(at), values, bias) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Learns only from ids whose crc32 (of the id as text) modulo ``folds`` is
    not ``held_out``; rows with a null id are not held out and never learned
    from. ``predicted`` is 1 from ``threshold`` up.
    """
    model = fit(docs, labels, f"crc32(cast(id as string)) % {folds} != {held_out}")
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    return score(docs, model).select(
        "doc_id",
        F.coalesce(fold == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
