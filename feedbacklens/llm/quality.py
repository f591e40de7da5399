"""Quality by attention-based multiple-instance learning.

A document is a bag of passages.  Each passage is encoded as numbers (which kinds of
bytes follow each other, how its words repeat), mapped to a short vector, and given a
weight by gated attention, ``softmax(w . (tanh(V h) * sigmoid(U h)))``.  Only documents
have labels; attention learns which passages decide.  The weighted mean is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .columns import column, others
from .labelled import fold, training_rows
from .word_hash import runs, words

#: Passages are this long, or longer where a document would have more than ``MOST``.
PASSAGE_BYTES, MOST = 1000, 64
KINDS, STYLE = 16, 8
FEATURES = KINDS * KINDS + STYLE
HIDDEN, GATE = 24, 12
#: Labelled documents the classifier is fitted on, those with the smallest hashed keys.
TRAIN_DOCS = 6000
EPOCHS, BATCH, RATE, SEED = 12, 64, 0.01, 11


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[:32] = 1
    kind[9] = kind[10] = kind[13] = 2
    kind[32] = 3
    kind[97:123] = 4
    kind[[ord(c) for c in "aeiou"]] = 5
    kind[65:91] = 6
    kind[48:58] = 7
    kind[[ord(c) for c in ".,;:"]] = 8
    kind[[ord(c) for c in "!?"]] = 9
    kind[[ord(c) for c in "'\"()[]{}"]] = 10
    kind[[ord(c) for c in "|/\\_-"]] = 11
    kind[[ord(c) for c in "#$%&*+@<=>^`~"]] = 12
    kind[128:192] = 13
    kind[192:] = 14
    return kind


_KIND = _kinds()


def encode_passages(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of ``(features, doc)``: one row per passage, every byte in one passage.

    A document has at least one passage, an empty one if it has no text.
    """
    for data, ends in runs(texts):
        starts = np.concatenate([[0], ends[:-1]])
        sizes = ends - starts
        long = np.maximum(PASSAGE_BYTES, -(-sizes // MOST))
        count = -(-sizes // long)
        first = np.cumsum(count) - count
        place = np.arange(len(data)) - np.repeat(starts, sizes)
        passage = np.repeat(first, sizes) + place // np.repeat(long, sizes)
        total = int(count.sum())
        kind = _KIND[data].astype(np.int64)
        inside = place[1:] > 0  # a pair of bytes of one document
        cell = (passage[1:] * KINDS + kind[:-1]) * KINDS + kind[1:]
        pairs = np.bincount(cell[inside], minlength=total * KINDS * KINDS).reshape(total, -1)
        style = np.zeros((total, STYLE))
        found = words(data, ends)
        if len(found.key):
            at = passage[found.start]
            n = np.bincount(at, minlength=total)
            same = np.diff(at, prepend=-1) == 0
            for column, back in enumerate((1, 2, 3)):
                echo = np.zeros(len(at), bool)
                echo[back:] = (found.key[back:] == found.key[:-back]) & (at[back:] == at[:-back])
                style[:, column] = np.bincount(at[echo], minlength=total) / np.maximum(n, 1)
            order = np.lexsort((found.key, at))
            fresh = np.ones(len(at), bool)
            fresh[1:] = (np.diff(at[order]) != 0) | (found.key[order][1:] != found.key[order][:-1])
            style[:, 3] = np.bincount(at[order][fresh], minlength=total) / np.maximum(n, 1)
            style[:, 4] = np.log1p(n) / 5
            style[:, 5] = np.bincount(at, found.size, minlength=total) / np.maximum(n, 1) / 10
            style[:, 6] = np.bincount(at[same], minlength=total) / np.maximum(n, 1)
        style[:, 7] = np.log1p(np.repeat(sizes, count)) / 10
        share = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
        yield np.hstack([share, style]).astype(np.float32), np.repeat(np.arange(len(ends)), count)


class Attention:
    """Parameters of the network, its forward pass and one step of learning."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        random = np.random.default_rng(SEED)
        self.mean, self.spread = mean, spread
        draw = lambda *shape: random.normal(0, shape[0] ** -0.5, shape)
        self.p = {"W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE),
                  "U": draw(HIDDEN, GATE), "w": draw(GATE), "c": draw(HIDDEN), "d": np.zeros(1)}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    def forward(self, x: np.ndarray, doc: np.ndarray, docs: int) -> dict:
        p = self.p
        x = (x - self.mean) / self.spread
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (v * u) @ p["w"]
        top = np.full(docs, -np.inf)
        np.maximum.at(top, doc, e)
        a = np.exp(e - top[doc])
        a /= np.bincount(doc, a, minlength=docs)[doc]
        z = np.zeros((docs, HIDDEN))
        np.add.at(z, doc, a[:, None] * h)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"][0], -30, 30)))
        return {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "score": score}

    def learn(self, x: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        p, f = self.p, self.forward(x, doc, len(y))
        g = weight * (f["score"] - y) / len(y)
        dz = g[:, None] * p["c"]
        da = (f["h"] * dz[doc]).sum(axis=1)
        mean = np.bincount(doc, f["a"] * da, minlength=len(y))
        de = f["a"] * (da - mean[doc])
        dv, du = de[:, None] * p["w"] * f["u"], de[:, None] * p["w"] * f["v"]
        dv, du = dv * (1 - f["v"] ** 2), du * f["u"] * (1 - f["u"])
        dh = f["a"][:, None] * dz[doc] + dv @ p["V"].T + du @ p["U"].T
        dx = dh * (1 - f["h"] ** 2)
        grads = {"W": f["x"].T @ dx, "b": dx.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
                 "w": (f["v"] * f["u"]).T @ de, "c": f["z"].T @ g, "d": np.array([g.sum()])}
        self.t += 1
        for k, grad in grads.items():
            grad = grad + 1e-4 * p[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * grad
            self.v[k] = 0.999 * self.v[k] + 0.001 * grad ** 2
            p[k] -= RATE * (self.m[k] / (1 - 0.9 ** self.t)) / (
                np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)


def fit(features: np.ndarray, bag: np.ndarray, truth: np.ndarray) -> Attention:
    """Train on bags: ``bag`` is the (sorted) position of each passage's document."""
    net = Attention(features.mean(axis=0), features.std(axis=0) + 0.02)
    random = np.random.default_rng(SEED)
    first = np.searchsorted(bag, np.arange(len(truth) + 1))
    share = np.clip(truth.mean(), 0.05, 0.95)
    weight = np.where(truth > 0, 0.5 / share, 0.5 / (1 - share))
    for _ in range(max(EPOCHS, -(-EPOCHS * 1000 // max(len(truth), 1))) if len(set(truth)) > 1 else 0):
        order = random.permutation(len(truth))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
            net.learn(features[rows], np.repeat(np.arange(len(some)), first[some + 1] - first[some]),
                      truth[some].astype(float), weight[some])
    return net


def score_texts(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
                label: str = "quality", threshold: float = 0.5, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Add ``held_out, score, predicted`` to every row (same-named columns are replaced).

    The network is fitted on the labelled rows outside fold 1 of at most ``train_docs``
    keys (of at most twice as many rows, if keys are repeated); every text is scored whole, over all its passages.  Null and empty texts are one empty
    passage.  Rows without a label, repeated rows and null keys are scored like any
    other.  Without labels of both classes the scores carry no information but stay
    between 0 and 1; an empty table stays empty.
    """
    spark = docs.sparkSession

    def bags(batches):
        for batch in batches:
            truth, at = batch.column("label").to_numpy(), 0
            for features, doc in encode_passages(batch.column("text")):
                n = int(doc[-1]) + 1
                cuts = np.searchsorted(doc, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array([features[cuts[i]:cuts[i + 1]].tobytes() for i in range(n)], pa.binary()),
                    pa.array(truth[at:at + n].astype(np.int32))], names=["bag", "label"])
                at += n

    train = training_rows(docs, labels, label, key, text)
    # the keys are chosen before any text is read
    chosen = train.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(train_docs)
    sample = (train.join(F.broadcast(chosen), "key").select("label", "text")
              .mapInArrow(bags, "bag binary, label int").limit(2 * train_docs).toArrow())
    parts = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in sample.column("bag").to_pylist()]
    truth = (sample.column("label").to_numpy() > 0).astype(int)
    order = sorted(range(len(parts)), key=lambda i: (len(parts[i]), parts[i].tobytes()))  # same at every run
    parts, truth = [parts[i] for i in order], truth[order]
    features = np.concatenate(parts) if parts else np.zeros((1, FEATURES), np.float32)
    bag = np.repeat(np.arange(len(parts)), [len(p) for p in parts]) if parts else np.zeros(0, int)
    net = fit(features, bag, truth)
    net.m = net.v = {}
    shared = spark.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = [shared.value.forward(features, doc, int(doc[-1]) + 1)["score"]
                 for features, doc in encode_passages(texts)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    names = ["held_out", "score", "predicted"]
    scored = docs.select(*others(docs, *names), (fold(column(key)) == 1).alias("held_out"),
                         score(column(text)).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
