"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters of eight bytes run with a stride of two over chunks of 512 bytes that overlap by a
filter's reach and together cover the whole document. Each chunk's activations are max-pooled; a document's chunks are
combined by maximum and mean, and one logistic unit turns that into a probability. The network is fitted on the driver
on a bounded sample of labelled rows (``sample_rows`` of at most 64 kB each) and sent to the executors (about 40 kB).
The two classes weigh the same in the loss, so that a rare class is not outvoted, and a small sample is read as often as
it takes for ``least_steps`` steps.

Edge cases: null text is empty; an empty text is one chunk of padding and gets a score like any other; ties and
repeated rows are scored alike; without labelled rows every score is 0.5; an empty table gives an empty result; columns
of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, no_clash, remainder, steps, utf8_bytes

CHUNK, REACH, PAIRS, EMBED, FILTERS = 512, 6, 4, 8, 24


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All chunks as rows of CHUNK + REACH byte codes (byte + 1; 0 is padding), and the first chunk of each document."""
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-lengths // CHUNK))
    first = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(lengths)), counts)
    start = offsets[doc] + (np.arange(first[-1]) - first[doc]) * CHUNK
    at = start[:, None] + np.arange(CHUNK + REACH)
    inside = at < offsets[doc + 1][:, None]
    codes = np.zeros(at.shape, np.int16)
    codes[inside] = data[at[inside]].astype(np.int16) + 1
    return codes, first[:-1]


class ByteConvNet:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (257, EMBED)).astype(np.float32)
        self.embed[0] = 0
        self.filters = rng.normal(0, 0.25, (PAIRS, 2 * EMBED, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(2 * FILTERS, np.float32)
        self.prior = np.zeros(1, np.float32)

    def activations(self, codes: np.ndarray) -> np.ndarray:
        pairs = self.embed[codes].reshape(len(codes), (CHUNK + REACH) // 2, 2 * EMBED)
        n = CHUNK // 2
        y = pairs[:, :n] @ self.filters[0]
        for j in range(1, PAIRS):
            y += pairs[:, j : j + n] @ self.filters[j]
        return y

    def features(self, pooled: np.ndarray, first: np.ndarray) -> np.ndarray:
        counts = np.diff(np.append(first, len(pooled)))[:, None]
        return np.concatenate([np.maximum.reduceat(pooled, first), np.add.reduceat(pooled, first) / counts], axis=1)

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(codes), FILTERS), np.float32)
        for lo in range(0, len(codes), 256):
            out[lo : lo + 256] = self.activations(codes[lo : lo + 256]).max(1)
        return np.maximum(out + self.bias, 0)

    def score(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        logit = self.features(self.pooled(codes), first).astype(np.float64) @ self.out + self.prior[0]
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))

    def fit(self, texts: list[str], labels: list[int], epochs: int = 12, batch: int = 64, rate: float = 0.01, least_steps: int = 200, seed: int = 7) -> ByteConvNet:
        docs = []
        for text in texts:
            raw = np.frombuffer(text.encode(), np.uint8)
            docs.append(chunks_of(raw, np.array([0, len(raw)]))[0])
        y = np.array(labels, np.float32)
        if not len(docs):
            return self
        rng = np.random.default_rng(seed)
        classes = [np.flatnonzero(y == c) for c in (0, 1)]
        weight = np.array([len(y) / (2 * max(1, len(c))) for c in classes], np.float32)[y.astype(int)]
        params = [self.embed, self.filters, self.bias, self.out, self.prior]
        mean, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        batches = -(-len(docs) // batch)
        epochs = max(epochs, -(-least_steps // batches))
        total = epochs * batches
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for lo in range(0, len(order), batch):
                pick = order[lo : lo + batch]
                grads = self._gradients([docs[i] for i in pick], y[pick], weight[pick])
                step += 1
                lr = rate * (1 - step / (total + 1))
                for p, g, m, v in zip(params, grads, mean, square):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
                self.embed[0] = 0
        return self

    def _gradients(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        codes = np.concatenate(docs)
        counts = np.array([len(d) for d in docs])
        first = np.cumsum(counts) - counts
        top, at = np.empty((len(codes), FILTERS), np.float32), np.empty((len(codes), FILTERS), np.int64)
        for lo in range(0, len(codes), 256):
            act = self.activations(codes[lo : lo + 256])
            at[lo : lo + 256] = act.argmax(1)
            top[lo : lo + 256] = np.take_along_axis(act, at[lo : lo + 256, None, :], 1)[:, 0]
        pooled = np.maximum(top + self.bias, 0)
        feats = self.features(pooled, first)
        p = 1 / (1 + np.exp(-np.clip(feats @ self.out + self.prior[0], -30, 30)))
        err = weight * (p - y) / len(y)
        g_out, g_prior = feats.T @ err + 1e-4 * self.out, np.array([err.sum()], np.float32)
        g_feat = err[:, None] * self.out
        doc = np.repeat(np.arange(len(docs)), counts)
        g_pool = (g_feat[:, FILTERS:] / counts[:, None])[doc]
        largest = pooled == feats[:, :FILTERS][doc]
        share = np.add.reduceat(largest.astype(np.float32), first)
        g_pool = (g_pool + largest * (g_feat[:, :FILTERS] / np.maximum(share, 1))[doc]) * (pooled > 0)
        g_bias = g_pool.sum(0)
        # Only the position that won the pooling passes a gradient on to its eight bytes.
        where = 2 * at[:, :, None] + np.arange(2 * PAIRS)
        seen = codes[np.arange(len(codes))[:, None, None], where]
        window = self.embed[seen].reshape(len(codes), FILTERS, PAIRS, 2 * EMBED)
        g_filters = np.einsum("cf,cfpe->pef", g_pool, window, optimize=True)
        g_window = (g_pool[:, :, None, None] * self.filters.transpose(2, 0, 1)[None]).reshape(len(codes), FILTERS, 2 * PAIRS, EMBED)
        g_embed = np.zeros_like(self.embed)
        flat, g_flat = seen.ravel(), g_window.reshape(-1, EMBED)
        for e in range(EMBED):
            g_embed[:, e] = np.bincount(flat, g_flat[:, e], minlength=257)
        return [g_embed, g_filters.astype(np.float32), g_bias, g_out.astype(np.float32), g_prior]


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 2_500) -> ByteConvNet:
    sample = labelled_sample(docs, labels, label, sample_rows)
    return ByteConvNet().fit([t for t, _ in sample], [y for _, y in sample])


def _score(net: ByteConvNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step_bytes=1 << 20):
            codes, first = chunks_of(*utf8_bytes(batch.column("text")))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(net.score(codes, first))})

    return run


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 2_500) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    net = fit_quality(docs, labels, sample_rows=sample_rows)
    scored = no_clash(docs, "doc_id", "text").mapInArrow(_score(net), "doc_id bigint, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _keep(net: ByteConvNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step_bytes=1 << 20):
            codes, first = chunks_of(*utf8_bytes(batch.column("text")))
            yield batch.filter(pa.array(net.score(codes, first) >= 0.5))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = 2_500) -> DataFrame:
    """The rows of docs whose score is at least 0.5, with all their columns."""
    return docs.mapInArrow(_keep(fit_quality(docs, labels, sample_rows=sample_rows)), docs.schema)
