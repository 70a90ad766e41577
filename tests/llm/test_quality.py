"""The byte-level network against loops over bytes, numeric gradients, and the majority class on held-out rows."""

import numpy as np
import pytest

from roadmetrics.llm import quality


def score_by_loops(net, raw: bytes) -> float:
    codes = [b + 1 for b in raw]
    count = max(1, -(-len(codes) // quality.CHUNK))
    codes += [0] * (count * quality.CHUNK + quality.REACH - len(codes))
    rows = []
    for c in range(count):
        best = np.full(quality.FILTERS, -np.inf)
        for at in range(c * quality.CHUNK, (c + 1) * quality.CHUNK, 2):
            window = net.embed[codes[at : at + 2 * quality.PAIRS]].reshape(quality.PAIRS, -1)
            best = np.maximum(best, np.einsum("pe,pef->f", window, net.filters))
        rows.append(np.maximum(best + net.bias, 0))
    logit = np.concatenate([np.max(rows, 0), np.mean(rows, 0)]) @ net.out + net.prior[0]
    return float(1 / (1 + np.exp(-logit)))


@pytest.mark.parametrize("text", ["", "a", "x" * 511, "ab" * 256, "äöü " * 400, "The end. " * 3000])
def test_score_equals_loops_over_all_bytes(text):
    net = quality.ByteConvNet()
    net.out[:] = np.linspace(-0.3, 0.3, len(net.out))
    raw = text.encode()
    data = np.frombuffer(b"junk" + raw + b"more", np.uint8)
    codes, first = quality.chunks_of(data, np.array([0, 4, 4 + len(raw), 8 + len(raw)]))
    assert net.score(codes, first)[1] == pytest.approx(score_by_loops(net, raw), abs=1e-5)


def test_gradients_equal_differences():
    net, y, weight = quality.ByteConvNet(), np.array([1, 0], np.float32), np.array([0.5, 3], np.float32)
    net.out[:] = np.linspace(-0.3, 0.3, len(net.out))
    texts = [b"some words " * 80, b"OTHER!! " * 20]
    docs = [quality.chunks_of(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    first = np.array([0, len(docs[0])])

    def loss():
        p = net.score(np.concatenate(docs), first)
        return float((weight * -np.log(np.where(y == 1, p, 1 - p))).mean())

    net.embed, net.filters, net.out = (x.astype(np.float64) for x in (net.embed, net.filters, net.out))
    grads = net._gradients(docs, y, weight)
    for array, grad, at in ((net.out, grads[3], (5,)), (net.out, grads[3], (40,)), (net.filters, grads[1], (1, 3, 20)), (net.embed, grads[0], (ord("o") + 1, 2))):
        was, step = array[at], 1e-3
        array[at] = was + step
        up = loss()
        array[at] = was - step
        down = loss()
        array[at] = was
        assert grad[at] == pytest.approx((up - down) / (2 * step), abs=3e-3)


def test_beats_the_majority_on_held_out_rows(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    rows = quality.score_quality(read("documents"), read("labels")).join(read("labels"), "doc_id").filter("held_out").select("predicted", "quality").collect()
    right = lambda some: sum(r.predicted == r.quality for r in some) / len(some)
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert right(bad) >= 0.85 and right(good) >= 0.85
    assert right(rows) > max(len(good), len(bad)) / len(rows) + 0.05
    kept = quality.keep_good(read("documents"), read("labels"))
    assert kept.columns == read("documents").columns and 0.7 * read("documents").count() < kept.count() < 0.98 * read("documents").count()
