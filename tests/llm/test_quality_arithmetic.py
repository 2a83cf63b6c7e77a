"""The network's score and gradient against plain loops and finite differences."""

import math

import numpy as np
import pytest

from cartloom.llm import quality
from cartloom.llm.quality import CHUNK, FILTERS, STEP, WIDTH

TEXTS = [b"", b"a", bytes(range(256)) * 2, b"x" * CHUNK, b"word " * 130, "größe 漢字 ".encode() * 40]


def features(text, filters):
    """Mean and maximum over the chunks of tanh of each filter's best place."""
    chunks = []
    for start in range(0, max(1, len(text) - CHUNK + STEP), STEP):
        best = [-math.inf] * FILTERS
        for place in range(start, start + CHUNK):
            window = [text[i] if i < len(text) else 0 for i in range(place, place + WIDTH)]
            values = sum(filters[j][b] for j, b in enumerate(window))
            best = [max(a, v) for a, v in zip(best, values)]
        chunks.append([math.tanh(v) for v in best])
    return [sum(c[f] for c in chunks) / len(chunks) for f in range(FILTERS)] + [max(c[f] for c in chunks) for f in range(FILTERS)] + [1.0]


def probability(text, filters, out):
    return 1 / (1 + math.exp(-sum(x * w for x, w in zip(features(text, filters), out))))


@pytest.fixture
def network():
    found = quality.Network(seed=3)
    found.out = np.random.default_rng(4).standard_normal(2 * FILTERS + 1).astype(np.float32)
    return found


def test_scores_equal_plain_loops(network):
    for text in TEXTS:
        want = probability(text, network.filters.astype(float), network.out.astype(float))
        got = network.features(text)
        assert got == pytest.approx(features(text, network.filters.astype(float)), abs=1e-5)
        assert 1 / (1 + math.exp(-got @ network.out)) == pytest.approx(want, abs=1e-5)
    assert network.score("größe 漢字 " * 40) == pytest.approx(probability(TEXTS[-1], network.filters.astype(float), network.out.astype(float)), abs=1e-5)
    assert network.score(None) == network.score("")


@pytest.mark.parametrize("good", [0.0, 1.0])
def test_gradients_equal_finite_differences(network, good):
    text, step = "größe der 漢字 und mehr ".encode() * 14, 1e-4
    assert len(quality.chunk_starts(len(text))) > 1
    d_filters, d_out = np.zeros_like(network.filters), np.zeros_like(network.out)
    network._gradient(text, good, 0.5, d_filters, d_out)
    filters, out = network.filters.astype(float), network.out.astype(float)

    def loss():
        p = probability(text, filters, out)
        return -0.5 * math.log(p if good else 1 - p)

    def slope(array, at):
        kept = array[at]
        array[at] = kept + step
        above = loss()
        array[at] = kept - step
        below = loss()
        array[at] = kept
        return (above - below) / (2 * step)

    for at in (0, FILTERS - 1, FILTERS, 2 * FILTERS):
        assert d_out[at] == pytest.approx(slope(out, at), rel=1e-2, abs=1e-5)
    moved = np.argwhere(d_filters)
    assert len(moved) >= FILTERS
    for j, b, f in [tuple(x) for x in moved[:: max(1, len(moved) // 6)]] + [(0, 255, 0)]:
        assert d_filters[j, b, f] == pytest.approx(slope(filters, (j, b, f)), rel=1e-2, abs=1e-5)
