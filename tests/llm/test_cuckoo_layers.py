import numpy as np
import pytest

from cartloom.llm.cuckoo import CuckooFilter


def keys_of(seed, n, prints=2**62, places=2**30):
    """Distinct keys; few prints and places give many equal fingerprints."""
    draw = np.random.default_rng(seed)
    words = np.column_stack([draw.integers(0, places, 3 * n) << 32, draw.integers(0, prints, 3 * n)]).astype(np.uint64)
    words[:, 0] |= np.arange(3 * n, dtype=np.uint64)
    return words[:n]


def fill(keys, sizes):
    held = CuckooFilter()
    for part in np.split(keys, np.cumsum(sizes)):
        held.insert(part)
    return held


@pytest.mark.parametrize("seed, n, batch, prints, places", [
    (1, 500_000, 10_000, 2**62, 2**30), (2, 60_000, 1_000, 2000, 2**30), (3, 20_000, 100, 500, 2**30), (4, 3_000, 10, 40, 2**12)])
def test_held_keys_are_found_after_deletions(seed, n, batch, prints, places):
    keys = keys_of(seed, n, prints, places)
    draw = np.random.default_rng(seed)
    held = fill(keys, np.full(n // batch - 1, batch))
    assert len(held.layers) > 2
    left = np.ones(n, bool)
    for _ in range(3):
        gone = np.flatnonzero(left)
        gone = draw.choice(gone, len(gone) // 3, replace=False)
        held.delete(keys[gone])
        left[gone] = False
        assert held.contains(keys[left]).all()
        back = draw.choice(np.flatnonzero(~left), len(gone) // 4, replace=False)
        held.insert(keys[back])
        left[back] = True
        held = CuckooFilter.from_bytes(held.to_bytes())
        assert held.contains(keys[left]).all()


def test_all_deleted_leave_nothing():
    keys = keys_of(5, 100_000)
    held = fill(keys, [5_000] * 19)
    for part in np.array_split(np.random.default_rng(5).permutation(keys), 7):
        held.delete(part)
    assert len(held.layers) > 2 and not any(layer.table.any() or layer.held for layer in held.layers)


def test_a_small_full_first_layer_loses_no_key():
    keys = keys_of(6, 400_000)
    held = fill(keys, [50, 400, 9_000])
    held.delete(keys[200_000:])
    assert held.contains(keys[:200_000]).all()
    held.delete(keys[:50])
    assert held.contains(keys[50:200_000]).all()
    CuckooFilter().delete(keys)
    held.delete(keys[:0])
    held.insert(keys[:0])
    assert held.contains(keys[50:200_000]).all()
