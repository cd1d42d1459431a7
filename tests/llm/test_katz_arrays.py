"""The arrays of the Katz model's rows and the orders in which k-grams are sent."""

import numpy as np
import pytest

from barpath.llm.katz import APART, _gram_order, _keys, in_order, pack, unpack


@pytest.mark.parametrize("n", [0, 1, APART - 1, APART, 5 * APART])
def test_arrays_come_back(n):
    r = np.random.default_rng(n)
    arrays = [r.integers(0, 1 << 40, n), np.zeros(n, np.int64), r.random(n), r.integers(0, 2, n).astype(np.uint8)]
    back = unpack(pack(*arrays), "<i8", "<i8", "<f8", "u1")
    assert all(np.array_equal(a, b) and a.dtype == b.dtype for a, b in zip(arrays, back, strict=True))


@pytest.mark.parametrize("k", [2, 3, 4])
@pytest.mark.parametrize("top", [1, 3, 1 << 17, 1 << 30])
def test_orders_are_those_of_a_plain_sort(k, top):
    columns = [np.random.default_rng(j).integers(0, top, 3000) for j in range(k)]
    expected = sorted(range(3000), key=lambda i: ([int(columns[j][i]) for j in range(k - 2, -1, -1)], int(columns[-1][i])))
    assert _gram_order(columns).tolist() == expected
    assert in_order(columns[-1], *columns[:-1]).tolist() == expected


def test_keys_sort_as_the_numbers_do():
    columns = np.array([[0, 0], [0, 1], [1, 0], [255, 3], [256, 0], [1 << 40, 2]])
    keys = _keys(columns)
    assert (np.sort(keys) == keys).all() and len(np.unique(keys)) == len(columns)
    assert in_order(np.zeros(0, np.int64)).tolist() == []
