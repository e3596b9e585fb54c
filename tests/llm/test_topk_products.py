"""Inner products of any size: exact, or an error."""

import numpy as np
import pytest

from dockwatch.llm.topk import _products


@pytest.mark.parametrize("size", [1 << 10, 1 << 28, 1 << 30])
def test_products_are_exact(size):
    rng = np.random.default_rng(1)
    q, c = rng.integers(-size, size, (5, 4)), rng.integers(-size, size, (7, 4))
    want = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in c] for x in q]
    assert _products(q, c).tolist() == want


def test_large_parts_may_cancel_but_not_wrap():
    big = 1 << 33
    assert _products(np.array([[big, big, 3]]), np.array([[big, -big, 5]])).tolist() == [[15]]
    with pytest.raises(OverflowError):
        _products(np.array([[big, big]]), np.array([[big, big]]))
    assert _products(np.zeros((0, 3), np.int64), np.zeros((2, 3), np.int64)).shape == (0, 2)
