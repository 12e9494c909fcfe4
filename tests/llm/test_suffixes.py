import random

import numpy as np
import pytest

from acreledger.llm.fmindex import FMIndex
from acreledger.llm.suffixes import permuted_lcp, suffix_array


def cases():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 10, 40, 120):
        for top in (1, 2, 4, 250):
            for _ in range(12):
                yield [rng.randrange(top) for _ in range(n)]
    yield [7] * 80
    yield [1, 2, 3, 4, 5] * 20
    yield list(range(60, 0, -1))


def common(s, a, b):
    k = 0
    while a + k < len(s) and b + k < len(s) and s[a + k] == s[b + k]:
        k += 1
    return k


def test_order_and_prefixes_match_sorting_all_suffixes():
    for s in cases():
        want = sorted(range(len(s)), key=lambda i: s[i:])
        data = np.array(s, dtype=np.uint8)
        assert suffix_array(data).tolist() == want
        assert suffix_array(data.astype(np.int64) * 1009).tolist() == want  # a large alphabet takes the other way
        plcp = permuted_lcp(data, np.array(want, dtype=np.int64))
        assert [plcp[i] for i in want] == [0] * bool(s) + [common(s, a, b) for a, b in zip(want, want[1:])]


@pytest.mark.parametrize("top", [1, 3, 40])
def test_index_finds_every_occurrence(top):
    rng = random.Random(top)
    text = [rng.randint(1, top) for _ in range(300)]
    index = FMIndex(np.array(text), sample=5)
    patterns = [text[i : i + n] for n in (1, 2, 5, 9) for i in (0, 7, 100)] + [[top + 5], [1, top + 9, 1], [1] * 40]
    grid = np.zeros((len(patterns), 40), dtype=np.int64)
    for k, p in enumerate(patterns):
        grid[k, : len(p)] = p
    low, high = index.search(grid, np.array([len(p) for p in patterns]))
    for k, p in enumerate(patterns):
        want = [i for i in range(len(text) - len(p) + 1) if text[i : i + len(p)] == p]
        assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == want
