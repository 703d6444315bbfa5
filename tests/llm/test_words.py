"""Words, hashes and windows of batches against plain Python."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aBcé\x01 \t\n9-Ω"), max_size=40)),
                 min_size=1, max_size=6)


@settings(deadline=None, max_examples=150)
@given(TEXTS, st.integers(1, 4))
def test_words_and_windows(texts, k):
    raw = [None if t is None else t.encode() for t in texts]
    for seps, lower, pattern in ((W.SPACES, False, r"[^\x20\x09-\x0D]+"),
                                 (W.NON_WORDS, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        got = W.split_words(raw, seps, lower)
        hashes, ok = got.windows(k)
        seen = {}
        for d, text in enumerate(texts):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
            want = re.findall(pattern, low)
            a, b = got.first[d], got.first[d + 1]
            assert [got.text(i, i + 1).decode() for i in range(a, b)] == want
            for i in range(b - a):
                whole = i + k <= b - a
                assert ok[a + i] == whole
                if whole:
                    assert seen.setdefault(tuple(want[i:i + k]), hashes[a + i]) == hashes[a + i]
                else:
                    assert hashes[a + i] == W.NONE
        assert len(set(seen.values())) == len(seen)


def test_blocks_do_not_show():
    text = b" ".join(b"w%d" % (i % 977) for i in range(100_000))
    got = W.split_words([text, text], W.SPACES)
    h, ok = got.windows(35)
    n = 100_000
    assert (got.hashes[:n] == got.hashes[n:]).all() and (h[:n] == h[n:]).all()
    assert ok.sum() == 2 * (n - 34) and len(np.unique(h[:n][ok[:n]])) == 977


@pytest.mark.parametrize("w", [1, 2, 5, 8, 20])
def test_sliding(w):
    values = np.random.default_rng(w).integers(0, 99, 57).astype(np.uint64)
    for pick in (np.minimum, np.maximum):
        want = [pick.reduce(values[i:i + w]) for i in range(len(values) - w + 1)]
        assert W.sliding(values, w, pick).tolist() == want
    assert len(W.sliding(values[:3], 20, np.minimum)) == 0


def test_batches_are_bounded_and_whole():
    rows = ["a" * n for n in (5, 5, 30, 1, 1, 9, 40)]
    got = list(W.batches(rows, len, 10))
    assert [r for b in got for r in b] == rows
    assert all(sum(map(len, b)) <= 10 or len(b) == 1 for b in got)
