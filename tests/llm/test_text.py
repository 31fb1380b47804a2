from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.shared import ODD_TEXTS, alphanumeric, spaced
from tillwright.llm import text as T


@pytest.mark.parametrize(("alphabet", "plain"), [(T.SPACED, spaced), (T.ALPHANUMERIC, alphanumeric)])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.text("aA \n.0é")), max_size=8))
def test_words(alphabet, plain, texts):
    seen: dict[str, int] = {}
    found = 0
    for first, data, offsets in T.slices(pa.array(texts, pa.string())):
        words = T.split_words(data, offsets, alphabet)
        for t in range(len(words)):
            own = words.hashes[words.bounds[t] : words.bounds[t + 1]].tolist()
            expected = plain(texts[first + t])
            assert len(own) == len(expected)
            for word, value in zip(expected, own):
                assert seen.setdefault(word, value) == value
            found += 1
    assert found == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_shingle_sets_have_the_size_of_plain_ones(monkeypatch):
    monkeypatch.setattr(T, "SLICE_BYTES", 64)  # many slices
    sizes = [len(own) for own in T.shingle_sets(pa.array(ODD_TEXTS), 4)]
    expected = [len({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))}) if w else 0 for w in map(spaced, ODD_TEXTS)]
    assert sizes == expected


def test_short_sequences_differ_from_shingles_and_from_each_other():
    own = list(T.shingle_sets(pa.array(["a b c", "a b c d", "a b", "b a", "a b c"]), 4))
    assert np.array_equal(own[0], own[4])
    assert len({int(s[0]) for s in own[:4]}) == 4


def test_long_texts_are_hashed_like_short_ones(monkeypatch):
    texts = ["alpha Beta  gamma ", "", "x" * 700, "é ß " * 300, " " * 500 + "one", "two three " * 80, "end"] * 3
    data, offsets = T.raw(pa.array(texts))
    whole = T.split_words(data, offsets, T.SPACED)
    prefixes = T.prefix_hashes(whole, T.SPACED, 3)
    monkeypatch.setattr(T, "SLICE_BYTES", 100)
    pieces = T.split_words(data, offsets, T.SPACED)
    for name in ("starts", "ends", "hashes", "bounds"):
        assert (getattr(whole, name) == getattr(pieces, name)).all()
    assert (T.prefix_hashes(pieces, T.SPACED, 3) == prefixes).all()
