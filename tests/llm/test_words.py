import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lakemart.llm.words import ALNUM, NOT_SPACE, single_spaced, split_words, xxh64

PATTERNS = [(NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]


@pytest.mark.parametrize(("is_word", "pattern"), PATTERNS)
def test_split_words_equals_the_pattern(is_word, pattern):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB \n\té9_|xyzQ") for _ in range(rng.choice([0, 1, 5, 300]))) for _ in range(200)]
    texts += ["", " ", "a", "x" * 5000]
    w = split_words(pa.array([t.encode() for t in texts], pa.large_binary()), is_word)
    s = single_spaced(w)
    for i, t in enumerate(texts):
        words = re.findall(pattern, t.encode().lower())
        assert [w.data[a:b].tobytes() for a, b in zip(w.starts, w.ends)][w.first[i] : w.first[i + 1]] == words
        if words:
            assert s.data[s.starts[s.first[i]] : s.ends[s.first[i + 1] - 1]].tobytes() == b" ".join(words)


def test_xxh64_equals_the_library():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 60_000).astype(np.uint8)
    starts = rng.integers(0, 40_000, 5000)
    ends = starts + rng.integers(0, 120, 5000)
    ends[:6] = starts[:6] + np.array([0, 31, 32, 33, 4096, 9000])
    got = xxh64(data, starts, ends, 42)
    for g, a, b in zip(got, starts, ends):
        assert int(g) == xxhash.xxh64_intdigest(data[a:b].tobytes(), 42)
