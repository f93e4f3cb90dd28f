import random

import numpy as np

from tidemark.llm.run_length_index import RunLengthIndex, suffix_array


def corpus(seed=4):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcd ") for _ in range(300))
    made = []
    for _ in range(12):
        t = list(base[rng.randrange(100) :])
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = "x"
        made.append("".join(t).encode())
    return [*made, b"", b"short"]


def test_suffix_array():
    s = np.array([3, 1, 3, 1, 2, 0])
    assert suffix_array(s).tolist() == sorted(range(6), key=lambda i: s[i:].tolist())


def test_long_matches_and_runs():
    texts = corpus()
    index = RunLengthIndex(texts)
    assert index.runs < index.length / 2
    for d, t in enumerate(texts):
        mask = np.zeros(len(t), bool)
        for i in range(len(t) - 49):
            if any(t[i : i + 50] in x for x in texts[:d]):
                mask[i : i + 50] = True
        assert np.array_equal(index.long_matches(t, d), mask), d


def test_matching_statistics():
    texts = corpus(9)[:4]
    index = RunLengthIndex(texts)
    for t in (b"abcd abx", texts[2][20:60] + b"zz", b""):
        want = [max(k for k in range(len(t) - i + 1) if any(t[i : i + k] in x for x in texts)) for i in range(len(t))]
        assert index.matching_statistics(t).tolist() == want
