import pickle
import time

import numpy as np
import pytest

from halfstar.llm import decontaminate as D


def text(numbers):
    return " ".join(f"w{i}" for i in numbers)


def edited(rng, item, edits):
    """``edits`` single-word edits at places of their own."""
    out = list(item)
    for p in sorted(rng.choice(len(item), edits, replace=False).tolist(), reverse=True):
        kind = rng.integers(3)
        if kind == 0:
            out[p] = 10**6 + int(rng.integers(1000))
        elif kind == 1:
            del out[p]
        else:
            out.insert(p, 10**6 + int(rng.integers(1000)))
    return out


def test_index_of_many_items_is_small():
    rng = np.random.default_rng(1)
    items = [(i, text(rng.integers(0, 50_000, 40).tolist())) for i in range(10_000)]
    assert len(pickle.dumps(D.Index(items))) < 64 << 20


def test_items_that_share_pieces_equal_brute_force_and_stay_cheap():
    """1,000 items begin with the same words; a long text repeats those words."""
    rng = np.random.default_rng(2)
    template = list(range(10))
    items = [template + rng.integers(10, 5_000, 30).tolist() for _ in range(1_000)]
    index = D.Index([(i, text(w)) for i, w in enumerate(items)])
    doc = []
    for _ in range(60):
        doc += template + rng.integers(10, 5_000, 50).tolist()
    doc += edited(rng, items[17], 6) + rng.integers(10, 5_000, 50).tolist() + items[400]
    held = D.words(text(doc))
    index.search([held])
    start = time.perf_counter()
    (got,) = index.search([held])
    seconds = time.perf_counter() - start
    code = {w: i + 1 for i, w in enumerate(dict.fromkeys(D.words(" ".join(text(w) for w in items))))}
    stream = np.array([code.get(w, 0) for w in held])
    coded = [np.array([code[w] for w in D.words(text(i))]) for i in items]
    # a copy needs 34 of its 40 words in the text at all, an exact bound that keeps the slow twin short
    near = [p for p, c in enumerate(coded) if np.isin(c, stream).sum() >= len(c) - int(D.EDITS * len(c))]
    expected = {(p, e) for p in near if (e := D.edit_distance(coded[p], stream)) <= int(D.EDITS * len(coded[p]))}
    assert {(p, e) for p, _, e in got} == expected
    assert {17, 400} <= {p for p, _ in expected}
    assert seconds < 1.5, seconds


@pytest.mark.parametrize("length", [10, 40, 150, 300, 400])
def test_walks_alone_and_pieces_at_the_threshold(length):
    rng = np.random.default_rng(length)
    items = [rng.integers(0, 20_000, length).tolist() for _ in range(60)]
    index = D.Index([(i, text(w)) for i, w in enumerate(items)])
    texts = [D.words(text(rng.integers(0, 20_000, 30).tolist() + edited(rng, w, int(D.EDITS * length)) + [5, 6, 7])) for w in items]
    both = [i in {p for p, _, _ in hits} for i, hits in enumerate(index.search(texts))]
    assert all(both)
    index.pieces = {}
    walks = sum(i in {p for p, _, _ in hits} for i, hits in enumerate(index.search(texts)))
    assert walks >= 0.95 * len(items), walks / len(items)
