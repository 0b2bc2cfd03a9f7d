import random

import numpy as np
import xxhash
from helpers import AWKWARD, docs_of

from halfstar.llm import components as C
from halfstar.llm import simhash as S


def slow_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def near_texts(seed=1, base=12, copies=6):
    rnd = random.Random(seed)
    rows, number = [], 0
    for _ in range(base):
        words = [f"t{rnd.randint(0, 5000)}" for _ in range(400)]
        for c in range(copies):
            own = list(words)
            for _ in range(c):
                own[rnd.randrange(len(own))] = f"e{rnd.randint(0, 99)}"
            rows.append((number, " ".join(own), f"s{c}"))
            number += 1
    return rows


def test_contract_against_brute_force(spark):
    rows = near_texts() + AWKWARD
    got = S.simhash_components(docs_of(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    values = [slow_fingerprint(t, 3) for _, t, _ in rows]
    groups = slow_components(values, 2)
    smallest = {}
    for (i, _, _), g in zip(rows, groups):
        if i is not None:
            smallest[g] = min(i, smallest.get(g, i))
    expected = sorted((str(i), f"{v:016x}", str(smallest.get(g))) for (i, _, _), v, g in zip(rows, values, groups))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected


def test_every_link_shares_a_bucket_and_the_table_bounds_it():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, (400, 1)).astype(np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, i % 3, replace=False):
            y[i, 0] ^= np.uint64(1 << int(b))
    assert np.abs(S.pivot_table(x) - S.pivot_table(y)).max() <= 2
    kx, ky = S._complete_keys(x, 2), S._complete_keys(y, 2)
    assert np.any([a == b for a, b in zip(kx, ky)], axis=0).all()


def test_large_buckets_are_cut_without_losing_links(spark):
    docs = docs_of(spark, near_texts(seed=3, base=4, copies=8))
    whole = S.simhash_components(docs, radius=2).collect()
    cut = S.simhash_components(docs, radius=2, bucket_rows=2).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, cut))


def test_spanning_reaches_what_links_reach():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 6).astype(np.uint64)
    words = np.array([[b ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64)))] for b in base for _ in range(30)])
    bucket = S._Bucket(words, 2)
    groups = slow_components([int(w) for w in words[:, 0]], 2)
    total = []
    for links in (bucket.spanning(0, len(words)), bucket._grown(0, len(words))):
        found = list(range(len(words)))
        for a, b, d in links:
            assert d == int(words[a, 0] ^ words[b, 0]).bit_count() <= 2
            keep, drop = sorted((found[a], found[b]))
            assert keep != drop
            found = [keep if f == drop else f for f in found]
        assert len(set(found)) == len(set(groups))
        total.append(sum(d for _, _, d in links))
    assert total[0] == total[1]


def test_one_document_of_each_group_stays(spark):
    rows = near_texts(seed=7, base=5, copies=4) + [(900, "x y z " * 50, "q")] + AWKWARD
    docs = docs_of(spark, rows, clash=True)
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None and i < 20 and i % 4 == 0 and i not in (4,)) == [0, 8, 12, 16]
    assert 900 in ids and 5 in ids and 7 in ids
    assert ids.count(1) <= 1 and ids.count(None) <= 1
    # all texts without words are one group: its smallest id stays
    assert 2 in ids and 3 not in ids


def test_components_of_chains_hubs_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in C.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    empty = docs_of(spark, [])
    assert S.simhash_components(empty).count() == 0
    assert S.drop_near_duplicates(empty).count() == 0


def slow_near(rows, similarity=0.8):
    sets = []
    for _, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or len(a & sets[j]) >= similarity * len(a | sets[j]) > 0:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def test_stage_groups_by_exact_similarity(spark):
    """Copies from sure ones down to ones well below the threshold."""
    rows = [r for r in near_texts(seed=11, base=15, copies=14)]
    got = {r.key.id: r.component for r in S.near_groups(docs_of(spark, rows), **S.STAGE, key=S.row_key(docs_of(spark, rows))).collect()}
    expected = slow_near(rows)
    ours, theirs = {}, {}
    for (i, _, _), g in zip(rows, expected):
        ours.setdefault(got[i], set()).add(i)
        theirs.setdefault(g, set()).add(i)
    wrong = [g for g in ours.values() if not any(g <= t for t in theirs.values())]
    assert not wrong
    assert len(ours) <= len(theirs) + 2


def stage_groups(spark, rows):
    docs = docs_of(spark, rows)
    return {r.key.id: r.component for r in S.near_groups(docs, **S.STAGE, key=S.row_key(docs)).collect()}


def test_true_links_of_a_template_family_are_not_dropped_for_short_ones(spark):
    """Pairs at 0.82 whose cross pairs stand just below the threshold, all in the same buckets."""
    rnd = random.Random(5)
    common = [f"c{i}" for i in range(1200)]
    rows = []
    for p in range(100):
        middle = [f"p{p}x{i}" for i in range(36)]
        for c in range(2):
            rows.append((2 * p + c, " ".join(common + middle + [f"o{p}y{c}z{i}" for i in range(134)]), "s"))
    rnd.shuffle(rows)
    got = stage_groups(spark, rows)
    expected = slow_near(rows)
    assert len(set(expected)) == 100
    together = sum(got[2 * p] == got[2 * p + 1] for p in range(100))
    assert len(set(got.values())) == 200 - together and together >= 97


def test_long_texts_are_linked_whatever_their_fingerprints(spark, monkeypatch):
    """No fingerprint links anything here: pairs at 0.8 or just below, of which one text may be a short one."""
    monkeypatch.setattr(S, "ASKED", 1)
    rnd, rows = random.Random(3), []
    often = [f"c{i}" for i in range(40)]
    for p in range(60):
        words = [*often[: p % 3 * 20], *(f"w{p}x{i}" for i in range(110 + 3 * p))]
        n = len(words) - 4
        other = words[: len(words) - round((0.2 if p % 2 else 0.23) * n)] if p % 5 else words + [f"z{p}y{i}" for i in range(n // 4)]
        rows += [(2 * p, " ".join(words), "s"), (2 * p + 1, " ".join(other), "s")]
    rnd.shuffle(rows)
    docs = docs_of(spark, rows)
    got = {r.key.id: r.component for r in S.near_groups(docs, **{**S.STAGE, "radius": 0, "sure": 0}, key=S.row_key(docs)).collect()}
    expected = slow_near(rows)
    by = dict(zip((i for i, _, _ in rows), expected))
    assert 20 < sum(by[2 * p] == by[2 * p + 1] for p in range(60)) < 60
    pairs = [(a, b) for a in by for b in by if a < b]
    assert [got[a] == got[b] for a, b in pairs] == [by[a] == by[b] for a, b in pairs]


def test_parities_never_differ_more_than_the_sets():
    rng = np.random.default_rng(2)
    for n, m in ((1, 1), (5, 40), (300, 310), (400, 90), (2000, 2100)):
        x = np.unique(rng.integers(0, 1 << 32, n).astype(np.uint32))
        y = np.unique(np.concatenate([x[: len(x) // 2], rng.integers(0, 1 << 32, m).astype(np.uint32)]))
        apart = len(np.setxor1d(x, y))
        assert apart / 3 < S._differ(S._parity(x), S._parity(y)) <= apart and S._differ(S._parity(x), S._parity(x)) == 0


def test_short_texts_are_linked_by_exact_joins(spark):
    rows = []
    for p in range(100):
        words = [f"w{p}x{i}" for i in range(8)]
        rows += [(2 * p, " ".join(words), "s"), (2 * p + 1, " ".join(words + ["more"]), "s")]
    got = stage_groups(spark, rows)
    assert len(set(got.values())) == 100 and all(got[2 * p] == got[2 * p + 1] for p in range(100))


def test_wide_keys_and_discards_come_from_the_distance_table(monkeypatch):
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 63, (300, 16)).astype(np.uint64)
    for i in range(0, 300, 3):  # near copies of the row before
        flips = rng.choice(1024, i, replace=False)
        words[i + 1] = words[i]
        for b in flips.tolist():
            words[i + 1, b // 64] ^= np.uint64(1 << b % 64)
    # the bands agree exactly where the bits do, and the keys are counts away from the base
    keys = np.array(S._band_keys(words, 16))
    bits = np.ascontiguousarray(words ^ S.BASE).view("<u2")
    assert keys.shape == (64, 300) and (keys.T == bits).all()
    carried = words[:, :8]
    bucket = S._Bucket(carried, 128)
    c = S.coordinates(S.pivot_table(carried)).astype(int)
    a, b = np.triu_indices(300, 1)
    exact = np.bitwise_count(carried[a] ^ carried[b]).sum(1)
    least = np.bitwise_count(bucket.table[a] ^ bucket.table[b]).sum(1)
    assert (least == np.abs(c[a] - c[b]).sum(1)).all() and (least <= exact).all()
    assert (np.minimum(bucket.distances(a, b), 129) == np.minimum(exact, 129)).all()
    assert (exact <= 128).any() and (least[exact > 128] > 128).mean() > 0.99
