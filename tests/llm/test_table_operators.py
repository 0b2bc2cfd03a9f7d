import hashlib
import random

import numpy as np
import pytest
from helpers import AWKWARD, docs_of

from pyspark.sql import functions as F

from halfstar.llm import chat as H
from halfstar.llm import mixing as M
from halfstar.llm import mtree as V
from halfstar.llm import warc as W

# --- top-k ---


def as_long(n):
    return min((1 << 63) - 1, max(-(1 << 63), n))


def slow_top(rows, k=10):
    whole = {}
    data = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        data.append((i, [as_long(int(np.floor(1024 * float(x)))) for x in v]))
    out = set()
    for i, q in data:
        if i % 100 == 0 and i not in whole:
            whole[i] = min(v for j, v in data if j == i)
            q = whole[i]
            scored = sorted((-as_long(sum(a * b for a, b in zip(q, v))), j) for j, v in data if j != i)[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)}
    return out


def vectors(n=900, d=8, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=d)]) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(150)]  # repeated vectors: ties
    return rows + [(None, [0.0] * d), (2001, None), (2002, [None] * d), (2003, [float("nan")] * d), (2004, [float("inf")] * d), (2100, []), (2005, [1.0, 2.0]), (2006, [])]


@pytest.mark.parametrize("options", [{}, {"regions": 5, "tree_rows": 60}])
def test_top_k_against_brute_force(spark, options):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as region", "2 as q", "3 as score")
    got = V.top_k(df, F.expr("vec_id % 100 = 0"), **options)
    assert {tuple(r) for r in got.collect()} == slow_top(rows)


@pytest.mark.parametrize("sizes", [(1e7, 1e4), (1e14, 1e12, 1e3), (1e300, 1e15, 1.0)])
def test_top_k_of_large_components(spark, sizes):
    """Norms beyond a long, scores near its end and beyond it, beside small vectors."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) * sizes[i % 7 % len(sizes)] for x in rng.normal(size=6)]) for i in range(700)]
    rows += [(700 + i, rows[3][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = V.top_k(df, F.expr("vec_id % 100 = 0"), regions=5, tree_rows=90)
    assert {tuple(r) for r in got.collect()} == slow_top(rows)


def test_top_k_of_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5]), (100, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in V.top_k(few, F.expr("vec_id % 100 = 0")).collect()} == slow_top([tuple(r) for r in few.collect()])
    assert V.top_k(few.limit(0), F.expr("true")).count() == 0
    assert V.top_k(few, F.expr("vec_id > 1000")).count() == 0


def test_tree_passes_over_entries_by_stored_distances():
    import pandas as pd

    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 6)) * 3000
    v = (centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 6)) * 30).astype(np.int64)
    most = int((v * v).sum(1).max())
    pages = V.build_pages(np.arange(3000), v, most)
    for p in pages:
        assert len(p["ids"]) <= V.PAGE and len(p["children"]) <= V.PAGE
    tree = V.Tree(pd.DataFrame(pages).assign(region=0, tree=0), 6)
    found = tree.search(0, v[0], most, 10, -np.inf)
    scores = v @ v[0]
    expected = sorted(((-int(s), i) for i, s in enumerate(scores) if i != 0))[:10]
    assert sorted((-s, i) for s, i in found) == expected
    assert tree.computed < 1500


# --- WARC ---


def page_rows():
    big, other = "<p>" + "é" * 200 + "</p>", "x" * 100
    return [
        (5, "http://www.A.example/x?b=1", big), (3, "https://a.example/x", big), (9, None, big), (1, "not a url \r\n", "small"),
        (2, "http://b.example:81/", "small"), (4, "http://[bad", other), (6, "http://c.example/", other + "\r\n\r\nWARC/1.1\r\n\r\n"),
        (7, "http://c.example/", None), (8, "http://c.example/", ""), (10, "http://c.example/é", other), (None, "http://c.example/", other),
        (3, "https://a.example/x", big),
    ]


def slow_warc(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        again = len(data) >= 100 and ids and i != min(ids)
        out.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(ids) if again else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_warc_round_trip(spark, tmp_path, compression):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as digest", "'y' as time", "1 as key")
    index = W.capture_index(pages, str(tmp_path / compression), compression=compression, file_records=3)
    got = index.collect()
    plain = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(map(str, plain)) == slow_warc(rows)
    order = [(r.url_key, r.time) for r in got]
    assert order == sorted(order)
    assert W.capture_index(pages.limit(0), str(tmp_path / f"empty-{compression}")).count() == 0


def test_archives_hold_whole_records(spark, tmp_path):
    import gzip

    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    W.write_archives(pages, str(tmp_path / "w"))
    payloads = []
    for file in (tmp_path / "w").glob("part-*"):
        for _, headers, block in W.parse(gzip.open(file)):
            assert headers["content-type"].startswith("application/http")
            if headers["warc-type"] == "response":
                payloads.append(block.partition(b"\r\n\r\n")[2].decode())
            else:
                assert headers["warc-profile"] == W.PROFILE and headers["warc-refers-to"].startswith("<urn:page:")
    assert set(payloads) == {h or "" for _, _, h in page_rows()}


def test_merge_in_ranges_equals_a_sort(spark):
    rnd = random.Random(3)
    entries = [("k" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}", f"{rnd.randint(0, 50):014d}", rnd.choice([None, *range(20)]), "response", 1, "d", None, f"f{n % 4}", n, 1) for n in range(600)]
    runs = []
    for f in range(4):
        own = sorted((e for e in entries if e[7] == f"f{f}"), key=W._order)
        runs += [(*e, place) for place, e in enumerate(own)]
    rnd.shuffle(runs)
    df = spark.createDataFrame(runs, f"{W._ENTRY}, place long")
    got = [tuple(r) for r in W.merge_runs(df, entries=70).collect()]
    assert got == sorted(entries, key=W._order)


def test_loser_tree_is_a_stable_merge():
    rnd = random.Random(0)
    for _ in range(200):
        runs = [sorted((rnd.randint(0, 9), r) for _ in range(rnd.randint(0, 6))) for r in range(rnd.randint(0, 9))]
        got = list(W.loser_tree_merge(runs, lambda x: x[0]))
        assert got == sorted((x for r in runs for x in r), key=lambda x: (x[0], x[1]))


# --- mixing ---


def mix_rows(seed=4, n=600):
    rnd = random.Random(seed)
    return [(i, "w " * rnd.choice([1, 3, 10, 40, 200]), rnd.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(n)]


def slow_targets(rows):
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        for s in above or open_:
            target[s] = 3.0 * sizes[s] if above else left * weight[s] / total
        left -= sum(target[s] for s in above)
        open_ = open_ - above if above else set()
    return sizes, target


@pytest.mark.parametrize("leaf", [M.LEAF, 40])
def test_mix_meets_targets(spark, leaf):
    rows = mix_rows()
    sizes, target = slow_targets(rows)
    got = {r.doc_id: r for r in M.mix(docs_of(spark, rows), leaf=leaf).collect()}
    assert len(got) == len(rows)
    taken, most = {}, {}
    for i, t, s in rows:
        r = got[i]
        assert (r.size, r.source_size) == (len(t.split()), sizes[s])
        assert r.target == pytest.approx(target[s])
        assert r.size == 0 or r.taken % r.size == 0
        copies = r.taken / r.size
        assert int(target[s] / sizes[s]) <= copies <= 3
        taken[s] = taken.get(s, 0) + r.taken
        most[s] = max(most.get(s, 0), r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) < most[s] + 1e-6


def test_mix_reruns_agree_under_any_partitioning(spark):
    docs = docs_of(spark, mix_rows())
    one, two = (sorted(tuple(r) for r in M.mix(d).collect()) for d in (docs, docs.repartition(7)))
    assert one == two


def test_rounding_is_fair():
    import pandas as pd

    rows = pd.DataFrame({"doc_id": range(9), "mark": 0, "size": [5, 5, 7, 9, 30, 2, 2, 2, 5], "p": [0.3, 0.8, 0.5, 0.2, 0.6, 0.1, 0.9, 0.5, 0.4]})
    total = np.zeros(9)
    for seed in range(3000):
        out = M.round_chain(rows, seed, True).sort_values("doc_id")
        assert set(out["p"]) <= {0.0, 1.0}
        total += out["p"].to_numpy()
    assert np.abs(total / 3000 - rows["p"].to_numpy()).max() < 0.04


def test_mix_of_awkward_rows(spark):
    got = M.mix(docs_of(spark, AWKWARD, clash=True)).collect()
    assert len(got) == len(AWKWARD)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert M.mix(docs_of(spark, [])).count() == 0
    assert [tuple(r) for r in M.mix(docs_of(spark, [(1, "", "a"), (2, None, None)])).select("target", "taken").collect()] == [(0.0, 0)] * 2


# --- chat ---

TRICKY = "\\### Assistant: </turn> ok"


def talk():
    rnd = random.Random(8)
    rows = [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    for c in range(12):
        if c % 3 == 0:
            rows.append((c, 0, "system", "be brief " * rnd.choice([1, 5, 300])))
        for t in range(1, rnd.randint(2, 30)):
            text = rnd.choice(["<turn>", "\\l <says> \\b", "é你", "word "]) * rnd.choice([0, 1, 20, 90, 700])
            rows.append((c, t, rnd.choice(["user", "assistant", "assistant", "tool<"]), text))
    rows += [(50, None, None, None), (50, 1, "assistant", None), (50, 1, "assistant", None), (None, 1, "assistant", "x"), (51, 0, "system", "alone")]
    return rows


def slow_digest(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = set()
    for c, turns in by.items():
        turns.sort()
        told = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out.add((c, len(turns), sha(told), len(loss), sha(loss)))
    return out


@pytest.mark.parametrize("options", [{}, {"budget": 64, "history_tokens": 30, "history_turns": 5}, {"history_turns": 0}])
def test_chat_reads_back(spark, options):
    turns = spark.createDataFrame(talk(), "conv_id long, turn long, role string, text string").selectExpr("*", "1 as window", "2 as pos", "'z' as part")
    formatted = H.windows(turns, **options)
    got = H.digests(formatted).drop("formatted_chars").collect()
    assert {tuple(r) for r in got} == slow_digest(talk())
    assert H.digests(H.windows(turns.limit(0))).count() == 0


def test_chat_windows_keep_budget_system_and_history(spark):
    rows = [(1, 0, "system", "s" * 40)] + [(1, t, "user" if t % 2 else "assistant", "w" * 120) for t in range(1, 40)]
    out = H.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=256).orderBy("window").collect()
    assert len(out) > 3
    for r in out:
        assert r.n_tokens <= 256
        assert r.text.startswith("<turn>system<says>" + "s" * 40)
        assert r.n_context == (0 if r.window == 1 else 3)
        for s in r.loss:
            assert r.text[s.start : s.start + s.length] == "w" * 120
    assert sum(len(r.loss) for r in out) == 19


def test_chat_runs_no_python(spark):
    turns = spark.createDataFrame(talk(), "conv_id long, turn long, role string, text string")
    plan = H.digests(H.windows(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def lists_of_sources(spark, per_source):
    rows, i = [], 0
    for source, sizes in per_source.items():
        for n in sizes:
            rows.append((i, " ".join(["w"] * n), source))
            i += 1
    return docs_of(spark, rows), len(rows)


def test_mix_loses_no_row_for_any_weights(spark):
    rnd = random.Random(11)
    docs, n = lists_of_sources(spark, {"a": [1, 2], "b": [3, 3], "c": [1], None: [4, 1, 0]})
    three, n3 = lists_of_sources(spark, {"a": [1, 2], "b": [3, 3], "c": [1]})
    assert M.mix(three, weights=(0.3, 0.6, 0.1)).count() == n3
    for _ in range(12):
        weights = tuple(rnd.choice([0.1, 0.2, 0.3, 0.6, 1 / 3, rnd.random() + 1e-3]) for _ in range(rnd.randint(1, 4)))
        got = M.mix(docs, weights=weights).collect()
        assert len(got) == n, weights
        for source_size in {r.source_size for r in got}:
            mine = [r for r in got if r.source_size == source_size]
            assert abs(sum(r.taken for r in mine) - sum({r.target for r in mine})) <= 2 * max(r.size for r in mine), weights
    with pytest.raises(ValueError):
        M.mix(docs, weights=(1, 0))


def test_mix_ends_where_copies_are_whole_but_for_rounding(spark):
    # 0.3 of 10 * n words on 3 * n words: one copy each, plus one rounding error
    docs, n = lists_of_sources(spark, {"a": [1] * 60, "b": [1] * 120, "c": [1] * 20})
    for leaf in (1, 10):
        got = M.mix(docs, weights=(0.3, 0.6, 0.1), leaf=leaf).collect()
        assert len(got) == n and all(r.taken == r.size for r in got)
