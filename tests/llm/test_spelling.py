import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import AWKWARD, docs_of

from halfstar.llm import queries as Q
from halfstar.llm import spelling as S


def slow_forms(rows):
    """Words that meet under a deleted letter, compared letter by letter; ``rows`` of (doc_id, text)."""
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    meet = defaultdict(set)
    for w in words:
        for k in {w[:p] + w[p + 1 :] for p in range(len(w))} | {w}:
            meet[k].add(w)
    near = defaultdict(set)
    for group in meet.values():
        for a in group:
            for b in group:
                if a != b and apart(a, b):
                    near[a].add(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(near[w]), f and words[f]))
    return sorted(out)


def apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:p] + long[p + 1 :] == short for p in range(len(long)))


def plain(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_over_the_whole_table(spark):
    from conftest import TESTDATA

    rows = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").collect()]
    expected = slow_forms(rows)
    assert sum(r[4] > 0 for r in expected) > 100
    assert plain(Q.queries()["op11_spelling"](spark, TESTDATA)) == expected


@pytest.mark.parametrize("dictionary", [2, 40, 50_000])
def test_every_dictionary_finds_all_pairs(spark, monkeypatch, dictionary):
    monkeypatch.setattr(S, "DICTIONARY", dictionary)
    base = ["banana", "aaaaa", "aaaaaa", "abababa", "ababa", "mississippi", "éàüöß", "ÀÉÎÕÜ", "queue", "bookkeeper"]
    words = set(base)
    for w in base:
        for p in range(len(w)):
            words |= {w[:p] + w[p + 1 :], w[:p] + w[p] + w[p:], w[:p] + "z" + w[p + 1 :], w[:p] + "÷" + w[p:], w + "a"}
    rows = [(i, " ".join(sorted(words)[: len(words) - i * 7])) for i in range(40)]
    rows += [(None, "banana banana banana " * 30), (None, "zzzzz-zzzzz zzzzzy")]
    df = docs_of(spark, [(i, t, "a") for i, t in rows], clash=True).selectExpr("*", "'x' as word", "1 as n", "2 as rank")
    assert plain(S.spelling_forms(df)) == slow_forms(rows)


def test_long_lists_are_merged_without_all_pairs():
    words = ["prefix" + a + b + "tail" for a in "abcdefghij" for b in "klmnopqrst"]
    found = {frozenset((words[i], words[j])) for i, j in S._variants(words) if S.one_edit(words[i], words[j]) >= 0}
    assert found == {frozenset((a, b)) for a in words for b in words if a != b and apart(a, b)}
    far = [f"{i:05d}{i * 7919 % 100003:06d}" for i in range(400)]
    assert sum(1 for _ in S._variants(far)) < 4_000


def test_prefix_holds_a_whole_gram_for_every_edit():
    frequent = {g: 9 for w in ("\x01thing\x02", "\x01thingthing\x02") for q in (2, 3, 4) for p in range(len(w)) if len(g := w[p : p + q]) == q}
    for w in ("thing", "thingthing", "hhhhh", "nothing"):
        padded = f"\x01{w}\x02"
        for edit in range(1, len(padded) - 1):
            assert any(e <= edit or p > edit for p, e in S.prefix_grams(padded, frequent))


def test_awkward_rows(spark):
    rows = AWKWARD * 3
    assert plain(S.spelling_forms(docs_of(spark, rows, clash=True))) == slow_forms([r[:2] for r in rows])
    assert S.spelling_forms(docs_of(spark, [])).count() == 0
    long = [(1, "Wordé " * 300_000 + "word" + "x" * 300_000, "a")]
    assert plain(S.spelling_forms(docs_of(spark, long))) == slow_forms([r[:2] for r in long])


def test_first_whole_gram_is_found_among_known_ones():
    padded = S._FIRST + "abcdefg" + S._LAST
    prefix = S.prefix_grams(padded, {})
    for edit in range(1, len(padded)):
        for longer in (False, True):
            whole = [2 * r + (p >= edit + longer) for r, (p, e) in enumerate(prefix) if e <= edit or p >= edit + longer]
            assert S._first_whole(prefix, edit, longer) == (whole[0] if whole else -1)
