"""Spelling variants: words one edit apart, found through variable-length grams.

Words are padded with a mark at both ends and cut into one gram per position. A
gram grows while it is frequent among the words, so common letter groups give
longer grams and lists stay short; the dictionary holds the frequent grams only.
A gram hangs on nothing but its own letters, so one edit changes just the grams
that stand over it. The most grams of a word that one edit can change bound how
many others must be shared: of any one more than that, in the order of rarity,
one is left whole. Words are listed under these grams, split by what stands on
the whole side of the edit, and the lists are merged and verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfstar.llm.common import utf8
from halfstar.session import materialise

#: Fixed values of the damage: every 97th occurrence loses a letter.
DAMAGED = 97
#: Words counted: code points and occurrences at least, and how much more frequent a form must be.
MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
#: Letters of a gram, marks included. The shortest word has MIN_CHARS + 1 grams, more than one edit can change.
SHORTEST, LONGEST = 2, 5
#: Frequent grams kept per length at most: the threshold is the number of all grams over this.
DICTIONARY = 50_000
#: Distinct words a task counts before it hands them on.
HELD_WORDS = 500_000
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
_FIRST, _LAST = "\x01", "\x02"


def _damaged(run: bytes, start: int) -> bytes:
    """``run`` without one code point if the checksum that ``start`` begins is divisible by 97."""
    h = zlib.crc32(run, start)
    if h % DAMAGED:
        return run
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the damaged runs of all texts; a null id reads as empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            table = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return table

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                start = zlib.crc32(f"{'' if i is None else i}:".encode())
                own: Counter[bytes] = Counter(m.group() for m in _RUN.finditer(text.lower()))
                for word, n in own.items():
                    counts[_damaged(word, start)] += n
                if len(counts) > HELD_WORDS:
                    yield flush()
        if counts:
            yield flush()

    per_task = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    long_enough = per_task.where(F.length("word") >= min_chars)
    return long_enough.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams that occur more often than all grams of their length / ``DICTIONARY``; so no more than that.

    The table is bounded at every size of the vocabulary and may be broadcast.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for word in batch.column("word").to_pylist():
                padded = _FIRST + word + _LAST
                for q in range(SHORTEST, LONGEST):
                    counts.update(padded[p : p + q] for p in range(len(padded) - q + 1))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])

    counted = materialise(words.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "spell-grams")
    size = F.length("gram")
    total = counted.groupBy(size.alias("q")).agg((F.sum("n") / DICTIONARY).alias("least"))
    kept = counted.join(F.broadcast(total), size == F.col("q")).where(F.col("n") > F.greatest(F.lit(1.0), "least"))
    return {r.gram: r.n for r in kept.select("gram", "n").collect()}


def grams(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """Spans of the grams of a padded word: from each position on, as long as they are frequent."""
    out, n = [], len(word)
    for p in range(n - SHORTEST + 1):
        e = p + SHORTEST
        while e < n and e - p < LONGEST and word[p:e] in frequent:
            e += 1
        out.append((p, e))
    return out


def prefix_grams(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """The rarest grams of a padded word, one more than an edit can change, in the order all words share."""
    spans = grams(word, frequent)
    over = [0] * len(word)
    for p, e in spans:
        for i in range(p, e):
            over[i] += 1
    order = sorted(spans, key=lambda s: (frequent.get(word[s[0] : s[1]], 0), zlib.crc32(word[s[0] : s[1]].encode()), word[s[0] : s[1]], s))
    return order[: max(over) + 1]


def one_edit(a: str, b: str) -> int:
    """Where ``a`` and ``b`` differ by one inserted, deleted or replaced letter, or -1."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return -1
    i, least = 0, min(len(a), len(b))
    while i < least and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return i if a[i + 1 :] == b[i + 1 :] else -1
    short, long = (a, b) if len(a) < len(b) else (b, a)
    return i if short[i:] == long[i + 1 :] else -1


def _listed(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """``(key, word, n, rank)``: a word under each of its prefix grams, for an edit to the right or to the left of it."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            keys, at, ranks = [], [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                padded = _FIRST + word + _LAST
                for rank, (p, e) in enumerate(prefix_grams(padded, known)):
                    # An edit to the right leaves all up to the gram's end, one to the left all from its start.
                    for side in (f"<{e - p}{padded[:e]}", f">{e - p}{padded[p:]}"):
                        keys.append(xxhash.xxh64_intdigest(side.encode()) - (1 << 63))
                        at.append(row)
                        ranks.append(2 * rank + (side[0] == ">"))
            where = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column("word").take(where), batch.column("n").take(where), pa.array(ranks, pa.int16())],
                ["key", "word", "n", "rank"],
            )

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long, rank short")


def _first_whole(prefix: list[tuple[int, int]], edit: int, longer: bool) -> int:
    """Which prefix gram of a word is the first that an edit at ``edit`` leaves whole, and on which side."""
    for rank, (p, e) in enumerate(prefix):
        if e <= edit:
            return 2 * rank
        if p >= edit + longer:
            return 2 * rank + 1
    return -1


def _variants(words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of places whose words are at most one edit apart; linear in the list but for true pairs.

    Words meet under what is left of them without one letter.
    """
    if len(words) <= 12:
        yield from ((i, j) for i in range(len(words)) for j in range(i))
        return
    same = 0
    while all(len(w) > same and w[same] == words[0][same] for w in words):
        same += 1
    by: dict[str, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        for k in {w[same:p] + w[p + 1 :] for p in range(same, len(w))} | {w[same:]}:
            by[k].append(i)
    met = {(max(i, j), min(i, j)) for group in by.values() if len(group) > 1 for x, i in enumerate(group) for j in group[:x]}
    yield from met


def near_pairs(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """``(word, near, near_n)``, both ways, for all words one edit apart; every pair comes once each way.

    A pair may meet in several lists. It is handed on in the one that belongs to
    its first gram left whole, so the pairs need no distinct.
    """
    shared = words.sparkSession.sparkContext.broadcast(frequent)
    listed = _listed(words, frequent).repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        out: tuple[list, list, list] = ([], [], [])
        held: tuple[list, list, list] = ([], [], [])
        last = None

        def merge() -> None:
            words, counts, ranks = held
            if len(words) > 1:
                prefix: dict[int, list[tuple[int, int]]] = {}  # one word often has several pairs in a list
                for i, j in _variants(words):
                    a, b = words[i], words[j]
                    edit = one_edit(a, b)
                    if edit < 0:
                        continue
                    if i not in prefix:
                        prefix[i] = prefix_grams(_FIRST + a + _LAST, known)
                    if ranks[i] == _first_whole(prefix[i], edit + 1, len(a) >= len(b)):
                        for x, y in ((i, j), (j, i)):
                            out[0].append(words[x])
                            out[1].append(words[y])
                            out[2].append(counts[y])
            for x in held:
                x.clear()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], ["word", "near", "near_n"])
            for x in out:
                x.clear()
            return batch

        for batch in batches:
            keys = batch.column("key").to_pylist()
            for key, *row in zip(keys, *(batch.column(c).to_pylist() for c in ("word", "n", "rank"))):
                if key != last:
                    merge()
                    last = key
                for x, value in zip(held, row):
                    x.append(value)
                if len(out[0]) > 50_000:
                    yield flush()
        merge()
        if out[0]:
            yield flush()

    return listed.mapInArrow(run, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for words with a form, by doubling the steps; counts double along forms, so rounds are few."""
    up = materialise(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = up.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        stepped = materialise(stepped, "spell-roots")
        up = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return up


def spelling_forms(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for the words of all texts.

    Words are maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z lowered,
    after the damage of ``word_counts``, of ``min_chars`` (5 at least) code points and
    ``min_count`` occurrences. A word's form is its most frequent near word (ties:
    least in code-point order), if that occurs ``ratio`` times as often (2 at
    least); ``root`` follows forms to the last. Null and empty texts hold no word,
    repeated rows count again, an empty table gives no row, other columns are
    not read.
    """
    if min_chars < MIN_CHARS or ratio < 2:
        raise ValueError(f"words of {MIN_CHARS} letters and a ratio of 2 at least")
    words = materialise(word_counts(docs, min_chars, min_count), "spell-words")
    pairs = near_pairs(words, frequent_grams(words))
    # The largest count first, then the least word.
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    nearest = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best)
    wide = words.join(nearest, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.m") >= ratio * F.col("n"), F.col("best.near")).alias("form"), (-F.col("best.m")).alias("top_n"),
    )
    table = materialise(wide, "spell-forms")
    roots = _roots(table.where("form is not null"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
        F.when(F.col("form").isNotNull(), F.col("top_n")).alias("form_n"),
    )
