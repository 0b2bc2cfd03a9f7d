"""Documents that hold benchmark items, up to a share of edited words.

CGK embedding: a random walk reads a window of words. At step j it writes the
word it stands on and moves on by a random bit that hangs on j and that word
alone. Two windows at a small edit distance drift apart and meet again, so
their walks agree in most steps: edit distance becomes Hamming distance.
Samples of a few steps are hash keys of a few walks. Walks drift apart with the
number of edits, so long items with many edits need a second, complete way: of
k + 1 disjoint pieces of an item k edits leave one untouched, which is looked up
as it stands. What shares a key with an item is verified by its exact edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits per word of an item that still count as a copy; items without words take no part.
EDITS, MIN_WORDS = 0.15, 1
#: Shorter items have no walks: their pieces alone find every copy.
WALK_WORDS = 8
#: Steps per key and keys per walk.
SAMPLE, KEYS = 3, 16
#: Slots of the word filter per word of an item.
SLOTS = 16
#: Words of benchmark broadcast at once, a few tens of MB; more items are searched block by block.
BLOCK_WORDS = 500_000
#: Words of documents looked at together.
BATCH_WORDS = 400_000

_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes(32 if b in _SEPARATORS else b for b in range(256))


def words(text: str) -> list[bytes]:
    """Lower-case runs without ASCII punctuation and white space."""
    return text.lower().encode().translate(_FOLD).split()


def edit_distance(item: np.ndarray, region: np.ndarray) -> int:
    """Least number of word edits between ``item`` and any run of ``region``."""
    steps = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for w in item:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (region != w))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def walks_of(length: int) -> int:
    """Walks of a window: long ones drift further apart at the threshold, so they are walked more often."""
    return 3 if length <= 100 else 5 if length <= 200 else 8


class _Class:
    """Items of about one length: their keys in every walk and sample."""

    def __init__(self, length: int, items: list[tuple[int, np.ndarray]], vocabulary: int):
        self.length, self.items = length, items
        self.least = length - max(int(EDITS * len(i)) for _, i in items)
        # how often a word stands in an item, sparse: sorted keys item * vocabulary + word, and counts
        self.vocabulary = vocabulary
        in_items = np.concatenate([row * vocabulary + i.astype(np.int64) for row, (_, i) in enumerate(items)])
        self.bag, self.count = np.unique(in_items, return_counts=True)
        self.known = np.zeros(vocabulary, bool)
        self.known[self.bag % vocabulary] = True
        self.most = np.array([int(EDITS * len(i)) for _, i in items])
        rng = np.random.default_rng(length)
        self.samples = [np.sort(rng.integers(0, 2 * length, (KEYS, SAMPLE)), axis=1) for _ in range(walks_of(length))]
        self.factors = rng.integers(1 << 20, 1 << 62, SAMPLE).astype(np.uint64) | np.uint64(1)

    def likely(self, rows: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Whether enough words of a window are in the item, each as often as it stands there."""
        key = rows[:, None] * np.int64(self.vocabulary) + windows
        at = np.minimum(np.searchsorted(self.bag, key), len(self.bag) - 1)
        have = np.where(self.bag[at] == key, self.count[at], 0)
        ok = np.flatnonzero((have > 0).sum(1) >= self.length - self.most[rows])
        windows, have = windows[ok], have[ok]
        nth = np.zeros(windows.shape, np.int16)
        for back in range(1, self.length):
            nth[:, back:] += windows[:, back:] == windows[:, :-back]
        out = np.zeros(len(rows), bool)
        out[ok] = (nth < have).sum(1) >= self.length - self.most[rows[ok]]
        return out

    def keys(self, windows: np.ndarray, walk: int, coins: np.ndarray) -> Iterator[np.ndarray]:
        """Hash keys of the windows (one per row) for the samples of a walk."""
        n, length = windows.shape
        wanted = set(self.samples[walk].ravel().tolist())
        flat, base = windows.ravel(), np.arange(n) * length
        at, out = np.zeros(n, np.int64), {}
        for step in range(max(wanted) + 1):
            word = flat[base + np.minimum(at, length - 1)]
            if step in wanted:
                out[step] = np.where(at < length, word, 0).astype(np.uint64)
            at += (coins[word, step >> 6] >> np.uint64(step & 63)).astype(np.int64) & 1
        for sample in self.samples[walk]:
            key = np.zeros(n, np.uint64)
            for f, step in zip(self.factors, sample.tolist()):
                key = (key ^ out[step]) * f
                key ^= key >> np.uint64(31)
            yield key


class Index:
    """The benchmark side of the search; small enough to be broadcast."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        cut = [words(t) for _, t in items]
        coded = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws], np.int32) for ws in cut]
        size = len(self.vocabulary) + 1
        by: dict[int, list[tuple[int, np.ndarray]]] = {}
        for place, item in enumerate(coded):
            if len(item) >= WALK_WORDS:
                by.setdefault(_grid(len(item)), []).append((place, item))
        self.classes = [_Class(n, rows, size) for n, rows in sorted(by.items())]
        longest = max((c.length for c in self.classes), default=0)
        rng = np.random.default_rng(7)
        self.coins = rng.integers(0, 1 << 63, (walks_of(longest), size, 2 * longest // 64 + 1)).astype(np.uint64)
        self.pad = max(map(len, coded), default=0) + longest + 1
        self.coded = coded
        self.pieces = _pieces(coded)
        self.most = np.array([int(EDITS * len(i)) for i in coded], np.int64)
        self.lengths = np.array([len(i) for i in coded], np.int64)
        # filter of (item, word): a slot that is not set says that the word is not in the item
        self.filter = np.zeros(1 << max(10, int(SLOTS * self.lengths.sum()).bit_length()), bool)
        if len(coded):
            self.filter[self._slot(np.repeat(np.arange(len(coded)), self.lengths), np.concatenate(coded))] = True
        self.tables = []
        for c in self.classes:
            cores = np.stack([i[: c.length] for _, i in c.items])
            self.tables.append([[_sorted(k) for k in c.keys(cores, w, self.coins[w])] for w in range(len(c.samples))])

    def _slot(self, place: np.ndarray, word: np.ndarray) -> np.ndarray:
        key = place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word.astype(np.uint64)
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((key ^ (key >> np.uint64(29))) & np.uint64(len(self.filter) - 1)).astype(np.int64)

    def _enough(self, stream: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether so many words of a region may be in the item that it can be a copy; an upper bound."""
        out = np.zeros(len(place), bool)
        size = np.maximum(end - begin, 0)
        upto = np.cumsum(size)
        lo = 0
        while lo < len(place):
            # about a million words at once, one region at least
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + (1 << 20), "right")))
            n = size[lo:hi]
            starts = np.cumsum(n) - n
            word = stream[np.arange(n.sum()) - np.repeat(starts - begin[lo:hi], n)]
            inside = (word > 0) & self.filter[self._slot(np.repeat(place[lo:hi], n), word)]
            sums = np.concatenate([[0], np.cumsum(inside)])
            p = place[lo:hi]
            out[lo:hi] = sums[starts + n] - sums[starts] >= self.lengths[p] - self.most[p]
            lo = hi
        return out

    def search(self, texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
        """(item place, first word of the window, edits) of the items in each text."""
        get, zero = self.vocabulary.get, repeat(0)
        gap = np.zeros(self.pad, np.int32)
        parts, starts, at = [gap], [], self.pad
        for ws in texts:
            starts.append(at)
            parts += [np.fromiter(map(get, ws, zero), np.int32, len(ws)), gap]
            at += len(ws) + self.pad
        stream, starts = np.concatenate(parts), np.array(starts)
        sizes = np.array([len(ws) for ws in texts])
        below = np.concatenate([[0], np.cumsum(stream > 0, dtype=np.int32)])
        found: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        for c, tables in zip(self.classes, self.tables):
            # Every foreign word of a window costs an edit: exact bounds before any walk.
            inside = below[c.length :] - below[: -c.length]
            windows = np.flatnonzero(inside >= c.least)
            for i in range(0, len(windows), 1 << 15):
                self._class(c, tables, stream, windows[i : i + (1 << 15)], starts, sizes, found)
        for q, table in self.pieces.items():
            self._piece(q, table, stream, np.flatnonzero(below[q:] - below[:-q] == q), starts, sizes, found)
        return [[(p, a, e) for p, (e, a) in sorted(f.items())] for f in found]

    def _class(self, c: _Class, tables, stream, at, starts, sizes, found) -> None:
        doc = np.searchsorted(starts, at, "right") - 1
        ends = starts + sizes
        at = at[(doc >= 0) & (at < ends[doc])]  # not between two texts
        view = np.lib.stride_tricks.sliding_window_view(stream, c.length)
        content = view[at]
        own = c.known[content].sum(1) >= c.least
        at, content = at[own], content[own]
        if not len(at):
            return
        pairs = []
        for walk in range(len(c.samples)):
            for (keys, order), key in zip(tables[walk], c.keys(content, walk, self.coins[walk])):
                lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
                hit = np.flatnonzero(hi > lo)
                n = (hi - lo)[hit]
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pairs.append(order[np.repeat(lo[hit], n) + nth] * len(at) + np.repeat(hit, n))
        row, w = np.divmod(np.unique(np.concatenate(pairs)), len(at))
        # the same bound for the one item, before its exact distance
        likely = [c.likely(row[i : i + 1024], content[w[i : i + 1024]]) for i in range(0, len(row), 1024)]
        likely = np.concatenate([*likely, np.zeros(0, bool)])
        for row, p in zip(row[likely].tolist(), at[w[likely]].tolist()):
            place, item = c.items[row]
            doc = int(np.searchsorted(starts, p, "right")) - 1
            best = found[doc].get(place)
            if best and best[0] == 0:
                continue
            most = int(EDITS * len(item))
            if np.array_equal(stream[p : p + len(item)], item):
                edits = 0
            else:
                edits = edit_distance(item, stream[max(starts[doc], p - most) : min(ends[doc], p + len(item) + most)])
            if edits <= most and (best is None or edits < best[0]):
                found[doc][place] = (edits, p - int(starts[doc]))


    def _piece(self, q: int, table, stream, at, starts, sizes, found) -> None:
        """The items of which a piece of ``q`` words stands in a text, wherever the item then begins."""
        keys, owner, offset = table
        key = _gram_keys(stream, at, q)
        lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
        n = hi - lo
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        at = np.repeat(at, n)
        place, doc = owner[entry], np.searchsorted(starts, at, "right") - 1
        begin = at - offset[entry]
        order = np.lexsort((begin, place, doc))
        place, doc, begin = place[order], doc[order], begin[order]
        most = self.most
        # begins near each other are one region
        new = np.ones(len(begin), bool)
        new[1:] = (np.diff(doc) != 0) | (np.diff(place) != 0) | (np.diff(begin) > most[place[1:]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(begin))[: len(first)] - 1
        # a piece that many items share meets this bound as whole arrays, before anything per candidate
        p, d = place[first], doc[first]
        region = np.maximum(starts[d], begin[first] - most[p])
        until = np.minimum(starts[d] + sizes[d], begin[last] + self.lengths[p] + most[p])
        ok = self._enough(stream, p, region, until)
        first, last = first[ok], last[ok]
        for d, p, b, e in zip(doc[first].tolist(), place[first].tolist(), begin[first].tolist(), begin[last].tolist()):
            best = found[d].get(p)
            if best and best[0] == 0:
                continue
            item, k, start, end = self.coded[p], int(most[p]), int(starts[d]), int(starts[d] + sizes[d])
            region = stream[max(start, b - k) : min(end, e + len(item) + k)]
            if np.isin(item, region).sum() < len(item) - k:
                continue
            edits = edit_distance(item, region)
            if edits <= k and (best is None or edits < best[0]):
                found[d][p] = (edits, max(b - start, 0))


def _gram_keys(stream: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
    """Hash keys of the ``q`` words from each place on."""
    key = np.full(len(at), q, np.uint64)
    for j in range(q):
        key = (key ^ stream[at + j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def _pieces(coded: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length (at most 6 words), the sorted keys of all pieces with the place of their item and their offset in it."""
    by: dict[int, list[tuple[int, int, np.ndarray]]] = {}
    for place, item in enumerate(coded):
        if len(item) >= MIN_WORDS:
            n = int(EDITS * len(item)) + 1
            q = len(item) // n
            by.setdefault(q, []).extend((place, i * q, item[i * q : i * q + q]) for i in range(n))
    out = {}
    for q, rows in sorted(by.items()):
        words_of = np.concatenate([w for _, _, w in rows])
        keys = _gram_keys(words_of, np.arange(len(rows)) * q, q)
        order = np.argsort(keys, kind="stable")
        out[q] = keys[order], np.array([p for p, _, _ in rows])[order], np.array([o for _, o, _ in rows])[order]
    return out


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    return keys[order], order


def _grid(length: int) -> int:
    """Window of an item: its own length, from 40 words on a step of a grid not above it."""
    if length <= 40:
        return length
    step = 40.0
    while step * 1.04 <= length:
        step *= 1.04
    return int(step)


_HIT = "array<struct<item_id:long,word:long,edits:long>>"
_ARROW_HIT = pa.list_(pa.struct([("item_id", pa.int64()), ("word", pa.int64()), ("edits", pa.int64())]))


def with_hits(docs: DataFrame, benchmark: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` and ``hits``: item_id, first word and edits of each item held.

    An item of m words is held if some run of words is within
    ``floor(0.15 * m)`` word edits of it; words are lower-case, without
    punctuation. Its best match is reported. Items are broadcast in blocks of
    about ``block_words`` words, so memory is bounded however many there are;
    documents are never shuffled.

    Null and empty texts hold nothing. Items that are null or have no words
    take no part; equal (item_id, text) rows are one item. Empty
    tables give no hits. A column ``hits`` of the input is replaced.
    """
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    words_in_all = items.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    blocks = max(1, ceil(words_in_all / block_words))
    docs = docs.drop("hits").withColumn("hits", F.array().cast(_HIT))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect() if words_in_all else []
        index = Index(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        if index.pieces:
            docs = _searched(docs, docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index)))
    return docs


def _searched(docs: DataFrame, shared) -> DataFrame:
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = cloudpickle.loads(shared.value)
        for batch in batches:
            hits, held, size = [], [], 0
            for text in batch.column(names.index("text")).to_pylist():
                held.append(words(text or ""))
                size += len(held[-1]) + index.pad
                if size > BATCH_WORDS:
                    hits += index.search(held)
                    held, size = [], 0
            hits += index.search(held) if held else []
            before = batch.column(len(names) - 1).to_pylist()
            told = [
                b + [{"item_id": index.ids[p], "word": a, "edits": e} for p, a, e in h] for b, h in zip(before, hits)
            ]
            columns = [batch.column(i) for i in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(told, _ARROW_HIT)], names)

    return docs.mapInArrow(run, docs.schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, item_id, word, edits)``, a row per document and item it holds."""
    found = with_hits(docs.select("doc_id", "text"), benchmark, **options)
    return found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    inner = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)), F.col("text").alias("text"))
    clean = with_hits(inner, benchmark, **options).filter(F.size("hits") == 0)
    return clean.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
