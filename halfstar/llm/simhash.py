"""SimHash near-duplicates, linked through pivot distance tables.

A fingerprint is compared with a fixed family of reference fingerprints: a base
and, for every block of bits, the base with that block flipped. The table of
distances to them gives, per block, a coordinate ``c = (d(base) + |block| -
d(flipped)) / 2``, the number of bits in which the fingerprint leaves the base
inside the block. A coordinate changes by at most one per differing bit, and
coordinates of disjoint blocks add up, hence:

* two fingerprints with at most r differing bits differ in at most r
  coordinates, so among r + 2 groups of coordinates two agree wholly. The pairs
  of groups are bucket keys, and every link shares a bucket;
* inside a bucket a pair is discarded as soon as a table coordinate (distance
  to one reference) differs by more than r, and survivors are verified by
  their exact Hamming distance.

A wide fingerprint has references of its own per 64-bit word. Bands of coordinates
of one-bit blocks are its bucket keys; there no single reference tells rows apart at
so large a radius, so a pair is discarded once the differences of all coordinates of
two-bit blocks add up to more than r.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from halfstar.llm.common import key_text, map_batches, row_key, utf8
from halfstar.llm.components import components
from halfstar.session import discard, freed_shuffles, materialise

#: Fixed value: seed of the shingle hash and of the base reference.
SEED = 42
BLOCK_BITS = 2
#: Wide fingerprints whose distance table is held at once.
TABLE_ROWS = 1024
#: Rows of one bucket that one task compares; a larger bucket is cut into pairs of parts.
BUCKET_ROWS = 20_000
#: Rows of one group whose shingle sets one task compares, and the bytes up to which a set is one row.
GROUP_ROWS, ROW_BYTES = 4_000, 8_192
#: Texts of at most so many shingles are also compared by exact joins: few votes make fingerprints differ more.
SHORT = 125
#: One text of so many is asked which shingles are frequent, and texts of those that make a shingle frequent.
ASKED, FREQUENT = 32, 8
#: Shingles hashed at once; bounds the memory of a very long text.
SHINGLES = 1 << 16

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)
_ODD = np.array([2 * _hash(b"lane%d" % i) + 1 & (1 << 64) - 1 for i in range(64)], np.uint64)


def _lanes(h: np.ndarray, lanes: int) -> np.ndarray:
    """``lanes`` 64-bit words per hash: the hash itself, then mixed copies."""
    out = np.empty((len(h), lanes), np.uint64)
    out[:, 0] = h
    for i in range(1, lanes):
        x = (h ^ _ODD[i]) * _ODD[i - 1]
        out[:, i] = x ^ (x >> np.uint64(29))
    return out


def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of a text, repeats included, part by part."""
    words = text.lower().split()  # ASCII only, as bytes
    if not words:
        return
    if len(words) < shingle:
        yield np.array([_hash(b" ".join(words))], np.uint64)
        return
    for start in range(0, len(words) - shingle + 1, SHINGLES):
        part = words[start : start + SHINGLES + shingle - 1]
        yield np.fromiter(map(_hash, map(b" ".join, zip(*(part[i:] for i in range(shingle))))), np.uint64)


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """The distinct hashes, sorted."""
    parts = list(shingle_hashes(text, shingle))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def fingerprint(text: bytes, shingle: int, lanes: int, distinct: np.ndarray | None = None) -> bytes:
    """Big-endian fingerprint of ``64 * lanes`` bits, of the ``distinct`` shingles if given; no word gives zeros."""
    counts, n = np.zeros(64 * lanes, np.int64), 0
    for h in shingle_hashes(text, shingle) if distinct is None else [distinct]:
        n += len(h)
        for i in range(0, len(h), 4096):
            block = _lanes(h[i : i + 4096], lanes).astype(">u8").view(np.uint8).reshape(-1, 8 * lanes)
            counts += np.unpackbits(block, axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * counts > n).tobytes()


def fingerprints(
    docs: DataFrame, shingle: int, lanes: int = 1, *, key: Column | None = None, similarity: float | None = None
) -> DataFrame:
    """``(key, fp)`` per row of ``docs``, fp binary, of the shingles as a set if ``similarity`` is given.

    Then also ``few``, the shingles of a text with few; ``size``, how many there are; ``first``, as many
    of them as texts of that similarity must have one of in common; ``late``, how many of these are frequent;
    and ``parity`` of all of them.
    """
    key = F.col("doc_id") if key is None else key
    source = docs.select(key.alias("key"), "text")
    kind = source.schema["key"].dataType.simpleString()
    if similarity is None:

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = pa.array([fingerprint(t, shingle, lanes) for t in utf8(batch.column("text"))], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column("key"), fps], ["key", "fp"])

        return map_batches(source, make, f"key {kind}, fp binary")
    frequent = frequent_shingles(docs, shingle)
    names = ["fp", "few", "size", "first", "late", "parity"]
    kinds = [pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.int32(), pa.binary()]

    def told(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in names]
        for t in utf8(batch.column("text")):
            distinct = shingle_set(t, shingle)
            s = _narrow(distinct)
            first, late = _first(s, *frequent, similarity)
            values = fingerprint(t, shingle, lanes, distinct), _few(t, shingle, s), len(s), first.tobytes(), late, _parity(s).tobytes()
            for column, value in zip(columns, values):
                column.append(value)
        return pa.RecordBatch.from_arrays([batch.column("key"), *map(pa.array, columns, kinds)], ["key", *names])

    return map_batches(source, told, f"key {kind}, fp binary, few array<long>, size int, first binary, late int, parity binary")


def _narrow(shingles: np.ndarray) -> np.ndarray:
    """The distinct shingles, cut like those of the exact check."""
    return np.unique((shingles >> np.uint64(32)).astype(np.uint32))


def _few(text: bytes, shingle: int, narrow: np.ndarray) -> list[int] | None:
    """The shingles of a text with at most ``SHORT``."""
    if not text or len(text.split(None, SHORT + shingle)) > SHORT + shingle - 1:
        return None
    return narrow.astype(np.int64).tolist() or None


def frequent_shingles(docs: DataFrame, shingle: int, most: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and their ranks, rarer ones first, by a share of the different texts.

    They only serve to put what is frequent last in an order; any order gives the same links.
    """
    mark = F.xxhash64("text")
    asked = docs.select("text", mark.alias("mark")).filter(F.pmod("mark", F.lit(ASKED)) == 0).dropDuplicates(["mark"])

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_narrow(shingle_set(t, shingle)) for t in utf8(batch.column("text"))]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64))], ["s"])

    counted = map_batches(asked.select("text"), sets, "s long").groupBy("s").agg(F.count("*").alias("n"))
    found = counted.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "s").limit(most).collect()
    values = np.array([r["s"] for r in reversed(found)], np.uint32)
    order = np.argsort(values)
    return values[order], order


def _first(narrow: np.ndarray, frequent: np.ndarray, rank: np.ndarray, similarity: float) -> tuple[np.ndarray, int]:
    """So many shingles that any set with ``similarity`` of the union in common has one of them among its own first ones.

    The order is the same for all texts: by value, but frequent ones last; of these there are so many.
    """
    n = len(narrow)
    most = n - ceil(similarity * n - 1e-9) + 1 if n else 0
    if not len(frequent):
        return narrow[:most], 0
    at = np.minimum(np.searchsorted(frequent, narrow), len(frequent) - 1)
    late = frequent[at] == narrow
    ordered = np.concatenate([narrow[~late], narrow[late][np.argsort(rank[at[late]])]])
    return ordered[:most], max(0, most - int((~late).sum()))


def _parity(narrow: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls into each of so many classes, two or more per shingle, packed.

    Two sets differ in at least as many elements as their parities do.
    """
    classes = 1 << max(6, (2 * len(narrow) - 1).bit_length())
    odd = np.bincount(narrow & np.uint32(classes - 1), minlength=classes) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def _differ(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the elements in which two sets differ, by their parities."""
    if len(x) > len(y):
        x, y = y, x
    while len(y) > len(x):  # the same parity over half as many classes
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


# --- buckets ------------------------------------------------------------------------


def _words(fps: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(fps), ">u8").astype(np.uint64).reshape(len(fps), -1)


def _masks(block_bits: int) -> np.ndarray:
    ones = (1 << block_bits) - 1
    return np.array([ones << s for s in range(0, 64, block_bits)], np.uint64)


BASE = np.uint64(_hash(b"base"))


def pivot_table(words: np.ndarray, block_bits: int = BLOCK_BITS) -> np.ndarray:
    """Distances to the references, one row per fingerprint: the base, then a flipped block each.

    Of a wide fingerprint every 64-bit word has references of its own.
    """
    away = words ^ BASE
    masks = _masks(block_bits)
    flipped = np.bitwise_count(away[:, :, None] ^ masks).astype(np.int16)
    base = np.bitwise_count(away).astype(np.int16)
    return np.concatenate([base[:, :, None], flipped], axis=2).reshape(len(words), -1)


def coordinates(table: np.ndarray, block_bits: int = BLOCK_BITS) -> np.ndarray:
    """Bits per block in which a fingerprint leaves the base, out of the distance table."""
    refs = 64 // block_bits + 1
    t = table.reshape(len(table), -1, refs)
    return ((t[:, :, :1] + block_bits - t[:, :, 1:]) // 2).reshape(len(table), -1)


def _complete_keys(words: np.ndarray, radius: int) -> list[np.ndarray]:
    """Two of radius + 2 groups of coordinates agree for every link."""
    c = coordinates(pivot_table(words)).astype(np.int64)
    groups = np.array_split(np.arange(c.shape[1]), radius + 2)
    keys = []
    for pair in combinations(range(len(groups)), 2):
        key = np.zeros(len(words), np.int64)
        for g in pair:
            for j in groups[g]:
                key = key * (BLOCK_BITS + 1) + c[:, j]
        keys.append(key)
    return keys


def _band_keys(words: np.ndarray, band_bits: int) -> list[np.ndarray]:
    """One key per band of coordinates of one-bit blocks, out of the distance table."""
    digits = 1 << np.arange(band_bits, dtype=np.int64)
    made = [np.zeros((0, words.shape[1] * 64 // band_bits), np.int64)]
    for at in range(0, len(words), TABLE_ROWS):
        c = coordinates(pivot_table(words[at : at + TABLE_ROWS], 1), 1)
        made.append(c.reshape(len(c), -1, band_bits) @ digits)
    return list(np.concatenate(made).T)


def _unary(words: np.ndarray) -> np.ndarray:
    """Coordinates of two-bit blocks, out of the distance table, as digits 00, 01, 11 of as many words.

    The bits in which two rows differ are the sum of the differences of their coordinates.
    """
    made = [np.zeros((0, words.shape[1]), np.uint64)]
    for at in range(0, len(words), TABLE_ROWS):
        c = coordinates(pivot_table(words[at : at + TABLE_ROWS]))
        made.append(np.packbits(np.stack([c > 1, c > 0], axis=2).reshape(len(c), -1), axis=1).view(np.uint64))
    return np.concatenate(made)


def _bucket_rows(distinct: DataFrame, radius: int, band_bits: int | None, carried: int) -> DataFrame:
    """``(band, bucket, node, fp)``; of a wide fingerprint the first ``carried`` words go along."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column("fp").to_pylist()
        words = _words(fps)
        keys = _band_keys(words, band_bits) if band_bits else _complete_keys(words, radius)
        n, k = len(fps), len(keys)
        fp = [x[: 8 * carried] for x in fps] if words.shape[1] > carried else fps
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(k, dtype=np.int32), n)),
                pa.array(np.concatenate(keys)),
                pa.array(np.tile(batch.column("node").to_numpy(), k)),
                pa.array(fp * k, pa.binary()),
            ],
            ["band", "bucket", "node", "fp"],
        )

    return map_batches(distinct.select("node", "fp"), make, "band int, bucket long, node long, fp binary")


def _parts(rows: DataFrame, most: int) -> DataFrame:
    """Add ``part``: 0, or for a bucket of more than ``most`` rows one of its pairs of parts.

    Every pair of rows of such a bucket meets in some pair of parts, so no task
    holds more than about twice ``most`` rows of it and no link is lost. A row
    of more than ``ROW_BYTES`` counts as several.
    """
    weight = F.greatest(F.lit(1), F.ceil(F.length("fp") / ROW_BYTES))
    hot = materialise(
        rows.groupBy("band", "bucket").agg(F.sum(weight).alias("n")).filter(F.col("n") > most), "simhash-hot"
    )
    if hot.isEmpty():
        return rows.withColumn("part", F.lit(0).cast("long"))
    parts = F.ceil(F.col("n") / most).cast("long")
    own = F.pmod(F.xxhash64("node"), parts)
    spread = rows.join(hot, ["band", "bucket"], "left").withColumn(
        "other", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), parts - 1)))
    )
    pair = F.least(own, "other") * parts + F.greatest(own, "other")
    return spread.select(*rows.columns, F.coalesce(pair, F.lit(0).cast("long")).alias("part"))


class _Bucket:
    """Compares the rows of one partition, bucket by bucket."""

    def __init__(self, words: np.ndarray, radius: int):
        self.words, self.radius = words, radius
        self.wide = words.shape[1] > 1
        self.table = _unary(words) if self.wide else pivot_table(words)

    def distances(self, left, right) -> np.ndarray:
        """Differing bits of the pairs, or more than the radius; ``left`` may be one row.

        A pair is discarded once the distances to one reference differ by more
        than the radius, of a wide fingerprint once all its coordinates together do.
        """
        t, r = self.table, self.radius
        if self.wide:
            keep = np.flatnonzero(np.bitwise_count(t[left] ^ t[right]).sum(-1, dtype=np.int32) <= r)
            return self._verified(left, right, keep)
        keep = np.flatnonzero(np.abs(t[left, 0] - t[right, 0]) <= r)
        first = left if np.isscalar(left) else left[keep]
        keep = keep[np.abs(t[first] - t[right[keep]]).max(-1, initial=0) <= r]
        return self._verified(left, right, keep)

    def _verified(self, left, right, keep: np.ndarray) -> np.ndarray:
        """The exact distance of the pairs at ``keep``, more than the radius for the others."""
        first = left if np.isscalar(left) else left[keep]
        out = np.full(len(right), self.radius + 1, np.int32)
        out[keep] = np.bitwise_count(self.words[first] ^ self.words[right[keep]]).sum(-1, dtype=np.int32)
        return out

    def _from(self, row: int, others: np.ndarray) -> np.ndarray:
        parts = [self.distances(row, others[i : i + (1 << 16)]) for i in range(0, len(others), 1 << 16)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def spanning(self, lo: int, hi: int) -> list[tuple[int, int, int]]:
        """(row, row, distance): a spanning forest of the bucket's links that prefers short ones.

        At any distance up to the radius it connects what the links up to that
        distance connect, with fewer links than rows.
        """
        n = hi - lo
        if n <= 1024:
            found, pairs = [], n * (n - 1) // 2
            first, second = np.triu_indices(n, 1)
            for i in range(0, pairs, 1 << 16):
                a, b = first[i : i + (1 << 16)] + lo, second[i : i + (1 << 16)] + lo
                d = self.distances(a, b)
                ok = d <= self.radius
                found.append(np.stack([a[ok], b[ok], d[ok]]))
            links = np.concatenate(found, axis=1)
            if links.shape[1] <= 8 * n:
                return _forest(links)
        return self._grown(lo, hi)

    def _grown(self, lo: int, hi: int) -> list[tuple[int, int, int]]:
        """The forest grown row by row, for buckets with many rows or many links."""
        todo = np.arange(lo + 1, hi)
        near, parent = self._from(lo, todo), np.full(len(todo), lo)
        found = []
        while len(todo):
            at = int(near.argmin())
            row, d = int(todo[at]), int(near[at])
            if d <= self.radius:
                found.append((int(parent[at]), row, d))
            rest = np.arange(len(todo)) != at
            todo, near, parent = todo[rest], near[rest], parent[rest]
            closer = self._from(row, todo)
            better = closer < near
            near[better], parent[better] = closer[better], row
        return found

    def links(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Links as columns (row, row, distance): of small buckets all, of larger ones a forest."""
        out = [np.zeros((3, 0), np.int64)]
        size = ends - starts
        small = size <= 8
        for offset in range(1, 8):
            runs = small & (size > offset)
            if not runs.any():
                break
            s, n = starts[runs], size[runs] - offset
            at = np.repeat(s - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            for i in range(0, len(at), 1 << 16):
                row = at[i : i + (1 << 16)]
                d = self.distances(row, row + offset)
                ok = d <= self.radius
                out.append(np.stack([row[ok], row[ok] + offset, d[ok]]))
        for s, e in zip(starts[~small].tolist(), ends[~small].tolist()):
            if found := self.spanning(s, e):
                out.append(np.array(found).T)
        return np.concatenate(out, axis=1)


class _Forest:
    """Union-find."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = self.root
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        ra, rb = self.find(a), self.find(b)
        self.root[max(ra, rb)] = min(ra, rb)
        return ra != rb


def _forest(links: np.ndarray) -> list[tuple[int, int, int]]:
    """Of the links (row, row, distance), shortest first, those that join two trees."""
    forest = _Forest()
    ordered = links[:, np.argsort(links[2], kind="stable")].T.tolist()
    return [(a, b, d) for a, b, d in ordered if forest.join(a, b)]


def _by_bucket(rows: DataFrame, keys: tuple[str, ...], others: tuple[str, ...], make, schema: str) -> DataFrame:
    """``make(table, starts, ends)`` over the buckets of several rows, each whole in one call."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                rest = table if rest is None else pa.concat_tables([rest, table])
            if rest is None or not rest.num_rows:
                continue
            at = np.stack([rest.column(c).to_numpy().astype(np.int64) for c in keys])
            new = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1
            bounds = np.concatenate([[0], new, [rest.num_rows]])
            done = bounds[-1] if batch is None else bounds[-2]
            if not done:
                continue
            starts, ends = bounds[:-1], bounds[1:]
            several = (ends - starts > 1) & (ends <= done)
            if several.any():
                yield make(rest, starts[several], ends[several])
            rest = rest.slice(done)

    dealt = rows.select(*keys, *others).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)


def _bucket_links(rows: DataFrame, radius: int, sure: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``(a, b, d)``: node pairs with their distance that span the links of every bucket.

    With ``sure`` also ``(bucket, node)``: what a forest joins by an edge of more
    bits, if these are more than two rows. Such an edge may fail the exact check,
    so each pair of the group has to be looked at, not the edges alone.
    """

    def make(rest: pa.Table, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        a, b, d = _Bucket(_words(rest.column("fp").to_pylist()), radius).links(starts, ends)
        node = rest.column("node").to_numpy()
        columns = [[node[a]], [node[b]], [d]]
        for own in _trees(a, b, d, sure) if sure is not None else ():
            nodes = np.sort(node[own])
            columns[0].append(np.full(len(own), np.uint64(_hash(nodes.tobytes())).astype(np.int64)))
            columns[1].append(nodes)
            columns[2].append(np.full(len(own), -1))
        a, b, d = (np.concatenate(c) for c in columns)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(d.astype(np.int32))], ["a", "b", "d"])

    found = _by_bucket(rows, ("band", "bucket", "part"), ("node", "fp"), make, "a long, b long, d int")
    groups = None
    if sure is not None:
        found = materialise(found, "simhash-found")
        groups = found.filter("d < 0").select(F.col("a").alias("bucket"), F.col("b").alias("node")).distinct()
        found = found.filter("d >= 0")
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    return found.select(*ends, "d").groupBy("a", "b").agg(F.min("d").alias("d")), groups


def _trees(a: np.ndarray, b: np.ndarray, d: np.ndarray, sure: int) -> list[list[int]]:
    """The rows of each tree of more than two rows that has an edge of more than ``sure`` bits."""
    forest = _Forest()
    for x, y in zip(a.tolist(), b.tolist()):
        forest.join(x, y)
    doubtful = {forest.find(x) for x in a[d > sure].tolist()}
    trees: dict[int, list[int]] = {}
    for x in np.unique(np.concatenate([a, b])).tolist():
        if (r := forest.find(x)) in doubtful:
            trees.setdefault(r, []).append(x)
    return [t for t in trees.values() if len(t) > 2]


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


# --- exact similarity -----------------------------------------------------------------


def _sets(docs: DataFrame, distinct: DataFrame, key: Column, nodes: DataFrame, shingle: int) -> DataFrame:
    """``(node, s)``: the distinct shingles of ``nodes(node)``."""
    asked = distinct.join(nodes, "node").select(key_text(F.col("least")).alias("__k"), "node")
    texts = docs.select(key_text(key).alias("__k"), "text").join(asked, "__k").dropDuplicates(["node"]).select("node", "text")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(shingle_set(t, shingle) >> np.uint64(32)).astype(np.uint32).tobytes() for t in utf8(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], ["node", "s"])

    known = map_batches(texts, sets, "node long, s binary")
    return materialise(known, "simhash-sets")


def _verified(links: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """The ``links(a, b)`` whose sets ``known(node, s)`` have ``similarity`` of their shingles in common."""

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
            x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
            both = len(np.intersect1d(x, y))
            keep.append(both >= similarity * (len(x) + len(y) - both))
        chosen = pa.array(keep, pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(c).filter(chosen) for c in ("a", "b")], ["a", "b"])

    sides = [known.select(F.col("node").alias(c), F.col("s").alias(f"s{c}")) for c in ("a", "b")]
    return map_batches(links.join(sides[0], "a").join(sides[1], "b").select("a", "b", "sa", "sb"), compare, "a long, b long")


def _checked(
    docs: DataFrame, distinct: DataFrame, key: Column, links: DataFrame, groups: DataFrame, shingle: int, similarity: float, sure: int
) -> DataFrame:
    """Links by exact similarity; those up to ``sure`` bits are beyond doubt.

    First the links themselves, then what they leave apart in a group: there
    every pair of different components is compared, inside the task. Last, what
    is still apart and shares one of its first shingles, whatever its bits.
    """
    links = materialise(links, "simhash-links")
    certain = links.filter(F.col("d") <= sure).select("a", "b")
    doubt = links.filter(F.col("d") > sure).select("a", "b")
    joined = components(certain)
    doubt = materialise(_apart(doubt, joined), "simhash-doubt")
    nodes = doubt.select(F.explode(F.array("a", "b")).alias("node"))
    groups = materialise(groups.unionByName(_short_groups(distinct, similarity)), "simhash-groups")
    open_groups = _open(groups, joined)
    nodes = materialise(nodes.unionByName(open_groups.select("node")).distinct(), "simhash-asked")
    if nodes.isEmpty():
        return _completed(docs, distinct, key, certain, joined, shingle, similarity)
    known = _sets(docs, distinct, key, nodes, shingle)
    held = materialise(certain.unionByName(_verified(doubt, known, similarity)), "simhash-held")
    rows = _open(groups, components(held)).join(known.withColumnRenamed("s", "fp"), "node")
    rows = materialise(rows.withColumn("band", F.lit(0)), "simhash-group-rows")
    held = materialise(held.unionByName(_group_links(_parts(rows, GROUP_ROWS), similarity)), "simhash-held")
    discard(links, doubt, groups, nodes, known, rows)
    return _completed(docs, distinct, key, held, components(held), shingle, similarity)


def _completed(
    docs: DataFrame, distinct: DataFrame, key: Column, held: DataFrame, joined: DataFrame, shingle: int, similarity: float
) -> DataFrame:
    """``held`` and the links between its components ``joined`` that no bucket or group has shown."""
    shown = materialise(_candidates(distinct, joined, similarity), "simhash-candidates")
    more = materialise(_likely(shown, distinct, similarity), "simhash-likely")
    asked = materialise(more.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "simhash-asked")
    if asked.isEmpty():
        return held
    known = _sets(docs, distinct, key, asked, shingle)
    found = materialise(held.unionByName(_verified(more, known, similarity)), "simhash-completed")
    discard(shown, more, asked, known)
    return found


def _likely(pairs: DataFrame, distinct: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs(a, b)`` but those whose parities show that they differ too much."""

    def near(batch: pa.RecordBatch) -> pa.RecordBatch:
        most = (1 - similarity) / (1 + similarity) * batch.column("sizes").to_numpy() + 1e-9
        sides = zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist())
        found = [_differ(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in sides]
        chosen = pa.array(np.array(found) <= most)
        return pa.RecordBatch.from_arrays([batch.column(c).filter(chosen) for c in ("a", "b")], ["a", "b"])

    told = [distinct.select(F.col("node").alias(c), F.col("size").alias(f"n{c}"), F.col("parity").alias(f"p{c}")) for c in ("a", "b")]
    both = pairs.join(told[0], "a").join(told[1], "b").select("a", "b", (F.col("na") + F.col("nb")).alias("sizes"), "pa", "pb")
    return map_batches(both, near, "a long, b long")


def _apart(links: DataFrame, joined: DataFrame) -> DataFrame:
    ends = [joined.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in ("a", "b")]
    both = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
    return both.filter(~F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))).select("a", "b")


def _open(groups: DataFrame, joined: DataFrame) -> DataFrame:
    """``(bucket, node, component)`` of the groups that hold several components."""
    told = groups.join(joined, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    several = told.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y")
    return told.join(several.select("bucket"), "bucket", "left_semi")


def _short_groups(distinct: DataFrame, similarity: float) -> DataFrame:
    """``(bucket, node)``: texts of few shingles by the rarest of these, a bucket per shingle.

    Sets that share ``similarity`` of their union have a common element among
    the first ``n - ceil(similarity * n) + 1`` of each in any one order, so no
    pair is missed; rare shingles first keep the buckets small.
    """
    few = distinct.filter("few is not null").select("node", F.explode("few").alias("s"))
    count = few.groupBy("s").agg(F.count("*").alias("n")).filter("n > 1")
    # a shingle of one text alone opens no bucket, but takes its place in the order
    own = few.join(count, "s", "left").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "s"))).alias("own")
    )
    first = F.size("own") - F.ceil(F.size("own") * similarity - 1e-9).cast("int") + 1
    rows = own.select("node", F.explode(F.slice("own", F.lit(1), first)).alias("e")).filter("e.n > 1")
    return rows.select(F.col("e.s").cast("long").alias("bucket"), "node")


def _candidates(distinct: DataFrame, joined: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: all nodes of different components that can reach ``similarity``, by their first shingles.

    Two sets of that similarity have a common element among the first of both; from the places of the
    earliest one on, both must hold as many elements as the similarity asks for. Pairs of texts with few
    shingles are left to their own joins.
    """
    kept = distinct.filter("size > 0").select("node", "size", "first", "late", F.col("few").isNotNull().alias("short"))
    told = kept.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def rows(frequent: bool) -> DataFrame:
        def explode(batch: pa.RecordBatch) -> pa.RecordBatch:
            first = [np.frombuffer(x, np.uint32) for x in batch.column("first").to_pylist()]
            n, late = np.array([len(x) for x in first]), batch.column("late").to_numpy()
            n, skipped = (late, n - late) if frequent else (n - late, 0 * n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(skipped, n)
            bucket = np.concatenate([x[s : s + k] for x, s, k in zip(first, skipped.tolist(), n.tolist())])
            size, short = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64), n) for c in ("size", "short"))
            told = [pa.array(np.repeat(batch.column(c).to_numpy(), n)) for c in ("node", "component")]
            columns = [pa.array(bucket.view(np.int32)), *told, pa.array(size << 32 | place << 1 | short)]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "node", "component", "told"])

        return map_batches(told, explode, "bucket int, node long, component long, told long")

    def make(table: pa.Table, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        node, component, told = (table.column(c).to_numpy() for c in ("node", "component", "told"))
        size, short = told >> 32, (told & 1).astype(bool)
        left = size - (told >> 1 & (1 << 31) - 1)
        found = [np.zeros((2, 0), np.int64)]

        def keep(a: np.ndarray, b: np.ndarray) -> None:
            ok = component[a] != component[b]
            ok &= ~(short[a] & short[b])
            ok &= np.minimum(left[a], left[b]) >= (similarity / (1 + similarity) * (size[a] + size[b]) - 1e-9)
            found.append(np.stack([node[a[ok]], node[b[ok]]]))

        several = ends - starts
        for offset in range(1, int(min(several.max(), 64))):
            s, n = starts[several > offset], several[several > offset] - offset
            a = np.repeat(s - (np.cumsum(n) - n), n) + np.arange(n.sum())
            for i in range(0, len(a), 1 << 16):
                keep(a[i : i + (1 << 16)], a[i : i + (1 << 16)] + offset)
        for lo, hi in zip(starts[several > 64].tolist(), ends[several > 64].tolist()):
            if component[lo:hi].min() == component[lo:hi].max():
                continue
            for a in range(lo, hi - 64):
                keep(np.full(hi - a - 64, a), np.arange(a + 64, hi))
        a, b = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    alone, shared = rows(False), _parts(rows(True).withColumns({"band": F.lit(0), "fp": F.lit(b"")}), BUCKET_ROWS)
    found = _by_bucket(alone, ("bucket",), ("node", "component", "told"), make, "a long, b long")
    return found.unionByName(_by_bucket(shared, ("bucket", "part"), ("node", "component", "told"), make, "a long, b long")).distinct()


def _group_links(rows: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: links by exact similarity that join what is apart in a group, a forest of each."""

    def make(table: pa.Table, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
        found = []
        for lo, hi in zip(starts.tolist(), ends.tolist()):
            sets = [np.frombuffer(x, np.uint32) for x in table.column("fp").slice(lo, hi - lo).to_pylist()]
            found += [(node[lo + i], node[lo + j]) for i, j in similar(sets, component[lo:hi], similarity)]
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return _by_bucket(rows, ("bucket", "part"), ("node", "fp", "component"), make, "a long, b long").distinct()


def similar(sets: list[np.ndarray], component: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs that share ``similarity`` of their union and join what ``component`` and earlier pairs leave apart."""
    size = np.array([len(x) for x in sets])
    stop = np.cumsum(size)
    start = stop - size
    distinct, code = np.unique(np.concatenate(sets), return_inverse=True)
    label = np.unique(component, return_inverse=True)[1]
    own, found = np.zeros(len(distinct), bool), []
    for i in range(len(sets) - 1):
        if (label[i + 1 :] == label[i]).all():
            continue
        own[code[start[i] : stop[i]]] = True
        below = np.concatenate([[0], np.cumsum(own[code[stop[i] :]], dtype=np.int64)])
        both = below[stop[i + 1 :] - stop[i]] - below[start[i + 1 :] - stop[i]]
        own[code[start[i] : stop[i]]] = False
        for j in (np.flatnonzero(both >= similarity * (size[i] + size[i + 1 :] - both)) + i + 1).tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                found.append((i, j))
    return found


# --- the operator ---------------------------------------------------------------------


def grouped(
    docs: DataFrame,
    *,
    shingle: int = 3,
    lanes: int = 1,
    radius: int = 2,
    band_bits: int | None = None,
    carried: int = 1,
    similarity: float | None = None,
    sure: int = 0,
    bucket_rows: int = BUCKET_ROWS,
    key: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(key, fp, node)`` per row of ``docs(doc_id, text)``, and ``(node, component, least)`` per node.

    With ``lanes=1`` and no bands, fingerprints have 64 bits and link at
    ``radius`` or fewer differing bits; the buckets find every such link. With
    more lanes and ``band_bits`` set, the fingerprint is wide, a link needs one
    band in which both agree, and ``radius`` counts bits of the first
    ``carried`` words. With ``similarity`` the shingles are taken as a set, and
    a link of more than ``sure`` bits holds only if the texts share that part
    of their shingles, which every pair of a bucket's group is asked until it is
    joined; and whatever their fingerprints, texts of at most ``SHORT`` shingles are
    compared by exact joins, others if they share one of the shingles that such a
    pair must share. ``key`` must then be ``row_key``. ``component`` is
    shared by all nodes that links connect, ``least`` is the smallest key of a node.

    Equal fingerprints are one node, so copies cost one row however many there
    are. Null and empty texts have the zero fingerprint and link like any other.
    Null, repeated or tied keys are kept as they are. An empty table gives none.
    """
    with freed_shuffles(docs.sparkSession):
        return _grouped(docs, shingle, lanes, radius, band_bits, carried, similarity, sure, bucket_rows, key)


def _grouped(docs, shingle, lanes, radius, band_bits, carried, similarity, sure, bucket_rows, key) -> tuple[DataFrame, DataFrame]:
    made = fingerprints(docs, shingle, lanes, key=key, similarity=similarity)
    fps = materialise(made.withColumn("node", F.xxhash64("fp")), "simhash-fp")
    least = F.col("key")
    if isinstance(fps.schema["key"].dataType, StructType):  # null ids last
        least = F.struct(F.col("key.id").isNull().alias("none"), F.col("key.id").alias("id"), F.col("key.h").alias("h"))
    few = [F.first(c).alias(c) for c in ("few", "size", "first", "late", "parity")] if similarity is not None else []
    distinct = fps.groupBy("node").agg(F.first("fp").alias("fp"), F.min(least).alias("least"), *few)
    fps = fps.select("key", "fp", "node")
    distinct = materialise(distinct, "simhash-nodes")
    rows = _bucket_rows(distinct, radius, band_bits, carried)
    links, groups = _bucket_links(_parts(rows, bucket_rows), radius, None if similarity is None else sure)
    if groups is not None:
        links = _checked(docs, distinct, key, links, groups, shingle, similarity, sure)
    found = components(links.select("a", "b"))
    members = distinct.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "least")
    return fps, materialise(members, "simhash-members")


def near_groups(docs: DataFrame, **options) -> DataFrame:
    """``(key, fp, node, component)`` per row of ``docs``; see ``grouped``."""
    fps, members = grouped(docs, **options)
    return fps.join(members.drop("least"), "node")


def simhash_components(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: component_id is the smallest doc_id reachable.

    Ids that are null take no part in that minimum; where a whole component has
    none, component_id is null. Other columns of ``docs`` are not read.
    """
    fps, members = grouped(docs, **options)
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    told = members.join(smallest, "component").select("node", "component_id")
    return fps.join(told, "node").select(
        F.col("key").alias("doc_id"), F.lower(F.hex("fp")).alias("fingerprint"), "component_id"
    )


#: Stage values: 64 bands of 16 bits, 512 bits compared. Texts with a shingle similarity of 0.8
#: differ in 78 of them on average (standard deviation 8), unrelated texts in 256. A pair at 0.8
#: shares a band with a probability of 0.99, and the radius lies six deviations above its mean; up to 44 bits (four deviations) its similarity is beyond doubt.
STAGE = {"shingle": 5, "lanes": 16, "radius": 128, "band_bits": 16, "carried": 8, "similarity": 0.8, "sure": 44}


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each group stays: that with the smallest doc_id (nulls last).

    Empty texts are one group. Rows equal in id, source and text count as one
    document and one of them stays. All columns of ``docs`` are returned.
    """
    _, members = grouped(docs, **{**STAGE, **options}, key=row_key(docs))
    kept = members.groupBy("component").agg(F.min("least").alias("k")).select(key_text(F.col("k")).alias("__key"))
    marked = docs.withColumn("__key", key_text(row_key(docs)))
    return marked.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)
