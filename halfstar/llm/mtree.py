"""Exact top-k by inner product, searched best-first in M-trees.

Inner products become distances by one more component: a vector v gets
``sqrt(M - |v|^2)``, M the largest squared norm, a query gets 0. Then
``|q - v|^2 = |q|^2 + M - 2 <q, v>`` is a metric in which the nearest vectors
are those of the largest inner product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halfstar.session import materialise

SCALE = 1024
#: Vectors that split the space into regions: those whose ids have the smallest hashes.
REGIONS = 64
#: Entries of a page, vectors of one tree, queries searched together in a tree.
PAGE, TREE_ROWS, QUERY_BLOCK = 64, 20_000, 1_000
#: Room for rounding in comparisons of distances.
SLACK = 1e-6


def quantised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` with whole numbers; rows with a null id or a null or non-finite component are left out."""
    x = F.col(column)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("long"))
    return vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")
    )


def _matrix(rows, width: int) -> np.ndarray:
    """Vectors as rows; a shorter one goes on with zeros."""
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _lift(v: np.ndarray, most: float) -> np.ndarray:
    v = v.astype(float)
    return np.hstack([v, np.sqrt(np.maximum(0.0, most - (v * v).sum(1)))[:, None]])


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(-1))


#: The score of the least long stands for any below it and bounds nothing.
_LEAST = -(2.0**63)


def _room(total, width: int):
    """Room for rounding in a limit of distance, ``total`` the squared norms in it.

    Squares below 2^53 are whole numbers a double holds; beyond, their errors
    grow with them.
    """
    return SLACK + np.where(total < 2**53, 0.0, 8 * np.sqrt((width + 4) * np.finfo(float).eps * total))


def _scores(v: np.ndarray, q: np.ndarray, exact: bool) -> list[int]:
    """Integer inner products, by Python's numbers where a long may not hold them."""
    if exact:
        return (v @ q).tolist()
    least, most = -(1 << 63), (1 << 63) - 1
    return [min(most, max(least, s)) for s in (v.astype(object) @ q.astype(object)).tolist()]


# --- building -------------------------------------------------------------------------


def build_pages(ids: np.ndarray, v: np.ndarray, most: float) -> list[dict]:
    """The pages of one tree, root first.

    A page holds entries with their distance to the page's centre: vectors in a
    leaf, else child pages with their covering radius. A set too large for a
    page is parted around spread seeds; equal vectors are parted by halves.
    """
    lifted, pages = _lift(v, most), []

    def page(rows: np.ndarray, centre: np.ndarray) -> int:
        number = len(pages)
        far = _distances(lifted[rows], centre)
        this = {"page": number, "centre": centre, "radius": float(far.max(initial=0.0)), "leaf": len(rows) <= PAGE}
        pages.append(this)
        if this["leaf"]:
            this |= {"ids": ids[rows], "v": v[rows].ravel(), "to_centre": far, "children": [], "radii": []}
            return number
        seeds = [int(np.argmax(far))]
        nearest = _distances(lifted[rows], lifted[rows[seeds[0]]])
        owner = np.zeros(len(rows), int)
        for n in range(1, min(PAGE, ceil(2 * len(rows) / PAGE))):
            seeds.append(int(np.argmax(nearest)))
            if nearest[seeds[-1]] == 0:
                break
            d = _distances(lifted[rows], lifted[rows[seeds[-1]]])
            owner[d < nearest], nearest = n, np.minimum(d, nearest)
        groups = [rows[owner == n] for n in np.unique(owner)]
        if len(groups) == 1:
            groups = np.array_split(rows, 2)
        centres = [lifted[g].mean(0) for g in groups]
        children = [page(g, c) for g, c in zip(groups, centres)]
        this |= {
            "ids": [], "v": [], "to_centre": [float(_distances(c[None], centre)[0]) for c in centres],
            "children": children, "radii": [pages[c]["radius"] for c in children],
        }
        return number

    if len(ids):
        page(np.arange(len(ids)), lifted.mean(0))
    return pages


_PAGE = (
    "region int, tree int, page int, leaf boolean, centre array<double>, radius double, ids array<long>, "
    "v array<long>, to_centre array<double>, children array<int>, radii array<double>"
)


# --- searching --------------------------------------------------------------------------


class Tree:
    def __init__(self, pages: pd.DataFrame, width: int):
        self.pages = {}
        for p in pages.itertuples(index=False):
            self.pages[p.page] = (
                p.leaf, np.asarray(p.centre, float), p.radius, np.asarray(p.ids, np.int64),
                np.asarray(p.v, np.int64).reshape(-1, width) if p.leaf else None,
                np.asarray(p.to_centre, float), list(p.children), np.asarray(p.radii, float),
            )
        self.largest = max((float(np.abs(p[4].astype(float)).max(initial=0.0)) for p in self.pages.values() if p[0]), default=0.0)
        self.width, self.computed = width, 0

    def search(self, query: int, q: np.ndarray, most: float, k: int, floor: float) -> list[tuple[int, int]]:
        """The k best (score, id) but the query's own row; scores below ``floor`` may be left out.

        Pages are opened by their least possible distance. A child or entry is
        passed over without a computation where the difference of the stored
        distance to the centre and the query's shows it to be too far.
        """
        point = np.append(q.astype(float), 0.0)
        norm = float(point @ point)
        room = float(_room(norm + most, self.width))
        exact = float(np.abs(point).max()) * self.largest * self.width < 2.0**62
        best: list[tuple[int, int]] = []  # (score, -id), the worst first

        def reach() -> float:
            """Distance beyond which nothing can enter the result."""
            score = max(floor, best[0][0]) if len(best) == k else floor
            return sqrt(max(0.0, norm + most - 2 * score)) * (1 + 1e-9) + room if score > _LEAST else np.inf

        root = _distances(point[None], self.pages[0][1])[0]
        queue = [(max(0.0, root - self.pages[0][2]), 0, root)]
        while queue:
            least, number, own = heapq.heappop(queue)
            limit = reach()
            if least > limit:
                break
            leaf, _, _, ids, v, to_centre, children, radii = self.pages[number]
            if leaf:
                near = np.flatnonzero((np.abs(own - to_centre) <= limit) & (ids != query))
                self.computed += len(near)
                for score, i in zip(_scores(v[near], q, exact), ids[near].tolist()):
                    if len(best) < k:
                        heapq.heappush(best, (score, -i))
                    elif (score, -i) > best[0]:
                        heapq.heapreplace(best, (score, -i))
                continue
            for n in np.flatnonzero(np.abs(own - to_centre) - radii <= limit):
                d = _distances(point[None], self.pages[children[n]][1])[0]
                self.computed += 1
                if d - radii[n] <= limit:
                    heapq.heappush(queue, (max(0.0, d - radii[n]), children[n], d))
        return [(s, -i) for s, i in best]


class TopK:
    """An index of ``vectors(vec_id, embedding)``: every valid row, in trees of bounded size.

    Regions around a bounded sample of vectors only decide which tree holds a
    row. A region with many rows is dealt to several trees, so equal vectors,
    however many, fill no task.
    """

    def __init__(self, vectors: DataFrame, column: str = "embedding", regions: int = REGIONS, tree_rows: int = TREE_ROWS):
        rows = materialise(quantised(vectors, column), "mtree-vectors")
        norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
        bounds = rows.agg(F.max(norm).alias("most"), F.max(F.size("v")).alias("width")).first()
        self.rows, self.most, self.width = rows, bounds["most"] or 0.0, bounds["width"] or 0
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(regions).collect()
        self.centres = _lift(_matrix([r["v"] for r in sample], self.width), self.most)
        most, width, centres = self.most, self.width, self.centres

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                points = _lift(_matrix(batch["v"], width), most)
                away = np.stack([_distances(points, c) for c in centres], 1)
                region = away.argmin(1)
                yield batch.assign(region=region.astype(np.int32), away=away[np.arange(len(batch)), region])

        placed = rows.mapInPandas(assign, "vec_id long, v array<long>, region int, away double")
        placed = materialise(placed, "mtree-regions")
        per = placed.groupBy("region").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()  # one row a region
        self.radius = {r["region"]: r["radius"] for r in per}
        self.trees = {r["region"]: ceil(r["n"] / tree_rows) for r in per}

        def build(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("vec_id", kind="stable")
            pages = build_pages(rows["vec_id"].to_numpy(), _matrix(rows["v"], width), most)
            out = pd.DataFrame(pages)
            out.insert(0, "tree", rows["tree"].iloc[0])
            out.insert(0, "region", rows["region"].iloc[0])
            return out[[c.split()[0] for c in _PAGE.split(", ")]]

        dealt = placed.withColumn("tree", F.pmod(F.xxhash64("vec_id", "v"), _per_region(self.trees)).cast("int"))
        self.pages = materialise(dealt.groupBy("region", "tree").applyInPandas(build, _PAGE), "mtree-pages")

    def _found(self, wanted: DataFrame, k: int) -> DataFrame:
        """Search ``wanted(query_id, q, region, floor)``: a query block meets one tree in a task."""
        per = {r["region"]: r["n"] for r in wanted.groupBy("region").agg(F.count("*").alias("n")).collect()}
        if not per:
            return self.rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
        blocks = {r: ceil(n / QUERY_BLOCK) for r, n in per.items()}
        asked = wanted.withColumn("block", F.pmod(F.xxhash64("query_id"), _per_region(blocks)).cast("int")).withColumn(
            "tree", F.explode(F.sequence(F.lit(0), _per_region(self.trees).cast("int") - 1))
        )
        known = self.pages.filter(F.col("region").isin(list(blocks))).withColumn(
            "block", F.explode(F.sequence(F.lit(0), _per_region(blocks).cast("int") - 1))
        )
        most, width = self.most, self.width

        def search(queries: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(queries) and len(pages):
                tree = Tree(pages, width)
                vectors = _matrix(queries["q"], width)
                for query, q, floor in zip(queries["query_id"].tolist(), vectors, queries["floor"].tolist()):
                    out += [(query, i, s) for s, i in tree.search(query, q, most, k, floor)]
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

        keys = ["region", "tree", "block"]
        return asked.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInPandas(
            search, "query_id long, vec_id long, score long"
        )

    def search(self, queries: DataFrame, k: int = 10) -> DataFrame:
        """``(query_id, rank, vec_id, score)``: the k largest integer inner products of each query.

        ``queries(query_id, q)``. Ties go to the smaller vec_id; rows with the
        query's own id are no candidates of it; with fewer candidates all are
        returned. First each query searches its own region, which gives it a
        score to beat; then it visits only regions whose radius allows one at
        least as high.
        """
        most, width, centres, radius = self.most, self.width, self.centres, self.radius

        def regions(batches: Iterator[pd.DataFrame], first: bool) -> Iterator[pd.DataFrame]:
            for batch in batches:
                q = _matrix(batch["q"], width)
                points = np.hstack([q.astype(float), np.zeros((len(q), 1))])
                away = np.stack([_distances(points, centres[r]) for r in radius], 1)
                numbers = np.array(list(radius))
                nearest = away.argmin(1)
                if first:
                    yield batch.assign(region=numbers[nearest].astype(np.int32), floor=-np.inf)
                    continue
                least = np.maximum(0.0, away - np.array([radius[r] for r in radius]))
                norm = (q.astype(float) ** 2).sum(1)
                floor = batch["floor"].to_numpy(float)
                reach = np.sqrt(np.maximum(0.0, norm + most - 2 * np.where(floor > _LEAST, floor, -np.inf)))
                limit = reach * (1 + 1e-9) + _room(norm + most, width)
                visit = ~(least > limit[:, None])
                visit[np.arange(len(q)), nearest] = False
                row, column = np.nonzero(visit)
                yield batch.iloc[row].assign(region=numbers[column].astype(np.int32))[["query_id", "q", "region", "floor"]]

        schema = "query_id long, q array<long>, region int, floor double"
        own = queries.select("query_id", "q").mapInPandas(lambda b: regions(b, True), schema)
        first = materialise(_best(self._found(materialise(own, "mtree-own"), k), k), "mtree-first")
        floor = first.filter(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("floor"))
        asked = queries.select("query_id", "q").join(floor, "query_id", "left").fillna(float("-inf"), ["floor"])
        other = materialise(asked.mapInPandas(lambda b: regions(b, False), schema), "mtree-other")
        return _best(first.drop("rank").unionByName(self._found(other, k)), k)


def _per_region(numbers: dict[int, int]) -> Column:
    """A number of the region of a row, out of a table with one entry per region."""
    pairs = [x for r, n in numbers.items() for x in (F.lit(r), F.lit(n).cast("long"))]
    return F.element_at(F.create_map(*pairs), F.col("region"))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, *, column: str = "embedding", k: int = 10, **options) -> DataFrame:
    """Search the rows of ``vectors`` that ``is_query`` marks against all rows.

    Vectors are scaled by 1024 and rounded down. Vectors of unequal length are
    compared as if the shorter went on with zeros. Components and scores beyond
    a long count as the largest or least long. Null vectors, such with a
    null or non-finite component, and rows without an id take no part. Of
    repeated query ids one row asks; as candidates repeated rows count each.
    Empty tables give none; other columns are not read.
    """
    index = TopK(vectors, column, **options)
    if not index.radius:
        return index.rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = index.rows.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    return index.search(materialise(asked, "mtree-queries"), k)


ORACLE_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as double)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from whole q join whole c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
), ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
