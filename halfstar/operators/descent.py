"""Biased matrix factorisation by blocked stochastic gradient descent.

Users and items are dealt to B blocks each. An epoch is B rounds; in round s user
block b meets item block (b + s) mod B, so that no two tasks share a factor row and
every rating is visited once an epoch. A cell's ratings, its user block and its item
block travel as three rows and meet in one task; item blocks move on to the next
cell. All models of a grid (and all folds) are trained in the same jobs; where blocks
are fewer than cores, the models are dealt to groups that get the ratings each. The state
after an epoch is a written table: one run gives the whole training curve, and
training goes on from any state. Few blocks let one job go through several epochs, whose
sums travel with the state.

A user or item that holds much of all ratings would bind a block to itself. It is
split into copies, dealt by the other side's id, which are averaged by their
ratings after every epoch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfstar.operators.factor import dot
from halfstar.operators.joins import KeyedTable, lookup
from halfstar.operators.split import fold_of
from halfstar.session import discard, freed_shuffles, materialise

# Ship the kernels themselves: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ratings of a cell at most, about; more ratings give more blocks.
ROWS_PER_CELL = 250_000
#: Rounds in one job; longer epochs write their state in between.
ROUNDS_PER_JOB = 8
#: Ratings whose gradients are taken together.
BATCH = 128
_COPIES_FROM = -(1 << 62)
_COPIES_APART = 1 << 20


@dataclass(frozen=True)
class Params:
    """One model: ``fold`` names the fold it does not learn from."""

    rank: int = 20
    rate: float = 0.1
    reg: float = 0.05
    bounds: tuple[float, float] | None = None
    fold: int = -1
    seed: int = 42


_STATE = (
    "kind string, model int, cell int, block int, a binary, b binary, c binary, d binary, e binary, sse double, visited long, penalty double"
)
_NAMES = [c.split()[0] for c in _STATE.split(", ")]
_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
_SCHEMA = pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in _STATE.split(", ")])


def first_vectors(ids: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Small start values that hang on id and seed alone, the same in every partitioning."""
    x = ids.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, rank + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    x += np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) / 2.0**64 - 0.5) / sqrt(rank)


def errors(x: np.ndarray, r: np.ndarray, mean: float, p: Params) -> tuple[np.ndarray, np.ndarray | float]:
    """Rating minus the prediction that the link makes of ``x``, and the slope of the link there."""
    if not p.bounds:
        return r - (mean + x), 1.0
    s = 1 / (1 + np.exp(-x))
    width = p.bounds[1] - p.bounds[0]
    return r - (p.bounds[0] + width * s), width * s * (1 - s)


def visits(u: np.ndarray, i: np.ndarray) -> list[tuple[slice, list[tuple]]]:
    """Batches of ratings with, per side, their rows, the order by row, where each row starts in it, and the rows met.

    They hang on the places of user and item rows alone, so models that learn from the same ratings share them.
    """
    out = []
    for at in range(0, len(u), BATCH):
        part, sides = slice(at, at + BATCH), []
        for rows in (u[part], i[part]):
            order = np.argsort(rows, kind="stable")
            ordered = rows[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            sides.append((rows, order, first, ordered[first]))
        out.append((part, sides))
    return out


def step(users: dict, items: dict, batches: list[tuple[slice, list[tuple]]], r: np.ndarray, mean: float, p: Params) -> float:
    """Visit ratings in the batches of ``visits``; changes the factors, returns the squared errors met.

    The step of a row is ``rate / sqrt(g)``, where g sums its squared gradients: a row
    that is visited often takes short steps, however its ratings fall into batches.
    """
    total = 0.0
    whole = [np.column_stack([side["b"], side["c"]]) for side in (users, items)]
    for part, sides in batches:
        pu, qi = (m[rows] for m, (rows, *_) in zip(whole, sides))
        x = pu[:, -1] + qi[:, -1] + np.einsum("ij,ij->i", pu[:, :-1], qi[:, :-1])
        error, slope = errors(x, r[part], mean, p)
        total += float(error @ error)
        d = error * slope
        for side, m, (_, order, first, touched), own, other in zip((users, items), whole, sides, (pu, qi), (qi, pu)):
            gradient = d[:, None] * other
            gradient[:, -1] = d
            gradient -= p.reg * own
            gradient = gradient[order]
            side["d"][touched] += np.add.reduceat(np.einsum("ij,ij->i", gradient, gradient) / gradient.shape[1], first)
            m[touched] += np.add.reduceat(gradient, first) * (p.rate / np.sqrt(side["d"][touched]))[:, None]
    for side, m in zip((users, items), whole):
        side["b"][:], side["c"][:] = m[:, :-1], m[:, -1]
    return total


def _unpacked(row: dict, rank: int) -> dict:
    out = {"a": np.frombuffer(row["a"], np.int64), "e": np.frombuffer(row["e"], np.int64)}
    out |= {x: np.frombuffer(row[x], np.float64).copy() for x in "bcd"}
    out["b"] = out["b"].reshape(len(out["a"]), rank)
    return out


def _packed(row: dict, side: dict, **more) -> dict:
    return row | {x: side[x].tobytes() for x in "abcde"} | more


def _penalty(side: dict, reg: float) -> float:
    return reg * float((side["e"] * ((side["b"] ** 2).sum(1) + side["c"] ** 2)).sum())


def _visit(rows: list[dict], models: list[Params], mean: float, blocks: int, first: bool, averages: dict, learn: bool, closes: int | None = None) -> Iterator[dict]:
    """One cell in one round: its ratings against the two blocks of every model.

    A round that ``closes`` an epoch within a pass adds a row of kind ``s`` per model, whose
    block is that epoch and which later rounds hand on.

    Without ``learn`` the ratings of a model's own fold are predicted instead;
    those of a user or item that the model has never met are counted in ``penalty``.
    """
    ratings = [r for r in rows if r["kind"] == "r"]
    u, i, r, fold = (np.concatenate([np.frombuffer(x[c], t) for x in ratings]) if ratings else np.zeros(0, t) for c, t in zip("abcd", (np.int64, np.int64, np.float64, np.int32)))
    by: dict[int, dict[str, dict]] = {}
    for row in rows:
        if row["kind"] == "s":
            yield row
        elif row["kind"] != "r":
            by.setdefault(row["model"], {})[row["kind"]] = row
    same: dict[int, tuple] = {}
    # models with one fold follow each other and share their batches
    for model, pair in sorted(by.items(), key=lambda x: (models[x[0]].fold, x[0])):
        p = models[model]
        sides = {k: _unpacked(row, p.rank) for k, row in pair.items()}
        for k, side in sides.items():
            if first:
                _put_averages(side, averages.get((model, k), {}))
        sse, n, unmet = 0.0, 0, 0
        if len(sides) == 2 and len(r):
            if p.fold not in same:
                use = (fold != p.fold) == learn
                ub, ib = (np.searchsorted(sides[k]["a"], x[use]) for k, x in (("u", u), ("i", i)))
                same = {p.fold: (ub, ib, r[use], visits(ub, ib) if learn else None)}
            ub, ib, rated, batches = same[p.fold]
            if learn:
                n, sse = len(ub), step(sides["u"], sides["i"], batches, rated, mean, p)
            else:
                met = (sides["u"]["d"][ub] > 1) & (sides["i"]["d"][ib] > 1)
                ub, ib = ub[met], ib[met]
                x = sides["u"]["c"][ub] + sides["i"]["c"][ib] + (sides["u"]["b"][ub] * sides["i"]["b"][ib]).sum(1)
                error = errors(x, rated[met], mean, p)[0]
                n, sse, unmet = len(error), float(error @ error), int((~met).sum())
        closed = {"kind": "s", "model": model, "block": closes, "sse": 0.0, "visited": 0, "penalty": 0.0}
        for k, side in sides.items():
            row = pair[k]
            gained = (0.0, 0) if first else (row["sse"], row["visited"])
            penalty = _penalty(side, p.reg) if learn else 0.0 if first else row["penalty"]
            if k == "u":
                gained, penalty = (gained[0] + sse, gained[1] + n), penalty + unmet
            # Item blocks move to the cell of the user block that meets them next.
            base = row["cell"] % blocks
            cell = row["cell"] - base + (row["block"] if k == "u" else (base - 1) % blocks)
            yield _packed(row, side, cell=cell, sse=gained[0], visited=gained[1], penalty=penalty)
            closed |= {"cell": cell, "sse": closed["sse"] + gained[0], "visited": closed["visited"] + gained[1], "penalty": closed["penalty"] + penalty}
        if closes is not None:
            yield closed


def _put_averages(side: dict, averages: dict[int, tuple[np.ndarray, float, float]]) -> None:
    codes = np.fromiter(averages, np.int64, len(averages))
    for code in codes[np.isin(codes, side["a"])].tolist():
        at = int(np.searchsorted(side["a"], code))
        side["b"][at], side["c"][at], side["d"][at] = averages[code]


def _round(
    state: DataFrame, cells: DataFrame, s: int, models: list[Params], mean: float, blocks: int, groups: int, averages: dict, learn: bool,
    closes: int | None = None,
) -> DataFrame:
    first = s == 0
    here = cells.where(F.col("block") == F.pmod(F.col("cell") + s, F.lit(blocks)))
    if groups > 1:
        dealt = here.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        here = dealt.withColumn("cell", F.col("cell") + F.col("group") * blocks).drop("group")
    # the cell names its partition: by hash several cells would meet in one task and other tasks have none
    together = state.unionByName(here).repartitionById(blocks * groups, "cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def done() -> pa.RecordBatch:
            out = list(_visit(held, models, mean, blocks, first, averages, learn, closes))
            return pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["cell"] != row["cell"]:
                    yield done()
                    held.clear()
                held.append(row)
        if held:
            yield done()

    return together.mapInArrow(run, _STATE)


@dataclass
class Coding:
    """Codes of one side: the key, or one of several copies of a hot key."""

    key: str
    hot: dict[int, tuple[int, int]]  # key -> first code, copies

    @staticmethod
    def of(rows: DataFrame, key: str, blocks: int, total: int) -> Coding:
        """Keys with more than half a block's share of the ratings (fewer than 2 B) get copies."""
        share = total / (2 * blocks)
        found = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > share).orderBy(key).collect() if blocks > 1 else []
        return Coding(key, {r[0]: (_COPIES_FROM + k * _COPIES_APART, min(2 * blocks, ceil(r["n"] / share))) for k, r in enumerate(found)})

    def code(self, other: str) -> Column:
        plain = F.col(self.key).cast("long")
        if not self.hot:
            return plain
        base = F.create_map(*[F.lit(x).cast("long") for k, (b, _) in self.hot.items() for x in (k, b)])
        copies = F.create_map(*[F.lit(x).cast("long") for k, (_, c) in self.hot.items() for x in (k, c)])
        return F.coalesce(base[plain] + F.pmod(F.xxhash64(other), copies[plain]), plain)

    def copies(self) -> dict[int, int]:
        return {b + c: k for k, (b, n) in self.hot.items() for c in range(n)}


@dataclass
class Trained:
    """Models after their epochs: the state table, the curve, and what scoring needs."""

    models: list[Params]
    mean: float
    blocks: int
    groups: int
    cells: DataFrame
    state: DataFrame
    codings: dict[str, Coding]
    averages: dict = field(default_factory=dict)
    curve: list[tuple] = field(default_factory=list)

    def _pass(self, learn: bool, epochs: int = 1) -> DataFrame:
        """All cells once an epoch; the written state behind them, with sums of all epochs but the last."""
        done, state = self.state, self.state.where("kind <> 's'")
        rounds = epochs * self.blocks
        with freed_shuffles(state.sparkSession):
            for t in range(rounds):
                s = t % self.blocks
                closes = t // self.blocks if s == self.blocks - 1 and t < rounds - 1 else None
                state = _round(state, self.cells, s, self.models, self.mean, self.blocks, self.groups, self.averages, learn, closes)
                if t % ROUNDS_PER_JOB == ROUNDS_PER_JOB - 1 or t == rounds - 1:
                    state = materialise(state, "descent-state")
                    if done is not self.state:
                        discard(done)
                    done = state
        return state

    def epoch(self, epochs: int = 1) -> None:
        """One epoch of every model, or several in one pass; the state before it is deleted."""
        before, state = self.state, self._pass(learn=True, epochs=epochs)
        discard(before)
        self.state = state
        self.averages = self._averaged() if any(c.hot for c in self.codings.values()) else {}
        within = F.when(F.col("kind") == "s", F.col("block")).otherwise(epochs - 1).alias("epoch")
        sums = state.groupBy(within, "model").agg(F.sum("sse").alias("sse"), F.sum("visited").alias("n"), F.sum("penalty").alias("penalty"))
        number = len(self.curve) // len(self.models) + 1
        for r in sums.orderBy("epoch", "model").collect():
            self.curve.append((r.model, number + r.epoch, sqrt(r.sse / r.n) if r.n else None, r.sse + r.penalty))

    def held_out(self) -> list[tuple[int, float | None, int]]:
        """``(model, rmse, ratings without a vector)`` of every model's own fold."""
        state = self._pass(learn=False)
        sums = state.groupBy("model").agg(F.sum("sse").alias("sse"), F.sum("visited").alias("n"), F.sum("penalty").alias("unmet"))
        out = [(r.model, sqrt(r.sse / r.n) if r.n else None, int(r.unmet)) for r in sums.orderBy("model").collect()]
        discard(state)
        return out

    def _vectors(self) -> DataFrame:
        """``(model, kind, code, n, features, bias, g)`` of the state."""
        ranks = [p.rank for p in self.models]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    side = _unpacked(row, ranks[row["model"]])
                    n = len(side["a"])
                    columns = [pa.array([row["model"]] * n, pa.int32()), pa.array([row["kind"]] * n), pa.array(side["a"]), pa.array(side["e"])]
                    columns += [pa.array(list(side["b"]), pa.list_(pa.float64())), pa.array(side["c"]), pa.array(side["d"])]
                    yield pa.RecordBatch.from_arrays(columns, ["model", "kind", "code", "n", "features", "bias", "g"])

        return self.state.where("kind <> 's'").mapInArrow(run, "model int, kind string, code long, n long, features array<double>, bias double, g double")

    def _averaged(self) -> dict:
        """Copies of hot keys, averaged by their ratings: fewer than 2 B keys a side, so they fit the driver."""
        known = {k: c.copies() for k, c in self.codings.items()}
        found = self._vectors().where(F.col("code") < _COPIES_FROM // 2).collect()
        groups: dict = {}
        for r in found:
            groups.setdefault((r.model, r.kind, known[r.kind][r.code]), []).append(r)
        out: dict = {}
        for (model, kind, _), copies in groups.items():
            weight = np.array([max(1, r.n) for r in copies], float)
            weight /= weight.sum()
            mean = (weight @ np.array([r.features for r in copies]), float(weight @ [r.bias for r in copies]), float(weight @ [r.g for r in copies]))
            out.setdefault((model, kind), {}).update({r.code: mean for r in copies})
        return out

    def run(self, epochs: int) -> Trained:
        """So many epochs more. Where no copies have to be averaged in between, a job goes through several."""
        at_once = 1 if any(c.hot for c in self.codings.values()) else max(1, ROUNDS_PER_JOB // self.blocks)
        for at in range(0, epochs, at_once):
            self.epoch(min(at_once, epochs - at))
        return self

    def tables(self, model: int = 0) -> tuple[KeyedTable, KeyedTable]:
        """User and item vectors of one model, one row per key."""
        out = []
        vectors = materialise(self._vectors().where(F.col("model") == model), "descent-vectors")
        for kind, coding in self.codings.items():
            mine = vectors.where(F.col("kind") == kind).select(F.col("code").alias(coding.key), "n", "features", "bias")
            hot = []
            for key, (base, copies) in coding.hot.items():
                mean = self.averages[(model, kind)]
                code = next(c for c in range(base, base + copies) if c in mean)
                hot.append((key, 0, [float(x) for x in mean[code][0]], mean[code][1]))
            if hot:
                plain = mine.where(F.col(coding.key) > _COPIES_FROM // 2)
                mine = plain.unionByName(mine.sparkSession.createDataFrame(hot, mine.schema))
            out.append(KeyedTable.build(mine, coding.key))
        return tuple(out)

    def score(self, rows: DataFrame, model: int = 0, name: str = "pred") -> DataFrame:
        """Add a model's prediction; NULL where the user or item was not in the training rows."""
        users, items = self.tables(model)
        paired = lookup(rows, users, [F.col("features").alias("__p"), F.col("bias").alias("__bu")])
        paired = lookup(paired, items, [F.col("features").alias("__q"), F.col("bias").alias("__bi")])
        x = F.col("__bu") + F.col("__bi") + dot(F.col("__p"), F.col("__q"))
        bounds = self.models[model].bounds
        value = bounds[0] + (bounds[1] - bounds[0]) / (1 + F.exp(-x)) if bounds else self.mean + x
        return paired.withColumn(name, value).drop("__p", "__q", "__bu", "__bi")

    def curve_table(self) -> DataFrame:
        """``(model, iter, tr_rmse, obj)``: errors as the epoch met them, and those with the penalty behind it."""
        return self.state.sparkSession.createDataFrame(self.curve, "model int, iter int, tr_rmse double, obj double")


def prepare(train: DataFrame, models: list[Params], *, folds: int = 0, user: str = "userId", item: str = "movieId", rows_per_cell: int = ROWS_PER_CELL) -> Trained:
    """Deal the ratings to cells and give every model its start values. Rows with a null are left out."""
    fold = fold_of(folds) if folds else F.lit(0)
    rows = train.select(F.col(user).alias("userId"), F.col(item).alias("movieId"), F.col("rating").cast("double").alias("rating")).dropna()
    rows = materialise(rows.withColumn("fold", fold.cast("int")), "descent-rows")
    found = rows.agg(F.count("*").alias("n"), F.avg("rating").alias("mean")).first()
    blocks = max(1, ceil(sqrt(found["n"] / rows_per_cell)))
    groups = max(1, min(len(models), train.sparkSession.sparkContext.defaultParallelism // blocks))
    codings = {"u": Coding.of(rows, "userId", blocks, found["n"]), "i": Coding.of(rows, "movieId", blocks, found["n"])}
    coded = rows.select(codings["u"].code("movieId").alias("u"), codings["i"].code("userId").alias("i"), "rating", "fold")
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    placed = materialise(coded.select("u", "i", "rating", "fold", block("u").alias("cell"), block("i").alias("block"), F.xxhash64("u", "i").alias("h")), "descent-coded")

    def pack(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_numpy() for c in table.column_names}
        order = np.lexsort((columns["rating"], columns["i"], columns["u"], columns["h"]))
        row = {"kind": "r", "model": -1, "cell": int(columns["cell"][0]), "block": int(columns["block"][0]), "e": b"", "sse": 0.0, "visited": 0, "penalty": 0.0}
        row |= {x: columns[c][order].astype(t).tobytes() for x, c, t in zip("abcd", ("u", "i", "rating", "fold"), (np.int64, np.int64, np.float64, np.int32))}
        return pa.Table.from_pylist([row], schema=_SCHEMA)

    cells = materialise(placed.groupBy("cell", "block").applyInArrow(pack, _STATE), "descent-cells")

    def start(table: pa.Table) -> pa.Table:
        kind, place = table.column("kind")[0].as_py(), table.column("block")[0].as_py()
        order = np.argsort(table.column("code").to_numpy())
        ids, n = (table.column(c).to_numpy()[order].astype(np.int64) for c in ("code", "n"))
        out = []
        for model, p in enumerate(models):
            seed = p.seed + (kind == "i")
            side = {"a": ids, "b": first_vectors(ids, p.rank, seed), "c": np.zeros(len(ids)), "d": np.ones(len(ids)), "e": n}
            out.append(_packed({"kind": kind, "model": model, "cell": place + blocks * (model % groups), "block": place, "sse": 0.0, "visited": 0, "penalty": 0.0}, side))
        return pa.Table.from_pylist(out, schema=_SCHEMA)

    sides = [placed.groupBy(F.lit(k).alias("kind"), F.col(b).alias("block"), F.col(c).alias("code")).agg(F.count("*").alias("n")) for k, b, c in (("u", "cell", "u"), ("i", "block", "i"))]
    state = materialise(sides[0].unionByName(sides[1]).groupBy("kind", "block").applyInArrow(start, _STATE), "descent-start")
    discard(rows, placed)
    return Trained(list(models), found["mean"] or 0.0, blocks, groups, cells, state, codings)


def fit(train: DataFrame, params: Params, epochs: int = 20, **options) -> Trained:
    return prepare(train, [params], **options).run(epochs)


def grid_search(train: DataFrame, ranks: list[int], rates: list[float], epochs: int = 10, folds: int = 5, reg: float = 0.05) -> tuple[Params, DataFrame]:
    """Cross-validated grid; the best point and ``(rank, rate, rmse, n_null, is_best)``. All models share every job."""
    points = [Params(rank=k, rate=r, reg=reg) for k in ranks for r in rates]
    models = [replace(p, fold=f) for p in points for f in range(folds)]
    done = prepare(train, models, folds=folds).run(epochs)
    found = done.held_out()
    per = [found[k : k + folds] for k in range(0, len(found), folds)]
    mean = [sum(e for _, e, _ in part) / folds for part in per]
    least = min(range(len(points)), key=lambda k: mean[k])
    rows = [(p.rank, p.rate, mean[k], sum(x[2] for x in per[k]), k == least) for k, p in enumerate(points)]
    return points[least], train.sparkSession.createDataFrame(rows, "rank int, rate double, rmse double, n_null long, is_best boolean")
