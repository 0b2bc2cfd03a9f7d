"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfstar.llm.common import map_batches, utf8
from halfstar.operators.ids import dense_ids
from halfstar.session import materialise

#: Weights of the sources in turn, and the most copies of a document.
WEIGHTS = (1, 2, 3)
MOST = 3.0
#: Documents one task rounds; more documents of a source are dealt to several tasks.
LEAF = 2_000
#: A fraction nearer to a whole number than this is that number.
EPSILON = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, row)``: words of every text, and a number that tells equal ids apart."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column("text"))
        size = pa.array([len(t.split()) for t in texts], pa.int64())
        mark = pa.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), size, mark], ["doc_id", "source", "size", "mark"])

    source = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_batches(source, make, f"doc_id {kind}, source string, size long, mark long")


def source_targets(counted: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)``.

    Sources in code point order, null last, take the weights in turn and share
    the sum of all sizes by them. A target stops at ``most`` times its source's
    size; the excess is shared again by weight until none is above. Each
    sharing is one aggregate over the source table; its scalars alone reach the
    driver.
    """
    per = counted.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    # dense ids sort in parallel; the prefix keeps the null group, and puts it last
    keyed = per.withColumn("name", F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source")))
    ranked = dense_ids(keyed, "name", F.first("source").alias("source"), F.first("source_size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("idx") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = materialise(ranked.select("source", "source_size", weight.cast("double").alias("weight")), "mix-sources")
    cap = most * F.col("source_size")
    share = None
    while True:
        capped = F.lit(False) if share is None else cap < share * F.col("weight")
        row = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(capped, cap).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        new = (row["all"] - row["fixed"]) / row["open"] if row["open"] else (share or 0.0)
        if share is not None and new <= share:
            break
        share = new
    return table.select("source", "source_size", F.least(cap.cast("double"), share * F.col("weight")).alias("target"))


def _draw(seed: int, row) -> float:
    """A number in 0..1 that hangs on the two documents of a pair alone."""
    return xxhash.xxh64_intdigest(repr(row).encode(), seed=seed) / 2.0**64


def round_chain(rows: pd.DataFrame, seed: int, last: bool) -> pd.DataFrame:
    """Pivotal rounding of ``p`` over one chain of documents; at most one stays fractional.

    Two documents trade words, so that ``size * p`` keeps its sum, until one is
    at 0 or 1; either direction comes with the probability that keeps both
    expectations. The document still open meets the next one. Large documents
    go first, so that what stays open is small. The ``last`` one is rounded by
    its own probability.
    """
    rows = rows.sort_values(["size", "doc_id", "mark"], ascending=[False, True, True], na_position="last", kind="stable")
    size, p = rows["size"].to_numpy(float), rows["p"].to_numpy(float).copy()
    ids = list(zip(rows["doc_id"].tolist(), rows["mark"].tolist()))
    held = -1
    for i in np.flatnonzero((p >= EPSILON) & (p <= 1 - EPSILON)):
        if held < 0:
            held = i
            continue
        up = min((1 - p[held]) * size[held], p[i] * size[i])  # words towards the held one
        down = min(p[held] * size[held], (1 - p[i]) * size[i])
        step = up if _draw(seed, (ids[held], ids[i])) * (up + down) < down else -down
        p[held] += step / size[held]
        p[i] -= step / size[i]
        for k in (held, i):
            p[k] = 0.0 if p[k] < EPSILON else 1.0 if p[k] > 1 - EPSILON else p[k]
        open_ = [k for k in (held, i) if 0 < p[k] < 1]
        held = open_[0] if open_ else -1
    if last and held >= 0:
        p[held] = float(_draw(seed, ids[held]) < p[held])
    return rows.assign(p=p)


_COLUMNS = "size long, mark long, source string, source_size long, target double, whole long, p double, twin long"


def _rounder(seed: int, last: bool):
    def rounded(rows: pd.DataFrame) -> pd.DataFrame:
        out = round_chain(rows, seed, last).rename(columns={"own": "source"})
        return out[["doc_id", *(c.split()[0] for c in _COLUMNS.split(", "))]]

    return rounded


def mix(
    docs: DataFrame, *, weights: tuple = WEIGHTS, most: float = MOST, seed: int = 42, leaf: int = LEAF
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row of ``docs(doc_id, source, text)``.

    A source's target asks for target / source_size copies of each of its
    documents: the whole part is taken for sure, the fraction is rounded by
    pairs (see ``round_chain``). A source's documents are dealt to chains of
    about ``leaf`` by a hash; each chain leaves at most one open document, and
    these meet again in fewer chains, up to one. So the words taken miss the
    target by less than the size of one document of the source, and no task
    holds more than a chain. Draws hang on ids and texts, not on partitions:
    reruns agree. The draw is fair: a document's expected copies are those
    asked for.

    Null and empty texts have size 0 and take nothing. A null source is a
    source of its own, last in order. Rows equal in id and text but repeated
    are rounded one by one. An empty table, and one without words, gives
    targets of 0. Other columns are not read. Weights are any positive numbers.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    leaf = max(2, leaf)  # a chain of one document would close nothing
    counted = materialise(sizes(docs), "mix-sizes")
    targets = source_targets(counted, weights, most)
    joined = counted.withColumnRenamed("source", "own").join(targets, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(copies + EPSILON)
    part = copies - whole
    state = materialise(
        joined.select(
            "doc_id", "size", "mark", "source", "source_size", "target", whole.cast("long").alias("whole"),
            F.when(part < EPSILON, 0.0).otherwise(part).alias("p"), F.lit(0).cast("long").alias("twin"),
        ),
        "mix-copies",
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    # The same bounds as in the chains: what is open here is traded there.
    is_open = (F.col("p") >= EPSILON) & (F.col("p") <= 1 - EPSILON) & (F.col("size") > 0)
    done, level = [state.filter(~is_open)], 0
    waiting = state.filter(is_open)
    while True:
        per = waiting.groupBy("source").agg(F.ceil(F.count("*") / leaf).cast("long").alias("chains"))
        many = per.agg(F.max("chains")).first()[0]
        if many is None:
            break
        last = many == 1
        chained = waiting.withColumnRenamed("source", "own").join(per.withColumnRenamed("source", "s"), F.col("own").eqNullSafe(F.col("s")))
        chained = chained.withColumn("chain", F.pmod(F.xxhash64("doc_id", "mark", F.lit(level)), F.col("chains")))

        chains = chained.groupBy("own", "chain")
        state = materialise(chains.applyInPandas(_rounder(seed + level, last), f"doc_id {kind}, {_COLUMNS}"), "mix-round")
        if last:
            done.append(state)
            break
        done.append(state.filter(~is_open))
        waiting = state.filter(is_open)
        level += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    extra = F.when(F.col("p") >= 0.5, 1).otherwise(0)
    return out.select("doc_id", "size", "source_size", "target", ((F.col("whole") + extra) * F.col("size")).cast("long").alias("taken"))
