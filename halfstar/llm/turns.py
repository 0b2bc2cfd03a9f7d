"""Repair of conversation structure by alignment with the alternating grammar.

Roles should read ``(s?(ua)+)?``: an optional system turn, then user and
assistant in turn. A conversation is aligned with every feasible length of that
string by Wagner-Fischer tables. Read from the end, all lengths share one table
(the last symbol is always ``a``, the one before ``u``), so a cell stands for
"rows from i on against the last k symbols". A quick repair gives an incumbent
cost; cells further off the diagonal than it allows are never computed (Ukkonen).
Of all cheapest alignments the one whose backtraced audit is least in ASCII is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from halfstar.llm.common import map_batches
from halfstar.session import materialise

#: Costs of the edits; a truncated row that stays costs ``CUT`` more.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: Rows between two stored rows of a long table; those between are computed again for the backtrace.
STRIDE = 256
_FAR = np.int64(1) << 40
_WHITE = " \t\n\x0b\x0c\r"


class _Table:
    """Costs of rows i.. against the last k symbols, within a band around the diagonal.

    ``rows`` holds ``(initial, fault)`` per row: fault ``x`` (blank or duplicate,
    must go), ``t`` (truncated) or ``-``. ``low[i]`` is the first k of the band.
    """

    def __init__(self, rows: list[tuple[str, str]], slack: int):
        self.rows = rows
        n = len(rows)
        keepable = np.zeros(n + 1, np.int64)
        keepable[:n] = np.cumsum([f != "x" for _, f in reversed(rows)])[::-1]
        # An unforced delete costs 2 more than the row's own fault, an insert 2.
        self.low = np.maximum(0, keepable - slack // 2 - 1)
        self.high = keepable + slack // INSERT + 1
        self.kept = {n: self._last()}
        self._block: dict[int, np.ndarray] = {}
        row = self.kept[n]
        for i in range(n - 1, -1, -1):
            row = self._step(i, row)
            if i % STRIDE == 0:
                self.kept[i] = row

    def _last(self) -> np.ndarray:
        n = len(self.rows)
        return INSERT * np.arange(self.low[n], self.high[n] + 1)

    def _moved(self, i: int, below: np.ndarray, shift: int) -> np.ndarray:
        """``below[k - shift]`` for the k of row i, far outside its band."""
        ks = np.arange(self.low[i], self.high[i] + 1) - shift - self.low[i + 1]
        ok = (ks >= 0) & (ks < len(below))
        return np.where(ok, below[np.clip(ks, 0, len(below) - 1)], _FAR)

    def _step(self, i: int, below: np.ndarray) -> np.ndarray:
        initial, fault = self.rows[i]
        best = DELETE + self._moved(i, below, 0)
        ks = np.arange(self.low[i], self.high[i] + 1)
        if fault != "x":
            odd = ks % 2 == 1
            fits = odd if initial == "a" else ~odd if initial == "u" else np.zeros(len(ks), bool)
            stay = np.where(fits, 0, REROLE) + CUT * (fault == "t")
            best = np.minimum(best, np.where(ks > 0, stay + self._moved(i, below, 1), _FAR))
        return np.minimum.accumulate(best - INSERT * ks) + INSERT * ks

    def row(self, i: int) -> np.ndarray:
        if i in self.kept:
            return self.kept[i]
        if i not in self._block:
            top = min(len(self.rows), (i // STRIDE + 1) * STRIDE)
            self._block, row = {}, self.kept[top]
            for j in range(top - 1, i // STRIDE * STRIDE, -1):
                row = self._block[j] = self._step(j, row)
        return self._block[i]

    def cost(self, i: int, k: int) -> int:
        at = k - int(self.low[i])
        row = self.row(i)
        return int(row[at]) if 0 <= at < len(row) else int(_FAR)

    def audit(self, i: int, k: int) -> str:
        """The least audit among the cheapest alignments of rows i.. with the last k symbols."""
        out, n = [], len(self.rows)
        while i < n or k > 0:
            here = self.cost(i, k)
            initial, fault = self.rows[i] if i < n else ("", "x")
            cut = CUT * (fault == "t")
            if i < n and DELETE + self.cost(i + 1, k) == here:
                out.append("D")
                i += 1
            elif k > 0 and INSERT + self.cost(i, k - 1) == here:
                out.append("I")
                k -= 1
            else:
                fits = initial == ("a" if k % 2 else "u")
                out.append("K" if fits and cut + self.cost(i + 1, k - 1) == here else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def _incumbent(rows: list[tuple[str, str]]) -> int:
    """Cost of a quick repair, without what every repair pays (forced deletes, truncated rows)."""
    extra, want, first = 0, "u", True
    for initial, fault in rows:
        if fault == "x":
            continue
        if first and initial == "s":
            first = False
            started = True
            continue
        if initial == want:
            want = "a" if want == "u" else "u"
        elif initial in ("u", "a"):
            extra += INSERT
        else:
            extra += REROLE
            want = "a" if want == "u" else "u"
        first = started = False
    if want == "a":
        extra += INSERT
    elif not first and started:
        extra += 2 * INSERT  # a system turn alone needs a pair behind it
    return extra


def repair(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """``(cost, audit)`` of the cheapest repair; time is turns x band, memory turns x band / ``STRIDE``."""
    table = _Table(rows, _incumbent(rows))
    starts: dict[int, list[tuple[int, int]]] = {}
    for k in range(int(table.low[0]), int(table.high[0]) + 1):
        if k % 2 == 0:
            starts.setdefault(table.cost(0, k), []).append((-1, k))
    gone = 0
    for i, (initial, fault) in enumerate(rows):
        if initial == "s" and fault != "x":
            keep = gone + CUT * (fault == "t")
            for k in range(max(2, int(table.low[i + 1])), int(table.high[i + 1]) + 1):
                if k % 2 == 0:
                    starts.setdefault(keep + table.cost(i + 1, k), []).append((i, k))
        gone += DELETE
        if min(starts, default=_FAR) < gone:
            break  # deleting this row too is already dearer
    cost = min(starts)
    audits = ("D" * max(i, 0) + ("K" if i >= 0 else "") + table.audit(i + 1, k) for i, k in starts[cost])
    return cost, min(audits)


@lru_cache(maxsize=20_000)
def _short(code: str) -> tuple[int, str]:
    return repair(list(zip(code[::2], code[1::2])))


def repaired(code: str) -> tuple[int, str]:
    """``repair`` of rows written as two characters each; short ones are remembered."""
    return _short(code) if len(code) <= 200 else repair(list(zip(code[::2], code[1::2])))


def damage(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, gone)``: rows damaged by ``crc32("conv_id:turn") % 20``.

    0 drops a row (``gone``), 1 empties its text, 2 removes ``.!?``, 3 repeats it,
    4 makes it a user's. A null id, turn, role or text reads as one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    damaged = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
        (kind == 0).alias("gone"), F.when(kind == 3, 2).otherwise(1).alias("__times"),
    )
    return damaged.withColumn("__i", F.explode(F.sequence(F.lit(1), "__times"))).drop("__times", "__i")


def _coded(rows: DataFrame) -> DataFrame:
    """Rows with their place in the conversation and a code of role initial and fault."""
    seen = F.row_number().over(W.partitionBy("conv_id", "role", "text", "gone").orderBy("turn")) > 1
    marked = rows.withColumn("seen", seen)
    order = W.partitionBy("conv_id").orderBy("gone", F.col("turn").asc_nulls_first(), "role", "text")
    inner = F.rtrim(F.col("text"), F.lit(_WHITE))
    blank = F.length(inner) == 0
    fault = F.when(blank, "b").when(F.col("seen"), "d").when(~F.substring(inner, -1, 1).isin(".", "!", "?"), "t").otherwise("-")
    head = F.substring("role", 1, 1)
    other = ~F.col("turn").eqNullSafe(F.lag("turn").over(order))
    return marked.select(
        "conv_id", F.row_number().over(order).cast("long").alias("pos"), "turn", "role", "text", "gone",
        F.when(F.col("turn").isNotNull() & other & ~F.col("gone"), 1).otherwise(0).alias("fresh"),
        F.when(F.col("gone"), "").otherwise(F.concat(F.when(head.isin("s", "u", "a"), head).otherwise("?"), fault)).alias("code"),
    )


def _count(code: Column, fault: str) -> Column:
    return F.length(F.regexp_replace(code, f"[^{fault}]", "")).cast("long")


def _plans(coded: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost and audit. Texts are not read."""
    here = ~F.col("gone")
    per = coded.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x.code), "").alias("code"),
        F.max(F.when(here, F.col("turn"))).alias("most"), F.min(F.when(here, F.col("turn"))).alias("least"),
        F.sum("fresh").alias("turns"),
    )
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
    faults = F.regexp_replace("code", "(.)(.)", "$2")
    heads = F.regexp_replace("code", "(.)(.)", "$1")
    pairs = F.length(heads) - 1
    # Overlapping pairs: each legal pair is found where its first symbol stands.
    legal = F.size(F.regexp_extract_all(heads, F.lit("(s(?=u)|u(?=a)|a(?=u))"), F.lit(1)))
    table = per.select(
        "conv_id", "code", gaps.alias("gaps"), _count(faults, "b").alias("blank"), _count(faults, "d").alias("duplicate"),
        _count(faults, "t").alias("truncated"), F.greatest(F.lit(0), pairs - legal).cast("long").alias("illegal"),
    )

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        forced = [c.replace("b", "x").replace("d", "x") for c in batch.column("code").to_pylist()]
        found = [repaired(c) for c in forced]
        columns = [batch.column(c) for c in batch.schema.names if c != "code"]
        columns += [pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, [c for c in batch.schema.names if c != "code"] + ["cost", "audit"])

    kind = coded.schema["conv_id"].dataType.simpleString()
    return map_batches(table, make, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


class _Writer:
    """Feeds one conversation's repaired turns to a digest, row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.out, self.hash = audit, 0, 0, hashlib.sha256()
        self.odd = (len(audit) - audit.count("D")) % 2

    def _write(self, role: str | None, text: str) -> None:
        if role is None:
            role = "user" if (self.out - self.odd) % 2 == 0 else "assistant"
        self.hash.update(f"{chr(10) if self.out else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.out += 1

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(None, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._write(role if edit == "K" else None, text)

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def repair_turns(rows: DataFrame) -> DataFrame:
    """Repair of every conversation of ``rows(conv_id, turn, role, text[, gone])``.

    Returns ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256)``; rows marked ``gone`` only keep their conversation in the
    result. A blank row holds no character but ASCII white space, a duplicate
    repeats role and text of an earlier row, a truncated one ends without
    ``.!?``; the first that holds counts. The audit is the string of edits:
    Keep, Rerole, Delete, Insert.

    Order is by turn, nulls first, then by role and text: equal rows are alike.
    A null conv_id is one conversation; null role and text read as one space.
    Roles that do not begin with s, u or a can be reroled or deleted only. An
    empty table gives no row. Other columns are not read.

    Repeats are marked by a window over conversation, role and text, so a
    conversation with very many turns is spread there. The alignment reads two
    characters a turn. The digest hashes the turns one after another, as SHA-256
    must, in sorted order and without holding them.
    """
    if "gone" not in rows.columns:
        space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
        rows = rows.select("conv_id", "turn", space("role"), space("text"), F.lit(False).alias("gone"))
    coded = materialise(_coded(rows), "turns-coded")
    plans = materialise(_plans(coded), "turns-plans")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    empty = lambda kind: F.lit(None).cast(kind)
    heads = plans.select("conv_id", F.lit(0).cast("long").alias("pos"), empty("string").alias("role"), empty("string").alias("text"), *names)
    kinds = {f.name: f.dataType for f in plans.schema}
    body = coded.where("not gone").select("conv_id", "pos", "role", "text", *[empty(kinds[c]).alias(c) for c in names])
    ordered = heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, head, done = None, None, []
        kind = None

        def flush() -> pa.RecordBatch:
            table = [pa.array([d[0] for d in done], kind)]
            table += [pa.array([d[1 + j] for d in done], pa.int64()) for j in range(6)]
            table += [pa.array([d[7 + j] for d in done], pa.string()) for j in range(2)]
            done.clear()
            return pa.RecordBatch.from_arrays(table, ["conv_id", *names, "repaired_sha256"])

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            columns = batch.to_pydict()
            for pos, role, text, *rest in zip(*(columns[c] for c in ("pos", "role", "text", "conv_id", *names))):
                if pos == 0:
                    if writer:
                        done.append((*head, writer.digest()))
                    writer, head = _Writer(rest[-1]), rest
                else:
                    writer.row(role, text)
            if len(done) >= 5_000:
                yield flush()
        if writer:
            done.append((*head, writer.digest()))
            yield flush()

    kind = rows.schema["conv_id"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in names[:-1])
    return ordered.mapInArrow(run, f"conv_id {kind}, {longs}, audit string, repaired_sha256 string")
