"""Chat formatting in budgeted windows, by DataFrame functions alone.

Template: a turn is ``<turn>`` role ``<says>`` text ``</turn>`` and a newline. In
roles and texts a backslash is written ``\\b`` and ``<`` is written ``\\l``, so
no marker can arise inside them, and undoing the two in turn restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens a window may hold; of these at most so many, in so many turns, repeat what came before.
BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 512, 128, 2
OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _numbered(turns: DataFrame, budget: int, history: int, n_history: int) -> DataFrame:
    """Each turn with its place, its span and the later spans that repeat it as history."""
    tokens = F.greatest(F.lit(1), F.ceil(F.length("text") / 4)).cast("long")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    base = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    part = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SAYS), escape(F.col("text")), F.lit(CLOSE))
    placed = base.withColumn("tok", tokens).withColumn("pos", F.row_number().over(order)).withColumns(
        {"lead": (F.col("pos") == 1) & (F.col("role") == "system"), "part": part}
    )
    first = F.first(F.when(F.col("lead"), F.struct("part", "tok")), ignorenulls=False).over(so_far)
    room = F.greatest(F.lit(4), F.lit(budget) - F.coalesce(F.col("system.tok"), F.lit(0)))
    past = F.least(F.lit(history), F.floor(F.col("room") / 4))
    body = F.when(F.col("lead"), 0).otherwise(F.col("tok"))
    sized = (
        placed.withColumn("system", first)
        .withColumn("room", room)
        .withColumn("past", past)
        .withColumn("quota", F.greatest(F.lit(1), F.floor((F.col("room") - F.col("past")) / 2)))
        .withColumn("large", F.col("tok") > F.col("quota"))
        .withColumns({"upto": F.sum(body).over(so_far), "larges": F.sum(F.col("large").cast("long")).over(so_far)})
    )
    # Turns whose prefix sums end in the same quota form a span of less than two quotas; a turn above a quota is one alone.
    group = F.struct("lead", "larges", "large", F.when(~F.col("large"), F.floor((F.col("upto") - 1) / F.col("quota"))).alias("slot"))
    marked = sized.withColumn("group", group).withColumn(
        "starts", (~F.col("lead")) & ~F.coalesce(F.col("group").eqNullSafe(F.lag("group").over(order)), F.lit(False))
    )
    spans = marked.withColumn("span", F.sum(F.col("starts").cast("long")).over(so_far))
    before = F.col("upto") - F.col("tok")
    later = [
        F.when(
            F.lead("starts", d).over(order) & ((F.lead("upto", d).over(order) - F.lead("tok", d).over(order)) - before <= F.col("past")),
            F.lead("span", d).over(order),
        )
        for d in range(1, n_history + 1)
    ]
    repeats = F.filter(F.array(*later), lambda s: s.isNotNull()) if later else F.array().cast("array<bigint>")
    return spans.withColumn("later", F.when(F.col("lead"), F.array().cast("array<bigint>")).otherwise(repeats))


def windows(
    turns: DataFrame,
    *,
    budget: int = BUDGET,
    history_tokens: int = HISTORY_TOKENS,
    history_turns: int = HISTORY_TURNS,
) -> DataFrame:
    """``(conv_id, window, text, n_context, n_tokens, loss)`` for ``turns(conv_id, turn, role, text)``.

    Prefix sums of turn tokens (a quarter of the code points, rounded up) cut a
    conversation into spans of whole turns. A window holds the system turn, if
    the conversation opens with one, then up to ``history_turns`` turns of at
    most ``history_tokens`` before the span, then the span. The first
    ``n_context`` turns of its text repeat earlier windows. ``loss`` lists
    (start, length) in code points of the assistant texts that the window is
    the first to show, as they stand in ``text``; repeated ones are masked. A
    window stays within the budget unless the system turn and one turn alone
    exceed it.

    Turns are ordered by turn (null first), then role and text; repeated rows
    are turns of their own. Null roles and texts are empty, a null conv_id is
    a conversation. Other columns are not read; an empty table gives none.
    Work is one shuffle by conversation, and one by window.
    """
    turn = _numbered(turns, budget, history_tokens, history_turns)
    # A system turn without anything after it fills window 1 alone.
    own = F.when(F.col("lead"), F.array(F.lit(1).cast("long"))).otherwise(F.concat(F.array("span"), F.col("later")))
    shown = turn.withColumn("window", F.explode(own)).select(
        "conv_id",
        "window",
        F.when(F.col("window") > 1, F.col("system")).alias("system"),
        F.struct(
            "pos",
            "part",
            "tok",
            F.when(F.col("lead"), False).otherwise(F.col("span") != F.col("window")).alias("again"),
            (F.col("role") == "assistant").alias("target"),
            F.length(F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SAYS))).alias("skip"),
        ).alias("t"),
    )
    gathered = shown.groupBy("conv_id", "window").agg(
        F.first("system").alias("system"), F.sort_array(F.collect_list("t")).alias("ts")
    )
    head = F.coalesce(F.col("system.part"), F.lit(""))
    size = F.length(F.lit(CLOSE))
    start = F.aggregate(
        "ts",
        F.struct(F.length(head).cast("int").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["part"])).alias("at"),
            F.when(
                t["target"] & ~t["again"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + t["skip"]).alias("start"), (F.length(t["part"]) - t["skip"] - size).alias("length")
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )
    again = F.size(F.filter("ts", lambda t: t["again"])) + F.col("system").isNotNull().cast("int")
    total = F.aggregate("ts", F.coalesce(F.col("system.tok"), F.lit(0).cast("long")), lambda acc, t: acc + t["tok"])
    return gathered.select(
        "conv_id",
        "window",
        F.concat(head, F.array_join(F.transform("ts", lambda t: t["part"]), "")).alias("text"),
        again.alias("n_context"),
        total.alias("n_tokens"),
        start["spans"].alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, turns, targets, chars)`` out of windows: new turns as (role, text), the
    texts under the loss mask, both unescaped and in order, and the length of all windows."""
    pieces = F.slice(F.split("text", OPEN), F.lit(2), F.greatest(F.lit(0), F.size(F.split("text", OPEN)) - 1))
    fresh = F.slice(F.col("pieces"), F.col("n_context") + 1, F.greatest(F.lit(0), F.size("pieces") - F.col("n_context")))
    per = formatted.withColumn("pieces", pieces).select(
        "conv_id",
        F.struct(
            "window",
            F.transform(
                fresh,
                lambda p: F.struct(
                    unescape(F.substring_index(p, SAYS, 1)).alias("role"),
                    unescape(F.substring_index(F.substring_index(p, SAYS, -1), CLOSE, 1)).alias("text"),
                ),
            ).alias("turns"),
            F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["length"]))).alias("targets"),
        ).alias("w"),
        F.length("text").alias("chars"),
    )
    whole = per.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"), F.sum("chars").cast("long").alias("chars"))
    return whole.select(
        "conv_id",
        F.flatten(F.transform("ws", lambda w: w["turns"])).alias("turns"),
        F.flatten(F.transform("ws", lambda w: w["targets"])).alias("targets"),
        "chars",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and hashes of what ``read_back`` finds, one row per conversation."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    target = F.array_join("targets", "")
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(target).cast("long").alias("loss_chars"),
        F.sha2(target, 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


ORACLE_SQL = """
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), placed as (
  select *, row_number() over w as pos, greatest(1, cast(ceil(length(text) / 4.0) as bigint)) as tok,
         20 + length(role) + length(text) + length(role || text)
            - length(replace(replace(role || text, '\\', ''), '<', '')) as chars
  from given window w as (partition by conv_id order by turn nulls first, role, text)
), led as (
  select *, pos = 1 and role = 'system' as lead,
         max(case when pos = 1 and role = 'system' then tok else 0 end) over (partition by conv_id) as stok,
         max(case when pos = 1 and role = 'system' then chars else 0 end) over (partition by conv_id) as schars
  from placed
), roomy as (
  select *, greatest(4, 512 - stok) as room, least(128, greatest(4, 512 - stok) // 4) as past from led
), sized as (
  select *, greatest(1, (room - past) // 2) as quota, tok > greatest(1, (room - past) // 2) as large,
         sum(case when lead then 0 else tok end) over w as upto
  from roomy window w as (partition by conv_id order by pos)
), grouped as (
  select *, row(lead, sum(large::int) over (partition by conv_id order by pos), large,
                case when not large then (upto - 1) // quota end) as grp from sized
), started as (
  select *, not lead and (grp is distinct from lag(grp) over w) as starts from grouped window w as (partition by conv_id order by pos)
), spans as (
  select *, sum(starts::int) over (partition by conv_id order by pos) as span from started
), shown as (
  select conv_id, chars from spans
  union all select conv_id, schars from spans where starts and span > 1
  union all
  select t.conv_id, t.chars from spans t join spans s
    on s.conv_id is not distinct from t.conv_id and s.starts and s.pos between t.pos + 1 and t.pos + 2
   and (s.upto - s.tok) - (t.upto - t.tok) <= t.past
  where not t.lead
), formatted as (select conv_id, cast(sum(chars) as bigint) as formatted_chars from shown group by conv_id)
select p.conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
       any_value(f.formatted_chars) as formatted_chars
from placed p join formatted f on f.conv_id is not distinct from p.conv_id
group by p.conv_id
"""
