"""Removal of boilerplate lines by the number of distinct sites that show them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfstar.llm.common import key_text, row_key
from halfstar.session import materialise

#: A line shown by this many sites or more is boilerplate.
MIN_SITES = 5
#: Shorter lines (code points, trimmed) stay: by chance they recur anywhere.
MIN_CHARS = 20
#: log2 of the registers of a sketch; its relative standard error is 1.04 / 2^(LOG_K / 2), 1.6 %.
LOG_K = 12
#: Estimates this near the threshold, relative to it (three errors) or by one site, are counted exactly.
BAND = 0.05


def line_key(line: Column) -> Column:
    """128 bits of a line without the white space around it."""
    trimmed = F.trim(line, F.lit(" \t\r"))
    return F.struct(F.xxhash64(trimmed).alias("a"), F.xxhash64(F.lit(1), trimmed).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _eligible(text: Column, min_chars: int) -> Column:
    long = F.filter(_lines(text), lambda x: F.length(F.trim(x, F.lit(" \t\r"))) >= min_chars)
    return F.array_distinct(F.transform(long, line_key))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(line, site, id, doc)``: the distinct lines of every document."""
    site = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("none"))
    key = row_key(docs)
    return docs.select(
        site.alias("site"), key.getField("id").alias("id"), key_text(key).alias("doc"), F.explode(_eligible(F.col("text"), min_chars)).alias("line")
    )


def spread(occurrence: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(line, first)`` of the lines that ``min_sites`` or more distinct sites show.

    One sketch of sites per line, filled on the map side and merged by the
    aggregation, so a line in every document costs one sketch per task. Only
    lines whose estimate lies near the threshold are counted exactly, from
    their distinct (line, site) pairs. ``first`` is the document with the
    smallest id (nulls last, then the smaller key) that has the line.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc"))
    sketched = materialise(
        occurrence.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LOG_K)).alias("sketch"), first.alias("first"))
        .select("line", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .filter(F.col("sites") >= min_sites - max(1, BAND * min_sites)),
        "lines-spread",
    )
    near = F.abs(F.col("sites") - min_sites) <= max(1, BAND * min_sites)
    pairs = occurrence.join(sketched.filter(near).select("line"), "line", "left_semi").select("line", "site").distinct()
    exact = pairs.groupBy("line").agg(F.count("*").alias("exact")).filter(F.col("exact") >= min_sites)
    sure = sketched.filter(~near).select("line", "first")
    return sure.unionByName(sketched.join(exact, "line", "left_semi").select("line", "first"))


def remove_boilerplate(
    docs: DataFrame, *, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS
) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without boilerplate, ``n_removed`` lines fewer.

    Lines are what newlines part; two lines are equal if they are once the
    white space around them is gone. A line of ``min_chars`` or more shown by
    ``min_sites`` or more distinct sources is boilerplate: it stays in the
    document with the smallest id that has it (there as often as it stands)
    and goes everywhere else, so that of copies on many sites one stays whole.
    A null source is a site of its own. A text without such lines, a null and
    an empty one are returned unchanged; a text that was boilerplate alone
    becomes empty. Rows equal in id, source and text fare alike. A column
    ``n_removed`` of the input is replaced. An empty table gives none.
    """
    found = materialise(occurrences(docs, min_chars), "lines")
    bad = materialise(spread(found, min_sites), "lines-boilerplate")
    gone = (
        found.join(bad, "line")
        .filter(F.col("doc") != F.col("first.doc"))
        .groupBy("doc")
        .agg(F.collect_set("line").alias("__gone"))
    )
    marked = docs.withColumn("__doc", key_text(row_key(docs)))
    joined = marked.join(gone.withColumnRenamed("doc", "__doc"), "__doc", "left")
    lines = _lines(F.col("text"))
    kept = F.filter(lines, lambda x: ~F.array_contains("__gone", line_key(x)))
    touched = F.col("__gone").isNotNull()
    out = joined.withColumn("__kept", F.when(touched, kept))
    return out.withColumns(
        {
            "n_removed": F.when(touched, F.size(lines) - F.size("__kept")).otherwise(F.lit(0)),
            "text": F.when(touched, F.array_join("__kept", "\n")).otherwise(F.col("text")),
        }
    ).select(*(c for c in docs.columns if c != "n_removed"), "n_removed")


def clean_lines(docs: DataFrame, **options) -> DataFrame:
    """``remove_boilerplate`` as a filter: n_chars follows the text, documents left empty by it go."""
    cleaned = remove_boilerplate(docs, **options)
    kept = cleaned.filter((F.col("n_removed") == 0) | (F.trim("text", F.lit(" \t\r\n")) != ""))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


ORACLE_SQL = r"""
with raw as (
  select doc_id, coalesce('=' || source, 'none') as site, unnest(string_split(coalesce(text, ''), chr(10))) as line from documents
), lined as (
  select distinct doc_id, site, trim(line, ' ' || chr(9) || chr(13)) as line from raw
  where length(trim(line, ' ' || chr(9) || chr(13))) >= 20
), bad as (
  select line, min(doc_id) as first from lined group by line having count(distinct site) >= 5
), gone as (
  select l.doc_id, list(l.line) as gone from lined l join bad b on l.line = b.line and l.doc_id <> b.first group by l.doc_id
), split as (
  select d.doc_id, d.text, string_split(coalesce(d.text, ''), chr(10)) as lines,
         list_filter(string_split(coalesce(d.text, ''), chr(10)),
                     lambda x: not list_contains(g.gone, trim(x, ' ' || chr(9) || chr(13)))) as kept, g.gone
  from documents d left join gone g on g.doc_id = d.doc_id
)
select doc_id, cast(case when gone is null then 0 else len(lines) - len(kept) end as integer) as n_removed,
       case when gone is null then text else array_to_string(kept, chr(10)) end as text
from split
"""
