"""Removes lines that many sites share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, unused


def _rebuilt(lines: Column, gone: Column) -> Column:
    """``lines`` without the positions in the sorted array ``gone``.

    The stretches between removed lines are cut out whole, so the cost is
    linear in the number of lines.
    """

    def stretch(i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1)
        end = F.coalesce(F.get(gone, i), F.size(lines))
        return F.slice(lines, start + 1, end - start)

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch)), "\n")


def drop_shared_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = 10,
    lg_k: int = 12,
) -> DataFrame:
    """``docs`` without boilerplate lines, plus ``n_lines`` and ``n_removed``.

    A line is boilerplate if it stands on ``min_sites`` sites or more. Its first
    occurrence, by document id and position, stays, so text that only exists in
    copies is not lost. Lines are compared without blanks at their ends; blank
    lines always stay.

    One HyperLogLog sketch of the sites per line hash is merged by aggregation.
    Lines whose estimate lies within five standard errors (and at least one
    site) of ``min_sites`` are counted exactly, which needs only the rows of the
    lines that pass the lower bound.

    Null texts stay null with 0 lines, the empty text has one blank line; a null
    site counts as one unnamed site; a null document id comes first. Rows that
    repeat id and text get the same result. Other columns pass through; if
    ``n_lines`` or ``n_removed`` is taken, an underscore is added to the new one.
    """
    raw = docs.select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(text).alias("text_hash"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"),
    )
    line = F.trim("line")
    lines = raw.where(line != "").select(
        "doc", "text_hash", "site", "pos", F.xxhash64(line).alias("h"), F.hash(line).alias("g")
    )
    slack = max(1, math.ceil(5 * 1.04 / math.sqrt(2**lg_k) * min_sites))
    spread = (
        lines.groupBy("h", "g")
        .agg(
            F.hll_sketch_agg("site", lg_k).alias("sketch"),
            F.min(F.struct("doc", "pos")).alias("first"),
        )
        .select("h", "g", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites - slack)
        .select("h", "g", "first", (F.col("sites") > min_sites + slack).alias("sure"))
    )
    # Written first: a join of two shuffled sides can be split where one line is very common.
    spread = staged(spread, "line-spread")
    rows = staged(lines.join(spread, ["h", "g"]), "shared-lines")
    counted = (
        rows.where(~F.col("sure"))
        .groupBy("h", "g", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("h", "g")
        .agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= min_sites)
        .select("h", "g")
    )
    first = F.col("first.doc").eqNullSafe(F.col("doc")) & (F.col("first.pos") == F.col("pos"))
    later = rows.where(~first)
    # Very common lines are sure: their rows go on without a join. The others meet a written table.
    sure = later.where("sure").select("doc", "text_hash", "pos")
    close = later.where(~F.col("sure")).join(staged(counted, "counted-lines"), ["h", "g"], "left_semi")
    gone = (
        sure.unionByName(close.select("doc", "text_hash", "pos"))
        .groupBy("doc", "text_hash")
        .agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )
    key, hashed, dropped, n_lines, n_removed = unused(
        docs, "line_doc", "line_hash", "line_gone", "n_lines", "n_removed"
    )
    gone = gone.toDF(key, hashed, dropped)
    out = docs.join(
        gone,
        docs[doc_id].eqNullSafe(gone[key]) & (F.xxhash64(docs[text]) == gone[hashed]),
        "left",
    )
    parts = F.split(F.col(text), "\n")
    return out.select(
        *[
            (
                F.when(F.col(dropped).isNull(), F.col(text)).otherwise(_rebuilt(parts, F.col(dropped))).alias(text)
                if c == text
                else F.col(c)
            )
            for c in docs.columns
        ],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long").alias(n_lines),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias(n_removed),
    )


LINES_SQL = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), shared AS (
  SELECT trim(line) AS line, min((doc_id, pos)) AS first
  FROM lines WHERE trim(line) <> ''
  GROUP BY 1 HAVING count(DISTINCT coalesce(source, '')) >= 10
), marked AS (
  SELECT l.doc_id, l.pos, l.line, s.line IS NOT NULL AND s.first <> (l.doc_id, l.pos) AS gone
  FROM lines l LEFT JOIN shared s ON trim(l.line) = s.line
)
SELECT doc_id,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
FROM marked GROUP BY doc_id
UNION ALL
SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
"""
