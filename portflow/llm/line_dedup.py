"""Line dedup by site-relative frequency.

Pages are grouped by host; a line's frequency is the number of the host's pages that contain it beside one of them,
divided by the number of the host's pages.  So a line of a single page has frequency zero on a host of any size, and a
notice on all pages of a host with two has one half.  A page is a distinct text: copies of a page count once, so that a
copied article is not taken for boilerplate.  Lines above the ratio go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.common import free_name, written

RATIO = 0.05
#: bytes of boilerplate lists that are broadcast; larger ones meet the documents in a shuffle join
BROADCAST_BYTES = 8 << 20
#: what a line must contain to count: a character that isn't ASCII white space
WORD = r"[^\x20\x09-\x0D]"


def _key(text: F.Column) -> F.Column:
    """128 bits of a text."""
    return F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))


def _lines(text: F.Column) -> F.Column:
    return F.split(text, "\n", -1)


def _counted(line: F.Column) -> F.Column:
    return F.rlike(line, F.lit(WORD))


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO) -> DataFrame:
    """host, bad: the keys of the host's boilerplate lines.

    A host's lines above the ratio are at most its mean number of lines per page divided by the ratio, whatever its
    number of pages; so ``bad`` is bounded and fits in a row.
    """
    line = F.transform(F.filter(_lines(F.col("text")), _counted), _key)
    pages = docs.where(F.col("text").isNotNull()).select(F.col(f"`{host}`").alias("host"), _key(F.col("text")).alias("page"), F.array_distinct(line).alias("lines"))
    pages = pages.groupBy("host", "page").agg(F.first("lines").alias("lines"))
    # a null line stands for the page itself: its count is the host's number of pages
    counts = pages.select("host", F.explode(F.array_append("lines", F.lit(None).cast("struct<x:bigint,y:bigint>"))).alias("line"))
    counts = written(counts.groupBy("host", "line").count().where((F.col("count") > 1) | F.col("line").isNull()), "line_counts")
    totals = counts.where("line is null").select(F.col("host").alias("h"), F.col("count").alias("pages"))
    over = counts.where("line is not null").join(totals, F.col("host").eqNullSafe(F.col("h"))).where(F.col("count") - 1 > ratio * F.col("pages"))
    return over.groupBy("host").agg(F.collect_list("line").alias("bad"))


def _checked(bad: DataFrame, broadcast_bytes: int) -> DataFrame:
    """The lists written once, with a broadcast hint if they are measured to be small: then no document is shuffled."""
    bad = written(bad, "boilerplate")
    row = F.octet_length(F.coalesce(F.col("host").cast("string"), F.lit(""))) + 40 * F.size("bad") + 64
    size = bad.agg(F.sum(row.cast("long"))).first()[0] or 0
    return F.broadcast(bad) if size <= broadcast_bytes else bad


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO,
                     n_lines: str | None = None, n_dropped: str | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without boilerplate lines; ``n_lines`` and ``n_dropped``, if named, are added as columns.

    Lines are separated by \\n.  Blank lines are never boilerplate; null hosts are one host; null texts stay null, and
    a text that loses all its lines becomes empty.  Repeated rows are cleaned each on its own; an empty table gives no
    rows.  Other columns stay as they are, whatever their names.
    """
    b, h = free_name(docs, "_bad"), free_name(docs, "_host")
    bad = _checked(boilerplate(docs, host, ratio), broadcast_bytes).select(F.col("host").alias(h), F.col("bad").alias(b))
    joined = docs.join(bad, F.col(f"`{host}`").eqNullSafe(F.col(h)), "left")
    kept = F.filter(_lines(F.col("text")), lambda x: ~(_counted(x) & F.array_contains(F.col(b), _key(x))))
    cleaned = F.when(F.col(b).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    total = F.coalesce(F.size(_lines(F.col("text"))).cast("long"), F.lit(0).cast("long"))
    total = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(total)
    dropped = F.when(F.col(b).isNull() | F.col("text").isNull(), F.lit(0).cast("long")).otherwise(total - F.size(kept))
    return joined.select(*(cleaned.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns),
                         *([total.alias(n_lines)] if n_lines else []), *([dropped.alias(n_dropped)] if n_dropped else []))


def oracle(ratio: float = RATIO) -> str:
    return f"""
WITH line AS (SELECT doc_id, source, text, pos, line, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS counted
    FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents WHERE text IS NOT NULL)),
total AS (SELECT source, count(DISTINCT text) AS pages FROM documents WHERE text IS NOT NULL GROUP BY source),
freq AS (SELECT source, line, count(DISTINCT text) AS n FROM line WHERE counted GROUP BY source, line),
bad AS (SELECT f.source, f.line FROM freq f JOIN total t ON f.source IS NOT DISTINCT FROM t.source WHERE f.n - 1 > {ratio} * t.pages),
cleaned AS (SELECT l.doc_id, count(*) AS n_lines, count(b.line) AS n_dropped,
        coalesce(string_agg(CASE WHEN b.line IS NULL THEN l.line END, chr(10) ORDER BY l.pos), '') AS text
    FROM line l LEFT JOIN bad b ON l.counted AND l.line = b.line AND l.source IS NOT DISTINCT FROM b.source GROUP BY l.doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, c.text AS text
FROM documents LEFT JOIN cleaned c USING (doc_id)
"""
