"""Link discovery in saved HTML pages and download-manifest reconciliation.

Pages are processed whole (``regexp_extract_all`` over the full text inside
each task); links are de-duplicated with a shuffle on the URL, never on the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HREF = r'href="([^"]+)"'


def extract_links(pages: DataFrame, html: str = "html", page_url: str = "url", pattern: str = HREF,
                  keep: str | None = None, year_pattern: str | None = None) -> DataFrame:
    """Every link of every page, made absolute.

    Root-relative links (``/path``) get the scheme and host of their page;
    absolute ones are kept.  ``keep`` is an optional regex the link must
    match, ``year_pattern`` an optional regex whose group 1 is the year.
    """
    host = F.regexp_extract(F.col(page_url), r"^(https?://[^/?#]+)", 1)
    x = pages.select(host.alias("_host"), F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), 1)).alias("_l"))
    absolute = F.when(F.col("_l").startswith("/") & ~F.col("_l").startswith("//"),
                      F.concat(F.col("_host"), F.col("_l"))).otherwise(F.col("_l"))
    x = x.select(absolute.alias("link"))
    if keep:
        x = x.where(F.col("link").rlike(keep))
    if year_pattern:
        y = F.regexp_extract(F.col("link"), year_pattern, 1)
        x = x.withColumn("year", F.when(y != "", y.cast("int")))
    return x


def link_counts(links: DataFrame) -> DataFrame:
    """Distinct links with how often they occur."""
    return links.groupBy("link").agg(F.count(F.lit(1)).alias("n_refs"))


def reconcile_manifest(manifest: DataFrame, priority: list[str], min_year: int,
                       url: str = "url", category: str = "category", year: str = "year") -> DataFrame:
    """One row per URL: the first category in ``priority`` order wins; rows
    before ``min_year`` or without a year are dropped; sorted by (year, url)."""
    prio = F.create_map(*[x for i, c in enumerate(priority) for x in (F.lit(c), F.lit(i))])
    # min of (priority, year, category) per URL: a map-side combined aggregate,
    # so a URL listed millions of times never lands whole in one task
    best = F.min(F.struct(prio[F.col(category)].alias("p"), F.col(year).alias("y"), F.col(category).alias("c")))
    first = manifest.groupBy(url).agg(best.alias("_b")).select(
        url, F.col("_b.c").alias(category), F.col("_b.y").alias(year))
    return first.where(F.col(year) >= min_year).orderBy(year, url)


def outcome_stats(df: DataFrame, status: str = "status", category: str | None = "category") -> DataFrame:
    keys = [status] + ([category] if category else [])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
