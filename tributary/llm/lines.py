"""Site-relative line frequency: lines that too many pages of one host share are dropped.

For each host, the number of its pages that hold a line is divided by the number of its
pages. A line is boilerplate of that host when the quotient exceeds `ratio` and at least
`min_pages` pages hold it; `also` names a second such pair, for hosts as large as a source,
of which a shared line takes a small part only. Everything is a DataFrame expression. Lines are counted by two
64-bit hashes with partial aggregation, so a host with a third of all pages is spread over
all tasks. A host has at most (mean lines per page / least ratio) boilerplate lines, which go back
to its pages in one join; texts themselves are never grouped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written


def _key(line: Column) -> Column:
    clean = F.trim(line)
    return F.struct(F.xxhash64(clean).alias("a"), F.xxhash64(F.lit(1), clean).alias("b"))


def _blank(line: Column) -> Column:
    return F.trim(line) == ""


def line_counts(pages: DataFrame, host: str, text: str) -> DataFrame:
    """(host, a, b, n_pages): how many pages of the host hold the line of that key."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~_blank(x))
    keys = F.array_distinct(F.transform(lines, _key))
    held = pages.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), F.explode(keys).alias("k"))
    return held.groupBy("host", "k.a", "k.b").agg(F.count(F.lit(1)).alias("n_pages"))


def boilerplate(
    pages: DataFrame, host: str, text: str, ratio: float, min_pages: int, also: tuple[float, int] | None = None
) -> DataFrame:
    """(host, keys): the boilerplate line keys of each host that has any."""
    totals = (
        pages.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("total"))
    )
    pairs = [(ratio, min_pages), *([also] if also else [])]
    common = line_counts(pages, host, text).where(F.col("n_pages") >= min(least for _, least in pairs)).join(totals, "host")
    share = F.col("n_pages") / F.col("total")
    common = common.where(reduce(Column.__or__, [(share > part) & (F.col("n_pages") >= least) for part, least in pairs]))
    return common.groupBy("host").agg(F.collect_set(F.struct("a", "b")).alias("keys"))


def drop_boilerplate(
    pages: DataFrame,
    *,
    host: str,
    text: str = "text",
    ratio: float = 0.3,
    min_pages: int = 3,
    also: tuple[float, int] | None = None,
) -> DataFrame:
    """`pages` with `text` without its host's boilerplate lines, and n_lines, n_dropped.

    A line is what stands between newlines; it is compared without outer spaces. Blank lines
    are neither counted nor dropped, and a line that a page repeats counts once for it. Null
    texts stay null with no lines, a page that loses every line keeps an empty text, and rows
    of a null host keep theirs. Repeated rows count as pages of their own. Other columns are
    carried along; columns named n_lines or n_dropped are replaced.
    """
    # Stored, so that its size is known when the join is planned: small, it goes to the pages
    # and no text is shuffled; large, the join by host is one that splits a hot host.
    found = written(boilerplate(pages, host, text, ratio, min_pages, also), "lines-boilerplate")
    found = found.select(F.col("host").alias("__host"), F.col("keys").alias("__keys"))
    columns = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    joined = pages.select(*columns).join(found, F.col(host) == F.col("__host"), "left")
    lines = F.split(text, "\n")
    gone = lambda x: ~_blank(x) & F.array_contains(F.col("__keys"), _key(x))
    kept = F.when(F.col("__keys").isNull(), lines).otherwise(F.filter(lines, lambda x: ~gone(x)))
    size = lambda x: F.coalesce(F.size(F.filter(x, lambda y: ~_blank(y))), F.lit(0))
    cleaned = joined.withColumn("__kept", kept)
    counts = [
        F.when(F.col(text).isNull(), 0).otherwise(size(lines)).alias("n_lines"),
        F.when(F.col(text).isNull(), 0).otherwise(size(lines) - size(F.col("__kept"))).alias("n_dropped"),
    ]
    new_text = F.array_join("__kept", "\n").alias(text)
    return cleaned.select(*[new_text if c == text else F.col(c) for c in columns], *counts)


def html_lines(html: str) -> Column:
    """Text of a page as lines: what stands between tags, blank parts left out."""
    parts = F.transform(F.split(html, r"<[^>]*>|\n"), lambda x: F.trim(x))
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n")


HTML_LINES_SQL = (
    "list_filter(list_transform(regexp_split_to_array(html, '<[^>]*>|\\n'), lambda x: trim(x, ' ')), lambda x: x <> '')"
)
PAGES_SQL = f"""
    WITH p AS (
        SELECT page_id, regexp_extract(url, '://([^/:?#]+)', 1) AS host, {HTML_LINES_SQL} AS lines FROM pages
    ), h AS (SELECT host, count(*) AS total FROM p GROUP BY host
    ), c AS (
        SELECT host, line, count(DISTINCT page_id) AS n
        FROM (SELECT host, page_id, unnest(lines) AS line FROM p) GROUP BY host, line
    ), b AS (
        SELECT host, list(line) AS gone FROM c JOIN h USING (host)
        WHERE n >= 3 AND n / total > 0.3 GROUP BY host
    ), k AS (
        SELECT page_id, host, lines,
            CASE WHEN gone IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(gone, x)) END AS kept
        FROM p LEFT JOIN b USING (host)
    )
    SELECT page_id, host, array_to_string(kept, chr(10)) AS text,
        CAST(len(lines) AS INT) AS n_lines, CAST(len(lines) - len(kept) AS INT) AS n_dropped
    FROM k
"""
