"""Links out of raw web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from finfacts.functions import last_path_segment

# An href stands in double quotes, in single quotes, or alone up to white space.
ANCHOR = (
    r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>([^<]*)"""
)
TABLE_EDGE = r"(?i)(?=</?table\b)"


def _inside_tables(html: Column) -> Column:
    """The parts of a page within tables, nested ones and what follows them included."""
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, part: Column) -> Column:
        opens, closes = F.lower(part).startswith("<table"), F.lower(part).startswith("</table")
        depth = F.greatest(acc["depth"] + opens.cast("int") - closes.cast("int"), F.lit(0))
        kept = F.when(depth > 0, F.array_append(acc["kept"], part)).otherwise(acc["kept"])
        return F.struct(depth.alias("depth"), kept.alias("kept"))

    parts = F.aggregate(F.split(html, TABLE_EDGE), start, step, lambda acc: acc["kept"])
    return F.array_join(parts, "\n")


def extract_links(
    pages: DataFrame, text_like: str = "Q", inside_table: bool = True
) -> DataFrame:
    """Anchors whose leading text contains ``text_like``: page, link, text and file name.

    ``inside_table`` keeps only anchors within an HTML table.
    """
    html = _inside_tables(F.col("html")) if inside_table else F.col("html")
    found = [F.regexp_extract_all("_html", F.lit(ANCHOR), i).alias(f"g{i}") for i in range(1, 5)]
    anchors = pages.select("page_id", html.alias("_html")).select(
        "page_id", F.explode(F.arrays_zip(*found)).alias("a"))
    links = anchors.select(
        "page_id", F.concat("a.g1", "a.g2", "a.g3").alias("href"), F.col("a.g4").alias("link_text"))
    return links.filter(F.col("link_text").contains(text_like)).select(
        "*", last_path_segment(F.col("href")).alias("file_name"))
