"""HTML bodies to plain text (the mail fallback), over a page table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logpulse.functions.text import html_to_text


def pages_to_text(pages: DataFrame, html_col: str = "html", id_cols=("page_id",)) -> DataFrame:
    return pages.select(*id_cols, html_to_text(html_col).alias("text"))
