"""Query of the main-text extraction (SQL has no maximum flow; tests hold it against brute force over all cuts and the pages' own articles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import main_text as op
from ledgerlink.llm.frames import table


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return op.main_text(pages, keep_html=False).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
