"""op1: main text of all pages."""

from pyspark.sql import functions as F

from clickloom.llm import html_text
from clickloom.llm.queries.registry import register


@register("op1_main_text")
def op1_main_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    texts = html_text.extract_pages(pages).select("page_id", "url", "text")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
