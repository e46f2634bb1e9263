"""op3: main text of all ``pages``."""

from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.html_crf import extract, fit
from panelcast.llm.registry import register


@register("op3_html_extract")
def op3(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages, fit(pages)).select("page_id", "url", "text")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
