"""op5: language of all ``documents``, learned from the folds that are not held out."""

from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.ppm import fit, held_out, identify
from panelcast.llm.registry import register


@register("op5_language_id")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"))
    model = fit(docs.filter(~out & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()))
    return identify(docs.select("doc_id", "text", out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")
