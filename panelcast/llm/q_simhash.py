"""op4: fingerprints and near-duplicate groups of all ``documents``."""

from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.registry import register
from panelcast.llm.simhash import hex_fingerprint, near_duplicates


@register("op4_simhash_dedup")
def op4(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")
