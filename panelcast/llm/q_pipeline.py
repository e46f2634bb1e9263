"""pipeline: all stages of ``corpus_pipeline`` on ``documents``."""

import corpus_pipeline
from panelcast.llm.registry import register


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
