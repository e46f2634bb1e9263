"""op8: all ``documents`` packed into bins of 2,048 words."""

from panelcast.llm.common import table
from panelcast.llm.packing import pack
from panelcast.llm.registry import register


@register("op8_best_fit_packing")
def op8(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
