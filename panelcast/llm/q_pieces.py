"""op12: every text of ``documents`` encoded with a public SentencePiece model and decoded again."""

from panelcast.llm.common import table
from panelcast.llm.registry import register

MODEL = "piece_bpe_32k.model"


@register("op12_sentence_pieces")
def op12(spark, sf_dir, model_file: str | None = None):
    from panelcast.llm.sentence_pieces import piece_digests
    if model_file is None:
        import public_tokenizers
        model_file = public_tokenizers.path(MODEL)
    return piece_digests(table(spark, sf_dir, "documents"), model_file)
