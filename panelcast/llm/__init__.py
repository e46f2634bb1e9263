"""Text operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from __future__ import annotations


def load_queries():
    """Import the modules that register queries; returns the registry."""
    from panelcast.llm import q_chat, q_decontaminate, q_hard_negatives, q_html, q_packing, q_pieces, q_pipeline, q_ppm, q_quality, q_secrets, q_simhash, q_substrings, q_turns, q_url_filter, registry  # noqa: F401
    return registry
