"""All registered queries."""

from __future__ import annotations

from . import q_corpus, q_duplicates, q_files, q_mix, q_more, q_rank, q_sinks, q_state, q_stream, q_text  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
