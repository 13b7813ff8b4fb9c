"""Registered queries over the given tables, each next to its check SQL."""

from __future__ import annotations

from importlib import import_module

from .registry import QUERIES, Query

MODULES = [
    "media_queries", "log_queries", "chat_queries", "prompt_queries", "sample_queries", "training_queries",
    "question_queries", "detection_queries", "answer_queries", "file_queries",
]


def load_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"{__name__}.{module}")
    return dict(QUERIES)
