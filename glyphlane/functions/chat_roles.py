"""Role names of training turns and of the chat template."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def template_role(speaker: Column) -> Column:
    return F.when(speaker == "human", "user").otherwise("assistant")


def speaker(role: Column) -> Column:
    return F.when(role == "user", "human").otherwise("gpt")
