"""Cleaning rules: a small JSON file, read once on the driver and put into plans as literals."""

from __future__ import annotations

import json
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from pagetables.profile import CleaningRules

log = logging.getLogger(__name__)


def load_rules(spark: SparkSession, path: str) -> CleaningRules:
    """A missing or unreadable file gives empty rules; an empty phrase or marker is an error."""
    try:
        text = spark.read.text(path, wholetext=True).head()
        data = json.loads(text.value) if text else {}
    except (AnalysisException, json.JSONDecodeError) as error:
        log.warning("cleaning rules not loaded from %s: %s", path, error)
        return CleaningRules()
    rules = CleaningRules(tuple(data.get("scam_phrases", ())), tuple(data.get("cutoff_markers", ())))
    if "" in rules.scam_phrases + rules.cutoff_markers:
        raise ValueError(f"empty phrase or marker in {path}")
    return rules
