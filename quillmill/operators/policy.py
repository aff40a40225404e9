"""The policy matrix: cells by tier, source type and stem pattern, with defaults by tier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (domain, tier, source type, stem pattern, gate action, correction strategy).
CELLS = [
    ("BPSY", 4, "integrated", "contrast_prompt", "audit", "judgment_error"),
    ("BPSY", 4, "integrated", "subtle_error", "audit", "judgment_error"),
    ("BPSY", 4, "integrated", "competing_evidence", "audit", "judgment_error"),
    ("BPSY", 4, "integrated", "integration", "audit", "judgment_error"),
    ("BPSY", 2, "anchor_grounded", "paraphrase", "audit", "rewrite_stem_to_observation"),
    ("BPSY", 2, "integrated", "simple_application", "audit", "rewrite_stem_to_observation"),
    ("BPSY", 3, "integrated", "clinical_vignette", "strict", "mechanism_inversion"),
    ("BPSY", 3, "integrated", "scenario_completion", "strict", "mechanism_inversion"),
    ("PETH", 2, "anchor_grounded", "paraphrase", "framework_aware", "framework_misapplication"),
    ("PETH", 2, "integrated", "comparison", "framework_aware", "framework_misapplication"),
    ("PETH", 3, "integrated", "clinical_vignette", "framework_aware", "framework_misapplication"),
    ("PETH", 3, "integrated", "scenario_completion", "framework_aware", "framework_misapplication"),
    ("PETH", 3, "integrated", "case_analysis", "framework_aware", "framework_misapplication"),
    ("PETH", 4, "integrated", "contrast_prompt", "framework_aware", "framework_misapplication"),
    ("PETH", 4, "integrated", "subtle_error", "framework_aware", "framework_misapplication"),
    ("PETH", 4, "integrated", "competing_evidence", "framework_aware", "framework_misapplication"),
    ("PETH", 4, "integrated", "best_answer", "framework_aware", "framework_misapplication"),
    ("PETH", 4, "integrated", "integration", "framework_aware", "framework_misapplication"),
]
# By tier the override threshold, whether detectors have to fire together, the prior.
TIER_DEFAULTS = {1: (0.75, False, None), 2: (0.75, False, None), 3: (0.85, False, None), 4: (0.95, True, "content_gap")}
DEFAULT_ACTION, DEFAULT_STRATEGY = "strict", "swap_for_content_distractor"
SCHEMA = "domain string, tier int, source_type string, stem_pattern string, gate_action string, correction_strategy string"
KEYS = ["domain", "tier", "source_type", "stem_pattern"]


def resolve(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Adds the cell's columns (J13): the domain's cell, completed by the tier's default;
    unknown keys get the default."""
    cells = spark.createDataFrame(CELLS, SCHEMA)
    joined = rows.join(F.broadcast(cells), KEYS, "left")  # 18 rows
    by = lambda i, kind: F.coalesce(*(F.when(F.col("tier") == t, F.lit(v[i])) for t, v in TIER_DEFAULTS.items())).cast(kind)
    return joined.withColumns(
        {
            "gate_action": F.coalesce("gate_action", F.lit(DEFAULT_ACTION)), "correction_strategy": F.coalesce("correction_strategy", F.lit(DEFAULT_STRATEGY)),
            "override_threshold": by(0, "double"), "co_firing_required": F.coalesce(by(1, "boolean"), F.lit(False)), "classification_prior": by(2, "string"),
        }
    )
