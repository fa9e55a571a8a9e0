"""The subpackage's queries, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftwell.llm import decontamination, language_model, licenses, packing, pii, quality_classifier, quality_rules, secrets, simhash, substring_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_quality_classifier": quality_classifier.op3_quality_classifier,
    "op4_pii": pii.op4_pii,
    "op5_language_model": language_model.op5_language_model,
    "op6_secret_scan": secrets.op6_secret_scan,
    "op7_packing": packing.op7_packing,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_simhash": simhash.op9_simhash,
    "op10_quality_rules": quality_rules.op10_quality_rules,
}
ORACLES = {"op1_decontamination": decontamination.ORACLE_SQL, "op2_substring_dedup": substring_dedup.ORACLE_SQL}
