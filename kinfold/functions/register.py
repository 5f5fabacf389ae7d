"""The scalar functions for SQL, by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import folding, fuzzy, phonetics


def register(spark: SparkSession) -> list[str]:
    found = {"kf_fold": folding._fold, "kf_phonetic_keys": phonetics.phonetic_keys, "kf_fuzzy_ratios": fuzzy.ratios}
    for name, f in found.items():
        spark.udf.register(name, f)
    return list(found)
