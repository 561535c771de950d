"""Commune-level indicator tables: crime pivot and rent indicators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.departments import dep_of, in_departments_prefix
from ..functions.text import decimal_comma, slug, slug_py


# ----------------------------------------------------------------- crime (A3)
def crime_pairs(df: DataFrame, year: int, deps: Iterable[str]) -> DataFrame:
    """One row per (commune, indicator): first non-null rate and count in
    file order (``ordinal``).  Map-side combined, skew-safe."""
    rows = (df.where((F.col("annee") == year) & in_departments_prefix(F.col("CODGEO_2025"), deps))
            .select(F.col("CODGEO_2025").alias("code_commune"),
                    F.col("indicateur").alias("indicator"),
                    decimal_comma(F.col("taux_pour_mille")).alias("rate"),
                    decimal_comma(F.col("nombre")).alias("cnt"),
                    F.col("ordinal"))
            .where(F.col("code_commune").isNotNull() & F.col("indicator").isNotNull()))
    return rows.groupBy("code_commune", "indicator").agg(
        F.min_by("rate", F.when(F.col("rate").isNotNull(), F.col("ordinal"))).alias("rate"),
        F.min_by("cnt", F.when(F.col("cnt").isNotNull(), F.col("ordinal"))).alias("cnt"))


def crime_indicators(pairs: DataFrame) -> tuple[list[str], list[str]]:
    """Indicators having any non-null rate / any non-null count.

    The result sizes the output schema, so it is read on the driver; it is
    bounded by the number of distinct indicators (a fixed nomenclature).
    """
    stats = (pairs.groupBy("indicator")
             .agg(F.max(F.col("rate").isNotNull().cast("int")).alias("r"),
                  F.max(F.col("cnt").isNotNull().cast("int")).alias("c"))
             .collect())
    rates = sorted(r["indicator"] for r in stats if r["r"])
    counts = sorted(r["indicator"] for r in stats if r["c"])
    return rates, counts


def crime_pivot(df: DataFrame, year: int, deps: Iterable[str],
                indicators: tuple[list[str], list[str]] | None = None) -> DataFrame:
    """One row per commune, ``taux_<slug>`` and ``nb_<slug>`` per indicator.

    Input columns: CODGEO_2025, annee, indicateur, taux_pour_mille, nombre
    (text, decimal comma) and ``ordinal`` (file order).  Communes without any
    rate are dropped (the rate pivot drives a left join); the department is
    3 characters for overseas codes.
    """
    pairs = crime_pairs(df, year, deps)
    rates, counts = indicators if indicators is not None else crime_indicators(pairs)
    aggs = [F.max(F.when(F.col("indicator") == i, F.col("rate"))).alias(f"taux_{slug_py(i)}")
            for i in rates]
    aggs += [F.max(F.when(F.col("indicator") == i, F.col("cnt"))).alias(f"nb_{slug_py(i)}")
             for i in counts]
    has_rate = F.max(F.col("rate").isNotNull().cast("int")).alias("_has_rate")
    wide = pairs.groupBy("code_commune").agg(*aggs, has_rate)
    return (wide.where(F.col("_has_rate") == 1).drop("_has_rate")
            .withColumn("departement", dep_of(F.col("code_commune"))))


# ------------------------------------------------------------------ rents (A4)
RENT_COLUMNS = [
    ("INSEE_C", "code_commune", "text"), ("DEP", "departement", "text"),
    ("loypredm2", "loyer_m2_median", "num"), ("lwr.IPm2", "loyer_m2_lower", "num"),
    ("upr.IPm2", "loyer_m2_upper", "num"), ("TYPPRED", "prediction_type", "text"),
    ("nbobs_com", "nb_obs", "num"), ("R2_adj", "r2_adj", "num"),
]


def parse_rents(df: DataFrame, type_local: str) -> DataFrame:
    """Normalise one rent-indicator file (decimal-comma numbers, codes as text)."""
    cols = []
    for src, dst, kind in RENT_COLUMNS:
        c = F.col(f"`{src}`")
        cols.append((decimal_comma(c) if kind == "num" else c.cast("string")).alias(dst))
    out = df.select(*cols).withColumn("type_local", F.lit(type_local))
    return out.select("code_commune", "type_local", "departement", "loyer_m2_median",
                      "loyer_m2_lower", "loyer_m2_upper", "prediction_type", "nb_obs", "r2_adj")


def rents_long(frames: Mapping[str, DataFrame], deps: Iterable[str] | None = None) -> DataFrame:
    """Stack the per-type files into one long table, filtered to departments."""
    out = None
    for type_local, df in frames.items():
        p = parse_rents(df, type_local)
        out = p if out is None else out.unionByName(p)
    deps = list(deps or [])
    if deps:
        out = out.where(F.col("departement").isin(deps))
    return out
