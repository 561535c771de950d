"""Property-transaction price statistics per cadastral section and commune.

Input (``read_dvf`` or any DataFrame with these columns): ``id_mutation``,
``nature_mutation``, ``valeur_fonciere``, ``surface_reelle_bati``,
``id_parcelle`` and ``departement`` (the file the row came from).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .quantiles import exact_quantiles

# --- fixed values -----------------------------------------------------------
# Kinds of mutation that count as a sale.
SALE_KINDS = ["Vente", "Vente en l'état futur d'achèvement", "Adjudication"]
# --- end of fixed values ----------------------------------------------------


def section_id(parcel: Column) -> Column:
    """First 10 characters of the parcel id; NULL when shorter or NULL."""
    return F.when(F.length(parcel) >= 10, F.substring(parcel, 1, 10))


def built_sales(dvf: DataFrame) -> DataFrame:
    """Sales with a positive built surface, with price per m2 (one row per line).

    A mutation spanning several rows repeats the full sale value on each row;
    statistics are over rows, sale counts over distinct mutation ids.
    """
    return (dvf
            .where(F.col("nature_mutation").isin(SALE_KINDS)
                   & F.col("valeur_fonciere").isNotNull())
            .select("departement", "id_mutation",
                    F.col("valeur_fonciere").cast("double").alias("valeur_fonciere"),
                    F.col("surface_reelle_bati").cast("double").alias("surface_reelle_bati"),
                    section_id(F.col("id_parcelle")).alias("section_id"))
            .where(F.col("section_id").isNotNull() & (F.col("surface_reelle_bati") > 0))
            .withColumn("prix_m2", F.col("valeur_fonciere") / F.col("surface_reelle_bati"))
            .withColumn("code_commune", F.substring("section_id", 1, 5)))


#: One row for every different sale line, and how often it comes.
_LINE = ["departement", "section_id", "code_commune", "id_mutation", "prix_m2", "surface_reelle_bati"]


def counted_sales(dvf: DataFrame) -> DataFrame:
    """The built sales as different lines and their counts ``n``: the one read
    of the transactions, from which every statistic follows."""
    bati = built_sales(dvf).where(F.col("departement").isNotNull())
    # Every use needs the count, so that all of them share one shuffle.
    return bati.groupBy(*_LINE).agg(F.count("*").alias("n")).where(F.col("n") > 0)


def staged_sales(dvf: DataFrame) -> DataFrame:
    """:func:`counted_sales`, written to the checkpoint folder for several jobs."""
    return materialize(counted_sales(dvf), "sales")


def _totals(lines: DataFrame, keys: list[str], distinct: str, mean: str, count: str) -> DataFrame:
    """Mean price over lines and number of different ``distinct`` per group,
    from rows already reduced to one per ``distinct``."""
    each = lines.groupBy(*keys, distinct).agg(F.sum(F.col("prix_m2") * F.col("n")).alias("s"),
                                              F.sum(F.when(F.col("prix_m2").isNotNull(), F.col("n"))).alias("c"))
    return each.groupBy(*keys).agg((F.sum("s") / F.sum("c")).alias(mean), F.count(distinct).alias(count))


def section_prices(dvf: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Per (departement, section_id): q1/median/q3/mean of EUR/m2, distinct
    sales and median built surface (exact quantiles, linear interpolation).
    ``lines``, if given, are :func:`staged_sales` of ``dvf``, and the
    quantiles are made step by step; otherwise the result is lazy.
    """
    keys = ["departement", "section_id"]
    staged = lines is not None
    lines = lines if staged else counted_sales(dvf)
    q = exact_quantiles(lines, keys, [
        ("prix_m2", 0.25, "prix_m2_q1"), ("prix_m2", 0.5, "prix_m2_median"),
        ("prix_m2", 0.75, "prix_m2_q3"), ("surface_reelle_bati", 0.5, "surface_mediane")], "n", staged)
    return _totals(lines, keys, "id_mutation", "prix_m2_mean", "nb_ventes").join(q, keys).select(
        "section_id", "prix_m2_q1", "prix_m2_median", "prix_m2_q3", "prix_m2_mean", "nb_ventes",
        "surface_mediane", "departement")


def commune_prices(dvf: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Per (departement, code_commune): median and mean EUR/m2 over raw rows,
    distinct sales and distinct sections.  ``lines`` as in
    :func:`section_prices`."""
    keys = ["departement", "code_commune"]
    staged = lines is not None
    lines = lines if staged else counted_sales(dvf)
    totals = _totals(lines, keys, "section_id", "commune_mean_price_sqm", "commune_sections_count")
    sales = lines.groupBy(*keys, "id_mutation").agg(F.sum("n")).groupBy(*keys).agg(F.count("id_mutation").alias("commune_sales_count"))
    q = exact_quantiles(lines, keys, [("prix_m2", 0.5, "commune_median_price_sqm")], "n", staged)
    return totals.join(sales, keys).join(q, keys).select(
        "code_commune", "commune_median_price_sqm", "commune_mean_price_sqm",
        "commune_sales_count", "commune_sections_count", "departement")
