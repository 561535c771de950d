"""Urban-planning zones: document status per commune, zone harmonisation and
the covered-commune zone/prescription tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.crs import source_crs, to_wgs84

# --- fixed values -----------------------------------------------------------
# Exact zone types and their category; other types fall back on their base
# type after stripping trailing digits and c/s/h suffixes.
ZONE_CATEGORIES = {"U": "urban", "AUc": "to_urbanize", "AUs": "to_urbanize_strict",
                   "AU": "to_urbanize", "A": "agricultural", "N": "natural"}
BASE_TYPES = ["U", "AU", "A", "N"]
ZONE_SUFFIX = "[0-9csCShH]+$"
# --- end of fixed values ----------------------------------------------------


def zone_category(typezone: Column) -> Column:
    """Planning zone type -> normalised category (``other`` when unknown)."""
    exact = F.create_map(*[x for k, v in ZONE_CATEGORIES.items() for x in (F.lit(k), F.lit(v))])
    base = F.upper(F.regexp_replace(typezone, ZONE_SUFFIX, ""))
    fallback = None
    for b in BASE_TYPES:
        c = F.when(base == b, F.lit(ZONE_CATEGORIES[b]))
        fallback = c if fallback is None else fallback.when(base == b, F.lit(ZONE_CATEGORIES[b]))
    return F.coalesce(exact[typezone], fallback, F.lit("other"))


def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """Optional column: its value when present in the layer, else NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def document_status(docs: DataFrame, communes: DataFrame, deps: Iterable[str]) -> DataFrame:
    """Planning-document type per commune of the requested departments.

    A department sees the documents whose partition starts with
    ``DU_<dep>``; for each of its communes the document with the highest
    ``gid`` wins (its type may be NULL).  Communes without a document get a
    NULL type (national rules, 'RNU').
    """
    deps = list(deps)
    # partition LIKE 'DU_<dep>%': the candidates are the 2- and 3-character
    # codes after the 'DU_' prefix that are requested departments.
    part = F.col("partition")
    cands = F.array_distinct(F.array(*[F.substring(part, 4, n)
                                       for n in sorted({len(x) for x in deps})]))
    d = (docs.where(F.col("grid_name").isNotNull() & (F.col("grid_name") != "")
                    & part.startswith("DU_"))
         .select("grid_name", "du_type", "gid",
                 F.explode(F.filter(cands, lambda x: x.isin(deps))).alias("departement")))
    com = communes.where(F.col("departement").isin(deps)).select("code_commune", "departement")
    hit = d.join(com, (d.grid_name == com.code_commune) & (d.departement == com.departement)) \
        .select(com.code_commune, com.departement, d.du_type, d.gid)
    last = hit.groupBy("departement", "code_commune").agg(F.max_by("du_type", "gid").alias("du_type"))
    return com.join(last, ["departement", "code_commune"], "left") \
        .select("code_commune", "du_type", "departement")


def document_type_counts(status: DataFrame) -> DataFrame:
    """Communes per document type and department (no document -> 'RNU')."""
    return status.groupBy("departement", F.coalesce("du_type", F.lit("RNU")).alias("du_type")) \
        .agg(F.count(F.lit(1)).alias("n"))


def _covered(features: DataFrame, status: DataFrame) -> DataFrame:
    covered = status.where(F.col("du_type").isNotNull()).select(
        F.col("code_commune").alias("commune"), "departement")
    return features.join(covered, ["commune", "departement"], "left_semi")


def covered_zones(zones: DataFrame, status: DataFrame, src_epsg: int = 2154) -> DataFrame:
    """Zoning features of covered communes, harmonised and in WGS84."""
    z = _covered(zones, status)
    return z.select(
        "typezone", zone_category(F.col("typezone")).alias("zone_category"),
        "libelle", "libelong", col_or_null(z, "destdomi").alias("destdomi"), "idurba",
        col_or_null(z, "datappro").alias("datappro"), col_or_null(z, "urlfic").alias("urlfic"),
        "departement", to_wgs84(F.col("geom"), source_crs(z, src_epsg)).alias("geom"))


def covered_prescriptions(presc: DataFrame, status: DataFrame, src_epsg: int = 2154) -> DataFrame:
    """Prescription features of covered communes, in WGS84."""
    p = _covered(presc, status)
    return p.select(
        "typepsc", col_or_null(p, "stypepsc").alias("stypepsc"), "libelle",
        col_or_null(p, "txt").alias("txt"), "departement",
        to_wgs84(F.col("geom"), source_crs(p, src_epsg)).alias("geom"))


def union_layers(layers) -> DataFrame:
    """Stack per-commune downloads of differing schemas by column name."""
    out = None
    for layer in layers:
        out = layer if out is None else out.unionByName(layer, allowMissingColumns=True)
    return out
