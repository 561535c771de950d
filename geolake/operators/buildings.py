"""Building register tables and multi-dwelling energy diagnostics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.crs import to_wgs84
from ..functions.geometry import point, with_geom
from ..functions.text import null_tokens
from ..functions.wkt import find_geom_col, parse_geopoint, parse_wkt

# --- fixed values -----------------------------------------------------------
# The eight building tables: the main table and its satellites.
BUILDING_TABLES = ["buildings", "construction", "energy_dpe", "natural_risks",
                   "property_values", "coproperty", "social_housing", "addresses"]
# Diagnostic fields kept from the energy-performance records.
DPE_FIELDS = [
    "numero_dpe", "type_batiment", "etiquette_dpe", "etiquette_ges",
    "conso_5_usages_par_m2_ep", "emission_ges_5_usages_par_m2",
    "type_energie_principale_chauffage", "type_energie_principale_ecs",
    "type_installation_chauffage", "type_installation_ecs",
    "qualite_isolation_enveloppe", "qualite_isolation_murs",
    "qualite_isolation_menuiseries", "qualite_isolation_plancher_bas",
    "qualite_isolation_plancher_haut_comble_perdu", "surface_habitable_immeuble",
    "nombre_niveau_immeuble", "nombre_appartement", "periode_construction",
    "cout_total_5_usages", "cout_chauffage", "cout_ecs", "date_etablissement_dpe",
    "code_postal_ban", "nom_commune_ban", "code_departement_ban", "code_insee_ban",
]
# --- end of fixed values ----------------------------------------------------

#: Column that joins the eight tables, and the number of buckets it is dealt
#: into: of a national register about 200 MB each; a parameter of the job.
KEY, BUCKETS = "batiment_groupe_id", 256


def building_table(df: DataFrame, src_epsg: int = 2154) -> DataFrame:
    """One building CSV table (all text): pandas missing tokens -> NULL; if a
    geometry text column exists it is parsed from WKT, reprojected to WGS84
    and stored as ``geom`` (rows with empty/NULL/invalid WKT dropped)."""
    cols = [null_tokens(F.col(f"`{c}`")).alias(c) for c in df.columns]
    out = df.select(*cols)
    gcol = find_geom_col(df.columns)
    if gcol is None:
        return out
    g = to_wgs84(parse_wkt(F.col(f"`{gcol}`")), src_epsg)
    return with_geom(out, g).drop(gcol)


def dpe_collectif(df: DataFrame, deps: Iterable[str] | None = None,
                  building_type: str = "immeuble") -> DataFrame:
    """Energy diagnostics of multi-dwelling buildings located by their
    ``"lat,lon"`` geopoint; records without a numeric geopoint are dropped.

    ``deps``/``building_type`` are the fielded filter the remote API applied.
    """
    rows = df.where(F.col("type_batiment") == building_type)
    if deps:
        rows = rows.where(F.col("code_departement_ban").isin(list(deps)))
    lat, lon = parse_geopoint(F.col("_geopoint"))
    rows = rows.where(F.col("_geopoint").isNotNull() & (F.col("_geopoint") != "")) \
        .select(*[c for c in DPE_FIELDS if c in df.columns],
                F.col("code_departement_ban").alias("departement"),
                lat.alias("_lat"), lon.alias("_lon"))
    return rows.where(F.col("_lat").isNotNull() & F.col("_lon").isNotNull()) \
        .withColumn("geom", point(F.col("_lon"), F.col("_lat"))).drop("_lat", "_lon")
