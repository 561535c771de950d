"""Reference joins and lookups that consumers run over the loaded tables,
plus the small read queries of the diagnostics (filter / prefix / count /
limit)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import nonempty

# --- fixed values -----------------------------------------------------------
IMAGE_URL_PREFIX = "https://commons.wikimedia.org/wiki/Special:FilePath/"
IMAGE_URL_SUFFIX = "?width=400"
# --- end of fixed values ----------------------------------------------------


def of_department(features: DataFrame) -> DataFrame:
    """Feature rows with ``departement``: the department that their file was
    landed for; a property of that name only where the file names none."""
    own = [F.col("departement")] if "departement" in features.columns else []
    return features.withColumn("departement", F.coalesce(F.col("file_departement"), *own)).drop("file_departement")


def sections_table(features: DataFrame) -> DataFrame:
    """Cadastral sections from GeoJSON feature rows (properties + geom)."""
    return features.select(F.col("id").alias("section_id"), "commune", "prefixe", "code",
                           "departement", "geom")


def commune_geoms(features: DataFrame) -> DataFrame:
    """Commune geometries from GeoJSON feature rows."""
    return features.select(F.col("id").alias("code_commune"), F.col("nom").alias("nom_commune"), "departement", "geom")


def prices_with_geometry(prices: DataFrame, sections: DataFrame, how: str = "inner") -> DataFrame:
    """Section price statistics joined to section geometry on ``section_id``."""
    return prices.join(sections.drop("departement"), "section_id", how)


def attach_commune(df: DataFrame, communes: DataFrame, how: str = "inner") -> DataFrame:
    """Any commune-level table joined to commune names and geometries (columns
    that the table has itself are kept from it)."""
    extra = [c for c in communes.columns if c == "code_commune" or c not in df.columns]
    return df.join(communes.select(*extra), "code_commune", how)


def sections_of_commune(sections: DataFrame, code: str) -> DataFrame:
    """Sections of one commune, ordered by section id."""
    return sections.where(F.col("commune") == code).orderBy("section_id")


def rows_by_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """``col LIKE 'prefix%'`` (a literal prefix, no wildcards), ordered."""
    return df.where(F.col(col).startswith(prefix)).orderBy(col)


def row_count(df: DataFrame) -> DataFrame:
    """Global row count as a one-row DataFrame (partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def sample_rows(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order`` the choice is deterministic (top-n
    per task, then a final top-n: no full sort)."""
    return (df.orderBy(*order) if order else df).limit(n)


# ------------------------------------------------------------ wikidata
def wikidata_ids(pois: DataFrame) -> DataFrame:
    """The distinct QIDs to look up."""
    return pois.select("wikidata_id").where(F.col("wikidata_id").isNotNull()).distinct()


def entity_enrichment(entities: DataFrame) -> DataFrame:
    """QID -> description (fr if the key exists, even with a NULL value, else
    en) and image URL from the first P18 claim; entities flagged missing are
    dropped."""
    d = F.col("descriptions")
    desc = (F.when(F.map_contains_key(d, "fr"), d["fr"]["value"])
            .when(F.map_contains_key(d, "en"), d["en"]["value"]))
    img = nonempty(F.get(F.col("claims.P18"), 0)["mainsnak"]["datavalue"]["value"])
    url = F.when(img.isNotNull(), F.concat(F.lit(IMAGE_URL_PREFIX),
                                            F.replace(img, F.lit(" "), F.lit("_")),
                                            F.lit(IMAGE_URL_SUFFIX)))
    return (entities.where(~F.coalesce(F.col("missing"), F.lit(False)))
            .select("qid", desc.alias("description"), url.alias("image_url")))


# ----------------------------------------------------------- buildings
def building_profile(buildings: DataFrame, satellites: dict[str, DataFrame],
                     key: str = "batiment_groupe_id") -> DataFrame:
    """Buildings left-joined with each satellite table on the building id.

    The tables that the building job writes are bucketed alike on the id, so
    these joins run without a shuffle; over other tables AQE picks the strategy
    per join.
    """
    out = buildings
    for name, sat in satellites.items():
        cols = [c for c in sat.columns if c not in (key, "code_departement_insee")]
        out = out.join(sat.select(key, *[F.col(c).alias(f"{name}_{c}") for c in cols]), key, "left")
    return out
