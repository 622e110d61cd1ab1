"""Buildings by which extra rooms their units have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def building_profile(groups: DataFrame, units: DataFrame, accessories: DataFrame) -> DataFrame:
    """Per group with units: units, rows with storage, with parking and with either.

    Accessory rows are counted per unit and units per group before any name is attached.
    """
    flag = {
        "ufs_con_baulera": F.col("baulera"),
        "ufs_con_cochera": F.col("cochera"),
        "ufs_con_accesorios": F.coalesce("baulera", F.lit(False)) | F.coalesce("cochera", F.lit(False)),
    }
    per_unit = accessories.groupBy(F.col("idUnidadFuncional").alias("idUF")).agg(
        *[F.count_if(c).alias(name) for name, c in flag.items()]
    )
    per_group = (
        units.select("idUF", "idConsorcio")
        .join(per_unit, "idUF", "left")
        .groupBy(F.col("idConsorcio").alias("id"))
        .agg(
            # idUF is the unit table's key, so its rows are its distinct units.
            F.count("idUF").alias("cantUF"),
            *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in flag],
        )
    )
    return groups.select("id", "nombre").join(per_group, "id")


def with_both(profile: DataFrame) -> DataFrame:
    return _both_counts(profile.filter("ufs_con_baulera > 0 AND ufs_con_cochera > 0"))


def with_none(profile: DataFrame) -> DataFrame:
    return profile.filter("ufs_con_accesorios = 0").select("id", "nombre", "cantUF", "ufs_con_accesorios")


def storage_only(profile: DataFrame) -> DataFrame:
    return _both_counts(profile.filter("ufs_con_baulera > 0 AND ufs_con_cochera = 0"))


def parking_only(profile: DataFrame) -> DataFrame:
    return _both_counts(profile.filter("ufs_con_cochera > 0 AND ufs_con_baulera = 0"))


def _both_counts(profile: DataFrame) -> DataFrame:
    return profile.select("id", "nombre", "cantUF", "ufs_con_baulera", "ufs_con_cochera")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        for name, df in tables.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result
