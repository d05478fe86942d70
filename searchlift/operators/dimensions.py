"""Lookups whose size is bounded by their key domain, so broadcasting them is safe at any data size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from searchlift.schemas import CTR, FACTORS, LAST_POSITION


def curve_lookup(curve: DataFrame, value: str = "ctr_mid") -> DataFrame:
    """At most 20 rows: one expected CTR per whole position."""
    in_domain = curve.where(F.col("position").between(1, LAST_POSITION))
    return in_domain.groupBy(F.col("position").cast("int").alias("slot")).agg(
        F.max(value).cast(CTR).alias("slot_ctr")
    )


def curve_slot(position: Column) -> Column:
    """Whole position clamped to the curve; null stays null."""
    whole = F.round(position, 0).cast("int")
    return F.when(position.isNotNull(), F.greatest(F.least(whole, F.lit(LAST_POSITION)), F.lit(1)))


def with_ctr(df: DataFrame, curve: DataFrame, position: str, out: str) -> DataFrame:
    """Adds the curve's CTR at a position; 0 where the position or the curve entry is missing."""
    lookup = F.broadcast(curve_lookup(curve))
    keyed = df.withColumn("slot", curve_slot(F.col(position)))
    joined = keyed.join(lookup, "slot", "left")
    return joined.withColumn(out, F.coalesce("slot_ctr", F.lit(0).cast(CTR))).drop("slot", "slot_ctr")


def params_lookup(params: DataFrame, factors: tuple[str, ...] = FACTORS) -> DataFrame:
    """Boost and success probability, at most one row for each of the factors asked for."""
    in_domain = params.where(F.col("factor_name").isin(*factors))
    return in_domain.groupBy(F.col("factor_name").alias("agency_factor")).agg(
        F.max("ctr_boost").alias("ctr_boost"), F.max("success_prob").alias("success_prob")
    )


def with_params(df: DataFrame, params: DataFrame, how: str = "left", factors: tuple[str, ...] = FACTORS) -> DataFrame:
    """Adds ``ctr_boost`` and ``success_prob`` by ``agency_factor``; null where the factor has no params.

    ``factors`` are the names that may stand in ``df``; a table with more names is cut to them before it is broadcast.
    """
    return df.join(F.broadcast(params_lookup(params, factors)), "agency_factor", how)


def set_boost(params: DataFrame, factors: list[str], value: float | str) -> DataFrame:
    """Replaces the boost of the listed factors."""
    changed = F.when(F.col("factor_name").isin(*factors), F.lit(value).cast(params.schema["ctr_boost"].dataType))
    return params.withColumn("ctr_boost", changed.otherwise(F.col("ctr_boost")))


def ordered_params(params: DataFrame) -> DataFrame:
    """Boost and success probability by factor name."""
    return params.select(
        "factor_name",
        F.col("ctr_boost").cast("double").alias("ctr_boost"),
        F.col("success_prob").cast("double").alias("success_prob"),
    ).orderBy("factor_name")


def ordered_curve(curve: DataFrame) -> DataFrame:
    """Expected CTR by position."""
    return curve.select("position", F.col("ctr_mid").cast("double").alias("ctr_mid")).orderBy("position")


def curve_map(curve: DataFrame) -> DataFrame:
    """The curve as one row holding a map from position to CTR."""
    entry = F.struct("slot", F.col("slot_ctr").cast("double"))
    entries = F.sort_array(F.collect_list(entry))
    return curve_lookup(curve).agg(F.map_from_entries(entries).alias("ctr_curve"))


def snapshot(df: DataFrame, date=None) -> DataFrame:
    """Rows of one date, the newest one by default; on a date-partitioned table it prunes to one folder.

    With the session's ``metadataOnly`` rule (see ``session.SETTINGS``) the newest date of such a table is read from its
    folders' names, and no file is opened for it.
    """
    wanted = df.select(F.max("date")).scalar() if date is None or date == "" else F.to_date(F.lit(date))
    return df.where(F.col("date") == wanted)
