"""The business refresh: file rows in, priced catalog out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from searchlift.operators.bi import cascade, clean_bi, reset_catalog
from searchlift.schemas import HOST_MARKER


def refresh_catalog(catalog: DataFrame, bi_rows: DataFrame, now=None, marker: str = HOST_MARKER) -> DataFrame:
    """The catalog with taxonomy and rates rebuilt; ``rate_source`` names the tier of each row."""
    priced = cascade(reset_catalog(catalog, marker), clean_bi(bi_rows))
    stamp = F.current_timestamp() if now is None else F.to_timestamp(F.lit(now))
    return priced.withColumn("updated_at", stamp).select(*catalog.columns, "rate_source")
