"""Input views derived from the given tables; one SQL text for Spark and for the check engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-28"
NOW = "2024-02-01 06:00:00"
HOME = "https://www.shop.cl/small/brand-1/"

FX_FACTS = """
SELECT date, query, page, clicks, impressions,
  CAST(FLOOR((CAST(clicks AS DOUBLE) * 2000000 + impressions) / (2 * impressions)) / 1000000 AS DECIMAL(12,6)) AS ctr,
  CAST(pos AS DECIMAL(8,2)) AS position
FROM (
  SELECT DATE '2024-01-01' + CAST(l_orderkey % 28 AS INT) AS date, p_name AS query,
    'https://www.shop.cl/' || lower(p_type) || '/' || CASE
      WHEN l_linenumber = 6 THEN '' WHEN l_linenumber = 7 THEN 'listas/x/'
      WHEN l_linenumber = 5 THEN 'search' WHEN l_linenumber = 4 THEN 'ficha.html'
      ELSE lower(replace(p_brand, '#', '-')) || '/' END AS page,
    CAST(FLOOR(CAST(SUM(CAST(l_quantity AS BIGINT) * CAST(ROUND(l_discount * 100) AS BIGINT)) AS DOUBLE) * 2 / 5) AS BIGINT) AS clicks,
    CAST(SUM(CAST(l_quantity AS BIGINT)) * 40 AS BIGINT) AS impressions,
    1 + CAST((MIN(l_orderkey) * 7 + MIN(l_partkey) * 13) % 2400 AS DOUBLE) / 100 AS pos
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
) r
"""

# The same facts with positions of four decimals, drawn close to 5, 10 and 20, and CTRs of nine.
FX_FINE = """
SELECT date, query, page, clicks, impressions,
  CAST(CAST(ctr AS DECIMAL(14,12)) + CAST(clicks % 7 AS DECIMAL(4,0)) * CAST(0.000000013 AS DECIMAL(10,9)) AS DECIMAL(14,12)) AS ctr,
  CAST(CASE WHEN position BETWEEN 4.5 AND 5.5 THEN 5 WHEN position BETWEEN 9.5 AND 10.5 THEN 10
      WHEN position BETWEEN 19.5 AND 20.5 THEN 20 ELSE position END
    + CAST((clicks % 9 - 4) * 11 AS DECIMAL(6,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(15,9)) AS position
FROM fx_facts
"""

FX_BI = """
SELECT lower(p_type) AS dept, lower(replace(p_brand, '#', '-')) AS sub,
  CAST(COUNT(*) AS DOUBLE) / 2000 AS tasa_conversion,
  CAST(SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS ticket_promedio, 0 AS ord
FROM part WHERE p_type <> 'PROMO' AND p_brand NOT LIKE '%5' GROUP BY 1, 2
UNION ALL
SELECT lower(p_type), 'brand-10', CAST(COUNT(*) AS DOUBLE) / 1000, 55555.5, 1
FROM part WHERE p_type <> 'PROMO' AND p_brand = 'Brand#10' GROUP BY 1
UNION ALL
SELECT * FROM (VALUES
  ('sin_path1', 'x', CAST(0.01 AS DOUBLE), CAST(1000 AS DOUBLE), 2), ('http://a', 'b', 0.01, 1000, 2),
  ('?q', 'b', 0.01, 1000, 2), ('', 'b', 0.01, 1000, 2), ('small', '', 0.01, 1000, 2), ('small', 'cero', 0, 1000, 2)) v(a, b, c, d, e)
"""

# The ids number the whole list in one window; a watch-list is short (here at most 64 queries x 156 pages,
# whatever the scale) because people keep it.
FX_WATCH = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY query, page_url) AS BIGINT) AS id, w.* FROM (
  SELECT query, page AS page_url, CAST(MAX(position) AS DECIMAL(6,2)) AS baseline_position, MIN(date) AS baseline_date,
    CAST(GREATEST(MAX(position) - 5.5, 3.0) AS DECIMAL(6,2)) AS target_position, 'LINK_BUILDING' AS agency_factor_aplicado,
    CAST(NULL AS VARCHAR(50)) AS notas, CAST(MIN(date) AS TIMESTAMP) AS created_at
  FROM fx_facts WHERE (LENGTH(query) + LENGTH(page)) % 5 = 0 AND page LIKE '%brand-%' GROUP BY 1, 2
  UNION ALL
  SELECT 'sin historia', 'https://www.shop.cl/none/', 9.50, DATE '2024-01-01', 4.00, 'LINK_BUILDING', 'nota', TIMESTAMP '2024-01-01 00:00:00'
) w
"""

_POSITIONS = ", ".join(f"({p})" for p in range(1, 21))

FX_CTR_CURVE = f"""
SELECT position, CAST(ctr_mid * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(12,6)) AS ctr_low, ctr_mid,
  CAST(ctr_mid * CAST(1.5 AS DECIMAL(2,1)) AS DECIMAL(12,6)) AS ctr_high,
  CASE WHEN position <= 5 THEN 'green' WHEN position <= 10 THEN 'amber' ELSE 'red' END AS color_zone
FROM (SELECT position, CAST(CAST(0.30 AS DOUBLE) / position AS DECIMAL(12,6)) AS ctr_mid
      FROM (VALUES {_POSITIONS}) p(position)) c
"""

# Boost, success probability, position change and weeks to effect per factor.
FX_PARAMS = """
SELECT factor_name, CAST(boost AS DECIMAL(6,3)) AS ctr_boost, CAST(prob AS DECIMAL(6,3)) AS success_prob,
  CAST(jump AS DECIMAL(6,2)) AS pos_delta, weeks_min AS impact_weeks_min, weeks_max AS impact_weeks_max
FROM (VALUES ('NONE', 1.00, 0.00, 0.0, 0, 0), ('CONTENT', 1.20, 0.65, 0.0, 2, 6),
  ('LINK_BUILDING', 1.00, 0.55, 5.5, 8, 16), ('BOTH', 1.00, 0.75, 7.5, 4, 12))
  f(factor_name, boost, prob, jump, weeks_min, weeks_max)
"""

FX_BRANDED = "SELECT term, note FROM (VALUES ('hot', 'test term')) b(term, note)"

# SQL text and the tables or views it reads.
VIEWS = {
    "fx_facts": (FX_FACTS, ("lineitem", "part")),
    "fx_fine": (FX_FINE, ("fx_facts",)),
    "fx_bi": (FX_BI, ("part",)),
    "fx_watch": (FX_WATCH, ("fx_facts",)),
    "fx_ctr_curve": (FX_CTR_CURVE, ()),
    "fx_params": (FX_PARAMS, ()),
    "fx_branded": (FX_BRANDED, ()),
}


class Inputs:
    """The given tables and the derived views of one data folder, each opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.frames: dict[str, DataFrame] = {}

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = build()
        return self.frames[name]

    def table(self, name: str) -> DataFrame:
        return self.keep(name, lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def view(self, name: str) -> DataFrame:
        """A derived view; its inputs are registered under the names its SQL uses."""
        return self.keep(name, lambda: self._view(name))

    def _view(self, name: str) -> DataFrame:
        sql, needs = VIEWS[name]
        for need in needs:
            frame = self.view(need) if need in VIEWS else self.table(need)
            frame.createOrReplaceTempView(need)
        return self.spark.sql(sql)
