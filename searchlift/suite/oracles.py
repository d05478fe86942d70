"""Check SQL, written apart from the Spark code; only the input views are shared.

It computes on whole numbers (CTR in 10^-9, positions in millionths, conversion in 10^-12) and divides
once at the end, so no result depends on how an engine rounds.
"""

from __future__ import annotations

import re

from searchlift.suite.fixtures import AS_OF, HOME, NOW, VIEWS

CTES: dict[str, str] = {name: sql for name, (sql, _) in VIEWS.items()}

# Fixed values, spelled here apart from the code under test.
_SOFT = "('mujer', 'hombre', 'ninos', 'zapatos', 'belleza', 'deportes', 'outlet', 'regalos')"
_SPELLINGS = "paris|pars|paeis|paaris|pariw|parus|parid|patis|paros|paria|parís|cenco|almacen|almacenes"


def _branded(text: str) -> str:
    return f"(regexp_matches({text}, '{_SPELLINGS}', 'i') OR regexp_matches({text}, '\\baris\\b', 'i'))"


CTES["kept"] = f"""
SELECT * FROM fx_fine
WHERE page NOT LIKE '%/listas/%' AND page NOT LIKE '%/search%' AND page NOT LIKE '%.html%'
  AND NOT COALESCE(position > 20, FALSE) AND NOT {_branded('query')}
"""

CTES["clean"] = """
SELECT dept, sub, CAST(CAST(CAST(tasa_conversion AS VARCHAR) AS DECIMAL(24,12)) * 1000000000000 AS HUGEINT) AS cr,
  CAST(CAST(CAST(ticket_promedio AS VARCHAR) AS DECIMAL(24,6)) * 1000000 AS HUGEINT) AS tk, ord
FROM (SELECT lower(trim(COALESCE(dept, ''))) AS dept, lower(trim(COALESCE(sub, ''))) AS sub,
        CAST(tasa_conversion AS DOUBLE) AS tasa_conversion, CAST(ticket_promedio AS DOUBLE) AS ticket_promedio, ord
      FROM fx_bi) b
WHERE dept <> '' AND sub <> '' AND tasa_conversion > 0 AND ticket_promedio > 0
  AND NOT (starts_with(dept, 'sin_path') OR starts_with(dept, 'http') OR starts_with(dept, '?'))
"""

CTES["large_bi"] = """
SELECT c.dept, c.sub, CAST(CAST(b.tasa_conversion * 1073741824 AS VARCHAR) AS DECIMAL(24,12)) AS rate,
  CAST(CAST(b.ticket_promedio * 1073741824 AS VARCHAR) AS DECIMAL(24,6)) AS ticket, c.ord
FROM (SELECT DISTINCT dept, sub, ord FROM clean) c
  JOIN fx_bi b ON lower(trim(b.dept)) = c.dept AND lower(trim(b.sub)) = c.sub AND b.ord = c.ord
"""

# The second word of every document, a list as long as the table.
CTES["brand_words"] = """
SELECT DISTINCT lower(split_part(text, ' ', 2)) AS term FROM documents WHERE length(split_part(text, ' ', 2)) >= 6
"""

# No term holds a space, so a text holds a term where one of its words does.
CTES["text_words"] = """
SELECT doc_id, unnest(list_distinct(string_split(lower(text), ' '))) AS word FROM documents
"""
CTES["branded_words"] = """
SELECT v.word FROM (SELECT DISTINCT word FROM text_words) v
WHERE EXISTS (SELECT 1 FROM brand_words w WHERE contains(v.word, w.term))
"""

# No term is part of another one, and each stands between blanks.
_SHARED = """
SELECT o_orderkey, CAST(lpad(CAST(o_custkey * 2 AS VARCHAR), 9, '0') IN (SELECT split_part(c_name, '#', 2) FROM customer)
  OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS VARCHAR) AS is_branded
FROM orders
"""

CTES["pairs"] = """
SELECT dept, sub, arg_max(cr, ord) AS cr, (2 * arg_max(tk, ord) + 1000000) // 2000000 AS tk
FROM clean GROUP BY dept, sub
"""

CTES["depts"] = """
SELECT dept, (2 * SUM(cr) + COUNT(*)) // (2 * COUNT(*)) AS cr,
  (2 * SUM(tk) + COUNT(*) * 1000000) // (COUNT(*) * 2000000) AS tk, COUNT(*) AS n
FROM clean GROUP BY dept
"""

CTES["site"] = """
SELECT COALESCE((2 * SUM(cr) + COUNT(*)) // (2 * NULLIF(COUNT(*), 0)), 2000000000) AS cr,
  COALESCE((2 * SUM(tk) + COUNT(*) * 1000000) // (NULLIF(COUNT(*), 0) * 2000000), 80000) AS tk
FROM clean
"""

CTES["pages_seen"] = """
SELECT page AS page_url, lower(split_part(split_part(page, '.cl/', 2), '/', 1)) AS department,
  lower(split_part(split_part(page, '.cl/', 2), '/', 2)) AS category_l1
FROM (SELECT DISTINCT page FROM fx_fine) d
"""

CTES["fx_catalog"] = f"""
SELECT c.*, COALESCE(p.cr, d.cr, s.cr) AS cr, COALESCE(p.tk, d.tk, s.tk) AS tk,
  CASE WHEN p.cr IS NOT NULL THEN 'exact' WHEN d.cr IS NOT NULL THEN 'department' ELSE 'site' END AS rate_source,
  CASE WHEN COALESCE(p.cr, d.cr) IS NOT NULL
    THEN department IN {_SOFT} END AS is_blando
FROM pages_seen c LEFT JOIN pairs p ON p.dept = c.department AND p.sub = c.category_l1
  LEFT JOIN depts d ON d.dept = c.department CROSS JOIN site s
"""

CTES["curve6"] = "SELECT position AS slot, CAST(ctr_mid * 1000000 AS BIGINT) AS mid6 FROM fx_ctr_curve"

CTES["params3"] = """
SELECT factor_name, CAST(ctr_boost * 1000 AS BIGINT) AS boost3, CAST(success_prob * 1000 AS BIGINT) AS prob3,
  CAST(pos_delta * 1000000 AS BIGINT) AS jump6 FROM fx_params
"""

# What to do in each band, by its test: a CTR below the expected one, or for deep positions enough demand.
CTES["rules"] = """
SELECT * FROM (VALUES ('top', TRUE, 'CONTENT'), ('top', FALSE, 'NONE'), ('mid', TRUE, 'BOTH'),
  ('mid', FALSE, 'LINK_BUILDING'), ('deep', TRUE, 'LINK_BUILDING'), ('deep', FALSE, 'NONE')) r(band, test, action)
"""

CTES["weights"] = "SELECT * FROM (VALUES ('top', 10), ('mid', 8), ('deep', 5)) w(band, tenths)"


def _band(pos6: str) -> str:
    return f"['top', 'mid', 'deep'][1 + CAST({pos6} > 5000000 AS INT) + CAST({pos6} > 10000000 AS INT)]"


def _target(pos6: str, jump6: str) -> str:
    return f"IF({jump6} > 0, GREATEST({pos6} - {jump6}, 3000000), {pos6})"


CTES["units"] = """
SELECT date, query, page, clicks, impressions, CAST(position * 1000000 AS BIGINT) AS pos6, CAST(CAST(ctr AS DECIMAL(30,12)) * 1000000000 AS BIGINT) AS ctr9
FROM fx_fine
"""

CTES["diag"] = """
SELECT k.date, k.query, k.page AS page_url, k.impressions, CAST(k.position * 1000000 AS BIGINT) AS pos6,
  CAST(CAST(k.ctr AS DECIMAL(30,12)) * 1000000000 AS BIGINT) AS ctr9,
  k.query IN (SELECT q.query FROM (SELECT DISTINCT query FROM kept) q
              JOIN fx_branded b ON contains(lower(q.query), lower(b.term))) AS branded,
  COALESCE(c.mid6, 0) AS exp6
FROM kept k LEFT JOIN curve6 c ON c.slot = LEAST(GREATEST((CAST(k.position * 1000000 AS BIGINT) + 500000) // 1000000, 1), 20)
"""

CTES["classed"] = f"""
SELECT d.* EXCLUDE (test), IF(branded OR impressions < 200, 'NONE', r.action) AS factor
FROM (SELECT *, IF(band = 'deep', impressions > 1000, ctr9 < exp6 * 1000) AS test
      FROM (SELECT *, {_band('pos6')} AS band FROM diag) b) d
  JOIN rules r ON r.band = d.band AND r.test = d.test
"""

CTES["proj"] = f"""
SELECT t.*, COALESCE(c.mid6, 0) AS tgt6, COALESCE(c.mid6, 0) * t.boost3 AS adj9,
  CAST(t.impressions AS HUGEINT) * (COALESCE(c.mid6, 0) * t.boost3 - t.ctr9) AS gain9
FROM (SELECT k.*, p.boost3, p.prob3, {_target('k.pos6', 'p.jump6')} AS tpos6
      FROM classed k LEFT JOIN params3 p ON p.factor_name = k.factor) t
  LEFT JOIN curve6 c ON c.slot = LEAST(GREATEST((t.tpos6 + 500000) // 1000000, 1), 20)
"""

CTES["priced"] = """
SELECT x.*, r.cr, r.tk,
  CASE WHEN branded THEN NULL ELSE (2 * CAST(delta AS HUGEINT) * r.tk * r.cr + 1000000000000) // 2000000000000 END AS revenue
FROM (SELECT *, CASE WHEN factor = 'NONE' OR gain9 <= 0 THEN 0
        ELSE CAST((2 * gain9 + 1000000000) // 2000000000 AS BIGINT) END AS delta FROM proj) x
  LEFT JOIN fx_catalog r ON r.page_url = x.page_url
"""

CTES["raw"] = "SELECT p.*, revenue * prob3 * w.tenths AS raw4 FROM priced p JOIN weights w ON w.band = p.band"

CTES["best"] = "SELECT date, MAX(raw4) FILTER (WHERE raw4 > 0) AS best4 FROM raw GROUP BY date"

CTES["gaps"] = """
SELECT r.*, CASE WHEN best4 IS NULL THEN raw4 ELSE (raw4 * 20000 + best4) // (2 * best4) END AS score2
FROM raw r LEFT JOIN best b ON b.date = r.date
"""

CTES["latest"] = "SELECT * FROM gaps WHERE date = (SELECT MAX(date) FROM gaps)"

_GAP_OUT = """
SELECT query, page_url, impressions, pos6 / 1000000.0::DOUBLE AS avg_position, ctr9 / 1000000000.0::DOUBLE AS ctr_actual,
  CAST(branded AS VARCHAR) AS is_branded, CASE WHEN NOT branded THEN exp6 / 1000000.0::DOUBLE END AS ctr_expected,
  CASE WHEN branded THEN 0 ELSE GREATEST(exp6 * 1000 - ctr9, 0) END / 1000000000.0::DOUBLE AS ctr_gap,
  factor AS agency_factor, CASE WHEN NOT branded THEN tpos6 / 1000000.0::DOUBLE END AS pos_target,
  CASE WHEN NOT branded THEN tgt6 / 1000000.0::DOUBLE END AS ctr_target,
  CASE WHEN NOT branded THEN adj9 / 1000000000.0::DOUBLE END AS ctr_target_adjusted,
  CAST(delta AS BIGINT) AS delta_clicks, CAST(cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(tk AS BIGINT) AS avg_ticket,
  CAST(revenue AS BIGINT) AS revenue_final, CAST(score2 AS DOUBLE) / 100 AS opportunity_score, date
FROM gaps
"""

# The list in display form, CTRs in hundredths of a percent and scores in tenths for exact ordering.
CTES["shown"] = """
SELECT date, query, page_url, pos6, (pos6 + 5000) // 10000 AS pos2, impressions, CAST(delta AS BIGINT) AS delta, (ctr9 + 50000) // 100000 AS ctr4,
  CASE WHEN NOT branded THEN (exp6 + 50) // 100 END AS exp4, CAST(revenue AS BIGINT) AS revenue, factor,
  CAST((score2 + 5) // 10 AS BIGINT) AS score1, cr, tk
FROM gaps
"""

CTES["listed"] = "SELECT * FROM shown WHERE date = (SELECT MAX(date) FROM shown) AND delta > 0"

_SHOWN = """query, page_url, pos2 / 100.0::DOUBLE AS avg_position, impressions, delta AS delta_clicks,
  ctr4 / 100.0::DOUBLE AS ctr_actual, exp4 / 100.0::DOUBLE AS ctr_expected, revenue AS revenue_final, factor AS agency_factor,
  score1 / 10.0::DOUBLE AS opportunity_score, CAST(cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(tk AS BIGINT) AS avg_ticket"""

_BY_SCORE = "ORDER BY score1 DESC NULLS FIRST, query, page_url"

CTES["first_page"] = f"SELECT * FROM listed {_BY_SCORE} LIMIT 10"

CTES["best_now"] = """
SELECT MAX(raw4) AS best4 FROM raw
WHERE date = (SELECT MAX(date) FROM raw) AND revenue > 0
"""


def _whatif(source: str, ctr9: str, best: str = "CROSS JOIN best_now", params: str = "params3") -> str:
    """Every row of a frame under every factor; ctr9 is the starting CTR in 10^-9."""
    return f"""
SELECT z.date, query, page_url, factor, pos6, tpos6, delta, CAST(revenue AS BIGINT) AS revenue,
  IF(factor = 'NONE' OR best4 IS NULL, 0.0,
    LEAST((CAST(raw4 AS DOUBLE) / 10000) / (CAST(best4 AS DOUBLE) / 10000) * 100, 100.0)) AS score
FROM (
  SELECT v.*, revenue * prob3 * w.tenths AS raw4
  FROM (
    SELECT *, (2 * CAST(delta AS HUGEINT) * tk * cr + 1000000000000) // 2000000000000 AS revenue
    FROM (
      SELECT *, IF(factor = 'NONE' OR gain9 <= 0, 0, CAST((2 * gain9 + 1000000000) // 2000000000 AS BIGINT)) AS delta
      FROM (
        SELECT u.*, CAST(u.impressions AS HUGEINT) * (COALESCE(c.mid6, 0) * u.boost3 - u.ctr9) AS gain9
        FROM (
          SELECT g.date, g.query, g.page_url, g.impressions, g.pos6, g.band, g.cr, g.tk, {ctr9} AS ctr9,
            p.factor_name AS factor, p.boost3, p.prob3, {_target('g.pos6', 'p.jump6')} AS tpos6
          FROM {source} g CROSS JOIN {params} p) u
        LEFT JOIN curve6 c ON c.slot = LEAST(GREATEST((u.tpos6 + 500000) // 1000000, 1), 20)) t) d) v
  JOIN weights w ON w.band = v.band) z {best}
"""


CTES["best_by_date"] = "SELECT date, MAX(raw4) AS best4 FROM raw WHERE revenue > 0 GROUP BY date"

_SHOWN_CTR = "((g.ctr9 + 50000) // 100000) * 100000"

CTES["active_now"] = "SELECT * FROM latest WHERE delta > 0"
_DAILY = "LEFT JOIN best_by_date b ON b.date = z.date"
CTES["params5"] = "SELECT * FROM params3 UNION ALL SELECT 'AUDIT', 1100, 750, 0"
CTES["whatif_now"] = _whatif("latest", _SHOWN_CTR)
CTES["whatif_all"] = _whatif("gaps", _SHOWN_CTR, _DAILY)
CTES["whatif_fifth"] = _whatif("latest", _SHOWN_CTR, params="params5")
CTES["whatif_active"] = _whatif("active_now", _SHOWN_CTR)
CTES["whatif_exact"] = _whatif("active_now", "g.ctr9")

CTES["weekly"] = """
SELECT query, page, CAST(date_trunc('week', date) AS DATE) AS week_start,
  (2 * SUM(pos6) + COUNT(*) * 10000) // (2 * COUNT(*) * 10000) AS avg2
FROM units GROUP BY 1, 2, 3
"""

CTES["recent"] = f"""
SELECT query, page, (2 * SUM(pos6) + COUNT(*) * 10000) // (2 * COUNT(*) * 10000) AS cur2
FROM units WHERE date >= DATE '{AS_OF}' - 7 GROUP BY 1, 2
"""

CTES["series"] = """
SELECT query, page, string_agg(strftime(week_start, '%G-W%V') || '=' || CAST(CAST(avg2 AS BIGINT) AS VARCHAR), ',' ORDER BY week_start) AS txt,
  COUNT(*) AS points, MIN(avg2) AS lo2, MAX(avg2) AS hi2,
  arg_min(avg2, week_start) AS first2, arg_max(avg2, week_start) AS last2
FROM weekly GROUP BY 1, 2
"""

_TREND = """CASE WHEN points >= 2 THEN CASE WHEN last2 < first2 - 10 THEN 'up'
  WHEN last2 > first2 + 10 THEN 'down' ELSE 'flat' END END"""

CTES["watched"] = """
SELECT w.*, CAST(r.cur2 AS BIGINT) AS cur2, CAST(r.cur2 - CAST(w.baseline_position * 100 AS BIGINT) AS BIGINT) AS delta2
FROM fx_watch w LEFT JOIN recent r ON r.query = w.query AND r.page = w.page_url
"""

# The same over the landed facts alone.
CTES["kept_units"] = CTES["units"].replace("FROM fx_fine", "FROM kept")
for _name, _from in (("weekly", "units"), ("recent", "units"), ("series", "weekly"), ("watched", "recent")):
    CTES[f"kept_{_name}"] = re.sub(rf"(FROM|JOIN) {_from}\b", rf"\1 kept_{_from}", CTES[_name])

_STATUS = """CASE WHEN delta2 IS NULL THEN 'nodata' WHEN delta2 < -50 THEN 'improved'
  WHEN delta2 > 50 THEN 'worsened' ELSE 'stable' END"""

CTES["urls"] = "SELECT DISTINCT url FROM (SELECT page AS url FROM fx_fine UNION ALL SELECT url FROM pages) u"

CTES["watch_updates"] = f"""
SELECT query, page_url, 'CONTENT' AS factor, (pos6 + 5000) // 10000 AS base2, (tpos6 + 5000) // 10000 AS aim2, DATE '{AS_OF}' AS base_date
FROM whatif_active WHERE factor = 'CONTENT'
"""

CTES["updates"] = """
SELECT date, query, page, clicks + 2 AS clicks, impressions, ctr, position FROM kept WHERE date >= DATE '2024-01-15'
UNION ALL
SELECT date + 28, query, page, clicks, impressions, ctr, position FROM kept WHERE date >= DATE '2024-01-15'
"""

CTES["quart"] = """
SELECT slot, [(CAST(x * 4 AS HUGEINT) + 2000000) // 4000000 FOR x IN q] AS q, n
FROM (SELECT slot, quantile_cont(CAST(ctr12 AS DOUBLE), [0.25, 0.5, 0.75]) AS q, COUNT(*) AS n
  FROM (SELECT LEAST(GREATEST((CAST(position * 1000000 AS BIGINT) + 500000) // 1000000, 1), 20) AS slot,
      CAST(CAST(ctr AS DECIMAL(30,12)) * 1000000000000 AS BIGINT) AS ctr12 FROM fx_fine) u GROUP BY slot) f
"""

_FACT_KEYS = "date, query, page"
_GAP_KEYS = "date, query, page_url"
_CATALOG_OUT = "page_url, department, category_l1, CAST(cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(tk AS BIGINT) AS avg_ticket"
_FACTS_OUT = "clicks, impressions, CAST(ctr AS DOUBLE) AS ctr, CAST(position AS DOUBLE) AS position"

def _tier(join: str, soft: bool, source: str) -> str:
    old = "contains(c.page_url, 'brand-2')"
    blando = f"CASE WHEN l.cr IS NOT NULL THEN c.department IN {_SOFT} ELSE {old} END" if soft else old
    return f"""
SELECT c.page_url, c.department, c.category_l1, CAST(l.cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(l.tk AS BIGINT) AS avg_ticket,
  CAST({blando} AS VARCHAR) AS is_blando, CASE WHEN l.cr IS NOT NULL THEN '{source}' END AS rate_source
FROM pages_seen c {join}
"""


CTES["units_exp"] = """
SELECT u.*, COALESCE(c.mid6, 0) AS exp6 FROM units u
LEFT JOIN curve6 c ON c.slot = LEAST(GREATEST((u.pos6 + 500000) // 1000000, 1), 20)
"""

def _number(text: str) -> str:
    """The longest start of a text that the engine's own cast accepts, tried length by length; these texts hold no blanks inside."""
    starts = f"list_transform(range(1, length(trim({text})) + 1), lambda n: trim({text})[1:n])"
    plain = f"list_filter({starts}, lambda s: right(s, 1) <> ' ' AND lower(right(s, 1)) NOT BETWEEN 'a' AND 'z' AND TRY_CAST(s AS DOUBLE) IS NOT NULL)"
    return f"COALESCE(CAST(list_last({plain}) AS DOUBLE), 0.0)"


_UPSERTED = f"""
SELECT {_FACT_KEYS}, {_FACTS_OUT} FROM updates
UNION ALL
SELECT {_FACT_KEYS}, {_FACTS_OUT} FROM kept k
WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.date = k.date AND u.query = k.query AND u.page = k.page)"""

_SUMMARY = """
SELECT date, COUNT(*) FILTER (WHERE branded) AS branded, COUNT(*) FILTER (WHERE NOT branded) AS diagnosed,
  COUNT(*) FILTER (WHERE NOT branded) AS classified, COUNT(*) FILTER (WHERE NOT branded) AS projected,
  COUNT(raw4) AS scored, CASE WHEN MAX(raw4) > 0 THEN COUNT(raw4) ELSE 0 END AS normalised
FROM gaps GROUP BY date"""


def _report(watched: str, series: str) -> str:
    return f"""
SELECT w.id, w.query, w.page_url, CAST(w.baseline_position AS DOUBLE) AS baseline_position, w.baseline_date,
  CAST(w.target_position AS DOUBLE) AS target_position, w.agency_factor_aplicado, w.notas,
  strftime(w.created_at, '%Y-%m-%d %H:%M:%S') AS created_at, cur2 / 100.0::DOUBLE AS current_position, delta2 / 100.0::DOUBLE AS delta,
  {_STATUS} AS status, COALESCE(s.txt, '') AS weekly_series, {_TREND} AS trend
FROM {watched} w LEFT JOIN {series} s ON s.query = w.query AND s.page = w.page_url"""


BODIES: dict[str, str] = {
    "scan_search_facts": f"SELECT {_FACT_KEYS}, {_FACTS_OUT} FROM fx_fine",
    "scan_section": f"SELECT {_FACT_KEYS}, {_FACTS_OUT} FROM fx_fine WHERE contains(page, '.cl/small/')",
    "scan_bi_csv": "SELECT dept, sub, CAST(tasa_conversion AS DOUBLE) AS tasa_conversion, CAST(ticket_promedio AS DOUBLE) AS ticket_promedio FROM fx_bi",
    "upsert_facts": _UPSERTED,
    "upsert_facts_bucketed": _UPSERTED,
    "insert_if_absent": """
SELECT date, query, page AS page_url, impressions, CAST(position AS DOUBLE) AS avg_position, CAST(ctr AS DOUBLE) AS ctr_actual,
  CASE WHEN impressions >= 1000 THEN 'BOTH' ELSE 'NONE' END AS agency_factor FROM kept""",
    "upsert_watchlist": f"""
SELECT COALESCE(w.id, (SELECT MAX(id) FROM fx_watch) + ROW_NUMBER() OVER (PARTITION BY w.id IS NULL ORDER BY u.query, u.page_url)) AS id, COALESCE(w.query, u.query) AS query, COALESCE(w.page_url, u.page_url) AS page_url,
  COALESCE(u.base2 / 100.0::DOUBLE, CAST(w.baseline_position AS DOUBLE)) AS baseline_position,
  COALESCE(u.base_date, w.baseline_date) AS baseline_date,
  COALESCE(u.aim2 / 100.0::DOUBLE, CAST(w.target_position AS DOUBLE)) AS target_position,
  COALESCE(u.factor, w.agency_factor_aplicado) AS agency_factor_aplicado, w.notas,
  CASE WHEN u.query IS NOT NULL THEN '{NOW}' ELSE strftime(w.created_at, '%Y-%m-%d %H:%M:%S') END AS created_at
FROM fx_watch w FULL OUTER JOIN watch_updates u ON u.query = w.query AND u.page_url = w.page_url""",
    "delete_by_id": "SELECT id, CASE WHEN target_position <= 3 THEN 'deleted' ELSE 'kept' END AS outcome FROM fx_watch",
    "update_params": """
SELECT factor AS agency_factor, COUNT(*) AS n,
  CASE factor WHEN 'CONTENT' THEN 1.2 WHEN 'BOTH' THEN 1.35 WHEN 'LINK_BUILDING' THEN 1.1 ELSE 1.0 END::DOUBLE AS old_boost,
  CASE factor WHEN 'CONTENT' THEN 1.2 ELSE 1.0 END::DOUBLE AS new_boost,
  MAX(CASE factor WHEN 'CONTENT' THEN 0.65 WHEN 'BOTH' THEN 0.75 WHEN 'LINK_BUILDING' THEN 0.55 ELSE 0.0 END)::DOUBLE AS success_prob
FROM classed GROUP BY factor""",
    "reset_rates": """
SELECT page_url, department, category_l1, CAST(NULL AS DOUBLE) AS conversion_rate, CAST(NULL AS BIGINT) AS avg_ticket FROM pages_seen
UNION ALL
SELECT DISTINCT url, CASE WHEN url LIKE '%.cl/%' THEN lower(split_part(split_part(url, '.cl/', 2), '/', 1)) ELSE 'old' END,
  CASE WHEN url LIKE '%.cl/%' THEN lower(split_part(split_part(url, '.cl/', 2), '/', 2)) ELSE 'old' END,
  CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT) FROM pages""",
    "backfill_dates": """
SELECT CAST(d.day AS DATE) AS date, COUNT(k.query) AS landed_rows
FROM (SELECT unnest(generate_series(DATE '2024-03-10' - 60, DATE '2024-03-10' - 4, INTERVAL 1 DAY)) AS day) d
LEFT JOIN kept k ON k.date = CAST(d.day AS DATE) GROUP BY 1""",
    "consolidated_date": "SELECT CAST(o_orderdate AS DATE) AS today, COUNT(*) AS n, CAST(o_orderdate AS DATE) - 3 AS consolidated FROM orders GROUP BY 1, 3",
    "export_opportunities": f"""
SELECT ROW_NUMBER() OVER ({_BY_SCORE}) AS row_index, query AS keyword, page_url AS url, CAST(CAST(pos2 AS DECIMAL(10,0)) / 100 AS DECIMAL(8,2))::VARCHAR AS posicion,
  delta::VARCHAR AS delta_clics, CAST(ctr4 / 100.0::DOUBLE AS DECIMAL(12,2))::VARCHAR || '%' AS ctr_real,
  CAST(exp4 / 100.0::DOUBLE AS DECIMAL(12,2))::VARCHAR || '%' AS ctr_esperado, revenue::VARCHAR AS revenue_clp,
  factor AS agency_factor, CAST(score1 / 10.0::DOUBLE AS DECIMAL(6,1))::VARCHAR AS score FROM listed""",
    "ingest_accounting": f"""
SELECT date, CASE WHEN query IS NULL OR page IS NULL THEN 'malformed'
    WHEN page LIKE '%/listas/%' OR page LIKE '%/search%' OR page LIKE '%.html%' THEN 'page'
    WHEN position > 20 THEN 'position' WHEN {_branded("query")} THEN 'branded' ELSE 'kept' END AS reason, COUNT(*) AS n
FROM (SELECT date, position, CASE WHEN clicks % 11 <> 0 THEN query END AS query, CASE WHEN clicks % 13 <> 0 THEN page END AS page FROM fx_fine) f
GROUP BY 1, 2""",
    "ingest_balance": """
SELECT date, COUNT(*) AS landed, COUNT(*) AS accounted FROM fx_fine GROUP BY 1""",
    "exclude_pages": f"SELECT {_FACT_KEYS}, {_FACTS_OUT} FROM fx_fine WHERE NOT (contains(page, '/listas/') OR contains(page, '/search') OR contains(page, '.html'))",
    "max_rank": f"SELECT {_FACT_KEYS}, {_FACTS_OUT} FROM fx_fine WHERE position IS NULL OR position <= 20",
    "brand_regex": f"SELECT doc_id, CAST({_branded('text')} AS VARCHAR) AS is_branded FROM documents",
    "brand_table": "SELECT query, CAST(contains(lower(query), 'hot') AS VARCHAR) AS is_branded, COUNT(*) AS n FROM fx_fine GROUP BY 1, 2",
    "brand_table_join": """
SELECT f.query, CAST(EXISTS (SELECT 1 FROM (SELECT term FROM fx_branded UNION ALL SELECT n_name FROM nation) t
    WHERE contains(lower(f.query), lower(t.term))) AS VARCHAR) AS is_branded, f.n
FROM (SELECT query, COUNT(*) AS n FROM fx_fine GROUP BY 1) f""",
    "filter_factor": f"SELECT {_GAP_KEYS}, factor AS agency_factor FROM gaps WHERE factor = 'BOTH'",
    "filter_max_pos": f"SELECT {_GAP_KEYS}, pos6 / 1000000.0::DOUBLE AS avg_position FROM gaps WHERE pos6 <= 9500000",
    "filter_min_revenue": f"SELECT {_GAP_KEYS}, CAST(revenue AS BIGINT) AS revenue_final FROM gaps WHERE revenue >= 1000",
    "filter_subcategory": f"SELECT {_GAP_KEYS} FROM gaps WHERE COALESCE(NULLIF(split_part(split_part(page_url, '.cl/', 2), '/', 2), ''), '(sin subcategoría)') = 'brand-10'",
    "active_only": f"SELECT {_GAP_KEYS}, delta AS delta_clicks FROM gaps WHERE delta > 0",
    "latest_snapshot": f"SELECT {_FACT_KEYS}, impressions FROM kept WHERE date = (SELECT MAX(date) FROM kept)",
    "trailing_7d": f"SELECT {_FACT_KEYS}, CAST(position AS DOUBLE) AS position FROM kept WHERE date >= DATE '{AS_OF}' - 7",
    "bi_junk_filter": "SELECT dept, sub, CAST(cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(tk AS DOUBLE) / 1e6 AS ticket, CAST(ord AS BIGINT) AS ord FROM clean",
    "site_urls_only": "SELECT url, COUNT(*) AS n FROM (SELECT page AS url FROM fx_fine UNION ALL SELECT url FROM pages) u WHERE url LIKE '%.cl/%' GROUP BY url",
    "revenue_guard": "SELECT date, COUNT(revenue) AS with_revenue, NULLIF(COUNT(*) FILTER (WHERE revenue > 0), 0) AS with_positive FROM gaps GROUP BY date",
    "watchlist_validation": f"""
SELECT {_GAP_KEYS}, CASE WHEN factor = 'NONE' THEN 'OTHER' ELSE factor END AS agency_factor_aplicado,
  CASE WHEN branded THEN 'missing_field' WHEN factor = 'NONE' THEN 'unknown_factor' END AS rejected_reason FROM gaps""",
    "join_ctr_curve": f"SELECT {_FACT_KEYS}, pos6 / 1000000.0::DOUBLE AS position, exp6 / 1000000.0::DOUBLE AS ctr_expected FROM units_exp",
    "join_factor_params": f"""
SELECT {_GAP_KEYS}, factor AS agency_factor, CASE WHEN known THEN tpos6 / 1000000.0::DOUBLE END AS pos_target,
  CASE WHEN known THEN tgt6 / 1000000.0::DOUBLE END AS ctr_target, CASE WHEN known THEN adj9 / 1000000000.0::DOUBLE END AS ctr_target_adjusted,
  CASE WHEN known OR factor = 'NONE' THEN delta END AS delta_clicks
FROM (SELECT *, NOT branded AND factor <> 'LINK_BUILDING' AS known FROM gaps) g""",
    "bi_exact": _tier("LEFT JOIN pairs l ON l.dept = c.department AND l.sub = c.category_l1", True, "exact"),
    "bi_dept_fallback": _tier("LEFT JOIN depts l ON l.dept = c.department", True, "department"),
    "bi_site_fallback": _tier("CROSS JOIN site l", False, "site"),
    "join_catalog": "SELECT k.date, k.query, k.page AS page_url, CAST(c.cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(c.tk AS BIGINT) AS avg_ticket FROM kept k LEFT JOIN fx_catalog c ON c.page_url = k.page",
    "watch_history": "SELECT f.date, f.query, f.page, CAST(f.position AS DOUBLE) AS position FROM fx_fine f WHERE EXISTS (SELECT 1 FROM fx_watch w WHERE w.query = f.query AND w.page_url = f.page)",
    "watch_report_join": "SELECT w.id, w.query, w.page_url, COALESCE(s.points, 0) AS weeks, w.cur2 / 100.0::DOUBLE AS current_position FROM watched w LEFT JOIN series s ON s.query = w.query AND s.page = w.page_url",
    "max_score_join": "SELECT CAST(best4 AS DOUBLE) / 10000 AS max_raw_score FROM best_now",
    "factor_cross": "SELECT g.date, g.query, g.page_url, f.factor_name AS agency_factor FROM kept k JOIN gaps g ON g.date = k.date AND g.query = k.query AND g.page_url = k.page CROSS JOIN fx_params f",
    "kpis": """
SELECT date, CAST(SUM(n) AS BIGINT) AS total_keywords, CAST(SUM(n) - COALESCE(MAX(IF(factor = 'NONE', n, NULL)), 0) AS BIGINT) AS with_opportunity,
  COALESCE(MAX(IF(factor = 'BOTH', n, NULL)), 0) AS factor_both, COALESCE(MAX(IF(factor = 'CONTENT', n, NULL)), 0) AS factor_content,
  COALESCE(MAX(IF(factor = 'LINK_BUILDING', n, NULL)), 0) AS factor_lb, COALESCE(MAX(IF(factor = 'NONE', n, NULL)), 0) AS factor_none,
  CAST(COALESCE(SUM(earned), 0) AS BIGINT) AS total_revenue, CAST(COALESCE(SUM(IF(factor = 'NONE', 0, earned)), 0) AS BIGINT) AS active_revenue
FROM (SELECT date, factor, COUNT(*) AS n, SUM(revenue) AS earned FROM gaps GROUP BY 1, 2) f GROUP BY date""",
    "kpis_newest": """
SELECT date, CAST(SUM(n) AS BIGINT) AS total_keywords, CAST(SUM(n) - COALESCE(MAX(IF(factor = 'NONE', n, NULL)), 0) AS BIGINT) AS with_opportunity,
  COALESCE(MAX(IF(factor = 'BOTH', n, NULL)), 0) AS factor_both, COALESCE(MAX(IF(factor = 'CONTENT', n, NULL)), 0) AS factor_content,
  COALESCE(MAX(IF(factor = 'LINK_BUILDING', n, NULL)), 0) AS factor_lb, COALESCE(MAX(IF(factor = 'NONE', n, NULL)), 0) AS factor_none,
  CAST(COALESCE(SUM(earned), 0) AS BIGINT) AS total_revenue, CAST(COALESCE(SUM(IF(factor = 'NONE', 0, earned)), 0) AS BIGINT) AS active_revenue
FROM (SELECT date, factor, COUNT(*) AS n, SUM(revenue) AS earned FROM gaps GROUP BY 1, 2) f WHERE date = (SELECT MAX(date) FROM gaps) GROUP BY date""",
    "factor_distribution": "SELECT date, factor AS agency_factor, COUNT(*) AS n FROM classed GROUP BY 1, 2",
    "actionable_share": "SELECT date, SUM(CASE WHEN factor <> 'NONE' THEN 1 ELSE 0 END)::BIGINT AS active, COUNT(*) AS total FROM classed GROUP BY date",
    "bi_dept_means": "SELECT dept, CAST(cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(tk AS BIGINT) AS avg_ticket, n FROM depts",
    "bi_site_means": "SELECT CAST(cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(tk AS BIGINT) AS avg_ticket FROM site",
    "bi_last_wins": "SELECT dept, sub, CAST(cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(tk AS BIGINT) AS avg_ticket FROM pairs",
    "weekly_avg_position": "SELECT query, page, week_start, CAST(avg2 AS DOUBLE) / 100 AS avg_position FROM weekly",
    "current_position": "SELECT query, page, CAST(cur2 AS DOUBLE) / 100 AS current_position FROM recent",
    "weekly_series": "SELECT query, page, txt AS weekly_series FROM series",
    "daily_max_score": "SELECT date, CAST(best4 AS DOUBLE) / 10000 AS max_raw_score FROM best",
    "count_matching": "SELECT COUNT(*) AS total FROM listed WHERE factor = 'BOTH' AND pos6 <= 9500000",
    "bi_check": """
SELECT category_l1, COUNT(*) AS urls, CAST((2 * SUM(cr) + COUNT(*) * 10000000) // (COUNT(*) * 20000000) AS DOUBLE) / 1000 AS conv_pct,
  CAST((2 * SUM(tk) + COUNT(*)) // (2 * COUNT(*)) AS BIGINT) AS ticket
FROM fx_catalog WHERE department = 'small' AND cr > 0 GROUP BY category_l1 ORDER BY urls DESC, category_l1 LIMIT 25""",
    "bi_coverage": "SELECT rate_source, COUNT(*) AS n FROM fx_catalog GROUP BY rate_source",
    "calibrate_ctr_curve": "SELECT CAST(slot AS BIGINT) AS position, CAST(q[1] AS DOUBLE) / 1000000 AS ctr_low, CAST(q[2] AS DOUBLE) / 1000000 AS ctr_mid, CAST(q[3] AS DOUBLE) / 1000000 AS ctr_high, n FROM quart",
    "distinct_subcategories": "SELECT DISTINCT COALESCE(NULLIF(split_part(split_part(page_url, '.cl/', 2), '/', 2), ''), '(sin subcategoría)') AS subcategory FROM listed",
    "score_summary": _SUMMARY,
    "normalise_score": f"SELECT {_GAP_KEYS}, CAST(score2 AS DOUBLE) / 100 AS opportunity_score FROM gaps",
    "row_index": f"""
SELECT rn AS row_index, query, page_url, score1 / 10.0::DOUBLE AS opportunity_score
FROM (SELECT *, ROW_NUMBER() OVER ({_BY_SCORE}) AS rn FROM listed) l WHERE rn BETWEEN 26 AND 50""",
    "share_of_max": """
SELECT ROW_NUMBER() OVER (ORDER BY revenue DESC, query, page_url) AS row_index, query, page_url, revenue AS revenue_final,
  CAST((200 * revenue + best) // (2 * best) AS BIGINT) AS share_pct
FROM (SELECT *, COALESCE(NULLIF(MAX(revenue) OVER (), 0), 1) AS best FROM first_page) p
ORDER BY revenue DESC, query, page_url LIMIT 5""",
    "series_trend": f"""
SELECT query, page, CAST(first2 AS DOUBLE) / 100 AS first_position, CAST(last2 AS DOUBLE) / 100 AS last_position,
  CAST(lo2 AS DOUBLE) / 100 AS min_position, CAST(hi2 AS DOUBLE) / 100 AS max_position, points, {_TREND} AS trend FROM series""",
    "sort_opportunities": f"SELECT {_SHOWN} FROM listed ORDER BY exp4 ASC NULLS LAST, query, page_url",
    "page_opportunities": f"""
SELECT {_SHOWN}, rn AS row_index, CAST(21 AS BIGINT) AS start_row, LEAST(30, total) AS end_row, total, (total + 9) // 10 AS total_pages
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY revenue DESC NULLS FIRST, query, page_url) AS rn, COUNT(*) OVER () AS total FROM listed) l
WHERE rn BETWEEN 21 AND 30""",
    "page_last_history": f"""
SELECT date, {_SHOWN} FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY revenue DESC NULLS FIRST, query, page_url, date) AS rn, COUNT(*) OVER () AS total
  FROM shown WHERE delta > 0) h WHERE rn > ((total - 1) // 10) * 10""",
    "page_middle_history": f"""
SELECT date, {_SHOWN} FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY factor, query, page_url, date) AS rn FROM shown WHERE delta > 0) h WHERE rn BETWEEN 134 AND 140""",
    "join_catalog_skewed": f"""
SELECT k.date, k.query, k.page_url, CAST(c.cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(c.tk AS BIGINT) AS avg_ticket
FROM (SELECT date, query, CASE WHEN clicks % 2 = 0 THEN '{HOME}' ELSE page END AS page_url FROM kept) k LEFT JOIN fx_catalog c ON c.page_url = k.page_url""",
    "top_opportunity": """
SELECT date, query, page_url, CAST(revenue AS BIGINT) AS revenue_final, CAST(score2 AS DOUBLE) / 100 AS opportunity_score,
  factor AS agency_factor, pos6 / 1000000.0::DOUBLE AS avg_position
FROM latest WHERE revenue IS NOT NULL ORDER BY revenue DESC, query, page_url LIMIT 1""",
    "top5_revenue": "SELECT ROW_NUMBER() OVER (ORDER BY revenue DESC, query, page_url) AS row_index, query, page_url, revenue AS revenue_final FROM first_page ORDER BY row_index LIMIT 5",
    "top5_revenue_all": "SELECT ROW_NUMBER() OVER (ORDER BY revenue DESC, query, page_url) AS row_index, query, page_url, revenue AS revenue_final FROM listed ORDER BY row_index LIMIT 5",
    "top10_revenue": "SELECT ROW_NUMBER() OVER (ORDER BY revenue DESC, query, page_url) AS row_index, query, page_url, revenue AS revenue_final, (2 * revenue + 1000) // 2000 AS revenue_k FROM first_page ORDER BY row_index LIMIT 10",
    "ordered_params": """
SELECT p.factor_name AS name, CAST(p.ctr_boost AS DOUBLE) AS ctr_boost, CAST(p.success_prob AS DOUBLE) AS success_prob, CAST(NULL AS DOUBLE) AS ctr_mid
FROM fx_params p WHERE p.factor_name IN (SELECT factor FROM classed)
UNION ALL
SELECT CAST(slot AS VARCHAR), NULL, NULL, CAST(q[2] AS DOUBLE) / 1000000 FROM quart""",
    "ctr_gap": f"SELECT {_FACT_KEYS}, GREATEST(exp6 * 1000 - ctr9, 0) / 1000000000.0::DOUBLE AS ctr_gap FROM units_exp",
    "classify_factor": f"""
SELECT {_FACT_KEYS}, IF(impressions < 200, 'NONE', r.action) AS agency_factor
FROM (SELECT *, IF(band = 'deep', impressions > 1000, ctr9 < exp6 * 1000) AS test
      FROM (SELECT *, {_band('pos6')} AS band FROM units_exp) b) u
  JOIN rules r ON r.band = u.band AND r.test = u.test""",
    "target_position": f"SELECT {_FACT_KEYS}, p.factor_name AS agency_factor, {_target('pos6', 'p.jump6')} / 1000000.0::DOUBLE AS pos_target FROM units CROSS JOIN params3 p",
    "ctr_target": f"SELECT {_GAP_KEYS}, CASE WHEN NOT branded THEN tgt6 / 1000000.0::DOUBLE END AS ctr_target, CASE WHEN NOT branded THEN adj9 / 1000000000.0::DOUBLE END AS ctr_target_adjusted FROM proj",
    "delta_clicks": f"SELECT {_GAP_KEYS}, factor AS agency_factor, delta AS delta_clicks FROM priced",
    "revenue": f"SELECT {_GAP_KEYS}, CAST(cr AS DOUBLE) / 1e12 AS conversion_rate, CAST(tk AS BIGINT) AS avg_ticket, CAST(revenue AS BIGINT) AS revenue_final FROM priced",
    "position_weight": f"SELECT {_FACT_KEYS}, w.tenths / 10.0::DOUBLE AS position_weight FROM units JOIN weights w ON w.band = {_band('pos6')}",
    "raw_score": f"SELECT {_GAP_KEYS}, CAST(raw4 AS DOUBLE) / 10000 AS raw_score FROM raw",
    "whatif_score": "SELECT query, page_url, factor AS agency_factor, score FROM whatif_exact",
    "display_rounding": """
SELECT query, page_url, pos2 / 100.0::DOUBLE AS avg_position, ctr4 / 100.0::DOUBLE AS ctr_actual, exp4 / 100.0::DOUBLE AS ctr_expected,
  revenue AS revenue_final, score1 / 10.0::DOUBLE AS opportunity_score, CAST(cr AS DOUBLE) / 1e12 AS conversion_rate,
  CAST(tk AS BIGINT) AS avg_ticket, COUNT(*) AS n FROM shown GROUP BY ALL""",
    "url_department": "SELECT url, lower(split_part(split_part(url, '.cl/', 2), '/', 1)) AS department FROM urls",
    "url_category": "SELECT url, lower(split_part(split_part(url, '.cl/', 2), '/', 2)) AS category_l1 FROM urls",
    "subcategory_label": "SELECT url, COALESCE(NULLIF(split_part(split_part(url, '.cl/', 2), '/', 2), ''), '(sin subcategoría)') AS subcategory FROM urls",
    "url_path": "SELECT url, COALESCE(NULLIF(regexp_replace(regexp_replace(url, '^https?://[^/]+', ''), '/$', ''), ''), '/') AS path FROM urls",
    "is_soft_department": f"SELECT department, CAST(department IN {_SOFT} AS VARCHAR) AS is_blando FROM (SELECT department FROM pages_seen UNION SELECT split_part(url, '/', 4) FROM pages) d",
    "loose_number": f"""
SELECT o_orderkey, {_number("o_orderpriority")} AS priority, {_number("CAST(o_totalprice AS VARCHAR) || ' CLP'")} AS price,
  {_number("o_orderstatus")} AS status FROM orders""",
    "normalise_label": r"SELECT doc_id, md5(lower(regexp_replace(COALESCE(text, ''), '^[\s\p{Z}\x{FEFF}]+|[\s\p{Z}\x{FEFF}]+$', '', 'g'))) AS label_md5 FROM documents",
    "iso_week_label": "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%G-W%V') AS week FROM orders",
    "position_delta": "SELECT id, delta2 / 100.0::DOUBLE AS delta FROM watched",
    "delta_status": f"SELECT id, {_STATUS} AS status FROM watched",
    "position_band": f"SELECT date, {_band('pos6')} AS band, COUNT(*) AS n FROM units GROUP BY 1, 2",
    "target_improves": "SELECT date, query, page_url, factor AS agency_factor, CAST(tpos6 < pos6 - 50000 AS VARCHAR) AS improves FROM whatif_all",
    "watch_record": f"SELECT query, page_url, factor AS agency_factor_aplicado, ((pos6 + 5000) // 10000) / 100.0::DOUBLE AS baseline_position, ((tpos6 + 5000) // 10000) / 100.0::DOUBLE AS target_position, DATE '{AS_OF}' AS baseline_date FROM whatif_active WHERE factor <> 'NONE'",
    "incremental_daily": _GAP_OUT,
    "score_day": f"{_GAP_OUT} WHERE date = DATE '{AS_OF}'",
    "score_backfill": f"{_GAP_OUT} WHERE date BETWEEN DATE '2024-03-10' - 60 AND DATE '2024-03-10' - 4",
    "refresh_catalog": f"SELECT {_CATALOG_OUT}, CAST(is_blando AS VARCHAR) AS is_blando, '{NOW}' AS updated_at FROM fx_catalog",
    "opportunities": f"SELECT {_SHOWN} FROM listed WHERE factor = 'BOTH' AND pos6 <= 9500000 AND revenue >= 100 ORDER BY revenue DESC NULLS FIRST, query, page_url LIMIT 20",
    "incremental_facts": f"SELECT {_FACT_KEYS}, {_FACTS_OUT} FROM kept",
    "incremental_accounting": f"""
SELECT date, CASE WHEN page LIKE '%/listas/%' OR page LIKE '%/search%' OR page LIKE '%.html%' THEN 'page'
    WHEN position > 20 THEN 'position' WHEN {_branded("query")} THEN 'branded' ELSE 'kept' END AS reason, COUNT(*) AS n
FROM fx_fine GROUP BY 1, 2""",
    "incremental_summary": _SUMMARY,
    "watch_report_weeks": _report("kept_watched", "kept_series"),
    "watch_report": _report("watched", "series"),
    "what_if": "SELECT date, query, page_url, factor AS agency_factor, pos6 / 1000000.0::DOUBLE AS avg_position, tpos6 / 1000000.0::DOUBLE AS pos_target, delta AS delta_clicks, revenue, score FROM whatif_all",
    "whatif_extra_factor": "SELECT date, query, page_url, factor AS agency_factor, pos6 / 1000000.0::DOUBLE AS avg_position, tpos6 / 1000000.0::DOUBLE AS pos_target, delta AS delta_clicks, revenue, score FROM whatif_fifth",
    "what_if_newest": "SELECT date, query, page_url, factor AS agency_factor, pos6 / 1000000.0::DOUBLE AS avg_position, tpos6 / 1000000.0::DOUBLE AS pos_target, delta AS delta_clicks, revenue, score FROM whatif_now",
    "filter_max_pos_fine": f"SELECT {_GAP_KEYS}, pos6 / 1000000.0::DOUBLE AS avg_position FROM gaps WHERE pos6 <= 9999900",
    "bi_large_values": """
SELECT dept, sub, CAST(arg_max(rate, ord) AS DOUBLE) AS conversion_rate, CAST(ROUND(arg_max(ticket, ord), 0) AS BIGINT) AS avg_ticket
FROM large_bi GROUP BY dept, sub""",
    "brand_table_words": """
SELECT t.text, CAST(EXISTS (SELECT 1 FROM brand_words w WHERE contains(lower(t.text), w.term)) AS VARCHAR) AS is_branded
FROM (SELECT p_name AS text FROM part UNION ALL SELECT url FROM pages UNION ALL SELECT text FROM documents) t""",
    "brand_table_words_join": """
SELECT t.text, CAST(EXISTS (SELECT 1 FROM brand_words w WHERE contains(lower(t.text), w.term)) AS VARCHAR) AS is_branded
FROM (SELECT p_name AS text FROM part UNION ALL SELECT url FROM pages UNION ALL SELECT text FROM documents) t""",
    "brand_table_shared": _SHARED,
    "brand_table_shared_join": _SHARED,
    "brand_table_texts": """
SELECT d.doc_id, CAST(d.doc_id IN (SELECT t.doc_id FROM text_words t JOIN branded_words b ON t.word = b.word) AS VARCHAR) AS is_branded
FROM documents d""",
    "brand_table_texts_join": """
SELECT d.doc_id, CAST(d.doc_id IN (SELECT t.doc_id FROM text_words t JOIN branded_words b ON t.word = b.word) AS VARCHAR) AS is_branded
FROM documents d""",
    "upsert_landed_order": f"""
SELECT {_FACT_KEYS}, clicks + 2 AS clicks, impressions, CAST(ctr AS DOUBLE) AS ctr, CAST(position AS DOUBLE) AS position FROM kept""",
    "scan_search_responses": f"SELECT {_FACT_KEYS}, clicks + 2 AS clicks, impressions, CAST(ctr AS DOUBLE) AS ctr, CAST(position AS DOUBLE) AS position FROM kept",
    "curve_map": "SELECT CAST(slot AS BIGINT) AS position, CAST(q[2] AS DOUBLE) / 1000000 AS ctr_mid FROM quart",
    "opportunities_lenient": f"SELECT {_SHOWN} FROM listed WHERE pos6 <= 9500000 AND revenue >= 1000 ORDER BY score1 DESC NULLS FIRST, query, page_url LIMIT 10",
    "opportunities_after": f"SELECT {_SHOWN} FROM listed ORDER BY revenue DESC NULLS FIRST, query, page_url LIMIT 10 OFFSET 20",
}


def _needed(sql: str, found: list[str]) -> None:
    for name, body in CTES.items():
        if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+\(?{name}\b", sql):
            _needed(body, found)
            if name not in found:
                found.append(name)


def with_inputs(body: str) -> str:
    """The body with the views and steps it reads spelled out before it."""
    found: list[str] = []
    _needed(body, found)
    steps = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name].strip()})" for name in found)
    return f"WITH {steps}\n{body.strip()}" if found else body.strip()


def oracle_sql() -> dict[str, str]:
    return {key: with_inputs(body) for key, body in BODIES.items()}
