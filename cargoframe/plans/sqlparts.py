"""DuckDB SQL text for the same rules, used only by the oracle side."""

from __future__ import annotations

from ..functions.text import WHITESPACE
from ..sources.fixtures import HS_CODE_SQL, attribute_values_sql, shipments_sql


def strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def collapse(x: str) -> str:
    return f"regexp_replace({strip(x)}, '[{WHITESPACE}]+', ' ', 'g')"


def hs4(x: str) -> str:
    d = f"regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '[^0-9]', '', 'g')"
    return (f"(CASE WHEN {d} = '' THEN '' WHEN length({d}) = 9 THEN substr(lpad({d}, 10, '0'), 1, 4) "
            f"WHEN length({d}) < 4 THEN lpad({d}, 4, '0') ELSE substr({d}, 1, 4) END)")


def hs4_prefix(x: str) -> str:
    return f"lpad(substr({strip(x)}, 1, 4), 4, '0')"


def match_text(x: str) -> str:
    return f"(' ' || lower({collapse(f'coalesce({x}, {chr(39)}{chr(39)})')}) || ' ')"


def sha_chunk(id_expr: str, n_expr: str) -> str:
    return f"(CAST(('0x' || substr(sha256({id_expr}), 1, 8)) AS BIGINT) % {n_expr})"


def truthy(x: str) -> str:
    return f"coalesce(lower({strip(x)}) IN ('true', '1', 'yes', 'y', 't'), false)"


def clean_cte(extended: bool = False) -> str:
    """``shipments`` and ``clean`` CTE bodies (no leading WITH)."""
    return f"""shipments AS ({shipments_sql(extended)}),
clean AS (
  SELECT * REPLACE ({strip('CAST(hs_code AS VARCHAR)')} AS hs_code,
                    {strip("coalesce(goods_shipped, '')")} AS goods_shipped,
                    {strip('shipment_id')} AS shipment_id),
         {hs4('hs_code')} AS hs4,
         {hs4_prefix('hs_code')} AS hs4_prefix
  FROM shipments
  WHERE {strip("coalesce(goods_shipped, '')")} <> ''
)"""


def dictionary_ctes() -> str:
    """``attrvals``, ``schema``, ``dict`` (compiled patterns) — after clean."""
    return f"""attrvals AS ({attribute_values_sql()}),
schema AS (
  SELECT p.hs4, p.product, a.attr, a.attr_ord, a.value, a.value_ord
  FROM (SELECT DISTINCT {hs4(strip(HS_CODE_SQL))} AS hs4, p_type AS product FROM part) p, attrvals a
),
dict0 AS (
  SELECT *, lower({collapse('value')}) AS norm FROM schema WHERE length({strip('value')}) >= 3
),
dict AS (
  SELECT hs4, product, attr, attr_ord, value, norm,
         '(^|[^a-z0-9])\\Q' || norm || '\\E($|[^a-z0-9])' AS pattern
  FROM (SELECT *, row_number() OVER (PARTITION BY hs4, product, attr, norm ORDER BY value_ord) AS rn FROM dict0)
  WHERE rn = 1
)"""


def goods_ctes() -> str:
    """Distinct goods per product with match text — after clean."""
    return f"""goods AS (
  SELECT hs4, category AS product, goods_shipped, min(ord) AS first_ord, count(*) AS n_rows,
         {match_text('goods_shipped')} AS t
  FROM clean GROUP BY hs4, category, goods_shipped
)"""


def matches_ctes() -> str:
    return """hits AS (
  SELECT g.hs4, g.product, g.goods_shipped, g.n_rows, g.t, d.attr, d.value, d.pattern,
         row_number() OVER (PARTITION BY g.hs4, g.product, g.goods_shipped, d.attr
                            ORDER BY length(d.value) DESC, d.value) AS rn
  FROM goods g JOIN dict d ON g.hs4 = d.hs4 AND g.product = d.product
  WHERE regexp_matches(g.t, d.pattern)
),
matches AS (SELECT hs4, product, goods_shipped, n_rows, t, attr, value, pattern FROM hits WHERE rn = 1)"""


def resolved_ctes() -> str:
    """``resolved(hs4, product, goods_shipped, attr, value, source)``: dictionary >
    heuristic > 'None' for every (description, attribute) — after matches."""
    return f"""attrs AS (SELECT DISTINCT hs4, product, attr, attr_ord FROM schema),
ht AS (SELECT hs4, product, goods_shipped, translate(lower(goods_shipped), '#,;/\\()', '       ') AS h FROM goods),
cand AS (
  SELECT ht.hs4, ht.product, ht.goods_shipped, s.attr, s.value,
         row_number() OVER (PARTITION BY ht.hs4, ht.product, ht.goods_shipped, s.attr
                            ORDER BY length(s.value) DESC, s.value) AS rn
  FROM ht JOIN schema s ON ht.hs4 = s.hs4 AND ht.product = s.product
  WHERE length(s.value) > 0 AND strpos(ht.h, lower(s.value)) > 0
    AND (strpos(ht.h, lower(s.value)) = 1
         OR regexp_matches(substr(ht.h, strpos(ht.h, lower(s.value)) - 1, 1), '^[{WHITESPACE}]$'))
    AND (strpos(ht.h, lower(s.value)) + length(lower(s.value)) > length(ht.h)
         OR regexp_matches(substr(ht.h, strpos(ht.h, lower(s.value)) + length(lower(s.value)), 1), '^[{WHITESPACE}]$'))
),
resolved AS (
  SELECT g.hs4, g.product, g.goods_shipped, a.attr, a.attr_ord,
         coalesce(m.value, c.value, 'None') AS value,
         CASE WHEN m.value IS NOT NULL THEN 'dictionary' WHEN c.value IS NOT NULL THEN 'heuristic' ELSE 'none' END AS source
  FROM goods g JOIN attrs a ON g.hs4 = a.hs4 AND g.product = a.product
  LEFT JOIN matches m ON m.hs4 = g.hs4 AND m.product = g.product AND m.goods_shipped = g.goods_shipped AND m.attr = a.attr
  LEFT JOIN cand c ON c.hs4 = g.hs4 AND c.product = g.product AND c.goods_shipped = g.goods_shipped
                  AND c.attr = a.attr AND c.rn = 1
)"""


def wide_ctes(attrs: list[str]) -> str:
    """``wide`` per description and ``rows`` per shipment (K1 layout) — after resolved."""
    cols = ", ".join(f"max(CASE WHEN attr = '{a}' THEN value END) AS attr_{a}" for a in attrs)
    rcols = ", ".join(f"w.attr_{a}" for a in attrs)
    return f"""wide AS (SELECT hs4, product, goods_shipped, {cols} FROM resolved GROUP BY hs4, product, goods_shipped),
rows AS (SELECT c.shipment_id, c.ord, c.hs4, c.category AS product, c.goods_shipped, c.weight_in_kg, {rcols}
         FROM clean c JOIN wide w ON c.hs4 = w.hs4 AND c.category = w.product AND c.goods_shipped = w.goods_shipped)"""


def json_str(x: str) -> str:
    esc = f"replace(replace(replace(replace(replace({x}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    return f"('\"' || {esc} || '\"')"


def all_ctes(attrs: list[str]) -> str:
    return f"{clean_cte()}, {dictionary_ctes()}, {goods_ctes()}, {matches_ctes()}, {resolved_ctes()}, {wide_ctes(attrs)}"
