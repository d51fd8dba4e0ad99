"""Registry of the queries and the SQL fragments they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that gives the same rows."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


# Sums differ in their last bits between engines; the nudge keeps exact halves
# (common in averages of prices) from rounding to different sides.
NUDGE = 1.2e-8


def r(column: str | Column, digits: int = 4) -> Column:
    """Rounded double under its own name, free of negative zero."""
    value = F.col(column) if isinstance(column, str) else column
    rounded = F.round(value + F.lit(NUDGE), digits) + F.lit(0.0)
    return rounded.alias(column) if isinstance(column, str) else rounded


def R(expression: str, digits: int = 4) -> str:
    return f"(round(({expression}) + 1.2e-8::DOUBLE, {digits}) + 0.0::DOUBLE)"


def text_date(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


# Latin letters with a mark and without it, for translate().
MARKED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyAAAAAAEEEEIIIIOOOOOUUUUNCY"

# Observations of the order and line tables, in SQL.
DM = """seg_codes AS (SELECT seg, row_number() OVER (ORDER BY seg NULLS LAST) AS code FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer)),
dm AS (
  SELECT c_nationkey AS nk, n_regionkey AS rk, c_mktsegment AS seg, code,
    CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS m,
    count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS rev,
    count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open,
    count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN seg_codes ON seg_codes.seg IS NOT DISTINCT FROM c_mktsegment
  GROUP BY ALL)"""
NM = """nm AS (
  SELECT nk, rk, m, sum(n)::DOUBLE AS n, sum(rev)::DOUBLE AS rev, sum(n_open)::DOUBLE AS n_open,
    sum(n_urgent)::DOUBLE AS n_urgent
  FROM dm GROUP BY ALL)"""
LM = """lm AS (
  SELECT c_nationkey AS nk, n_regionkey AS rk,
    CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS m,
    count(*)::DOUBLE AS n, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty, sum(CAST(l_discount AS DECIMAL(18,2))) AS disc,
    (count(*) FILTER (WHERE l_returnflag = 'R'))::DOUBLE AS n_ret
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL)"""


def padded(code: str, width: int) -> str:
    """A code with zeros in front where it is shorter than ``width``; never cut."""
    return f"printf('%0{width}d', {code})"


MUN = f"'mun-' || {padded('(nk + 1)', 5)}"
PROV = f"'prov-' || {padded('(nk + 1)', 2)}"
CCAA = f"'ccaa-' || {padded('(rk + 1)', 2)}"
DIST = f"'dist-' || {padded('(nk + 1)', 5)} || '-' || {padded('code', 2)}"

_PARTS = {
    "orders_count": f"SELECT 'orders_count' AS metric_id, {MUN} AS geo_id, 'municipality' AS geo_level, 'monthly' AS cadence, m AS pidx, n AS value FROM nm",
    "revenue": f"SELECT 'revenue' AS metric_id, {MUN} AS geo_id, 'municipality' AS geo_level, 'monthly' AS cadence, m AS pidx, rev AS value FROM nm",
    "avg_ticket": f"SELECT 'avg_ticket' AS metric_id, {MUN} AS geo_id, 'municipality' AS geo_level, 'monthly' AS cadence, m AS pidx, rev / n AS value FROM nm",
    "open_share": f"SELECT 'open_share' AS metric_id, {MUN} AS geo_id, 'municipality' AS geo_level, 'monthly' AS cadence, m AS pidx, 100.0::DOUBLE * n_open / n AS value FROM nm",
    "urgent_share": f"SELECT 'urgent_share' AS metric_id, {MUN} AS geo_id, 'municipality' AS geo_level, 'monthly' AS cadence, m AS pidx, 100.0::DOUBLE * n_urgent / n AS value FROM nm",
    "world_revenue": "SELECT 'world_revenue' AS metric_id, 'es' AS geo_id, 'nation' AS geo_level, 'monthly' AS cadence, m AS pidx, sum(rev)::DOUBLE AS value FROM dm GROUP BY m",
    "orders_quarter": f"SELECT 'orders_quarter' AS metric_id, {MUN} AS geo_id, 'municipality' AS geo_level, 'quarterly' AS cadence, (m // 3)::INTEGER AS pidx, sum(n)::DOUBLE AS value FROM dm GROUP BY nk, (m // 3)::INTEGER",
    "segment_orders": f"SELECT 'segment_orders' AS metric_id, {DIST} AS geo_id, 'district' AS geo_level, 'monthly' AS cadence, m AS pidx, n::DOUBLE AS value FROM dm",
    "segment_ticket": f"SELECT 'segment_ticket' AS metric_id, {DIST} AS geo_id, 'district' AS geo_level, 'monthly' AS cadence, m AS pidx, rev::DOUBLE / n::DOUBLE AS value FROM dm",
    "buyers_annual": f"SELECT 'buyers_annual' AS metric_id, {MUN} AS geo_id, 'municipality' AS geo_level, 'annual' AS cadence, y AS pidx, n AS value FROM (SELECT c_nationkey AS nk, year(o_orderdate)::INTEGER AS y, count(DISTINCT o_custkey)::DOUBLE AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)",
    "qty_shipped": f"SELECT 'qty_shipped' AS metric_id, {PROV} AS geo_id, 'province' AS geo_level, 'monthly' AS cadence, m AS pidx, qty::DOUBLE AS value FROM lm",
    "return_rate": f"SELECT 'return_rate' AS metric_id, {PROV} AS geo_id, 'province' AS geo_level, 'monthly' AS cadence, m AS pidx, 100.0::DOUBLE * n_ret / n AS value FROM lm",
    "discount_rate": f"SELECT 'discount_rate' AS metric_id, {CCAA} AS geo_id, 'ccaa' AS geo_level, 'monthly' AS cadence, m AS pidx, 100.0::DOUBLE * sum(disc)::DOUBLE / sum(n) AS value FROM lm GROUP BY rk, m",
}


def obs_sql(*metrics: str) -> str:
    """``WITH`` clause ending in the CTE ``obs`` of the wanted metrics (all if none)."""
    wanted = metrics or tuple(_PARTS)
    body = " UNION ALL ".join(_PARTS[m] for m in wanted)
    return f"WITH {DM}, {NM}, {LM}, obs AS ({body})"


REV = f"""rlog AS (
  SELECT 'line_revenue' AS metric_id, {MUN} AS geo_id, m AS pidx, revision, value, last_day(make_date((m // 12)::INTEGER, (m % 12 + 1)::INTEGER, 1)) AS observation_end,
    CASE WHEN m % 5 <> 0 THEN (last_day(make_date((m // 12)::INTEGER, (m % 12 + 1)::INTEGER, 1)) + (revision + 1) * 30) END AS published_at
  FROM (
    SELECT c_nationkey AS nk, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS m, v.revision,
      (sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE v.top IS NULL OR l_linenumber <= v.top))::DOUBLE AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      CROSS JOIN (VALUES (0, 2), (1, 4), (2, NULL)) AS v(revision, top)
    GROUP BY ALL)
  WHERE value IS NOT NULL)"""

#: Four words of a SHA-256 ``h``, each summed modulo 2^64, in hexadecimal.
DIGEST = " || ".join(f"lpad(lower(to_hex((sum(('0x' || substr(h, {1 + 16 * i}, 16))::UBIGINT) % 18446744073709551616)::UBIGINT)), 16, '0')" for i in range(4))

PERIOD_M = "lpad((pidx // 12)::VARCHAR, 4, '0') || '-' || lpad((pidx % 12 + 1)::VARCHAR, 2, '0')"
PERIOD_ANY = (
    "CASE cadence WHEN 'annual' THEN pidx::VARCHAR WHEN 'quarterly' THEN (pidx // 4)::VARCHAR || '-Q' || (pidx % 4 + 1)::VARCHAR "
    f"ELSE {PERIOD_M} END"
)

# Place of every geography that a city level can resolve to.
BRIDGE = f"""bridge AS (
  SELECT lower(n_name) AS place, n_nationkey AS nk, n_regionkey AS rk, u.geo_level, CASE u.geo_level
      WHEN 'municipality' THEN {MUN.replace('nk', 'n_nationkey')}
      WHEN 'province' THEN {PROV.replace('nk', 'n_nationkey')}
      WHEN 'ccaa' THEN {CCAA.replace('rk', 'n_regionkey')} ELSE 'es' END AS geo_id
  FROM nation CROSS JOIN (VALUES ('municipality'), ('province'), ('ccaa'), ('nation')) AS u(geo_level))"""


def values_sql(name: str, columns: str, rows: list[tuple]) -> str:
    """A literal table as a CTE."""

    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        if isinstance(v, float):
            return f"{v!r}::DOUBLE"
        return f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"
