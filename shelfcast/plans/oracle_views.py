"""DuckDB SQL text of the derived views (see ``shelfcast.sources.views``).

Used only by the correctness gate: each oracle query is ``WITH <views>
SELECT ...`` over the driver's pre-registered tables.  The fixed values come
from the Spark module so both sides share one definition.
"""

from __future__ import annotations

from shelfcast.sources import views as V

_D0 = f"DATE '{V.CALENDAR_START}'"


def _dnum(date_expr: str) -> str:
    return f"CAST(date_diff('day', {_D0}, {date_expr}) + 1 AS INTEGER)"


def _wk(dnum_expr: str) -> str:
    return f"CAST(floor({dnum_expr} / 7) + 1 AS INTEGER)"


V_SALES = f"""v_sales AS (
  SELECT p_brand AS id, CAST(l_shipdate AS DATE) AS date,
         {_dnum('CAST(l_shipdate AS DATE)')} AS d_num,
         SUM(l_quantity) AS sales
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_brand, CAST(l_shipdate AS DATE))"""

_BN = "CAST(regexp_extract(p_brand, '#(\\d+)$', 1) AS INTEGER)"

V_FACTS = f"""v_facts AS (
  SELECT p_brand AS item_id,
         'DEPT_' || CAST({_BN} % 6 AS VARCHAR) AS dept_id,
         'CAT_' || CAST({_BN} % 3 AS VARCHAR) AS cat_id,
         'STORE_' || CAST(r_regionkey AS VARCHAR) AS store_id,
         'STATE_' || CAST(r_regionkey % 2 AS VARCHAR) AS state_id,
         CAST(l_shipdate AS DATE) AS date,
         l_quantity, l_extendedprice, l_discount
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

V_PANEL = f"""v_panel AS (
  SELECT item_id || '_' || store_id || '_validation' AS id,
         item_id, dept_id, cat_id, store_id, state_id,
         'd_' || CAST({_dnum('date')} AS VARCHAR) AS d,
         {_dnum('date')} AS d_num, date, SUM(l_quantity) AS sales
  FROM v_facts
  GROUP BY item_id, dept_id, cat_id, store_id, state_id, date)"""

V_PRICES = f"""v_prices AS (
  SELECT item_id, store_id, {_wk(_dnum('date'))} AS wm_yr_wk,
         SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) / SUM(l_quantity) / 100.0 AS sell_price
  FROM v_facts
  WHERE l_discount <= {V.PRICE_MAX_DISCOUNT}
  GROUP BY ALL)"""


def _event_case(idx: int, field: int) -> str:
    whens = []
    for ev in V.CALENDAR_EVENTS:
        m, d = ev[0], ev[1]
        val = ev[field]
        if val is not None:
            whens.append(f"WHEN month(date) = {m} AND dayofmonth(date) = {d} THEN '{val}'")
    return "CASE " + " ".join(whens) + " END" if whens else "CAST(NULL AS VARCHAR)"


V_CALENDAR = f"""v_calendar AS (
  SELECT date, 'd_' || CAST({_dnum('date')} AS VARCHAR) AS d,
         {_dnum('date')} AS d_num,
         {_wk(_dnum('date'))} AS wm_yr_wk,
         dayname(date) AS weekday,
         CAST(((dayofweek(date) + 1) % 7) + 1 AS INTEGER) AS wday,
         CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year,
         {_event_case(0, 2)} AS event_name_1,
         {_event_case(0, 3)} AS event_type_1,
         {_event_case(0, 4)} AS event_name_2,
         {_event_case(0, 5)} AS event_type_2,
         CAST(dayofmonth(date) <= 10 AS DOUBLE) AS snap_CA,
         CAST(dayofmonth(date) <= 15 AND dayofmonth(date) % 2 = 1 AS DOUBLE) AS snap_TX,
         CAST(dayofmonth(date) >= 2 AND dayofmonth(date) <= 15 AND dayofmonth(date) % 2 = 0 AS DOUBLE) AS snap_WI
  FROM (SELECT CAST(unnest(generate_series(DATE '{V.CALENDAR_START}', DATE '{V.CALENDAR_END}',
                                           INTERVAL 1 DAY)) AS DATE) AS date))"""


def v_wide(by: str = "event_type", name: str | None = None) -> str:
    name = name or ("v_wide" if by == "event_type" else "v_wide_user")
    cols = []
    for d in range(1, V.EVENTS_DAYS + 1):
        cnt = f"count(*) FILTER (WHERE day = {d})"
        if by == "event_type":
            cols.append(f"CAST({cnt} AS DOUBLE) AS d_{d}")
        else:
            cols.append(f"CAST(NULLIF({cnt}, 0) AS DOUBLE) AS d_{d}")
    return f"""{name} AS (
  SELECT id, {', '.join(cols)}
  FROM (SELECT CAST({by} AS VARCHAR) AS id,
               CAST(date_diff('day', DATE '{V.EVENTS_START}', CAST(ts AS DATE)) + 1 AS INTEGER) AS day
        FROM events) e
  WHERE day BETWEEN 1 AND {V.EVENTS_DAYS}
  GROUP BY id)"""


_VIEWS = {
    "v_sales": V_SALES,
    "v_facts": V_FACTS,
    "v_panel": V_PANEL,
    "v_prices": V_PRICES,
    "v_calendar": V_CALENDAR,
    "v_wide": v_wide("event_type"),
    "v_wide_user": v_wide("user_id"),
}
_DEPS = {"v_panel": ["v_facts"], "v_prices": ["v_facts"]}


def with_views(*names: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding the named views (dependencies first) and any
    extra ``name AS (...)`` CTE strings."""
    ordered: list[str] = []
    for n in names:
        for dep in _DEPS.get(n, []):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    parts = [_VIEWS[n] for n in ordered] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n"
