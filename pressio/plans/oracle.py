"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code, from the same specification, over
the driver's tables (views ``lineitem``, ``orders``, ...). Doubles are kept
as doubles (DuckDB reads ``0.95`` as DECIMAL, so literals are cast), integer
sums are cast back to BIGINT, and the R rounding rule is spelled out with
``floor``/``ceil`` exactly as the Spark expression does.
"""

from __future__ import annotations

import datetime as dt

from ..sources.adapters import DRIVER as CFG

TOTAL = CFG.total_label
NATIONS = tuple(f"NATION_{i}" for i in range(25))
ENTITY_NAMES = tuple(sorted(NATIONS + (TOTAL,)))
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def dbl(v) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def day(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def round_r(x: str, d: int) -> str:
    p = dbl(10 ** d)
    s = f"(({x}) * {p})"
    lo_i, hi_i = f"floor({s})", f"ceil({s})"
    down, up = f"(({x}) - {lo_i} / {p})", f"({hi_i} / {p} - ({x}))"
    pick = f"CAST(({down} > {up}) OR ({down} = {up} AND {lo_i} % 2 <> 0) AS BIGINT)"
    return (f"(CASE WHEN abs({s}) < {dbl(2 ** 52)} "
            f"THEN ({lo_i} + ({hi_i} - {lo_i}) * {pick}) / {p} ELSE ({x}) END)")


def div(a: str, b: str) -> str:
    return (f"(CASE WHEN CAST({b} AS DOUBLE) = 0 THEN NULL "
            f"ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)")


def ssum(x: str) -> str:
    return f"CAST(CASE WHEN COUNT({x}) = COUNT(*) THEN SUM({x}) END AS BIGINT)"


def week_no(d: str) -> str:
    return f"CAST(floor((dayofyear({d}) - 1) / 7) + 1 AS INTEGER)"


def week_label(year: str, week: str) -> str:
    jan1 = f"make_date(CAST({year} AS BIGINT), 1, 1)"
    return (f"({jan1} + CAST(((7 - dayofweek({jan1})) % 7) + ({week} - 1) * 7 + 1"
            f" AS INTEGER))")


# --- the CTE chain, in dependency order ---------------------------------------
T = CFG.thresholds
PER = dbl(CFG.per)
POP_PER = f"(CAST(popolazione AS DOUBLE) / {PER})"
KPI_DOUBLES = (
    ["incidenza", "saturazione_ti", "saturazione_area_non_critica"]
    + [f"casi_soglia_{t}" for t in T]
    + ["vaccinati_suscettibili", "suscettibili"]
    + [f"casi_soglia_{t}_suscettibili" for t in T]
    + [f"soglia_{t}_effettiva" for t in T]
    + ["moltiplicatore_vaccini"]
    + [f"soglia_{t}_equivalente" for t in T]
    + ["indicatore_stress"]
)
CARRIED = ["data", "denominazione_regione", "totale_casi", "terapia_intensiva",
           "ricoverati_con_sintomi", "totale_casi_lag", "incremento",
           "PL_area_non_critica", "PL_terapia_intensiva", "popolazione",
           "nuovi_vaccinati", "vaccinati"]

CTES: list[tuple[str, str]] = [
    ("inc_daily", """
SELECT CAST(l.l_shipdate AS DATE) AS d, n.n_name AS region,
       SUM(l.l_quantity) AS qty,
       COUNT(CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 END) AS ti,
       COUNT(CASE WHEN o.o_orderstatus = 'F' THEN 1 END) AS ric
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2"""),
    ("incidence_raw", """
SELECT strftime(d, '%Y-%m-%d') || 'T18:00:00' AS data, region AS denominazione_regione,
       CAST(SUM(qty) OVER (PARTITION BY region ORDER BY d
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS totale_casi,
       CAST(ti AS BIGINT) AS terapia_intensiva, CAST(ric AS BIGINT) AS ricoverati_con_sintomi
FROM inc_daily"""),
    ("incidence", r"""
SELECT * FROM (
  SELECT TRY_CAST(regexp_extract(data, '^([^T\s]+)', 1) AS DATE) AS data,
         denominazione_regione, totale_casi, terapia_intensiva, ricoverati_con_sintomi
  FROM incidence_raw) WHERE data IS NOT NULL"""),
    ("incidence_total", f"""
SELECT data, denominazione_regione, totale_casi, terapia_intensiva, ricoverati_con_sintomi
FROM incidence
UNION ALL
SELECT data, {lit(TOTAL)}, {ssum('totale_casi')}, {ssum('terapia_intensiva')},
       {ssum('ricoverati_con_sintomi')}
FROM incidence GROUP BY data"""),
    ("incidence_lag", f"""
SELECT *, LAG(totale_casi, {CFG.delta}) OVER w AS totale_casi_lag,
       totale_casi - LAG(totale_casi, {CFG.delta}) OVER w AS incremento
FROM incidence_total WINDOW w AS (PARTITION BY denominazione_regione ORDER BY data)"""),
    ("dimension_raw", """
SELECT n.n_name AS denominazione_regione, CAST(3 * COUNT(*) AS BIGINT) AS PL_area_non_critica,
       CAST(1 + COUNT(CASE WHEN c.c_acctbal < 0 THEN 1 END) AS BIGINT) AS PL_terapia_intensiva,
       CAST(5000 * COUNT(*) AS BIGINT) AS popolazione
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name"""),
    ("dim_total", f"""
SELECT denominazione_regione, PL_area_non_critica, PL_terapia_intensiva, popolazione
FROM dimension_raw
UNION ALL
SELECT {lit(TOTAL)}, {ssum('PL_area_non_critica')}, {ssum('PL_terapia_intensiva')},
       {ssum('popolazione')}
FROM dimension_raw"""),
    ("vaccination_raw", """
SELECT CAST(l.l_shipdate AS DATE) AS data_somministrazione, n.n_name AS nome_area,
       CAST(l.l_linenumber AS VARCHAR) AS fascia_anagrafica, l.l_returnflag AS fornitore,
       CAST(CASE WHEN l.l_linestatus = 'F' THEN l.l_quantity ELSE 0 END AS BIGINT) AS prima_dose,
       CAST(CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity ELSE 0 END AS BIGINT) AS seconda_dose,
       CAST(CASE WHEN l.l_discount = 0 THEN 1 ELSE 0 END AS BIGINT) AS pregressa_infezione
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    ("vax_conformed", """
SELECT data_somministrazione AS data, nome_area AS denominazione_regione, fascia_anagrafica,
       fornitore, prima_dose, seconda_dose, pregressa_infezione
FROM vaccination_raw WHERE data_somministrazione IS NOT NULL"""),
    ("vax_sums", f"""
SELECT data, denominazione_regione, fornitore, {ssum('prima_dose')} AS prima_dose,
       {ssum('seconda_dose')} AS seconda_dose, {ssum('pregressa_infezione')} AS pregressa_infezione
FROM vax_conformed GROUP BY data, denominazione_regione, fornitore"""),
    ("vax_prepped", f"""
SELECT *, CASE WHEN fornitore = {lit(CFG.single_dose_supplier)}
               THEN prima_dose + pregressa_infezione
               ELSE seconda_dose + pregressa_infezione END AS totale
FROM vax_sums"""),
    ("vax_daily", f"""
SELECT data, CASE WHEN GROUPING(denominazione_regione) = 1 THEN {lit(TOTAL)}
                  ELSE denominazione_regione END AS denominazione_regione,
       {ssum('totale')} AS nuovi_vaccinati
FROM vax_prepped GROUP BY GROUPING SETS ((data, denominazione_regione), (data))"""),
    ("vax_series", """
SELECT data, denominazione_regione, nuovi_vaccinati,
       CASE WHEN COUNT(nuovi_vaccinati) OVER w = COUNT(*) OVER w
            THEN CAST(SUM(nuovi_vaccinati) OVER w AS BIGINT) END AS vaccinati
FROM vax_daily WINDOW w AS (PARTITION BY denominazione_regione ORDER BY data
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    ("j1", """
SELECT i.data, i.denominazione_regione, i.totale_casi, i.terapia_intensiva,
       i.ricoverati_con_sintomi, i.totale_casi_lag, i.incremento,
       d.PL_area_non_critica, d.PL_terapia_intensiva, d.popolazione
FROM incidence_lag i LEFT JOIN dim_total d
  ON i.denominazione_regione IS NOT DISTINCT FROM d.denominazione_regione"""),
    ("j2", """
SELECT v.data, v.denominazione_regione, j.totale_casi, j.terapia_intensiva,
       j.ricoverati_con_sintomi, j.totale_casi_lag, j.incremento, j.PL_area_non_critica,
       j.PL_terapia_intensiva, j.popolazione, v.nuovi_vaccinati, v.vaccinati
FROM vax_series v LEFT JOIN j1 j
  ON v.data IS NOT DISTINCT FROM j.data
 AND v.denominazione_regione IS NOT DISTINCT FROM j.denominazione_regione"""),
    ("k1", "SELECT *, "
     + f"{div('incremento', POP_PER)} AS incidenza, "
     + f"{div('terapia_intensiva', 'PL_terapia_intensiva')} AS saturazione_ti, "
     + f"{div('ricoverati_con_sintomi', 'PL_area_non_critica')} AS saturazione_area_non_critica, "
     + ", ".join(f"{POP_PER} * {dbl(t)} AS casi_soglia_{t}" for t in T) + ", "
     + round_r(f"CAST(vaccinati AS DOUBLE) * {dbl(1.0 - CFG.efficacy)}", 0)
     + " AS vaccinati_suscettibili FROM j2"),
    ("k2", "SELECT *, "
     + round_r("CAST(popolazione - vaccinati AS DOUBLE) + vaccinati_suscettibili", 0)
     + " AS suscettibili FROM k1"),
    ("k3", "SELECT *, "
     + ", ".join(f"suscettibili / {PER} * {dbl(t)} AS casi_soglia_{t}_suscettibili" for t in T)
     + " FROM k2"),
    ("k4", "SELECT *, "
     + ", ".join(round_r(div(f"casi_soglia_{t}_suscettibili", POP_PER), 0)
                 + f" AS soglia_{t}_effettiva" for t in T)
     + f", {div(f'casi_soglia_{T[0]}', f'casi_soglia_{T[0]}_suscettibili')} AS moltiplicatore_vaccini"
     + " FROM k3"),
    ("k5", "SELECT *, "
     + ", ".join(round_r(f"{dbl(t)} * moltiplicatore_vaccini", 0) + f" AS soglia_{t}_equivalente"
                 for t in T)
     + " FROM k4"),
    ("k6", f"SELECT *, {div('incidenza', f'soglia_{T[0]}_equivalente')} AS indicatore_stress FROM k5"),
    ("res", "SELECT " + ", ".join(CARRIED) + ", "
     + ", ".join(f"{round_r(c, 2)} AS {c}" for c in KPI_DOUBLES) + " FROM k6"),
    ("wk", f"""
SELECT {week_no('data')} AS week, CAST(year(data) AS INTEGER) AS year,
       denominazione_regione, indicatore_stress
FROM res WHERE data BETWEEN {day(CFG.weekly_start)} AND {day(CFG.as_of)}"""),
    ("wv", """
SELECT week, year, denominazione_regione,
       list_sort(list(indicatore_stress)) AS v,
       COUNT(indicatore_stress) = COUNT(*) AS ok
FROM wk GROUP BY week, year, denominazione_regione"""),
    ("wm", """
SELECT *, list_reduce(v, lambda a, b: a + b) / CAST(len(v) AS DOUBLE) AS m FROM wv"""),
    ("wl", """
SELECT week, year, denominazione_regione,
       CASE WHEN ok AND len(v) > 0
            THEN m + list_reduce(list_transform(v, lambda t: t - m), lambda a, b: a + b)
                     / CAST(len(v) AS DOUBLE) END AS mean
FROM wm"""),
    ("weekly_long", f"""
SELECT week, year, denominazione_regione, {round_r('mean', 2)} AS media_indicatore_stress
FROM wl WHERE week IS NOT NULL AND year IS NOT NULL AND denominazione_regione IS NOT NULL
  AND mean IS NOT NULL AND NOT isnan(mean)"""),
    ("weekly_piv", "SELECT week, year, "
     + ", ".join(f"MAX(CASE WHEN denominazione_regione = {lit(n)} THEN media_indicatore_stress END)"
                 f" AS {ident(n)}" for n in ENTITY_NAMES)
     + " FROM weekly_long GROUP BY week, year"),
    ("lines", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity <> 13 THEN CAST(l_quantity AS BIGINT) END AS qty
FROM lineitem"""),
    ("ship_weeks", f"""
SELECT d, {week_no('d')} AS week, CAST(year(d) AS INTEGER) AS year,
       {week_label('year(d)', week_no('d'))} AS week_label
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"""),
]
CTE_NAMES = [n for n, _ in CTES]
# Stages computed once: inlining the chained rounding expressions into their
# consumers would grow the expression text multiplicatively.
MATERIALIZED = {"k1", "k2", "k3", "k4", "k5", "k6", "res", "weekly_long"}


def with_chain(final_select: str, upto: str | None) -> str:
    """``WITH`` every CTE up to and including ``upto``, then the select."""
    if upto is None:
        return final_select.strip()
    idx = CTE_NAMES.index(upto)
    body = ",\n".join(
        f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({sql.strip()})"
        for n, sql in CTES[: idx + 1])
    return f"WITH {body}\n{final_select.strip()}"


def _snapshot(k: int) -> str:
    return f"data = {day(CFG.day(k))}"


def _scatter_cols() -> str:
    labels = dict((c, lab) for lab, c in CFG.scatter_labels)
    perc = round_r(div("vaccinati", "popolazione"), 4) + f" * {dbl(100)}"
    return (f"denominazione_regione, indicatore_stress, incidenza AS {ident(labels['incidenza'])}, "
            f"vaccinati, popolazione, {perc} AS {ident(labels['vaccinati_perc'])}")


def _labelled_cols() -> str:
    last = {}
    for lab, c in CFG.table_labels:
        last[c] = lab
    cols = CARRIED + KPI_DOUBLES
    return ", ".join(f"{c} AS {ident(last[c])}" if c in last else c for c in cols)


def _recode_case() -> str:
    from .catalog import DRIVER_RECODE
    whens = " ".join(f"WHEN denominazione_regione = {lit(a)} THEN {lit(b)}"
                     for a, b in DRIVER_RECODE)
    return f"CASE {whens} ELSE denominazione_regione END"


def _events_wide() -> str:
    cells = ", ".join(f"MAX(CASE WHEN event_type = {lit(t)} THEN value END) AS {ident(t)}"
                      for t in EVENT_TYPES)
    return f"""
SELECT day, {cells} FROM (
  SELECT day, event_type, {round_r('s', 2)} AS value FROM (
    SELECT CAST(ts AS DATE) AS day, event_type, SUM(value) AS s FROM events GROUP BY 1, 2))
GROUP BY day"""


def _population() -> str:
    return f"""
WITH pc AS (
  SELECT n.n_name AS denominazione_regione,
         CAST(COALESCE(SUM(c.c_custkey), 0) AS BIGINT) AS popolazione_totale
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name)
SELECT *, CAST(row_number() OVER (ORDER BY denominazione_regione = {lit(TOTAL)}, popolazione_totale DESC,
                             denominazione_regione) AS INTEGER) AS rank
FROM (SELECT denominazione_regione, popolazione_totale FROM pc
      UNION ALL
      SELECT {lit(TOTAL)}, {ssum('popolazione_totale')} FROM pc)"""


FEED_CELLS = """
SELECT l_orderkey, l_linenumber,
  CASE l_linenumber % 5 WHEN 3 THEN NULL WHEN 2 THEN 100 * CAST(l_quantity AS BIGINT)
       ELSE CAST(l_quantity AS BIGINT) END AS totale_casi,
  CASE WHEN l_linenumber % 5 <> 4 THEN CAST(l_partkey AS BIGINT) END AS terapia_intensiva,
  CASE WHEN l_linenumber % 5 <> 2 THEN ' a ' END AS note
FROM lineitem"""

DATE_SPELLINGS = """
SELECT l_orderkey, l_linenumber,
  CASE k WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y-%-m-%-d')
         WHEN 2 THEN strftime(d, '%Y.%m.%d') WHEN 3 THEN strftime(d, '%Y %m %d')
         WHEN 4 THEN strftime(d, '%Y%m%d') WHEN 5 THEN strftime(d, '%Y/%m/%d') || 'T18:00:00'
         WHEN 6 THEN CAST(year(d) AS VARCHAR) || '-02-30' END AS text,
  CASE WHEN k < 6 THEN d END AS day, k = 6 AS rejected
FROM (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d,
             (l_orderkey + l_linenumber) % 8 AS k FROM lineitem)"""

NUMBER_TEXT = """
SELECT l_orderkey, l_linenumber, CAST(CAST(round_even(l_extendedprice, 0) AS BIGINT) AS VARCHAR) AS whole,
  CAST(cents // 4 AS VARCHAR) || CASE cents % 4 WHEN 0 THEN '' WHEN 1 THEN '.25' WHEN 2 THEN '.5'
                                       ELSE '.75' END AS quarters,
  CAST(cents * 274877906944 + 1 AS VARCHAR) AS exact,
  CAST(CAST(cents AS HUGEINT) * 1125899906842624 AS VARCHAR) AS large
FROM (SELECT *, CAST(round_even(l_extendedprice * CAST(100 AS DOUBLE), 0) AS BIGINT) AS cents FROM lineitem)"""

JOIN_NULL_KEYS = """
WITH l AS (
  SELECT CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
         nullif(c_nationkey, 7) AS entity
  FROM orders JOIN customer ON o_custkey = c_custkey
), a AS (
  SELECT day, entity, count(*) AS n_orders FROM l WHERE day IS NOT NULL GROUP BY day, entity
), b AS (
  SELECT nullif(c_nationkey, 7) AS entity, count(*) AS n_customers FROM customer GROUP BY 1
)
SELECT a.day, a.entity, a.n_orders, b.n_customers
FROM a LEFT JOIN b ON a.entity IS NOT DISTINCT FROM b.entity AND b.entity IS DISTINCT FROM 3"""


# A landed feed whose counts and days are spelled by kind, some unreadable.
LANDED = """
WITH feed AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q, CAST(l_shipdate AS DATE) AS d,
         (l_orderkey + l_linenumber) % 7 AS kind FROM lineitem
), cells AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN kind NOT IN (1, 2, 3) THEN q END AS totale_casi,
         CASE WHEN kind NOT IN (3, 4, 5) THEN d END AS day,
         CASE kind WHEN 1 THEN q || 'x' WHEN 3 THEN q || '.5' END AS bad_count,
         CASE kind WHEN 3 THEN year(d) || '-02-30' WHEN 4 THEN 'soon' END AS bad_day FROM feed)
"""
FEED_ROWS = LANDED + """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  totale_casi, day, bad_count, bad_day FROM cells"""
FEED_REJECTS = LANDED + """
SELECT x."column", COUNT(*) AS n_rows,
       CAST(SUM(CASE x."column" WHEN 'totale_casi' THEN CAST(bad_count IS NOT NULL AS INTEGER)
                WHEN 'data' THEN CAST(bad_day IS NOT NULL AS INTEGER) ELSE 0 END) AS BIGINT) AS n_rejected
FROM cells, (VALUES ('l_orderkey'), ('l_linenumber'), ('totale_casi'), ('data'), ('(record)')) x("column")
GROUP BY x."column"
"""
PUBLISHED_TEXT = r"""
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
       COALESCE(regexp_replace(CAST(m AS VARCHAR), '\.0$', ''), 'NA') AS mean_qty
FROM (SELECT l_orderkey, CASE WHEN COUNT(q) = COUNT(*) THEN CAST(SUM(q) AS DOUBLE) / COUNT(*) END AS m
      FROM (SELECT l_orderkey, CASE WHEN l_quantity <> 13 THEN CAST(l_quantity AS BIGINT) END AS q FROM lineitem)
      GROUP BY l_orderkey)
"""


def _result_months() -> str:
    first = CFG.day(40).replace(day=1)
    after = (CFG.as_of.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return (f"SELECT * FROM incidence WHERE {ident(CFG.date)} >= {day(first)} "
            f"AND {ident(CFG.date)} < {day(after)}")


def oracle_sql() -> dict[str, str]:
    lo60, hi2 = day(CFG.day(CFG.last_days)), day(CFG.day(CFG.snapshot_lag))
    wk_key = "week * 10000 + year"
    q = {
        "conform_incidence": with_chain("SELECT * FROM incidence", "incidence"),
        "entity_recode": with_chain(
            f"SELECT data, {_recode_case()} AS denominazione_regione, fascia_anagrafica, "
            "fornitore, prima_dose, seconda_dose, pregressa_infezione FROM vax_conformed",
            "vax_conformed"),
        "dose_sums": with_chain("SELECT * FROM vax_sums", "vax_sums"),
        "completed_courses": with_chain("SELECT * FROM vax_prepped", "vax_prepped"),
        "incidence_with_total": with_chain("SELECT * FROM incidence_total", "incidence_total"),
        "vaccination_with_total": with_chain("SELECT * FROM vax_daily", "vax_daily"),
        "dimension_with_total": with_chain("SELECT * FROM dim_total", "dim_total"),
        "lag_increment": with_chain("SELECT * FROM incidence_lag", "incidence_lag"),
        "running_total": with_chain("SELECT * FROM vax_series", "vax_series"),
        "lag_increment_by_month": with_chain("SELECT * FROM incidence_lag", "incidence_lag"),
        "running_total_by_month": with_chain("SELECT * FROM vax_series", "vax_series"),
        "strict_sum": with_chain(
            f"SELECT l_orderkey, {ssum('qty')} AS sum_qty, COUNT(*) AS n_lines "
            "FROM lines GROUP BY l_orderkey", "lines"),
        "strict_mean": with_chain(
            "SELECT l_orderkey, CASE WHEN COUNT(qty) = COUNT(*) THEN AVG(qty) END AS mean_qty "
            "FROM lines GROUP BY l_orderkey", "lines"),
        "strict_cumsum": with_chain(
            "SELECT l_orderkey, l_linenumber, qty, CASE WHEN COUNT(qty) OVER w = COUNT(*) OVER w "
            "THEN CAST(SUM(qty) OVER w AS BIGINT) END AS cum_qty FROM ("
            f"SELECT l_orderkey, l_linenumber, {ssum('qty')} AS qty FROM lines "
            "GROUP BY l_orderkey, l_linenumber) "
            "WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", "lines"),
        "join_dimension": with_chain("SELECT * FROM j1", "j1"),
        "join_right": with_chain("SELECT * FROM j2", "j2"),
        "round_parity": (
            "SELECT l_orderkey, l_linenumber, " + round_r("x", 0) + " AS r0, "
            + round_r("x", 2) + " AS r2, " + round_r("x", 4) + " AS r4, "
            + round_r("h", 2) + " AS half2 FROM (SELECT l_orderkey, l_linenumber, "
            f"l_extendedprice * l_discount / {dbl(3)} AS x, l_extendedprice / {dbl(2)} AS h "
            "FROM lineitem)"),
        "week_number_label": with_chain("SELECT * FROM ship_weeks", "ship_weeks"),
        "date_filters": with_chain(
            f"SELECT * FROM incidence WHERE data BETWEEN {lo60} AND {hi2}", "incidence"),
        "drop_incomplete": with_chain(
            "SELECT data, denominazione_regione, incremento, incidenza, indicatore_stress FROM res "
            "WHERE data IS NOT NULL AND denominazione_regione IS NOT NULL AND incremento IS NOT NULL "
            "AND incidenza IS NOT NULL AND NOT isnan(incidenza) AND indicatore_stress IS NOT NULL "
            "AND NOT isnan(indicatore_stress)", "res"),
        "drop_last_key": with_chain(
            f"SELECT * FROM ship_weeks WHERE {wk_key} < (SELECT MAX({wk_key}) FROM ship_weeks)",
            "ship_weeks"),
        "weekly_mean_long": with_chain("SELECT * FROM weekly_long", "weekly_long"),
        "weekly_wide": with_chain(
            f"SELECT {week_label('year', 'week')} AS week, year, "
            + ", ".join(ident(n) for n in ENTITY_NAMES)
            + f" FROM weekly_piv WHERE {wk_key} < (SELECT MAX({wk_key}) FROM weekly_piv)",
            "weekly_piv"),
        "daily_wide": with_chain(
            "SELECT data, "
            + ", ".join(f"MAX(CASE WHEN denominazione_regione = {lit(n)} THEN indicatore_stress END)"
                        f" AS {ident(n)}" for n in ENTITY_NAMES)
            + f" FROM res WHERE data BETWEEN {lo60} AND {hi2} GROUP BY data", "res"),
        "events_daily_wide": _events_wide(),
        "weighted_count": _population(),
        "feed_cells": FEED_CELLS,
        "date_spellings": DATE_SPELLINGS,
        "feed_rows": FEED_ROWS,
        "feed_rejects": FEED_REJECTS,
        "result_months": with_chain(_result_months(), "incidence"),
        "published_text": PUBLISHED_TEXT,
        "number_text": NUMBER_TEXT,
        "join_null_keys": JOIN_NULL_KEYS,
        "full_result": with_chain("SELECT * FROM res", "res"),
        "snapshot_labelled": with_chain(
            f"SELECT {_labelled_cols()} FROM res WHERE {_snapshot(CFG.snapshot_lag)}", "res"),
        "snapshot_map": with_chain(
            f"SELECT denominazione_regione, indicatore_stress FROM res "
            f"WHERE {_snapshot(CFG.snapshot_lag)}", "res"),
        "snapshot_scatter": with_chain(
            f"SELECT {_scatter_cols()} FROM res WHERE {_snapshot(CFG.snapshot_lag)}", "res"),
        "arrow": with_chain(f"""
SELECT t.data, t1.denominazione_regione, t.indicatore_stress_t, t1.indicatore_stress_t1
FROM (SELECT denominazione_regione, indicatore_stress AS indicatore_stress_t1 FROM res
      WHERE {_snapshot(CFG.previous_lag)}) t1
LEFT JOIN (SELECT data, denominazione_regione, indicatore_stress AS indicatore_stress_t FROM res
           WHERE {_snapshot(CFG.snapshot_lag)}) t
  ON t.denominazione_regione IS NOT DISTINCT FROM t1.denominazione_regione""", "res"),
    }
    return q
