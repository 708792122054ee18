"""DuckDB oracles for the registered queries (see ``__spark_entry__``).

Each entry is plain SQL over the driver's tables, written independently of
the Spark plans: rolling sums are SQL RANGE windows over the rows (no
pre-aggregation), NULL-poisoning sums are ``CASE WHEN count(x) = count(*)``,
scalar lookups are subqueries. Python only assembles repeated fragments
(the fact CTE, the deflator CTEs, the deflation projection) and applies the
same output rounding rule as the Spark side.
"""

from __future__ import annotations

from tradelake.plans.presentation import DIGITS, OFF_TIES, inexact

DEFAULT_PREFIXES = ("qt_stat", "kg_net", "fob_", "freight_", "insurance_", "cif_")
MEASURES = ("qt_stat", "kg_net", "fob_usd", "freight_usd", "insurance_usd", "cif_usd")


# --- fragments ------------------------------------------------------------------

FACTS = """
f0 AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST(month(l.l_shipdate) AS INTEGER) AS month,
         lpad(CAST(l.l_partkey AS VARCHAR), 8, '0') AS ncm,
         CAST(l.l_linenumber AS INTEGER) AS unit_code,
         CAST(s.s_nationkey AS INTEGER) AS country_code,
         'UF' || lpad(CAST(l.l_suppkey % 27 AS VARCHAR), 2, '0') AS state_abb,
         CAST(1 + l.l_orderkey % 9 AS INTEGER) AS transp_mode_code,
         CAST(l.l_suppkey AS INTEGER) AS urf_code,
         CAST(l.l_quantity AS BIGINT) AS qt_stat,
         CAST(l.l_quantity * 10 AS BIGINT) AS kg_net,
         CAST(floor(l.l_extendedprice * 100 + 0.5) AS BIGINT) AS fob_usd,
         CASE WHEN l.l_linestatus = 'F' THEN CAST(floor(l.l_extendedprice * l.l_tax * 100 + 0.5) AS BIGINT) END AS freight_usd,
         CASE WHEN l.l_linestatus = 'F' THEN CAST(floor(l.l_extendedprice * l.l_discount * 100 + 0.5) AS BIGINT) END AS insurance_usd,
         CASE WHEN l.l_linestatus = 'F' THEN 'imp' WHEN l.l_linestatus = 'O' THEN 'exp' END AS direction,
         make_date(CAST(year(l.l_shipdate) AS INTEGER), CAST(month(l.l_shipdate) AS INTEGER), 1) AS date
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
facts AS (SELECT *, fob_usd + freight_usd + insurance_usd AS cif_usd FROM f0)"""

FACT_COLS = ["year", "month", "ncm", "unit_code", "country_code", "state_abb", "transp_mode_code", "urf_code",
             "qt_stat", "kg_net", "fob_usd", "freight_usd", "insurance_usd", "direction", "date", "cif_usd"]

HS4 = """
hs4 AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST(month(l.l_shipdate) AS INTEGER) AS month,
         lpad(CAST(l.l_partkey % 100 AS VARCHAR), 4, '0') AS hs4,
         CAST(s.s_nationkey AS INTEGER) AS country_code,
         CAST(l.l_quantity * 10 AS BIGINT) AS kg_net,
         CAST(floor(l.l_extendedprice * 100 + 0.5) AS BIGINT) AS fob_usd,
         CASE WHEN l.l_linestatus = 'F' THEN 'imp' WHEN l.l_linestatus = 'O' THEN 'exp' END AS direction
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""


def deflator_ctes(na_omit: bool = True, basedate: str | None = None) -> str:
    """CTEs omonths, ipca_src, cpi_src, ipca, fx, cpi, defl, dr (deflators with ratios)."""
    where = "WHERE ipca IS NOT NULL AND ipca_i IS NOT NULL AND brlusd IS NOT NULL AND cpi IS NOT NULL" \
        if na_omit else ""
    if basedate is None:
        cpi_bd = "SELECT max(date) AS bd FROM defl WHERE cpi IS NOT NULL"
        ipca_bd = "SELECT max(date) AS bd FROM defl WHERE ipca_i IS NOT NULL"
    else:
        cpi_bd = ipca_bd = f"SELECT DATE '{basedate}' AS bd"
    return f"""
omonths AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders),
ipca_src AS (SELECT date, CAST((year(date) * 12 + month(date)) % 7 - 1 AS DOUBLE) / 10.0 AS ipca FROM omonths),
cpi_src AS (SELECT date, CAST(100 AS DOUBLE) + CAST(0.25 AS DOUBLE) * (year(date) * 12 + month(date) - 23940) AS cpi
            FROM omonths),
ipca AS (
  SELECT date, ipca,
         CASE WHEN count(ipca) OVER w = count(*) OVER w THEN product(1 + ipca / 100) OVER w END AS ipca_i
  FROM ipca_src WHERE date >= DATE '1997-01-01'
  WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
fx AS (
  SELECT CAST(date_trunc('month', d) AS DATE) AS date,
         CASE WHEN count(bid) = count(*) AND count(ask) = count(*) THEN (avg(bid) + avg(ask)) / 2 END AS brlusd
  FROM (SELECT CAST(o_orderdate AS DATE) AS d, o_totalprice / 1e5 AS bid, o_totalprice / 1e5 * 1.01 AS ask
        FROM orders) q
  WHERE d >= DATE '1997-01-01' AND d <= last_day(current_date - INTERVAL 1 MONTH)
  GROUP BY 1),
cpi AS (SELECT date, cpi FROM cpi_src WHERE date >= DATE '1997-01-01'),
defl0 AS (
  SELECT coalesce(a.date, c.date) AS date, a.ipca, a.ipca_i, a.brlusd, c.cpi
  FROM (SELECT coalesce(i.date, x.date) AS date, i.ipca, i.ipca_i, x.brlusd
        FROM ipca i FULL JOIN fx x ON i.date = x.date) a
  FULL JOIN cpi c ON a.date = c.date),
defl AS (SELECT * FROM defl0 {where}),
cpi_b AS (SELECT b.bd, (SELECT max(cpi) FROM defl WHERE date = b.bd) AS v FROM ({cpi_bd}) b),
ipca_b AS (SELECT b.bd, (SELECT max(ipca_i) FROM defl WHERE date = b.bd) AS v FROM ({ipca_bd}) b),
dr AS (
  SELECT d.date, d.ipca, d.ipca_i, d.brlusd, d.cpi,
         cb.v / nullif(d.cpi, 0) AS cpi_r, cb.bd AS cpi_basedate,
         ib.v / nullif(d.ipca_i, 0) AS ipca_r, ib.bd AS ipca_basedate
  FROM defl d CROSS JOIN cpi_b cb CROSS JOIN ipca_b ib)"""


DEFL_COLS = ["ipca", "ipca_i", "brlusd", "cpi", "cpi_r", "cpi_basedate", "ipca_r", "ipca_basedate"]


def deflate_cte(name: str, src: str, cols: list[str]) -> tuple[str, list[str]]:
    """CTE ``name`` = src left join dr on date, plus generated columns; returns (sql, columns)."""
    usd = [c for c in cols if c.endswith("_usd")]
    brl_new = [c[:-4] + "_brl" for c in usd]
    existing_brl = [c for c in cols if c.endswith("_brl")]
    sel = [f"x.{c}" for c in cols] + [f"dr.{c}" for c in DEFL_COLS]
    sel += [f"x.{c} * dr.cpi_r AS {c}_deflated" for c in usd]
    sel += [f"x.{c} * dr.brlusd AS {n}" for c, n in zip(usd, brl_new)]
    sel += [f"x.{c} * dr.ipca_r AS {c}_deflated" for c in existing_brl]
    sel += [f"(x.{c} * dr.brlusd) * dr.ipca_r AS {n}_deflated" for c, n in zip(usd, brl_new)]
    out = cols + DEFL_COLS + [f"{c}_deflated" for c in usd] + brl_new + \
        [f"{c}_deflated" for c in existing_brl] + [f"{n}_deflated" for n in brl_new]
    sql = f"{name} AS (SELECT {', '.join(sel)} FROM {src} x LEFT JOIN dr ON x.date = dr.date)"
    return sql, out


def match_prefix(cols: list[str], prefixes, exclude=()) -> list[str]:
    prefixes = [prefixes] if isinstance(prefixes, str) else list(prefixes)
    out = []
    for p in prefixes:
        for c in cols:
            if c not in exclude and c.lower().startswith(p.lower()) and c not in out:
                out.append(c)
    return out


def nsum(x: str, cast: str | None = None) -> str:
    e = f"CASE WHEN count({x}) = count(*) THEN sum({x}) END"
    return f"CAST({e} AS {cast})" if cast else e


def sums(cols: list[str], types: dict[str, str] | None = None) -> str:
    types = types or {}
    return ", ".join(f"{nsum(c, types.get(c, 'BIGINT' if c in MEASURES else 'DOUBLE'))} AS {c}" for c in cols)


def roll_sql(cols: list[str], k: int, by: list[str], m: str = "(year(date) * 12 + month(date))") -> str:
    """Rolled columns over RANGE windows on rows (ties share totals), span-complete."""
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    w = f"({part} ORDER BY {m} RANGE BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    complete = f"{m} - {k - 1} >= min({m}) OVER ({part})"
    return ", ".join(
        f"CAST(CASE WHEN {complete} AND count({c}) OVER {w} = count(*) OVER {w} THEN sum({c}) OVER {w} END AS DOUBLE)"
        f" AS {c}_{k}" for c in cols)


def significant(x: str) -> str:
    """``x`` rounded to DIGITS significant digits."""
    return f"CASE WHEN {x} IS NOT NULL THEN CAST(printf('%.{DIGITS - 1}e', ({x}) * CAST({OFF_TIES!r} AS DOUBLE)) AS DOUBLE) + 0.0 END"


def final(src: str, cols: list[str], doubles: set[str]) -> str:
    out = []
    for c in cols:
        out.append(f"{significant(c)} AS {c}" if c in doubles and inexact(c) else c)
    return f"SELECT {', '.join(out)} FROM {src}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(x.strip() for x in ctes if x.strip()) + "\n"


LONG = set(MEASURES)


def _doubles(cols, exact=()):
    """Columns of a deflated / rolled table that are DOUBLE (names only decide)."""
    ints = {"year", "month", "country_code", "unit_code", "transp_mode_code", "urf_code"}
    strs = {"direction", "ncm", "state_abb", "country_name", "name", "code", "arrecadacao_categoria", "mes",
            "partner", "is_partner"}
    dates = {"date", "cpi_basedate", "ipca_basedate"}
    return {c for c in cols if c not in ints | strs | dates | LONG | set(exact)}


# --- queries ----------------------------------------------------------------------

Q: dict[str, str] = {}

SUMS6 = sums(list(MEASURES))

Q["sum_by_direction_year"] = with_(FACTS) + f"SELECT direction, year, {SUMS6} FROM facts GROUP BY direction, year"

Q["sum_na_rm"] = with_(FACTS) + "SELECT year, " + ", ".join(
    f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in MEASURES) + " FROM facts GROUP BY year"

Q["sum_global"] = with_(FACTS) + f"SELECT {SUMS6} FROM facts"

Q["format_ncm"] = with_(FACTS) + (f"SELECT direction, year, {nsum('fob_usd', 'BIGINT')} AS fob_usd FROM facts "
                                  "WHERE year IN (1996, 1997, 1998, 1999) GROUP BY direction, year")

Q["format_hs4"] = with_(HS4) + (f"SELECT direction, year, country_code, {nsum('fob_usd', 'BIGINT')} AS fob_usd "
                                "FROM hs4 GROUP BY direction, year, country_code")


def _top_series(member: str, k: int, source: str) -> str:
    return f"""
series AS (SELECT year, direction, {member}, {nsum('fob_usd', 'BIGINT')} AS fob_usd
           FROM {source} GROUP BY year, direction, {member}),
top AS (SELECT {member} FROM (SELECT {member}, {nsum('fob_usd')} AS t FROM series GROUP BY {member}) q
        ORDER BY t DESC NULLS LAST, {member} ASC NULLS LAST LIMIT {k})"""


Q["top_partners"] = with_(FACTS, """
pb AS (SELECT n.n_nationkey AS country_code,
              CASE WHEN n.n_regionkey = 1 THEN r.r_name WHEN n.n_regionkey = 3 THEN r.r_name ELSE n.n_name END AS partner
       FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
fp AS (SELECT f.*, pb.partner FROM facts f LEFT JOIN pb ON f.country_code = pb.country_code)""",
                          _top_series("partner", 5, "fp")) + \
    "SELECT s.* FROM series s WHERE EXISTS (SELECT 1 FROM top t WHERE t.partner IS NOT DISTINCT FROM s.partner)"

Q["top_partners_recent"] = with_(FACTS, """
pb AS (SELECT n.n_nationkey AS country_code,
              CASE WHEN n.n_regionkey = 1 THEN r.r_name WHEN n.n_regionkey = 3 THEN r.r_name ELSE n.n_name END AS partner
       FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
fp AS (SELECT f.*, pb.partner FROM facts f LEFT JOIN pb ON f.country_code = pb.country_code
       WHERE f.year BETWEEN 1998 AND 2001)""", _top_series("partner", 5, "fp")) + \
    "SELECT s.* FROM series s WHERE EXISTS (SELECT 1 FROM top t WHERE t.partner IS NOT DISTINCT FROM s.partner)"

Q["top_states"] = with_(FACTS, _top_series("state_abb", 3, "facts")) + \
    "SELECT s.* FROM series s WHERE EXISTS (SELECT 1 FROM top t WHERE t.state_abb IS NOT DISTINCT FROM s.state_abb)"


# R3
def _partner_real_rolling() -> str:
    base_cols = ["direction", "date", "country_code"] + list(MEASURES)
    s = f"s AS (SELECT direction, date, country_code, {SUMS6} FROM facts WHERE country_code IN (7, 14, 21) " \
        "GROUP BY direction, date, country_code)"
    dcte, dcols = deflate_cte("d", "s", base_cols)
    j = "j AS (SELECT d.*, n.n_name AS country_name FROM d LEFT JOIN nation n ON d.country_code = n.n_nationkey " \
        "WHERE d.fob_usd IS NOT NULL)"
    cols = dcols + ["country_name"]
    r = f"r AS (SELECT *, {roll_sql(['fob_usd_deflated'], 12, ['direction', 'country_name'])} FROM j)"
    out = cols + ["fob_usd_deflated_12"]
    return with_(FACTS, deflator_ctes(), s, dcte, j, r) + final("r", out, _doubles(out))


Q["partner_real_rolling"] = _partner_real_rolling()

Q["roll12_by_direction"] = with_(FACTS, f"s AS (SELECT direction, date, {SUMS6} FROM facts GROUP BY direction, date)") + \
    f"SELECT *, {roll_sql(list(MEASURES), 12, ['direction'])} FROM s"

Q["roll3_with_ties"] = with_(FACTS) + (
    "SELECT year, month, ncm, country_code, direction, date, qt_stat, fob_usd, freight_usd, "
    f"{roll_sql(['qt_stat', 'fob_usd', 'freight_usd'], 3, ['direction'])} FROM facts")

GDP = """
gdp AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
               CAST(sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS BIGINT) / 1e6 AS pib_brl_milhoes
        FROM orders GROUP BY 1),
pib AS (SELECT date, pib_brl_milhoes * 1e6 AS pib_brl FROM gdp),
pib12 AS (SELECT date, pib_brl,
                 CASE WHEN count(*) OVER w = 12 AND count(pib_brl) OVER w = 12 THEN sum(pib_brl) OVER w END AS pib_annual_brl
          FROM pib WINDOW w AS (ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))"""

Q["roll_rows12"] = with_(GDP) + final("pib12", ["date", "pib_brl", "pib_annual_brl"], {"pib_brl", "pib_annual_brl"})

Q["deflators"] = with_(deflator_ctes(na_omit=False)) + final(
    "defl", ["date", "ipca", "ipca_i", "brlusd", "cpi"], {"ipca", "ipca_i", "brlusd", "cpi"})

Q["price_index"] = with_(deflator_ctes(), """
pi AS (SELECT date, ipca,
              CASE WHEN count(ipca) OVER w = count(*) OVER w THEN product(1 + ipca / 100) OVER w END AS ipca_i
       FROM ipca_src WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""") + \
    final("pi", ["date", "ipca", "ipca_i"], {"ipca", "ipca_i"})


def _monthly_ctes() -> tuple[list[str], list[str]]:
    """CTEs up to ``monthly`` (R10) and its columns."""
    s = f"ms AS (SELECT year, date, {SUMS6} FROM facts GROUP BY year, date)"
    dcte, cols = deflate_cte("monthly", "ms", ["year", "date"] + list(MEASURES))
    return [FACTS, deflator_ctes(), s, dcte], cols


def _q_deflated_monthly():
    ctes, cols = _monthly_ctes()
    return with_(*ctes) + final("monthly", cols, _doubles(cols))


Q["deflated_monthly"] = _q_deflated_monthly()


def _q_deflate_basedate():
    s = f"s AS (SELECT direction, date, {SUMS6} FROM facts GROUP BY direction, date)"
    dcte, cols = deflate_cte("d", "s", ["direction", "date"] + list(MEASURES))
    return with_(FACTS, deflator_ctes(basedate="1999-12-01"), s, dcte) + final("d", cols, _doubles(cols))


Q["deflate_basedate"] = _q_deflate_basedate()

BAL_PREFIXES = ("fob_brl", "fob_usd", "fob_usd_deflated", "fob_brl_deflated", "cif_usd_deflated", "cif_brl_deflated")


def _balance_ctes() -> tuple[list[str], list[str]]:
    s = f"s AS (SELECT direction, date, {SUMS6} FROM facts GROUP BY direction, date)"
    dcte, cols = deflate_cte("d", "s", ["direction", "date"] + list(MEASURES))
    rc = match_prefix(cols, BAL_PREFIXES, exclude=("direction", "date"))
    b = f"bal AS (SELECT *, {roll_sql(rc, 12, ['direction'])} FROM d)"
    return [FACTS, deflator_ctes(), s, dcte, b], cols + [f"{c}_12" for c in rc]


def _q_trade_by_direction():
    ctes, cols = _balance_ctes()
    return with_(*ctes) + final("bal", cols, _doubles(cols))


Q["trade_by_direction"] = _q_trade_by_direction()


def _q_balance(value: str, name: str, na_omit: bool) -> str:
    ctes, _ = _balance_ctes()
    b = (f"b AS (SELECT date, max(CASE WHEN direction = 'exp' THEN {value} END) / 1e9 "
         f"- max(CASE WHEN direction = 'imp' THEN {value} END) / 1e9 AS {name} FROM bal GROUP BY date)")
    where = f" WHERE {name} IS NOT NULL" if na_omit else ""
    return with_(*ctes, b) + final("b", ["date", name], {name}) + where


Q["balance_usd"] = _q_balance("fob_usd_deflated_12", "balance_usd_deflated_12", False)
Q["balance_brl"] = _q_balance("fob_brl_deflated_12", "balance_brl_deflated_12", True)


def _q_peak_month():
    ctes, cols = _balance_ctes()
    p = ("pk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY direction "
         "ORDER BY fob_usd_deflated DESC NULLS LAST, date ASC) AS rn FROM bal) q WHERE rn = 1)")
    return with_(*ctes, p) + final("pk", cols, _doubles(cols))


Q["peak_month"] = _q_peak_month()


def _q_same_month():
    ctes, cols = _balance_ctes()
    p = "sm AS (SELECT * FROM bal WHERE month(date) = (SELECT month(max(date)) FROM bal))"
    return with_(*ctes, p) + final("sm", cols, _doubles(cols))


Q["same_month"] = _q_same_month()


def _yearly_ctes():
    ctes, mcols = _monthly_ctes()
    yc = match_prefix(mcols, DEFAULT_PREFIXES, exclude=("year",))
    y = (f"yearly AS (SELECT year, {sums(yc)} FROM monthly GROUP BY year "
         "HAVING max(month(date)) = 12)")
    return ctes + [y], ["year"] + yc


def _q_yearly_complete():
    ctes, cols = _yearly_ctes()
    return with_(*ctes) + final("yearly", cols, _doubles(cols))


Q["yearly_complete"] = _q_yearly_complete()


def _rolling_totals_ctes():
    ctes, mcols = _monthly_ctes()
    rc = match_prefix(mcols, DEFAULT_PREFIXES, exclude=("date",))
    r = f"rt AS (SELECT *, {roll_sql(rc, 12, [])} FROM monthly)"
    return ctes + [r], mcols + [f"{c}_12" for c in rc]


def _q_rolling_real_vs_nominal():
    ctes, cols = _rolling_totals_ctes()
    return with_(*ctes) + final("rt", cols, _doubles(cols))


Q["rolling_real_vs_nominal"] = _q_rolling_real_vs_nominal()


def _q_max_real_date():
    ctes, _ = _rolling_totals_ctes()
    return with_(*ctes) + "SELECT date FROM rt ORDER BY fob_usd_deflated_12 DESC NULLS LAST, date ASC LIMIT 1"


Q["max_real_date"] = _q_max_real_date()


def _q_yearly_growth_long():
    ctes, _ = _yearly_ctes()
    g = ("g AS (SELECT year, "
         "(fob_brl_deflated / nullif(lag(fob_brl_deflated) OVER (ORDER BY year), 0) - 1) * 100 AS brl, "
         "(fob_usd_deflated / nullif(lag(fob_usd_deflated) OVER (ORDER BY year), 0) - 1) * 100 AS usd FROM yearly)")
    lg = ("lg AS (SELECT year, 'BRL' AS name, brl AS value FROM g UNION ALL "
          "SELECT year, 'USD' AS name, usd AS value FROM g)")
    return with_(*ctes, g, lg) + final("lg", ["year", "name", "value"], {"value"})


Q["yearly_growth_long"] = _q_yearly_growth_long()

PRODUCTS = """
p_ncm AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS co_ncm, CAST(p_size % 10 AS VARCHAR) AS co_unid,
                 upper(substr(p_type, 1, 3)) AS co_cgce_n3, p_name AS no_ncm_ing FROM part),
p_cgce AS (SELECT upper(substr(p_type, 1, 3)) AS co_cgce_n3, min(p_type) AS no_cgce_n3_ing FROM part GROUP BY 1),
p_unid AS (SELECT CAST(p_size % 10 AS VARCHAR) AS co_unid, 'UNIT ' || CAST(min(p_size % 10) AS VARCHAR) AS no_unid
           FROM part GROUP BY 1),
products AS (SELECT a.co_ncm, a.co_unid, a.co_cgce_n3, a.no_ncm_ing, b.no_cgce_n3_ing, c.no_unid
             FROM p_ncm a LEFT JOIN p_cgce b ON a.co_cgce_n3 = b.co_cgce_n3
             LEFT JOIN p_unid c ON a.co_unid = c.co_unid)"""

Q["lookup_merge"] = with_(PRODUCTS) + "SELECT * FROM products"
Q["lookup_merge_null_key"] = with_(PRODUCTS) + """
SELECT a.co_ncm, a.co_unid, nullif(a.co_cgce_n3, 'LAR') AS co_cgce_n3, a.no_ncm_ing, b.no_cgce_n3_ing, c.no_unid
FROM p_ncm a LEFT JOIN p_cgce b ON nullif(a.co_cgce_n3, 'LAR') IS NOT DISTINCT FROM nullif(b.co_cgce_n3, 'LAR')
LEFT JOIN p_unid c ON a.co_unid = c.co_unid"""


def _q_category_change(products: str = "products", since: str = "DATE '1998-01-01'"):
    f = ("cf AS (SELECT f.*, p.no_cgce_n3_ing AS name, p.co_cgce_n3 AS code FROM facts f "
         f"LEFT JOIN {products} p ON f.ncm = p.co_ncm WHERE f.date >= {since} AND f.country_code = 9)")
    s = f"cs AS (SELECT name, code, direction, date, {SUMS6} FROM cf GROUP BY name, code, direction, date)"
    dcte, cols = deflate_cte("cd0", "cs", ["name", "code", "direction", "date"] + list(MEASURES))
    d = "cd AS (SELECT * FROM cd0 WHERE fob_brl_deflated IS NOT NULL AND direction = 'imp')"
    r = f"cr AS (SELECT *, {roll_sql(['fob_usd_deflated'], 12, ['name', 'code', 'direction'])} FROM cd)"
    sm = ("c1 AS (SELECT name, code, direction, fob_usd_deflated_12 AS v, year(date) AS y FROM cr "
          "WHERE month(date) = (SELECT month(max(date)) FROM cr)), "
          "c2 AS (SELECT *, CASE WHEN y = (SELECT max(y) FROM c1) THEN 'current' ELSE 'last' END AS lbl FROM c1 "
          "WHERE y >= (SELECT max(y) FROM c1) - 1)")
    w = ("w0 AS (SELECT name, code, direction, coalesce(max(CASE WHEN lbl = 'last' THEN v END), 0) AS last, "
         "coalesce(max(CASE WHEN lbl = 'current' THEN v END), 0) AS current FROM c2 GROUP BY name, code, direction), "
         "w AS (SELECT name, code, direction, last, current, current - last AS d, last + current AS s, "
         "current / nullif(last, 0) AS p FROM w0)")
    t = ("tk AS (SELECT code, sum(abs(current - last)) AS total FROM w GROUP BY code "
         "ORDER BY total DESC NULLS LAST, code ASC NULLS LAST LIMIT 10), "
         "res AS (SELECT tk.code, tk.total, w.name, w.direction, w.last, w.current, w.d, w.s, w.p "
         "FROM tk JOIN w ON tk.code IS NOT DISTINCT FROM w.code)")
    out = ["code", "total", "name", "direction", "last", "current", "d", "s", "p"]
    return with_(FACTS, deflator_ctes(), PRODUCTS, f, s, dcte, d, r, sm, w, t) + \
        final("res", out, {"total", "last", "current", "d", "s", "p"})


Q["category_change_top10"] = _q_category_change()
Q["category_change_unclassified"] = _q_category_change("(SELECT * FROM products WHERE co_cgce_n3 <> 'LAR')")


def _pvr_ctes(real: bool):
    f = ("pf AS (SELECT f.*, f.country_code = 9 AS is_partner FROM facts f LEFT JOIN products p "
         "ON f.ncm = p.co_ncm WHERE p.co_cgce_n3 = 'LAR')")
    s = f"ps AS (SELECT direction, date, is_partner, {SUMS6} FROM pf GROUP BY direction, date, is_partner)"
    cols = ["direction", "date", "is_partner"] + list(MEASURES)
    ctes = [FACTS, PRODUCTS, f, s]
    src = "ps"
    if real:
        ctes.insert(1, deflator_ctes())
        dcte, cols = deflate_cte("pd", "ps", cols)
        ctes.append(dcte)
        src = "pd"
    rc = match_prefix(cols, DEFAULT_PREFIXES, exclude=("direction", "date", "is_partner"))
    r = f"pr AS (SELECT *, {roll_sql(rc, 12, ['direction', 'is_partner'])} FROM {src})"
    return ctes + [r], cols + [f"{c}_12" for c in rc]


def _q_pvr(real: bool):
    ctes, cols = _pvr_ctes(real)
    return with_(*ctes) + final("pr", cols, _doubles(cols))


Q["partner_vs_rest"] = _q_pvr(False)
Q["partner_vs_rest_real"] = _q_pvr(True)

Q["freight_share_year"] = with_(FACTS) + (
    f"SELECT year, direction, fob_usd, freight_usd, {significant('freight_usd / nullif(fob_usd, 0)')} AS p FROM ("
    f"SELECT year, direction, {nsum('fob_usd', 'BIGINT')} AS fob_usd, {nsum('freight_usd', 'BIGINT')} AS freight_usd "
    "FROM facts GROUP BY year, direction) q")

Q["freight_share_country"] = with_(FACTS) + (
    f"SELECT country_code, fob_usd, freight_usd, {significant('freight_usd / nullif(fob_usd, 0)')} AS p FROM ("
    f"SELECT country_code, CAST(coalesce(sum(fob_usd), 0) AS BIGINT) AS fob_usd, "
    f"{nsum('freight_usd', 'BIGINT')} AS freight_usd FROM facts GROUP BY country_code) q")

Q["code_clean"] = """
SELECT p_partkey, raw_code,
       nullif(regexp_replace(raw_code, '[^0-9]', '', 'g'), '') AS ncm,
       nullif(regexp_replace(p_brand, '[^0-9]', '', 'g'), '') AS brand_digits,
       nullif(regexp_replace(p_name, '[^0-9]', '', 'g'), '') AS name_digits
FROM (SELECT *, printf('%04d.%04d', CAST(p_partkey // 10000 AS INTEGER), CAST(p_partkey % 10000 AS INTEGER)) AS raw_code
      FROM part) q"""

CONTROL = """
per_year AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_linestatus,
         sum(CAST(l_quantity AS BIGINT)) AS q, sum(CAST(l_quantity * 10 AS BIGINT)) AS kg,
         sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS fob,
         sum(CAST(floor(l_extendedprice * l_tax * 100 + 0.5) AS BIGINT)) AS fr,
         sum(CAST(floor(l_extendedprice * l_discount * 100 + 0.5) AS BIGINT)) AS ins, count(*) AS n
  FROM lineitem GROUP BY 1, 2),
control AS (
  SELECT CASE WHEN l_linestatus = 'F' THEN 'IMP_' ELSE 'EXP_' END || CAST(year AS VARCHAR) || '.csv' AS file,
         year, CAST(q AS BIGINT) AS qt_stat, CAST(kg AS BIGINT) AS kg_net, CAST(fob AS BIGINT) AS fob_usd,
         CASE WHEN l_linestatus = 'F' THEN CAST(fr AS BIGINT) END AS freight_usd,
         CASE WHEN l_linestatus = 'F' THEN CAST(ins AS BIGINT) END AS insurance_usd,
         CAST(n AS BIGINT) AS number_of_lines
  FROM per_year)"""

CHECK = ("qt_stat", "kg_net", "fob_usd", "freight_usd", "insurance_usd", "number_of_lines")


def _reconcile(control_expr: str, check=CHECK, source: str = "facts", ctes=(FACTS, CONTROL)) -> str:
    CHECK = check
    totals = ("totals AS (SELECT year, direction, " + ", ".join(
        f"CAST({nsum(c)} AS BIGINT) AS a_{c}" for c in CHECK[:-1]) +
        f", count(*) AS a_number_of_lines FROM {source} GROUP BY year, direction)")
    ctrl = (f"ctrl AS (SELECT file, CAST(year AS INTEGER) AS year, "
            f"CASE WHEN file LIKE '%IMP%' THEN 'imp' ELSE 'exp' END AS direction, {', '.join(CHECK)} FROM ({control_expr}) c)")
    same = " AND ".join(f"c.{m} IS NOT DISTINCT FROM t.a_{m}" for m in CHECK)
    j = (f"j AS (SELECT c.*, t.year IS NOT NULL AS present, {', '.join('t.a_' + m for m in CHECK)}, "
         f"CASE WHEN t.year IS NULL THEN 'uncovered' WHEN {same} THEN 'ok' ELSE 'mismatch' END AS status "
         "FROM ctrl c LEFT JOIN totals t ON c.year = t.year AND c.direction = t.direction)")
    body = " UNION ALL ".join(
        f"SELECT year, direction, file, status, '{m}' AS measure, {m} AS expected, a_{m} AS actual FROM j"
        for m in CHECK)
    return with_(*ctes, totals, ctrl, j) + body


Q["reconcile_ok"] = _reconcile("SELECT * FROM control")
Q["reconcile_mismatch"] = _reconcile(
    "SELECT file, year, qt_stat, kg_net, CASE WHEN year = 1998 AND file LIKE '%IMP%' THEN fob_usd + 1 ELSE fob_usd END "
    "AS fob_usd, freight_usd, insurance_usd, number_of_lines FROM control")
Q["uncovered_control"] = _reconcile(
    "SELECT * FROM control UNION ALL SELECT regexp_replace(file, '[0-9]{4}', "
    "CAST(CAST(year + 10 AS INTEGER) AS VARCHAR)) AS file, year + 10 AS year, qt_stat, kg_net, fob_usd, freight_usd, "
    "insurance_usd, number_of_lines FROM control WHERE year = (SELECT max(year) FROM control)")

Q["missing_partitions"] = with_(FACTS, HS4, """
grid AS (SELECT CAST(r.range AS INTEGER) AS year, d.direction, t.type
         FROM range(1993, 2004) r, (VALUES ('imp'), ('exp')) d(direction), (VALUES ('ncm'), ('hs4')) t(type)),
present AS (SELECT DISTINCT year, direction, 'ncm' AS type FROM facts
            UNION SELECT DISTINCT year, direction, 'hs4' AS type FROM hs4)""") + (
    "SELECT g.year, g.direction, g.type, 'missing' AS status FROM grid g WHERE NOT EXISTS ("
    "SELECT 1 FROM present p WHERE p.year = g.year AND p.direction = g.direction AND p.type = g.type)")

Q["union_missing_columns"] = with_(FACTS) + (
    "SELECT year, month, ncm, country_code, qt_stat, fob_usd, freight_usd, insurance_usd, "
    "CASE WHEN freight_usd IS NULL THEN 'exp' ELSE 'imp' END AS direction, make_date(year, month, 1) AS date, "
    "fob_usd + freight_usd + insurance_usd AS cif_usd FROM ("
    "SELECT year, month, ncm, country_code, qt_stat, fob_usd, freight_usd, insurance_usd FROM facts WHERE direction = 'imp' "
    "UNION ALL SELECT year, month, ncm, country_code, qt_stat, fob_usd, NULL, NULL FROM facts WHERE direction = 'exp') u")


def sheet_ctes(name: str, scale: float) -> str:
    unit = 1e8 / scale
    return f"""
{name}_m AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS mo,
         sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0 ELSE CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) END) AS a,
         sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) ELSE 0 END) AS b
  FROM orders GROUP BY 1, 2),
{name}_rows AS (SELECT y, mo, a, b FROM {name}_m UNION ALL SELECT y, 13 AS mo, sum(a), sum(b) FROM {name}_m GROUP BY y),
{name}_sheet AS (
  SELECT ['JAN', 'FEV', 'MAR', 'ABR', 'MAIO', 'JUN', 'JUL', 'AGO', 'SET', 'OUT', 'NOV', 'DEZ', 'TOTAL'][mo] AS mes,
         CAST(a AS DOUBLE) / {unit!r} AS i_renda, CAST(b AS DOUBLE) / {unit!r} AS i_importacao_e_ipi_vinculado,
         CAST(a + b AS DOUBLE) / {unit!r} AS total_geral,
         CAST((y - (SELECT min(year(o_orderdate)) FROM orders)) * 13 + mo AS INTEGER) AS line
  FROM {name}_rows),
{name}_w AS (
  SELECT mes, i_renda, i_importacao_e_ipi_vinculado, total_geral, line,
         CAST(floor((line - 1) / 13) + (SELECT min(year(o_orderdate)) FROM orders) AS INTEGER) AS ano,
         CAST(list_position(['JAN', 'FEV', 'MAR', 'ABR', 'MAIO', 'JUN', 'JUL', 'AGO', 'SET', 'OUT', 'NOV', 'DEZ'], mes)
              AS INTEGER) AS mes_codigo
  FROM {name}_sheet),
{name}_long AS (
  SELECT mes, line, ano, mes_codigo, make_date(ano, mes_codigo, 1) AS date, arrecadacao_categoria,
         imposto_brl_milhoes * 1e6 AS imposto_brl
  FROM (SELECT * FROM {name}_w WHERE mes_codigo > 0)
  UNPIVOT (imposto_brl_milhoes FOR arrecadacao_categoria IN (i_renda, i_importacao_e_ipi_vinculado, total_geral)))"""


Q["fiscal_long"] = with_(sheet_ctes("tax", 1.0)) + final(
    "tax_long", ["mes", "line", "ano", "mes_codigo", "date", "arrecadacao_categoria", "imposto_brl"], {"imposto_brl"})


def _q_effective_rate():
    cat = "'i_importacao_e_ipi_vinculado'"
    t = f"t AS (SELECT date, arrecadacao_categoria, imposto_brl AS imposto_nominal_brl FROM tax_long WHERE arrecadacao_categoria = {cat})"
    tr = f"tr AS (SELECT date, imposto_brl AS imposto_rfb_brl FROM taxr_long WHERE arrecadacao_categoria = {cat})"
    im = f"im AS (SELECT date, {SUMS6} FROM facts WHERE direction = 'imp' GROUP BY date)"
    j = ("jj AS (SELECT t.date, t.arrecadacao_categoria, t.imposto_nominal_brl, tr.imposto_rfb_brl, "
         + ", ".join(f"im.{c}" for c in MEASURES) +
         " FROM t LEFT JOIN tr ON t.date = tr.date LEFT JOIN im ON t.date = im.date)")
    jcols = ["date", "arrecadacao_categoria", "imposto_nominal_brl", "imposto_rfb_brl"] + list(MEASURES)
    dcte, dcols = deflate_cte("dd", "jj", jcols)
    ren = ", ".join(("imposto_nominal_brl AS imposto_brl" if c == "imposto_nominal_brl" else c) for c in dcols)
    dcols = ["imposto_brl" if c == "imposto_nominal_brl" else c for c in dcols]
    d2 = f"d2 AS (SELECT {ren} FROM dd)"
    rc = match_prefix(dcols, list(DEFAULT_PREFIXES) + ["imposto_"], exclude=("date",))
    r = f"rr AS (SELECT *, {roll_sql(rc, 12, [])} FROM d2)"
    e = ("er AS (SELECT rr.*, imposto_brl / nullif(cif_brl, 0) AS ii_prop, imposto_brl_12 / nullif(cif_brl_12, 0) AS ii_prop_12, "
         "pib12.pib_annual_brl, cif_brl_12 / nullif(pib12.pib_annual_brl, 0) AS imp_pct_pib_12, "
         "imposto_brl_12 / nullif(pib12.pib_annual_brl, 0) AS ii_ipi_pct_pib_12 "
         "FROM rr LEFT JOIN pib12 ON rr.date = pib12.date)")
    cols = dcols + [f"{c}_12" for c in rc] + ["ii_prop", "ii_prop_12", "pib_annual_brl", "imp_pct_pib_12",
                                             "ii_ipi_pct_pib_12"]
    return with_(FACTS, deflator_ctes(), sheet_ctes("tax", 1.0), sheet_ctes("taxr", 1.25), GDP, t, tr, im, j, dcte,
                 d2, r, e) + final("er", cols, _doubles(cols))


Q["effective_rate"] = _q_effective_rate()

def _q_gdp_shares_long():
    q = Q["effective_rate"]
    body = ("SELECT date, 'Importações CIF' AS serie, " + significant("imp_pct_pib_12") + " AS pct_pib FROM er "
            "WHERE imp_pct_pib_12 IS NOT NULL UNION ALL "
            "SELECT date, 'II + IPI vinculado' AS serie, " + significant("ii_ipi_pct_pib_12") + " AS pct_pib FROM er "
            "WHERE imp_pct_pib_12 IS NOT NULL")
    return q[: q.rindex("SELECT ")] + body


Q["gdp_shares_long"] = _q_gdp_shares_long()


def _q_peak_month_brl():
    ctes, cols = _balance_ctes()
    p = ("pk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY direction "
         "ORDER BY fob_brl_deflated DESC NULLS LAST, date ASC) AS rn FROM bal) q WHERE rn = 1)")
    return with_(*ctes, p) + final("pk", cols, _doubles(cols))


Q["peak_month_brl"] = _q_peak_month_brl()

Q["deflator_report"] = with_(deflator_ctes(na_omit=False), """
pd AS (SELECT date, count(*) AS k,
              max(CASE WHEN date IS NULL OR ipca IS NULL OR ipca_i IS NULL OR brlusd IS NULL OR cpi IS NULL
                  THEN 1 ELSE 0 END) AS z
       FROM defl0 GROUP BY date)""") + (
    "SELECT CAST(sum(k) AS BIGINT) AS n_rows, CAST(sum(z) AS BIGINT) AS months_with_null, "
    "count(CASE WHEN k > 1 THEN 1 END) AS duplicated_dates FROM pd")


def _q_month_labels():
    ctes, _ = _pvr_ctes(False)
    return with_(*ctes) + ("SELECT strftime(max(date), '%m/%Y') AS label_mm_yyyy, "
                           "substr(CAST(max(date) AS VARCHAR), 1, 7) AS label_yyyy_mm FROM pr")


Q["month_labels"] = _q_month_labels()

CONTROL_MUN = """
mun_year AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_linestatus, sum(CAST(l_quantity * 10 AS BIGINT)) AS kg,
         sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS fob, count(*) AS n
  FROM lineitem GROUP BY 1, 2),
control_mun AS (
  SELECT CASE WHEN l_linestatus = 'F' THEN 'IMP_' ELSE 'EXP_' END || CAST(year AS VARCHAR) || '_MUN.csv' AS file,
         year, CAST(kg AS BIGINT) AS kg_net, CAST(fob AS BIGINT) AS fob_usd,
         CAST(n AS BIGINT) AS number_of_lines
  FROM mun_year)"""

Q["reconcile_hs4"] = _reconcile("SELECT * FROM control_mun", check=("kg_net", "fob_usd", "number_of_lines"),
                                source="hs4", ctes=(HS4, CONTROL_MUN))

Q["hs4_csv_roundtrip"] = Q["format_hs4"]
Q["lookup_csv_roundtrip"] = ("SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS co_ncm, "
                             "CAST(p_size % 10 AS VARCHAR) AS co_unid, p_name AS no_ncm_ing FROM part")
Q["control_csv_reconcile"] = Q["reconcile_ok"]
Q["control_csv_reconcile_mun"] = Q["reconcile_hs4"]
Q["reconcile_large"] = with_(FACTS, CONTROL, """
t AS (SELECT year, direction, CAST(sum(fob_usd) AS BIGINT) + 1152921504606846976 AS a FROM facts GROUP BY year, direction),
c AS (SELECT file, year, CASE WHEN file LIKE '%IMP%' THEN 'imp' ELSE 'exp' END AS direction,
             fob_usd + 1152921504606846976 + CASE WHEN year = 1998 THEN 1 ELSE 0 END AS e FROM control)""") + """
SELECT c.year, c.direction, c.file, CASE WHEN t.year IS NULL THEN 'uncovered' WHEN e = a THEN 'ok' ELSE 'mismatch' END AS status,
       'fob_usd' AS measure, e AS expected, a AS actual
FROM c LEFT JOIN t ON c.year = t.year AND c.direction = t.direction"""
Q["deflators_from_files"] = Q["deflators"]
Q["fiscal_from_sheet"] = Q["fiscal_long"]
Q["partition_replace"] = with_(FACTS) + (
    "SELECT direction, year, CAST(sum(CASE WHEN year = 1997 THEN 2 ELSE 1 END * fob_usd) AS BIGINT) AS fob_usd "
    "FROM facts GROUP BY direction, year")
Q["sorted_monthly"] = with_(FACTS) + (
    f"SELECT direction, date, {nsum('fob_usd', 'BIGINT')} AS fob_usd, "
    "CAST(row_number() OVER (ORDER BY date NULLS LAST, direction NULLS LAST) AS INTEGER) AS position "
    "FROM facts GROUP BY direction, date")
Q["partner_code_labels"] = ("SELECT CAST(n_nationkey AS INTEGER) AS country_code, "
                            "CAST(n_nationkey AS VARCHAR) || ': ' || n_name AS label FROM nation")
Q["ingest_bad_file_report"] = with_(FACTS) + """
SELECT direction, year, upper(direction) || '_' || CAST(year AS VARCHAR) || '.csv' AS file, count(*) AS rows,
       count(CASE WHEN year = 1997 AND qt_stat = 10 THEN 1 END) AS bad_rows,
       CAST(count(CASE WHEN year = 1997 AND qt_stat = 10 THEN 1 END) AS BIGINT) AS null_cells FROM facts GROUP BY direction, year"""
Q["ingest_missing_files"] = with_(FACTS) + """
SELECT CAST(r.range AS INTEGER) AS year, d.direction, 'ncm' AS type, 'missing' AS status
FROM range(1993, 2004) r, (VALUES ('imp'), ('exp')) d(direction)
WHERE NOT EXISTS (SELECT 1 FROM facts f WHERE f.year = r.range AND f.direction = d.direction AND f.direction = 'imp')"""
Q["covered_partitions"] = Q["missing_partitions"].replace("'missing'", "'landed'").replace("NOT EXISTS", "EXISTS")
Q["ingest_job"] = Q["sum_by_direction_year"]
Q["file_quality"] = ("SELECT CASE WHEN l_linestatus = 'F' THEN 'imp' ELSE 'exp' END AS direction, "
                     "CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS rows, CAST(0 AS BIGINT) AS bad_rows, CAST(0 AS BIGINT) AS null_cells "
                     "FROM lineitem GROUP BY 1, 2")
Q["hs4_lake_roundtrip"] = Q["format_hs4"]
Q["lake_roundtrip"] = Q["sum_by_direction_year"]
Q["csv_ingest_roundtrip"] = Q["sum_by_direction_year"]

Q["publish_half_failed"] = Q["sum_by_direction_year"]
Q["publish_one_partition"] = with_(FACTS) + """
SELECT direction, year, CAST(sum(fob_usd) AS BIGINT) AS fob_usd, 'first' AS manifest FROM facts GROUP BY direction, year
UNION ALL
SELECT direction, year, CAST(sum(CASE WHEN year = 1997 AND direction = 'imp' THEN 2 ELSE 1 END * fob_usd) AS BIGINT) AS fob_usd,
       'newest' AS manifest FROM facts GROUP BY direction, year"""
Q["publish_conflict"] = with_(FACTS) + """
SELECT direction, year, CAST(sum(CASE year WHEN 1997 THEN 2 WHEN 1998 THEN 3 ELSE 1 END * fob_usd) AS BIGINT) AS fob_usd
FROM facts GROUP BY direction, year"""
Q["ingest_mixed_kinds"] = with_(FACTS, HS4) + """
SELECT direction, year, CAST(sum(kg_net) AS BIGINT) AS kg_net, CAST(sum(fob_usd) AS BIGINT) AS fob_usd, 'ncm' AS kind
FROM facts GROUP BY direction, year
UNION ALL
SELECT direction, year, CAST(sum(kg_net) AS BIGINT) AS kg_net, CAST(sum(fob_usd) AS BIGINT) AS fob_usd, 'hs4' AS kind
FROM hs4 GROUP BY direction, year"""
Q["landing_manifest"] = with_(HS4) + """
SELECT DISTINCT 'hs4' AS kind, direction, year, upper(direction) || '_' || CAST(year AS VARCHAR) || '_MUN.csv' AS file
FROM hs4 WHERE year < 1998"""


def _with_refused(files: str) -> str:
    return f"SELECT q.*, '{files}' AS refused FROM ({Q['sum_by_direction_year']}) q"


Q["ingest_stray_year"] = _with_refused("EXP_1998.csv,IMP_1998.csv")
Q["ingest_swapped_header"] = _with_refused("IMP_1999.csv")
Q["states_after_replace"] = with_(FACTS) + (
    "SELECT year, date, " + ", ".join(
        ("CAST(sum(CASE WHEN year = 1997 THEN 2 ELSE 1 END * fob_usd) AS BIGINT) AS fob_usd" if m == "fob_usd"
         else f"{nsum(m, 'BIGINT')} AS {m}") for m in MEASURES) +
    ", 'exp/1997,imp/1997' AS refreshed FROM facts GROUP BY year, date")
Q["yearly_growth_from_states"] = Q["yearly_growth_long"]
Q["country_scan_clustered"] = with_(FACTS) + (
    "SELECT country_code, direction, year, CAST(sum(fob_usd) AS BIGINT) AS fob_usd FROM facts "
    "WHERE country_code IN (7, 14, 21) GROUP BY country_code, direction, year")
Q["partner_vs_rest_colocated"] = Q["partner_vs_rest"]
Q["deflators_persisted"] = Q["deflate_basedate"]
Q["category_change_latest"] = _q_category_change(since="make_date((SELECT max(year) FROM facts) - 2, 1, 1)")
Q["fiscal_from_raw_sheet"] = Q["fiscal_long"]
Q["quotes_until_last_month"] = (
    "SELECT date, " + significant("brlusd") + " AS brlusd FROM ("
    "SELECT CAST(date_trunc('month', d) AS DATE) AS date, (avg(bid) + avg(ask)) / 2 AS brlusd FROM ("
    "SELECT CAST(o_orderdate AS DATE) + CAST(datediff('day', (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), current_date) "
    "AS INTEGER) + 45 AS d, o_totalprice / 1e5 AS bid, o_totalprice / 1e5 * 1.01 AS ask FROM orders) q "
    "WHERE d >= DATE '1997-01-01' AND d < date_trunc('month', current_date) GROUP BY 1) r")

ORACLE_SQL = Q
