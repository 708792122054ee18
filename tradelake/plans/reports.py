"""Report queries composed from the operators.

Each function takes DataFrames (facts, lookups, deflators) and parameters and
returns a lazy DataFrame; building one starts no job. Grouping is always explicit. Facts are scanned once
per report where the reference scans twice: series and rankings are derived
from one aggregate, which Spark reuses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tradelake.functions.nulls import nsum, ratio
from tradelake.operators.aggregate import share_of_sums, sum_prefixed
from tradelake.operators.deflate import deflate
from tradelake.operators.lookups import partner_labels
from tradelake.operators.ranking import first_per_group, top_k
from tradelake.operators.reshape import longer, wider
from tradelake.operators.rolling import roll_months, roll_rows
from tradelake.schemas import DEFAULT_PREFIXES, MONTH_LABELS


def _null_safe_filter(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is among the (few, unique) ``keys``; NULL matches NULL.

    An inner join with the broadcast key list, not a semi join: the optimizer
    pushes semi joins below aggregates, which would split the shared series
    aggregate into two scans of the facts.
    """
    k = keys.select(F.col(on).alias("__key"))
    return df.join(F.broadcast(k), df[on].eqNullSafe(k["__key"]), "inner").drop("__key")


def top_members_series(df: DataFrame, member: str, series_keys: Sequence[str], k: int,
                       value: str = "fob_usd") -> DataFrame:
    """Series of ``value`` by (series_keys, member) for the k largest members.

    One aggregate to (series_keys, member); the ranking re-aggregates that
    small table and the top-k list (k rows, broadcast) filters it. Both
    branches share the aggregate's shuffle, so the facts are scanned once.
    """
    series = df.groupBy(*series_keys, member).agg(nsum(value).alias(value))
    totals = series.groupBy(member).agg(nsum(value).alias(value))
    top = top_k(totals, k, desc=value, tiebreak=member)
    return _null_safe_filter(series, top, member)


# R1
def _year_range(facts: DataFrame, years: tuple[int, int] | None) -> DataFrame:
    # a range on the partition key: prunes directories on the lake
    return facts if years is None else facts.where(F.col("year").between(years[0], years[1]))


def top_partners(facts: DataFrame, countries: DataFrame, blocks: DataFrame, collapse: Sequence[int],
                 k: int = 5, years: tuple[int, int] | None = None) -> DataFrame:
    """Top-k partners (listed blocks collapsed to one partner) and their yearly series."""
    facts = _year_range(facts, years)
    pb = partner_labels(countries, blocks, collapse)
    f = facts.join(pb, "country_code", "left")
    return top_members_series(f, "partner", ["year", "direction"], k)


# R2
def top_states(facts: DataFrame, k: int = 3, years: tuple[int, int] | None = None) -> DataFrame:
    return top_members_series(_year_range(facts, years), "state_abb", ["year", "direction"], k)


# R3
def partner_real_rolling(facts: DataFrame, countries: DataFrame, deflators: DataFrame,
                         codes: Sequence[int], k: int = 12) -> DataFrame:
    s = sum_prefixed(facts.where(F.col("country_code").isin(list(codes))),
                     by=["direction", "date", "country_code"])
    d = deflate(s, deflators)
    d = d.join(countries, "country_code", "left").where(F.col("fob_usd").isNotNull())
    # one row per (direction, date, country) already; countries of one name share the frame
    return roll_months(d, by=["direction", "country_name"], prefixes=["fob_usd_deflated"], k=k, one_row_per_date=True)


# R4
BALANCE_PREFIXES = ("fob_brl", "fob_usd", "fob_usd_deflated", "fob_brl_deflated", "cif_usd_deflated",
                    "cif_brl_deflated")


def trade_by_direction(facts: DataFrame, deflators: DataFrame, k: int = 12,
                       prefixes: Sequence[str] = BALANCE_PREFIXES) -> DataFrame:
    s = sum_prefixed(facts, by=["direction", "date"])
    d = deflate(s, deflators)
    return roll_months(d, by=["direction"], prefixes=prefixes, k=k, one_row_per_date=True)


# R5
def peak_month(df: DataFrame, value: str = "fob_usd_deflated", by: str = "direction") -> DataFrame:
    """Row of the largest ``value`` per group; ties keep the earliest date."""
    return first_per_group(df, by, desc=value, tiebreak="date")


# R6
def same_month_as_latest(df: DataFrame, date: str = "date") -> DataFrame:
    # one row per (direction, month): the window over all of it is bounded by the calendar
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (df.withColumn("__latest", F.max(date).over(everything))
            .where(F.month(date) == F.month("__latest")).drop("__latest"))


# R7
def balance(df: DataFrame, value: str = "fob_usd_deflated_12", name: str | None = None,
            scale: float = 1e9, na_omit: bool = False) -> DataFrame:
    """exp - imp per date (in units of ``scale``); NULL when a side is missing."""
    e = F.max(F.when(F.col("direction") == "exp", F.col(value)))
    i = F.max(F.when(F.col("direction") == "imp", F.col(value)))
    out = df.groupBy("date").agg((e / F.lit(scale) - i / F.lit(scale)).alias(name or value.replace("fob_", "balance_")))
    return out.na.drop("any") if na_omit else out


# R8
def category_change_top(facts: DataFrame, products: DataFrame, deflators: DataFrame, country: int,
                        since: str, direction: str = "imp", k: int = 10, window: int = 12) -> DataFrame:
    """Categories with the largest change of 12-month real value, same month, last two years."""
    v = f"fob_usd_deflated_{window}"
    cat = products.selectExpr("co_ncm AS ncm", "no_cgce_n3_ing AS name", "co_cgce_n3 AS code")
    start = F.to_date(F.lit(str(since)))
    # the year bound prunes the lake's directories, the date bound does the rest
    f = facts.where((F.col("year") >= F.year(start)) & (F.col("date") >= start)
                    & (F.col("country_code") == int(country)) & (F.col("direction") == direction))
    s = sum_prefixed(f.join(cat, "ncm", "left"), by=["name", "code", "direction", "date"])
    d = deflate(s, deflators).where(F.col("fob_brl_deflated").isNotNull())
    r = roll_months(d, by=["name", "code", "direction"], prefixes=["fob_usd_deflated"], k=window, one_row_per_date=True)
    r = r.select("name", "code", "direction", "date", v)
    # rows in the latest row's month of the last two years: the latest date and
    # the same month one year earlier (dates are month starts)
    # (the table is bounded by the code list and the calendar)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = r.withColumn("latest", F.max("date").over(everything))
    r = r.where("date = latest OR date = add_months(latest, -12)") \
         .withColumn("year", F.expr("CASE WHEN date = latest THEN 'current' ELSE 'last' END"))
    w = wider(r.select("name", "code", "direction", v, "year"), ["name", "code", "direction"], "year", v,
              ["last", "current"])
    w = w.selectExpr("name", "code", "direction", "coalesce(last, 0.0D) AS last", "coalesce(current, 0.0D) AS current")
    w = w.selectExpr("name", "code", "direction", "last", "current", "current - last AS d", "last + current AS s",
                     "try_divide(current, last) AS p")
    totals = w.groupBy("code").agg(F.expr("sum(abs(current - last)) AS total"))
    top = top_k(totals, k, desc="total", tiebreak="code")
    # the NULL category (products without a class) ranks like any other
    keys = F.broadcast(top.select(F.col("code").alias("__key"), "total"))
    return w.join(keys, w["code"].eqNullSafe(keys["__key"]), "inner").drop("__key")


# R9
def partner_vs_rest(facts: DataFrame, products: DataFrame, category: str, partner: int,
                    deflators: DataFrame | None = None, window: int = 12) -> DataFrame:
    """Monthly sums for one category, split partner / rest, rolled per (direction, flag)."""
    cat = products.selectExpr("co_ncm AS ncm", "co_cgce_n3")
    f = facts.join(cat, "ncm", "left").where(F.col("co_cgce_n3") == category)
    s = sum_prefixed(f, by=["direction", "date", (F.col("country_code") == partner).alias("is_partner")])
    if deflators is not None:
        s = deflate(s, deflators)
    return roll_months(s, by=["direction", "is_partner"], k=window, one_row_per_date=True)


# R10
def monthly_real(facts: DataFrame, deflators: DataFrame, since_year: int | None = None,
                 prefixes: Sequence[str] = DEFAULT_PREFIXES) -> DataFrame:
    f = facts if since_year is None else facts.where(F.col("year") >= since_year)
    return deflate(sum_prefixed(f, by=["year", "date"], prefixes=prefixes), deflators)


# R11
def yearly_complete(monthly: DataFrame, prefixes: Sequence[str] = DEFAULT_PREFIXES) -> DataFrame:
    """Yearly sums of the years whose last month is December (one aggregate)."""
    from tradelake.functions.names import match_prefix
    cols = match_prefix(monthly.columns, prefixes, exclude=["year"])
    agg = monthly.groupBy("year").agg(*[nsum(c).alias(c) for c in cols],
                                      F.max(F.month("date")).alias("__last_month"))
    return agg.where(F.col("__last_month") == 12).drop("__last_month")


# R12
def rolling_totals(monthly: DataFrame, k: int = 12) -> DataFrame:
    """Rolling sums of every default measure over the whole (one-row-per-month) series."""
    return roll_months(monthly, by=None, k=k, one_row_per_date=True)


def date_of_max(df: DataFrame, value: str) -> DataFrame:
    return top_k(df, 1, desc=value, tiebreak="date").select("date")


# R13
def yearly_growth_long(yearly: DataFrame, values: Sequence[str] = ("fob_brl_deflated", "fob_usd_deflated")) -> DataFrame:
    """Year-on-year growth in %, long form with the currency as upper-case name."""
    w = Window.partitionBy().orderBy("year")
    g = yearly.select("year", *[((ratio(F.col(v), F.lag(v).over(w)) - F.lit(1)) * F.lit(100)).alias(f"{v}_growth")
                                for v in values])
    long = longer(g, ["year"], [f"{v}_growth" for v in values], "name", "value")
    return long.withColumn("name", F.upper(F.regexp_replace("name", r"fob_(.*)_deflated_growth", "$1")))


# R14
def fiscal_long(sheet: DataFrame, first_year, value_name: str = "imposto_brl",
                category: str = "arrecadacao_categoria", unit: float = 1e6) -> DataFrame:
    """Wide monthly sheet (13 lines per year) -> (date, category, value in units).

    The year comes from the line number (13 lines a year from ``first_year``,
    an int or a scalar column); the TOTAL line and lines without a month
    label are dropped.
    """
    values = [c for c in sheet.columns if c not in ("mes", "line")]
    labels = ", ".join(f"'{x}'" for x in MONTH_LABELS)
    s = sheet.select(
        "mes", *values, "line",
        (F.floor((F.col("line") - 1) / 13) + first_year).cast("int").alias("ano"),
        F.expr(f"CAST(array_position(array({labels}), mes) AS INT) AS mes_codigo"))
    s = s.where("mes_codigo > 0").selectExpr("*", "make_date(ano, mes_codigo, 1) AS date")
    ids = ["mes", "line", "ano", "mes_codigo", "date"]
    long = longer(s, ids, values, category, f"{value_name}_milhoes")
    return long.selectExpr(*ids, category, f"{value_name}_milhoes * {unit!r}D AS {value_name}")


# R15
def effective_rate(tax_long: DataFrame, tax_real_long: DataFrame, facts: DataFrame, gdp: DataFrame,
                   deflators: DataFrame, category: str, window: int = 12) -> DataFrame:
    """Import tax over CIF imports, rolled, and both as shares of rolled GDP."""
    t = tax_long.where(F.col("arrecadacao_categoria") == category).select(
        "date", "arrecadacao_categoria", "imposto_brl")
    tr = tax_real_long.where(F.col("arrecadacao_categoria") == category).select(
        "date", F.col("imposto_brl").alias("imposto_rfb_brl"))
    imports = sum_prefixed(facts.where(F.col("direction") == "imp"), by=["date"])
    j = t.join(tr, "date", "left").join(imports, "date", "left")
    j = j.withColumnRenamed("imposto_brl", "imposto_nominal_brl")
    d = deflate(j, deflators).withColumnRenamed("imposto_nominal_brl", "imposto_brl")
    r = roll_months(d, by=None, prefixes=list(DEFAULT_PREFIXES) + ["imposto_"], k=window,
                    one_row_per_date=True)
    pib = roll_rows(gdp.selectExpr("date", "pib_brl_milhoes * 1000000.0D AS pib_brl"),
                    "pib_brl", n=12, name="pib_annual_brl")
    r = r.join(pib.select("date", "pib_annual_brl"), "date", "left")
    w = window
    return r.selectExpr("*", "try_divide(imposto_brl, cif_brl) AS ii_prop",
                        f"try_divide(imposto_brl_{w}, cif_brl_{w}) AS ii_prop_{w}",
                        f"try_divide(cif_brl_{w}, pib_annual_brl) AS imp_pct_pib_{w}",
                        f"try_divide(imposto_brl_{w}, pib_annual_brl) AS ii_ipi_pct_pib_{w}")


# fixed values: display names of the two share series (the reference's labels)
SHARE_LABELS = {"imp_pct_pib_12": "Importações CIF", "ii_ipi_pct_pib_12": "II + IPI vinculado"}


def gdp_shares_long(rate: DataFrame, labels: dict[str, str] = SHARE_LABELS) -> DataFrame:
    """(date, serie, pct_pib): the two GDP shares of ``effective_rate`` in long form,
    rows without an import share dropped, series names recoded to labels."""
    cols = list(labels)
    long = longer(rate.where(F.col(cols[0]).isNotNull()).select("date", *cols), ["date"], cols, "serie", "pct_pib")
    mapping = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return long.withColumn("serie", F.coalesce(mapping[F.col("serie")], F.col("serie")))


def month_labels(df: DataFrame, date: str = "date") -> DataFrame:
    """One row: the latest month as 'MM/yyyy' and as the first 7 characters of the date."""
    latest = F.max(date)
    return df.agg(F.date_format(latest, "MM/yyyy").alias("label_mm_yyyy"),
                  F.substring(latest.cast("string"), 1, 7).alias("label_yyyy_mm"))


# R16
def format_ncm(facts: DataFrame, years: Sequence[int]) -> DataFrame:
    return sum_prefixed(facts.where(F.col("year").isin(list(years))), by=["direction", "year"], prefixes="fob_usd")


def format_hs4(facts: DataFrame) -> DataFrame:
    return sum_prefixed(facts, by=["direction", "year", "country_code"], prefixes="fob_usd")


# R17
def freight_share_by_year(facts: DataFrame) -> DataFrame:
    """Freight over FOB per (year, direction); exports have no freight, so NULL."""
    return share_of_sums(facts, ["year", "direction"], num="freight_usd", den="fob_usd")


def freight_share_by_country(facts: DataFrame) -> DataFrame:
    """Freight over FOB per country; FOB skips NULLs, freight does not (as the reference's example)."""
    return share_of_sums(facts, "country_code", num="freight_usd", den="fob_usd", na_rm_den=True)
