"""

Every query reads the driver's tables through the adapter in
``tradelake.sources.testdata`` (trade facts from lineitem + supplier,
deflator series from orders, code tables from part / nation / region) and
runs a report or operator of ``tradelake`` over the whole tables.

Floating columns whose last bits depend on summation order (anything that goes
through an average, a running product or a sum of doubles) are rounded to the same
number of significant digits on both sides (``tradelake.plans.presentation``);
all others are compared exactly. The DuckDB oracles live in ``oracles.py``.
"""

from __future__ import annotations

import datetime
import os
import re
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradelake.functions.codes import clean_code, code_label
from tradelake.operators.aggregate import sum_prefixed
from tradelake.operators.checks import coverage_grid, covered_partitions, missing_partitions, reconcile
from tradelake.operators.deflate import deflate
from tradelake.operators.deflators import build_deflators, deflator_report, monthly_mid_rate, price_index
from tradelake.operators.deflator_store import persist_deflators, series_state, stored_deflators
from tradelake.operators.lookups import merge_lookups
from tradelake.operators.rolling import roll_months, roll_rows
from tradelake.plans import ingest, layout, publish, reports, states
from tradelake.plans.presentation import ordered, stable
from tradelake.session import scratch_path
from tradelake.sources.lake import lake_years, open_hs4, open_ncm
from tradelake.sources.lines import read_raw_sheet
from tradelake.sources.series import read_cpi, read_ipca, read_quotes, read_sheet
from tradelake.sources.trade_csv import landed_files, read_control, read_hs4_raw, read_ncm_raw, read_table
from tradelake.sources import testdata as td

SF_SMOKE = "/root/testdata/sf0.001"

# report parameters (the reference's articles pick partners, a category and
# a start date; these pick the counterparts in the driver's tables)
PARTNERS = (7, 14, 21)          # three countries for the real rolling series
BLOCKS = (1, 3)                 # two blocks collapsed into one partner each
CATEGORY_PARTNER = 9            # partner whose categories are ranked
CATEGORY_SINCE = "1998-01-01"
CATEGORY = "LAR"                # category code for the partner-vs-rest report
FORMAT_YEARS = (1996, 1997, 1998, 1999)
RECENT_YEARS = (1998, 2001)
BASEDATE = "1999-12-01"

_stable = stable


# --- shared inputs -------------------------------------------------------------

def _facts(spark, d):
    return td.trade_facts(spark, d)


_DEFLATOR_STORES: dict[str, str] = {}


def _series_state(spark, d):
    # quotes, CPI and IPCA all come from the orders; the last month that counts is the one before this
    return series_state(spark, [f"{d.rstrip('/')}/orders.parquet"], datetime.date.today().replace(day=1).isoformat())


def persist_series(spark, d):
    """Write the deflators of ``d`` once; reports over ``d`` read that table while its series stay as they are."""
    store = _DEFLATOR_STORES.setdefault(d, scratch_path(spark, "deflators"))
    return persist_deflators(spark, store, _series_state(spark, d), lambda: _deflators(spark, d, na_omit=False))


def _deflators(spark, d, na_omit=True):
    # one row per month; built from the series where no table of their present state was written
    stored = stored_deflators(spark, _DEFLATOR_STORES[d], _series_state(spark, d)) if d in _DEFLATOR_STORES else None
    if stored is not None:
        return stored.na.drop("any") if na_omit else stored
    return build_deflators(td.ipca_source(spark, d), td.fx_quotes(spark, d), td.cpi_source(spark, d), na_omit=na_omit)


def _products(spark, d):
    # merged product code tables
    return merge_lookups(td.product_tables(spark, d), check_unique=True)


def _monthly(spark, d, **options):
    return reports.monthly_real(_facts(spark, d), _deflators(spark, d), **options)


def _balance_deflated(spark, d):
    # (direction, month) table behind the balance, peak and same-month reports
    return reports.trade_by_direction(_facts(spark, d), _deflators(spark, d))


def _tax_long(spark, d, scale=1.0):
    first = td.first_order_year(spark, d)
    return reports.fiscal_long(td.fiscal_sheet(spark, d, first, scale), first)


def _gdp(spark, d):
    return td.gdp_series(spark, d)


# --- queries --------------------------------------------------------------------

def q_sum_by_direction_year(spark, d):
    return sum_prefixed(_facts(spark, d), by=["direction", "year"])


def q_sum_na_rm(spark, d):
    return sum_prefixed(_facts(spark, d), by=["year"], na_rm=True)


def q_sum_global(spark, d):
    return sum_prefixed(_facts(spark, d))


def q_format_ncm(spark, d):
    return reports.format_ncm(_facts(spark, d), FORMAT_YEARS)


def q_format_hs4(spark, d):
    return reports.format_hs4(td.hs4_facts(spark, d))


def q_top_partners(spark, d):
    return reports.top_partners(_facts(spark, d), td.countries(spark, d), td.country_blocks(spark, d), BLOCKS)


def q_top_partners_recent(spark, d):
    # the article's window: the last four years of data
    return reports.top_partners(_facts(spark, d), td.countries(spark, d), td.country_blocks(spark, d), BLOCKS,
                                years=RECENT_YEARS)


def q_top_states(spark, d):
    return reports.top_states(_facts(spark, d))


def q_partner_real_rolling(spark, d):
    return _stable(reports.partner_real_rolling(_facts(spark, d), td.countries(spark, d),
                                                _deflators(spark, d), PARTNERS))


def q_roll12_by_direction(spark, d):
    s = sum_prefixed(_facts(spark, d), by=["direction", "date"])
    return roll_months(s, by=["direction"], k=12, one_row_per_date=True)


def q_roll3_with_ties(spark, d):
    f = _facts(spark, d).select("year", "month", "ncm", "country_code", "direction", "date",
                                "qt_stat", "fob_usd", "freight_usd")
    return roll_months(f, by=["direction"], prefixes=["qt_", "fob_", "freight_"], k=3)


def q_roll_rows12(spark, d):
    g = _gdp(spark, d).select("date", (F.col("pib_brl_milhoes") * F.lit(1e6)).alias("pib_brl"))
    return _stable(roll_rows(g, "pib_brl", n=12, name="pib_annual_brl"))


def q_deflators(spark, d):
    return _stable(_deflators(spark, d, na_omit=False))


def q_price_index(spark, d):
    return _stable(price_index(td.ipca_source(spark, d)))


def q_deflated_monthly(spark, d):
    return _stable(_monthly(spark, d))


def q_deflate_basedate(spark, d):
    s = sum_prefixed(_facts(spark, d), by=["direction", "date"])
    return _stable(deflate(s, _deflators(spark, d), basedate=BASEDATE))


def q_trade_by_direction(spark, d):
    return _stable(_balance_deflated(spark, d))


def q_balance_usd(spark, d):
    return _stable(reports.balance(_balance_deflated(spark, d), "fob_usd_deflated_12", "balance_usd_deflated_12"))


def q_balance_brl(spark, d):
    return _stable(reports.balance(_balance_deflated(spark, d), "fob_brl_deflated_12", "balance_brl_deflated_12",
                                   na_omit=True))


def q_peak_month(spark, d):
    return _stable(reports.peak_month(_balance_deflated(spark, d), "fob_usd_deflated"))


def q_same_month(spark, d):
    return _stable(reports.same_month_as_latest(_balance_deflated(spark, d)))


def q_yearly_complete(spark, d):
    return _stable(reports.yearly_complete(_monthly(spark, d)))


def q_rolling_real_vs_nominal(spark, d):
    return _stable(reports.rolling_totals(_monthly(spark, d)))


def q_max_real_date(spark, d):
    return reports.date_of_max(reports.rolling_totals(_monthly(spark, d)), "fob_usd_deflated_12")


def q_yearly_growth_long(spark, d):
    # only the FOB measures are deflated: the growth table needs no other
    return _stable(reports.yearly_growth_long(reports.yearly_complete(_monthly(spark, d, prefixes="fob_usd"))))


def q_category_change_top10(spark, d):
    return _stable(reports.category_change_top(_facts(spark, d), _products(spark, d), _deflators(spark, d),
                                               CATEGORY_PARTNER, CATEGORY_SINCE))


def q_category_change_unclassified(spark, d):
    # one class is missing from the code table: its products rank as the NULL category
    p = _products(spark, d).where(F.col("co_cgce_n3") != CATEGORY)
    return _stable(reports.category_change_top(_facts(spark, d), p, _deflators(spark, d),
                                               CATEGORY_PARTNER, CATEGORY_SINCE))


def q_partner_vs_rest(spark, d):
    return reports.partner_vs_rest(_facts(spark, d), _products(spark, d), CATEGORY, CATEGORY_PARTNER)


def q_partner_vs_rest_real(spark, d):
    return _stable(reports.partner_vs_rest(_facts(spark, d), _products(spark, d), CATEGORY, CATEGORY_PARTNER,
                                           deflators=_deflators(spark, d)))


def q_freight_share_year(spark, d):
    return _stable(reports.freight_share_by_year(_facts(spark, d)))


def q_freight_share_country(spark, d):
    return _stable(reports.freight_share_by_country(_facts(spark, d)))


def q_code_clean(spark, d):
    p = td.table(spark, d, "part")
    raw = F.format_string("%04d.%04d", (F.col("p_partkey") / 10000).cast("int"), (F.col("p_partkey") % 10000).cast("int"))
    return p.select("p_partkey", raw.alias("raw_code"),
                    clean_code(raw, 8).alias("ncm"),
                    clean_code("p_brand").alias("brand_digits"),
                    clean_code("p_name").alias("name_digits"))


def q_lookup_merge(spark, d):
    return _products(spark, d)


def q_lookup_merge_null_key(spark, d):
    # one class code is unknown (NULL) in both tables: it matches itself, as in an in-memory merge
    ncm, cgce, unid = td.product_tables(spark, d)
    blank = lambda t: t.withColumn("co_cgce_n3", F.expr(f"nullif(co_cgce_n3, '{CATEGORY}')"))
    return merge_lookups([blank(ncm), blank(cgce), unid], check_unique=True)


def _control(spark, d):
    return td.control_totals(spark, d)


def q_reconcile_ok(spark, d):
    return reconcile(_facts(spark, d), _control(spark, d))


def q_reconcile_mismatch(spark, d):
    c = _control(spark, d)
    hit = (F.col("year") == 1998) & F.col("file").contains("IMP")
    c = c.withColumn("fob_usd", F.when(hit, F.col("fob_usd") + 1).otherwise(F.col("fob_usd")))
    return reconcile(_facts(spark, d), c)


def q_uncovered_control(spark, d):
    c = _control(spark, d)
    last = c.agg(F.max("year")).scalar()
    extra = (c.where(F.col("year") == last).withColumn("year", F.col("year") + 10)
              .withColumn("file", F.regexp_replace("file", r"[0-9]{4}", (last + 10).cast("int").cast("string"))))
    return reconcile(_facts(spark, d), c.unionByName(extra))


def _landed(spark, d):
    """(direction, year, type) of official files, listed by name."""
    ncm = ingest.land_as_csv(_facts(spark, d))
    hs4 = ingest.land_hs4_as_csv(td.hs4_facts(spark, d))
    return landed_files(spark, ncm, "ncm").withColumn("type", F.lit("ncm")).unionByName(
        landed_files(spark, hs4, "hs4").withColumn("type", F.lit("hs4"))), ncm


def q_missing_partitions(spark, d):
    grid = coverage_grid(spark, list(range(1993, 2004)), ["imp", "exp"], ["ncm", "hs4"])
    return missing_partitions(grid, _landed(spark, d)[0])


def q_covered_partitions(spark, d):
    grid = coverage_grid(spark, list(range(1993, 2004)), ["imp", "exp"], ["ncm", "hs4"])
    return covered_partitions(grid, _landed(spark, d)[0])


def q_ingest_missing_files(spark, d):
    # files of one direction only: what a request for both directions lacks
    landing = ingest.land_as_csv(_facts(spark, d).where(F.col("direction") == "imp"))
    return ingest.missing_files(spark, landing, list(range(1993, 2004)))


def q_ingest_bad_file_report(spark, d):
    # text in a numeric cell of every file of one year: the probe counts the rows
    landing = ingest.land_as_csv(_facts(spark, d).withColumn("qt_stat", F.when(
        (F.col("year") == 1997) & (F.col("qt_stat") == 10), F.lit("ten")).otherwise(F.col("qt_stat").cast("string"))))
    return ingest.landing_report(spark, landing)


def q_reconcile_large(spark, d):
    # totals beyond 2^53 that differ by one: exact, where doubles would print and compare alike
    big = F.lit(1 << 60)
    f = _facts(spark, d).groupBy("year", "direction").agg(F.sum("fob_usd").alias("fob_usd"))
    f = f.withColumn("fob_usd", F.col("fob_usd") + big)
    c = _control(spark, d).select("file", "year", (F.col("fob_usd") + big + F.when(
        F.col("year") == 1998, F.lit(1)).otherwise(F.lit(0))).alias("fob_usd"))
    return reconcile(f, c, measures=["fob_usd"])


def q_union_missing_columns(spark, d):
    f = _facts(spark, d)
    base = ["year", "month", "ncm", "country_code", "qt_stat", "fob_usd"]
    imp = f.where(F.col("direction") == "imp").select(*base, "freight_usd", "insurance_usd")
    exp = f.where(F.col("direction") == "exp").select(*base)
    return ingest.standardize_union([imp, exp])


def q_fiscal_long(spark, d):
    return _stable(_tax_long(spark, d))


def q_effective_rate(spark, d):
    r = reports.effective_rate(_tax_long(spark, d), _tax_long(spark, d, scale=1.25), _facts(spark, d),
                               _gdp(spark, d), _deflators(spark, d), "i_importacao_e_ipi_vinculado")
    return _stable(r)


def q_gdp_shares_long(spark, d):
    r = reports.effective_rate(_tax_long(spark, d), _tax_long(spark, d, scale=1.25), _facts(spark, d),
                               _gdp(spark, d), _deflators(spark, d), "i_importacao_e_ipi_vinculado")
    return _stable(reports.gdp_shares_long(r))


def q_peak_month_brl(spark, d):
    return _stable(reports.peak_month(_balance_deflated(spark, d), "fob_brl_deflated"))


def q_deflator_report(spark, d):
    return deflator_report(build_deflators(td.ipca_source(spark, d), td.fx_quotes(spark, d),
                                           td.cpi_source(spark, d)))


def q_month_labels(spark, d):
    return reports.month_labels(reports.partner_vs_rest(_facts(spark, d), _products(spark, d), CATEGORY,
                                                        CATEGORY_PARTNER))


def q_reconcile_hs4(spark, d):
    return reconcile(td.hs4_facts(spark, d), td.control_totals_mun(spark, d))


def q_hs4_csv_roundtrip(spark, d):
    landing = ingest.land_hs4_as_csv(td.hs4_facts(spark, d))
    return reports.format_hs4(read_hs4_raw(spark, landing))


def q_lookup_csv_roundtrip(spark, d):
    # the product code table as an official CSV: codes keep their leading zeros
    folder = scratch_path(spark, "tables")
    p = td.table(spark, d, "part").selectExpr("lpad(CAST(p_partkey AS STRING), 8, '0') AS CO_NCM",
                                              "CAST(p_size % 10 AS STRING) AS CO_UNID", "p_name AS NO_NCM_ING")
    ingest.land_table_csv(p, f"{folder}/ncm.csv")
    return read_table(spark, "ncm", folder)


def q_control_csv_reconcile(spark, d):
    folder = scratch_path(spark, "tables")
    c = _control(spark, d)
    official = {"file": "ARQUIVO", "year": "CO_ANO", "qt_stat": "QT_ESTAT", "kg_net": "KG_LIQUIDO",
                "fob_usd": "VL_FOB", "freight_usd": "VL_FRETE", "insurance_usd": "VL_SEGURO",
                "number_of_lines": "NUMERO_LINHAS"}
    imp = c.where(F.col("file").startswith("IMP")).select(*[F.col(k).alias(v) for k, v in official.items()])
    exp = c.where(F.col("file").startswith("EXP")).select(
        *[F.col(k).alias(v) for k, v in official.items() if k not in ("freight_usd", "insurance_usd")])
    ingest.land_table_csv(imp, f"{folder}/imp_totais_conferencia.csv", decimal_comma=True)
    ingest.land_table_csv(exp, f"{folder}/exp_totais_conferencia.csv", decimal_comma=True)
    return reconcile(_facts(spark, d), read_control(spark, folder))


def q_control_csv_reconcile_mun(spark, d):
    folder = scratch_path(spark, "tables")
    official = {"file": "ARQUIVO", "year": "CO_ANO", "kg_net": "KG_LIQUIDO", "fob_usd": "VL_FOB",
                "number_of_lines": "NUMERO_LINHAS"}
    c = td.control_totals_mun(spark, d).select(*[F.col(k).alias(v) for k, v in official.items()])
    for side in ("imp", "exp"):
        ingest.land_table_csv(c.where(F.col("ARQUIVO").startswith(side.upper())),
                              f"{folder}/{side}_totais_conferencia_mun.csv", decimal_comma=True)
    return reconcile(td.hs4_facts(spark, d), read_control(spark, folder, mun=True),
                     measures=["kg_net", "fob_usd", "number_of_lines"])


def q_deflators_from_files(spark, d):
    # the series as landed files: S7-S9 readers feed the table
    folder = scratch_path(spark, "series")
    for name, df in (("cpi", td.cpi_source(spark, d)), ("ipca", td.ipca_source(spark, d)),
                     ("quotes", td.fx_quotes(spark, d))):
        df.write.option("header", "true").csv(f"{folder}/{name}.csv")
    return _stable(build_deflators(read_ipca(spark, f"{folder}/ipca.csv"), read_quotes(spark, f"{folder}/quotes.csv"),
                                   read_cpi(spark, f"{folder}/cpi.csv")))


def q_fiscal_from_sheet(spark, d):
    # the sheet as an exported CSV (S10), then the same long table
    path = f"{scratch_path(spark, 'sheet')}/sheet.csv"
    first = td.first_order_year(spark, d)
    td.fiscal_sheet(spark, d, first).write.option("header", "true").option("sep", ";").csv(path)
    return _stable(reports.fiscal_long(read_sheet(spark, path), first))


def q_partition_replace(spark, d):
    # publish, then replace one year: the others stay as they are
    facts = _facts(spark, d)
    lake = ingest.publish_lake(facts)
    ingest.publish_lake(facts.where(F.col("year") == 1997).withColumn("fob_usd", F.col("fob_usd") * 2), lake)
    return sum_prefixed(open_ncm(spark, lake), by=["direction", "year"], prefixes="fob_usd")


def q_sorted_monthly(spark, d):
    # display order of the monthly table: numbered rows, NULL dates last
    s = ordered(sum_prefixed(_facts(spark, d), by=["direction", "date"], prefixes="fob_usd"), "date", "direction")
    everything = Window.partitionBy().orderBy(F.col("date").asc_nulls_last(), F.col("direction").asc_nulls_last())
    return s.withColumn("position", F.row_number().over(everything))


def q_partner_code_labels(spark, d):
    # "code: name" labels of the countries
    return td.countries(spark, d).select("country_code", code_label("country_code", "country_name").alias("label"))


def q_ingest_job(spark, d):
    landing = ingest.land_as_csv(_facts(spark, d))
    lake = ingest.ingest(spark, landing, scratch_path(spark, "lake"), control=_control(spark, d))
    return sum_prefixed(open_ncm(spark, lake), by=["direction", "year"])


def q_file_quality(spark, d):
    landing = ingest.land_as_csv(_facts(spark, d))
    return ingest.landing_report(spark, landing).drop("file")


def q_hs4_lake_roundtrip(spark, d):
    # rewrite() picks the HS4 dataset (no ncm column) and publishes it under <base>/hs4
    path, _ = ingest.rewrite(td.hs4_facts(spark, d), scratch_path(spark, "lake"))
    return reports.format_hs4(open_hs4(spark, path))


def q_lake_roundtrip(spark, d):
    lake = ingest.publish_lake(_facts(spark, d))
    return sum_prefixed(spark.read.parquet(lake), by=["direction", "year"])


def q_csv_ingest_roundtrip(spark, d):
    landing = ingest.land_as_csv(_facts(spark, d))
    raw = read_ncm_raw(spark, landing)
    return sum_prefixed(raw, by=["direction", "year"])


def _refused(publication) -> str:
    """The message of a publication that has to fail."""
    try:
        publication()
    except (ValueError, publish.PublishConflict) as e:
        return str(e)
    raise AssertionError("a publication that had to fail went through")


def q_publish_half_failed(spark, d):
    # a second publication writes all its rows, then fails its check: the lake reads as before
    lake, facts = scratch_path(spark, "lake"), _facts(spark, d)
    publish.publish(facts, lake)
    control = _control(spark, d)
    _refused(lambda: publish.publish(facts.withColumn("fob_usd", F.col("fob_usd") * 2), lake,
                                     verify=lambda staged: ingest.check_totals(staged, control)))
    return sum_prefixed(open_ncm(spark, lake), by=["direction", "year"])


def q_publish_one_partition(spark, d):
    # one partition is replaced; the first manifest still reads what it read
    lake, facts = scratch_path(spark, "lake"), _facts(spark, d)
    first = publish.publish(facts, lake).number
    publish.publish(facts.where("year = 1997 AND direction = 'imp'").withColumn("fob_usd", F.col("fob_usd") * 2), lake,
                    partitions=[(1997, "imp")])
    sums = lambda f, name: sum_prefixed(f, by=["direction", "year"], prefixes="fob_usd").withColumn("manifest", F.lit(name))
    return sums(open_ncm(spark, lake, manifest=first), "first").unionByName(sums(open_ncm(spark, lake), "newest"))


def q_publish_conflict(spark, d):
    # two writers start from one manifest: the second to finish is refused, and publishes on top when it starts again
    lake, facts = scratch_path(spark, "lake"), _facts(spark, d)
    publish.publish(facts, lake)
    slow = publish.stage(facts.where("year = 1998").withColumn("fob_usd", F.col("fob_usd") * 3), lake)
    publish.publish(facts.where("year = 1997").withColumn("fob_usd", F.col("fob_usd") * 2), lake)
    _refused(lambda: publish.commit(spark, slow))
    publish.discard(spark, lake, slow.version)
    publish.publish(facts.where("year = 1998").withColumn("fob_usd", F.col("fob_usd") * 3), lake)
    publish.vacuum(spark, lake)
    # after the vacuum even a reader that knows nothing of manifests sees the newest versions only
    return sum_prefixed(spark.read.parquet(lake), by=["direction", "year"], prefixes="fob_usd")


def q_ingest_mixed_kinds(spark, d):
    # municipality files lie in the same folders as the NCM files: each kind is published as what it is
    landing = ingest.land_as_csv(_facts(spark, d), scratch_path(spark, "landing"))
    ingest.land_hs4_as_csv(td.hs4_facts(spark, d), landing, mode="append")
    years = list(range(1995, 2002))
    ncm = ingest.ingest(spark, landing, scratch_path(spark, "lake"), years=years, control=_control(spark, d))
    hs4 = ingest.ingest(spark, landing, scratch_path(spark, "lake"), years=years, kind="hs4",
                        control=td.control_totals_mun(spark, d))
    sums = lambda f, kind: sum_prefixed(f, by=["direction", "year"], prefixes=["kg_net", "fob_usd"]).withColumn("kind", F.lit(kind))
    return sums(open_ncm(spark, ncm), "ncm").unionByName(sums(open_hs4(spark, hs4), "hs4"))


def q_landing_manifest(spark, d):
    landing = scratch_path(spark, "landing")
    ingest.land_hs4_as_csv(td.hs4_facts(spark, d).where("year < 1998"), landing)
    return ingest.landing_table(spark, landing).select("kind", "direction", "year", "file")


def q_ingest_stray_year(spark, d):
    # one year's file holds rows of another year: nothing is published, the message names the file, the lake stays
    lake, facts = scratch_path(spark, "lake"), _facts(spark, d)
    ingest.ingest(spark, ingest.land_as_csv(facts), lake)
    moved = facts.where("year = 1998").withColumn("year", F.expr("CASE WHEN month = 12 THEN 1997 ELSE year END"))
    landing = scratch_path(spark, "landing")
    ingest.land_as_csv(moved.withColumn("file_year", F.lit(1998)), landing, file_year="file_year")
    said = _refused(lambda: ingest.ingest(spark, landing, lake))
    named = sorted(set(re.findall(r"(?:IMP|EXP)_[0-9]+[.]csv", said)))
    return sum_prefixed(open_ncm(spark, lake), by=["direction", "year"]).withColumn("refused", F.lit(",".join(named)))


def q_ingest_swapped_header(spark, d):
    # freight and insurance change places in one year's files: the header check names the file, the lake stays
    lake, facts = scratch_path(spark, "lake"), _facts(spark, d)
    ingest.ingest(spark, ingest.land_as_csv(facts), lake)
    landing = scratch_path(spark, "landing")
    ingest.land_as_csv(facts.where("year = 1999 AND direction = 'imp'"), landing, header={"VL_FRETE": "VL_SEGURO", "VL_SEGURO": "VL_FRETE"})
    said = _refused(lambda: ingest.ingest(spark, landing, lake))
    named = sorted(set(re.findall(r"(?:IMP|EXP)_[0-9]+[.]csv", said)))
    return sum_prefixed(open_ncm(spark, lake), by=["direction", "year"]).withColumn("refused", F.lit(",".join(named)))


def q_states_after_replace(spark, d):
    # the aggregates are refreshed for the replaced partitions only, and equal a full run
    lake, store, facts = scratch_path(spark, "lake"), scratch_path(spark, "states"), _facts(spark, d)
    publish.publish(facts, lake)
    states.refresh_states(spark, lake, store)
    publish.publish(facts.where("year = 1997").withColumn("fob_usd", F.col("fob_usd") * 2), lake)
    anew = states.refresh_states(spark, lake, store)
    merged = states.merge_states(states.read_states(spark, store), by=["year", "date"])
    return merged.withColumn("refreshed", F.lit(",".join(f"{p}/{y}" for y, p in anew)))


def q_yearly_growth_from_states(spark, d):
    # R13 from the kept aggregates: no fact is read
    lake, store = scratch_path(spark, "lake"), scratch_path(spark, "states")
    publish.publish(_facts(spark, d), lake)
    states.refresh_states(spark, lake, store, prefixes=["fob_usd"])
    monthly = deflate(states.merge_states(states.read_states(spark, store), by=["year", "date"]), _deflators(spark, d))
    return _stable(reports.yearly_growth_long(reports.yearly_complete(monthly)))


def q_country_scan_clustered(spark, d):
    # the lake clustered over product and country: a country filter skips row groups
    lake = scratch_path(spark, "lake")
    layout.cluster(_facts(spark, d), lake, row_group_bytes=1 << 18, distinct={"ncm": 2000, "country_code": 25})
    return sum_prefixed(open_ncm(spark, lake).where(F.col("country_code").isin(list(PARTNERS))),
                        by=["country_code", "direction", "year"], prefixes="fob_usd")


def q_partner_vs_rest_colocated(spark, d):
    # facts and product table bucketed alike on the product code: their join moves neither
    tag = os.path.basename(scratch_path(spark, "bucketed")).replace("-", "_")
    facts, products = _facts(spark, d), _products(spark, d)
    buckets = layout.bucket_count(facts, products)
    facts = layout.colocate(facts, f"facts_{tag}", "ncm", buckets)
    products = layout.colocate(products, f"products_{tag}", "co_ncm", buckets)
    return reports.partner_vs_rest(facts, products, CATEGORY, CATEGORY_PARTNER)


def q_deflators_persisted(spark, d):
    # written once per state of the series; a state that was never written is not served
    store = scratch_path(spark, "deflators")
    persist_deflators(spark, store, _series_state(spark, d),
                      lambda: build_deflators(td.ipca_source(spark, d), td.fx_quotes(spark, d), td.cpi_source(spark, d)))
    if stored_deflators(spark, store, "another state") is not None:
        raise AssertionError("a table of another state was served")
    s = sum_prefixed(_facts(spark, d), by=["direction", "date"])
    return _stable(deflate(s, stored_deflators(spark, store, _series_state(spark, d)).na.drop("any"), basedate=BASEDATE))


def q_category_change_latest(spark, d):
    # the lake's own latest three years bound the scan: no date is given
    lake = scratch_path(spark, "lake")
    publish.publish(_facts(spark, d), lake)
    since = f"{lake_years(spark, lake)[-1] - 2}-01-01"
    return _stable(reports.category_change_top(open_ncm(spark, lake, last_years=3), _products(spark, d), _deflators(spark, d),
                                               CATEGORY_PARTNER, since))


def q_fiscal_from_raw_sheet(spark, d):
    # the sheet as exported: six lines of preamble, a header, rows without numbers, read in several splits
    path = f"{scratch_path(spark, 'sheet')}/sheet.csv"
    first = td.first_order_year(spark, d)
    sheet = td.fiscal_sheet(spark, d, first)
    names = [c for c in sheet.columns if c != "line"]
    text = sheet.select("line", F.concat_ws(";", *[F.col(c).cast("string") for c in names]).alias("value"))
    head = ["TABELA;Arrecadação", "", "Fonte;;", "Unidade: milhões;", "", "notas", ";".join(names)]
    top = spark.range(len(head)).select((F.col("id") - len(head)).cast("int").alias("line"), F.element_at(
        F.array(*[F.lit(h) for h in head]), (F.col("id") + 1).cast("int")).alias("value"))
    ordered_lines = top.unionByName(text).repartition(1).sortWithinPartitions("line").select(F.col("value"))
    ordered_lines.write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512b")
    try:
        raw = read_raw_sheet(spark, path, encoding="UTF-8")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return _stable(reports.fiscal_long(raw, first))


def q_quotes_until_last_month(spark, d):
    # quotes that run past today: the default bound, the last day of the previous month, cuts them
    o = td.fx_quotes(spark, d)
    ahead = o.agg(F.datediff(F.current_date(), F.max("date")) + 45).scalar()
    return _stable(monthly_mid_rate(o.withColumn("date", F.date_add("date", ahead))))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sum_by_direction_year": q_sum_by_direction_year,
    "sum_na_rm": q_sum_na_rm,
    "sum_global": q_sum_global,
    "format_ncm": q_format_ncm,
    "format_hs4": q_format_hs4,
    "top_partners": q_top_partners,
    "top_partners_recent": q_top_partners_recent,
    "top_states": q_top_states,
    "partner_real_rolling": q_partner_real_rolling,
    "roll12_by_direction": q_roll12_by_direction,
    "roll3_with_ties": q_roll3_with_ties,
    "roll_rows12": q_roll_rows12,
    "deflators": q_deflators,
    "price_index": q_price_index,
    "deflated_monthly": q_deflated_monthly,
    "deflate_basedate": q_deflate_basedate,
    "trade_by_direction": q_trade_by_direction,
    "balance_usd": q_balance_usd,
    "balance_brl": q_balance_brl,
    "peak_month": q_peak_month,
    "same_month": q_same_month,
    "yearly_complete": q_yearly_complete,
    "rolling_real_vs_nominal": q_rolling_real_vs_nominal,
    "max_real_date": q_max_real_date,
    "yearly_growth_long": q_yearly_growth_long,
    "category_change_top10": q_category_change_top10,
    "category_change_unclassified": q_category_change_unclassified,
    "partner_vs_rest": q_partner_vs_rest,
    "partner_vs_rest_real": q_partner_vs_rest_real,
    "freight_share_year": q_freight_share_year,
    "freight_share_country": q_freight_share_country,
    "code_clean": q_code_clean,
    "lookup_merge": q_lookup_merge,
    "lookup_merge_null_key": q_lookup_merge_null_key,
    "reconcile_ok": q_reconcile_ok,
    "reconcile_large": q_reconcile_large,
    "covered_partitions": q_covered_partitions,
    "ingest_missing_files": q_ingest_missing_files,
    "ingest_bad_file_report": q_ingest_bad_file_report,
    "control_csv_reconcile_mun": q_control_csv_reconcile_mun,
    "deflators_from_files": q_deflators_from_files,
    "fiscal_from_sheet": q_fiscal_from_sheet,
    "partition_replace": q_partition_replace,
    "sorted_monthly": q_sorted_monthly,
    "partner_code_labels": q_partner_code_labels,
    "reconcile_mismatch": q_reconcile_mismatch,
    "uncovered_control": q_uncovered_control,
    "missing_partitions": q_missing_partitions,
    "union_missing_columns": q_union_missing_columns,
    "fiscal_long": q_fiscal_long,
    "effective_rate": q_effective_rate,
    "gdp_shares_long": q_gdp_shares_long,
    "peak_month_brl": q_peak_month_brl,
    "deflator_report": q_deflator_report,
    "month_labels": q_month_labels,
    "reconcile_hs4": q_reconcile_hs4,
    "hs4_csv_roundtrip": q_hs4_csv_roundtrip,
    "lookup_csv_roundtrip": q_lookup_csv_roundtrip,
    "control_csv_reconcile": q_control_csv_reconcile,
    "ingest_job": q_ingest_job,
    "file_quality": q_file_quality,
    "hs4_lake_roundtrip": q_hs4_lake_roundtrip,
    "lake_roundtrip": q_lake_roundtrip,
    "csv_ingest_roundtrip": q_csv_ingest_roundtrip,
    "publish_half_failed": q_publish_half_failed,
    "publish_one_partition": q_publish_one_partition,
    "publish_conflict": q_publish_conflict,
    "ingest_mixed_kinds": q_ingest_mixed_kinds,
    "landing_manifest": q_landing_manifest,
    "ingest_stray_year": q_ingest_stray_year,
    "ingest_swapped_header": q_ingest_swapped_header,
    "states_after_replace": q_states_after_replace,
    "yearly_growth_from_states": q_yearly_growth_from_states,
    "country_scan_clustered": q_country_scan_clustered,
    "partner_vs_rest_colocated": q_partner_vs_rest_colocated,
    "deflators_persisted": q_deflators_persisted,
    "category_change_latest": q_category_change_latest,
    "fiscal_from_raw_sheet": q_fiscal_from_raw_sheet,
    "quotes_until_last_month": q_quotes_until_last_month,
}


def _corpus_operators() -> tuple[dict, dict]:
    """Queries and SQL of the corpus operators; none where that subpackage is absent."""
    try:
        import corpus_pipeline
        from tradelake.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name not in ("tradelake.llm", "tradelake.llm.queries", "corpus_pipeline"):
            raise
        return {}, {}
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: 12-month rolling trade by direction on sf0.001."""
    return q_roll12_by_direction(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_corpus_operators()[0]}


def oracle_sql() -> dict[str, str]:
    from oracles import ORACLE_SQL
    return {**{k: v for k, v in ORACLE_SQL.items() if k in _QUERIES}, **_corpus_operators()[1]}
