"""tradelake: foreign-trade statistics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark's own
expressions, aggregates, joins and windows. Nothing is collected to the
driver inside an operator; the caller triggers the action.

User-facing functions, by role:
  read an official table ........ read_table, read_control
  open the lake ................. open_ncm, open_hs4
  land -> stage -> check -> switch  ingest, rewrite (publish, vacuum), publish_lake for a plain folder
  what has landed ............... landing_manifest
  keep aggregates fresh ......... refresh_states, read_states, merge_states
  check against control totals .. reconcile
  sum measures by prefix ........ sum_prefixed
  calendar rolling sums ......... roll_months (and roll_rows)
  deflator table ................ build_deflators (price_index, monthly_mid_rate), persist_deflators, series_state
  raw sheets, numbered lines .... read_raw_sheet, numbered_lines
  deflate and convert ........... deflate
  clean product codes ........... clean_code, check_codes
  merge code tables ............. merge_lookups
"""

from tradelake.functions.codes import check_codes, clean_code
from tradelake.functions.nulls import nsum, ratio
from tradelake.operators.aggregate import sum_prefixed
from tradelake.operators.checks import missing_partitions, reconcile
from tradelake.operators.deflate import deflate
from tradelake.operators.deflator_store import persist_deflators, series_state, stored_deflators
from tradelake.operators.deflators import build_deflators, deflator_report, monthly_mid_rate, price_index
from tradelake.operators.lookups import merge_lookups, partner_labels
from tradelake.operators.rolling import roll_months, roll_rows
from tradelake.plans.ingest import ingest, publish_lake, rewrite
from tradelake.plans.publish import publish, vacuum
from tradelake.plans.states import merge_states, read_states, refresh_states
from tradelake.sources.lake import lake_years, open_hs4, open_ncm
from tradelake.sources.lines import numbered_lines, read_raw_sheet
from tradelake.sources.manifest import landing_manifest
from tradelake.sources.trade_csv import file_counts, read_control, read_hs4_raw, read_ncm_raw, read_table

__all__ = [
    "read_table", "read_control", "read_ncm_raw", "read_hs4_raw", "file_counts", "open_ncm", "open_hs4", "lake_years",
    "landing_manifest", "numbered_lines", "read_raw_sheet", "publish", "vacuum", "refresh_states", "read_states", "merge_states",
    "persist_deflators", "stored_deflators", "series_state",
    "ingest", "publish_lake", "rewrite", "reconcile", "missing_partitions",
    "sum_prefixed", "roll_months", "roll_rows", "build_deflators", "price_index", "monthly_mid_rate",
    "deflator_report", "deflate", "clean_code", "check_codes", "merge_lookups", "partner_labels", "nsum", "ratio",
]
