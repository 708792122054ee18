"""Scans: raw landed CSVs, the partitioned Parquet lake, deflator series,
fiscal sheets, and the adapter from the driver's test tables."""
