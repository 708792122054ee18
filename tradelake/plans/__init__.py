"""Compositions of operators: report queries and the ingest job."""
