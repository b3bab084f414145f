"""Readers and writers: driver parquet tables, fixture views, TSV files, text folders, run parameters."""
