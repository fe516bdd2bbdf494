"""Reading and writing: delimited and Parquet tables, digests, stages, reports, artefacts."""
