"""Jobs that read and write tables: ingest, validate, explain, report, and all of them in turn."""
