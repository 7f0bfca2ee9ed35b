"""Event analytics on Spark: ingest, live counters, snapshots, alerts, lake and reports over a feed of page changes."""
