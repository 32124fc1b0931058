"""The processing paths: analysis on arrival, of stored batches, incremental, backfill."""
