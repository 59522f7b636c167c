"""The models: staging, metrics, marts, incremental refresh, quality, backfill and audit."""
