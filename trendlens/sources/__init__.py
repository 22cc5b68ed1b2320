"""Readers and writers: regional CSV + category-lookup JSON scans, stage
tables, CSV / metrics sinks (survey S1-S10)."""
