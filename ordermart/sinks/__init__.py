"""Sinks: overwrite/partitioned/table writes, publish, manifest."""
