"""Ordered frame series, pixel masks, registries and dataset splits as Spark jobs."""
