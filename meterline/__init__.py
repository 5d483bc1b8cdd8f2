"""Batch analytics for metered trips, written as composable Spark jobs."""
