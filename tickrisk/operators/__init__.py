"""DataFrame -> DataFrame operators: ticks, scans, statistics, metrics,
weights, point tables and joins (batch; most also run on streams)."""
