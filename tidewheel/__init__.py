"""Time-sliced feature vectors from longitudinal event tables, as lazy Spark plans."""
