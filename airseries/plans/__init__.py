"""Ready-made plans: readings to clean table, to feature table, to scored models."""
