"""Column functions: ``Column -> Column``, built from Spark built-ins only."""
