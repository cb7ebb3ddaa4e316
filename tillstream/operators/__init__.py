"""DataFrame operators: ``DataFrame -> DataFrame``."""
