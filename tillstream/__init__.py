"""Payment settlement, risk and billing analytics as Spark DataFrame plans."""
