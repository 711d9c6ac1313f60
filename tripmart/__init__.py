"""Trip and hourly-weather analytics as Spark DataFrame operators."""
