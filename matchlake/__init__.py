"""Match-results analytics on Spark: raw CSV -> bronze -> silver -> mart -> KPIs and checks."""
