"""Transaction monitoring on Spark: change log, current state, rules, alerts, dashboards."""
