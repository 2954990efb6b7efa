"""civicloom: a Spark-first analytics engine for provenance-keeping policy-research data."""
