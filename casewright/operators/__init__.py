"""DataFrame operators: data quality, profiling, features, metrics, decisions, explanation."""
