"""Ordinal and multiclass models: fitted by Spark jobs, scored by column expressions."""
