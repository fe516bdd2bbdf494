"""Whole batch flows: validate, choose a threshold out of fold, refit, score, record."""
