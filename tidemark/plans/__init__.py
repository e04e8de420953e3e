"""Whole jobs: landing tables, weekly features, news, risk, models, scenarios, registry."""
