"""Reusable DataFrame operators: star joins, filters, shares, histograms, reconciliation."""
