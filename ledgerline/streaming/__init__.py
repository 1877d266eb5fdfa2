"""Refreshes that follow the arrival of new exports."""
