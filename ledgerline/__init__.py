"""Billing analytics on Spark: clean, route, reconcile and summarise subscription billing."""

from ledgerline.config import BillingConfig

__all__ = ["BillingConfig"]
