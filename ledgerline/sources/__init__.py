"""Readers, writers, load reconciliation and the billing projection of the benchmark tables."""
