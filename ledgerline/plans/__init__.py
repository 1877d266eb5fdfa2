"""The data products: classified rows, staging, quarantine, marts, checks and profiles."""
