"""Refresh the billing warehouse from CSV exports; for spark-submit."""

from ledgerline.plans.pipeline import main

if __name__ == "__main__":
    main()
