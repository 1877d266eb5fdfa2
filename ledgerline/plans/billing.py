"""All tables of the billing warehouse under (layer, name), each built when first asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ledgerline.config import BillingConfig
from ledgerline.plans import classify, marts, quarantine, staging

Loader = Callable[[str], DataFrame]
Keeper = Callable[[str, DataFrame], DataFrame]

ENTITIES = ["customers", "subscriptions", "invoices"]
MARTS = ["mrr_monthly", "customer_ltv", "churn_monthly"]
LAYERS = {"raw": ENTITIES, "staging": ENTITIES, "quarantine": ENTITIES, "marts": MARTS}


class Billing:
    """``raw`` loads a raw table by name.

    ``keep`` is given the name and the plan of every classified table and returns what the
    later layers read, for example a written copy. Without it all plans are composed into one
    query, which suits a single mart; jobs that read many tables should keep them.
    """

    def __init__(self, raw: Loader, config: BillingConfig, keep: Keeper | None = None):
        self.config = config
        self._raw = raw
        self._keep = keep
        self._tables: dict[tuple[str, str], DataFrame] = {}

    def keeping(self, keep: Keeper) -> Billing:
        """The same tables over kept classified ones."""
        return Billing(self._raw, self.config, keep)

    def set_table(self, layer: str, name: str, rows: DataFrame) -> None:
        """Read ``rows`` from now on instead of building the table."""
        self._tables[layer, name] = rows

    def table(self, layer: str, name: str) -> DataFrame:
        if (layer, name) not in self._tables:
            self._tables[layer, name] = getattr(self, f"_build_{layer}")(name)
        return self._tables[layer, name]

    def _build_raw(self, name: str) -> DataFrame:
        return self._raw(name)

    def _build_classified(self, name: str) -> DataFrame:
        raw = self.table("raw", name)
        if name == "customers":
            rows = classify.classify_customers(raw, self.config)
        elif name == "subscriptions":
            rows = classify.classify_subscriptions(raw, self.table("staging", "customers"))
        else:
            rows = classify.classify_invoices(
                raw, self.table("staging", "subscriptions"), self.config
            )
        return rows if self._keep is None else self._keep(name, rows)

    def _build_judged(self, name: str) -> DataFrame:
        if self._keep is not None or name == "invoices":
            return self.table("classified", name)
        raw = self.table("raw", name)
        if name == "customers":
            return classify.judge_customers(raw, self.config)
        return classify.judge_subscriptions(raw, self.table("staging", "customers"))

    def _build_staging(self, name: str) -> DataFrame:
        rows = self.table("judged", name)
        if name == "customers":
            return staging.stage_customers(rows)
        if name == "subscriptions":
            return staging.stage_subscriptions(rows)
        return staging.stage_invoices(rows, self.config)

    def _build_quarantine(self, name: str) -> DataFrame:
        return quarantine.quarantine(name, self.table("classified", name))

    def _build_marts(self, name: str) -> DataFrame:
        if name == "mrr_monthly":
            return marts.mrr_monthly(self.table("classified", "invoices"))
        if name == "churn_monthly":
            return marts.churn_monthly(self.table("staging", "subscriptions"))
        return marts.customer_ltv(
            self.table("staging", "customers"),
            self.table("staging", "subscriptions"),
            self.table("classified", "invoices"),
        )
