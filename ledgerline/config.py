"""Settings shared by all plans."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class BillingConfig:
    """What the business decides, as opposed to what the data says.

    ``fx_rates`` maps a currency code to its price in the reporting currency. Rates are
    decimals: a float rate would turn every converted amount into a double.
    ``as_of`` replaces today's date in the "lies in the future" tests, so a run can be repeated.
    """

    reporting_currency: str = "EUR"
    fx_rates: dict[str, Decimal] = field(default_factory=lambda: {"SEK": Decimal("0.087")})
    as_of: date | None = None

    @property
    def supported_currencies(self) -> list[str]:
        return [self.reporting_currency, *self.fx_rates]
