"""Currency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import whole

# Fixed value: the euro's official rate in leva.
BGN_PER_EUR = 1.95583


def to_eur(amount: Column, currency: Column | str) -> Column:
    """Whole euros; leva are converted, any other currency is taken as euros."""
    currency = F.lit(currency) if isinstance(currency, str) else currency
    return F.when(currency == "BGN", whole(amount / F.lit(BGN_PER_EUR))).otherwise(whole(amount))
