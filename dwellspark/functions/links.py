"""Addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute(address: Column, base: str, scheme_relative: bool = True, relative: bool = False) -> Column:
    """The address with scheme and host.

    ``//host/x`` gets ``https:`` (with ``scheme_relative``), ``/x`` the base, and with ``relative`` also what has
    neither a scheme nor a leading slash.
    """
    out = F.when(F.lit(scheme_relative) & address.startswith("//"), F.concat(F.lit("https:"), address))
    out = out.when(address.startswith("/"), F.concat(F.lit(base), address))
    if relative:
        out = out.when(~address.startswith("http"), F.concat(F.lit(base + "/"), address))
    return out.otherwise(address)
