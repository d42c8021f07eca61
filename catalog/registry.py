"""All registered queries by name."""

from __future__ import annotations

from . import checks, landing, network, published, reports, series, views
from .case import Case

CASES: dict[str, Case] = {**series.CASES, **network.CASES, **reports.CASES, **views.CASES, **checks.CASES, **landing.CASES, **published.CASES}
