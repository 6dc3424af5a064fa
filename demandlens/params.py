"""Every threshold, window and list the monitoring jobs use, as one explicit value.

The jobs never read a clock: ``as_of`` is always passed in, so a batch that starts before
midnight and finishes after it still answers for one day.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass
from datetime import date, timedelta

# --- fixed values (must equal the monitored system's conventions) -------------------------
# Replenishment (PPM) types reported as columns, in report order; a missing type is reported as NO_PPM.
PPM_TYPES = ("PD", "ND", "ZK", "ZR", "ZC", "ZD", "NO_PPM")
PPM_DEFAULT = "NO_PPM"
# Store formats checked for adjustment cuts, and the assortment type that is skipped there.
STORE_FORMATS = ("Mahalla", "Supermarket")
AZ_EXCLUDED = ("ND",)
# Store exclusions per job: substring, explicit list, prefixes.
ANTIPEAK_STORE_SUBSTRING = "L"
PEAK_STORE_LIST = ("L001", "L002", "L003", "L005", "L006")
SALES_STORE_PREFIXES = ("L", "R", "B")
# Reference day of the stock snapshot used for PPM counts and recent sales (a single frozen day).
STOCK_REF_DAY = date(2026, 1, 19)
# Label of the grand-total row of the day-by-day sales report.
TOTAL_LABEL = "Итог"
# -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    as_of: date
    # history window [as_of - history_days, as_of - 1], horizon [as_of, as_of + horizon_days]
    history_days: int = 14
    horizon_days: int = 21
    # stock snapshot range (inclusive); None means the single fixed reference day
    stock_ref_from: date | None = None
    stock_ref_to: date | None = None
    ppm_types: tuple[str, ...] = PPM_TYPES
    ppm_default: str = PPM_DEFAULT
    # system antipeaks
    antipeak_ratio: float = 0.4
    min_median: float = 100.0
    antipeak_store_substring: str = ANTIPEAK_STORE_SUBSTRING
    # old peaks
    peak_floor: float = 100.0
    rise_guard: float = 2.0
    rise_lag1: float = 1.8
    rise_default: float = 2.0
    min_abs_rise: float = 10.0
    min_ly_gap: float = 0.5
    peak_store_list: tuple[str, ...] = PEAK_STORE_LIST
    # new peaks
    ratio_min: float = 20.0
    max_floor: float = 10.0
    min_floor: float = 5.0
    # adjustment cuts
    day_total_floor: float = 100.0
    min_stores: int = 40
    cut_pct: float = -50.0
    store_formats: tuple[str, ...] = STORE_FORMATS
    az_excluded: tuple[str, ...] = AZ_EXCLUDED
    # day-by-day sales
    sales_store_prefixes: tuple[str, ...] = SALES_STORE_PREFIXES
    total_label: str = TOTAL_LABEL

    # derived dates ----------------------------------------------------------------------
    @property
    def history_from(self) -> date:
        return self.as_of - timedelta(days=self.history_days)

    @property
    def history_to(self) -> date:
        return self.as_of - timedelta(days=1)

    @property
    def horizon_to(self) -> date:
        return self.as_of + timedelta(days=self.horizon_days)

    @property
    def stock_from(self) -> date:
        return self.stock_ref_from or self.stock_ref_to or STOCK_REF_DAY

    @property
    def stock_to(self) -> date:
        return self.stock_ref_to or self.stock_ref_from or STOCK_REF_DAY

    def day(self, k: int) -> date:
        """The day ``k`` days before ``as_of``."""
        return self.as_of - timedelta(days=k)

    def replace(self, **changes) -> Params:
        return dataclasses.replace(self, **changes)

    @classmethod
    def from_dict(cls, values: dict) -> Params:
        """Build from plain values (e.g. JSON): ISO date strings for the dates, lists for the
        tuples. Unknown names are rejected."""
        fields = {f.name: f for f in dataclasses.fields(cls)}
        unknown = sorted(set(values) - set(fields))
        if unknown:
            raise ValueError(f"unknown parameters: {unknown}")
        out = {}
        for name, v in values.items():
            if name in ("as_of", "stock_ref_from", "stock_ref_to") and isinstance(v, str):
                v = date.fromisoformat(v)
            elif isinstance(v, list):
                v = tuple(v)
            out[name] = v
        return cls(**out)
