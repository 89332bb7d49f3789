"""Settings of a run: every date, window, status and threshold is an argument."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

KEY = ["tin", "providerid"]
ROW_KEY = KEY + ["date_start", "date_end"]

# Status names, product lines and contact reasons as they appear in
# the source tables.
VALID_STATUSES = ("Processed - Paid", "Processing - Out for payment")
PAID_STATUS = "Processed - Paid"
CANCELLED_STATUS = "Cancelled"
PRODUCT_LINES = {
    "check": "Check",
    "vcc": "VCC",
    "ach": "ACH+",
    "payersponsored": "PayerSponsoredACH",
    "reversal": "ACH Reversal",
}
CALL_ACTION = "Disposition"
CALL_REASONS = (
    "1099 Request",
    "Assisted with Registration",
    "Cancel Check",
    "EOP Discrepancy",
    "Escalation",
    "Escheatment",
    "Exclusion Request",
    "Member",
    "New Check Issued",
    "Not receiving Remits",
    "Payer List Request",
    "Payment Already Processed",
    "Provisioning Request",
    "Referred Provider to Payer",
    "Resent EOP",
    "Stop Payment",
)
FEE_NOTE_PATTERNS = ("%fee%", "%want to pay to be paid%")
CONFUSED_NOTE_PATTERNS = ("%understand%", "%agree to product%")


@dataclass(frozen=True)
class Settings:
    """One run of the training-table build or of the scoring job."""

    as_of: dt.date
    created_from: dt.date = dt.date(2012, 1, 1)
    spine_start: dt.date = dt.date(2022, 1, 1)
    spine_end: dt.date = dt.date(2026, 2, 1)
    spine_days: tuple[int, ...] = (1, 15)
    horizon_days: int = 30
    min_duration: int = 90
    trailing_days: tuple[int, ...] = (30, 60, 90)
    optout_lookback_days: int = 365
    min_amount: float = 1.0
    focus_payer: str = "7376"
    # Call reasons named after the operating organisation's own teams and portals are
    # supplied by the caller.
    house_call_reasons: tuple[str, ...] = ()
    sponsored_status_id: int = 31
    sponsored_product_id: int = 3

    def __post_init__(self) -> None:
        if max(self.trailing_days) > self.min_duration:
            raise ValueError(
                "trailing windows must lie inside the spell: "
                f"max(trailing_days)={max(self.trailing_days)} > min_duration={self.min_duration}"
            )
        if not self.spine_days or not all(1 <= d <= 28 for d in self.spine_days):
            raise ValueError("spine_days must be days of month between 1 and 28")

    @property
    def call_reasons(self) -> tuple[str, ...]:
        return CALL_REASONS + self.house_call_reasons


FIXTURE_SETTINGS = Settings(
    as_of=dt.date(2001, 12, 31),
    created_from=dt.date(1994, 1, 1),
    spine_start=dt.date(1995, 6, 1),
    spine_end=dt.date(2000, 12, 31),
    focus_payer="37",
)
