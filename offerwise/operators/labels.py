"""How a customer answered a purchase's expiry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerwise.functions import safe_ratio

# Outcome codes and the grace period, in days after expiry.
ACCEPT, DOWNGRADE, CHURN = 0, 1, 2
GRACE_DAYS = 15


def customer_action(as_of: dt.date | str, grace_days: int = GRACE_DAYS) -> Column:
    """Outcome of a purchase, from the columns `with_history` adds.

    Renewed within the grace period: accept if the daily revenue held or grew,
    downgrade if it fell. Renewed later, or not at all although the grace
    period is over on `as_of`: churn. Otherwise NULL: not known yet. A renewal
    before expiry counts as within the grace period.
    """
    days_late = F.datediff("next_purchasedate", "expirationdate")
    renewed_in_time = days_late <= grace_days
    now = safe_ratio(F.col("price"), F.col("duration"))
    after = safe_ratio(F.col("next_price"), F.col("next_duration"))
    grace_over = F.date_add("expirationdate", grace_days) < F.lit(as_of).cast("date")
    never_renewed = F.col("next_purchasedate").isNull()
    return (
        F.when(renewed_in_time & (after >= now), ACCEPT)
        .when(renewed_in_time & (after < now), DOWNGRADE)
        .when((days_late > grace_days) | (never_renewed & grace_over), CHURN)
        .cast("int")
    )
