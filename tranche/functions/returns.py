"""Expected-return and ROI expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rate_fraction(rate) -> Column:
    """A rate may arrive as '12.5%' text or as a fraction."""
    r = _col(rate)
    txt = r.cast("string")
    pct = F.regexp_replace(txt, "%", "").try_cast("double") / 100.0
    return F.when(txt.contains("%"), pct).otherwise(txt.try_cast("double"))


def expected_return(rate, p, method: str = "simple", recovery: float = 0.30) -> Column:
    """K2. simple: (1-p)r - p(1-rec); detailed: r(1-p) + p*rec - p (the same
    value algebraically); anything else: r - 2p."""
    r, p = _col(rate), _col(p)
    if method == "simple":
        return (1 - p) * r - p * F.lit(1.0 - recovery)
    if method == "detailed":
        return r * (1 - p) + p * F.lit(recovery) - p
    return r - p * 2


def expected_value(amount, rate, p, method: str = "simple", recovery: float = 0.30) -> Column:
    """Money expected from a loan = amount * expected return."""
    return _col(amount) * expected_return(rate, p, method, recovery)


def instalment_roi(installment, term, principal, defaulted, bad_share: float = 0.30) -> Column:
    """collected = instalment * term (good) or bad_share of it (default);
    ROI = (collected - principal) / principal."""
    full = _col(installment) * _col(term)
    collected = F.when(_col(defaulted) == 1, full * bad_share).otherwise(full)
    return F.when(_col(principal) > 0, (collected - _col(principal)) / _col(principal))
