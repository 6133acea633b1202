"""Column functions that judge the outcome of a fetch attempt."""

from __future__ import annotations

from collections.abc import Iterable
from http import HTTPStatus

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public defaults of the retry policy.
RETRY_CAP = 2
PRIORITY_STEP = -1
RETRY_CODES = (500, 502, 503, 504, 522, 524, 408, 429)
# Failures that evict an endpoint, and pool size limits.
EVICT_AT = 8
REFILL_BELOW = 30
PAUSE_BELOW_REQUEST = 20
PAUSE_BELOW_FAILURE = 30


def is_ok(status: Column) -> Column:
    """Only 200 counts as success; redirects are failures too."""
    return F.coalesce(status == 200, F.lit(False))


def is_retryable(
    status: Column,
    exception: Column,
    codes: Iterable[int] = RETRY_CODES,
    classes: Iterable[str] = (),
) -> Column:
    """A failure whose status is in ``codes`` or whose exception class is listed."""
    by_status = F.coalesce(status.isin(*codes), F.lit(False))
    by_class = F.coalesce(exception.isin(*classes), F.lit(False))
    return by_status | by_class


def retryable(flag: Column) -> Column:
    """A ``dont_retry`` flag takes the row out; no flag means it may retry."""
    return ~F.coalesce(flag, F.lit(False))


def reason_of(status: Column, exception: Column) -> Column:
    """Exception class when there is one, else ``<code> <phrase>``."""
    phrases = F.str_to_map(
        F.lit("\x1e".join(f"{s.value}\x1f{s.phrase}" for s in HTTPStatus)),
        F.lit("\x1e"),
        F.lit("\x1f"),
    )
    code = status.cast("string")
    phrase = F.coalesce(F.element_at(phrases, code), F.lit("Unknown Status"))
    return F.coalesce(exception, F.concat(code, F.lit(" "), phrase))
