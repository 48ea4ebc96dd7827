"""Column functions with the null, rounding and boundary rules of the warehouse dialect."""

from ledgerloom.functions.checks import check_digit, luhn_valid, with_check_digit
from ledgerloom.functions.scalars import *  # noqa: F403
from ledgerloom.functions.temporal import *  # noqa: F403

__all__ = [n for n in dir() if not n.startswith("_")]
