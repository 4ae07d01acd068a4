from .money import MONEY, average, exact_amount, inexact_amount, revenue
from .text import has_text, lower_text, title_text, upper_text
from .time import as_timestamp

__all__ = [
    "MONEY",
    "as_timestamp",
    "average",
    "exact_amount",
    "has_text",
    "inexact_amount",
    "lower_text",
    "revenue",
    "title_text",
    "upper_text",
]
