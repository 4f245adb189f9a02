"""Column expressions shared by the batch and the streaming lane."""

from wayfare.functions.columns import (
    driver_tier, exact_mean, is_cancelled, moment, share, surge_multiplier, text_enum,
)

__all__ = [
    "driver_tier", "exact_mean", "is_cancelled", "moment", "share", "surge_multiplier",
    "text_enum",
]
