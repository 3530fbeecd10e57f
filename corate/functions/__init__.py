"""Column functions (scale, deviations, pair keys, safe ratios)."""

from corate.functions.columns import (
    ORDER_DIGITS,
    RANK_DIGITS,
    RATING_MAX,
    RATING_MIN,
    denormalize,
    jaccard,
    normalized_deviation,
    order_key,
    pair_high,
    pair_low,
    rank_key,
    ratio_or_zero,
    round_half_away,
    scale,
    scaled_round,
)

__all__ = [
    "ORDER_DIGITS", "RANK_DIGITS", "RATING_MAX", "RATING_MIN", "denormalize",
    "jaccard", "normalized_deviation", "order_key", "pair_high", "pair_low",
    "rank_key", "ratio_or_zero", "round_half_away", "scale", "scaled_round",
]
