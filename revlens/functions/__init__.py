"""Column functions: scalar helpers, buckets, flags, keys."""

from revlens.functions.scalar import *  # noqa: F401,F403
from revlens.functions.scalar import (  # noqa: F401
    bucketize, category_health, count_if, engagement_bucket, flag, has_votes, is_null_or_zero,
    is_trusted, is_weekend, parse_price, pct, preview, price_bucket, rating_consistency,
    rating_delta, review_length_bucket, review_volume_bucket, reviewer_tendency, round_half_away,
    safe_divide, sentiment_from_rating, stddev_from_moments, stddev_samp_int, surrogate_key, text_length, to_int, word_count_approx,
)
