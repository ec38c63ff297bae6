"""Business rules of the pipeline, as data.

Every threshold, label and list below is a fixed value of the pipeline's
semantics; results depend on them exactly. The operators turn these lists into
``CASE WHEN`` chains (first match wins, in list order).
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Statuses an order may end in.
VALID_STATUSES = ("DELIVERED", "CANCELLED", "RETURNED")

# Data-quality rules, evaluated in this order; the first match is the flag.
# (flag, column, operator, threshold); the status rule is handled separately.
DQ_RULES = (
    ("INVALID_AMOUNT", "order_amount", "<=", 0),
    ("NEGATIVE_FINAL", "final_amount", "<", 0),
    ("EXCESS_DELIVERY_TIME", "delivery_time_minutes", ">", 180),
    ("INVALID_RATING", "rating", ">", 5),
)
UNKNOWN_STATUS_FLAG = "UNKNOWN_STATUS"
OK_FLAG = "OK"

# Columns whose NULLs become 0.0 before anything else.
FILL_ZERO_COLUMNS = ("rating", "discount_amount", "tip_amount")

# Delivery speed bands: minutes <= bound -> label; anything else (NULL too) SLOW.
SPEED_BANDS = ((30, "FAST"), (60, "MEDIUM"))
SPEED_OTHERWISE = "SLOW"

# Final amount from which an order is high value.
HIGH_VALUE_FROM = 1000

# Day-of-week numbers (1 = Sunday ... 7 = Saturday) that are weekend days.
WEEKEND_DAYS = (1, 7)

# Time zone of the silver load time column.
LOAD_TIME_ZONE = "Asia/Kolkata"

# Recency (days since last order) -> score; anything older scores 1.
RECENCY_SCORES = ((7, 5), (30, 4), (60, 3), (120, 2))
RECENCY_OTHERWISE = 1

# Number of tiles for the frequency and monetary scores.
RFM_TILES = 5

# RFM score -> segment; first threshold reached wins.
RFM_SEGMENTS = ((13, "Champion"), (10, "Loyal"), (7, "Potential"), (5, "At Risk"))
RFM_OTHERWISE = "Lost"

# Top customers: dense rank cut-off (ties at the cut-off are all kept).
TOP_CUSTOMERS = 100

# Partner tiers: STAR needs both rating and time; then rating alone decides.
STAR_MIN_RATING = 4.5
STAR_MAX_MINUTES = 30
PARTNER_TIERS = ((4.0, "EXCELLENT"), (3.5, "GOOD"))
PARTNER_OTHERWISE = "POOR"
STAR_TIER = "STAR"

# Month label format.
MONTH_FORMAT = "yyyy-MM"
# ---------------------------------------------------------------------------

# Our own definitions (documented-only marts, rejects of the raw scan).
# Meal periods by hour of the order timestamp (inclusive ranges).
MEAL_PERIODS = ((5, 10, "BREAKFAST"), (11, 15, "LUNCH"), (16, 18, "SNACKS"),
                (19, 22, "DINNER"))
MEAL_OTHERWISE = "LATE_NIGHT"
# Flag of a raw record with a value that could not be parsed.
MALFORMED_FLAG = "MALFORMED"
