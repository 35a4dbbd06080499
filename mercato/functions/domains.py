"""Fixed values that must equal the source data model's vocabularies.

These are plain data, listed in their natural order.
"""

# Transaction statuses.
TRANSACTION_STATUSES = ["completed", "processing", "shipped", "delivered"]

# Payment methods (session-born and standalone purchases).
PAYMENT_METHODS = ["credit_card", "paypal", "apple_pay", "crypto",
                   "bank_transfer", "gift_card"]

# Session outcome.
CONVERSION_STATUSES = ["converted", "abandoned", "browsed"]

# Traffic source of a session.
REFERRERS = ["direct", "email", "social", "search_engine", "affiliate"]

# Device classes.
DEVICE_TYPES = ["mobile", "desktop", "tablet"]

# Order-count buckets of the user segmentation
# (lower bounds, with the label of each bucket); the last bound closes the
# final bucket and anything outside goes to the default label.
SEGMENT_BOUNDS = [0, 1, 3, 6, 11, 100000]
SEGMENT_LABELS = ["0 orders (never purchased)", "1-2 orders", "3-5 orders",
                  "6-10 orders", "11+ orders"]
SEGMENT_DEFAULT = "11+"

# CLV weights.
ENGAGEMENT_WEIGHTS = {"sessions": 0.4, "minutes": 0.3, "conversion": 0.3}
CLV_WEIGHTS = {"spent": 0.60, "orders": 0.20, "engagement": 0.20}
CLV_TIER_QUANTILES = [0.25, 0.50, 0.75]
CLV_TIERS = ["Premium", "High Value", "Medium Value", "Low Value"]

# Chart label cut.
LABEL_MAX_CHARS = 28
LABEL_ELLIPSIS = "..."
