"""Class limits, labels and texts that appear in results."""

# Share of the running total up to which a class reaches, in percent.
ABC_LIMITS = (80, 95)
ABC_PRODUCT_LABELS = ("A", "B", "c")
ABC_LABELS = ("A", "B", "C")

MOVEMENT_NEW = "New this quarter"
MOVEMENT_STABLE = "Stable"
MOVEMENT_UP = "Upgraded"
MOVEMENT_DOWN = "Downgraded"

RANK_NEW = "New / Re-entered"

RFM_CHAMPIONS = "Champions"
RFM_LOYAL = "Loyal Customers"
RFM_NEW = "New / Promising"
RFM_AT_RISK = "At Risk"
RFM_CANT_LOSE = "Cant Lose Them"
RFM_HIBERNATING = "Hibernating / Lost"
RFM_OTHER = "Needs Attention"

ROLLUP_ALL = "ALL_CATEGORIES"
ROLLUP_SUBTOTAL = "subtotal"

CANCELLED = "cancelled"
ONLINE = "online"
PAID_STATUSES = ("completed", "shipped", "delivered")

UNKNOWN_EMPLOYEE_KEY = -1
UNKNOWN_EMPLOYEE_NAME = "Online / No Salesperson"
UNKNOWN_EMPLOYEE_STORE = "N/A"

PASS = "PASS"
FAIL = "*** FAIL ***"
