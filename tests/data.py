"""Small inputs shared by tests."""

from datetime import date, timedelta

from swellmark.fixed import ROUTE

# --- fixed values: the weekly price fixture ---
WEEK_PRICES = [
    1000, 1050, 1100, 1200, 1350, 1400, 1450, 1660, 2500,
    4000, 5000, 6000, 7500, 8200, 8500, 8000, 7800,
]

PRICES = [
    (str(date(2023, 10, 19) + timedelta(weeks=i)), ROUTE, float(p)) for i, p in enumerate(WEEK_PRICES)
]
