"""Hand-made frames and settings the tests share."""

from __future__ import annotations

from datetime import datetime

# Hand-made sales (FIXTURES.md)
F1_ROWS = [("2024-01-15", "P001", 10.0, 25.50, 0.10, 229.50),
           ("2024-01-15", "P002", 5.0, 100.00, 0.00, 500.00),
           ("2024-01-16", "P001", 8.0, 25.50, 0.05, 193.80),
           ("2024-01-16", "P003", 12.0, 75.25, 0.15, 767.55)]
SALES_DDL = ("date string, product_id string, quantity double, unit_price double, discount double, "
             "total_sales double")

AS_OF = datetime(2024, 2, 1)
