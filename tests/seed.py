"""The sample rows of the five tables, as fixed values."""

from decimal import Decimal
from datetime import date, datetime

AS_OF = datetime(2024, 1, 1)

CUSTOMERS = [
    ("John", "Smith", "john.smith@email.com", "+1-555-0101", date(2023, 1, 15), "GOLD"),
    ("Jane", "Doe", "jane.doe@email.com", "+1-555-0102", date(2023, 2, 20), "STANDARD"),
    ("Robert", "Johnson", "robert.j@email.com", "+1-555-0103", date(2023, 3, 10), "PLATINUM"),
    ("Emily", "Williams", "emily.w@email.com", "+1-555-0104", date(2023, 4, 5), "GOLD"),
    ("Michael", "Brown", "michael.b@email.com", "+1-555-0105", date(2023, 5, 12), "STANDARD"),
    ("Sarah", "Davis", "sarah.d@email.com", "+1-555-0106", date(2023, 6, 18), "STANDARD"),
    ("David", "Miller", "david.m@email.com", "+1-555-0107", date(2023, 7, 22), "GOLD"),
    ("Lisa", "Wilson", "lisa.w@email.com", "+1-555-0108", date(2023, 8, 30), "PLATINUM"),
    ("James", "Moore", "james.m@email.com", "+1-555-0109", date(2023, 9, 14), "STANDARD"),
    ("Jennifer", "Taylor", "jennifer.t@email.com", "+1-555-0110", date(2023, 10, 25), "GOLD"),
]
CUSTOMER_COLUMNS = ["first_name", "last_name", "email", "phone", "registration_date", "customer_tier"]

# order_id, customer_id, order_status, total_amount
ORDERS = [
    (1, 1, "DELIVERED", Decimal("1199.98")),
    (2, 2, "SHIPPED", Decimal("799.99")),
    (3, 3, "PROCESSING", Decimal("1549.97")),
    (4, 1, "PENDING", Decimal("299.99")),
    (5, 4, "DELIVERED", Decimal("579.98")),
    (6, 5, "CANCELLED", Decimal("199.99")),
    (7, 6, "SHIPPED", Decimal("929.98")),
    (8, 7, "DELIVERED", Decimal("1449.97")),
    (9, 8, "PROCESSING", Decimal("449.99")),
    (10, 9, "PENDING", Decimal("149.98")),
]

# order_id, product_id, quantity, unit_price, total_price
ITEMS = [
    (1, 1, 1, "999.99", "999.99"),
    (1, 4, 1, "199.99", "199.99"),
    (2, 2, 1, "799.99", "799.99"),
    (3, 1, 1, "999.99", "999.99"),
    (3, 3, 1, "499.99", "499.99"),
    (3, 9, 1, "69.99", "69.99"),
    (4, 5, 1, "299.99", "299.99"),
    (5, 4, 1, "199.99", "199.99"),
    (5, 7, 1, "79.99", "79.99"),
    (5, 9, 2, "69.99", "139.98"),
    (5, 8, 1, "129.99", "129.99"),
    (6, 4, 1, "199.99", "199.99"),
    (7, 2, 1, "799.99", "799.99"),
    (7, 8, 1, "129.99", "129.99"),
    (8, 1, 1, "999.99", "999.99"),
    (8, 10, 1, "449.99", "449.99"),
    (9, 10, 1, "449.99", "449.99"),
    (10, 7, 1, "79.99", "79.99"),
    (10, 9, 1, "69.99", "69.99"),
]

# customer_id, total_orders, total_spent
CUSTOMER_UPDATES = [
    (1, 2, "1499.97"),
    (2, 1, "799.99"),
    (3, 1, "1549.97"),
    (4, 1, "579.98"),
    (5, 1, "0.00"),
    (6, 1, "929.98"),
    (7, 1, "1449.97"),
    (8, 1, "449.99"),
    (9, 1, "149.98"),
]
