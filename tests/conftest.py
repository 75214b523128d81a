import datetime

import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "4g")
    yield session
    session.stop()


def day(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text)


DAYS = {n: day(f"2026-06-{7 * n:02d}") for n in (1, 2, 3, 4)}

# Twenty-six orders of the users U01 to U20, some at the same instant, with quarters as the smallest coin.
ORDER_ROWS = [
    (f"O{n:02d}", f"U{(n * 7) % 20 + 1:02d}", DAYS[(n * n + n // 3) % 4 + 1], 5.25 + 13.5 * ((n * 11) % 17))
    for n in range(1, 27)
]

# U01 to U24, the last of them without orders, in four cities of different size.
CITIES = {f"U{n:02d}": "Oslo Turin Lima Quito".split()[(n * n + n // 5) % 4] for n in range(1, 25)}

# Order lines (item, order, product, user, quantity): some orders have several products.
ITEM_ROWS = [(f"I{n:02d}", f"O{(n * 5) % 18 + 1:02d}", f"P{n * n % 5 % 3 + 1}", f"U{n % 9 + 1:02d}", 1 + n * 3 % 4) for n in range(1, 26)]
ITEM_PRICES = [1.5 * (n % 6) + 2.25 for n in range(1, 26)]


@pytest.fixture
def orders(spark):
    schema = "order_id string, user_id string, order_date timestamp, total_amount float"
    return spark.createDataFrame(ORDER_ROWS, schema)


@pytest.fixture
def users(spark):
    return spark.createDataFrame(list(CITIES.items()), "user_id string, city string")


@pytest.fixture
def order_items(spark):
    rows = [(*row, price, price * row[4]) for row, price in zip(ITEM_ROWS, ITEM_PRICES)]
    schema = (
        "order_item_id string, order_id string, product_id string, user_id string, "
        "quantity int, item_price double, item_total double"
    )
    return spark.createDataFrame(rows, schema)
