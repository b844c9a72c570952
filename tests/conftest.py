import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart import schemas  # noqa: E402
from starmart.session import get_spark  # noqa: E402
from starmart.sources.warehouse import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark(4, shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="starmart-test-")


@pytest.fixture()
def new_wh(spark, tmpdir_path):
    def make(name="wh"):
        return Warehouse(spark, f"{tmpdir_path}/{name}").create()
    return make


def raw_customers(spark, rows):
    """rows: (id, gender, age, occupation, city, stay, marital) as text."""
    return spark.createDataFrame(rows, schemas.CUSTOMER_RAW)


def raw_products(spark, rows):
    """rows: (id, category, price, storeID, storeName, supplierID, supplierName) as text."""
    return spark.createDataFrame(rows, schemas.PRODUCT_RAW)


def raw_tx(spark, rows):
    """rows: (orderID, Customer_ID, Product_ID, quantity, date) as text."""
    return spark.createDataFrame(rows, schemas.TRANSACTION_RAW)


CUSTOMERS = [
    ("C1", "F", "26-35", "4", "A", "1", "0"),
    ("C2", "M", "36-45", "7", "B", "2", "1"),
    ("C3", "F", "26-35", "4", "C", "4+", "1"),
]
PRODUCTS = [
    ("P1", "Grocery", "10.50", "S1", "Store One", "U1", "Supplier One"),
    ("P2", "Toys", "3.25", "S1", "Store One", "U2", "Supplier Two"),
    ("P3", "Grocery", "100.00", "S2", "Store Two", "U1", "Supplier One"),
]
