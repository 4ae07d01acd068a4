import json
import sys
from pathlib import Path

import pytest
from pyspark.sql.readwriter import DataFrameWriter

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.session import local_session  # noqa: E402
from tallywell.settings import JdbcTarget  # noqa: E402
from tallywell.sinks import jdbc  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        2,
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        # on so few rows compiling takes longer than running
        spark__sql__codegen__wholeStage="false",
    )
    yield session
    session.stop()


TARGET = JdbcTarget("jdbc:postgresql://db/shop", "me", "secret", batch_rows=500, connections=4)


@pytest.fixture
def writes(monkeypatch):
    """JDBC writes as told to Spark's writer; nothing is sent, there is no database."""
    made = []

    def note(name):
        original = getattr(DataFrameWriter, name)

        def noted(self, *args):
            self.__dict__.setdefault("told", {})[args if name == "mode" else args[0]] = args[-1]
            return original(self, *args)

        return noted

    def sent(self, url, table, mode=None, properties=None):
        made.append({"url": url, "table": table, "told": self.told, "properties": properties,
                     "rows": self._df.collect(), "types": dict(self._df.dtypes)})

    monkeypatch.setattr(DataFrameWriter, "mode", note("mode"))
    monkeypatch.setattr(DataFrameWriter, "option", note("option"))
    monkeypatch.setattr(DataFrameWriter, "jdbc", sent)
    return made


@pytest.fixture
def statements(monkeypatch):
    """Statements told to the database; there is none to run them."""
    made = []
    monkeypatch.setattr(jdbc, "execute", lambda session, target, told: made.append(told))
    return made


TRANSACTION = {
    "transaction_id": "T", "client_id": "C", "product_id": "P", "quantity": 3,
    "unit_price": 1.5, "total_amount": 9.99, "currency": " usd ",
    "payment_method": " PayPal", "status": "Completed ",
    "transaction_time": "2024-01-01T00:00:00Z",
}
CLIENT = {
    "client_id": "C", "first_name": " o'BRIEN mary-ann ", "last_name": "SMITH",
    "email": " A@B ", "country": " France ", "city": "Nice ", "age": 13,
    "segment": "VIP", "registered_at": "2020-02-03T04:05:06Z",
}
PRODUCT = {
    "product_id": "P", "name": " Brick ", "category": "toys", "sub_category": "LEGO",
    "brand": " FunFactory ", "price": 9.999, "weight_kg": 1.23456, "rating": 3.456,
    "stock": 0,
}
BASES = {"transactions": TRANSACTION, "clients": CLIENT, "products": PRODUCT}


def message(topic, drop=(), **changes):
    """A good message of the topic with some fields changed or dropped."""
    body = {**BASES[topic], **changes}
    return json.dumps({k: v for k, v in body.items() if k not in drop})


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()
