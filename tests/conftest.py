import os
import sys

from decimal import Decimal

import pytest
from pyspark.sql.types import DecimalType, _parse_datatype_string

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[*]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows("id bigint, name string", (1, "a"), ...)`` as a DataFrame."""

    def make(schema, *values):
        parsed = _parse_datatype_string(schema)
        money = [isinstance(f.dataType, DecimalType) for f in parsed.fields]
        fit = [tuple(Decimal(v) if m and v is not None else v for v, m in zip(r, money, strict=True)) for r in values]
        return spark.createDataFrame(fit, parsed)

    return make
