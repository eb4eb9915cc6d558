import math
import os
import tempfile

import pytest
from conftest import rows

from seriesflow.sources.tables import read_csv, require_columns


def test_csv_with_declared_schema(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="seriesflow-csv-"), "daily.csv")
    with open(path, "w") as f:
        f.write("date,price,demand\n2024-01-01,1.5,10\n2024-01-02,NaN,11\nbad,2.5,\n")
    df = read_csv(spark, path, "date date, price double, demand int")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["date", "double", "int"]
    got = rows(df, "price", "demand")
    assert got == [(1.5, 10), (None, 11), (2.5, None)] and not any(p is not None and math.isnan(p) for p, _ in got)
    assert df.where("date is null").count() == 1
    assert require_columns(df, "date", "price") is df
    with pytest.raises(ValueError, match="stock"):
        require_columns(df, "date", "stock")
