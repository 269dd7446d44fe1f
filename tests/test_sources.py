"""CSV/Parquet transaction scan, schema alignment, missing paths."""

import os
import tempfile

import pytest

from rarefy.operators.models import load_model
from rarefy.sources.tables import CONTRACT, align_schema, scan_transactions


def test_scan_csv_with_fixed_schema(spark):
    d = tempfile.mkdtemp()
    path = os.path.join(d, "tx.csv")
    header = ",".join(CONTRACT + ["Class"])
    rows = [",".join(["1.5"] + ["0.1"] * 28 + ["12.25", "0"]),
            ",".join(["7200"] + ["-0.2"] * 28 + ["3.0", "1"])]
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")
    df = scan_transactions(spark, path)
    assert df.schema["Amount"].dataType.simpleString() == "double"
    assert df.schema["Class"].dataType.simpleString() == "int"
    assert df.count() == 2 and "row_id" in df.columns


def test_missing_paths_raise(spark):
    with pytest.raises(FileNotFoundError):
        scan_transactions(spark, "/nonexistent/transactions.csv")
    with pytest.raises(FileNotFoundError):
        load_model("/nonexistent/model")


def test_align_schema_adds_missing_as_zero(spark):
    df = spark.createDataFrame([(1, 10.0, 5.0, 0)], "row_id long, Time double, Amount double, Class int")
    out = align_schema(df)
    assert out.columns == ["row_id", "Class"] + CONTRACT
    r = out.first()
    assert r["V1"] == 0.0 and r["V28"] == 0.0 and r["Amount"] == 5.0
