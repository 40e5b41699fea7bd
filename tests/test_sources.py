"""Ingest rules: explicit schema, NaN/NA -> missing, missing key dropped,
missing path -> guidance; JSON artifact default."""
import pytest
from pyspark.sql import types as T

from strata.operators.aggregate import entity_table
from strata.sources.tables import DatasetNotFound, read_json_rows, scan_raw
from strata.spec import CohortSpec

SPEC = CohortSpec(entity=("pid",), seq="hour", measures=("HR", "Lactate"), statics=("Age",), row_label="y")
SCHEMA = T.StructType([T.StructField("pid", T.LongType()), T.StructField("hour", T.IntegerType()),
                       T.StructField("HR", T.DoubleType()), T.StructField("Lactate", T.DoubleType()),
                       T.StructField("Age", T.DoubleType()), T.StructField("y", T.IntegerType()),
                       T.StructField("Unit1", T.DoubleType())])


def test_csv_nan_na_and_missing_key(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("pid,hour,HR,Lactate,Age,y,Unit1\n1,1,80,NaN,60,0,1\n1,2,90,NA,60,1,1\n1,3,,2.0,60,0,1\n"
                 ",1,70,1.0,50,1,0\n")
    raw = scan_raw(spark, str(p), SPEC, fmt="csv", schema=SCHEMA)
    assert "Unit1" not in raw.columns and raw.count() == 3
    r = entity_table(raw, SPEC).first()
    assert (r.HR_max, r.HR_mean, r.Lactate_mean, r.Lactate_std, r.y if hasattr(r, "y") else r.label) == \
        (90.0, 85.0, 2.0, None, 1)


def test_missing_path_has_guidance(spark, tmp_path):
    with pytest.raises(DatasetNotFound, match="Dataset not found"):
        scan_raw(spark, str(tmp_path / "nope.parquet"), SPEC)


def test_absent_artifact_is_empty(spark, tmp_path):
    df = read_json_rows(spark, str(tmp_path / "none"), T.StructType([T.StructField("a", T.LongType())]))
    assert df.count() == 0 and df.columns == ["a"]
