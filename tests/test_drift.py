"""Fields whose types drift, samples of whole files, errors of a model."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import delivery_model, select
from tidemark.sources import change_log, drift


def write_days(spark, root, days):
    for day, lines in days.items():
        text = [(x if isinstance(x, str) else json.dumps(x),) for x in lines]
        path = f"{change_log.change_log_path(root, 'orders')}/dt={day}"
        spark.createDataFrame(text, "value string").coalesce(1).write.text(path)


def image(lsn, after, before=None, op="u"):
    return {"op": op, "source": {"lsn": lsn}, "before": before, "after": after}


@pytest.fixture
def drifted(spark, tmp_path):
    root = str(tmp_path)
    days = {
        "2024-01-01": [image(1, {"id": 1, "a": 1, "gone": True, "n": None}), "null"],
        "2024-01-02": [image(2, {"id": 2, "a": 2.5, "n": 7}), image(3, None, {"id": 1, "a": 9}, "d")],
        "2024-01-04": [image(4, {"id": "x", "a": 3, "n": 1e30, "it's [odd]?": {"k": [1]}, "op": "own"})],
        "2024-01-05": [image(5, {"id": "y", "a": 4, "n": 2, "gone": False}), image(6, {"id": 5}), image(7, None)],
    }
    write_days(spark, root, days)
    return root


def test_drift_is_listed_by_day(spark, drifted):
    types = drift.field_types(drift.variant_log(spark, drifted, "orders"))
    found = {(str(r.dt)[-2:], r.field, r.change, r.previous_type, r.type) for r in drift.schema_drift(types).collect()}
    first = {("01", f, "added", None, t) for f, t in (("id", "bigint"), ("a", "bigint"), ("gone", "boolean"), ("n", "void"))}
    odd = "it's [odd]?"
    assert found == first | {
        ("02", "a", "widened", "bigint", "double"),
        ("02", "n", "widened", "void", "bigint"),
        ("02", "gone", "lost", "boolean", None),
        ("04", "id", "changed", "bigint", "string"),
        ("04", "a", "narrowed", "double", "bigint"),
        ("04", "n", "widened", "bigint", "double"),
        ("04", odd, "added", None, "object<k: array<bigint>>"),
        ("04", "op", "added", None, "string"),
        ("05", "id", "changed", "string", "variant"),
        ("05", "n", "narrowed", "double", "bigint"),
        ("05", "gone", "added", None, "boolean"),
        ("05", odd, "lost", "object<k: array<bigint>>", None),
        ("05", "op", "lost", "string", None),
    }


def test_drifted_changes_take_the_widest_type(spark, drifted):
    found = drift.read_drifted_changes(spark, drifted, "orders")
    assert dict(found.dtypes) == {
        "dt": "date", "op": "string", "lsn": "bigint", "id": "string", "a": "double", "gone": "boolean", "n": "double",
        "it's [odd]?": "string", "op_": "string",
    }
    rows = {r.lsn: r for r in found.collect()}
    assert len(rows) == 7 and rows[3].op == "d"
    assert [(rows[i].id, rows[i].a, rows[i].n, rows[i].gone) for i in range(1, 8)] == [
        ("1", 1.0, None, True), ("2", 2.5, 7.0, None), ("1", 9.0, None, None), ("x", 3.0, 1e30, None),
        ("y", 4.0, 2.0, False), ("5", None, None, None), (None, None, None, None),
    ]
    assert json.loads(rows[4]["it's [odd]?"]) == {"k": [1]} and rows[4].op_ == "own"


def test_a_line_that_is_no_json_fails(spark, tmp_path):
    write_days(spark, str(tmp_path), {"2024-01-01": ['{"op": "c", ']})
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        drift.variant_log(spark, str(tmp_path), "orders").collect()


def test_a_log_without_images_has_no_fields(spark, tmp_path):
    write_days(spark, str(tmp_path), {"2024-01-01": ["null", "{}", "[1]"]})
    types = drift.field_types(drift.variant_log(spark, str(tmp_path), "orders"))
    assert types.count() == drift.schema_drift(types).count() == 0
    assert drift.read_drifted_changes(spark, str(tmp_path), "orders").columns == ["dt", "op", "lsn"]


def files_read(df):
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numFiles").value()


def test_files_that_are_not_drawn_stay_closed(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4000).repartition(40).write.parquet(path)
    table = spark.read.parquet(path)
    drawn = select.sample_files(table, 25, seed=3)
    names = {r[0] for r in drawn.select("_metadata.file_name").distinct().collect()}
    whole = table.groupBy("_metadata.file_name").count().collect()
    assert drawn.count() == sum(n for name, n in whole if name in names)
    assert 0 < files_read(drawn) == len(names) < 25 and files_read(table) == 40
    assert {r.id for r in drawn.collect()} == {r.id for r in select.sample_files(spark.read.parquet(path), 25, seed=3).collect()}
    assert select.sample_files(table, 100, seed=3).count() == 4000 and select.sample_files(table, 0, seed=3).count() == 0


def test_prediction_error(spark):
    scored = spark.createDataFrame([("a", 10.0, 12.0), ("b", 20.0, 19.0), ("c", None, 5.0)], "order_id string, delivery_hours double, predicted_hours double")
    n, mean_error, rmse, r2 = delivery_model.prediction_error(scored).first()
    assert (n, mean_error) == (2, 0.5) and rmse == pytest.approx(2.5**0.5) and r2 == pytest.approx(0.9)
    assert tuple(delivery_model.prediction_error(scored.where("order_id = 'a'")).first())[3] is None
    assert tuple(delivery_model.prediction_error(scored.where(F.lit(False))).first()) == (0, None, None, None)
