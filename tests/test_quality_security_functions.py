import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidewell.functions import scalar as X
from tidewell.operators import quality as Q
from tidewell.operators.security import masked_view, row_security
from conftest import rows


def test_check_constraint_rejects_whole_write(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id INT, qty INT")
    out = str(tmp_path / "t")
    with pytest.raises(PySparkException):
        Q.check_constraint(df, {"positive": "qty > 0"}).write.parquet(out)
    import os
    assert not os.path.exists(os.path.join(out, "_SUCCESS"))
    # NULL passes by SQL convention, fails in strict mode
    ok = spark.createDataFrame([(1, 5), (3, None)], "id INT, qty INT")
    assert len(Q.check_constraint(ok, {"positive": "qty > 0"}).collect()) == 2
    with pytest.raises(PySparkException):
        Q.check_constraint(ok, {"positive": "qty > 0"}, strict=True).collect()


def test_validate_and_expectations(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, -2), (4, None)], "id INT, qty INT")
    v = {r["constraint"]: r["violations"] for r in Q.validate_existing(df, {"positive": "qty > 0"}).collect()}
    assert v == {"positive": 2}
    with pytest.raises(ValueError):
        Q.ensure_valid(df, {"positive": "qty > 0"})
    obs = Observation("drop")
    kept = Q.expect_drop(df, {"positive": "qty > 0"}, obs)
    assert rows(kept, "id") == [(1,)]
    assert obs.get["dropped_rows"] == 3 and obs.get["input_rows"] == 4
    w = Observation("warn")
    assert len(Q.expect_warn(df, {"positive": "qty > 0"}, w).collect()) == 4
    assert w.get["failed_positive"] == 3
    u = Q.assert_unique(df, "id").first()
    assert u["is_unique"] and u["n_rows"] == 4


def test_masking_and_rows(spark):
    df = spark.createDataFrame([(1, "a@x", "FR"), (2, "b@y", "DE")], "id INT, email STRING, country STRING")
    m = masked_view(df, ["email"], False)
    assert rows(m, "email") == [("REDACTED",), ("REDACTED",)]
    assert rows(masked_view(df, ["email"], True), "email") == [("a@x",), ("b@y",)]
    assert rows(row_security(m, False, "country = 'FR'"), "id") == [(1,)]
    assert len(row_security(m, True, "country = 'FR'").collect()) == 2


def test_scalar_functions(spark):
    df = spark.createDataFrame([("a@b.com",), ("x@y.org",), ("p@q.edu",), ("z@w.io",), ("nodomain",), (None,)],
                               "email STRING")
    out = df.select(X.site_type("email").alias("s"), X.url_from_email("email").alias("u")).collect()
    assert [r.s for r in out] == ["Commercial business", "Non-profits organization", "Educational institution",
                                  "Unknow extenstion for domain: w.io", None, None]
    assert out[0].u == "https://www.b.com" and out[4].u is None
    g = spark.createDataFrame([(3.5,), (3.49,), (2.75,), (2.0,), (1.99,), (-1.0,), (None,)], "gpa DOUBLE")
    assert [r[0] for r in g.select(X.letter_grade("gpa")).collect()] == ["A", "B", "B", "C", "F", "F", "F"]
    X.register_sql_functions(spark)
    assert spark.sql("SELECT get_letter_grade(3.6), site_type('a@b.org'), get_url('u@v.com')").first() == \
        ("A", "Non-profits organization", "https://www.v.com")
    t = spark.createDataFrame([([{"subtotal": 10}, {"subtotal": 7}],)], "b ARRAY<STRUCT<subtotal: BIGINT>>")
    assert t.select(X.discounted("b")).first()[0] == [8, 5]  # truncation, not rounding


def test_from_json_needs_schema_and_malformed_gives_nulls(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("not json",)], "s STRING")
    with pytest.raises(Exception):
        df.select(F.expr("from_json(s)")).collect()
    out = df.select(X.from_json_typed("s", "a INT").alias("v")).select("v.a").collect()
    assert [r[0] for r in out] == [1, None]
