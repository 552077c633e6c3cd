"""Scalar column functions (JSON, arrays, strings, time) and the SQL UDFs.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage code generation.  The SQL UDFs are registered with
``CREATE FUNCTION … RETURN`` so that SQL users get the same bodies, which the
analyzer inlines into the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Site-type labels by e-mail suffix (the "Unknow extenstion" spelling
# is kept as users of the original function see it) and letter-grade cut points.
SITE_TYPES = [(".com", "Commercial business"), (".org", "Non-profits organization"),
              (".edu", "Educational institution")]
SITE_UNKNOWN_PREFIX = "Unknow extenstion for domain: "
GRADE_CUTS = [(3.5, "A"), (2.75, "B"), (2.0, "C")]  # below the last cut (or NULL): "F"
URL_PREFIX = "https://www."


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- JSON ---------------------------------------------------------------------------

def json_path(col, *path: str) -> Column:
    """``col:a:b`` on a JSON string → ``get_json_object(col, '$.a.b')`` (STRING)."""
    return F.get_json_object(c(col), "$." + ".".join(path))


def from_json_typed(col, ddl: str, options: dict | None = None) -> Column:
    """Parse a JSON string (or BINARY value) with a DDL schema; malformed → NULL fields."""
    x = c(col)
    return F.from_json(x.cast("string"), ddl, options or {})


def schema_from_sample(spark: SparkSession, sample_json: str) -> str:
    """``schema_of_json(sample)`` evaluated once on the driver for one literal string."""
    return spark.range(1).select(F.schema_of_json(F.lit(sample_json))).first()[0]


# ---- arrays ---------------------------------------------------------------------------

def array_filter(col, pred) -> Column:
    return F.filter(c(col), pred)


def array_transform(col, fn) -> Column:
    return F.transform(c(col), fn)


def discounted(col, rate: float = 0.8) -> Column:
    """``transform(arr, b -> CAST(b.subtotal * rate AS INT))`` (truncates toward zero)."""
    return F.transform(c(col), lambda b: (b["subtotal"] * F.lit(rate)).cast("int"))


# ---- strings --------------------------------------------------------------------------

def email_domain(email) -> Column:
    """``split(email, '@')[1]`` with NULL when there is no '@' (no ANSI index error)."""
    return F.get(F.split(c(email), "@"), 1)


def url_from_email(email) -> Column:
    return F.concat(F.lit(URL_PREFIX), email_domain(email))


def site_type(email) -> Column:
    e = c(email)
    out = F.concat(F.lit(SITE_UNKNOWN_PREFIX), email_domain(e))
    for suffix, label in reversed(SITE_TYPES):
        out = F.when(e.like("%" + suffix), F.lit(label)).otherwise(out)
    return F.when(e.isNotNull(), out)


def letter_grade(gpa) -> Column:
    g = c(gpa)
    out = F.lit("F")
    for cut, letter in reversed(GRADE_CUTS):
        out = F.when(g >= cut, F.lit(letter)).otherwise(out)
    return out


# ---- time -----------------------------------------------------------------------------

def unix_seconds_to_ts(col) -> Column:
    """``CAST(from_unixtime(sec, 'yyyy-MM-dd HH:mm:ss') AS TIMESTAMP)`` (session zone UTC)."""
    return F.from_unixtime(c(col), "yyyy-MM-dd HH:mm:ss").cast("timestamp")


def epoch_ms_to_ts(col) -> Column:
    return F.timestamp_millis(c(col))


def day_bucket(ts) -> Column:
    return F.date_trunc("DD", c(ts))


def year_month(ts) -> Column:
    return F.date_format(c(ts), "yyyy-MM")


def deadline(ts, days: int = 30) -> Column:
    return F.date_add(c(ts), days)


# ---- SQL UDF registration ----------------------------------------------------------------

def _case_sql() -> str:
    whens = " ".join(f"WHEN email LIKE '%{s}' THEN '{label}'" for s, label in SITE_TYPES)
    return (f"CASE WHEN email IS NULL THEN NULL {whens} "
            f"ELSE concat('{SITE_UNKNOWN_PREFIX}', get(split(email, '@'), 1)) END")


def _grade_sql() -> str:
    whens = " ".join(f"WHEN gpa >= {cut} THEN '{letter}'" for cut, letter in GRADE_CUTS)
    return f"CASE {whens} ELSE 'F' END"


def register_sql_functions(spark: SparkSession, temporary: bool = True) -> None:
    """Create ``get_url``, ``site_type`` and ``get_letter_grade`` as SQL functions."""
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    spark.sql(f"CREATE OR REPLACE {kind} get_url(email STRING) RETURNS STRING "
              f"RETURN concat('{URL_PREFIX}', get(split(email, '@'), 1))")
    spark.sql(f"CREATE OR REPLACE {kind} site_type(email STRING) RETURNS STRING RETURN {_case_sql()}")
    spark.sql(f"CREATE OR REPLACE {kind} get_letter_grade(gpa DOUBLE) RETURNS STRING "
              f"RETURN {_grade_sql()}")
