"""File ingest whose schema is inferred, remembered and grows.

``<schema location>/v=<n>`` holds the n-th version of the schema.  Every micro-batch is looked at
before it is parsed: one aggregate (``schema_of_variant_agg``) gives the columns and types of its
JSON lines, new columns (also inside nested objects) are appended to the schema as a new
version, and only then are the rows written.  Known columns keep their types: values
that do not fit, lines that are no JSON object and names that differ from a column only
in case are kept as JSON in the column of leftovers.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

from tidewell.session import list_names
from tidewell.streaming.runner import run_available_now

RESCUED, CORRUPT = "_rescued", "_corrupt"
EPOCH = "_tw_epoch"


class SchemaLog:
    """Versions of a schema, each one a folder with one JSON text file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        names = [n for n in list_names(self.spark, self.path) if n.startswith("v=")]
        whole = [n for n in names if any(f.startswith("part-") for f in list_names(self.spark, f"{self.path}/{n}"))]
        return sorted(int(n[2:]) for n in whole)

    def read(self, version: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.path}/v={version}").first()[0]))

    def current(self) -> T.StructType | None:
        have = self.versions()
        return self.read(have[-1]) if have else None

    def publish(self, schema: T.StructType) -> int:
        version = (self.versions() or [-1])[-1] + 1
        (self.spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
         .write.mode("overwrite").text(f"{self.path}/v={version}"))
        return version


def _column_type(t: T.DataType) -> T.DataType | None:
    """What a column of an observed type is declared as; None while only nulls have been seen."""
    if isinstance(t, T.NullType):
        return None
    if isinstance(t, T.StructType):
        kept = [(f.name, _column_type(f.dataType)) for f in t.fields]
        return T.StructType([T.StructField(n, k) for n, k in kept if k is not None]) if any(k for _, k in kept) else None
    if isinstance(t, T.ArrayType):
        inner = _column_type(t.elementType)
        return None if inner is None else T.ArrayType(inner)
    if isinstance(t, T.DecimalType):
        return T.DoubleType()
    return T.StringType() if isinstance(t, T.VariantType) else t


def observed_schema(lines: DataFrame, infer_types: bool = True) -> T.StructType:
    """Columns and types of JSON lines (column ``value``): one distributed aggregate, one string back."""
    seen = lines.agg(F.schema_of_variant_agg(F.try_parse_json("value")).alias("s")).first()["s"]
    if not seen or not seen.startswith("OBJECT<"):
        # no object among the lines, or objects among other values: then the objects alone
        objects = lines.filter(F.ltrim("value").startswith("{"))
        seen = objects.agg(F.schema_of_variant_agg(F.try_parse_json("value")).alias("s")).first()["s"]
        if not seen or not seen.startswith("OBJECT<"):
            return T.StructType([])
    found = _column_type(T.DataType.fromDDL(seen.replace("OBJECT<", "STRUCT<"))) or T.StructType([])
    return found if infer_types else T.StructType([T.StructField(f.name, T.StringType()) for f in found.fields])


def merge_schemas(known: T.StructType, seen: T.StructType) -> tuple[T.StructType, list[str]]:
    """``known`` with the new columns of ``seen`` appended, and the names that clash with a column but for case."""
    fields, at, clashing = list(known.fields), {f.name.lower(): i for i, f in enumerate(known.fields)}, []
    for f in seen.fields:
        i = at.get(f.name.lower())
        if i is None:
            at[f.name.lower()] = len(fields)
            fields.append(T.StructField(f.name, f.dataType))
        elif fields[i].name != f.name:
            clashing.append(f.name)
        else:
            fields[i] = T.StructField(f.name, _merged_type(fields[i].dataType, f.dataType))
    return T.StructType(fields), clashing


def _merged_type(known: T.DataType, seen: T.DataType) -> T.DataType:
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        return merge_schemas(known, seen)[0]
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(_merged_type(known.elementType, seen.elementType))
    return known


def parse_lines(lines: DataFrame, schema: T.StructType, clashing: list[str] = (), *keep: Column) -> DataFrame:
    """JSON lines as typed columns and ``_rescued`` (JSON text of what has no place in them, else null)."""
    whole = "map<string, variant>"
    part = lambda name: F.try_element_at(F.col("_m"), F.lit(name))
    out, left = [], []
    for f in schema.fields:
        typed = F.try_variant_get(part(f.name), "$", _ddl(f.dataType))
        if not isinstance(f.dataType, (T.StringType, T.StructType, T.ArrayType)):
            typed = F.when(_fits(part(f.name), typed, f.dataType), typed)
        out.append(typed.alias(f.name))
        present = part(f.name).isNotNull() & ~F.is_variant_null(part(f.name))
        lost = present & typed.isNull()
        if isinstance(f.dataType, (T.StructType, T.ArrayType)):
            # a value inside that does not fit comes out as null: then the whole value is kept as well
            lost = lost | (present & (_values(F.to_json(part(f.name))) > _values(F.to_json(typed))))
        left.append((f.name, F.when(lost, F.to_json(part(f.name)))))
    left += [(name, F.to_json(part(name))) for name in clashing]
    left.append((CORRUPT, F.when(F.col("_m").isNull(), F.to_json(F.col("value").cast("variant")))))
    entries = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), v.alias("v")) for n, v in left]), lambda e: e["v"].isNotNull())
    quoted = F.transform(entries, lambda e: F.concat(F.to_json(e["n"].cast("variant")), F.lit(":"), e["v"]))
    rescued = F.when(F.size(entries) > 0, F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}")))
    parsed = lines.filter(F.trim("value") != "").withColumn("_m", F.try_variant_get(F.try_parse_json("value"), "$", whole))
    return parsed.select(*out, rescued.alias(RESCUED), *keep)


def _ddl(t: T.DataType) -> str:
    """The type in SQL, its field names quoted."""
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join("`" + f.name.replace("`", "``") + "`: " + _ddl(f.dataType) for f in t.fields) + ">"
    return f"array<{_ddl(t.elementType)}>" if isinstance(t, T.ArrayType) else t.simpleString()


def _fits(value: Column, typed: Column, t: T.DataType) -> Column:
    """Whether a scalar keeps its meaning in the column's type: truth values and numbers do not mix, and a
    fraction is no whole number; text that reads as the type is taken."""
    seen = F.schema_of_variant(value)
    fits = (seen == "STRING") | ((seen == "BOOLEAN") == F.lit(isinstance(t, T.BooleanType)))
    if isinstance(t, T.IntegralType):
        fits = fits & F.coalesce(F.try_variant_get(value, "$", "double") == typed.cast("double"), F.lit(True))
    return fits


def _values(text: Column) -> Column:
    """Number of keys and values in a JSON text, nulls not counted: equal where nothing was dropped."""
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', "s")
    bare = F.regexp_replace(bare, "s:null|null", "")
    return F.coalesce(F.regexp_count(bare, F.lit(r"[^\s,:\[\]{}]+")), F.lit(0))


class GrowingIngest:
    """Each new JSON file under ``landing`` once into ``out``, under a schema that grows.

    ``infer_types=False`` declares every column as a string (nested values as JSON).  ``schema_hints``
    are columns with given types, known from the start.  Rows of a micro-batch go to a folder of
    its own, which a replay overwrites; the schema is published before it, and a replay
    finds it there and changes nothing.  Nulls and missing columns are null; empty lines are
    skipped; a landing without files gives an empty table.
    """

    def __init__(self, spark: SparkSession, landing: str, out: str, schema_location: str, checkpoint: str,
                 infer_types: bool = True, schema_hints: T.StructType | None = None, max_files: int | None = None):
        self.spark, self.landing, self.out, self.checkpoint = spark, landing, out.rstrip("/"), checkpoint
        self.log, self.infer_types, self.hints, self.max_files = SchemaLog(spark, schema_location), infer_types, schema_hints, max_files

    def run(self, trigger: str | None = "available_now") -> DataFrame:
        """Take in what has landed since the last run; return the table."""
        src = self.spark.readStream.schema("value string")
        if self.max_files:
            src = src.option("maxFilesPerTrigger", self.max_files)
        run_available_now(src.text(self.landing), "growing-ingest", foreach_batch=self._batch,
                          checkpoint=self.checkpoint, trigger=trigger)
        return self.read()

    def _batch(self, lines: DataFrame, epoch: int) -> None:
        known = self.log.current() or self.hints or T.StructType([])
        schema, clashing = merge_schemas(known, observed_schema(lines, self.infer_types))
        if schema != self.log.current():
            self.log.publish(schema)
        parse_lines(lines, schema, clashing).write.mode("overwrite").parquet(f"{self.out}/{EPOCH}={epoch}")

    def read(self) -> DataFrame:
        """All rows under the newest schema; columns that a file does not have are null."""
        schema = T.StructType([*(self.log.current() or self.hints or T.StructType([])).fields, T.StructField(RESCUED, T.StringType())])
        if not list_names(self.spark, self.out):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.out).select(*["`" + n.replace("`", "``") + "`" for n in schema.names])
