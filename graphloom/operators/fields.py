"""Which fields JSON records hold, beside those that a written schema knows.

A scan with a written schema reads an unknown field as nothing and an absent one as null: a renamed field would
count as 0 for ever. Here records are read as variants, taken apart level by level, and each field is told with its kind,
how often it occurs, and whether the schema knows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from graphloom.sources.runlogs import SCHEMAS

# fixed values: the kinds of JSON values by Spark's name of a variant's type
KINDS = {"BIGINT": "number", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "STRING": "string",
         "BOOLEAN": "boolean", "OBJECT": "object", "ARRAY": "array", "VOID": "null"}
MALFORMED = "malformed"

# a row not taken apart yet becomes itself, told by its first member, and its members
LEVEL_SQL = """
SELECT inline(filter(array(
    IF(m.pos IS NULL OR m.pos = 0, named_struct('field', r.field, 'value', r.value, 'fresh', false), NULL),
    IF(m.pos IS NULL, NULL, named_struct('field', CASE WHEN m.key IS NULL THEN r.field || '[]' WHEN r.field = '' THEN m.key
        ELSE r.field || '.' || m.key END, 'value', m.value, 'fresh', true))), x -> x IS NOT NULL))
FROM {rows} r, LATERAL variant_explode_outer(IF(r.fresh, r.value, NULL)) m
"""


def read_variants(spark: SparkSession, runs_glob: str, kind: str) -> DataFrame:
    """The records of one kind under ``runs_glob`` with all their fields: ``app_id, record`` (variant)."""
    if kind not in SCHEMAS:
        raise ValueError(f"unknown record kind {kind!r}; one of {sorted(SCHEMAS)}")
    read = (spark.read.option("singleVariantColumn", "record").option("multiLine", True)
            .json(f"{runs_glob.rstrip('/')}/{kind}.json"))
    return read.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("app_id"), "record")


def schema_fields(kind: DataType, prefix: str = "") -> list[str]:
    """The fields of a schema as paths: ``a``, ``a.b``, ``a[]``, ``a[].b``."""
    if isinstance(kind, ArrayType):
        return [prefix + "[]", *schema_fields(kind.elementType, prefix + "[]")]
    if not isinstance(kind, StructType):
        return []
    found = []
    for f in kind.fields:
        path = f"{prefix}.{f.name}" if prefix else f.name
        found += [path, *schema_fields(f.dataType, path)]
    return found


def json_fields(records: DataFrame, known: str | StructType, column: str = "record", depth: int = 8) -> DataFrame:
    """``field, kind, records, known``: each field of the JSON records in ``column`` (variants or text).

    ``kind``: number, string, boolean, object, array or null; a field of several kinds has a row for each.
    ``records`` counts occurrences. Members of arrays are told as ``a[]``; a record that is an array itself counts
    as its members. Fields deeper than ``depth`` levels are told by the level above them. Text that is no JSON is counted as
    kind ``malformed`` with an empty field name. Null records and empty objects have no fields; an empty table gives no rows.
    One scan, one aggregation.
    """
    value = F.col(column)
    if records.schema[column].dataType.typeName() != "variant":
        rows = records.where(value.isNotNull()).select(F.lit("").alias("field"), F.try_parse_json(value).alias("value"))
    else:
        rows = records.where(value.isNotNull()).select(F.lit("").alias("field"), value.alias("value"))
    rows = rows.withColumn("fresh", F.lit(True))
    for _ in range(depth):
        rows = records.sparkSession.sql(LEVEL_SQL, rows=rows)
    name = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    field = F.regexp_replace("field", r"^\[\]\.?", "")  # members of a record that is an array
    told = rows.select(field.alias("field"), F.when(F.col("value").isNull(), F.lit(MALFORMED))
                       .otherwise(F.coalesce(F.try_element_at(kinds, name), F.lower(name))).alias("kind"))
    schema = StructType.fromDDL(known) if isinstance(known, str) else known
    counted = told.where((F.col("field") != "") | (F.col("kind") == MALFORMED)).groupBy("field", "kind").agg(
        F.count(F.lit(1)).alias("records"))
    return counted.select("field", "kind", "records", F.col("field").isin(schema_fields(schema)).alias("known"))


def unknown_fields(records: DataFrame, kind: str, column: str = "record") -> DataFrame:
    """The fields of run records of ``kind`` that the schema of that kind does not read."""
    return json_fields(records, SCHEMAS[kind], column).where(~F.col("known"))
