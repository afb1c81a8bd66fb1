"""Database column types to Spark types, and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.columns import clean_name

# Source type -> target type, as stored tables were created.
PLAIN_TYPES = {
    "double precision": "double",
    "character varying": "string",
    "character": "string",
    "text": "string",
    "name": "string",
    "timestamp without time zone": "timestamp_ntz",
    "bigint": "bigint",
    "integer": "int",
    "smallint": "smallint",
    "date": "date",
    "ARRAY": "array<string>",
}
# types the older mapping turned into text
EXACT_TYPES = {
    **PLAIN_TYPES,
    "boolean": "boolean",
    "real": "float",
    "timestamp with time zone": "timestamp",
}
# Spark type -> what a database table is created with; the way back of EXACT_TYPES
DATABASE_TYPES = {
    "double": "double precision", "float": "real", "string": "text",
    "timestamp_ntz": "timestamp without time zone", "timestamp": "timestamp with time zone",
    "bigint": "bigint", "int": "integer", "smallint": "smallint", "tinyint": "smallint",
    "date": "date", "boolean": "boolean", "binary": "bytea",
}
OTHER = "string"
UNBOUNDED_DECIMAL = (38, 18)
MAX_PRECISION = 38

COMPAT = "compat"
EXACT = "exact"


def spark_type_name(data_type: Column, precision: Column, scale: Column,
                    mode: str = EXACT) -> Column:
    """Spark type name of a source column, from its catalog row.

    ``exact`` keeps decimals; ``compat`` turns whole numerics into ``bigint``
    and the rest into ``double``, as older targets hold them.
    """
    if mode not in (COMPAT, EXACT):
        raise ValueError(f"unknown type mode {mode!r}")
    numeric = data_type == "numeric"
    sized = precision.isNotNull()
    if mode == COMPAT:
        out = (F.when(numeric & sized & (scale == 0), "bigint")
               .when(numeric | (F.coalesce(scale, F.lit(0)) > 0), "double"))
        plain = PLAIN_TYPES
    else:
        decimal = F.concat(F.lit("decimal("), precision.cast("string"), F.lit(","),
                           F.coalesce(scale, F.lit(0)).cast("string"), F.lit(")"))
        fits = sized & (precision <= MAX_PRECISION)
        out = (F.when(numeric & fits, decimal)
               .when(numeric, "decimal(%d,%d)" % UNBOUNDED_DECIMAL))
        plain = EXACT_TYPES
    for source, target in plain.items():
        out = out.when(data_type == source, target)
    return out.otherwise(OTHER)


def map_types(metadata: DataFrame, mode: str = EXACT) -> DataFrame:
    """Catalog rows with the Spark type and the cleaned column name added."""
    return metadata.withColumns({
        "spark_type": spark_type_name(F.col("data_type"), F.col("numeric_precision"),
                                      F.col("numeric_scale"), mode),
        "target_column": F.replace(F.col("column_name"), F.lit("$"), F.lit("_")),
    })


def column_lists(metadata: DataFrame, mode: str = COMPAT) -> DataFrame:
    """One row per table: its column definitions in ordinal order, as one string.

    Only catalog rows are gathered, a table's columns, never table data.
    """
    mapped = map_types(metadata, mode)
    entry = F.struct("ordinal_position", F.concat(F.lit("`"), F.col("target_column"),
                                                  F.lit("` "), F.col("spark_type")).alias("d"))
    ordered = F.sort_array(F.collect_list(entry))
    return (mapped.groupBy("table_schema", "table_name")
            .agg(F.array_join(F.transform(ordered, lambda e: e["d"]), ", ").alias("column_list"),
                 F.count(F.lit(1)).alias("column_count")))


def database_type(kind: T.DataType) -> str:
    """The database type that holds all values of a Spark type.

    Lengths of text are kept where the type tells them; what a database has no
    column type for is refused, not turned into text.
    """
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision},{kind.scale})"
    if isinstance(kind, (T.CharType, T.VarcharType)):
        name = "character" if isinstance(kind, T.CharType) else "character varying"
        return f"{name}({kind.length})"
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.ArrayType):
        return f"{database_type(kind.elementType)}[]"
    name = DATABASE_TYPES.get(kind.simpleString())
    if name is None:
        raise ValueError(f"no database type for {kind.simpleString()}")
    return name


def struct_type(columns: Sequence[dict], mode: str = EXACT) -> T.StructType:
    """Schema of one table from its catalog rows (dicts or Rows), without a job."""
    fields = []
    for c in sorted(columns, key=lambda c: c["ordinal_position"]):
        kind, p, s = c["data_type"], c["numeric_precision"], c["numeric_scale"]
        if kind == "numeric" and mode == COMPAT:
            name = "bigint" if p is not None and s == 0 else "double"
        elif kind == "numeric":
            p, s = (p, s or 0) if p is not None and p <= MAX_PRECISION else UNBOUNDED_DECIMAL
            name = f"decimal({p},{s})"
        elif mode == COMPAT and (s or 0) > 0:
            name = "double"
        else:
            name = (PLAIN_TYPES if mode == COMPAT else EXACT_TYPES).get(kind, OTHER)
        fields.append(T.StructField(clean_name(c["column_name"]), T._parse_datatype_string(name)))
    return T.StructType(fields)


def strict_cast(value: Column, dtype: T.DataType, name: str) -> Column:
    """Cast that fails the query on a value it cannot read, whatever the ANSI setting."""
    if isinstance(dtype, T.StringType):
        return value
    out = value.try_cast(dtype)
    return F.when(value.isNotNull() & out.isNull(),
                  F.raise_error(F.concat(F.lit(f"column {name}: cannot read as "
                                               f"{dtype.simpleString()}: "), value))
                  ).otherwise(out)


def narrowing_overflows(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: per column, how many values do not fit the narrower type."""
    return df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c)
                    for c, t in columns.items()])


def narrow(df: DataFrame, columns: dict[str, str], *, on_overflow: str = "fail") -> DataFrame:
    """Cast to narrower types. A value that does not fit fails the load, or with
    ``on_overflow="null"`` becomes NULL, see :func:`narrowing_overflows` for their number."""
    if on_overflow not in ("fail", "null"):
        raise ValueError(f"unknown on_overflow {on_overflow!r}")

    def value(name: str, kind: str) -> Column:
        out = F.col(name).try_cast(kind)
        if on_overflow == "null":
            return out
        complaint = F.concat(F.lit(f"column {name}: does not fit {kind}: "),
                             F.col(name).cast("string"))
        return F.when(F.col(name).isNotNull() & out.isNull(),
                      F.raise_error(complaint).cast(kind)).otherwise(out)

    return df.withColumns({c: value(c, t) for c, t in columns.items()})


def schema_drift(source: DataFrame, target: DataFrame) -> DataFrame:
    """Catalog rows of two sides compared by table and column: added, removed, retyped."""
    where = ["table_schema", "table_name", "column_name"]
    s = source.select(*where, F.col("data_type").alias("source_type"))
    t = target.select(*where, F.col("data_type").alias("target_type"))
    return (s.join(t, where, "full")
            .withColumn("change", F.when(F.col("target_type").isNull(), "added")
                        .when(F.col("source_type").isNull(), "removed")
                        .when(F.col("source_type") != F.col("target_type"), "retyped"))
            .filter(F.col("change").isNotNull()))


def drift_between(source: T.StructType, target: T.StructType) -> dict[str, list[str]]:
    """The same comparison for two schemas at hand; names compare without case."""
    s = {f.name.lower(): f for f in source}
    t = {f.name.lower(): f for f in target}
    return {
        "added": [f.name for n, f in s.items() if n not in t],
        "removed": [f.name for n, f in t.items() if n not in s],
        "retyped": [f.name for n, f in s.items() if n in t and t[n].dataType != f.dataType],
    }
