"""Small constant frames (parameters, catalogues) as in-plan ``VALUES``.

``spark.createDataFrame`` over Python rows becomes a Python-RDD scan that
needs Python workers whenever it runs; a ``VALUES`` query is a JVM local
relation with exact size statistics, which the planner broadcasts for free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "long": "BIGINT"}
SPARK_TYPES = {"string": "STRING", "int": "INT", "double": "DOUBLE", "boolean": "BOOLEAN", "long": "BIGINT"}


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def schema_columns(schema: str) -> list[tuple[str, str]]:
    out = []
    for part in schema.split(","):
        name, typ = part.strip().rsplit(" ", 1)
        out.append((name.strip("`"), typ))
    return out


def values_sql(rows, schema: str, quote: str = '"') -> str:
    """Rows as a typed ``VALUES`` query; ``quote`` is the identifier quote of the dialect."""
    cols = schema_columns(schema)
    if not rows:
        rows = [tuple(None for _ in cols)]
        where = " WHERE FALSE"
    else:
        where = ""
    body = ",\n    ".join("(" + ", ".join(sql_literal(v) for v in r) + ")" for r in rows)
    q = quote
    names = ", ".join(f"{q}{c}{q}" for c, _ in cols)
    types = SPARK_TYPES if quote == "`" else SQL_TYPES
    casts = ", ".join(f"CAST({q}{c}{q} AS {types[t]}) AS {q}{c}{q}" for c, t in cols)
    return f"(SELECT {casts} FROM (VALUES\n    {body}) AS v({names}){where})"


def local_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A constant frame as a JVM local relation.

    An empty table is not given to the planner as a provably empty relation:
    the optimizer would replace lookups against it by null literals and could
    then move the lookup checks onto rows that a branch filter removes.
    """
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.sql(values_sql(rows, schema, quote="`"))
