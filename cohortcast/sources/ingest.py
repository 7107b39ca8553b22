"""Scans (S1-S7, S14-S16) and explicit schemas.

Sheets arrive as CSV or Parquet with the same columns the spreadsheets had;
the header normaliser (S1) runs on the driver over column *names* only.  Fact
scans are one partition-pruned read of the whole layer, never a loop over
monthly files.
"""

from __future__ import annotations

import csv
import unicodedata
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, Params
from ..functions.periods import all_periods
from .dims import Dims

RAW_CLASS_SCHEMA = T.StructType([
    T.StructField("PERIODO", T.IntegerType()), T.StructField("SEDE", T.StringType()),
    T.StructField("MODALIDAD", T.StringType()), T.StructField("FASE", T.StringType()),
    T.StructField("NIVEL", T.StringType()), T.StructField("CODIGO_DE_CURSO", T.StringType()),
    T.StructField("DESCRIPCION", T.StringType()), T.StructField("FRECUENCIA", T.StringType()),
    T.StructField("INTENSIDAD", T.StringType()), T.StructField("HORARIO", T.StringType()),
    T.StructField("AULA", T.StringType()), T.StructField("COD_DOCENTE", T.StringType()),
    T.StructField("PROFESOR", T.StringType()), T.StructField("CANT_MATRICULADOS", T.IntegerType()),
    T.StructField("VACANTES_USADAS", T.IntegerType()), T.StructField("VACANTES_DISP", T.IntegerType()),
    T.StructField("VAC_HABILITADAS", T.IntegerType()), T.StructField("AFORO", T.DoubleType()),
    T.StructField("ESTADO", T.StringType()), T.StructField("FECHA_CREACION", T.StringType()),
])

CELL_SCHEMA = "PERIODO int, SEDE string, CURSO_ACTUAL string, HORARIO_ACTUAL string, CANT_CLASES long, CANT_ALUMNOS long"


def normalise_name(name: str) -> str:
    """Strip, upper-case, drop '.', spaces -> '_', strip accents."""
    s = str(name).strip().upper().replace(".", "").replace(" ", "_")
    return "".join(ch for ch in unicodedata.normalize("NFKD", s) if not unicodedata.combining(ch))


def normalise_headers(df: DataFrame) -> DataFrame:
    """S1 on a frame: rename every column; duplicate results are an error."""
    new = [normalise_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"header normalisation produces duplicate names: {new}")
    return df.toDF(*new)


def cast_to_schema(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """S3: explicit casts of every declared column (ANSI cast raises on bad input; ``strict=False`` -> try_cast)."""
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append((c.cast(f.dataType) if strict else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def _header(spark: SparkSession, path: str) -> list[str]:
    """The names in the second line of one of the files (the first is a title)."""
    top = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).take(2)
    names = next(csv.reader([top[1][0]])) if len(top) == 2 and top[1][0] else []
    if not names:
        raise ValueError(f"no header row below the banner in {path}")
    return names


def _below_banner(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows and header rows of CSV files with a title line (not blank) above the header, in one splittable scan.  The reader itself leaves out each file's first
    line, wherever its splits begin; the header row below it is left out as the row of its file's first split that
    holds the very names, and every file must have it."""
    names = _header(spark, path)
    own = [f"_c{i}" for i in range(len(names))]
    rows = (spark.read.schema(", ".join(f"{c} string" for c in own)).option("header", "true").csv(path)
            .withColumn("_first", F.col("_metadata.file_block_start") == 0))
    header = F.col("_first")
    for c, n in zip(own, names):
        header &= F.col(c).eqNullSafe(F.lit(n if n != "" else None))
    return rows.where(~header).drop("_first").toDF(*names), rows.where(header)


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", skip_banner: bool = False) -> DataFrame:
    """One sheet as CSV (header row, all strings) or Parquet, headers normalised.

    With a banner, every file below ``path`` must have the same header row; a file without it stops the reading."""
    if fmt == "csv":
        r = spark.read.option("header", "true").option("inferSchema", "false").option("encoding", "UTF-8")
        if skip_banner:
            df, headers = _below_banner(spark, path)
            found, files = headers.count(), len(headers.inputFiles())      # sheets are small: a look at each is cheap
            if found != files:
                raise ValueError(f"{found} of {files} files in {path} have the expected header row below the banner")
        else:
            df = r.csv(path)
    else:
        df = spark.read.parquet(path)
    return normalise_headers(df)


def read_classes(spark: SparkSession, root: str, periods=None, fmt: str = "parquet",
                 skip_banner: bool = False) -> DataFrame:
    """S2 + S3 + S6: the fact layer in one scan, pruned to ``periods`` (absent months simply vanish).

    CSV files with a banner are read without a look at each: another header row in one of them would reach the strict cast
    of PERIODO and stop the query there."""
    if fmt == "parquet":
        df = spark.read.parquet(root)
    else:
        df = _below_banner(spark, root)[0] if skip_banner else read_sheet(spark, root, "csv")
    df = cast_to_schema(normalise_headers(df), RAW_CLASS_SCHEMA)
    if periods is not None:
        df = df.where(F.col("PERIODO").isin([int(p) for p in periods]))
    return df


def missing_periods(spark: SparkSession, facts: DataFrame, periods) -> DataFrame:
    """S6 report: requested months with no rows (anti join of expected vs present)."""
    from .local import local_frame
    want = local_frame(spark, [(int(p),) for p in periods], "PERIODO int")
    return want.join(facts.select("PERIODO").distinct(), "PERIODO", "left_anti")


def history_periods(last: int, params: Params = DEFAULT) -> list[int]:
    return all_periods(last, params)


DIM_FILES = {
    "courses": "cursos_actual", "course_map": "tabla_curso_acumulado", "initial_courses": "tabla_curso_inicial",
    "seasonal_course_map": "tabla_curso_diario_to_sabatino",
    "seasonal_slot_map": "tabla_horario_diario_to_sabatino", "slots": "tabla_horario",
    "site_hours": "turno_disponible", "seats": "tabla_vac_estandar", "pe": "tabla_pe",
}


@dataclass(frozen=True)
class Snapshot:
    """One platinum version: fact and planner cells, catalogue tables, and the expected months that hold no facts."""
    facts: DataFrame
    synthetic: DataFrame
    dims: Dims
    missing: DataFrame


def pinned_version(spark: SparkSession, root: str, version: str | None = None) -> str:
    """The version itself, or the last one (by name) that all layers hold, so that one run never mixes versions."""
    if version is not None:
        return version
    have = [{r[0] for r in spark.read.parquet(f"{root}/{x}").select("version").distinct().collect()}   # one row a version
            for x in ("prog_acad", "synthetic")]
    both = sorted(have[0] & have[1])
    if not both:
        raise ValueError(f"no version in {root} has both facts and planner rows")
    return both[-1]


def load_versioned(spark: SparkSession, root: str, version: str | None = None, last_period: int | None = None,
                   params: Params = DEFAULT) -> Snapshot:
    """S6 + S7: facts, synthetic and the catalogue tables of one pinned platinum version.

    Layout: ``{root}/prog_acad/version=v/PERIODO=p``, ``{root}/synthetic/version=v``, ``{root}/dim/version=v/<name>``.
    Facts are pruned to the months from the history start to ``last_period``; months of that range without facts don't
    stop the run, they are reported in ``missing`` (an anti join of calendar and partition values).
    """
    version = pinned_version(spark, root, version)
    facts = spark.read.parquet(f"{root}/prog_acad/version={version}")
    missing = facts.select("PERIODO").limit(0)
    if last_period is not None:
        facts = facts.where(F.col("PERIODO").between(params.history_start_period, last_period))
        missing = missing_periods(spark, facts, history_periods(last_period, params))
    synth = spark.read.parquet(f"{root}/synthetic/version={version}")
    tables = {}
    for name, fname in DIM_FILES.items():
        t = spark.read.parquet(f"{root}/dim/version={version}/{fname}")
        tables[name] = t.distinct() if name == "initial_courses" else t
    return Snapshot(facts, synth, Dims(tables), missing)


def load_snapshot(spark: SparkSession, root: str, version: str, last_period: int | None = None,
                  params: Params = DEFAULT) -> tuple[DataFrame, DataFrame, Dims]:
    """``load_versioned`` as (facts, synthetic, catalogue tables)."""
    s = load_versioned(spark, root, version, last_period, params)
    return s.facts, s.synthetic, s.dims


def calendar_gate(calendar: DataFrame, as_of: str) -> DataFrame:
    """(should_run, periodo) for the date ``as_of`` (a parameter, never the wall clock)."""
    hit = calendar.where(F.col("fecha").cast("date") == F.to_date(F.lit(as_of)))
    return hit.agg((F.count(F.lit(1)) > 0).alias("should_run"),
                   F.coalesce(F.min(F.col("periodo").cast("int")), F.lit(-1)).alias("periodo"))


def with_file_version(df: DataFrame, pattern: str = r".+_(v[0-9]+).*[.]parquet") -> DataFrame:
    """Source path of each row and the version parsed out of it.

    Spark datasets are folders of part files, so the version is read from the
    full path (the dataset folder carries the name), not from the part file.
    """
    name = F.col("_metadata.file_path")
    return df.withColumn("NAME_FILE", name).withColumn("VERSION", F.regexp_extract(name, pattern, 1))


def csv_passthrough(spark: SparkSession, src: str, dst: str, **options) -> int:
    """Copy CSV files, counting rows with an observation of the write itself (no second pass over the data); ``options``
    go to the writer (the copy is plain text without them)."""
    from pyspark.sql import Observation
    obs = Observation("rows")
    spark.read.option("header", "true").csv(src).observe(obs, F.count(F.lit(1)).alias("n")) \
        .write.mode("overwrite").options(**options).option("header", "true").csv(dst)
    return int(obs.get["n"])
