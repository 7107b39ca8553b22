"""Reference tables (course catalogue, slot catalogue, break-even, seats, ...).

They are catalogues, not facts: their size is fixed by the business (a few
hundred courses, a few dozen slots, sites x months for opening hours).  Each
table carries a known row count; ``Dims.small`` broadcasts a table only when
that count is under ``broadcast_rows`` and otherwise leaves the join strategy
to the planner (AQE turns a small shuffle side into a broadcast at run time).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000

DIM_NAMES = ("courses", "course_map", "initial_courses", "seasonal_course_map", "seasonal_slot_map",
             "slots", "site_hours", "seats", "pe")


@dataclass
class Dims:
    """Named reference tables.

    courses:             CURSO_ACTUAL, CURSO_2, NIVEL, FRECUENCIA, INTENSIDAD, DURACION, PROGRAMA,
                         LINEA_DE_NEGOCIO, `POSTERIOR_(+1)`
    course_map:          CURSO_ANTERIOR, CURSO_ACTUAL, FLAG_ESTACIONAL
    initial_courses:     CURSOS_INICIALES
    seasonal_course_map: CURSO_ACTUAL, `POSTERIOR_(+1)`
    seasonal_slot_map:   HORARIO, `HORARIO_(+1)`
    slots:               HORARIO, HORARIO_ACTUAL, HORA_MIN, HORA_MAX
    site_hours:          PERIODO, SEDE, HORA_MIN, HORA_MAX
    seats:               PERIODO, NIVEL, LINEA_DE_NEGOCIO, VAC_ACAD_ESTANDAR
    pe:                  PERIODO, PROGRAMA, PE
    """
    tables: dict[str, DataFrame]
    rows: dict[str, int] = field(default_factory=dict)
    broadcast_rows: int = BROADCAST_ROWS

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def small(self, name: str, df: DataFrame | None = None) -> DataFrame:
        """The table (or a projection of it) with a broadcast hint when its size is proven small."""
        df = self.tables[name] if df is None else df
        n = self.rows.get(name)
        if n is None:
            n = self.tables[name].count()          # catalogue tables only; cheap
            self.rows[name] = n
        return F.broadcast(df) if n <= self.broadcast_rows else df

    def register(self) -> None:
        for name, df in self.tables.items():
            df.createOrReplaceTempView(f"dim_{name}")
