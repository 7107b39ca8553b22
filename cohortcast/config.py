"""Run parameters.

Every month, site, slot, threshold and label the forecasting rules depend on is
a field of :class:`Params`.  The defaults are the production values; callers
that run the rules over another calendar (tests, the driver tables) pass their
own instance.  Nothing in the operators hard-codes a month or a site name.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --------------------------------------------------------------------------
# These must equal the production rules for right results.
# --------------------------------------------------------------------------
CANCELLED_STATE = "Cur. Cancelado"
EXCLUDED_SITE = "VECOR"
EXCLUDED_LEVEL = "Corporate"
SATELLITE_SITES = ("San Juan de Lurigancho Satélite", "San Juan de Miraflores Satélite")
SITE_PREFIX_TO_STRIP = "Provincias - "
SITE_MERGE_SOURCES = ("Lima Norte Satélite 2", "Lima Norte")
SITE_MERGE_TARGET = "Lima Norte Satélite"
SUFFIX_CUTOVER_PERIOD = 202409
HISTORY_START_PERIOD = 202211
TRAINING_START_PERIOD = 202403
KIDS_PROGRAM = "Niños"
ADULTS_PROGRAM = "Adultos"
MONTHLY = "Mensual"
BIMONTHLY = "Bimensual"
MARCH_LEVELS = ("ST1", "ST2", "SY", "IST")
MARCH_FREQUENCY = "Interdiario"
MARCH_DAY_SLOTS = ("07:00 - 08:30", "08:45 - 10:15", "10:30 - 12:00", "12:30 - 14:00", "14:15 - 15:45")
SEASONAL_MONTHS = (1, 2, 3)          # month numbers with the seasonal training regime
LAG12_CANDIDATE_MONTHS = (1, 2, 3)   # first-level candidates also look 12 months back
SEASONAL_SUBSTITUTION_MONTH = 3      # March: seasonal successor substitution + slot exclusion
ROUND_UP_FRACTION = 0.4
THRESHOLD_FIRST_LEVEL = 0.30
THRESHOLD_OTHER = 0.50
BLACKOUT_SITES = ("Ica", "Pucallpa")
# (family, use) -> {site: months}
BLACKOUT = {
    ("inicial_regular", "target"): {"Ica": (202503, 202504, 202505, 202506, 202603),
                                    "Pucallpa": (202403, 202501, 202502, 202503)},
    ("inicial_regular", "features"): {"Ica": (202503, 202504, 202505, 202506, 202603),
                                      "Pucallpa": (202403, 202404, 202405, 202406, 202501, 202502, 202503)},
    ("continuidad_regular", "target"): {"Ica": (202503, 202504, 202505, 202603),
                                        "Pucallpa": (202403, 202501, 202502, 202503)},
    ("continuidad_regular", "features"): {"Ica": (202503, 202504, 202505, 202603),
                                          "Pucallpa": (202403, 202404, 202405, 202501, 202502, 202503)},
    ("continuidad_regular_horario", "target"): {"Ica": (202503, 202504, 202505, 202603),
                                                "Pucallpa": (202403, 202501, 202502, 202503)},
    ("continuidad_regular_horario", "features"): {"Ica": (202503, 202504, 202505, 202603),
                                                  "Pucallpa": (202403, 202404, 202405, 202501, 202502, 202503)},
}
FAMILIES = ("inicial_regular", "continuidad_regular", "continuidad_regular_horario")
# --------------------------------------------------------------------------


def _blackout_rows(table: dict) -> tuple:
    rows = []
    for (family, use), sites in table.items():
        for site, months in sites.items():
            rows.extend((family, use, site, int(m)) for m in months)
    return tuple(rows)


@dataclass(frozen=True)
class Params:
    cancelled_state: str = CANCELLED_STATE
    excluded_site: str = EXCLUDED_SITE
    excluded_level: str = EXCLUDED_LEVEL
    satellite_sites: tuple = SATELLITE_SITES
    site_prefix_to_strip: str = SITE_PREFIX_TO_STRIP
    site_merge_sources: tuple = SITE_MERGE_SOURCES
    site_merge_target: str = SITE_MERGE_TARGET
    suffix_cutover_period: int = SUFFIX_CUTOVER_PERIOD
    history_start_period: int = HISTORY_START_PERIOD
    training_start_period: int = TRAINING_START_PERIOD
    # label of the successor column meaning "no further course"; the
    # catalogue's own terminal label is site configuration
    terminal_course: str = "END"
    kids_program: str = KIDS_PROGRAM
    adults_program: str = ADULTS_PROGRAM
    monthly: str = MONTHLY
    bimonthly: str = BIMONTHLY
    march_levels: tuple = MARCH_LEVELS
    march_frequency: str = MARCH_FREQUENCY
    march_day_slots: tuple = MARCH_DAY_SLOTS
    seasonal_months: tuple = SEASONAL_MONTHS
    lag12_candidate_months: tuple = LAG12_CANDIDATE_MONTHS
    substitution_month: int = SEASONAL_SUBSTITUTION_MONTH
    round_up_fraction: float = ROUND_UP_FRACTION
    thresholds: tuple = (("inicial_regular", THRESHOLD_FIRST_LEVEL),
                         ("continuidad_regular", THRESHOLD_OTHER),
                         ("continuidad_regular_horario", THRESHOLD_OTHER))
    # rows (family, use, SEDE, PERIODO) removed from targets / features
    blackout: tuple = field(default_factory=lambda: _blackout_rows(BLACKOUT))
    # growth ratio a/b - 1 when b == 0: 'null' (default) or 'inf'
    zero_base: str = "null"

    def threshold(self, family: str) -> float:
        return dict(self.thresholds)[family]

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
