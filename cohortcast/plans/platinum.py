"""Platinum ETL (C1): raw class rows and planner rows -> per-cell roll-ups and catalogue outputs.

facts:     F1 regular sale -> F2 satellites -> F3 site canonical -> J1 course recode -> J2 slot recode -> A1
synthetic: J1 -> J2 -> A2   (synthetic rows skip F1-F3, like production)
The roll-up is the only shuffle; lookups are broadcast joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import DEFAULT, Params
from ..operators import clean, enrich, rollup
from ..sources.dims import Dims


def clean_classes(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """F1 + F2 + F3."""
    return clean.canonicalise_sites(clean.drop_satellites(clean.regular_sale(raw, params), params), params)


def recode(df: DataFrame, dims: Dims, strict: bool = True) -> DataFrame:
    """J1 + J2."""
    return enrich.recode_slot(enrich.recode_course(df, dims, strict), dims, strict)


def facts_rollup(raw: DataFrame, dims: Dims, params: Params = DEFAULT) -> DataFrame:
    return rollup.platinum_rollup(recode(clean_classes(raw, params), dims))


def synthetic_rollup(raw_synth: DataFrame, dims: Dims) -> DataFrame:
    return rollup.synthetic_rollup(recode(raw_synth, dims))


def build(raw: DataFrame, raw_synth: DataFrame | None, dims: Dims, params: Params = DEFAULT):
    """C1 frames: (fact cells, synthetic cells or None)."""
    facts = facts_rollup(raw, dims, params)
    synth = synthetic_rollup(raw_synth, dims) if raw_synth is not None else None
    return facts, synth


def build_and_write(raw: DataFrame, raw_synth: DataFrame | None, dims: Dims, root: str, version: str,
                    params: Params = DEFAULT) -> dict:
    """C1 + S8 + S9: write fact cells per month, synthetic cells and every catalogue table under ``version``."""
    from ..sources import sinks
    facts, synth = build(raw, raw_synth, dims, params)
    out = {"prog_acad": sinks.write_by_period(facts, root, version)}
    if synth is not None:
        out["synthetic"] = sinks.write_versioned(synth, root, "synthetic", version)
    from ..sources.ingest import DIM_FILES
    for name, fname in DIM_FILES.items():
        path = f"{root}/dim/version={version}/{fname}"
        dims[name].write.mode("overwrite").parquet(path)
        out[name] = path
    return out
