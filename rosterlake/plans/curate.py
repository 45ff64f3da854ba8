"""Raw nested records -> checked, normalised Parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..operators import quality
from ..operators.flatten import flatten_nested, normalize, string_columns
from ..session import over_all_cores, scratch_path, small_methods
from ..sources import schemas
from ..sources.tables import delete_path, publish, read_parquet, save_issues


@dataclass
class Gate:
    """What one entity must satisfy before it is written."""

    label: str
    id_field: str
    contract: T.StructType
    required: Sequence[str]
    unique: Sequence[str]
    dates: Sequence[str] = ()
    datetimes: Sequence[str] = ()
    drop_invalid: Sequence[str] = field(default_factory=tuple)


JOBS = Gate("jobs", "codigo_vaga", schemas.CURATED_JOB, ["codigo_vaga"], ["codigo_vaga"], schemas.JOB_DATES)
PROSPECTS = Gate("prospects", "codigo_vaga", schemas.CURATED_PROSPECT, ["codigo_vaga", "p_codigo"],
                 ["codigo_vaga", "p_codigo"], schemas.PROSPECT_DATES, drop_invalid=["codigo_vaga", "p_codigo"])
APPLICANTS = Gate("applicants", "codigo_candidato", schemas.CURATED_APPLICANT, ["codigo_candidato", "ib_nome"],
                  ["codigo_candidato"], schemas.APPLICANT_DATES, schemas.APPLICANT_DATETIMES)


class QualityError(ValueError):
    """A permanent quality check failed."""


#: Columns that the counts and the written copy share; tidied names have no colon.
VALID, CLEAN = "gate:valid", "gate:clean:"


def staged_counts(flat: DataFrame, gate: Gate) -> dict[str, Column]:
    """What the gate counts while the rows are written: contract nulls of all rows, the rest of the valid ones."""
    strings, valid = set(string_columns(flat)), F.col(VALID)
    counts = {f"null:{f.name}": F.count_if(F.col(f.name).isNull()) for f in gate.contract.fields if not f.nullable and f.name in flat.columns}
    counts |= {f"required:{c}": F.count_if(valid & text.is_missing_value(F.col(c), c in strings)) for c in gate.required if c in flat.columns}
    counts |= {f"changed:{c}": F.count_if(valid & ~F.col(CLEAN + c).eqNullSafe(F.col(c))) for c in gate.unique if c in strings}
    return counts | {"rows": F.count(F.lit(1)), "invalid": F.count_if(~valid)}


def issue_rows(flat: DataFrame, staged: DataFrame, gate: Gate, counts: Mapping[str, int], valid: Column) -> DataFrame:
    """Issues of the permanent checks: required columns from the counts, duplicates from the key columns of the staged copy.

    Cleaning can make different keys alike; where it changed any key, the keys are read from the flattened rows instead.
    """
    absent = [(("required", c, None, "column is missing")) for c in gate.required if c not in flat.columns]
    missing = [("required", c, counts[f"required:{c}"], quality.MISSING) for c in gate.required if counts.get(f"required:{c}")]
    found = flat.sparkSession.createDataFrame(absent + missing, quality.ISSUE_SCHEMA)
    same = not any(n for name, n in counts.items() if name.startswith("changed:"))
    return found.unionAll(quality.check_duplicates(staged if same else flat.where(valid), gate.unique))


def curate(raw: DataFrame, gate: Gate, issues_path: str | None = None, target: str | None = None) -> DataFrame:
    """Flatten, normalise, check. Raises :class:`QualityError` if a permanent check fails.

    The rows are read once and written once, already normalised, and counted on the way; validity and cleaned keys are
    computed once for both. Only the key columns of the written copy are read again, to find duplicates. A copy that passes is published by renaming it to ``target``, so a
    failed check leaves the earlier table as it was. Without ``target`` the copy stays in the shared folder.
    """
    spark = raw.sparkSession
    flat = flatten_nested(over_all_cores(raw))
    quality.assert_structure(flat, gate.contract, gate.label)
    valid = ~quality.bad_required(quality.present(flat, gate.drop_invalid))
    seen, strings = Observation(), set(string_columns(flat))
    cleaned = {c: CLEAN + c for c in gate.unique if c in strings}
    shared = {VALID: valid, **{name: text.clean_text(F.col(c)) for c, name in cleaned.items()}}
    counted = flat.withColumns(shared).observe(seen, *[c.alias(name) for name, c in staged_counts(flat, gate).items()])
    path = f"{target}.staged-{uuid.uuid4().hex}" if target else scratch_path(spark, gate.label)
    with small_methods(spark):
        normalize(counted.where(F.col(VALID)), gate.dates, gate.datetimes, cleaned, list(shared)).write.parquet(path)
    counts = seen.get
    try:
        if any(n for name, n in counts.items() if name.startswith("null:")):
            quality.assert_schema(flat, gate.contract, gate.label, gate.id_field, f"{issues_path}-schema" if issues_path else None)
        if counts["invalid"] and issues_path:
            removed = [("removed", ",".join(gate.drop_invalid), counts["invalid"], "null or invalid required fields")]
            save_issues(spark.createDataFrame(removed, quality.ISSUE_SCHEMA), gate.label, issues_path)
        # one row per check and column, as many as the gate lists
        issues = issue_rows(flat, read_parquet(spark, path), gate, counts, valid).collect()
        if issues:
            issues = spark.createDataFrame(issues, quality.ISSUE_SCHEMA)
            if issues_path:
                save_issues(issues, gate.label, issues_path)
            raise QualityError(f"[{gate.label}] quality check failed: " + "; ".join(r["message"] for r in quality.issue_text(issues).collect()))
    except ValueError:
        delete_path(spark, path)
        raise
    if target:
        publish(spark, path, target)
    return read_parquet(spark, target or path)


def curate_all(raw_jobs: DataFrame, raw_prospects: DataFrame, raw_applicants: DataFrame, target: str,
               issues_path: str | None = None) -> None:
    for raw, gate in ((raw_jobs, JOBS), (raw_prospects, PROSPECTS), (raw_applicants, APPLICANTS)):
        curate(raw, gate, issues_path, f"{target}/{gate.label}.parquet")
