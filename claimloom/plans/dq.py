"""The data-quality run: every coverage report as one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality
from ..work import store

DOMAINS = (
    "drug_exposure",
    "procedure_occurrence",
    "device_exposure",
    "condition_occurrence",
    "measurement",
)


LINE_REPORTS = {
    "drug_exposure": (
        ("mapped", quality.dq_drug_mapped),
        ("unmapped", quality.dq_drug_unmapped),
        ("raw", quality.dq_drug_raw),
    ),
    "procedure_occurrence": (
        ("mapped", quality.dq_procedure_mapped),
        ("ambiguous", quality.dq_procedure_ambiguous),
        ("unmapped", quality.dq_procedure_unmapped),
        ("raw", quality.dq_procedure_raw),
    ),
    "device_exposure": (
        ("mapped", quality.dq_device_mapped),
        ("ambiguous", quality.dq_device_ambiguous),
        ("unmapped", quality.dq_device_unmapped),
        ("raw", quality.dq_device_raw),
    ),
}


def run_dq(
    t30: DataFrame, t40: DataFrame, t60: DataFrame, gj: DataFrame,
    k30: DataFrame, k40: DataFrame, k60: DataFrame,
    code_map: DataFrame, measurement_map: DataFrame,
    domains: tuple[str, ...] = DOMAINS,
) -> DataFrame:
    """All reports of the chosen domains as (domain, item, div_type, multimapped, count).

    The claim tables are scanned once each: their code counts go into one stored table of
    the size of the vocabulary, and all reports read that.
    """
    chosen = [domain for domain in LINE_REPORTS if domain in domains]
    sources = {}
    if chosen:
        sources |= {"raw_30t": t30, "keyed_30t": k30, "raw_60t": t60, "keyed_60t": k60}
    if "condition_occurrence" in domains:
        sources |= {"raw_40t": t40, "keyed_40t": k40}
    counted = [
        quality.code_counts(df, "sick_sym" if name.endswith("40t") else "div_cd").withColumn(
            "source", F.lit(name)
        )
        for name, df in sources.items()
    ]
    parts: list[tuple[DataFrame, str, str]] = []
    if counted:
        stored = store(reduce(DataFrame.unionByName, counted), "code-counts", ("source",))

    def counts(name: str) -> DataFrame:
        return stored.where(F.col("source") == name)

    for tag in ("30t", "60t"):
        for domain in chosen:
            for kind, report in LINE_REPORTS[domain]:
                rows = counts(f"raw_{tag}" if kind == "raw" else f"keyed_{tag}")
                parts.append((report(rows, code_map), domain, f"{kind}_{tag}"))
    if "condition_occurrence" in domains:
        name, keyed = "condition_occurrence", counts("keyed_40t")
        parts += [
            (quality.dq_condition_mapped(keyed, code_map), name, "mapped_40t"),
            (quality.dq_condition_unmapped(keyed, code_map), name, "unmapped_40t"),
            (quality.dq_condition_raw(counts("raw_40t"), code_map), name, "raw_40t"),
        ]
    if "measurement" in domains:
        parts += [
            (quality.dq_measurement_numeric(gj, measurement_map), "measurement", "mapped_gj_numeric"),
            (quality.dq_measurement_coded(gj, measurement_map), "measurement", "mapped_gj_code"),
        ]
    return quality.dq_report(parts)
