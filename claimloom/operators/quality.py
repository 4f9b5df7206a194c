"""Data-quality reports: mapping coverage, forecasts, odd values and key integrity.

Coverage is counted from lines per code and targets per code, both vocabulary-sized, so no
line is fanned out and shuffled just to be counted again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import codes
from . import screening, vocab
from .events import DEVICE_LINES, DRUG_LINES, PROCEDURE_LINES
from .keys import unsent

# Foreign keys that hold integers; the other non-concept keys are vocabulary names.
INTEGER_KEYS = {
    field.name
    for schema in (*schemas.CDM.values(), *schemas.VOCABULARY.values())
    for field in schema
    if field.dataType.typeName() in ("integer", "long")
}
MEASUREMENT_ITEMS = screening.NUMERIC_ITEMS + screening.CODED_ITEMS


def code_counts(lines: DataFrame, code: str = "div_cd") -> DataFrame:
    """Lines per code and line type: all that mapping coverage depends on.

    One scan with a map-side count turns the lines into a vocabulary-sized table; every
    coverage report reads that and no report touches the lines again.
    """
    typed = "div_type_cd" in lines.columns
    line_type = F.col("div_type_cd") if typed else codes.null("string")
    return lines.groupBy(line_type.alias("div_type_cd"), F.col(code).alias("code")).agg(
        F.count("*").alias("lines")
    )


def _sum(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).alias("count")


def _mapped(counts: DataFrame, mapping: DataFrame, code: Column) -> DataFrame:
    """Codes of the given part of the code map, with their number of targets."""
    per_code = mapping.where(F.col("rn") == 1).select("source_code", "targets")
    return counts.join(per_code, code == F.col("source_code"))


def _rows(counts: DataFrame, mapping: DataFrame, code: Column) -> DataFrame:
    """Rows of the 1:N join with the map."""
    return _mapped(counts, mapping, code).agg(_sum(F.col("lines") * F.col("targets")))


def _unmapped(counts: DataFrame, mapping: DataFrame, code: Column) -> DataFrame:
    return vocab.unmapped_codes(counts, mapping, code).agg(_sum(F.col("lines")))


def _histogram(counts: DataFrame, mapping: DataFrame, code: Column, by: list[str]) -> DataFrame:
    """Lines by their number of targets (and ``by``)."""
    return (
        _mapped(counts, mapping, code)
        .groupBy(*by, F.col("targets").alias("multimapped"))
        .agg(F.sum("lines").alias("count"))
    )


def _once(counts: DataFrame) -> DataFrame:
    return counts.groupBy("div_type_cd").agg(F.sum("lines").alias("count")).select(
        "div_type_cd", F.lit(1).cast("bigint").alias("multimapped"), "count"
    )


# --- drugs --------------------------------------------------------------------------------


def dq_drug_mapped(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    return _histogram(counts, vocab.used(code_map, vocab.DRUG), F.col("code"), [])


def dq_drug_unmapped(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    drug = counts.where(F.col("div_type_cd").isin(*DRUG_LINES))
    return _unmapped(drug, vocab.used(code_map, vocab.DRUG), F.col("code"))


def dq_drug_raw(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    drug_line = F.col("div_type_cd").isin(*DRUG_LINES)
    mapping = vocab.used(code_map, vocab.DRUG)
    other = _histogram(counts.where(~drug_line), mapping, F.col("code"), ["div_type_cd"])
    return other.unionByName(_once(counts.where(drug_line)))


# --- procedures ---------------------------------------------------------------------------


def _prefix() -> Column:
    return F.substring("code", 1, 5)


def _candidates(counts: DataFrame) -> DataFrame:
    """Lines of the types that a procedure code may convert."""
    return counts.where(~F.col("div_type_cd").isin(*DRUG_LINES, *DEVICE_LINES))


def _procedures(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("div_type_cd").isin(*PROCEDURE_LINES))


def dq_procedure_mapped(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    return _rows(_candidates(counts), vocab.used(code_map, vocab.PROCEDURE_ONLY), _prefix())


def dq_procedure_ambiguous(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    return _rows(_procedures(counts), vocab.used(code_map, vocab.PROCEDURE_AMBIGUOUS), _prefix())


def dq_procedure_unmapped(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    either = vocab.used(code_map, vocab.PROCEDURE_ONLY, vocab.PROCEDURE_AMBIGUOUS)
    return _unmapped(_procedures(counts), either, _prefix())


def dq_procedure_raw(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    exclusive = vocab.used(code_map, vocab.PROCEDURE_ONLY)
    ambiguous = vocab.used(code_map, vocab.PROCEDURE_AMBIGUOUS)
    either = vocab.used(code_map, vocab.PROCEDURE_ONLY, vocab.PROCEDURE_AMBIGUOUS)
    return (
        _histogram(_candidates(counts), exclusive, _prefix(), ["div_type_cd"])
        .unionByName(_histogram(_procedures(counts), ambiguous, _prefix(), ["div_type_cd"]))
        .unionByName(_once(vocab.unmapped_codes(_procedures(counts), either, _prefix())))
    )


# --- devices ------------------------------------------------------------------------------


def _devices(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("div_type_cd").isin(*DEVICE_LINES))


def dq_device_mapped(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    lines = counts.where(~F.col("div_type_cd").isin(*PROCEDURE_LINES, *DRUG_LINES))
    return _rows(lines, vocab.used(code_map, vocab.DEVICE_ONLY), F.col("code"))


def dq_device_ambiguous(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    return _rows(
        _devices(counts), vocab.used(code_map, vocab.DEVICE_AMBIGUOUS), F.col("code")
    )


def dq_device_unmapped(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    either = vocab.used(code_map, vocab.DEVICE_ONLY, vocab.DEVICE_AMBIGUOUS)
    return _unmapped(_devices(counts), either, F.col("code"))


def dq_device_raw(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    other = counts.where(
        ~F.col("div_type_cd").isin(*PROCEDURE_LINES, *DRUG_LINES, *DEVICE_LINES)
    )
    mapping = vocab.used(code_map, vocab.DEVICE_ONLY)
    return _histogram(other, mapping, F.col("code"), ["div_type_cd"]).unionByName(
        _once(_devices(counts))
    )


# --- conditions ---------------------------------------------------------------------------


def dq_condition_mapped(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    return _rows(counts, vocab.used(code_map, vocab.CONDITION), F.col("code"))


def dq_condition_unmapped(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    known = vocab.used(code_map, vocab.CONDITION, vocab.ELSEWHERE)
    return _unmapped(counts, known, F.col("code"))


def dq_condition_raw(counts: DataFrame, code_map: DataFrame) -> DataFrame:
    mapped = _histogram(
        counts, vocab.used(code_map, vocab.CONDITION), F.col("code"), []
    ).select(F.lit("condition").alias("domain_id"), "multimapped", "count")
    rest = dq_condition_unmapped(counts, code_map).select(
        F.lit("Unclassified").alias("domain_id"),
        F.lit(1).cast("bigint").alias("multimapped"),
        "count",
    )
    return mapped.unionByName(rest)


# --- measurements -------------------------------------------------------------------------


def _screening_hits(gj: DataFrame, items: tuple[str, ...], rules: DataFrame) -> DataFrame:
    """Answers that map, times the screening rows of the person-year they are joined back to."""
    answers = screening.gj_vertical(gj, items).where(F.col("meas_value") != "")
    hits = screening.match_rules(answers, rules)
    copies = gj.groupBy("person_id", "hchk_year").agg(F.count("*").alias("copies"))
    per_year = hits.groupBy("person_id", "hchk_year").agg(F.count("*").alias("hits"))
    return per_year.join(unsent(copies), ["person_id", "hchk_year"]).agg(
        _sum(F.col("hits") * F.col("copies"))
    )


def dq_measurement_numeric(gj: DataFrame, measurement_map: DataFrame) -> DataFrame:
    rules = screening.numeric_rules(measurement_map)
    return _screening_hits(gj, screening.NUMERIC_ITEMS, rules)


def dq_measurement_coded(gj: DataFrame, measurement_map: DataFrame) -> DataFrame:
    return _screening_hits(gj, screening.CODED_ITEMS, screening.coded_rules(measurement_map))


def dq_item_counts(gj: DataFrame) -> DataFrame:
    """Screenings with a value, per observation item."""
    items = screening.GJ_ITEMS[len(MEASUREMENT_ITEMS) :]
    return (
        screening.gj_vertical(gj, items)
        .where(F.col("meas_value") != "")
        .groupBy("meas_type")
        .agg(F.count("*").alias("count"))
    )


# --- the collected report -----------------------------------------------------------------


def report_part(df: DataFrame, domain: str, item: str) -> DataFrame:
    """One result as rows (domain, item, div_type, multimapped, count)."""
    div_type = "div_type_cd" if "div_type_cd" in df.columns else "domain_id"
    return df.select(
        F.lit(domain).alias("domain"),
        F.lit(item).alias("item"),
        (F.col(div_type) if div_type in df.columns else codes.null("string")).alias("div_type"),
        (
            F.col("multimapped") if "multimapped" in df.columns else codes.null("bigint")
        ).alias("multimapped"),
        F.col("count").cast("bigint").alias("count"),
    )


def dq_report(parts: list[tuple[DataFrame, str, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [report_part(*part) for part in parts])


# --- forecasts and odd values -------------------------------------------------------------


def dq_expected_rows(counts: DataFrame, source_map: DataFrame, domain: str) -> DataFrame:
    """Forecast of converted rows: 1:N rows, lines with a code in the map, and the excess.

    ``counts`` are the code counts of lines that have a header.
    """
    valid = source_map.where((F.col("domain_id") == domain) & F.col("invalid_reason").isNull())
    lines, targets = F.col("lines"), F.col("targets")
    several = targets > 1
    hits = counts.join(vocab.target_counts(valid), F.col("code") == F.col("source_code"))
    return hits.agg(
        _sum(lines * targets).alias("expected_rows"),
        _sum(lines).alias("expected_lines"),
        _sum(F.when(several, lines * (targets - 1))).alias("extra_rows"),
        _sum(F.when(several, lines)).alias("multi_mapped_lines"),
    )


def dq_non_numeric(lines: DataFrame, column: str) -> DataFrame:
    """Dose text that is no number, by frequency."""
    text = F.col(column)
    return (
        lines.where(text.isNotNull() & codes.number(text).isNull())
        .groupBy(text.alias("value"))
        .agg(F.count("*").alias("count"))
    )


def dq_line_keys(
    sources: dict[str, tuple[DataFrame, str]], code_map: DataFrame, uses: dict[str, str], most: int = 9
) -> DataFrame:
    """(source, item, rows): lines that bend the rules of ids and dates, per source.

    ``rank_overflow`` counts event rows whose target ranks above ``most``: an event id has one
    digit for the rank, so id + 10 of such a row is an id of the next line. ``duplicate_lines``
    counts lines that share (key_seq, seq_no) with another, ``unreadable_dates`` those whose
    ``recu_fr_dt`` is a text but no date. ``sources`` gives lines and their code column, ``uses``
    the part of the code map that converts them.
    """
    parts = []
    for name, (lines, code) in sources.items():
        beyond = (
            vocab.used(code_map, uses[name])
            .where(F.col("rn") > most)
            .groupBy("source_code")
            .agg(F.count("*").alias("n"))
        )
        counted = lines.groupBy(F.col(code).alias("_code")).agg(F.count("*").alias("lines"))
        overflow = counted.join(beyond, F.col("_code") == F.col("source_code")).agg(
            _sum(F.col("lines") * F.col("n"))
        )
        twice = lines.groupBy("key_seq", "seq_no").count().where(F.col("count") > 1)
        date = F.col("recu_fr_dt")
        odd = lines.where(date.isNotNull() & codes.ymd(date).isNull()).agg(
            F.count("*").alias("count")
        )
        for item, rows in (
            ("rank_overflow", overflow),
            ("duplicate_lines", twice.agg(_sum(F.col("count")))),
            ("unreadable_dates", odd),
        ):
            parts.append(
                rows.select(
                    F.lit(name).alias("source"), F.lit(item).alias("item"), F.col("count").alias("rows")
                )
            )
    return reduce(DataFrame.unionByName, parts)


def dq_code_pairs(t30: DataFrame) -> DataFrame:
    return t30.groupBy("clause_cd", "item_cd").agg(F.count("clause_cd").alias("count"))


def dq_multi_mapped_codes(source_map: DataFrame, domain: str = "drug") -> DataFrame:
    valid = source_map.where((F.col("domain_id") == domain) & F.col("invalid_reason").isNull())
    return vocab.target_counts(valid).where(F.col("targets") > 1)


def dq_outside_period(drug: DataFrame, periods: DataFrame, deaths: DataFrame) -> DataFrame:
    """Exposures of deceased persons outside a period, one row per period missed."""
    start, end = "observation_period_start_date", "observation_period_end_date"
    return (
        drug.select(
            "person_id", "drug_exposure_id", "drug_exposure_start_date", "drug_exposure_end_date"
        )
        .join(unsent(periods.select("person_id", start, end)), "person_id")
        .where(
            (F.col("drug_exposure_start_date") < F.col(start))
            | (F.col("drug_exposure_end_date") > F.col(end))
        )
        .join(unsent(deaths.select("person_id", "death_date")), "person_id")
        .select(
            "person_id",
            "drug_exposure_id",
            "drug_exposure_start_date",
            "drug_exposure_end_date",
            start,
            end,
            "death_date",
        )
    )


def dq_dose_outliers(
    lines: DataFrame, source_map: DataFrame, concept: DataFrame, column: str, above: bool
) -> DataFrame:
    """Drug lines whose dose is above one, or in [0, 1), with the name of the drug concept.

    Text that is no number is skipped (the source system stops with an error there).
    """
    dose = codes.number(F.col(column))
    odd = dose > 1 if above else (dose >= 0) & (dose < 1)
    drug = source_map.where(F.col("domain_id") == "drug").select("source_code", "target_concept_id")
    names = concept.select(F.col("concept_id").alias("target_concept_id"), "concept_name")
    return (
        lines.where(odd)
        .join(drug.join(names, "target_concept_id"), F.col("div_cd") == F.col("source_code"))
        .select("key_seq", "seq_no", "div_cd", F.col(column), "target_concept_id", "concept_name")
    )


# --- integrity ----------------------------------------------------------------------------


def _keys_check(table: str, df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .agg(
            F.count("*").alias("duplicate_keys"),
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        )
        .select(F.lit(table).alias("table_name"), "duplicate_keys", "rows")
    )


def check_primary_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys that occur more than once, per table that is given."""
    return reduce(
        DataFrame.unionByName,
        [
            _keys_check(name, tables[name], key)
            for name, key in schemas.PRIMARY_KEYS.items()
            if name in tables
        ],
    )


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            _keys_check(name, tables[name], key)
            for name, key in schemas.UNIQUE.items()
            if name in tables
        ],
    )


def _reference_values(
    tables: dict[str, DataFrame], relations: list[tuple[str, str, str, str]], kind: str
) -> tuple[DataFrame, DataFrame]:
    """Counted child values and known parent keys, both as (table, value) rows of one type."""
    children, parents = [], []
    for child in sorted({r[0] for r in relations}):
        columns = [r[1] for r in relations if r[0] == child]
        values = (
            tables[child]
            .select(*[F.col(c).cast(kind).alias(c) for c in columns])
            .unpivot([], columns, "child_column", "value")
            .where(F.col("value").isNotNull())
            .groupBy("child_column", "value")
            .agg(F.count("*").alias("rows"))
        )
        children.append(values.withColumn("child_table", F.lit(child)))
    for parent, column in sorted({r[2:] for r in relations}):
        keys = tables[parent].select(F.col(column).cast(kind).alias("value")).distinct()
        parents.append(keys.withColumn("parent_table", F.lit(parent)))
    return reduce(DataFrame.unionByName, children), reduce(DataFrame.unionByName, parents)


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Values without a parent, for every relation whose child, column and parent are given.

    Each child table is scanned once: its foreign-key columns are unpivoted and counted per
    value before the shuffle, then one anti join serves all relations. A relation whose
    child column the table does not carry is all NULL and has no orphans.
    """
    given = [
        r
        for r in schemas.FOREIGN_KEYS
        if r[0] in tables and r[2] in tables and r[1] in tables[r[0]].columns
    ]
    spark = next(iter(tables.values())).sparkSession
    relations = spark.createDataFrame(
        [r[:3] for r in given], "child_table string, child_column string, parent_table string"
    )
    orphans = []
    for kind in ("bigint", "string"):
        own = [r for r in given if (r[1] in INTEGER_KEYS) == (kind == "bigint")]
        if not own:
            continue
        values, known = _reference_values(tables, own, kind)
        orphans.append(
            values.join(F.broadcast(relations), ["child_table", "child_column"])
            .join(unsent(known), ["parent_table", "value"], "left_anti")
            .groupBy("child_table", "child_column")
            .agg(F.count("*").alias("orphan_keys"), F.sum("rows").alias("orphan_rows"))
        )
    found = reduce(DataFrame.unionByName, orphans)
    zero = F.lit(0).cast("bigint")
    return relations.join(found, ["child_table", "child_column"], "left").select(
        "child_table",
        "child_column",
        "parent_table",
        F.coalesce("orphan_keys", zero).alias("orphan_keys"),
        F.coalesce("orphan_rows", zero).alias("orphan_rows"),
    )


def check_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """NULLs in NOT NULL columns and texts longer than declared: one pass over all tables.

    Rows that break no rule go no further than the scan; the others are counted once per rule they
    break, in one aggregate for all tables. Rules that hold come back with 0 rows.
    """
    rules, broken = [], []
    for name, df in tables.items():
        tests = {}
        for field in schemas.CDM.get(name) or schemas.VOCABULARY[name]:
            if field.name not in df.columns:
                continue
            if not field.nullable:
                tests[field.name, "null"] = f"`{field.name}` is null"
            if "length" in field.metadata:
                text = f"cast(`{field.name}` as string)"
                tests[field.name, "length"] = f"ifnull(length({text}) > {field.metadata['length']}, false)"
        if not tests:
            continue
        rules += [(name, *rule) for rule in tests]
        # As text: a table has some dozens of rules, and all tables have them at once.
        named = ", ".join(f"case when {test} then '{':'.join(rule)}' end" for rule, test in tests.items())
        broken.append(
            df.where(" or ".join(tests.values())).selectExpr(
                f"'{name}' as table_name", f"explode(array_compact(array({named}))) as check"
            )
        )
    found = (
        reduce(DataFrame.unionByName, broken)
        .groupBy("table_name", F.split("check", ":").alias("check"))
        .agg(F.count("*").alias("found"))
        .select("table_name", F.col("check")[0].alias("column_name"), F.col("check")[1].alias("rule"), "found")
    )
    spark = next(iter(tables.values())).sparkSession
    known = spark.createDataFrame(rules, "table_name string, column_name string, rule string")
    return known.join(found, ["table_name", "column_name", "rule"], "left").select(
        "table_name", "column_name", "rule", F.coalesce("found", F.lit(0)).cast("bigint").alias("rows")
    )
