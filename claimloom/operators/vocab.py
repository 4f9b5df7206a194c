"""Vocabulary: the source-to-concept map and joins of claim codes with it.

Maps are never broadcast by hint: their size grows with the vocabulary, so the choice is
left to the statistics-based threshold and to AQE, with a sort-merge join beyond it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normalise_vocabulary(df: DataFrame) -> DataFrame:
    """Undo what a case- and blank-insensitive collation hides: trailing blanks, '' for NULL.

    ``domain_id`` is lower-cased and an empty ``invalid_reason`` or ``standard_concept``
    becomes NULL, so later comparisons are plain.
    """
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.dataType.typeName() == "string":
            column = F.rtrim(column)
            if field.name in ("invalid_reason", "standard_concept"):
                column = F.nullif(column, F.lit(""))
            if field.name == "domain_id":
                column = F.lower(column)
        out.append(column.alias(field.name))
    return df.select(*out)


def build_source_map(concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Source code -> target concept over valid 'Maps to' relations and valid targets."""
    source = concept.where(
        F.col("concept_code").isNotNull() & F.col("vocabulary_id").isNotNull()
    ).select(
        F.col("concept_code").alias("source_code"),
        F.col("concept_id").alias("source_concept_id"),
        F.col("vocabulary_id").alias("source_vocabulary_id"),
        F.col("concept_name").alias("source_code_description"),
    )
    target = concept.where(F.col("invalid_reason").isNull() & F.col("domain_id").isNotNull()).select(
        F.col("concept_id").alias("target_concept_id"),
        F.col("vocabulary_id").alias("target_vocabulary_id"),
        "domain_id",
    )
    maps_to = relationship.where(
        (F.col("relationship_id") == "Maps to") & F.col("invalid_reason").isNull()
    ).select(
        F.col("concept_id_1").alias("source_concept_id"),
        F.col("concept_id_2").alias("target_concept_id"),
        "valid_start_date",
        "valid_end_date",
        "invalid_reason",
    )
    return (
        maps_to.join(source, "source_concept_id")
        .join(target, "target_concept_id")
        .select(
            "source_code",
            "source_concept_id",
            "source_vocabulary_id",
            "source_code_description",
            "target_concept_id",
            "target_vocabulary_id",
            "valid_start_date",
            "valid_end_date",
            "invalid_reason",
            "domain_id",
        )
    )


def mapping_all(source_map: DataFrame, concept: DataFrame) -> DataFrame:
    """Valid map rows whose target concept is valid too, any domain."""
    valid = concept.where(F.col("invalid_reason").isNull()).select(
        F.col("concept_id").alias("target_concept_id")
    )
    return (
        source_map.where(F.col("invalid_reason").isNull())
        .join(valid, "target_concept_id")
        .select("source_code", "target_concept_id", "domain_id")
    )


def mapping_for(source_map: DataFrame, concept: DataFrame, domain: str) -> DataFrame:
    return mapping_all(source_map.where(F.col("domain_id") == domain), concept)


def ambiguous_codes(source_map: DataFrame, domain: str, other: str) -> DataFrame:
    """Map rows of ``domain`` whose code is also mapped to ``other``, one row per pair.

    Invalid reasons are compared with NULL after normalising, for both domains alike.
    """
    valid = source_map.where(F.col("invalid_reason").isNull())
    rows = valid.where(F.col("domain_id") == domain)
    pairs = valid.where(F.col("domain_id") == other).select("source_code")
    return rows.join(pairs, "source_code").select("source_code", "target_concept_id", "domain_id")


def exclusive_mapping(
    source_map: DataFrame, concept: DataFrame, domain: str, other: str
) -> DataFrame:
    """Valid map of ``domain`` without the codes that are ambiguous with ``other``."""
    return mapping_for(source_map, concept, domain).join(
        ambiguous_codes(source_map, domain, other), "source_code", "left_anti"
    )


def target_rank(mapping: DataFrame, descending: bool = False) -> DataFrame:
    """Add ``rn``, the order of a target among the targets of its code, and their number.

    (key_seq, seq_no) is the key of a claim line and a line meets all targets of its one
    code, so numbering the targets per line equals numbering them per code. The window runs
    over the map and not over the lines.
    """
    target = F.col("target_concept_id")
    order = target.desc() if descending else target.asc()
    code = Window.partitionBy("source_code")
    return mapping.withColumns(
        {"rn": F.row_number().over(code.orderBy(order)), "targets": F.count("*").over(code)}
    )


def map_codes(df: DataFrame, mapping: DataFrame, code: Column) -> DataFrame:
    """1:N inner join on the exact code."""
    return df.join(mapping, code == F.col("source_code"))


def map_codes_prefix(df: DataFrame, mapping: DataFrame, code: Column, length: int = 5) -> DataFrame:
    """1:N inner join on the leading characters of the code."""
    return df.join(mapping, F.substring(code, 1, length) == F.col("source_code"))


def unmapped_codes(df: DataFrame, mapping: DataFrame, code: Column) -> DataFrame:
    """Rows whose code is NOT IN the map. A NULL code is neither in nor not in: no row."""
    codes = mapping.select("source_code")
    return df.where(code.isNotNull()).join(codes, code == F.col("source_code"), "left_anti")


# Uses of the code map; "elsewhere" holds codes whose valid targets are in other domains only.
DRUG, CONDITION, ELSEWHERE = "drug", "condition", "elsewhere"
PROCEDURE, PROCEDURE_ONLY, PROCEDURE_AMBIGUOUS = "procedure", "procedure_only", "procedure_ambiguous"
DEVICE_ONLY, DEVICE_AMBIGUOUS = "device_only", "device_ambiguous"
CODE_MAP_COLUMNS = ("source_code", "target_concept_id", "rn", "targets")


def code_map(source_map: DataFrame, concept: DataFrame) -> DataFrame:
    """All maps the conversion uses, in one table: use, code, target, its rank, targets of the code.

    It is vocabulary-sized. The pipeline stores it once, partitioned by use, and every
    target table reads only its part.
    """
    valid = mapping_all(source_map, concept)
    exclusive = [
        (use, exclusive_mapping(source_map, concept, own, other))
        for use, own, other in (
            (PROCEDURE_ONLY, "procedure", "device"),
            (DEVICE_ONLY, "device", "procedure"),
        )
    ]
    ambiguous = [
        (PROCEDURE_AMBIGUOUS, ambiguous_codes(source_map, "procedure", "device")),
        (DEVICE_AMBIGUOUS, ambiguous_codes(source_map, "device", "procedure")),
    ]
    per_domain = [
        (DRUG, valid.where(F.col("domain_id") == "drug")),
        (PROCEDURE, valid.where(F.col("domain_id") == "procedure")),
    ]
    elsewhere = (
        valid.groupBy("source_code")
        .agg(F.max((F.col("domain_id") == "condition").cast("int")).alias("hit"))
        .where(F.col("hit") == 0)
        .select("source_code", F.lit(None).cast("int").alias("target_concept_id"))
    )
    parts = [
        target_rank(part).select(F.lit(use).alias("use"), *CODE_MAP_COLUMNS)
        for use, part in (*per_domain, *exclusive, *ambiguous, (ELSEWHERE, elsewhere))
    ]
    condition = target_rank(valid.where(F.col("domain_id") == "condition"), descending=True)
    parts.append(condition.select(F.lit(CONDITION).alias("use"), *CODE_MAP_COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def used(codes: DataFrame, *uses: str) -> DataFrame:
    """The part of the code map for the given uses."""
    return codes.where(F.col("use").isin(*uses))


def target_counts(mapping: DataFrame) -> DataFrame:
    """Targets per code: the fan-out of a line, known without joining any line."""
    return mapping.groupBy("source_code").agg(F.count("*").alias("targets"))


def ingredient_map(ancestor: DataFrame, concept: DataFrame) -> DataFrame:
    """(drug_concept_id, ingredient_concept_id): RxNorm ingredients of every drug concept.

    The pipeline stores it once, so its size is known when exposures are joined with it.
    """
    ingredient = concept.where(
        F.col("vocabulary_id").isin("RxNorm", "RxNorm Extension")
        & (F.col("concept_class_id") == "Ingredient")
    ).select(F.col("concept_id").alias("ingredient_concept_id"))
    return (
        ancestor.select(
            F.col("ancestor_concept_id").alias("ingredient_concept_id"),
            F.col("descendant_concept_id").alias("drug_concept_id"),
        )
        .join(ingredient, "ingredient_concept_id")
        .select("drug_concept_id", "ingredient_concept_id")
    )


def ingredient_rollup(drug: DataFrame, ingredients: DataFrame) -> DataFrame:
    """Each exposure once per RxNorm ingredient of its drug concept."""
    return drug.join(ingredients, "drug_concept_id")
