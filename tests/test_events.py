import datetime as dt

from base_helpers import rows
from pyspark.sql import functions as F

from claimloom.operators import cleanse, events, money

LINE = (
    "master_seq bigint, key_seq bigint, seq_no int, person_id bigint, form_cd string, "
    "in_pat_cors_type string, vscn int, header_dt string, recu_fr_dt string, div_cd string, "
    "div_type_cd string, mdcn_exec_freq string, dd_mqty_exec_freq string, dd_mqty_freq string, "
    "clause_cd string, item_cd string, amt double, un_cost double"
)


def line(seq, code, kind, days="2", form="02", amt=10.0, cost=5.0):
    return (seq, seq, 1, 7, form, "00", 1, "20080101", "20080101", code, kind, days, "2", "0.5",
            "3", "1", amt, cost)


MAP = [
    ("drug", "A", 2, 2), ("drug", "A", 1, 1), ("procedure_only", "PPPPP", 30, 1),
    ("procedure_ambiguous", "QQQQQ", 31, 1), ("device_only", "D", 40, 1),
    ("device_ambiguous", "QQQQQ", 41, 1), ("procedure", "QQQQQ", 31, 1),
]


def code_map(spark):
    return spark.createDataFrame(
        MAP, "use string, source_code string, target_concept_id int, rn int"
    )


def test_drug_lines(spark):
    lines = spark.createDataFrame(
        [line(1, "A", "1"), line(2, "zz", "3", days="0.5"), line(3, "zz", "1"), line(4, None, "3")],
        LINE,
    )
    got = events.drug_lines(lines, code_map(spark), False)
    assert rows(got, "drug_exposure_id", "drug_concept_id", "quantity", "days_supply") == [
        (11, 1, 2.0, 2), (12, 2, 2.0, 2), (21, 0, 0.5, 0),
    ]
    ends = {r[0]: r[1].day for r in rows(got, "drug_exposure_id", "drug_exposure_end_date")}
    # days - 1 = -0.5 truncates to zero
    assert ends == {11: 2, 12: 2, 21: 1}
    assert rows(got.select("sig", "route_concept_id", "route_source_value").distinct()) == [
        ("03", 4128794, "03/01")
    ]


def test_procedure_prefix_and_kinds(spark):
    lines = spark.createDataFrame(
        [line(1, "PPPPPX", "1"), line(2, "PPPPP", "6"), line(3, "PPPPP", "3"),
         line(4, "QQQQQ", "2"), line(5, "QQQQQ", "6"), line(6, "other", "1"), line(7, "other", "6")],
        LINE,
    )
    got = events.procedure_lines(lines, code_map(spark), False)
    assert rows(got, "procedure_occurrence_id", "procedure_concept_id") == [
        (11, 30), (21, 30), (41, 31), (61, 0),
    ]
    only = events.procedure_lines(lines, code_map(spark), False, (events.AMBIGUOUS,))
    assert rows(only, "procedure_occurrence_id") == [(41,)]


def test_device_quantity(spark):
    lines = spark.createDataFrame(
        [line(1, "D", "7"), line(2, "D", "7", cost=20.0), line(3, "D", "6", cost=0.0),
         line(4, "D", "7", amt=None), line(5, "QQQQQ", "8"), line(6, "none", "8"),
         line(7, "none", "6"), line(8, "D", "1")],
        LINE,
    )
    got = events.device_lines(lines, code_map(spark), False)
    assert rows(got, "device_exposure_id", "device_concept_id", "quantity") == [
        (11, 40, 2), (21, 40, 2), (31, 40, 2), (41, 40, 2), (51, 41, 2), (61, 0, 2),
    ]


def test_conditions(spark):
    schema = (
        "master_seq bigint, key_seq bigint, seq_no int, person_id bigint, form_cd string, "
        "in_pat_cors_type string, vscn int, header_dt string, recu_fr_dt string, sick_sym string"
    )
    base = (7, "02", None, 3, "20080101")
    k40 = spark.createDataFrame(
        [(1, 1, 1, *base, "20080105", "K"), (2, 1, 2, *base, "20090105", "K"),
         (3, 1, 3, *base, "20080105", "else"), (4, 1, 9, *base, "20080105", "none"),
         (5, 1, 10, *base, "20080105", None)],
        schema,
    )
    mapping = spark.createDataFrame(
        [("condition", "K", 5, 2), ("condition", "K", 9, 1), ("elsewhere", "else", None, 1)],
        "use string, source_code string, target_concept_id int, rn int",
    )
    periods = spark.createDataFrame(
        [(7, dt.date(2008, 1, 2), dt.date(2008, 12, 31))],
        "person_id bigint, observation_period_start_date date, observation_period_end_date date",
    )
    got = events.condition_occurrence(k40, periods, mapping)
    assert rows(
        got, "condition_occurrence_id", "condition_concept_id", "condition_type_concept_id",
        "condition_start_date", "condition_end_date",
    ) == [
        (11, 9, 44786627, dt.date(2008, 1, 1), dt.date(2008, 1, 3)),
        (12, 5, 44786627, dt.date(2008, 1, 1), dt.date(2008, 1, 3)),
        (41, 0, 45756847, dt.date(2008, 1, 1), dt.date(2008, 1, 3)),
    ]


def test_deaths_limit_drugs(spark):
    drug = spark.createDataFrame(
        [(1, 7, dt.date(2008, 1, 1), dt.date(2008, 1, 9)), (2, 7, dt.date(2008, 2, 1), dt.date(2008, 2, 2)),
         (3, 8, dt.date(2008, 1, 1), dt.date(2008, 1, 9))],
        "drug_exposure_id bigint, person_id bigint, drug_exposure_start_date date, "
        "drug_exposure_end_date date",
    )
    deaths = spark.createDataFrame(
        [(7, dt.date(2008, 1, 5)), (7, dt.date(2008, 1, 31))], "person_id bigint, death_date date"
    )
    alive = events.drug_after_death_removed(drug, deaths)
    assert rows(alive, "drug_exposure_id") == [(1,), (3,)]
    clipped = events.drug_end_clipped_to_death(alive, deaths)
    assert {r[0]: r[1].day for r in rows(clipped, "drug_exposure_id", "drug_exposure_end_date")} == {
        1: 5, 3: 9,
    }


def test_cleansing(spark):
    payer = spark.createDataFrame(
        [(1, 7, dt.date(2008, 1, 1), dt.date(2008, 12, 31)), (2, 7, dt.date(2009, 1, 1), dt.date(2008, 3, 1)),
         (3, 7, dt.date(2008, 1, 1), None)],
        "payer_plan_period_id bigint, person_id bigint, payer_plan_period_start_date date, "
        "payer_plan_period_end_date date",
    )
    periods = spark.createDataFrame(
        [(7, dt.date(2008, 1, 1), dt.date(2008, 12, 31))],
        "person_id bigint, observation_period_start_date date, observation_period_end_date date",
    )
    # Only start >= first day and end <= last day are tested, so a period that ends before it
    # starts stays; a missing end never fits.
    assert rows(cleanse.cleanse_payer_plan(payer, periods), "payer_plan_period_id") == [(1,), (2,)]
    device = spark.createDataFrame([(0,), (2,), (None,)], "quantity int")
    assert rows(cleanse.device_quantity_zero_to_one(device)) == [(1,), (2,), (None,)]


def test_mapped_ambiguous_unmapped_cover_all_lines(stages):
    """Procedure lines of type 1 and 2 with a code fall into exactly one kind."""
    own = stages.k30.where(F.col("div_type_cd").isin("1", "2") & F.col("div_cd").isNotNull())
    got = events.procedure_lines(own, stages.code_map, False)
    lines = got.select((F.floor(F.col("procedure_occurrence_id") / 10)).alias("m")).distinct()
    assert lines.count() == own.count()


def test_line_costs_match_one_by_one(stages):
    whole = money.cost(
        stages.visit, stages.drug, stages.procedure, stages.device, stages.t20,
        stages.k30, stages.k60, stages.code_map,
    )
    parts = money.cost_visit(stages.visit, stages.t20)
    for keyed, tag in ((stages.k30, "130"), (stages.k60, "160")):
        parts = (
            parts.unionByName(money.cost_drug(stages.drug, keyed, tag))
            .unionByName(money.cost_procedure(stages.procedure, keyed, tag))
            .unionByName(money.cost_device(stages.device, keyed, tag, stages.code_map))
        )
    assert rows(whole) == rows(parts)
