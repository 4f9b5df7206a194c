"""The registered queries: a Spark plan over the bound tables and its oracle per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import cleanse, eras, events, keys, money, person, quality, screening, visits, vocab
from ..plans import dq, etl
from ..sources import loader, sinks
from ..work import fresh_path
from . import increments, loads, oracle, streams
from .stages import Stages

TODAY = dt.date(2020, 1, 1)


@dataclass(frozen=True)
class Query:
    name: str
    columns: list[tuple[str, str]]
    plan: Callable[[Stages], DataFrame]
    sql: str | None

    def run(self, spark, folder: str) -> DataFrame:
        df = self.plan(Stages(spark, folder))
        out = []
        for name, kind in self.columns:
            column = F.col(name).cast(kind)
            out.append((F.round(column, 6) if kind == "double" else column).alias(name))
        return df.select(*out)

    def oracle(self) -> str | None:
        return self.sql and oracle.compile_sql(self.sql, self.columns)


QUERIES: dict[str, Query] = {}


def _columns(text: str) -> list[tuple[str, str]]:
    """``"id name:string day:date"``; the default type is bigint."""
    return [(c.split(":") + ["bigint"])[:2] for c in text.split()]


def query(name: str, columns: str, plan: Callable[[Stages], DataFrame], sql: str | None) -> None:
    """``sql`` is a SELECT over oracle relations in braces, or just the name of one."""
    if sql and " " not in sql:
        sql = f"select * from {{{sql}}}"
    QUERIES[name] = Query(name, _columns(columns), plan, sql)


# --- column sets --------------------------------------------------------------------------

SEQ = "master_seq source_table:string person_id key_seq seq_no hchk_year:string stnd_y:string"
MAP = "source_code:string target_concept_id domain_id:string"
SOURCE_MAP = (
    "source_code:string source_concept_id source_vocabulary_id:string "
    "source_code_description:string target_concept_id target_vocabulary_id:string "
    "valid_start_date:date valid_end_date:date invalid_reason:string domain_id:string"
)
PERSON = (
    "person_id gender_concept_id year_of_birth race_concept_id ethnicity_concept_id location_id "
    "person_source_value:string gender_source_value:string"
)
DEATH = (
    "person_id death_date:date death_type_concept_id cause_concept_id cause_source_value:string"
)
PERIOD = (
    "person_id observation_period_start_date:date observation_period_end_date:date "
    "period_type_concept_id"
)
CARE_SITE = (
    "care_site_id place_of_service_concept_id location_id care_site_source_value:string "
    "place_of_service_source_value:string"
)
VISIT = (
    "visit_occurrence_id person_id visit_concept_id visit_start_date:date visit_end_date:date "
    "visit_type_concept_id care_site_id visit_source_value:string"
)
CONDITION = (
    "condition_occurrence_id person_id condition_concept_id condition_start_date:date "
    "condition_end_date:date condition_type_concept_id visit_occurrence_id "
    "condition_source_value:string"
)
DRUG = (
    "drug_exposure_id person_id drug_concept_id drug_exposure_start_date:date "
    "drug_exposure_end_date:date drug_type_concept_id quantity:double days_supply sig:string "
    "route_concept_id visit_occurrence_id drug_source_value:string route_source_value:string"
)
PROCEDURE = (
    "procedure_occurrence_id person_id procedure_concept_id procedure_date:date "
    "procedure_type_concept_id quantity visit_occurrence_id procedure_source_value:string"
)
DEVICE = (
    "device_exposure_id person_id device_concept_id device_exposure_start_date:date "
    "device_exposure_end_date:date device_type_concept_id quantity visit_occurrence_id "
    "device_source_value:string"
)
OBSERVATION = (
    "observation_id person_id observation_concept_id observation_date:date "
    "observation_type_concept_id value_as_number:double value_as_concept_id unit_concept_id "
    "visit_occurrence_id observation_source_value:string"
)
MEASUREMENT = (
    "measurement_id person_id measurement_concept_id measurement_date:date "
    "measurement_type_concept_id value_as_number:double value_as_concept_id unit_concept_id "
    "visit_occurrence_id measurement_source_value:string value_source_value:string"
)
PAYER = (
    "payer_plan_period_id person_id payer_plan_period_start_date:date "
    "payer_plan_period_end_date:date payer_source_value:string plan_source_value:string"
)
COST = (
    "cost_id cost_event_id cost_domain_id:string cost_type_concept_id currency_concept_id "
    "total_charge:double total_cost:double total_paid:double paid_by_payer:double "
    "paid_by_patient:double payer_plan_period_id drg_source_value:string"
)
DRUG_ERA = (
    "person_id drug_concept_id drug_era_start_date:date drug_era_end_date:date "
    "drug_exposure_count gap_days"
)
CONDITION_ERA = (
    "person_id condition_concept_id condition_era_start_date:date condition_era_end_date:date "
    "condition_occurrence_count"
)
DOSE_ERA = (
    "person_id drug_concept_id dose_value:double dose_era_start_date:date dose_era_end_date:date"
)

# --- keys ---------------------------------------------------------------------------------

query("seq_master", SEQ, lambda s: s.seq, "seq")
query(
    "event_id", "event_id master_seq target_concept_id",
    lambda s: vocab.map_codes(
        s.k30, vocab.used(s.code_map, vocab.DRUG), F.col("div_cd")
    ).withColumn("event_id", codes.event_id(F.col("master_seq"), F.col("rn"))),
    "select f.master_seq * 10 + row_number() over (partition by f.key_seq, f.seq_no "
    "order by m.target_concept_id) as event_id, f.master_seq, m.target_concept_id "
    "from {f30} f join {m_drug} m on f.div_cd = m.source_code",
)
query(
    "decode_event_id", "drug_exposure_id master_seq",
    lambda s: s.drug.withColumn("master_seq", codes.decode_event_id(F.col("drug_exposure_id"))),
    "select drug_exposure_id, left(cast(drug_exposure_id as varchar), 10) as master_seq from {drug}",
)
query(
    "screening_id", "screening_id master_seq meas_type:string",
    lambda s: visits.screening_master(s.gj, s.seq).transform(
        lambda g: screening.gj_vertical(g, screening.NUMERIC_ITEMS)
    ).join(s.measurement_map.select("meas_type", "id_value"), "meas_type").withColumn(
        "screening_id", codes.screening_id(F.col("master_seq"), F.col("id_value"))
    ),
    "select cast(cast(s.master_seq as varchar) || m.id_value as bigint) as screening_id, "
    "s.master_seq, v.meas_type from {gj_vertical} v join {measurement_map} m "
    "on v.meas_type = m.meas_type join {seq_gj} s on s.person_id = v.person_id "
    f"and s.hchk_year = v.hchk_year where v.meas_type in {oracle._in(screening.NUMERIC_ITEMS)}",
)
query(
    "era_id", "condition_era_id " + CONDITION_ERA,
    lambda s: eras.condition_era(s.condition),
    oracle.numbered(
        "{condition_era}",
        "person_id, condition_concept_id, condition_era_start_date, condition_era_end_date",
        "condition_era_id",
    ),
)
query(
    "identity_id", "observation_period_id " + PERIOD,
    lambda s: keys.with_identity(
        s.period, ["person_id", "observation_period_start_date"], "observation_period_id"
    ),
    oracle.numbered("{period}", "person_id, observation_period_start_date", "observation_period_id"),
)
query(
    "payer_plan_id", "person_id stnd_y payer_plan_period_id",
    lambda s: s.jk.withColumn(
        "payer_plan_period_id", codes.payer_plan_id(F.col("person_id"), F.col("stnd_y"))
    ),
    "select person_id, stnd_y, person_id * 10000 + stnd_y as payer_plan_period_id from {jk}",
)

# --- vocabulary and codes -----------------------------------------------------------------

query("build_source_map", SOURCE_MAP, lambda s: s.fresh("source_map"), "smap")
for _domain in ("drug", "procedure", "device", "condition"):
    query(
        f"mapping_for_{_domain}", MAP,
        lambda s, d=_domain: vocab.mapping_for(s.source_map, s.concept, d), f"m_{_domain}",
    )
query("mapping_all", MAP, lambda s: vocab.mapping_all(s.source_map, s.concept), "m_all")
for _own, _other in (("procedure", "device"), ("device", "procedure")):
    query(
        f"ambiguous_codes_{_own}", MAP,
        lambda s, a=_own, b=_other: vocab.ambiguous_codes(s.source_map, a, b), f"dup_{_own}",
    )
    query(
        f"exclusive_mapping_{_own}", MAP,
        lambda s, a=_own, b=_other: vocab.exclusive_mapping(s.source_map, s.concept, a, b), f"x_{_own}",
    )
query(
    "code_map", "use:string source_code:string target_concept_id rn targets",
    lambda s: s.fresh("code_map"), "code_map",
)
query(
    "map_codes", "key_seq seq_no div_cd:string target_concept_id",
    lambda s: vocab.map_codes(s.t30, vocab.used(s.code_map, vocab.DRUG), F.col("div_cd")),
    "select key_seq, seq_no, div_cd, target_concept_id from {t30} "
    "join {m_drug} on div_cd = source_code",
)
query(
    "map_codes_prefix", "key_seq seq_no div_cd:string target_concept_id",
    lambda s: vocab.map_codes_prefix(
        s.t30, vocab.used(s.code_map, vocab.PROCEDURE_ONLY), F.col("div_cd")
    ),
    "select key_seq, seq_no, div_cd, target_concept_id from {t30} "
    "join {x_procedure} on left(div_cd, 5) = source_code",
)
query(
    "unmapped_codes", "key_seq seq_no sick_sym:string",
    lambda s: vocab.unmapped_codes(s.t40, vocab.mapping_all(s.source_map, s.concept), F.col("sick_sym")),
    "select key_seq, seq_no, sick_sym from {t40} "
    "where sick_sym not in (select source_code from {m_all})",
)
query(
    "ingredient_rollup", "drug_exposure_id drug_concept_id ingredient_concept_id",
    lambda s: vocab.ingredient_rollup(s.drug, s.ingredient_map), "ingredient",
)
query(
    "place_of_service", "ykiho_id stnd_y ykiho_gubun_cd:string concept_id",
    lambda s: s.yk.withColumn("concept_id", codes.place_of_service(F.col("ykiho_gubun_cd"))),
    f"select ykiho_id, stnd_y, ykiho_gubun_cd, case {oracle._PLACES} end as concept_id from {{yk}}",
)
query(
    "visit_concept", "form_cd:string in_pat_cors_type:string visit_concept_id claims",
    lambda s: s.t20.groupBy(
        "form_cd", "in_pat_cors_type",
        codes.visit_concept(F.col("form_cd"), F.col("in_pat_cors_type")).alias("visit_concept_id"),
    ).agg(F.count("*").alias("claims")),
    "select form_cd, in_pat_cors_type, visit_concept_id, count(*) as claims "
    "from {t20} join {visit_claims} on key_seq = visit_occurrence_id group by 1, 2, 3",
)
query(
    "route_concept", "clause_cd:string item_cd:string route_concept_id lines",
    lambda s: s.t30.groupBy(
        "clause_cd", "item_cd",
        codes.route_concept(
            codes.zero_pad(F.col("clause_cd")), codes.zero_pad(F.col("item_cd"))
        ).alias("route_concept_id"),
    ).agg(F.count("*").alias("lines")),
    "select clause_cd, item_cd, case "
    + " ".join(
        f"when lpad(clause_cd, 2, '0') = '{c}' and lpad(item_cd, 2, '0') = '{i}' then {v}"
        for c, i, v in codes.ROUTES
    )
    + " else 0 end as route_concept_id, count(*) as lines from {t30} group by 1, 2, 3",
)
query(
    "condition_type", "seq_no condition_type_concept_id lines",
    lambda s: s.t40.groupBy(
        "seq_no", codes.condition_type(F.col("seq_no")).alias("condition_type_concept_id")
    ).agg(F.count("*").alias("lines")),
    "select seq_no, case when seq_no = 1 then 44786627 when seq_no = 2 then 44786629 "
    "when seq_no = 3 then 45756845 when seq_no = 4 then 45756846 else 45756847 end "
    "as condition_type_concept_id, count(*) as lines from {t40} group by 1, 2",
)
query(
    "drug_type", "form_cd:string drug_type_concept_id claims",
    lambda s: s.t20.groupBy(
        "form_cd", codes.drug_type(F.col("form_cd")).alias("drug_type_concept_id")
    ).agg(F.count("*").alias("claims")),
    "select form_cd, case when form_cd in ('02','2','04','06','10','12') then 38000180 "
    "when form_cd is not null then 581452 end as drug_type_concept_id, count(*) as claims "
    "from {t20} group by 1, 2",
)
query(
    "gender_concept", "sex gender_concept_id person_years",
    lambda s: s.jk.groupBy(
        "sex", codes.gender_concept(F.col("sex")).alias("gender_concept_id")
    ).agg(F.count("*").alias("person_years")),
    "select sex, case sex when 1 then 8507 when 2 then 8532 end as gender_concept_id, "
    "count(*) as person_years from {jk} group by 1, 2",
)
query(
    "positive_or_one", "text:string value:double lines",
    lambda s: s.t30.groupBy(
        F.col("dd_mqty_exec_freq").alias("text"),
        codes.positive_or_one(F.col("dd_mqty_exec_freq")).alias("value"),
    ).agg(F.count("*").alias("lines")),
    f"select dd_mqty_exec_freq as text, {oracle.pos1('dd_mqty_exec_freq')} as value, "
    "count(*) as lines from {t30} group by 1, 2",
)

# --- persons and visits -------------------------------------------------------------------

query(
    "location",
    "location_id address_1:string address_2:string city:string state:string zip:string "
    "county:string location_source_value:string",
    lambda s: s.fresh("location"),
    "select cast(code as integer) as location_id, province as address_1, "
    "code || ' ' || district as address_2, province as city, null as state, null as zip, "
    "'KOREA' as county, code as location_source_value from {regions}",
)
query("care_site", CARE_SITE, lambda s: s.fresh("care_site"), "care_site")
query(
    "person_latest", "person_id sex sgg:string", lambda s: person.person_latest(s.jk), "latest"
)
query(
    "age_group_profile", "person_id age_group n min_year max_year",
    lambda s: person.age_group_profile(s.jk), "bands",
)
query(
    "birth_year", "person_id rule:string year_of_birth", lambda s: person.birth_year(s.jk), "births"
)
query("person", PERSON, lambda s: s.fresh("person"), "person")
query("death", DEATH, lambda s: s.fresh("death"), "death")
query("observation_period", PERIOD, lambda s: s.fresh("period"), "period")
query(
    "visit_occurrence_claims", VISIT, lambda s: visits.visit_occurrence_claims(s.t20),
    "visit_claims",
)
query(
    "visit_occurrence_screening", VISIT,
    lambda s: visits.visit_occurrence_screening(s.gj, s.seq), "visit_screening",
)
query("visit_occurrence", VISIT, lambda s: s.fresh("visit"), "visit")

# --- events -------------------------------------------------------------------------------

for _kind in ("mapped", "unmapped"):
    query(
        f"condition_occurrence_{_kind}", CONDITION,
        lambda s, k=_kind: events.condition_occurrence(s.k40, s.period, s.code_map, (k,)),
        f"condition_{_kind}",
    )
query("condition_occurrence", CONDITION, lambda s: s.fresh("condition"), "condition")
for _source, _prescription in (("30", False), ("60", True)):
    for _kind in ("mapped", "unmapped"):
        query(
            f"drug_exposure_{_source}t_{_kind}", DRUG,
            lambda s, f=f"k{_source}", p=_prescription, k=_kind: events.drug_lines(
                getattr(s, f), s.code_map, p, (k,)
            ),
            f"drug_{_source}_{_kind}",
        )
    for _kind in ("mapped", "ambiguous", "unmapped"):
        query(
            f"procedure_{_source}t_{_kind}", PROCEDURE,
            lambda s, f=f"k{_source}", p=_prescription, k=_kind: events.procedure_lines(
                getattr(s, f), s.code_map, p, (k,)
            ),
            f"procedure_{_source}_{_kind}",
        )
        query(
            f"device_{_source}t_{_kind}", DEVICE,
            lambda s, f=f"k{_source}", p=_prescription, k=_kind: events.device_lines(
                getattr(s, f), s.code_map, p, (k,)
            ),
            f"device_{_source}_{_kind}",
        )


def _raw_drug(s: Stages) -> DataFrame:
    return events.drug_lines(s.k30, s.code_map, False).unionByName(
        events.drug_lines(s.k60, s.code_map, True)
    )


def _raw_procedure(s: Stages) -> DataFrame:
    return events.procedure_lines(s.k30, s.code_map, False).unionByName(
        events.procedure_lines(s.k60, s.code_map, True)
    )


query(
    "drug_after_death_removed", DRUG,
    lambda s: events.drug_after_death_removed(_raw_drug(s), s.death), "drug_alive",
)
query(
    "drug_end_clipped_to_death", DRUG,
    lambda s: events.drug_end_clipped_to_death(_raw_drug(s), s.death), "drug_clipped",
)
query("drug_exposure", DRUG, lambda s: s.fresh("drug"), "drug")
query(
    "procedure_dedup", PROCEDURE,
    lambda s: events.procedure_dedup(_raw_procedure(s), s.drug), "procedure",
)
query("procedure_occurrence", PROCEDURE, lambda s: s.fresh("procedure"), "procedure")
query("device_exposure", DEVICE, lambda s: s.fresh("device"), "device")

# --- screenings ---------------------------------------------------------------------------

query(
    "gj_vertical",
    "hchk_year:string person_id ykiho_gubun_cd:string meas_type:string meas_value:string",
    lambda s: screening.gj_vertical(s.gj), "gj_vertical",
)
query(
    "jk_vertical", "hchk_year person_id jk_type:string jk_value:string",
    lambda s: screening.jk_vertical(s.jk), "jk_vertical",
)
query(
    "observation_categorical", OBSERVATION,
    lambda s: screening.observation_categorical(s.gj, s.seq, s.observation_map),
    "observation_categorical",
)
query(
    "observation_continuous", OBSERVATION,
    lambda s: screening.observation_continuous(s.gj, s.seq, s.observation_map),
    "observation_continuous",
)
query(
    "observation_drink_2009_quantity", OBSERVATION,
    lambda s: screening.observation_drink_2009_quantity(s.gj, s.seq, s.observation_map_2009),
    "observation_drink_2009_quantity",
)
query(
    "observation_drink_2009_habit", OBSERVATION,
    lambda s: screening.observation_drink_2009_habit(s.gj, s.seq, s.observation_map_2009),
    "observation_drink_2009_habit",
)
query(
    "observation_income", OBSERVATION,
    lambda s: screening.observation_income(s.jk, s.seq, s.observation_map), "observation_income",
)
query("observation", OBSERVATION, lambda s: s.fresh("observation"), "observation")
query(
    "measurement_continuous", MEASUREMENT,
    lambda s: screening.measurement_continuous(s.gj, s.seq, s.measurement_map),
    "measurement_continuous",
)
query(
    "measurement_categorical", MEASUREMENT,
    lambda s: screening.measurement_categorical(s.gj, s.seq, s.measurement_map),
    "measurement_categorical",
)
query("measurement", MEASUREMENT, lambda s: s.fresh("measurement"), "measurement")
query(
    "measurement_fill_value", MEASUREMENT,
    lambda s: screening.measurement_fill_value(s.measurement),
    "select * replace (coalesce(value_as_number, "
    + oracle.num("measurement_source_value")
    + ") as value_as_number) from {measurement}",
)

# --- money --------------------------------------------------------------------------------

query("payer_plan_period", PAYER, lambda s: s.fresh("payer"), "payer")
query("cost_visit", COST, lambda s: money.cost_visit(s.visit, s.t20), "cost_visit")
for _source, _tag in (("30", keys.TREATMENT), ("60", keys.PRESCRIPTION)):
    query(
        f"cost_drug_{_source}t", COST,
        lambda s, f=f"k{_source}", t=_tag: money.cost_drug(s.drug, getattr(s, f), t),
        f"cost_drug_{_source}t",
    )
    query(
        f"cost_drug_{_source}t_all_types", COST,
        lambda s, f=f"k{_source}", t=_tag: money.cost_drug(s.drug, getattr(s, f), t, True),
        f"cost_drug_{_source}t_all_types",
    )
    query(
        f"cost_procedure_{_source}t", COST,
        lambda s, f=f"k{_source}", t=_tag: money.cost_procedure(s.procedure, getattr(s, f), t),
        f"cost_procedure_{_source}t",
    )
    query(
        f"cost_device_{_source}t", COST,
        lambda s, f=f"k{_source}", t=_tag: money.cost_device(
            s.device, getattr(s, f), t, s.code_map
        ),
        f"cost_device_{_source}t",
    )
query(
    "cost", COST,
    lambda s: money.cost(
        s.visit, s.drug, s.procedure, s.device, s.t20, s.k30, s.k60, s.code_map
    ),
    "cost",
)

# --- eras ---------------------------------------------------------------------------------

query(
    "drug_era", "drug_era_id " + DRUG_ERA,
    lambda s: eras.drug_era(s.drug, s.ingredient_map),
    oracle.numbered(
        "{drug_era}",
        "person_id, drug_concept_id, drug_era_start_date, drug_era_end_date, drug_exposure_count",
        "drug_era_id",
    ),
)
query(
    "condition_era", CONDITION_ERA, lambda s: eras.condition_era_spans(s.condition), "condition_era"
)
query(
    "dose_era", "dose_era_id " + DOSE_ERA,
    lambda s: eras.dose_era(s.drug, s.ingredient_map),
    oracle.numbered(
        "{dose_era}",
        "person_id, drug_concept_id, dose_value, dose_era_start_date, dose_era_end_date",
        "dose_era_id",
    ),
)

# --- cleansing ----------------------------------------------------------------------------

for _name, _columns_of, _stage, _key, _start, _end in (
    ("visit", VISIT, "visit", "visit_occurrence_id", "visit_start_date", "visit_end_date"),
    ("condition", CONDITION, "condition", "condition_occurrence_id", "condition_start_date",
     "condition_end_date"),
    ("drug", DRUG, "drug", "drug_exposure_id", "drug_exposure_start_date",
     "drug_exposure_end_date"),
    ("procedure", PROCEDURE, "procedure", "procedure_occurrence_id", "procedure_date",
     "procedure_date"),
    ("device", DEVICE, "device", "device_exposure_id", "device_exposure_start_date",
     "device_exposure_end_date"),
    ("measurement", MEASUREMENT, "measurement", "measurement_id", "measurement_date",
     "measurement_date"),
    ("payer_plan", PAYER, "payer", "payer_plan_period_id", "payer_plan_period_start_date",
     "payer_plan_period_end_date"),
):
    query(
        f"cleanse_{_name}", _columns_of,
        lambda s, f=getattr(cleanse, f"cleanse_{_name}"), t=_stage: f(getattr(s, t), s.period),
        oracle.cleansed_by_id(_stage, _key, _start, _end)
        if _name == "payer_plan"
        else oracle.cleansed(_stage, _start, _end),
    )
query(
    "patch_person", PERSON, lambda s: cleanse.patch_person(s.person, s.overrides),
    "select * replace (case when person_id % 101 = 7 then 8507 else gender_concept_id end "
    "as gender_concept_id, case when person_id % 101 = 7 then '1' else gender_source_value end "
    "as gender_source_value) from {person}",
)
query(
    "device_quantity_zero_to_one", DEVICE,
    lambda s: cleanse.device_quantity_zero_to_one(s.device),
    "select * replace (case when quantity = 0 then 1 else quantity end as quantity) from {device}",
)

# --- data quality -------------------------------------------------------------------------

for _source in ("30", "60"):
    _keyed, _lines = f"k{_source}", f"t{_source}"
    query(
        f"dq_drug_mapped_{_source}t", "multimapped count",
        lambda s, k=_keyed: quality.dq_drug_mapped(quality.code_counts(getattr(s, k)), s.code_map),
        "select n as multimapped, count(*) as count from (select master_seq, count(*) as n "
        f"from {{f{_source}}} join {{m_drug}} on div_cd = source_code group by 1) x group by 1",
    )
    query(
        f"dq_drug_unmapped_{_source}t", "count",
        lambda s, k=_keyed: quality.dq_drug_unmapped(quality.code_counts(getattr(s, k)), s.code_map),
        f"select count(*) as count from {{f{_source}}} where div_type_cd in ('3', '4', '5') "
        "and div_cd not in (select source_code from {m_drug})",
    )
    query(
        f"dq_drug_raw_{_source}t", "div_type_cd:string multimapped count",
        lambda s, k=_lines: quality.dq_drug_raw(quality.code_counts(getattr(s, k)), s.code_map),
        "select div_type_cd, n as multimapped, count(*) as count from (select key_seq, seq_no, "
        f"div_type_cd, count(*) as n from {{t{_source}}} join {{m_drug}} on div_cd = source_code "
        "where div_type_cd not in ('3', '4', '5') group by 1, 2, 3) x group by 1, 2 "
        f"union all select div_type_cd, 1, count(*) from {{t{_source}}} "
        "where div_type_cd in ('3', '4', '5') group by 1",
    )
    for _table in ("procedure", "device"):
        for _kind in ("mapped", "ambiguous", "unmapped"):
            query(
                f"dq_{_table}_{_kind}_{_source}t", "count",
                lambda s, f=getattr(quality, f"dq_{_table}_{_kind}"), k=_keyed: f(
                    quality.code_counts(getattr(s, k)), s.code_map
                ),
                f"select count(*) as count from {{{_table}_{_source}_{_kind}}}",
            )
    _histogram = (
        "select div_type_cd, n as multimapped, count(*) as count from (select key_seq, seq_no, "
        "div_type_cd, count(*) as n from {{t" + _source + "}} join {{{0}}} on {1} = source_code "
        "where div_type_cd {2} group by 1, 2, 3) x group by 1, 2"
    )
    query(
        f"dq_procedure_raw_{_source}t", "div_type_cd:string multimapped count",
        lambda s, k=_lines: quality.dq_procedure_raw(quality.code_counts(getattr(s, k)), s.code_map),
        _histogram.format("x_procedure", "left(div_cd, 5)", "not in ('3', '4', '5', '7', '8')")
        + " union all "
        + _histogram.format("dup_procedure", "left(div_cd, 5)", "in ('1', '2')")
        + f" union all select div_type_cd, 1, count(*) from {{t{_source}}} "
        "where div_type_cd in ('1', '2') and left(div_cd, 5) not in (select source_code "
        "from {dup_procedure} union all select source_code from {x_procedure}) group by 1",
    )
    query(
        f"dq_device_raw_{_source}t", "div_type_cd:string multimapped count",
        lambda s, k=_lines: quality.dq_device_raw(quality.code_counts(getattr(s, k)), s.code_map),
        _histogram.format(
            "x_device", "div_cd", "not in ('1', '2', '3', '4', '5', '7', '8')"
        )
        + f" union all select div_type_cd, 1, count(*) from {{t{_source}}} "
        "where div_type_cd in ('7', '8') group by 1",
    )
    for _domain in ("drug", "procedure", "device"):
        query(
            f"dq_expected_rows_{_domain}_{_source}t",
            "expected_rows expected_lines extra_rows multi_mapped_lines",
            lambda s, k=_keyed, d=_domain: quality.dq_expected_rows(
                quality.code_counts(getattr(s, k)), s.source_map, d
            ),
            f"""
select coalesce(sum(lines * targets), 0) as expected_rows, coalesce(sum(lines), 0) as expected_lines,
    coalesce(sum(lines * (targets - 1)), 0) as extra_rows,
    coalesce(sum(lines) filter (targets > 1), 0) as multi_mapped_lines
from (select div_cd as source_code, count(*) as lines from {{t{_source}}}
      where key_seq in (select key_seq from {{t20}}) group by all) used
join (select source_code, count(*) as targets from {{smap}}
      where domain_id = '{_domain}' and invalid_reason is null group by all) known
    using (source_code)""",
        )
    for _field in (
        ("mdcn_exec_freq", "dd_mqty_freq", "dd_exec_freq")
        if _source == "60"
        else ("mdcn_exec_freq", "dd_mqty_freq", "dd_mqty_exec_freq")
    ):
        query(
            f"dq_non_numeric_{_field}_{_source}t", "value:string count",
            lambda s, k=_lines, c=_field: quality.dq_non_numeric(getattr(s, k), c),
            f"select {_field} as value, count(*) as count from {{t{_source}}} where {_field} "
            f"is not null and {oracle.num(_field)} is null group by 1",
        )
for _name, _source, _field, _above in (
    ("dq_dose_low_30t", "30", "dd_mqty_exec_freq", False),
    ("dq_dose_high_30t", "30", "dd_mqty_exec_freq", True),
    ("dq_dose_high_60t", "60", "dd_mqty_freq", True),
):
    _number = oracle.num(_field)
    query(
        _name,
        f"key_seq seq_no div_cd:string {_field}:string target_concept_id concept_name:string",
        lambda s, k=f"t{_source}", c=_field, a=_above: quality.dq_dose_outliers(
            getattr(s, k), s.source_map, s.concept, c, a
        ),
        f"""
select key_seq, seq_no, div_cd, {_field}, target_concept_id, concept_name
from (select * from {{t{_source}}} where {_number} {"> 1" if _above else "between 0 and 1"}) line
join (select source_code as div_cd, target_concept_id, target_concept_id as concept_id
      from {{smap}} where domain_id = 'drug') drug using (div_cd)
join {{concept}} using (concept_id) where {_number} <> 1""",
    )
query(
    "dq_condition_mapped", "count",
    lambda s: quality.dq_condition_mapped(quality.code_counts(s.k40, "sick_sym"), s.code_map),
    "select count(*) as count from {f40} join {m_condition} on sick_sym = source_code",
)
query(
    "dq_condition_unmapped", "count",
    lambda s: quality.dq_condition_unmapped(quality.code_counts(s.k40, "sick_sym"), s.code_map),
    "select count(*) as count from {f40} "
    "where sick_sym not in (select source_code from {m_all})",
)
query(
    "dq_condition_raw", "domain_id:string multimapped count",
    lambda s: quality.dq_condition_raw(quality.code_counts(s.t40, "sick_sym"), s.code_map),
    "select 'condition' as domain_id, n as multimapped, count(*) as count from (select key_seq, "
    "seq_no, count(*) as n from {t40} join {m_condition} on sick_sym = source_code group by 1, 2) x "
    "group by 2 union all select 'Unclassified', 1, count(*) from {t40} "
    "where sick_sym not in (select source_code from {m_all})",
)
_SCREENED = (
    "select count(*) as count from {{gj_vertical}} a join {{measurement_map}} b "
    "on a.meas_type = b.meas_type and a.meas_value {0} cast(b.answer as varchar) join {{gj}} d "
    "on a.person_id = d.person_id and a.hchk_year = d.hchk_year "
    "where a.meas_value <> '' and a.meas_type in {1}"
)
query(
    "dq_measurement_numeric", "count",
    lambda s: quality.dq_measurement_numeric(s.gj, s.measurement_map),
    _SCREENED.format(">=", oracle._in(screening.NUMERIC_ITEMS)),
)
query(
    "dq_measurement_coded", "count",
    lambda s: quality.dq_measurement_coded(s.gj, s.measurement_map),
    _SCREENED.format("=", oracle._in(screening.CODED_ITEMS)),
)
query(
    "dq_item_counts", "meas_type:string count",
    lambda s: quality.dq_item_counts(s.gj),
    "select meas_type, count(*) as count from {gj_vertical} where meas_value <> '' "
    f"and meas_type not in {oracle._in(quality.MEASUREMENT_ITEMS)} group by 1",
)
query(
    "dq_code_pairs", "clause_cd:string item_cd:string count",
    lambda s: quality.dq_code_pairs(s.t30),
    "select clause_cd, item_cd, count(clause_cd) as count from {t30} group by 1, 2",
)
query(
    "dq_multi_mapped_codes", "source_code:string targets",
    lambda s: quality.dq_multi_mapped_codes(s.source_map),
    "select source_code, count(*) as targets from {smap} where domain_id = 'drug' "
    "and invalid_reason is null group by 1 having count(*) > 1",
)
query(
    "dq_outside_period",
    "person_id drug_exposure_id drug_exposure_start_date:date drug_exposure_end_date:date "
    "observation_period_start_date:date observation_period_end_date:date death_date:date",
    lambda s: quality.dq_outside_period(s.drug, s.period, s.death),
    """
select person_id, drug_exposure_id, drug_exposure_start_date, drug_exposure_end_date,
    observation_period_start_date, observation_period_end_date, death_date
from {drug} join {period} using (person_id) join {death} using (person_id)
where not (drug_exposure_start_date >= observation_period_start_date
    and drug_exposure_end_date <= observation_period_end_date)""",
)

_DQ_PARTS = []
for _source in ("30", "60"):
    _DQ_PARTS += [
        ("drug_exposure", f"mapped_{_source}t", f"dq_drug_mapped_{_source}t"),
        ("drug_exposure", f"unmapped_{_source}t", f"dq_drug_unmapped_{_source}t"),
        ("drug_exposure", f"raw_{_source}t", f"dq_drug_raw_{_source}t"),
    ]
    for _table, _domain in (("procedure", "procedure_occurrence"), ("device", "device_exposure")):
        _DQ_PARTS += [
            (_domain, f"{_kind}_{_source}t", f"dq_{_table}_{_kind}_{_source}t")
            for _kind in ("mapped", "ambiguous", "unmapped", "raw")
        ]
_DQ_PARTS += [
    ("condition_occurrence", f"{_kind}_40t", f"dq_condition_{_kind}")
    for _kind in ("mapped", "unmapped", "raw")
]
_DQ_PARTS += [
    ("measurement", "mapped_gj_numeric", "dq_measurement_numeric"),
    ("measurement", "mapped_gj_code", "dq_measurement_coded"),
]


def _dq_sql(domain: str, item: str, name: str) -> str:
    names = [c for c, _ in QUERIES[name].columns]
    div_type = next((c for c in ("div_type_cd", "domain_id") if c in names), "null")
    multi = "multimapped" if "multimapped" in names else "null"
    return (
        f"select '{domain}' as domain, '{item}' as item, cast({div_type} as varchar) as div_type, "
        f"cast({multi} as bigint) as multimapped, count from ({QUERIES[name].sql}) q"
    )


query(
    "dq_report", "domain:string item:string div_type:string multimapped count",
    lambda s: dq.run_dq(
        s.t30, s.t40, s.t60, s.gj, s.k30, s.k40, s.k60, s.code_map, s.measurement_map
    ),
    " union all ".join(_dq_sql(*part) for part in _DQ_PARTS),
)


# --- integrity ----------------------------------------------------------------------------

# CDM table -> (stage, oracle relation, columns). All other tables are declared and empty.
_ERA_IDS = {
    "drug_eras": ("drug_era", DRUG_ERA), "condition_eras": ("condition_era", CONDITION_ERA),
    "dose_eras": ("dose_era", DOSE_ERA),
}
_CHECKED = {
    "person": ("person", "person", PERSON),
    "death": ("death", "death", DEATH),
    "observation_period": ("numbered_period", "numbered_period", "observation_period_id " + PERIOD),
    "visit_occurrence": ("visit", "visit", VISIT),
    "condition_occurrence": ("condition", "condition", CONDITION),
    "drug_exposure": ("drug", "drug", DRUG),
    "procedure_occurrence": ("procedure", "procedure", PROCEDURE),
    "device_exposure": ("device", "device", DEVICE),
    "measurement": ("measurement", "measurement", MEASUREMENT),
    "observation": ("observation", "observation", OBSERVATION),
    "payer_plan_period": ("payer", "payer", PAYER),
    "cost": ("cost_rows", "cost", COST),
    "care_site": ("care_site", "care_site", CARE_SITE),
    "location": (
        "location", "regions_cdm", " ".join(":".join(c) for c in QUERIES["location"].columns)
    ),
    "concept": ("concept", "concept", " ".join(quality.schemas.VOCABULARY["concept"].names)),
    "concept_ancestor": (
        "ancestor", "ancestor", "ancestor_concept_id descendant_concept_id"
    ),
    "concept_relationship": (
        "relationship", "relationship",
        " ".join(quality.schemas.VOCABULARY["concept_relationship"].names),
    ),
} | {table: (stage, stage, f"{table}_id " + columns) for stage, (table, columns) in _ERA_IDS.items()}
_DECLARED = quality.schemas.CDM | quality.schemas.VOCABULARY
oracle.ORACLE["regions_cdm"] = QUERIES["location"].sql
oracle.ORACLE["numbered_period"] = QUERIES["identity_id"].sql
oracle.ORACLE["drug_eras"] = QUERIES["drug_era"].sql
oracle.ORACLE["dose_eras"] = QUERIES["dose_era"].sql
oracle.ORACLE["condition_eras"] = QUERIES["era_id"].sql


def _tables(s: Stages) -> dict[str, DataFrame]:
    """Every CDM and vocabulary table in its declared layout, the unbuilt ones empty."""
    out = {}
    for table, schema in _DECLARED.items():
        if table in _CHECKED:
            out[table] = sinks.conform(getattr(s, _CHECKED[table][0]), table)
        else:
            out[table] = s.spark.createDataFrame([], schema)
    return out


def _given(table: str) -> list[str]:
    return [c for c, _ in _columns(_CHECKED[table][2])] if table in _CHECKED else []


def _relation(table: str) -> str:
    return f"{{{_CHECKED[table][1]}}}"


def _pk_sql() -> str:
    return " union all ".join(
        f"select '{table}' as table_name, count(*) as duplicate_keys, coalesce(sum(n), 0) as rows "
        f"from (select count(*) as n from {_relation(table)} group by {', '.join(key)} "
        "having count(*) > 1) x"
        if table in _CHECKED
        else f"select '{table}', 0, 0"
        for table, key in quality.schemas.PRIMARY_KEYS.items()
    )


def _fk_sql() -> str:
    parts = []
    for child, column, parent, key in quality.schemas.FOREIGN_KEYS:
        head = (
            f"select '{child}' as child_table, '{column}' as child_column, "
            f"'{parent}' as parent_table, "
        )
        if column not in _given(child):
            parts.append(head + "0 as orphan_keys, 0 as orphan_rows")
            continue
        known = (
            f"and {column} not in (select {key} from {_relation(parent)})"
            if key in _given(parent)
            else ""
        )
        parts.append(
            head + f"count(distinct {column}) as orphan_keys, count(*) as orphan_rows "
            f"from {_relation(child)} where {column} is not null {known}"
        )
    return " union all ".join(parts)


def _null_sql() -> str:
    parts = []
    for table, schema in _DECLARED.items():
        given = _given(table)
        for field in schema:
            tests = []
            if not field.nullable:
                tests.append(("null", f"{field.name} is null" if field.name in given else "true"))
            if "length" in field.metadata:
                limit = field.metadata["length"]
                tests.append(
                    (
                        "length",
                        f"length(cast({field.name} as varchar)) > {limit}"
                        if field.name in given
                        else "false",
                    )
                )
            parts += [
                f"select '{table}' as table_name, '{field.name}' as column_name, '{rule}' as rule, "
                + (
                    f"count(*) as rows from {_relation(table)} where {test}"
                    if table in _CHECKED
                    else "0 as rows"
                )
                for rule, test in tests
            ]
    return " union all ".join(parts)


query(
    "check_primary_keys", "table_name:string duplicate_keys rows",
    lambda s: quality.check_primary_keys(_tables(s)), _pk_sql(),
)
query(
    "check_foreign_keys",
    "child_table:string child_column:string parent_table:string orphan_keys orphan_rows",
    lambda s: quality.check_foreign_keys(_tables(s)), _fk_sql(),
)
query(
    "check_not_null", "table_name:string column_name:string rule:string rows",
    lambda s: quality.check_not_null(_tables(s)), _null_sql(),
)
query(
    "check_unique", "table_name:string duplicate_keys rows",
    lambda s: quality.check_unique(
        {"concept_synonym": loads.load_vocabulary(s)["concept_synonym"]}
    ),
    "select 'concept_synonym' as table_name, count(*) as duplicate_keys, "
    "coalesce(sum(n), 0) as rows from (select count(*) as n from (select concept_id, vocabulary_id "
    "from {concept} union all select concept_id_1, 'EDI' from {relationship}) x "
    "group by concept_id, vocabulary_id having count(*) > 1) y",
)

# --- sources, sinks and the pipeline ------------------------------------------------------

query(
    "cdm_source",
    "cdm_source_name:string cdm_source_abbreviation:string cdm_holder:string "
    "cdm_release_date:date cdm_version:string vocabulary_version:string",
    lambda s: sinks.cdm_source(s.spark, s.concept, TODAY),
    f"select '{sinks.SOURCE_NAME}' as cdm_source_name, '{sinks.SOURCE_ABBREVIATION}' as "
    f"cdm_source_abbreviation, '{sinks.SOURCE_HOLDER}' as cdm_holder, date '{TODAY}' as "
    f"cdm_release_date, '{sinks.CDM_VERSION}' as cdm_version, cast(max(valid_end_date) as varchar) "
    f"as vocabulary_version from {{concept}} where standard_concept = 'S' "
    f"and valid_end_date < date '{TODAY}'",
)
query(
    "conform_drug_exposure",
    " ".join(
        f"{f.name}:{f.dataType.simpleString().replace('int', 'bigint').replace('bigbigint', 'bigint')}"
        for f in quality.schemas.CDM["drug_exposure"]
        if f.dataType.typeName() != "timestamp"
    ),
    lambda s: sinks.conform(s.drug, "drug_exposure"),
    "select *, cast(null as date) as verbatim_end_date, null as stop_reason, null as refills, "
    "null as lot_number, null as provider_id, null as visit_detail_id, "
    "null as drug_source_concept_id, null as dose_unit_source_value from {drug}",
)
query(
    "profile_table", "table_name:string position column_name:string type:string rows",
    lambda s: loader.profile_table(s.jk, "jk"),
    "select 'jk' as table_name, position, column_name, type, (select count(*) from {jk}) as rows "
    "from (values "
    + ", ".join(
        f"({i}, '{c.split()[0]}', '{c.split()[1]}')"
        for i, c in enumerate(quality.schemas.RAW["jk"].split(", "))
    )
    + ") v(position, column_name, type)",
)

_COUNTED = {
    "person": "person", "death": "death", "observation_period": "period", "care_site": "care_site",
    "location": "regions", "visit_occurrence": "visit", "condition_occurrence": "condition",
    "observation": "observation", "drug_exposure": "drug", "procedure_occurrence": "procedure",
    "device_exposure": "device", "measurement": "measurement", "payer_plan_period": "payer",
    "cost": "cost", "drug_era": "drug_era", "condition_era": "condition_era",
    "dose_era": "dose_era",
}
_CLEANSED = {
    "visit_occurrence": "cleanse_visit", "condition_occurrence": "cleanse_condition",
    "drug_exposure": "cleanse_drug", "procedure_occurrence": "cleanse_procedure",
    "device_exposure": "cleanse_device", "measurement": "cleanse_measurement",
    "payer_plan_period": "cleanse_payer_plan",
}


def _pipeline(s: Stages, stages: tuple[str, ...]) -> DataFrame:
    raw_tables = {n: getattr(s, n) for n in ("jk", "t20", "gj", "yk")}
    # As in the files, with trailing blanks: the conversion normalises them itself.
    raw_tables |= {n: getattr(s, f"{n}_file") for n in ("t30", "t40", "t60")}
    vocabulary = {"concept": s.concept, "concept_relationship": s.relationship,
                  "concept_ancestor": s.ancestor}
    tables = etl.run_etl(
        s.spark, raw_tables, vocabulary, etl.scratch(s.spark), regions=s.regions, today=TODAY,
        stages=stages,
    )
    return sinks.stage_counts({t: tables[t] for t in _COUNTED})


query(
    "run_etl_counts", "table_name:string rows",
    lambda s: _pipeline(s, etl.CONVERSION),
    " union all ".join(
        f"select '{t}' as table_name, count(*) as rows from "
        + (f"({QUERIES[_CLEANSED[t]].sql}) q" if t in _CLEANSED else f"{{{r}}}")
        for t, r in _COUNTED.items()
    ),
)

# --- streams ------------------------------------------------------------------------------

query("era_stream", CONDITION_ERA, streams.condition_eras, "condition_era")
query("era_stream_drug", DRUG_ERA, streams.drug_eras, "drug_era")
query(
    "era_stream_late", "person_id concept_id rows late", streams.late_rows,
    "select person_id, condition_concept_id as concept_id, count(*) as rows, "
    "count(*) filter (year(condition_start_date) = (select min(year(condition_start_date)) from "
    "{condition})) as late from {condition} where condition_start_date is not null group by 1, 2",
)

# --- loads --------------------------------------------------------------------------------

_YEAR_OF = "cast(left(recu_fr_dt, 4) as integer)"
_CLAIM = "key_seq:string person_id:string form_cd:string dmd_drg_no:string load_year"
_CLAIMS_SQL = (
    "select key_seq, person_id, form_cd, case when load_year % 2 = 0 then dmd_drg_no end "
    f"as dmd_drg_no, load_year from (select *, {_YEAR_OF} as load_year from {{t20}}) claims"
)
query(
    "union_columns", "column_name:string filled", loads.union_columns,
    f"select column_name, count(*) as filled from (unpivot (select cast(key_seq as varchar) as key_seq, "
    f"cast(person_id as varchar) as person_id, form_cd, dmd_drg_no from ({_CLAIMS_SQL}) c) "
    "on key_seq, person_id, form_cd, dmd_drg_no into name column_name value v) u group by 1",
)
query("load_years", _CLAIM, loads.load_years, _CLAIMS_SQL)
query("write_raw", _CLAIM, loads.write_raw, _CLAIMS_SQL)
query(
    "load_single",
    "ykiho_id:string stnd_y:string ykiho_gubun_cd:string org_type:string ykiho_sido:string",
    loads.load_single, "yk",
)
query(
    "ingest_incremental", "key_seq person_id form_cd:string", loads.ingest_incremental,
    "select key_seq, person_id, form_cd from {t20}",
)
query(
    "ingest_incremental_batch", "key_seq:string form_cd:string load_year",
    loads.ingest_incremental_batch,
    f"select key_seq, form_cd, {_YEAR_OF} as load_year from {{t20}} where {_YEAR_OF} > "
    f"(select min({_YEAR_OF}) from {{t20}})",
)
_CONCEPT = (
    "concept_id concept_name:string domain_id:string vocabulary_id:string concept_class_id:string "
    "standard_concept:string concept_code:string valid_start_date:date valid_end_date:date "
    "invalid_reason:string"
)
query("load_vocabulary", _CONCEPT, lambda s: loads.load_vocabulary(s)["concept"], "concept")
query(
    "load_vocabulary_rejects", "concept_id concept_name:string rejected:string",
    lambda s: (lambda v: v["concept"].select(
        "concept_id", "concept_name", F.lit("no").alias("rejected")
    ).unionByName(
        v["bad_concept"].select(
            F.split_part("_corrupt_record", F.lit("\t"), F.lit(1)).cast("bigint").alias("concept_id"),
            F.split_part("_corrupt_record", F.lit("\t"), F.lit(2)).alias("concept_name"),
            F.lit("yes").alias("rejected"),
        )
    ))(loads.load_vocabulary(s, bad=True)),
    "select concept_id, concept_name, if(concept_id % 50 = 7, 'yes', 'no') as rejected from {concept}",
)
query(
    "seed_location", "code:string province:string district:string", loads.seed_location, "regions"
)

# The fixed maps, each with what it meets in the data.
query(
    "seed_death_map", "source_code:string target_concept_id deaths",
    lambda s: s.death_map.join(
        s.jk.groupBy(F.col("dth_code1").alias("source_code")).agg(F.count("*").alias("deaths")),
        "source_code", "left",
    ).na.fill(0, ["deaths"]),
    "select source_code, target_concept_id, count(person_id) as deaths from (select * from (values "
    + oracle._DEATH_ROWS
    + ") v(source_code, target_concept_id)) known left join {jk} on dth_code1 = source_code "
    "group by 1, 2",
)
for _map, _prefix in (
    ("measurement_map", "measurement"), ("observation_map", "observation"),
    ("observation_map_2009", "observation"),
):
    query(
        f"seed_{_map}",
        "meas_type:string id_value:string answer concept kind unit value_concept "
        "value_number:double answers",
        lambda s, m=_map, p=_prefix: getattr(s, m).join(
            screening.gj_vertical(s.gj).groupBy("meas_type").agg(F.count("*").alias("answers")),
            "meas_type", "left",
        ).na.fill(0, ["answers"]).select(
            "meas_type", "id_value", "answer", F.col(f"{p}_concept_id").alias("concept"),
            F.col(f"{p}_type_concept_id").alias("kind"), F.col(f"{p}_unit_concept_id").alias("unit"),
            F.col("value_as_concept_id").alias("value_concept"),
            F.col("value_as_number").alias("value_number"), "answers",
        ),
        f"select m.*, coalesce(n, 0) as answers from {{{_map}}} m left join (select meas_type, "
        "count(*) as n from {gj_vertical} group by 1) g using (meas_type)",
    )

# --- line keys ----------------------------------------------------------------------------


def _line_keys(s: Stages, most: int) -> DataFrame:
    """The bound lines have no duplicates, so one line in seven comes twice here."""
    twice = {
        name: (lines.unionByName(lines.where(F.col("seq_no") % 7 == 3)), code)
        for name, lines, code in (
            ("30t", s.t30, "div_cd"), ("40t", s.t40, "sick_sym"), ("60t", s.t60, "div_cd")
        )
    }
    uses = {"30t": vocab.DRUG, "40t": vocab.CONDITION, "60t": vocab.DRUG}
    return quality.dq_line_keys(twice, s.code_map, uses, most)


def _line_keys_sql(most: int) -> str:
    parts = []
    for name, lines, code, mapping in (
        ("30t", "t30", "div_cd", "m_drug"), ("40t", "t40", "sick_sym", "m_condition"),
        ("60t", "t60", "div_cd", "m_drug"),
    ):
        doubled = (
            f"(select * from {{{lines}}} union all select * from {{{lines}}} where seq_no % 7 = 3) d"
        )
        parts += [
            f"select '{name}' as source, 'rank_overflow' as item, coalesce(sum(n - {most}), 0) as rows "
            f"from {doubled} join (select source_code, count(*) as n from {{{mapping}}} group by 1 "
            f"having count(*) > {most}) m on {code} = source_code",
            f"select '{name}', 'duplicate_lines', 2 * count(*) from {{{lines}}} where seq_no % 7 = 3",
            f"select '{name}', 'unreadable_dates', count(*) from {doubled} where recu_fr_dt is not null "
            f"and {oracle.ymd('recu_fr_dt')} is null",
        ]
    return " union all ".join(parts)


for _most in (1, 9):
    query(
        f"dq_line_keys_{_most}", "source:string item:string rows",
        lambda s, n=_most: _line_keys(s, n), _line_keys_sql(_most),
    )

# --- layouts, reruns and the log of stages ------------------------------------------------


def _filled(s: Stages) -> DataFrame:
    """Values per column of all 27 CDM tables in their declared layout."""
    parts = []
    for name, df in _tables(s).items():
        if name in quality.schemas.CDM:
            counts = df.select(*[F.count(c).alias(c) for c in df.columns])
            filled = counts.unpivot([], df.columns, "column_name", "filled")
            parts.append(filled.withColumn("table_name", F.lit(name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _filled_sql() -> str:
    parts = []
    for table, schema in quality.schemas.CDM.items():
        given = _given(table)
        counts = ", ".join(
            f"count({c}) as {c}" if c in given else f"cast(0 as bigint) as {c}" for c in schema.names
        )
        source = f"from {_relation(table)}" if table in _CHECKED else ""
        parts.append(
            f"select '{table}' as table_name, column_name, filled from (unpivot (select {counts} "
            f"{source}) on columns(*) into name column_name value filled) u"
        )
    return " union all ".join(parts)


query("conform_tables", "table_name:string column_name:string filled", _filled, _filled_sql())


def _bucketed(s: Stages) -> DataFrame:
    path = fresh_path(s.spark, "bucketed")
    return sinks.write_bucketed(
        s.visit, f"visit_{path.rsplit('-', 1)[1]}", 8, path=path
    )


query("write_bucketed", VISIT, _bucketed, "visit")
query(
    "write_cdm", PERIOD,
    lambda s: sinks.write_cdm(
        s.period.withColumn("observation_period_id", F.col("person_id")), "observation_period",
        fresh_path(s.spark, "cdm"),
    ),
    "period",
)


def _raw_files(s: Stages) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    files = {n: getattr(s, n) for n in ("jk", "t20", "gj", "yk")}
    files |= {n: getattr(s, f"{n}_file") for n in ("t30", "t40", "t60")}
    return files, {
        "concept": s.concept, "concept_relationship": s.relationship, "concept_ancestor": s.ancestor
    }


def _rerun(s: Stages) -> DataFrame:
    """Stages up to death, then observation periods alone from the stored outputs."""
    files, vocabulary = _raw_files(s)
    out = etl.scratch(s.spark)
    etl.run_etl(s.spark, files, vocabulary, out, stages=("vocabulary", "person", "death"))
    return etl.run_etl(s.spark, {"jk": files["jk"]}, vocabulary, out, stages=("observation_period",))[
        "observation_period"
    ]


query("rerun_subset", "observation_period_id " + PERIOD, _rerun, QUERIES["identity_id"].sql)

#: Stage -> tables it writes and the oracle relation of each; a SELECT where there is none.
_LOGGED: dict[str, dict[str, str]] = {
    "ddl": {t: "select null as nothing where false" for t in quality.schemas.CDM},
    "vocabulary": {
        "source_to_concept_map": "smap", "code_map": "code_map",
        "ingredient_map": "select a.* from {ancestor} a where ancestor_concept_id in (select concept_id "
        "from {concept} where concept_class_id = 'Ingredient' and vocabulary_id like 'RxNorm%')",
    },
    "cdm_source": {"cdm_source": QUERIES["cdm_source"].sql},
    "master": {"seq_master": "seq"},
    "location": {"location": "regions_cdm"},
    "eras": {"drug_era": "drug_eras", "condition_era": "condition_eras"},
    "dose_era": {"dose_era": "dose_eras"},
    "indexing": {
        f"indexed_{t}": _CHECKED[t][1] for t in sinks.SORT_COLUMN
    },
    "constraints": {
        f"checks/{name}": f"select * from (values {', '.join(['(1)'] * n)}) v(one)"
        for name, n in (
            ("primary_keys", len(quality.schemas.PRIMARY_KEYS)),
            # Relations of which both tables are there: of the vocabulary the run gets three.
            ("foreign_keys", sum(
                {r[0], r[2]} <= {*quality.schemas.CDM, "concept", "concept_relationship", "concept_ancestor"}
                for r in quality.schemas.FOREIGN_KEYS
            )),
        )
    } | {"checks/not_null": None},
    "data_cleansing": {t: QUERIES[q].sql for t, q in _CLEANSED.items()} | {"person": "person"},
} | {
    t: {t: _CHECKED[t][1]}
    for t in (
        "care_site", "person", "death", "observation_period", "visit_occurrence",
        "condition_occurrence", "observation", "drug_exposure", "procedure_occurrence",
        "device_exposure", "measurement", "payer_plan_period", "cost",
    )
}


def _stage_log(s: Stages) -> DataFrame:
    """The log of a run of all stages."""
    files, vocabulary = _raw_files(s)
    tables = etl.run_etl(
        s.spark, files, vocabulary, etl.scratch(s.spark), s.regions, s.overrides, TODAY, buckets=4
    )
    return tables["stage_log"].where(F.col("seconds") > 0)


def _log_sql() -> str:
    """Measures of every logged table from its own rows."""
    parts = []
    for stage, tables in _LOGGED.items():
        for table, relation in tables.items():
            head = f"select '{stage}' as stage, '{table}' as table_name, "
            if relation is None:
                # One row for each rule of a layout.
                rules = sum(
                    (not f.nullable) + ("length" in f.metadata)
                    for layout in quality.schemas.CDM.values() for f in layout
                )
                parts.append(head + f"{rules} as rows, 0 as null_keys, null as first_date, null as last_date")
                continue
            name = table.removeprefix("indexed_")
            given = _given(name) if name in _CHECKED else []
            keys = [k for k in quality.schemas.PRIMARY_KEYS.get(name, ()) if k in given]
            missing = " or ".join(f"{k} is null" for k in keys) or "false"
            date = sinks._date_column(name)
            date = date if date in given or name == "source_to_concept_map" else None
            if stage == "ddl":
                keys, missing, date = [], "false", None
            source = f"{{{relation}}}" if " " not in relation else f"({relation}) q"
            parts.append(
                head + f"count(*) as rows, count(*) filter ({missing}) as null_keys, "
                f"min({date or 'cast(null as date)'}) as first_date, "
                f"max({date or 'cast(null as date)'}) as last_date from {source}"
            )
    return " union all ".join(parts)


query(
    "stage_log",
    "stage:string table_name:string rows null_keys first_date:date last_date:date", _stage_log,
    _log_sql(),
)

# --- conversion load by load --------------------------------------------------------------

_YEAR_2 = f"case when left({{0}}, 4) <= '{increments.LAST_YEAR}' then 1 else 2 end"
for _source, _lines, _digit in (("130", "t30", 3), ("140", "t40", 4), ("160", "t60", 6)):
    # The serials of the second load follow all of the first.
    oracle.ORACLE[f"load_{_lines}"] = (
        f"select key_seq, seq_no, person_id, greatest({_YEAR_2.format('recu_fr_dt')}, case when "
        f"{increments.LATE_LINE} then 2 else 1 end) as load from (select key_seq, seq_no from {{{_lines}}}) line "
        "join (select key_seq, person_id, recu_fr_dt from {t20}) claim using (key_seq)"
    )
    oracle.ORACLE[f"later_{_lines}"] = (
        f"select {_digit}000000000 + row_number() over (order by load, key_seq, seq_no) as master_seq, "
        f"'{_source}' as source_table, person_id, key_seq, seq_no, null as hchk_year, null as stnd_y, load "
        f"from {{load_{_lines}}}"
    )
for _source, _table, _year, _digit in (("GJT", "gj", "hchk_year", 8), ("JKT", "jk", "stnd_y", 9)):
    _pair = "{0}, null" if _table == "gj" else "null, {0}"
    oracle.ORACLE[f"later_{_table}"] = (
        f"select {_digit}00000000000 + row_number() over (order by load, {_year}, person_id) as master_seq, "
        f"'{_source}' as source_table, person_id, null as key_seq, null as seq_no, "
        + ("cast(hchk_year as varchar) as hchk_year, null as stnd_y"
           if _table == "gj" else "null as hchk_year, cast(stnd_y as varchar) as stnd_y")
        + f", load from (select distinct {_year}, person_id, "
        f"{_YEAR_2.format(f'cast({_year} as varchar)')} as load from {{{_table}}}) pairs"
    )
_LATER = " union all ".join(f"select * from {{later_{t}}}" for t in ("t30", "t40", "t60", "gj", "jk"))
query("increment_seq_master", SEQ, lambda s: increments.store(s).seq_master(), _LATER)
query(
    "increment_ledger", "source:string load first_serial serials", increments.ledger,
    "select source_table as source, load, min(master_seq) as first_serial, count(*) as serials from "
    f"({_LATER}) serial group by 1, 2",
)


def _without_id(columns: str, name: str) -> str:
    """Event ids depend on the load that issued the serial, all other columns do not."""
    return " ".join(c for c in columns.split() if not c.startswith(f"{name}_id"))


for _table, _columns_of, _relation_of in (
    ("person", PERSON, "person"), ("death", DEATH, "death"), ("observation_period", PERIOD, "period"),
    ("condition_occurrence", CONDITION, "condition"), ("drug_exposure", DRUG, "drug"),
    ("procedure_occurrence", PROCEDURE, "procedure"), ("device_exposure", DEVICE, "device"),
    ("payer_plan_period", PAYER, "payer"), ("drug_era", DRUG_ERA, "drug_era"),
    ("condition_era", CONDITION_ERA, "condition_era"), ("dose_era", DOSE_ERA, "dose_era"),
):
    _kept = _columns_of if _table in ("person", "death") else _without_id(_columns_of, _table)
    query(f"increment_{_table}", _kept, lambda s, t=_table: increments.store(s).table(t), _relation_of)
query(
    "increment_counts", "table_name:string rows ids", increments.counts,
    " union all ".join(
        f"select '{t}' as table_name, count(*) as rows, count(distinct "
        f"{'person_id' if t == 'death' else t + '_id'}) as ids from {{{_CHECKED[t][1]}}}"
        for t in increments.increment.BUILDERS
    ),
)
