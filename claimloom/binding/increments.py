"""The bound raw tables in two loads, and what a conversion load by load makes of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import keys
from ..plans import increment
from ..work import fresh_path
from .stages import Stages

#: Years of the first load. Claims without a year, and some lines of its claims, come later.
LAST_YEAR = "2009"
LATE_LINE = "key_seq % 7 = 3 and seq_no % 3 = 2"

_stores: dict[tuple[str, str], increment.Store] = {}


def _load_of(year: Column) -> Column:
    return F.when(year <= LAST_YEAR, 1).otherwise(2)


def loads(s: Stages) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The raw tables of the first and of the second load."""
    claims = s.t20.withColumn("load", _load_of(F.substring("recu_fr_dt", 1, 4)))
    own = claims.select("key_seq", F.col("load").alias("claim_load"))
    parts = {
        "jk": s.jk.withColumn("load", _load_of(F.col("stnd_y").cast("string"))),
        "gj": s.gj.withColumn("load", _load_of(F.col("hchk_year").cast("string"))),
        "t20": claims,
    }
    for name in increment.LINES:
        late = F.when(F.expr(LATE_LINE), 2).otherwise(1)
        lines = getattr(s, f"{name}_file").join(keys.unsent(own), "key_seq", "left")
        parts[name] = lines.withColumn("load", F.greatest("claim_load", late)).drop("claim_load")
    return tuple({n: df.where(F.col("load") == k).drop("load") for n, df in parts.items()} for k in (1, 2))


def store(s: Stages) -> increment.Store:
    """Both loads converted, once a session and folder."""
    key = (s.spark.sparkContext.applicationId, s.folder)
    if key not in _stores:
        made = increment.Store(s.spark, fresh_path(s.spark, "increment"), buckets=8)
        vocabulary = {
            "concept": s.concept, "concept_relationship": s.relationship, "concept_ancestor": s.ancestor
        }
        for number, raw in enumerate(loads(s), 1):
            made.add(number, raw, vocabulary if number == 1 else None)
        _stores[key] = made
    return _stores[key]


def ledger(s: Stages) -> DataFrame:
    """Serials of the raw sources, an entry a load."""
    return store(s).ledger.entries().where(F.col("source").isin(*keys.LEADING))


def counts(s: Stages) -> DataFrame:
    """Rows and distinct ids of each table after both loads."""
    out = None
    for name in increment.BUILDERS:
        rows = store(s).table(name)
        key = F.col("person_id" if name == "death" else f"{name}_id")
        part = rows.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("ids")).select(
            F.lit(name).alias("table_name"), "rows", "ids"
        )
        out = part if out is None else out.unionAll(part)
    return out
