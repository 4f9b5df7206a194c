"""Conversion load by load: a new year of raw rows changes the persons it touches, and no others.

The store below ``root`` holds the raw rows, keyed claim lines and CDM tables of all loads so far,
every table laid out by a bucket of its person. A load

1. appends its raw rows and gives new claim lines and person-years serials behind those issued
   before: a ledger holds, for each load, the first serial and the number of serials of a source.
   Serials of earlier loads never change, and those of one load have no gaps;
2. finds the touched persons: those with a new row, or a new line of an old claim;
3. rebuilds the rows of these persons from all their raw rows, which are read from their buckets only;
4. stages the new content of the touched buckets, rows of other persons copied as they are, and then
   replaces these buckets. Files of all other buckets stay.

A load that was cut short is repeated by calling it again. Until everything is staged nothing of the
old tables has changed; from then on a repeated call only replaces buckets by what is staged.

Generated ids (periods and eras) come from the ledger too: a rebuilt person gets new ones. All other
ids derive from serials and so survive.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import eras, events, keys, money, person, screening, visits, vocab
from ..sources import loader, seeds, sinks
from ..work import exists, fresh_path, remove

#: Raw tables by person and the year column of those that get a serial a year.
BY_PERSON = ("jk", "gj", "t20")
YEARLY = {"gj": ("hchk_year", keys.SCREENING), "jk": ("stnd_y", keys.ELIGIBILITY)}
LINES = {"t30": keys.TREATMENT, "t40": keys.DIAGNOSIS, "t60": keys.PRESCRIPTION}

#: CDM tables by person in the order they are built, from raw tables, maps and tables before them.
BUILDERS: dict[str, Callable[[_Inputs], DataFrame]] = {
    "person": lambda r: person.person(r["jk"]),
    "death": lambda r: person.death(r["jk"], r["code_map"], seeds.seed_death_map(r.spark)),
    "observation_period": lambda r: person.observation_period(r["jk"], r["person"], r["death"]),
    "visit_occurrence": lambda r: visits.visit_occurrence(r["t20"], r["gj"], r["seq"]),
    "condition_occurrence": lambda r: events.condition_occurrence(
        r["t40"], r["observation_period"], r["code_map"]
    ),
    "observation": lambda r: screening.observation(
        r["gj"], r["jk"], r["seq"],
        seeds.seed_observation_map(r.spark), seeds.seed_observation_map_2009(r.spark),
    ),
    "drug_exposure": lambda r: events.drug_exposure(r["t30"], r["t60"], r["death"], r["code_map"]),
    "procedure_occurrence": lambda r: events.procedure_occurrence(
        r["t30"], r["t60"], r["drug_exposure"], r["code_map"]
    ),
    "device_exposure": lambda r: events.device_exposure(r["t30"], r["t60"], r["code_map"]),
    "measurement": lambda r: screening.measurement(
        r["gj"], r["seq"], seeds.seed_measurement_map(r.spark)
    ),
    "payer_plan_period": lambda r: money.payer_plan_period(r["jk"], r["death"]),
    "cost": lambda r: money.cost(
        r["visit_occurrence"], r["drug_exposure"], r["procedure_occurrence"], r["device_exposure"],
        r["t20"], r["t30"], r["t60"], r["code_map"], r.ranges,
    ),
    "drug_era": lambda r: eras.drug_era_spans(r["drug_exposure"], r["ingredient_map"]),
    "condition_era": lambda r: eras.condition_era_spans(r["condition_occurrence"]),
    "dose_era": lambda r: eras.dose_era_spans(r["drug_exposure"], r["ingredient_map"]),
}
#: Tables with generated ids: the id and the order in which the rows of a load get theirs.
NUMBERED = {
    "observation_period": ("observation_period_id", ["person_id", "observation_period_start_date"]),
    "drug_era": ("drug_era_id", eras.DRUG_ERA_ORDER),
    "condition_era": ("condition_era_id", eras.CONDITION_ERA_ORDER),
    "dose_era": ("dose_era_id", eras.DOSE_ERA_ORDER),
}


#: Tables that are written at a time: the tasks of one fill the cores that the last tasks of another leave.
AT_ONCE = 3


class _Inputs(dict):
    """What the builders read: raw rows, lines, maps and rebuilt rows of the touched persons.

    A table that is still being built is waited for.
    """

    def __init__(self, spark: SparkSession, ranges: keys.SerialRanges):
        super().__init__()
        self.spark, self.ranges = spark, ranges

    def __getitem__(self, name: str) -> DataFrame:
        found = super().__getitem__(name)
        return found.result() if isinstance(found, Future) else found


class Ledger:
    """Serials issued to each source, an entry a load; entries are added and never changed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        """(source, first_serial, serials, load)."""
        schema = "source string, first_serial bigint, serials bigint, load int"
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def issued(self, load: int) -> dict[str, int]:
        """Serials of each source before a load; a source and load have one entry."""
        before = self.entries().where(F.col("load") < load).groupBy("source")
        return {r.source: r.n for r in before.agg(F.sum("serials").alias("n")).collect()}

    def add(self, load: int, issued: dict[str, tuple[int, int]]) -> None:
        """``issued``: (first serial, serials) of each source. A repeated load has the same entry."""
        rows = [(source, first, n) for source, (first, n) in sorted(issued.items())]
        entry = self.spark.createDataFrame(rows, "source string, first_serial bigint, serials bigint")
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/load={load}")


def _same(a: str, b: str, on: str) -> Column:
    return F.col(f"{a}.{on}").eqNullSafe(F.col(f"{b}.{on}"))


def _only(rows: DataFrame, persons: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of these persons (or, as an anti join, of all others); a null person is one of them."""
    return rows.alias("r").join(keys.unsent(persons.alias("p")), _same("r", "p", "person_id"), how)


class Store:
    """Raw rows and CDM tables below ``root``, converted load by load.

    ``buckets`` is fixed with the first load. One bucket is what a touched person rewrites, so for
    large cohorts it should be chosen for buckets of some hundred megabytes.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = 64,
        ranges: keys.SerialRanges = keys.RANGES,
    ):
        self.spark, self.root, self.buckets, self.ranges = spark, root.rstrip("/"), buckets, ranges
        self.ledger = Ledger(spark, f"{self.root}/ledger")

    def _bucket(self) -> Column:
        return F.pmod(F.hash("person_id"), F.lit(self.buckets)).alias("bucket")

    def loads(self) -> DataFrame:
        """(persons, buckets, load): how many persons each finished load touched, and which buckets."""
        schema = "persons bigint, buckets array<int>, load int"
        if not exists(self.spark, f"{self.root}/loads"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/loads")

    def table(self, name: str) -> DataFrame:
        """A CDM table as of the last load."""
        return self.spark.read.parquet(f"{self.root}/cdm/{name}").drop("bucket")

    def seq_master(self) -> DataFrame:
        """The serial table of all loads."""
        return self._serials({n: self._stored(f"keyed/{n}") for n in LINES},
                             {n: self._stored(f"yearly/{n}") for n in YEARLY})

    @staticmethod
    def _serials(lines: dict[str, DataFrame], years: dict[str, DataFrame]) -> DataFrame:
        return keys.seq_master(lines["t30"], lines["t40"], lines["t60"], years["gj"], years["jk"])

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/{name}")

    def _before(self, name: str, load: int) -> DataFrame | None:
        """A stored table as earlier loads left it."""
        if not exists(self.spark, f"{self.root}/{name}"):
            return None
        rows = self._stored(name)
        return rows.where(F.col("load") < load) if "load" in rows.columns else rows

    def _append(self, name: str, load: int, rows: DataFrame) -> DataFrame:
        """Rows of one load, by bucket; written again if the load is repeated."""
        path = f"{self.root}/{name}/load={load}"
        laid = rows.withColumn("bucket", self._bucket())
        laid.write.mode("overwrite").partitionBy("bucket").parquet(path)
        return self.spark.read.schema(laid.schema).parquet(path).drop("bucket")

    # --- the steps of a load ----------------------------------------------------------------

    def add(
        self, load: int, raw: dict[str, DataFrame], vocabulary: dict[str, DataFrame] | None = None
    ) -> None:
        """Convert load ``load`` (1, 2, ...): ``raw`` holds its rows of jk, gj, t20, t30, t40, t60.

        The first load needs the vocabulary (concept, concept_relationship, concept_ancestor); later
        ones use the maps made from it. A finished load is not repeated. A claim header that came
        before is not taken again, nor is a line or person-year that has a serial.
        """
        last = self.loads().agg(F.max("load")).first()[0] or 0
        if load <= last:
            return
        if load != last + 1:
            raise ValueError(f"load {last + 1} comes before load {load}")
        staging = f"{self.root}/staging/{load}"
        if not exists(self.spark, f"{staging}/ready"):
            if load == 1 and vocabulary is not None:
                self._maps(vocabulary)
            new = {name: loader.normalise_strings(df) for name, df in raw.items()}
            issued = self.ledger.issued(load)
            serials: dict[str, tuple[int, int]] = {}
            touched = self._take(load, new, issued, serials, staging)
            self._stage(load, touched, issued, serials, staging)
            self.ledger.add(load, serials)
            found = touched.agg(
                F.count("*").alias("persons"), F.array_sort(F.collect_set(self._bucket())).alias("buckets")
            )
            found.coalesce(1).write.mode("overwrite").parquet(f"{staging}/ready")
        ready = self.spark.read.parquet(f"{staging}/ready")
        buckets = ready.first().buckets
        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(lambda name: self._replace(name, f"{staging}/{name}", buckets), BUILDERS))
        ready.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/loads/load={load}")
        remove(self.spark, staging)

    def _maps(self, vocabulary: dict[str, DataFrame]) -> None:
        concept = vocabulary["concept"]
        source_map = vocab.build_source_map(concept, vocabulary["concept_relationship"])
        vocab.code_map(source_map, concept).write.mode("overwrite").partitionBy("use").parquet(
            f"{self.root}/maps/code_map"
        )
        vocab.ingredient_map(vocabulary["concept_ancestor"], concept).write.mode("overwrite").parquet(
            f"{self.root}/maps/ingredient_map"
        )

    def _take(
        self,
        load: int,
        new: dict[str, DataFrame],
        issued: dict[str, int],
        serials: dict[str, tuple[int, int]],
        staging: str,
    ) -> DataFrame:
        """Store the rows of a load, with serials; returns the touched persons, as a stored table."""
        known = self._before("raw/t20", load)
        claims = new["t20"]
        if known is not None:
            claims = claims.join(keys.unsent(known.select("key_seq")), "key_seq", "left_anti")
        rows = {"jk": new["jk"], "gj": new["gj"], "t20": claims}
        with ThreadPoolExecutor(AT_ONCE) as pool:
            written = pool.map(lambda name: self._append(f"raw/{name}", load, rows[name]), rows)
            fresh = dict(zip(rows, written))
        persons = [df.select("person_id") for df in fresh.values()]

        def years(name: str, year: str, source: str) -> None:
            pairs, before = fresh[name].select(year, "person_id"), self._before(f"yearly/{name}", load)
            if before is not None:
                pairs = pairs.join(keys.unsent(before.select(year, "person_id")), [year, "person_id"], "left_anti")
            numbered = keys.yearly_master(pairs, year, source, self.ranges, issued.get(source, 0))
            self._note(serials, source, self._append(f"yearly/{name}", load, numbered), issued)

        def lines(name: str, source: str) -> DataFrame:
            keyed = self._keyed(load, name, new[name], fresh["t20"], known, source, issued)
            self._note(serials, source, keyed, issued)
            return keyed.select("person_id")

        with ThreadPoolExecutor(AT_ONCE) as pool:
            keyed = [pool.submit(lines, name, source) for name, source in LINES.items()]
            numbered = [pool.submit(years, name, *of) for name, of in YEARLY.items()]
            persons += [one.result() for one in keyed]
            for one in numbered:
                one.result()
        path = f"{staging}/persons"
        reduce(DataFrame.unionAll, persons).distinct().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def _note(
        self, serials: dict[str, tuple[int, int]], source: str, rows: DataFrame, issued: dict[str, int]
    ) -> None:
        """Counts of stored rows come from their footers."""
        base = self.ranges.base(source) if source in keys.LEADING else 0
        serials[source] = (base + issued.get(source, 0) + 1, rows.count())

    def _keyed(
        self,
        load: int,
        name: str,
        lines: DataFrame,
        claims: DataFrame,
        known: DataFrame | None,
        source: str,
        issued: dict[str, int],
    ) -> DataFrame:
        """Lines of new claims, and new lines of claims that came before, with header and serial."""
        headers = claims
        if known is not None:
            # Only lines without a new claim are looked up among the old ones.
            rest = lines.join(keys.unsent(claims.select("key_seq")), "key_seq", "left_anti")
            old = known.drop("load", "bucket").join(keys.unsent(rest.select("key_seq")), "key_seq", "left_semi")
            headers = claims.unionByName(old.select(claims.columns))
            done = self._before(f"keyed/{name}", load)
            if done is not None:
                have = done.select("key_seq", "seq_no").join(
                    keys.unsent(rest.select("key_seq").distinct()), "key_seq", "left_semi"
                )
                lines = lines.join(keys.unsent(have), ["key_seq", "seq_no"], "left_anti")
        path = f"{self.root}/keyed/{name}/load={load}"
        keys.keyed_lines(
            lines, headers, source, self.ranges, path, issued.get(source, 0), {"bucket": self._bucket()}
        )
        return self.spark.read.parquet(path).drop("bucket")

    def _stage(
        self,
        load: int,
        touched: DataFrame,
        issued: dict[str, int],
        serials: dict[str, tuple[int, int]],
        staging: str,
    ) -> None:
        """The touched buckets of every table as they are to be: rebuilt persons, and all others."""
        buckets = [r[0] for r in touched.select(self._bucket()).distinct().collect()]

        def rows(name: str) -> DataFrame:
            """Stored rows of the touched persons; other buckets are not read."""
            stored = self._stored(name).where(F.col("load") <= load)
            if load == 1:
                # Every person with a row has it from this load.
                return stored.drop("load", "bucket")
            return _only(stored.where(F.col("bucket").isin(buckets)), touched).drop("load", "bucket")

        inputs = _Inputs(self.spark, self.ranges)
        inputs |= {name: rows(f"raw/{name}") for name in BY_PERSON}
        inputs |= {name: rows(f"keyed/{name}") for name in LINES}
        inputs["seq"] = self._serials(inputs, {n: rows(f"yearly/{n}") for n in YEARLY})
        for name in ("code_map", "ingredient_map"):
            inputs[name] = self.spark.read.parquet(f"{self.root}/maps/{name}")

        def built(name: str) -> DataFrame:
            rows = BUILDERS[name](inputs)
            if name in NUMBERED:
                key, order = NUMBERED[name]
                numbered = fresh_path(self.spark, key)
                count = keys.write_numbered(rows, order, numbered)
                rows = keys.read_numbered(self.spark, numbered, key, issued.get(name, 0))
                serials[name] = (issued.get(name, 0) + 1, count)
            # Costs have no person in the layout; the bucket needs one.
            new = sinks.conform(rows, name, keep=("person_id",))
            new = new.withColumns({"touched": F.lit(True), "bucket": self._bucket()})
            if exists(self.spark, f"{self.root}/cdm/{name}"):
                current = self.spark.read.parquet(f"{self.root}/cdm/{name}")
                current = current.where(F.col("bucket").isin(buckets))
                others = _only(current, touched, "left_anti").withColumn("touched", F.lit(False))
                new = new.unionByName(others)
            path = f"{staging}/{name}"
            new.write.mode("overwrite").partitionBy("touched").parquet(path)
            if name in NUMBERED:
                remove(self.spark, numbered)
            staged = self.spark.read.schema(new.schema).parquet(path)
            return staged.where("touched").drop("touched", "bucket")

        # A table waits for those before it, which were begun earlier: the first one under way waits for none.
        with ThreadPoolExecutor(AT_ONCE) as pool:
            for name in BUILDERS:
                inputs[name] = pool.submit(built, name)
            for name in BUILDERS:
                inputs[name]

    def _replace(self, name: str, staged: str, buckets: list[int]) -> None:
        """Put the staged buckets in place of the old ones, sorted by person and concept."""
        path = f"{self.root}/cdm/{name}"
        rows = self.spark.read.parquet(staged).drop("touched")
        order = [c for c in ("bucket", "person_id", sinks.SORT_COLUMN.get(name)) if c in rows.columns]
        (
            # Small buckets share a task and large ones are split.
            rows.hint("rebalance", "bucket")
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(path)
        )
        filled = {r.bucket for r in rows.select("bucket").distinct().collect()}
        for bucket in set(buckets) - filled:
            # Its last rows belonged to touched persons.
            remove(self.spark, f"{path}/bucket={bucket}")
