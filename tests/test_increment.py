import os
import threading

import pytest
from base_helpers import rows
from pyspark.sql import functions as F

from claimloom.operators import keys
from claimloom.plans import increment

PERSONS, TOUCHED, BUCKETS = 30, 2, 16


class Cut(Exception):
    """A run that ends at once."""


def _files(root):
    """Names of data files below the CDM tables, by bucket."""
    return {
        os.path.join(os.path.relpath(folder, root), name)
        for folder, _, names in os.walk(f"{root}/cdm")
        for name in names
        if name.endswith(".parquet")
    }


def _bucket_of(file):
    return int(next(p for p in file.split(os.sep) if p.startswith("bucket=")).split("=")[1])


@pytest.fixture(scope="module")
def parts(spark, stages):
    """(vocabulary, first load, second load): the last years of two persons come later."""
    s = stages
    chosen = [r[0] for r in s.jk.select("person_id").distinct().orderBy("person_id").limit(PERSONS).collect()]
    late = chosen[:TOUCHED]
    own = {n: getattr(s, n).where(F.col("person_id").isin(chosen)).cache() for n in ("jk", "gj", "t20")}
    year = {"jk": F.col("stnd_y").cast("string"), "gj": F.col("hchk_year").cast("string"),
            "t20": F.substring("recu_fr_dt", 1, 4)}
    claims = own["t20"].select("key_seq", (F.col("person_id").isin(late) & (year["t20"] > "2008")).alias("l"))
    later = {n: F.col("person_id").isin(late) & (year[n] > "2008") for n in own}
    first = {n: df.where(~F.coalesce(later[n], F.lit(False))) for n, df in own.items()}
    second = {n: df.where(later[n]) for n, df in own.items()}
    for n in increment.LINES:
        lines = getattr(s, f"{n}_file").join(claims, "key_seq").cache()
        second[n] = lines.where("l").drop("l")
        first[n] = lines.where("not l").drop("l")
    vocabulary = {"concept": s.concept, "concept_relationship": s.relationship, "concept_ancestor": s.ancestor}
    return vocabulary, first, second


@pytest.fixture(scope="module")
def grown(spark, parts, tmp_path_factory):
    """The store after both loads, of which the second was cut short twice; and what lay there before."""
    vocabulary, first, second = parts
    root = str(tmp_path_factory.mktemp("store"))
    store = increment.Store(spark, root, BUCKETS)
    store.add(1, first, vocabulary)
    before = {"files": _files(root), "serials": set(rows(store.seq_master())), "ledger": rows(store.ledger.entries())}
    # Lines and headers of the first load come once more.
    again = {n: second[n].unionByName(first[n].limit(20)) if n in ("t20", *increment.LINES) else second[n] for n in second}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(increment.Ledger, "add", _cut_after(0, increment.Ledger.add))
        with pytest.raises(Cut):
            store.add(2, again)
    before["after_cut"] = _files(root)
    before["loads_after_cut"] = rows(store.loads(), "load")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(increment.Store, "_replace", _cut_after(3, increment.Store._replace))
        with pytest.raises(Cut):
            store.add(2, again)
    # Another process goes on.
    increment.Store(spark, root, BUCKETS).add(2, again)
    return store, before


def _cut_after(times, function):
    done = []

    def run(*args):
        if len(done) >= times:
            raise Cut
        done.append(1)
        return function(*args)

    return run


def test_both_loads_equal_one_run(spark, parts, grown, tmp_path):
    vocabulary, first, second = parts
    one = increment.Store(spark, str(tmp_path), BUCKETS)
    one.add(1, {n: first[n].unionByName(second[n]) for n in first}, vocabulary)
    for name in increment.BUILDERS:
        left, right = grown[0].table(name), one.table(name)
        assert left.columns == right.columns
        # Ids depend on the load, everything else does not.
        ids = [c for c in left.columns if c.endswith("_id") and c not in ("person_id", "location_id", "care_site_id")
               and "concept" not in c and c not in ("visit_occurrence_id", "payer_plan_period_id")]
        # So do the visits of screenings, which are named by their serial.
        keep = [
            F.when(F.col(c).cast("bigint") < 8 * 10**11, F.col(c)).alias(c)
            if c in ("visit_occurrence_id", "visit_source_value") else F.col(c)
            for c in left.columns if c not in ids
        ]
        assert rows(left, *keep) == rows(right, *keep), name
        assert left.count() or name == "cost"


def test_only_buckets_of_touched_persons_change(spark, grown, parts):
    store, before = grown
    root = store.root
    # Cut before everything was staged: nothing has changed.
    assert before["after_cut"] == before["files"] and before["loads_after_cut"] == [(1,)]
    touched = {
        r[0] for n in ("jk", "gj", "t20")
        for r in parts[2][n].select(F.pmod(F.hash("person_id"), F.lit(BUCKETS))).distinct().collect()
    }
    assert 0 < len(touched) < BUCKETS
    gone, new = before["files"] - _files(root), _files(root) - before["files"]
    assert gone and new and {_bucket_of(f) for f in gone | new} <= touched
    loads = {r.load: (r.persons, set(r.buckets)) for r in store.loads().collect()}
    assert loads[2] == (TOUCHED, touched) and loads[1][0] == PERSONS
    assert not os.path.exists(f"{root}/staging/2")


def test_serials_of_the_first_load_stay(grown):
    store, before = grown
    serials = rows(store.seq_master())
    assert before["serials"] < set(serials) and len(serials) == len(set(serials))
    entries = {(r.source, r.load): (r.first_serial, r.serials) for r in store.ledger.entries().collect()}
    assert {e for e in before["ledger"] if e[3] == 1} <= set(rows(store.ledger.entries()))
    for source in keys.LEADING:
        own = sorted(r[0] for r in serials if r[1] == source)
        base = keys.RANGES.base(source)
        # Without gaps over both loads, and each load where the ledger says.
        assert own == list(range(base + 1, base + 1 + len(own)))
        first, n = entries[source, 2]
        assert (first, first + n - 1) == (base + entries[source, 1][1] + 1, base + len(own))
    lines = [(r[1], r[3], r[4]) for r in serials if r[3] is not None]
    assert len(lines) == len(set(lines))


def test_generated_ids_are_unique(grown):
    for name, (key, _) in increment.NUMBERED.items():
        ids = grown[0].table(name).select(key)
        assert ids.count() == ids.distinct().count()


def test_finished_and_skipped_loads(grown, parts):
    store, _ = grown
    files = _files(store.root)
    store.add(2, parts[1])
    assert _files(store.root) == files and store.loads().count() == 2
    with pytest.raises(ValueError, match="load 3 comes before"):
        store.add(4, parts[2])


def test_ledger_runs_out(spark, tmp_path):
    lines = spark.range(5).select(F.col("id").alias("key_seq"), F.lit(1).alias("seq_no"))
    headers = spark.range(5).selectExpr(
        "id as key_seq", "id as person_id", "'02' as form_cd", "'1' as in_pat_cors_type", "1 as vscn",
        "'x' as sub_sick", "'20050101' as recu_fr_dt",
    )
    small = keys.SerialRanges(digits=1)
    with pytest.raises(ValueError, match="do not fit"):
        keys.keyed_lines(lines, headers, keys.TREATMENT, small, str(tmp_path / "k"), issued=5)
    keyed = keys.keyed_lines(lines, headers, keys.TREATMENT, small, str(tmp_path / "k"), issued=4)
    assert sorted(r.master_seq for r in keyed.collect()) == [35, 36, 37, 38, 39]


def test_first_load_needs_no_persons_and_writes_at_once(spark, parts, tmp_path):
    """All rows belong to touched persons; two tables are replaced at the same time."""
    together = threading.Barrier(2, timeout=120)
    replace, met = increment.Store._replace, []

    def meet(*args):
        if args[1] in ("person", "death"):
            met.append(together.wait())
        return replace(*args)

    def never(*args):
        raise Cut

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(increment, "_only", never)
        patch.setattr(increment.Store, "_replace", meet)
        store = increment.Store(spark, str(tmp_path), BUCKETS)
        store.add(1, parts[1], parts[0])
    assert sorted(met) == [0, 1] and store.table("person").count() == PERSONS
