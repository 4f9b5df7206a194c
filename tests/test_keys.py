import random

import pytest
from base_helpers import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from claimloom.operators import keys, vocab


def test_ranked_equals_row_number(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        values = list(range(5000))
        random.Random(1).shuffle(values)
        df = spark.createDataFrame([(v, v % 7) for v in values], "v int, k int").repartition(5)
        out = keys.ranked(df, ["v"], "r")
        assert rows(out, "v", "r") == sorted(((v, v + 1) for v in values), key=repr)
        assert out.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranked_within_a_dominating_group(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data = [(0 if i % 3 else i, i) for i in range(3000)]
        df = spark.createDataFrame(data, "g int, v int").repartition(6)
        out = keys.ranked_within(df, "g", ["v"], "n")
        expected, seen = [], {}
        for g, v in sorted(data):
            seen[g] = seen.get(g, 0) + 1
            expected.append((g, v, seen[g]))
        assert rows(out, "g", "v", "n") == sorted(expected, key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_serial_ranges():
    ranges = keys.SerialRanges()
    assert ranges.base(keys.TREATMENT) == 3_000_000_000
    assert ranges.base(keys.SCREENING) == 800_000_000_000
    with pytest.raises(ValueError):
        ranges.check(keys.DIAGNOSIS, 10**9)
    wide = keys.SerialRanges(12)
    wide.check(keys.DIAGNOSIS, 10**11)
    # Event and screening ids of the widest ranges still fit a bigint.
    assert (wide.base(keys.PRESCRIPTION) + wide.size(keys.PRESCRIPTION)) * 10 < 2**63
    assert (wide.base(keys.ELIGIBILITY) + wide.size(keys.ELIGIBILITY)) * 100 < 2**63


def test_keyed_lines_and_master(spark):
    t20 = spark.createDataFrame(
        [(1, 10, "20080101", "02", "11", 1, "K1"), (2, 20, "20080102", "03", None, 0, "K2")],
        "key_seq bigint, person_id bigint, recu_fr_dt string, form_cd string, "
        "in_pat_cors_type string, vscn int, sub_sick string",
    )
    t30 = spark.createDataFrame(
        [(2, 1, "a"), (1, 2, "b"), (1, 1, "c"), (3, 1, "no header")],
        "key_seq bigint, seq_no int, div_cd string",
    )
    keyed = keys.keyed_lines(t30, t20, keys.TREATMENT)
    assert rows(keyed, "master_seq", "person_id", "div_cd") == [
        (3000000001, 10, "c"), (3000000002, 10, "b"), (3000000003, 20, "a"),
    ]
    gj = spark.createDataFrame([("2009", 10), ("2009", 10), ("2008", 20)], "hchk_year string, person_id bigint")
    jk = spark.createDataFrame([(2009, 10)], "stnd_y int, person_id bigint")
    seq = keys.seq_master(
        keyed, keyed.limit(0), keyed.limit(0),
        keys.yearly_master(gj, "hchk_year", keys.SCREENING),
        keys.yearly_master(jk, "stnd_y", keys.ELIGIBILITY),
    )
    assert rows(seq.where("source_table = 'GJT'"), "master_seq", "person_id", "hchk_year") == [
        (800000000001, 20, "2008"), (800000000002, 10, "2009"),
    ]
    rebuilt = keys.join_master(t30, t20, seq, keys.TREATMENT)
    assert rows(rebuilt.select(keyed.columns)) == rows(keyed)


def test_numbered_tables_survive_the_run(spark, tmp_path):
    path = str(tmp_path / "numbered")
    assert keys.write_numbered(spark.range(100).repartition(3), ["id"], path) == 100
    again = keys.read_numbered(spark, path, "n", 1000)
    assert rows(again.where("n - 1001 <> id")) == [] and again.count() == 100
    empty = keys.write_numbered(spark.range(0), ["id"], str(tmp_path / "empty"))
    assert empty == 0 and keys.read_numbered(spark, str(tmp_path / "empty"), "n").count() == 0


def test_unmapped_codes_drop_null(spark):
    lines = spark.createDataFrame([("a",), ("b",), (None,)], "code string")
    mapping = spark.createDataFrame([("a", 1)], "source_code string, target_concept_id int")
    assert rows(vocab.unmapped_codes(lines, mapping, F.col("code"))) == [("b",)]


def test_ambiguous_fan_out_is_kept(spark):
    source_map = spark.createDataFrame(
        [("x", 1, "procedure", None), ("x", 2, "device", None), ("x", 3, "device", None),
         ("y", 4, "procedure", None), ("z", 5, "procedure", "D")],
        "source_code string, target_concept_id int, domain_id string, invalid_reason string",
    )
    concept = spark.createDataFrame(
        [(i, None) for i in range(1, 6)], "concept_id int, invalid_reason string"
    )
    ambiguous = vocab.ambiguous_codes(source_map, "procedure", "device")
    assert rows(ambiguous, "source_code", "target_concept_id") == [("x", 1), ("x", 1)]
    exclusive = vocab.exclusive_mapping(source_map, concept, "procedure", "device")
    assert rows(exclusive, "source_code", "target_concept_id") == [("y", 4)]
    ranks = vocab.used(vocab.code_map(source_map, concept), vocab.PROCEDURE_AMBIGUOUS)
    assert rows(ranks, "target_concept_id", "rn") == [(1, 1), (1, 2)]


def test_normalise_vocabulary(spark):
    raw = spark.createDataFrame(
        [("Drug ", "", "S")], "domain_id string, invalid_reason string, standard_concept string"
    )
    assert rows(vocab.normalise_vocabulary(raw)) == [("drug", None, "S")]


def test_a_full_range_stops_before_any_line_is_written(spark, tmp_path):
    t20 = spark.createDataFrame(
        [(1, 10, "20080101", "02", "11", 1, "K1")],
        "key_seq bigint, person_id bigint, recu_fr_dt string, form_cd string, "
        "in_pat_cors_type string, vscn int, sub_sick string",
    )
    lines = spark.range(10).selectExpr("1L as key_seq", "cast(id as int) as seq_no", "'a' as div_cd")
    path = tmp_path / "keyed"
    with pytest.raises(ValueError, match="do not fit"):
        keys.keyed_lines(lines, t20, keys.TREATMENT, keys.SerialRanges(1), str(path))
    assert not path.exists()


def test_claims_are_not_gathered_on_the_driver(spark):
    claims = spark.createDataFrame([(1,), (2,)], "key_seq bigint")
    lines = spark.createDataFrame([(1, 1), (1, 2), (3, 1)], "key_seq bigint, seq_no int")
    counted = keys.counted_claims(lines, claims)
    assert rows(counted) == [(1, 2)]
    assert "Broadcast" not in counted._jdf.queryExecution().executedPlan().toString()


def test_large_orders_are_numbered_alike(spark, stages):
    from claimloom.binding import raw

    lines, lineitem = stages.line_rows, stages.lineitem
    window = raw.numbered_lines(lines, lineitem)
    # For the join with the header and for the place in the order, lines are shuffled once.
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert rows(raw.numbered_lines(lines, lineitem, large=5), *window.columns) == rows(window)


def _claims(spark):
    """Claims with and without header; lines of two of three sources, NULL keys among them."""
    header = (
        "key_seq bigint, person_id bigint, recu_fr_dt string, form_cd string, in_pat_cors_type string, "
        "vscn int, sub_sick string"
    )
    t20 = [(k, k % 7, f"2008010{k % 9}", "02", "" if k % 2 else None, k, "K1") for k in range(1, 400) if k % 5]
    t20 = spark.createDataFrame([*t20, (400, 99, None, "03", "11", None, ""), (None, 1, "", "", "", 1, "")], header)
    lines = spark.range(1, 2001).selectExpr(
        "if(id % 50 = 0, null, (id * 37) % 400) as key_seq", "cast(id as int) as seq_no",
        "if(id % 3 = 0, '', 'P' || id) as div_cd", "id / 8 as amt",
    )
    sick = lines.selectExpr("key_seq", "seq_no", "if(seq_no % 4 = 0, null, 'K') as sick_sym").where("seq_no < 90")
    return {keys.TREATMENT: lines, keys.DIAGNOSIS: sick, keys.PRESCRIPTION: lines.where("false")}, t20


def test_sources_in_one_pass_are_keyed_alike(spark, tmp_path):
    """Same lines, headers and serials as source by source, over many ranges."""
    sources, t20 = _claims(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keys.write_keyed_sources(sources, t20, str(tmp_path / "all"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    for source, lines in sources.items():
        once = keys.read_keyed_source(spark, str(tmp_path / "all"), source)
        alone = keys.keyed_lines(lines, t20, source)
        assert set(once.columns) == set(alone.columns)
        assert {f.name: f.dataType for f in once.schema} == {f.name: f.dataType for f in alone.schema}
        assert rows(once, *alone.columns) == rows(alone)


def test_a_line_meets_each_header_of_its_claim(spark, tmp_path):
    sources, t20 = _claims(spark)
    t20 = t20.unionByName(t20.where("key_seq % 10 = 3").withColumn("person_id", F.lit(77).cast("bigint")))
    keys.write_keyed_sources(sources, t20, str(tmp_path / "all"))
    for source, lines in sources.items():
        once = keys.read_keyed_source(spark, str(tmp_path / "all"), source)
        columns = [c for c in once.columns if c != "master_seq"]
        joined = lines.join(keys._header(t20), "key_seq")
        assert rows(once, *columns) == rows(joined, *columns)
        first = keys.RANGES.base(source) + 1
        ordered = once.orderBy("master_seq").collect()
        assert [r.master_seq for r in ordered] == list(range(first, first + len(ordered)))
        assert [(r.key_seq, r.seq_no) for r in ordered] == sorted((r.key_seq, r.seq_no) for r in ordered)


def test_a_full_range_leaves_no_lines_to_read(spark, tmp_path):
    sources, t20 = _claims(spark)
    with pytest.raises(ValueError, match="do not fit"):
        keys.write_keyed_sources(sources, t20, str(tmp_path / "all"), keys.SerialRanges(1))
    with pytest.raises(AnalysisException):
        keys.read_keyed_source(spark, str(tmp_path / "all"), keys.TREATMENT)


def test_lines_of_all_sources_move_once(spark):
    """One exchange of headers and lines, by range; none for each source and none for the serials."""
    plan = keys.sources_by_claim(*_claims(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan


def test_rows_in_ranges_are_numbered_where_they_lie(spark, tmp_path):
    """Ids follow the order, whether rows lie in ranges as said or not."""
    df = spark.range(3000).selectExpr("id % 41 as g", "(id * 7919) % 3000 as v")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        expected = sorted((r.g, r.v) for r in df.collect())
        ranged = df.repartitionByRange("g")
        for lie in (ranged, df.repartition("g"), df.repartition("v")):
            found = keys.with_identity(lie, ["g", "v"], "n", ranged=("g",))
            assert [(r.g, r.v) for r in found.orderBy("n").collect()] == expected
            assert found.agg(F.min("n"), F.max("n")).first()[:] == (1, 3000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
