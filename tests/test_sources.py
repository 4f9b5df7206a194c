import pytest
from base_helpers import rows

from claimloom.operators import visits
from claimloom.sources import loader, seeds, vocabulary
from claimloom.streaming import ingest


@pytest.fixture
def years(tmp_path):
    (tmp_path / "gy_2004.csv").write_text("key_seq,form_cd\n1,02\n2,03\n")
    (tmp_path / "gy_2005.csv").write_text("key_seq,extra\n3,x\n")
    return tmp_path


def test_union_columns_skips_missing(spark, years):
    paths = [f"{years}/gy_{y}.csv" for y in (2004, 2005, 2006)]
    assert loader.union_columns(spark, paths) == ["extra", "form_cd", "key_seq"]


def test_load_years(spark, years):
    df = loader.load_years(spark, str(years), "gy_{year}.csv", range(2004, 2007))
    assert df.columns == ["extra", "form_cd", "key_seq", "load_year"]
    assert rows(df.na.fill("-")) == [("-", "02", "1", 2004), ("-", "03", "2", 2004), ("x", "-", "3", 2005)]
    with pytest.raises(FileNotFoundError):
        loader.load_years(spark, str(years), "gy_{year}.csv", [1999])


def test_write_raw_and_single(spark, years, tmp_path):
    target = str(tmp_path / "out.parquet")
    df = spark.range(2)
    loader.write_raw(df, target, first=True)
    loader.write_raw(df, target, first=False)
    assert spark.read.parquet(target).count() == 4
    loader.write_raw(df, target, first=True)
    assert spark.read.parquet(target).count() == 2
    single = loader.load_single(spark, f"{years}/gy_2005.csv", str(tmp_path / "single"))
    assert rows(single) == [("3", "x")]


def test_incremental_batch_skips_early_and_bad_years(spark, years, tmp_path):
    (years / "gy_2007.csv").mkdir()
    target = str(tmp_path / "target")
    loaded = loader.ingest_incremental_batch(
        spark, str(years), "gy_{year}.csv", range(2004, 2008), 2005, target
    )
    assert loaded == [2005]


def test_ingest_remembers_files(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "gy_2004.csv").write_text("key_seq,vscn\n1,2\n2,bad\n")
    schema = "key_seq bigint, vscn int"
    first = ingest.ingest_incremental(spark, source, schema, target, checkpoint)
    assert rows(first, "key_seq", "vscn") == [(1, 2), (2, None)]
    assert first.where("_corrupt_record is not null").count() == 1
    (tmp_path / "in" / "gy_2005.csv").write_text("key_seq,vscn\n3,4\n")
    again = ingest.ingest_incremental(spark, source, schema, target, checkpoint)
    assert rows(again, "key_seq") == [(1,), (2,), (3,)]
    ingest.ingest_incremental(spark, source, schema, target, checkpoint)
    assert rows(ingest.loaded_files(spark, target)) == [("gy_2004.csv", 2), ("gy_2005.csv", 1)]


def write_vocabulary(folder, concept_rows):
    header = {
        "concept_synonym": "concept_id\tconcept_synonym_name\tlanguage_concept_id",
        "concept_relationship": "concept_id_1\tconcept_id_2\trelationship_id\tvalid_start_date\t"
        "valid_end_date\tinvalid_reason",
    }
    from claimloom import schemas

    for table in vocabulary.TABLES:
        names = header.get(table, "\t".join(schemas.VOCABULARY[table].names))
        body = concept_rows if table == "concept" else []
        (folder / f"{table.upper()}.csv").write_text("\n".join([names, *body]) + "\n")


GOOD = '1\tsay "hi\tDrug\tRxNorm\tIngredient\tS\tc1\t19700101\t20991231\t'


def test_load_vocabulary(spark, tmp_path):
    write_vocabulary(tmp_path, [GOOD])
    got = vocabulary.load_vocabulary(spark, str(tmp_path), str(tmp_path / "store"))
    assert set(got) == set(vocabulary.TABLES)
    concept = got["concept"]
    assert rows(concept, "concept_id", "concept_name", "domain_id", "invalid_reason") == [
        (1, 'say "hi', "drug", None)
    ]
    assert concept.first()["valid_end_date"].year == 2099


def test_load_vocabulary_rejects(spark, tmp_path):
    write_vocabulary(tmp_path, [GOOD, "x\tbad\tDrug\tRxNorm\tIngredient\tS\tc2\t19700101\tnever\t"])
    with pytest.raises(Exception):
        vocabulary.load_vocabulary(spark, str(tmp_path), str(tmp_path / "store"))
    got = vocabulary.load_vocabulary(
        spark, str(tmp_path), str(tmp_path / "store2"), str(tmp_path / "bad")
    )
    assert got["concept"].count() == 1
    assert spark.read.parquet(str(tmp_path / "bad" / "concept")).count() == 1


def test_seeds(spark, tmp_path):
    assert seeds.seed_death_map(spark).count() == 47
    (tmp_path / "regions.csv").write_text("code,province,district\n11110,Seoul,Jongno\n")
    got = visits.location(seeds.seed_location(spark, str(tmp_path / "regions.csv")))
    assert rows(got, "location_id", "address_2", "county") == [(11110, "11110 Jongno", "KOREA")]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, t string")
    got = loader.profile_table(df, "sample")
    assert rows(got, "position", "column_name", "type", "rows") == [
        (0, "k", "int", 2), (1, "t", "string", 2),
    ]
    assert "database" in loader.list_tables(spark).columns


def test_normalise_strings(spark):
    df = spark.createDataFrame([("a  ", 1)], "t string, n int")
    assert rows(loader.normalise_strings(df)) == [("a", 1)]


def test_ingest_goes_on_with_the_checkpoint_beside_the_target(spark, tmp_path):
    """A later call without a named checkpoint adds new files; a foreign one is refused."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    schema = "key_seq bigint, vscn int"
    for year in (2004, 2005, 2006):
        (tmp_path / "in" / f"gy_{year}.csv").write_text(f"key_seq,vscn\n{year},1\n")
        got = ingest.ingest_incremental(spark, source, schema, target)
        assert rows(got, "key_seq") == [(y,) for y in range(2004, year + 1)]
    with pytest.raises(ValueError, match="do not belong together"):
        ingest.ingest_incremental(spark, source, schema, target, str(tmp_path / "other"))
    # A target that was cleared no longer fits the checkpoint that knows its files.
    (tmp_path / "out").rename(tmp_path / "gone")
    with pytest.raises(ValueError, match="do not belong together"):
        ingest.ingest_incremental(spark, source, schema, target)


def test_batches_are_not_appended_twice(spark, years, tmp_path):
    target = str(tmp_path / "target")
    load = lambda: loader.ingest_incremental_batch(
        spark, str(years), "gy_{year}.csv", range(2004, 2007), 2004, target
    )
    assert load() == [2004, 2005] and load() == []
    (years / "gy_2006.csv").write_text("key_seq\n9\n")
    assert load() == [2006]
    assert spark.read.parquet(target).count() == 4


def test_only_missing_years_are_skipped(spark, years):
    (years / "gy_2006.parquet").write_text("no parquet")
    with pytest.raises(Exception) as error:
        loader.union_columns(spark, [f"{years}/gy_2004.csv", f"{years}/gy_2006.parquet"])
    assert "PATH_NOT_FOUND" not in str(error.value)
