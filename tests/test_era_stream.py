import datetime as dt
import os

import pytest
from base_helpers import rows

from claimloom.binding import queries
from claimloom.operators import eras as batch
from claimloom.streaming import eras

DAY = dt.date
SCHEMA = (
    "person_id long, condition_concept_id int, condition_start_date date, condition_end_date date, "
    "note string"
)


def _frame(spark, given):
    return spark.createDataFrame([(p, c, s, e, "x") for p, c, s, e in given], SCHEMA)


@pytest.fixture
def stream(spark, tmp_path):
    """(stream over new files, function that adds a file of rows)."""

    def add(given):
        _frame(spark, given).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def new(**more):
        return eras.EraStream(
            spark, f"{tmp_path}/in", _frame(spark, []).schema, f"{tmp_path}/out", eras.CONDITIONS, **more
        )

    return new, add


def _eras(closed):
    return rows(eras.condition_eras(closed))


ORDERED = [
    [(1, 5, DAY(2005, 1, 1), DAY(2005, 1, 3)), (1, 5, DAY(2005, 1, 1), None), (2, 5, DAY(2005, 6, 1), DAY(2005, 6, 1))],
    # Exactly 30 days after the end: the same era; 31 days: another one.
    [(1, 5, DAY(2005, 2, 2), DAY(2005, 2, 2)), (2, 5, DAY(2005, 7, 2), DAY(2005, 7, 2)), (1, 6, DAY(2005, 2, 2), DAY(2007, 2, 2))],
    [(1, 5, DAY(2005, 3, 5), DAY(2005, 3, 5)), (1, 6, DAY(2007, 1, 1), DAY(2007, 1, 2)), (None, 5, DAY(2007, 1, 1), DAY(2007, 1, 1)),
     (3, None, DAY(2007, 5, 1), DAY(2007, 4, 1)), (3, 5, None, DAY(2007, 4, 1))],
]


def test_rows_in_order_give_the_eras_of_the_batch(spark, stream):
    new, add = stream
    for part in ORDERED:
        add(part)
        new(lateness="800 days").run()
    closed = new(lateness="800 days").finish()
    given = [r for part in ORDERED for r in part if r[2]]
    expected = batch.condition_era_spans(_frame(spark, given))
    assert _eras(closed) == rows(expected)
    assert (1, 5, DAY(2005, 1, 1), DAY(2005, 2, 2), 2) in _eras(closed)
    assert {r.late for r in new().late_rows().collect()} == {0}
    # The stream is closed: nothing new, and a row that comes now is late.
    assert _eras(new().run()) == rows(expected)
    add([(9, 9, DAY(2020, 1, 1), DAY(2020, 1, 1))])
    assert _eras(new().run()) == rows(expected)
    assert [tuple(r) for r in new().late_rows().where("late > 0").collect()] == [(9, 9, 1, 1)]


def test_an_era_stays_open_until_the_watermark_passes_it(stream):
    new, add = stream
    add([(1, 5, DAY(2005, 1, 1), DAY(2005, 1, 10))])
    assert _eras(new(lateness="60 days").run()) == []
    # The watermark is 3 February, the session ends on 9 February.
    add([(2, 5, DAY(2005, 4, 4), DAY(2005, 4, 4))])
    assert _eras(new(lateness="60 days").run()) == []
    # Out of order, but not late: the era is still open.
    add([(1, 5, DAY(2005, 1, 20), DAY(2005, 1, 20)), (2, 5, DAY(2005, 4, 30), DAY(2005, 4, 30))])
    assert _eras(new(lateness="60 days").run()) == [(1, 5, DAY(2005, 1, 1), DAY(2005, 1, 20), 2)]


def test_late_rows_are_dropped_and_counted(stream):
    new, add = stream
    add([(1, 5, DAY(2005, 1, 1), DAY(2005, 1, 1)), (2, 5, DAY(2010, 1, 1), DAY(2010, 1, 1))])
    before = new(lateness="30 days").run()
    assert _eras(before) == [(1, 5, DAY(2005, 1, 1), DAY(2005, 1, 1), 1)]
    late = [(1, 5, DAY(2005, 1, 5), DAY(2005, 1, 5))] * 3 + [(1, 5, DAY(2006, 1, 5), DAY(2006, 1, 5)), (4, 8, DAY(2001, 1, 1), None)]
    # Its start is behind the watermark, its session is not.
    add([*late, (1, 5, DAY(2009, 11, 20), DAY(2009, 11, 20))])
    new(lateness="30 days").run()
    closed = new(lateness="30 days").finish()
    assert _eras(closed) == [
        (1, 5, DAY(2005, 1, 1), DAY(2005, 1, 1), 1), (1, 5, DAY(2009, 11, 20), DAY(2009, 11, 20), 1),
        (2, 5, DAY(2010, 1, 1), DAY(2010, 1, 1), 1),
    ]
    assert rows(new().late_rows()) == [(1, 5, 6, 4), (2, 5, 1, 0), (4, 8, 1, 1)]


def test_a_batch_that_was_not_finished_is_repeated_without_double_eras(spark, stream):
    """A crash after the eras were written, before the batch was noted as finished."""
    new, add = stream
    for part in ORDERED[:2]:
        add(part)
    add([(7, 7, DAY(2009, 1, 1), DAY(2009, 1, 1))])
    first = new(lateness="30 days", files_per_batch=1)
    expected = _eras(first.run())
    commits = f"{first.checkpoint}/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.rename(f"{commits}/{name}", f"{first.target}-{name.strip('.')}.lost")
    again = new(lateness="30 days", files_per_batch=1)
    assert _eras(again.run()) == expected and expected
    given = [r for part in ORDERED[:2] for r in part] + [(7, 7, DAY(2009, 1, 1), DAY(2009, 1, 1))]
    assert _eras(again.finish()) == rows(batch.condition_era_spans(_frame(spark, given)))
    assert {r.late for r in again.late_rows().collect()} == {0}


def test_another_checkpoint_is_refused(stream, tmp_path):
    new, add = stream
    add(ORDERED[0])
    new().run()
    os.rename(f"{tmp_path}/out.checkpoint", f"{tmp_path}/elsewhere")
    with pytest.raises(ValueError, match="belong together"):
        new().run()


def test_drug_types_share_an_era_and_are_told_apart(spark, stages, tmp_path):
    """All drug exposures of the bound tables in one batch, ingredients joined in the stream."""
    stages.drug.write.parquet(f"{tmp_path}/in")
    stream = eras.EraStream(
        spark, f"{tmp_path}/in", stages.drug.schema, f"{tmp_path}/out", eras.DRUGS, stages.ingredient_map
    )
    found = eras.drug_eras(stream.finish())
    expected = batch.drug_era_spans(stages.drug, stages.ingredient_map)
    assert rows(found) == rows(expected.select(found.columns))
    assert {r.late for r in stream.late_rows().collect()} == {0}


def test_state_lies_on_disk(spark, tmp_path):
    """The store of the state and what the session says of it afterwards."""
    _frame(spark, ORDERED[0]).write.parquet(f"{tmp_path}/in")
    stream = eras.EraStream(spark, f"{tmp_path}/in", _frame(spark, []).schema, f"{tmp_path}/out", eras.CONDITIONS)
    stream.run()
    with open(f"{tmp_path}/out.checkpoint/offsets/0") as log:
        assert "RocksDBStateStoreProvider" in log.read()
    assert all(spark.conf.get(key, None) is None for key in eras.STATE_STORE)
    # One that the session names is kept.
    given = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(eras.PROVIDER, given)
    try:
        with eras._state_store(spark):
            assert spark.conf.get(eras.PROVIDER) == given
    finally:
        spark.conf.unset(eras.PROVIDER)


def test_state_is_one_window_aggregate_in_the_engine(spark, stream):
    """No Python in the plan; one shuffle to the state."""
    import contextlib
    import io

    spans = eras._spans(_frame(spark, ORDERED[0]), eras.CONDITIONS, None)
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        eras.era_sessions(spans, "30 days").explain()
    plan = shown.getvalue()
    assert "Python" not in plan and "Pandas" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_registered(spark):
    names = {"era_stream", "era_stream_drug", "era_stream_late"}
    assert names <= queries.QUERIES.keys() and all(queries.QUERIES[n].oracle() for n in names)
