from __future__ import annotations

import random
from collections import Counter
from dataclasses import replace

import pytest

from logtally.operators.batches import BatchTable, Part, _consecutive
from logtally.operators.ledger import CountLedger
from logtally.plans import DAILY_SUMMARY, MILLISECOND_SUMMARY
from logtally.storage import Files, fresh_dir

from tests.conftest import rows

KEYS = ("day", "app")
SCHEMA = "day string, app string, count bigint"


@pytest.fixture
def ledger(spark):
    return CountLedger(spark, fresh_dir(spark, "ledger"), KEYS)


@pytest.fixture
def counts(spark):
    return lambda *given: spark.createDataFrame(list(given), SCHEMA)


def test_an_empty_ledger(ledger):
    assert rows(ledger.totals()) == [] and rows(ledger.summary()) == [] and rows(ledger.batch_counts()) == []
    assert ledger.summary().schema.simpleString() == "struct<day:string,app:string,count:string>"
    assert ledger.runs() == set()
    assert ledger.compact() == 0


def test_batches_add_up_and_a_replay_replaces(ledger, counts):
    assert ledger.write_batch(counts(("d", "a", 1), ("d", "b", 2)), "r", 0)
    assert ledger.write_batch(counts(("d", "a", 10)), "r", 1)
    assert rows(ledger.totals()) == [("d", "a", 11), ("d", "b", 2)]
    assert ledger.write_batch(counts(("d", "a", 10)), "r", 1)
    assert rows(ledger.summary()) == [("d", "a", "11"), ("d", "b", "2")]
    assert rows(ledger.batch_counts()) == [("r", 0, "d", "a", 1), ("r", 0, "d", "b", 2), ("r", 1, "d", "a", 10)]


def test_a_complete_batch_can_be_left_alone(ledger, counts):
    assert ledger.write_batch(counts(("d", "a", 1)), "r", 0, replace=False)
    assert not ledger.write_batch(counts(("d", "a", 9)), "r", 0, replace=False)
    assert rows(ledger.totals()) == [("d", "a", 1)]
    assert ledger.write_batch(counts(("d", "a", 9)), "r", 0)
    assert rows(ledger.totals()) == [("d", "a", 9)]


def test_other_columns_are_refused(spark, ledger, counts):
    ledger.write_batch(counts(("d", "a", 1)), "r", 0)
    other = CountLedger(spark, ledger.path, ("day", "shop"))
    swapped = CountLedger(spark, ledger.path, ("app", "day"))
    renamed = CountLedger(spark, ledger.path, KEYS, "n")
    for stranger in (other, swapped, renamed):
        with pytest.raises(ValueError, match="holds"):
            stranger.totals()
        with pytest.raises(ValueError, match="holds"):
            stranger.write_batch(counts(("d", "a", 1)), "r", 1)
    assert rows(CountLedger(spark, ledger.path, KEYS).totals()) == [("d", "a", 1)]


def test_a_batch_may_repeat_a_group(ledger, counts):
    ledger.write_batch(counts(("d", "a", 1), ("d", "a", 2)), "r", 0)
    assert rows(ledger.totals()) == [("d", "a", 3)]


def test_a_merge_while_a_reader_has_its_list(ledger, counts):
    """What a reader has listed stays until the merge after the next one, so it neither misses batches nor counts them twice."""
    for i in range(2):
        ledger.write_batch(counts(("d", "a", 1)), "r", i)
    before = ledger.totals()
    assert ledger.compact() == 1
    assert rows(before) == rows(ledger.totals()) == [("d", "a", 2)]


def test_a_batch_without_rows_is_there(ledger, counts):
    ledger.write_batch(counts(("d", "a", 1)), "r", 0)
    ledger.write_batch(counts(), "r", 1)
    ledger.write_batch(counts((None, None, None)), "r", 2)
    assert ledger.last_batch("r") == 2 and ledger.last_batch("q") is None
    assert rows(ledger.totals()) == sorted([("d", "a", 1), (None, None, None)], key=repr)
    assert ledger.compact() == 1
    assert ledger.batches.live() == [Part("r", 0, 2)]


def test_runs_do_not_share_batch_ids(ledger, counts):
    ledger.write_batch(counts(("d", "a", 1)), "r1", 0)
    ledger.write_batch(counts(("d", "a", 1)), "r2", 0)
    assert rows(ledger.totals()) == [("d", "a", 2)]
    assert ledger.runs() == {"r1", "r2"}


@pytest.mark.parametrize("run_id, batch_id", [("", 0), ("a/b", 0), ("a=b", 0), ("r", -1)])
def test_bad_ids_are_refused(ledger, counts, run_id, batch_id):
    with pytest.raises(ValueError):
        ledger.write_batch(counts(("d", "a", 1)), run_id, batch_id)


def test_null_group_values_survive(ledger, counts):
    ledger.write_batch(counts((None, "a", 1)), "r", 0)
    ledger.write_batch(counts((None, "a", 2)), "r", 1)
    assert rows(ledger.totals()) == [(None, "a", 3)]
    assert ledger.compact() == 1
    assert rows(ledger.totals()) == [(None, "a", 3)]


def test_what_a_writer_left_behind_is_not_read(spark, ledger, counts):
    ledger.write_batch(counts(("d", "a", 1)), "r", 0)
    ledger.write_batch(counts(("d", "a", 5)), "q", 0)
    files, root = ledger.files, ledger.batches.path
    # As a job leaves it that dies before Spark moves its partition into place.
    files.rename(f"{root}/run_id=q", f"{root}/.spark-staging-1/run_id=q")
    assert rows(ledger.totals()) == [("d", "a", 1)] and ledger.runs() == {"r"}
    assert ledger.write_batch(counts(("d", "a", 5)), "q", 0, replace=False)
    assert rows(ledger.totals()) == [("d", "a", 6)]


def test_merging_changes_no_total(ledger, counts):
    for batch_id in range(3):
        ledger.write_batch(counts(("d", "a", 1), (f"d{batch_id}", "b", 1)), "r", batch_id)
    before = rows(ledger.totals())
    assert ledger.compact() == 1
    assert rows(ledger.totals()) == before
    assert rows(ledger.batch_counts()) == []
    assert ledger.compact() == 0
    assert rows(ledger.totals()) == before
    assert ledger.batches.parts() == [Part("r", 0, 2)]


def test_a_merged_batch_is_not_counted_again(ledger, counts):
    for i in range(2):
        ledger.write_batch(counts(("d", "a", 1)), "r", i)
    ledger.compact()
    for _ in range(2):
        for i in range(2):
            assert not ledger.write_batch(counts(("d", "a", 1)), "r", i)
        assert rows(ledger.totals()) == [("d", "a", 2)]
        ledger.compact()


def test_batches_may_come_out_of_order(ledger, counts):
    """Nothing is merged across an id that isn't there, so one that comes late is new and not taken for a replay."""
    for i in (5, 6, 2, 3):
        ledger.write_batch(counts(("d", "a", 1)), "r", i)
    assert ledger.compact() == 2
    assert ledger.write_batch(counts(("d", "a", 1)), "r", 4)
    assert rows(ledger.totals()) == [("d", "a", 5)]
    ledger.compact(full=True)
    assert ledger.batches.live() == [Part("r", 2, 6)]
    assert rows(ledger.totals()) == [("d", "a", 5)]


def test_a_merge_that_dies_changes_nothing(ledger, counts, monkeypatch):
    for i in range(2):
        ledger.write_batch(counts(("d", "a", 1)), "r", i)

    def die(*_):
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(ledger.batches, "write", die)
        with pytest.raises(OSError):
            ledger.compact()
    assert rows(ledger.totals()) == [("d", "a", 2)]
    assert ledger.compact() == 1
    assert rows(ledger.totals()) == [("d", "a", 2)]


def test_two_merges_that_overlap_are_noticed(ledger, counts):
    for i in range(4):
        ledger.write_batch(counts(("d", "a", 1)), "r", i)
    for first, last in ((0, 2), (1, 3)):
        ledger.batches.write(counts(("d", "a", 3)), Part("r", first, last))
    with pytest.raises(RuntimeError, match="overlap"):
        ledger.totals()


def test_a_merge_that_dies_while_cleaning_up_changes_nothing(ledger, counts, monkeypatch):
    for batch_id in range(4):
        ledger.write_batch(counts(("d", "a", 1)), "r", batch_id)
    ledger.compact()
    files = ledger.batches.files
    delete, calls = files.delete, []

    def die_on_second(path):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("gone")
        delete(path)

    with monkeypatch.context() as patched:
        patched.setattr(files, "delete", die_on_second)
        with pytest.raises(OSError):
            ledger.compact()
    assert rows(ledger.totals()) == [("d", "a", 4)]
    ledger.compact()
    assert rows(ledger.totals()) == [("d", "a", 4)] and ledger.batches.parts() == [Part("r", 0, 3)]


def test_a_larger_sum_is_left_alone_until_a_full_merge(ledger, spark):
    big = spark.range(20000).selectExpr("cast(id as string) day", "cast(hash(id) as string) app", "1L count")
    for i, batch in enumerate((big, big, big.limit(1), big.limit(1))):
        ledger.write_batch(batch, "r", i)
        if i % 2:
            assert ledger.compact() == 1
    assert ledger.batches.live() == [Part("r", 0, 1), Part("r", 2, 3)]
    assert ledger.totals().count() == 20000
    assert ledger.compact() == 0
    assert ledger.compact(full=True) == 1
    assert ledger.batches.live() == [Part("r", 0, 3)]
    assert ledger.totals().agg({"count": "sum"}).first()[0] == 40002


def test_random_histories(spark, ledger, counts):
    """Batches, replays and merges, with and without cleaning up, in any order leave the totals of the distinct batches."""
    draw = random.Random(7)
    written: dict[tuple[str, int], list] = {}
    for _ in range(25):
        action = draw.random()
        if action < 0.6:
            run, batch = draw.choice("xy"), draw.randint(0, 9)
            content = written.setdefault(
                (run, batch), [(draw.choice("de"), app, draw.randint(1, 5)) for app in draw.sample("abc", 2)]
            )
            ledger.write_batch(counts(*content), run, batch)
        else:
            ledger.compact(full=draw.random() < 0.3, keep_seconds=draw.choice([0, 3600]))
        expected = Counter()
        for content in written.values():
            for day, app, count in content:
                expected[day, app] += count
        assert rows(ledger.totals()) == sorted((day, app, n) for (day, app), n in expected.items())


def test_reset_forgets_everything(ledger, counts):
    ledger.write_batch(counts(("d", "a", 1)), "r", 0)
    ledger.compact()
    ledger.reset()
    assert rows(ledger.totals()) == [] and ledger.runs() == set()


def test_a_filter_on_a_group_column_reaches_the_scan(ledger, counts):
    ledger.write_batch(counts(("d", "a", 1)), "r", 0)
    ledger.write_batch(counts(("d", "a", 1)), "r", 1)
    plan = ledger.totals().where("day = 'd'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(day,d)" in plan


def test_one_source_needs_no_shuffle(ledger, counts):
    ledger.write_batch(counts(("d", "a", 1)), "r", 0)
    ledger.write_batch(counts(("d", "a", 1)), "r", 1)
    plan = lambda: ledger.totals()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan()
    ledger.compact()
    assert "Exchange" not in plan()


def test_rows_without_a_gap():
    parts = [Part("q", 1, 1), Part("r", 0, 4), Part("r", 5, 5), Part("r", 7, 7)]
    assert _consecutive(parts) == [[parts[0]], parts[1:3], parts[3:]]
    assert parts[1].spans(Part("r", 4, 4)) and not parts[1].spans(parts[1]) and not parts[1].spans(parts[2])


def test_names_of_its_own_are_refused(spark):
    with pytest.raises(ValueError, match="batch_id"):
        CountLedger(spark, fresh_dir(spark, "ledger"), ("day", "batch_id"))


def test_publishing_never_overwrites(spark):
    folder = fresh_dir(spark, "published")
    files = Files(spark, folder)
    files.publish(f"{folder}/a.json", "1")
    with pytest.raises(FileExistsError):
        files.publish(f"{folder}/a.json", "2")
    assert files.read(f"{folder}/a.json") == "1"
    assert files.children(folder) in (["a.json"], [".a.json.crc", "a.json"])


def test_a_path_with_pattern_characters(spark, counts):
    path = f"{fresh_dir(spark, 'ledger')}/led{{x}}[1]*? %20=ä"
    ledger = CountLedger(spark, path, KEYS)
    for i in range(3):
        ledger.write_batch(counts(("d", "a", 1)), "r", i)
    assert ledger.runs() == {"r"} and rows(ledger.totals()) == [("d", "a", 3)]
    assert ledger.batch_counts().count() == 3
    assert ledger.compact() == 1
    ledger.write_batch(counts(("d", "a", 1)), "r", 3)
    assert rows(ledger.totals()) == [("d", "a", 4)] and ledger.last_batch("r") == 3


def test_another_spec_on_the_same_columns_is_refused(spark, counts):
    path = fresh_dir(spark, "ledger")
    batch = counts(("d", "a", 1)).toDF("time_stamp", "app_id", "count")
    CountLedger.for_spec(spark, path, DAILY_SUMMARY).write_batch(batch, "r", 0)
    renamed = replace(DAILY_SUMMARY, table="other_name")
    assert CountLedger.for_spec(spark, path, renamed).totals().count() == 1
    for other in (MILLISECOND_SUMMARY, replace(DAILY_SUMMARY, where=None), replace(DAILY_SUMMARY, delimiter=";")):
        ledger = CountLedger.for_spec(spark, path, other)
        with pytest.raises(ValueError):
            ledger.write_batch(batch, "r", 1)
        with pytest.raises(ValueError):
            ledger.totals()


def test_a_count_that_is_no_number_fails_the_write(spark, counts):
    ledger = CountLedger(spark, fresh_dir(spark, "ledger"), KEYS)
    with pytest.raises(Exception, match="no number"):
        ledger.write_batch(counts(("d", "a", 1)).selectExpr("day", "app", "'x' AS count"), "r", 0)
    assert rows(ledger.totals()) == []


def test_clean_up_waits(spark, counts):
    ledger = CountLedger(spark, fresh_dir(spark, "ledger"), KEYS)
    for i in range(2):
        ledger.write_batch(counts(("d", "a", 1)), "r", i)
    ledger.compact()
    ledger.compact(keep_seconds=3600)
    assert len(ledger.batches.parts()) == 3
    ledger.compact()
    assert ledger.batches.parts() == [Part("r", 0, 1)]


def test_a_partition_is_replaced_and_no_other(spark):
    table = BatchTable(spark, fresh_dir(spark, "table"), spark.createDataFrame([], "a string, n int").schema)
    make = lambda *given: spark.createDataFrame(list(given), "n int, a string")
    table.write(make((1, "x"), (2, "y")), Part("1", 0, 0))
    table.write(make((3, "z")), Part("1", 1, 1))
    table.write(make((4, None)), Part("1", 0, 0))
    assert rows(table.read(table.live())) == sorted([(None, 4, "1", 0, 0), ("z", 3, "1", 1, 1)], key=repr)
    assert table.read([]).columns == ["a", "n", "run_id", "first_batch", "batch_id"]
