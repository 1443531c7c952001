import pytest
from conftest import make_feed, play, rows, start

from courtside.schema import FEED_SCHEMA
from courtside.streaming import compaction, jobs, sinks


def batch(spark, path, n, totals):
    table = spark.createDataFrame(list(totals.items()), "player string, total bigint").coalesce(1)
    table.write.mode("overwrite").parquet(f"{path}/batch_id={n}")


def folders(spark, path):
    files = compaction._Files(spark, path)
    return len(compaction._batches(files)), len(files.names("_compacted")), len(files.names("_manifest"))


def latest(spark, path):
    return rows(sinks.read_latest(spark, path, ["player"]))


def test_a_reader_has_few_folders_after_many_batches(spark, tmp_path):
    path, now = str(tmp_path / "t"), {}
    for n in range(9):
        change = {f"P{n % 4}": n, f"N{n}": 1, "all": n * n}
        now |= change
        batch(spark, path, n, change)
        if n % 2:
            assert compaction.compact(spark, path, ["player"]) == n - 1
        assert latest(spark, path) == sorted(now.items())
    live = folders(spark, path)
    assert live[0] <= 5 and live[1:] == (2, 2)
    read = sinks.read_latest(spark, path, ["player"]).inputFiles()
    assert len({f.rsplit("/", 1)[0] for f in read}) <= 3  # one table, at most two batches


def test_a_crash_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(3):
        batch(spark, path, n, {"a": n, f"b{n}": n})
    before = latest(spark, path)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "publish", crash)
        with pytest.raises(RuntimeError):
            compaction.compact(spark, path, ["player"])
    assert folders(spark, path) == (3, 1, 0) and latest(spark, path) == before
    assert compaction.compact(spark, path, ["player"]) == 1
    assert folders(spark, path) == (3, 1, 1) and latest(spark, path) == before
    assert compaction.compact(spark, path, ["player"]) is None  # nothing new to fold


def test_a_reader_that_began_before_a_switch_can_finish(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        batch(spark, path, n, {"a": n})
    first = sinks.read_latest(spark, path, ["player"])
    compaction.compact(spark, path, ["player"])
    assert rows(first) == [("a", 2)]
    second = sinks.read_latest(spark, path, ["player"])
    batch(spark, path, 3, {"a": 3})
    compaction.compact(spark, path, ["player"])
    assert rows(second) == [("a", 2)] and latest(spark, path) == [("a", 3)]


def test_the_newest_batch_may_be_written_again_and_unfinished_ones_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    batch(spark, path, 0, {"a": 1})
    assert compaction.compact(spark, path, ["player"]) is None
    batch(spark, path, 1, {"a": 2})
    assert compaction.compact(spark, path, ["player"]) == 0
    batch(spark, path, 1, {"a": 5, "b": 6})  # the same batch after a failure
    assert latest(spark, path) == [("a", 5), ("b", 6)]
    (tmp_path / "t" / "batch_id=2").mkdir()
    assert latest(spark, path) == [("a", 5), ("b", 6)]
    with pytest.raises(FileNotFoundError):
        sinks.read_latest(spark, str(tmp_path / "none"), ["player"])


def test_keys_are_needed(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_changelog(spark.readStream.format("rate").load(), str(tmp_path / "t"), str(tmp_path / "c"), compact_every=2)


def test_a_final_removes_its_match_and_a_start_brings_the_next(spark, tmp_path):
    feed, live, odds = (str(tmp_path / name) for name in ("f", "l", "o"))
    teams = {"A": (["a"], []), "B": (["b"], [])}
    parts = [
        [("g1", 1, start("A", "B", **teams)), ("g1", 2, play("A", 3, "A 1 X 0 B", acao="FOUL")),
         ("g2", 3, play("C", 2, "C 4 X 0 D", acao="FOUL"))],
        [("g1", 9, {"tipo": "FINAL", "match": "A 1 X 0 B"}), ("g2", 8, play("C", None, "C 4 X 5 D", acao="FOUL"))],
        [("g1", 20, start("B", "A", **teams)), ("g2", 7, play("C", 4, "C 4 X 2 D", acao="FOUL"))],
    ]
    want = [
        [("g1", "A", "B", 1, 0, 3), ("g2", "C", "D", 4, 0, 2)],
        [("g2", "C", "D", 4, 5, 2)],
        [("g1", "B", "A", 0, 0, 0), ("g2", "C", "D", 4, 5, 4)],
    ]
    for part, matches in zip(parts, want):
        make_feed(spark, part).coalesce(1).write.mode("append").parquet(feed)
        arriving = spark.readStream.schema(FEED_SCHEMA).parquet(feed)
        jobs.live_matches(arriving, live, f"{live}.c", available_now=True, compact_every=1).awaitTermination()
        assert rows(sinks.read_latest(spark, live, ["game_key"], removed="removed")) == matches
    # g1 was gone in the newest table, and came back with the batch after it
    folder = compaction._versions(compaction._Files(spark, live))[-1][1]
    assert [r["game_key"] for r in spark.read.parquet(f"{live}/_compacted/{folder}").collect()] == ["g2"]
    jobs.open_odds(arriving, odds, f"{odds}.c", available_now=True).awaitTermination()
    assert [r[0] for r in rows(sinks.read_latest(spark, odds, ["game_key"], removed="removed"))] == ["g2"]
