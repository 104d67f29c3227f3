"""Step state with several writers, torn saves and removal of old saves."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from pagetally.sources import state


def keys(spark, step, values):
    return spark.createDataFrame([(step, v) for v in values], "step string, slug string")


def slugs(spark, path, step="s"):
    return {r.slug for r in state.load_checkpoint(state.read_state(spark, path), step).collect()}


def test_interleaved_saves_do_not_mix(spark, tmp_path, monkeypatch):
    """Both runs read the same log before either writes; one of the two sets is in force."""
    path = str(tmp_path / "state")
    state.save_checkpoint(keys(spark, "s", ["old"]), path)
    sets = [{f"a{i}" for i in range(40)}, {f"b{i}" for i in range(30)}]
    seen = state.read_log(spark, path)
    monkeypatch.setattr(state, "read_log", lambda *_: seen)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda s: state.save_checkpoint(
            keys(spark, "s", s).repartition(4), path), sets))
    monkeypatch.undo()
    log = state.read_log(spark, path)
    assert log.select(F.substring("save", 1, 12)).distinct().count() == 2
    assert log.select("save").distinct().count() == 3
    assert slugs(spark, path) in sets


def test_a_torn_save_leaves_the_one_before(spark, tmp_path):
    path = tmp_path / "state"
    state.save_checkpoint(keys(spark, "s", ["x", "y"]), str(path))
    first = {p.name for p in path.iterdir()}
    state.save_checkpoint(keys(spark, "s", [str(i) for i in range(20)]).repartition(5), str(path))
    folder, = [p / "step=s" for p in path.iterdir() if p.name not in first]
    part = sorted(folder.glob("part-*"))[0]
    part.rename(folder / f"_{part.name}")
    (folder / f".{part.name}.crc").unlink(missing_ok=True)
    assert slugs(spark, str(path)) == {"x", "y"}
    # a whole newer save takes over, and then both older ones may go
    state.save_checkpoint(keys(spark, "s", ["z"]), str(path))
    assert slugs(spark, str(path)) == {"z"}
    assert state.remove_old_saves(spark, str(path)) == 2
    assert slugs(spark, str(path)) == {"z"} and state.remove_old_saves(spark, str(path)) == 0


def test_the_log_stays_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "KEEP_SAVES", 4)
    path = tmp_path / "state"
    state.save_checkpoint(keys(spark, "other: a/b%", ["kept"]), str(path))
    for i in range(14):
        state.save_checkpoint(keys(spark, "s", [f"k{i}", "all"]), str(path))
        assert len(list(path.iterdir())) <= 7
    assert slugs(spark, str(path)) == {"k13", "all"}
    assert slugs(spark, str(path), "other: a/b%") == {"kept"}
    state.clear_steps(spark, str(path), ["s"])
    assert slugs(spark, str(path)) == set()


def test_more_saves_than_a_filter_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "NAMED", 1)
    path = str(tmp_path / "state")
    for step in "abc":
        state.save_checkpoint(keys(spark, step, [step, None, step]), path)
    assert {r.step: r.completed for r in state.state_summary(state.read_state(spark, path)).collect()} == {
        "a": 1, "b": 1, "c": 1}
    assert state.remove_old_saves(spark, str(tmp_path / "none")) == 0
