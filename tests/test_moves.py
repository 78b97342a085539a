"""Rewriting and moving by journal, stopped between any two steps."""

import pytest

from lexharbor.plans import layout
from lexharbor.sources import archive, moves


class Stop(Exception):
    pass


def stopping(monkeypatch, after):
    """Calls of rename and delete raise after the first ``after`` of them."""
    done = [0]

    def wrap(real):
        def step(*args):
            if done[0] >= after:
                raise Stop
            done[0] += 1
            return real(*args)

        return step

    for name in ("_rename", "delete"):
        monkeypatch.setattr(moves, name, wrap(getattr(moves, name)))


def write(df, path):
    df.write.parquet(path)


@pytest.mark.parametrize("after", range(5))
def test_a_stopped_swap_leaves_old_or_new(spark, tmp_path, monkeypatch, after):
    path = f"{tmp_path}/table"
    write(spark.range(3), path)
    with monkeypatch.context() as m:
        stopping(m, after)
        try:
            moves.swap(spark.read.parquet(path).where("id > 0"), path, write)
            assert after == 4
        except Stop:
            assert after < 4
    moves.finish(spark, str(tmp_path))
    rows = sorted(r[0] for r in spark.read.parquet(path).collect())
    assert rows == ([0, 1, 2] if after == 0 else [1, 2])
    assert (tmp_path / "table.bak").exists() == (after > 0)
    # The next rewrite works and leaves nothing beside the tables.
    archive.rewrite(spark.range(1), path, write)
    assert [r[0] for r in spark.read.parquet(path).collect()] == [0]
    left = {p.name for p in tmp_path.iterdir() if not p.name.startswith(".")}
    assert {n for n in left if not n.endswith(".tmp")} == {"table", "table.bak"} | ({"table.bak.1"} if after else set())


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    write(spark.range(3), path)

    def half(df, target):
        write(df, target)
        raise Stop

    with pytest.raises(Stop):
        moves.swap(spark.range(1), path, half)
    assert spark.read.parquet(path).count() == 3
    moves.swap(spark.range(2), path, write)
    assert spark.read.parquet(path).count() == 2
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(moves.NEW)]


def make(folder, files):
    for name in files:
        (folder / name).write_text(name)


def test_layout_moves_files(spark, tmp_path):
    make(tmp_path, ["run.log", "x.png", "all_bibliography.csv", "w_gap_merged.csv"])
    got = layout.apply_moves(spark, str(tmp_path))
    assert got == [("run.log", "logs/run.log"), ("w_gap_merged.csv", "gapfills/w_gap/merged.csv"), ("x.png", "analysis/x.png")]
    assert (tmp_path / "logs/run.log").read_text() == "run.log" and (tmp_path / "all_bibliography.csv").exists() and not (tmp_path / "x.png").exists()
    assert layout.apply_moves(spark, str(tmp_path)) == []


def test_layout_refuses_to_overwrite(spark, tmp_path):
    make(tmp_path, ["a.log", "b.log"])
    (tmp_path / "logs").mkdir()
    make(tmp_path / "logs", ["b.log"])
    with pytest.raises(ValueError, match="logs/b.log"):
        layout.apply_moves(spark, str(tmp_path))
    assert (tmp_path / "a.log").exists() and (tmp_path / "b.log").exists()


@pytest.mark.parametrize("after", [1, 2, 3])
def test_stopped_moves_are_finished(spark, tmp_path, monkeypatch, after):
    make(tmp_path, ["a.log", "b.png"])
    with monkeypatch.context() as m, pytest.raises(Stop):
        stopping(m, after)
        layout.apply_moves(spark, str(tmp_path))
    assert layout.apply_moves(spark, str(tmp_path)) == []
    assert (tmp_path / "logs/a.log").exists() and (tmp_path / "analysis/b.png").exists()
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(moves.JOURNAL)]


def test_an_empty_folder(spark, tmp_path):
    assert layout.apply_moves(spark, str(tmp_path)) == [] == layout.apply_moves(spark, f"{tmp_path}/none")


def test_checkpoints_are_cleared_once_all_rows_are_there(spark, tmp_path):
    path, asked = f"{tmp_path}/checkpoints", spark.range(4)
    assert not archive.clear_checkpoints(spark, path, asked)
    archive.append_checkpoint(asked.where("id < 3"), path, 1)
    assert not archive.clear_checkpoints(spark, path, asked) and spark.read.parquet(path).count() == 3
    archive.append_checkpoint(asked.where("id > 1"), path, 2)
    assert archive.clear_checkpoints(spark, path, asked) and not (tmp_path / "checkpoints").exists()
