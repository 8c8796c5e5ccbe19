"""Jobs that are stopped and started again, and folders that are deleted."""

import json
from pathlib import Path

import pytest

from loomset import load_text_corpus, run_prep_job
from loomset.plans import datasets, job
from loomset.sources import scratch, stage

ROWS = [{"text": f"text {i}"} for i in range(60)] + [{"text": 5}]


@pytest.fixture()
def corpus(tmp_path):
    path = tmp_path / "in" / "c.jsonl"
    path.parent.mkdir()
    path.write_text("\n".join(map(json.dumps, ROWS)))
    return str(path)


@pytest.fixture()
def staged(tmp_path, monkeypatch):
    made = []

    def new(spark):
        made.append(str(tmp_path / f"staged{len(made)}"))
        return made[-1]

    monkeypatch.setattr(datasets, "shared_dir", new)
    return made


def _job(path):
    return {"mode": "pretrain", "dataset": {"path": path, "val_split": 0.1}}


def _texts(df):
    return sorted(r.text for r in df.collect())


def _stop_at(monkeypatch, name):
    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(job, name, stop)


@pytest.mark.parametrize("at, n_staged", [("write_split_table", 1), ("_manifest", 1)])
def test_a_stopped_job_goes_on(spark, corpus, staged, tmp_path, monkeypatch, at, n_staged):
    whole = run_prep_job(spark, _job(corpus), str(tmp_path / "whole"))
    want = _texts(whole.train), _texts(whole.eval)
    staged.clear()
    out = str(tmp_path / "out")
    with monkeypatch.context() as patched:
        _stop_at(patched, at)
        with pytest.raises(RuntimeError, match="stopped"):
            run_prep_job(spark, _job(corpus), out)
    assert Path(staged[0], "_SUCCESS").exists() and Path(f"{out}.job.json").exists()
    data = run_prep_job(spark, _job(corpus), out)
    assert (_texts(data.train), _texts(data.eval)) == want
    # the rows staged by the first run were taken over, and nothing is left of either
    assert len(staged) == n_staged and not Path(staged[0]).exists() and not Path(f"{out}.job.json").exists()
    manifests = [json.loads(Path(p, job.MANIFEST).read_text()) for p in (out, str(tmp_path / "whole"))]
    assert [manifests[0]["splits"][k]["rows"] for k in ("eval", "quarantine", "train")] == [6, 1, 54]
    assert {k: (v["rows"], v["hash"]) for k, v in manifests[0]["splits"].items()} == {
        k: (v["rows"], v["hash"]) for k, v in manifests[1]["splits"].items()
    }
    with pytest.raises(FileExistsError):
        run_prep_job(spark, _job(corpus), out)


def test_halves_are_removed(spark, corpus, staged, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with monkeypatch.context() as patched:
        _stop_at(patched, "write_split_table")
        with pytest.raises(RuntimeError):
            run_prep_job(spark, _job(corpus), out)
    # the driver died in the middle of both writes
    Path(staged[0], "_SUCCESS").unlink()
    Path(out, "split=train").mkdir(parents=True)
    data = run_prep_job(spark, _job(corpus), out)
    assert data.train.count() == 54
    assert len(staged) == 2 and not any(Path(p).exists() for p in staged)


def test_another_input_starts_anew(spark, corpus, staged, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with monkeypatch.context() as patched:
        _stop_at(patched, "write_split_table")
        with pytest.raises(RuntimeError):
            run_prep_job(spark, _job(corpus), out)
    Path(corpus).write_text(json.dumps({"text": "new"}) + "\n" + json.dumps({"text": "newer"}))
    data = run_prep_job(spark, _job(corpus), out)
    assert data.train.count() == 1 and len(staged) == 2 and not any(Path(p).exists() for p in staged)


def test_output_of_others_is_never_touched(spark, corpus, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "mine.txt").write_text("x")
    with pytest.raises(FileExistsError):
        run_prep_job(spark, _job(corpus), str(tmp_path / "out"))
    assert (tmp_path / "out" / "mine.txt").read_text() == "x"


def test_loaded_data_is_closed(spark, corpus, staged):
    with load_text_corpus(spark, corpus, val_split=0.1) as data:
        assert data.train.count() == 54 and Path(staged[0]).exists()
        train, held_out, refused = data
        assert held_out.count() == 6 and refused.count() == 1
    assert not Path(staged[0]).exists()
    load_text_corpus(spark, corpus).close()


def test_scratch_owns_what_is_staged_in_it(spark):
    with scratch(spark) as owned:
        inner = stage(spark.range(3))
        with scratch(spark) as more:
            stage(spark.range(4))
            kept = more.pop()
        assert inner.count() == 3 and len(owned) == 1
    assert not Path(owned[0]).exists() and Path(kept).exists()
