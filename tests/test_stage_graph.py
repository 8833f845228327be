"""Stages that are reused, run side by side, and fail."""

import os
import threading

import pytest

from orrery.plans.runs import Stage, summary
from orrery.plans.stagegraph import dependencies, run_graph


def graph(folder, done, broken=()):
    def stage(name, inputs, outputs, **parameters):
        def run():
            if name in broken:
                raise RuntimeError(f"{name} broke")
            done.append(name)
            text = "+".join(open(f"{folder}/{i}").read() for i in inputs) + name + str(parameters or "")
            for o in outputs:
                with open(f"{folder}/{o}", "w") as f:
                    f.write(text)

        return Stage(name, run, tuple(f"{folder}/{i}" for i in inputs), tuple(f"{folder}/{o}" for o in outputs), parameters)

    return [stage("merge", ["lit", "geo"], ["out"]), stage("literature", ["sites"], ["lit"]), stage("geo", ["sites", "places"], ["geo"], threshold=0.8), stage("report", ["out"], ["md"])]


@pytest.mark.parametrize("local", [True, False])
def test_reuse(spark, tmp_path, local):
    for n in ("sites", "places"):
        (tmp_path / n).write_text(n)
    state, session = str(tmp_path / "state.json"), None if local else spark
    run = lambda broken=(): (done := [], {n: r.status for n, r in run_graph(graph(tmp_path, done, broken), state, session).items()})
    done, got = run()
    assert set(got.values()) == {"ok"} and set(done[:2]) == {"literature", "geo"} and done[2:] == ["merge", "report"] and list(got) == ["merge", "literature", "geo", "report"]
    assert run() == ([], dict.fromkeys(got, "reused"))
    os.utime(tmp_path / "places", (1, 1))
    assert run() == (["geo", "merge", "report"], got | {"literature": "reused"})
    (tmp_path / "lit").unlink()
    assert run() == (["literature", "merge", "report"], got | {"geo": "reused"})
    os.utime(tmp_path / "sites", (2, 2))
    done, got = run(("geo",))
    assert done == ["literature"] and got == {"merge": "not reached", "literature": "ok", "geo": "failed", "report": "not reached"}
    done, got = run()
    assert done == ["geo", "merge", "report"] and got["literature"] == "reused"
    stages = graph(tmp_path, done := [])
    stages[2].parameters["threshold"] = 0.9
    run_graph(stages, state, session)
    assert done == ["geo", "merge", "report"]


def test_side_by_side(tmp_path):
    met = threading.Barrier(2, timeout=20)
    results = run_graph([Stage("a", met.wait), Stage("b", met.wait)], str(tmp_path / "s.json"))
    assert {r.status for r in results.values()} == {"ok"}


def test_errors(tmp_path):
    with pytest.raises(ValueError, match="depend on each other"):
        dependencies([Stage("a", print, ("x",), ("y",)), Stage("b", print, ("y/part",), ("x",))])
    with pytest.raises(ValueError, match="both make"):
        dependencies([Stage("a", print, (), ("y",)), Stage("b", print, (), ("y",))])
    got = run_graph([Stage("a", lambda: 1 / 0, (), ("y",)), Stage("b", print, (), (str(tmp_path / "never"),))], str(tmp_path / "s.json"))
    assert isinstance(got["a"].error, ZeroDivisionError) and isinstance(got["b"].error, FileNotFoundError)
    assert "FAIL (failed" in summary(got) and "ZeroDivisionError" in summary(got)
