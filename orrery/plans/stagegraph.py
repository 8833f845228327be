"""Stages as a graph of the files that they read and make: what is up to date is reused, independent stages run side by side.

A stage depends on the stages that make its inputs. Its fingerprint is of its name, its parameters and every file of its inputs (path,
size, time of change). A stage whose fingerprint and outputs are those of its last good run is reused. So a second run does
nothing, and a changed input runs again only what depends on it. Fingerprints are kept in one JSON file, replaced as a whole after each
stage, so that a run that ends early keeps what it has done. Files are listed through Hadoop's file systems if a session is given, so that
they may lie in any store that Spark reads, else locally; the state file is local to the driver.

A failed stage's exception is kept and logged; what depends on it is not reached, all else still runs. Each stage runs in a thread and a
FAIR pool of its own name. A cycle, or two stages that make one file, is an error before any work.
"""

from __future__ import annotations

import json
import logging
import os
import time
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from hashlib import sha256
from pathlib import Path

from pyspark.sql import SparkSession

from orrery.plans.runs import Result, Stage

log = logging.getLogger(__name__)


def files(path: str, spark: SparkSession | None = None) -> list[tuple[str, int, int]]:
    """(path, size, time of change) of a file, or of all files below a folder, in order; empty if there is none."""
    if spark is not None:
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found, each = [], fs.listFiles(root, True)
        while each.hasNext():
            f = each.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return sorted(found)
    top = Path(path)
    every = [top] if top.is_file() else [p for p in top.rglob("*") if p.is_file()]
    return sorted((str(p), p.stat().st_size, p.stat().st_mtime_ns) for p in every)


def fingerprint(stage: Stage, spark: SparkSession | None = None) -> str:
    said = [stage.name, stage.parameters, [files(p, spark) for p in stage.inputs]]
    return sha256(json.dumps(said, sort_keys=True, default=repr).encode()).hexdigest()


def dependencies(stages: list[Stage]) -> dict[str, set[str]]:
    """Stage -> the stages that make its inputs. A path that lies in a folder that a stage makes counts as made by it."""
    makers: dict[str, str] = {}
    for s in stages:
        for o in s.outputs:
            if o in makers:
                raise ValueError(f"{makers[o]} and {s.name} both make {o}")
            makers[o] = s.name
    within = lambda path, folder: path == folder or path.startswith(folder.rstrip("/") + "/")
    needs = {s.name: {m for i in s.inputs for o, m in makers.items() if within(i, o)} for s in stages}
    left = dict(needs)
    while left:
        ready = [n for n, of in left.items() if not of & left.keys()]
        if not ready:
            raise ValueError(f"stages depend on each other: {', '.join(sorted(left))}")
        for n in ready:
            del left[n]
    return needs


def run_graph(stages: list[Stage], state: str, spark: SparkSession | None = None, workers: int = 4) -> dict[str, Result]:
    """Stage -> Result: 'ok', 'reused', 'failed' (with its exception) or 'not reached', in the order of `stages`."""
    needs, by_name = dependencies(stages), {s.name: s for s in stages}
    kept: dict[str, dict] = json.loads(Path(state).read_text()) if Path(state).exists() else {}
    made = lambda s: [files(o, spark) for o in s.outputs]
    plain = lambda x: json.loads(json.dumps(x))

    def work(stage: Stage) -> tuple[Result, dict | None]:
        if spark is not None:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", stage.name)
        began, own = time.monotonic(), fingerprint(stage, spark)
        before = kept.get(stage.name)
        if before and before["inputs"] == own and before["outputs"] == plain(made(stage)) and all(before["outputs"]):
            return Result("reused", time.monotonic() - began), None
        try:
            stage.run()
            if lost := [o for o, f in zip(stage.outputs, made(stage)) if not f]:
                raise FileNotFoundError(f"{stage.name} did not make {', '.join(lost)}")
        except Exception as error:  # noqa: BLE001  a stage's failure is a result
            log.exception("stage %s failed", stage.name)
            return Result("failed", time.monotonic() - began, error), None
        return Result("ok", time.monotonic() - began), {"inputs": own, "outputs": plain(made(stage))}

    results: dict[str, Result] = {}
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(workers) as pool:
        while True:
            for name, of in needs.items():
                if name in results or name in running.values() or not of <= results.keys():
                    continue
                if any(results[n].status in ("failed", "not reached") for n in of):
                    results[name] = Result("not reached", 0.0)
                else:
                    running[pool.submit(work, by_name[name])] = name
            if not running:
                # stages may have been given up after their dependants were looked at
                if len(results) == len(needs):
                    break
                continue
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                results[name], new = done.result()
                if new:
                    kept[name] = new
                    part = Path(f"{state}.part")
                    part.write_text(json.dumps(kept))
                    os.replace(part, state)
    return {s.name: results[s.name] for s in stages}
