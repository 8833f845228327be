"""Runs: stages with preflight, provenance of a run as triples, and strict endings."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators.graph import root
from orrery.operators.tables import filled_counts
from orrery.operators.triples import PROV, RDF, RDFS, SCHEMA, XSD, Names
from orrery.sources.read import file_info, file_uri
from orrery.sources.write import duration

#: Stages of each enrichment mode, in order; merge follows both others.
MODES = {"full": ("literature", "geo", "merge"), "literature": ("literature", "merge"), "geo": ("geo", "merge"), "merge": ("merge",)}
ALL = MODES["full"]


@dataclass
class Stage:
    name: str
    run: Callable[[], object]
    inputs: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()
    parameters: dict = field(default_factory=dict)


class Result(NamedTuple):
    status: str
    seconds: float
    error: Exception | None = None


log = logging.getLogger(__name__)


def preflight(stages: list[Stage], mode: str) -> list[str]:
    """What is missing before any work: inputs of active stages that no active stage makes, outputs of those skipped."""
    active = [s for s in stages if s.name in MODES[mode]]
    made = {o for s in active for o in s.outputs}
    needed = [i for s in active for i in s.inputs if i not in made] + [o for s in stages if s.name not in MODES[mode] for o in s.outputs]
    return [p for p in dict.fromkeys(needed) if not file_info(p)[0]]


def execute(stages: list[Stage], mode: str = "full") -> dict[str, Result]:
    """Stage -> Result (ok, skipped or failed); a failure, whose exception is kept and logged, ends the run, a failed preflight raises before it."""
    if lost := preflight(stages, mode):
        raise FileNotFoundError(", ".join(lost))
    out: dict[str, Result] = {}
    for s in stages:
        if s.name not in MODES[mode]:
            out[s.name] = Result("skipped", 0.0)
            continue
        began = time.monotonic()
        try:
            s.run()
        except Exception as error:  # noqa: BLE001  a stage's failure is a result
            log.exception("stage %s failed", s.name)
            out[s.name] = Result("failed", time.monotonic() - began, error)
            break
        out[s.name] = Result("ok", time.monotonic() - began)
    return out


def summary(results: dict[str, Result]) -> str:
    said = lambda r: f"{'FAIL' if r.status in ('failed', 'not reached') else 'PASS'} ({r.status}, {duration(r.seconds)})" + (f": {r.error!r}" if r.error else "")
    return "\n".join(f"{n}: {said(r)}" for n, r in results.items())


def ending(passed: bool, strict: bool) -> int:
    """The exit code: findings only count in strict mode."""
    return int(strict and not passed)


def upstream(prov: DataFrame, file_name: str) -> tuple[str | None, str | None]:
    """(root activity, entity of a file) of an earlier run's provenance; None where there is none."""
    activities = prov.where((F.col("p") == f"{RDF}type") & (F.col("o") == f"{PROV}Activity")).select(F.col("s").alias("activity"))
    started = prov.where(F.col("p") == f"{PROV}startedAtTime").groupBy("s").agg(F.min("o").alias("started")).withColumnRenamed("s", "activity")
    top = root(activities.join(started, "activity", "left"), prov.where(F.col("p") == f"{PROV}wasInformedBy")).first()
    entity = prov.where((F.col("p") == f"{PROV}atLocation") | (F.col("p") == f"{RDFS}label")).where(F.col("o").endswith(f"/{file_name}")).agg(F.min("s")).first()[0]
    return (top["activity"] if top else None), entity


@dataclass
class Output:
    """What a run makes: the end of its IRI, a label, a path."""

    name: str
    label: str
    path: str


def provenance(spark: SparkSession, names: Names, started: datetime, ended: datetime, source: str, outputs: list[Output], rows: int, triples: int, earlier: tuple[str | None, str | None] = (None, None), git: dict | None = None, script: str = "pipeline.py", ontology: str | None = None, persons: list[str] | None = None) -> DataFrame:
    """The run as triples: activity, script as agent and plan, persons, inputs, outputs and what they derive from; counts are those before these triples.

    `earlier`: root activity and output entity of the run that made the source, which is then used beside its file.
    """
    stamp = lambda t: t.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    when = stamp(started).replace(":", "-")
    run, agent = f"{names.data}pipeline_run_{when}", f"{names.data}{Path(script).name.replace('.', '_')}"
    ref = lambda s, p, o: (s, p, o, "iri", None, None)
    val = lambda s, p, o, dt=None, lang=None: (s, p, o, "lit", dt and f"{XSD}{dt}", lang)
    facts = [
        ref(agent, f"{RDF}type", f"{PROV}SoftwareAgent"),
        ref(agent, f"{RDF}type", f"{PROV}Plan"),
        val(agent, f"{RDFS}label", Path(script).name),
        ref(agent, f"{PROV}atLocation", file_uri(script)),
        ref(run, f"{RDF}type", f"{PROV}Activity"),
        val(run, f"{RDFS}label", f"Pipeline run {when}", lang="en"),
        val(run, f"{PROV}startedAtTime", stamp(started), "dateTime"),
        val(run, f"{PROV}endedAtTime", stamp(ended), "dateTime"),
        *(ref(run, f"{PROV}wasAssociatedWith", x) for x in [*(persons or []), agent]),
        *(ref(run, f"{PROV}used", x) for x in (file_uri(source), ontology and file_uri(ontology), earlier[1]) if x),
        val(run, f"{names.data}rowCount", str(rows), "integer"),
        val(run, f"{names.data}dataTripleCount", str(triples), "integer"),
    ]
    if earlier[0]:
        facts.append(ref(run, f"{PROV}wasInformedBy", earlier[0]))
    for o in outputs:
        node = f"{names.data}{o.name}"
        facts += [ref(node, f"{RDF}type", f"{PROV}Entity"), val(node, f"{RDFS}label", o.label, lang="en"), ref(node, f"{PROV}atLocation", file_uri(o.path)), ref(node, f"{PROV}wasGeneratedBy", run), ref(node, f"{PROV}wasDerivedFrom", earlier[1] or file_uri(source))]
    if git and git.get("commit"):
        state = f"{names.data}git_{git['commit']}"
        facts += [ref(state, f"{RDF}type", f"{PROV}Entity"), ref(run, f"{PROV}used", state)]
        if git.get("dirty") is not None:
            facts.append(val(state, f"{names.term}dirty", str(git["dirty"]).lower(), "boolean"))
    return spark.createDataFrame(facts, SCHEMA)


def manifest(spark: SparkSession, names: Names, stages: list[Stage], results: dict[str, Result], started: datetime, ended: datetime, scripts: dict[str, str], tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """The provenance of a run of stages: an activity for the run and one for each stage that it informed.

    `tables`: the table in each file of which rows and filled cells are to be stated, counted in one pass over each.

    A stage that ran used its inputs and generated its outputs, which derive from them; a skipped one used the outputs
    that are there from an earlier run. `scripts`: the path of each stage's program.
    """
    stamp = lambda t: t.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    when = stamp(started).replace(":", "-")
    run = f"{names.data}enrichment_run_{when}"
    ref = lambda s, p, o: (s, p, o, "iri", None, None)
    val = lambda s, p, o, dt=None, lang=None: (s, p, o, "lit", dt and f"{XSD}{dt}", lang)
    entity = lambda path: f"{names.data}{Path(path).name.replace('.', '_')}"
    facts = [ref(run, f"{RDF}type", f"{PROV}Activity"), val(run, f"{RDFS}label", f"Enrichment run {when}", lang="en"), val(run, f"{PROV}startedAtTime", stamp(started), "dateTime"), val(run, f"{PROV}endedAtTime", stamp(ended), "dateTime")]
    made = {o for s in stages for o in s.outputs}
    for stage in stages:
        status = results.get(stage.name, Result("not reached", 0.0)).status
        node, agent = f"{run}_{stage.name}", entity(scripts[stage.name])
        note = "" if status == "ok" else f" ({status})"
        facts += [ref(node, f"{RDF}type", f"{PROV}Activity"), val(node, f"{RDFS}label", f"Stage {stage.name}{note}", lang="en"), ref(node, f"{PROV}wasInformedBy", run), ref(node, f"{PROV}wasAssociatedWith", agent)]
        facts += [ref(agent, f"{RDF}type", f"{PROV}SoftwareAgent"), ref(agent, f"{RDF}type", f"{PROV}Plan"), val(agent, f"{RDFS}label", Path(scripts[stage.name]).name), ref(agent, f"{PROV}atLocation", file_uri(scripts[stage.name]))]
        facts += [ref(node, f"{PROV}used", entity(i)) for i in (stage.outputs if status == "skipped" else stage.inputs)]
        facts += [ref(run, f"{PROV}used", entity(i)) for i in stage.inputs if i not in made]
        for x in (*stage.inputs, *stage.outputs):
            facts += [ref(entity(x), f"{RDF}type", f"{PROV}Entity"), val(entity(x), f"{RDFS}label", Path(x).name), ref(entity(x), f"{PROV}atLocation", file_uri(x))]
        if status == "ok":
            facts += [x for o in stage.outputs for x in (ref(entity(o), f"{PROV}wasGeneratedBy", node), *(ref(entity(o), f"{PROV}wasDerivedFrom", entity(i)) for i in stage.inputs))]
    out = spark.createDataFrame([*dict.fromkeys(facts)], SCHEMA)
    for path, table in (tables or {}).items():
        node = F.lit(entity(path))
        counts = filled_counts(table).select(F.inline(F.array(F.struct(F.concat(F.lit(f"{names.data}filled_"), "column").alias("p"), F.col("filled").alias("n")), F.struct(F.lit(f"{names.data}rowCount").alias("p"), F.col("total").alias("n")))))
        out = out.unionByName(counts.distinct().select(node.alias("s"), "p", F.col("n").cast("string").alias("o"), F.lit("lit").alias("o_kind"), F.lit(f"{XSD}integer").alias("o_dt"), F.lit(None).cast("string").alias("o_lang")))
    return out


def extract(graph: DataFrame, subjects: list[str]) -> DataFrame:
    """The triples of a few subjects."""
    return graph.where(F.col("s").isin(*subjects))
