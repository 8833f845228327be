"""Sinks: quoted CSV, N-Triples and Turtle, reports, class diagrams and logs."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str) -> None:
    """A folder of quoted CSV parts; missing cells are empty."""
    df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns)).write.option("header", True).option("quoteAll", True).option("escape", '"').option("emptyValue", "").csv(path)


def csv_file(df: DataFrame, path: str, bom: bool = False) -> int:
    """One quoted CSV file, written row by row as partitions arrive; the number of rows."""
    quoted = lambda x: '"' + ("" if x is None else str(x)).replace('"', '""') + '"'
    n = 0
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        f.write(",".join(map(quoted, df.columns)) + "\n")
        for row in df.toLocalIterator():
            f.write(",".join(map(quoted, row)) + "\n")
            n += 1
    return n


def escaped(c: Column) -> Column:
    for a, b in (("\\\\", "\\\\\\\\"), ('"', '\\\\"'), ("\n", "\\\\n"), ("\r", "\\\\r"), ("\t", "\\\\t")):
        c = F.regexp_replace(c, a, b)
    return c


def ntriples_lines(triples: DataFrame) -> DataFrame:
    ref = lambda c, kind: F.when(kind == "bnode", c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))
    text = F.concat(F.lit('"'), escaped(F.col("o")), F.lit('"'), F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang"))).when(F.col("o_dt").isNotNull(), F.concat(F.lit("^^<"), F.col("o_dt"), F.lit(">"))).otherwise(""))
    subject = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(F.concat(F.lit("<"), F.col("s"), F.lit(">")))
    return triples.select(F.concat_ws(" ", subject, F.concat(F.lit("<"), F.col("p"), F.lit(">")), F.when(F.col("o_kind") == "lit", text).otherwise(ref(F.col("o"), F.col("o_kind"))), F.lit(".")).alias("value"))


def ntriples(triples: DataFrame, path: str) -> None:
    ntriples_lines(triples).write.text(path)


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share; a local session without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(base or tempfile.mkdtemp(prefix='orrery-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Local names that are written behind a prefix; other IRIs stay whole.
_LOCAL = r"[A-Za-z0-9_][A-Za-z0-9_-]*"


def _short(term: Column, prefixes: dict[str, str]) -> Column:
    """An IRI in angle brackets by the first prefix that fits."""
    out = term
    for name, ns in reversed(prefixes.items()):
        local = F.substr(term, F.lit(len(ns) + 2), F.length(term) - len(ns) - 2)
        out = F.when(term.startswith(f"<{ns}") & local.rlike(f"^{_LOCAL}$"), F.concat(F.lit(f"{name}:"), local)).otherwise(out)
    return out


def turtle(triples: DataFrame, path: str, prefixes: dict[str, str] | None = None) -> None:
    """A folder of Turtle parts, each a document of its own: its prefixes, then a stanza a subject with its facts in order.

    Parts are written by Spark's text sink side by side, and by its committer appear together or not at all. A blank node
    means something in one file only, so graphs with blank nodes go to `turtle_file` or N-Triples.
    """
    prefixes = prefixes or {}
    line = F.split("value", " ", 3)
    text = F.regexp_replace(line[2], r" \.$", "")
    if prefixes:
        typed = F.regexp_extract(text, r"(?s)^(\".*\"\^\^)(<[^>]*>)$", 1)
        text = F.when(text.startswith("<"), _short(text, prefixes)).when(typed != "", F.concat(typed, _short(F.regexp_extract(text, r"(?s)^(\".*\"\^\^)(<[^>]*>)$", 2), prefixes))).otherwise(text)
    facts = ntriples_lines(triples).select(_short(line[0], prefixes).alias("s"), F.concat(_short(line[1], prefixes), F.lit(" "), text).alias("fact"))
    stanzas = facts.groupBy("s").agg(F.array_join(F.array_sort(F.collect_set("fact")), " ;\n    ").alias("facts")).select(F.concat("s", F.lit(" "), "facts", F.lit(" .\n")).alias("value"))
    head = "".join(f"@prefix {name}: <{ns}> .\n" for name, ns in prefixes.items())

    def headed(batches):
        import pyarrow as pa

        first = True
        for batch in batches:
            if batch.num_rows:
                if first and head:
                    yield pa.RecordBatch.from_pydict({"value": [head]})
                first = False
                yield batch

    (stanzas.mapInArrow(headed, "value string") if head else stanzas).write.text(path)


def turtle_file(triples: DataFrame, path: str, prefixes: dict[str, str] | None = None) -> None:
    """One Turtle file of stanzas by subject, streamed in order; for graphs that people read."""
    prefixes = prefixes or {}

    def short(t: str) -> str:
        for name, ns in prefixes.items():
            if t.startswith(f"<{ns}") and re.fullmatch(r"[\w-]+", t[len(ns) + 1 : -1]):
                return f"{name}:{t[len(ns) + 1:-1]}"
        return t

    lines = ntriples_lines(triples).orderBy("value")
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(f"@prefix {k}: <{v}> .\n" for k, v in prefixes.items())
        last = None
        for (line,) in lines.toLocalIterator():
            s, p, o = line[:-2].split(" ", 2)
            if o.startswith("<"):
                o = short(o)
            elif (m := re.fullmatch(r'(".*"\^\^)(<[^>]*>)', o, re.S)):
                o = m[1] + short(m[2])
            f.write(f" ;\n    {short(p)} {o}" if s == last else (" .\n" if last else "") + f"\n{short(s)} {short(p)} {o}")
            last = s
        f.write(" .\n" if last else "")


def stanza(subject: str, pairs: list[tuple[str, str]]) -> str:
    """A hand-made stanza; predicates may repeat."""
    return f"{subject}\n" + " ;\n".join(f"    {p} {o}" for p, o in pairs) + " .\n"


def turtle_text(s: str) -> str:
    return '"' + s.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n") + '"'


def markdown(df: DataFrame) -> str:
    """A small result as a Markdown table."""
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|")
    rows = [df.columns, ["---"] * len(df.columns), *df.collect()]
    return "\n".join("| " + " | ".join(map(cell, r)) + " |" for r in rows) + "\n"


def report(title: str, sections: list[tuple[str, bool, DataFrame]], path: str | None = None) -> tuple[str, bool]:
    """(text, passed): a validation report, its summary before its sections."""
    ok = all(passed for _, passed, _ in sections)
    text = f"# {title}\n\n" + "".join(f"- {name}: {'PASS' if passed else 'FAIL'}\n" for name, passed, _ in sections) + f"\nOverall: {'PASS' if ok else 'FAIL'}\n"
    text += "".join(f"\n## {name}\n\n{markdown(df)}" for name, _, df in sections)
    if path:
        Path(path).write_text(text, encoding="utf-8")
    return text, ok


def class_diagram(classes: DataFrame, edges: DataFrame, properties: DataFrame) -> str:
    """A Mermaid class diagram: classes with a stereotype (class, stereotype), (child, parent) edges, (domain, property, range) links."""
    name = lambda c: F.regexp_replace(F.regexp_replace(F.col(c), ".*[#/]", ""), r"[^\w]", "_")
    own = classes.select(F.concat(F.lit("    class "), name("class"), F.coalesce(F.concat(F.lit(" { <<"), F.col("stereotype"), F.lit(">> }")), F.lit(""))).alias("line"), F.lit(1).alias("k"))
    up = edges.select(F.concat(F.lit("    "), name("parent"), F.lit(" <|-- "), name("child")).alias("line"), F.lit(2).alias("k"))
    link = properties.select(F.concat(F.lit("    "), name("domain"), F.lit(" --> "), name("range"), F.lit(" : "), F.replace(F.regexp_replace("property", ".*[#/]", ""), F.lit(":"), F.lit("--"))).alias("line"), F.lit(3).alias("k"))
    lines = own.unionByName(up).unionByName(link).distinct().orderBy("k", "line").select("line").collect()
    return "classDiagram\n" + "\n".join(r[0] for r in lines) + "\n"


def logger(name: str, path: str | None = None) -> logging.Logger:
    """A logger to the console and, anew for each run, to a file."""
    log = logging.getLogger(name)
    log.setLevel(logging.INFO)
    log.handlers.clear()
    for h in [logging.StreamHandler(), *([logging.FileHandler(path, "w", "utf-8")] if path else [])]:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(h)
    return log


def duration(seconds: float) -> str:
    return f"{seconds:.1f}s" if seconds < 60 else f"{int(seconds // 60)}m {seconds % 60:.1f}s"
