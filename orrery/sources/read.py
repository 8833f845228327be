"""Sources: CSV dialects, graphs as text, documentation tables, label tables, files and repositories as metadata."""

from __future__ import annotations

import re
import subprocess
import time
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.text import na_to_null
from orrery.operators.graph import stored
from orrery.operators.triples import COLUMNS, SCHEMA, XSD


def csv(spark: SparkSession, path: str, sep: str = ",", na: bool = True, required: tuple[str, ...] = (), line_breaks: bool = False) -> DataFrame:
    """A CSV table of text columns. Header names are stripped; `na`: missing-value tokens become null, else cells stay as they are ('' for empty ones).

    `line_breaks`: quoted cells may hold line breaks; a file is then one task, else large files are read in pieces.
    """
    df = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", line_breaks).csv(path)
    df = df.toDF(*(c.strip().lstrip("\ufeff") for c in df.columns))
    if lost := [c for c in required if c not in df.columns]:
        raise ValueError(f"columns missing in {path}: {', '.join(lost)}")
    one = na_to_null if na else (lambda c: F.coalesce(c, F.lit("")))
    return df.select(*(one(F.col(f"`{c}`")).alias(c) for c in df.columns))


def limited(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first n rows in order; all of them without n."""
    return df if n is None else df.orderBy(*order).limit(n)


_TERM = r"(?:<([^>]*)>|(_:[^\s]+))"
_NT = rf"^\s*{_TERM}\s+<([^>]*)>\s+(?:{_TERM}|\"((?:[^\"\\]|\\.)*)\"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?)\s*\.\s*(?:#.*)?$"


def unescaped(c: Column) -> Column:
    """Text with its backslash escapes undone, each once: what stands between pairs of backslashes holds no other backslash than those that begin an escape."""
    hexed = lambda x, n: F.decode(F.unhex(F.lpad(F.substring(x, 1, n), 8, "0")), "UTF-32")
    simple = (("\\t", "\t"), ("\\b", "\b"), ("\\n", "\n"), ("\\r", "\r"), ("\\f", "\f"), ('\\"', '"'), ("\\'", "'"))

    def coded(x: Column, mark: str, n: int) -> Column:
        parts = F.split(x, re.escape(mark))
        rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda y: F.concat(hexed(y, n), F.substr(y, F.lit(n + 1))))
        return F.concat(parts[0], F.array_join(rest, ""))

    def one(x: Column) -> Column:
        for a, b in simple:
            x = F.replace(x, F.lit(a), F.lit(b))
        # a code may stand for a backslash, so neither result is looked at again
        long = F.split(x, re.escape("\\U"))
        rest = F.transform(F.slice(long, 2, F.greatest(F.size(long) - 1, F.lit(0))), lambda y: F.concat(hexed(y, 8), coded(F.substr(y, F.lit(9)), "\\u", 4)))
        return F.concat(coded(long[0], "\\u", 4), F.array_join(rest, ""))

    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(F.split(c, r"\\\\"), one), "\\")).otherwise(c)


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """N-Triples lines as triples, read in parallel. A line that is neither a triple nor blank nor a comment is an error.

    The files of a folder are one document: a blank node's label means one node in all of them.
    """
    part = lambda i: F.nullif(F.regexp_extract("value", _NT, i), F.lit(""))
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#.*)?$"))
    subject = F.when(F.col("value").rlike(_NT), F.coalesce(unescaped(part(1)), part(2))).otherwise(F.raise_error(F.concat(F.lit("not a triple: "), F.col("value"))))
    ref = F.coalesce(unescaped(part(4)), part(5))
    kind = F.when(part(5).isNotNull(), "bnode").when(part(4).isNotNull(), "iri").otherwise("lit")
    return lines.select(subject.alias("s"), unescaped(part(3)).alias("p"), F.coalesce(ref, unescaped(F.regexp_extract("value", _NT, 6))).alias("o"), kind.alias("o_kind"), unescaped(part(8)).alias("o_dt"), part(7).alias("o_lang"))


_TOKEN = re.compile(r'\s+|#[^\n]*|(?P<iri><[^>]*>)|(?P<long>"""(?:[^\\]|\\.)*?"""|\'\'\'(?:[^\\]|\\.)*?\'\'\')|(?P<str>"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\')|(?P<at>@[A-Za-z][\w-]*)|(?P<dt>\^\^)|(?P<num>[-+]?(?:(?:\d+\.\d*|\.?\d+)[eE][-+]?\d+|\d*\.\d+|\d+)(?![\w:]))|(?P<name>_:[\w.-]*[\w-]|[\w-]*:(?:[\w%-]|\.(?=[\w%-])|\\.)*|\ba\b|true\b|false\b|PREFIX\b|BASE\b)|(?P<p>[.;,()\[\]])', re.S)
_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", '"': '"', "'": "'", "\\": "\\"}


def parse_turtle(text: str, document: str = "", known: dict[str, str] | None = None, own: str = "") -> list[tuple]:
    """Triples of a Turtle document: base and prefixes, predicate and object lists, literals, blank nodes and collections.

    Blank nodes are those of the document: `document` goes into their labels, and `own` into those of nodes without a label. What is no token
    is an error. `known` has prefixes that hold from the start, and gets those that the text declares; the text is then a piece
    of a document, and a full stop without a statement, as behind a comment, says nothing.
    """
    tokens, seen, quoted = [], 0, -1
    for m in _TOKEN.finditer(text):
        if m.start() != seen:
            break
        if m.lastgroup in ("str", "long"):
            if quoted == seen:
                break  # two strings without a space: quotation marks of a longer string
            quoted = m.end()
        seen = m.end()
        if m.lastgroup:
            tokens.append((m.lastgroup, m[0]))
    if seen != len(text):
        raise ValueError(f"not Turtle at {seen}: {text[seen:seen + 40]!r}")
    prefixes: dict[str, str] = {} if known is None else known
    base = ""
    out: list[tuple] = []
    at = blank = 0
    rdf = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"

    def fresh() -> tuple:
        nonlocal blank
        blank += 1
        return f"_:{document}{own}n{blank}", "bnode", None, None

    def unescape(s: str) -> str:
        return re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _ESCAPES.get(m[1], m[1]), s)

    def named(t: str) -> str:
        head, _, tail = t.partition(":")
        return f"_:{document}b{tail}" if head == "_" else prefixes[head] + tail.replace("\\", "")

    def resolved(t: str) -> str:
        t = unescape(t)
        # joining drops an empty fragment, with which namespaces end
        return urljoin(base, t) + "#" * (t.endswith("#") and not urljoin(base, t).endswith("#")) if base else t

    def term() -> tuple:
        nonlocal at
        kind, t = tokens[at]
        at += 1
        if kind == "iri":
            return resolved(t[1:-1]), "iri", None, None
        if kind in ("str", "long"):
            body = unescape(t[3:-3] if kind == "long" else t[1:-1])
            if at < len(tokens) and tokens[at][0] == "at":
                at += 1
                return body, "lit", None, tokens[at - 1][1][1:]
            if at < len(tokens) and tokens[at][0] == "dt":
                at += 1
                return body, "lit", term()[0], None
            return body, "lit", None, None
        if kind == "num":
            return t, "lit", XSD + ("double" if "e" in t.lower() else "decimal" if "." in t else "integer"), None
        if t in ("true", "false"):
            return t, "lit", f"{XSD}boolean", None
        if t == "a":
            return f"{rdf}type", "iri", None, None
        if t == "[":
            node = fresh()
            if tokens[at][1] != "]":
                facts(node)
            at += 1
            return node
        if t == "(":
            items = []
            while tokens[at][1] != ")":
                items.append(term())
            at += 1
            rest: tuple = (f"{rdf}nil", "iri", None, None)
            for item in reversed(items):
                node = fresh()
                out.append((node[0], f"{rdf}first", *item))
                out.append((node[0], f"{rdf}rest", *rest))
                rest = node
            return rest
        return named(t), "bnode" if t.startswith("_:") else "iri", None, None

    def facts(subject: tuple) -> None:
        nonlocal at
        while tokens[at][1] not in (".", "]"):
            predicate = term()[0]
            while True:
                out.append((subject[0], predicate, *term()))
                if tokens[at][1] != ",":
                    break
                at += 1
            while tokens[at][1] == ";":
                at += 1

    while at < len(tokens):
        kind, t = tokens[at]
        if t.lower() in ("@prefix", "prefix"):
            prefixes[tokens[at + 1][1].rstrip(":")] = resolved(tokens[at + 2][1][1:-1])
            at += 4 if t[0] == "@" else 3
        elif t.lower() in ("@base", "base"):
            base = resolved(tokens[at + 1][1][1:-1])
            at += 3 if t[0] == "@" else 2
        elif t == "." and known is not None:
            at += 1
        else:
            facts(term())
            at += 1
    return out


class _Any(dict):
    """Prefixes of which any may be used."""

    def __missing__(self, name: str) -> str:
        return ""


#: Where Turtle is cut: a full stop at the end of a line.
_STOP = ".\n"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(document, piece, value): Turtle text cut at each full stop that ends a line, wherever that is; large files are read by many tasks."""
    lines = spark.read.option("lineSep", _STOP).text(path).withColumn("document", _document())
    return lines.select("document", F.concat(F.lit("p"), F.monotonically_increasing_id().cast("string")).alias("piece"), "value").where(F.col("value").rlike(r"\S"))


def _document() -> Column:
    return F.concat(F.lit("f"), F.substring(F.md5(F.col("_metadata.file_path").cast("binary")), 1, 16))


def _statements(text: str) -> str:
    """A piece with its full stop again, also behind a comment."""
    return f"{text}\n."


def turtle_heads(spark: SparkSession, path: str) -> DataFrame:
    """(document, whole, prefixes) of files with prefixes, or with pieces that are no statements of their own.

    A cut within a string or a comment leaves a piece that isn't whole. A file with one, with a base, or with two IRIs for one
    prefix is to be read in one go: `whole` is false.
    """

    def run(batches):
        import pandas as pd

        for b in batches:
            out = []
            for document, value in zip(b["document"], b["value"]):
                said = _Any()
                try:
                    parse_turtle(_statements(value), known=said)
                    whole = not re.search(r"(?i)@base\b|\bBASE\s*<", value)
                except (ValueError, IndexError):
                    whole = False
                if said or not whole:
                    out.append((document, whole, dict(said)))
            yield pd.DataFrame(out, columns=["document", "whole", "prefixes"])

    found = _pieces(spark, path).select("document", "value").mapInPandas(run, "document string, whole boolean, prefixes map<string, string>")
    named = found.select("document", "whole", F.explode_outer("prefixes").alias("name", "iri")).groupBy("document", "name").agg(F.min("whole").alias("whole"), F.min("iri").alias("iri"), F.count_distinct("iri").alias("n"))
    every = F.map_from_entries(F.filter(F.collect_list(F.struct("name", "iri")), lambda e: e["name"].isNotNull()))
    return named.groupBy("document").agg((F.min("whole") & (F.max("n") <= 1)).alias("whole"), every.alias("prefixes"))


def turtle(spark: SparkSession, path: str) -> DataFrame:
    """Turtle files as triples, read by statements: a first pass collects each file's prefixes, a second parses its pieces wherever they lie.

    Files whose statements can't be told apart by full stops at line ends (strings that hold one, a base, prefixes that
    change) are parsed one to a task. Blank nodes of different files are different, so their labels hold a hash of the
    file's path. What isn't Turtle is an error. The heads, a row a file at most, are stored, as both ways read them.
    """
    kinds = [c.split()[0] for c in SCHEMA.split(", ")]
    heads = stored(turtle_heads(spark, path))

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for document, piece, value, prefixes in zip(b["document"], b["piece"], b["value"], b["prefixes"]):
                rows += parse_turtle(_statements(value), document, dict(prefixes or {}), piece)
            yield pd.DataFrame(rows, columns=kinds)

    def run_whole(batches):
        import pandas as pd

        for b in batches:
            for t, name in zip(b["value"], b["document"]):
                yield pd.DataFrame(parse_turtle(t, name), columns=kinds)

    split = _pieces(spark, path).join(heads, "document", "left").where("coalesce(whole, true)")
    files = spark.read.text(path, wholetext=True).select("value", _document().alias("document")).join(heads.where("not whole"), "document", "left_semi")
    found = split.select("document", "piece", "value", "prefixes").mapInPandas(run, SCHEMA).unionByName(files.select("document", "value").mapInPandas(run_whole, SCHEMA))
    return found.select(*COLUMNS).dropDuplicates()


def markdown_table(spark: SparkSession, path: str, section: str, columns: tuple[str, ...] = ("class", "cell")) -> DataFrame:
    """Rows of the first tables below a heading, up to the next heading of its rank: their first and last cells."""
    text = spark.read.text(path, wholetext=True)
    rank = f"(?ms)^(#+)\\s*[^\\n]*{re.escape(section)}[^\\n]*$(.*?)(?=^#{{1,3}}\\s|\\z)"
    body = F.regexp_extract("value", rank, 2)
    line = text.select(F.posexplode(F.split(body, "\n")).alias("line", "text")).where(F.col("text").rlike(r"^\s*\|") & ~F.col("text").rlike(r"^\s*\|[\s:|-]+$"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("text"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    rows = line.select("line", cells.alias("c")).where("size(c) >= 2")
    head = rows.agg(F.min("line").alias("head"))
    return rows.join(F.broadcast(head), F.col("line") > F.col("head")).select(F.regexp_replace(F.col("c")[0], "[`*]", "").alias(columns[0]), F.element_at("c", -1).alias(columns[1]))


def labels(spark: SparkSession, path: str) -> DataFrame:
    """The label table that stands for a remote label service."""
    return spark.read.parquet(path)


def retried(call: Callable[[], list], retries: int = 3, delay: float = 2.0, again: tuple[type[Exception], ...] = (TimeoutError, ConnectionError), sleep: Callable[[float], None] = time.sleep) -> list:
    """The call's result; temporary failures are tried again after a fixed delay, and the last one is raised."""
    left = max(retries, 1)
    while True:
        left -= 1
        try:
            return call()
        except again:
            if not left:
                raise
        sleep(delay)


def git_info(folder: str) -> dict[str, str | bool | None]:
    """Commit, branch and whether files are changed; None where git can't tell within 5 s."""

    def said(*args: str) -> str | None:
        try:
            got = subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True, timeout=5)
        except (OSError, subprocess.TimeoutExpired):
            return None
        return got.stdout.strip() if got.returncode == 0 else None

    status = said("status", "--porcelain")
    return {"commit": said("rev-parse", "HEAD"), "branch": said("rev-parse", "--abbrev-ref", "HEAD"), "dirty": None if status is None else bool(status)}


def file_uri(path: str) -> str:
    """The file's URI: of its absolute path, with what a URI can't hold in per cent."""
    return Path(path).resolve().as_uri()


def file_info(path: str) -> tuple[bool, datetime | None]:
    p = Path(path)
    return (True, datetime.fromtimestamp(p.stat().st_mtime, timezone.utc)) if p.exists() else (False, None)
