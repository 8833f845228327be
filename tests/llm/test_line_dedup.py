"""Line dedup against plain Python."""

from collections import defaultdict

import pytest

from orrery.llm import linededup

SPACE = " \t\n\x0b\x0c\r"
FOLD = str.maketrans(linededup.UPPER, linededup.LOWER)


def plain(rows, least_chars=20, least_docs=3):
    held, out = defaultdict(set), []
    key = lambda line: line.strip(SPACE).translate(FOLD)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= least_chars:
                held[key(line)].add(doc)
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(held[key(x)]) < least_docs or doc == max(held[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LINE = "A passage that several documents share"
ROWS = [
    (1, f"{LINE}\nown line of the first\n\t{LINE.upper()} \r\n"),
    (2, f"own line of the second\n{LINE}"),
    (3, LINE),
    (3, f"{LINE}\nanother row with the same id"),
    (4, f"\n\n  {LINE.lower()}\x0b\n"),
    (5, "shared by only two documents, so kept\nshort"),
    (6, "shared by only two documents, so kept\nshort"),
    (7, "short"),
    (8, ""),
    (9, None),
    (None, LINE),
    (None, "shared by only two documents, so kept"),
    (10, "ÄÖÜ ÉÈ only A-Z are folded here"),
    (11, "äöü éè only a-z are folded here"),
    (12, "ÄÖÜ ÉÈ ONLY A-z are folded here"),
    (13, "ÄÖÜ ÉÈ only A-Z are folded here\n" + "x" * 19 + "\n" + "é" * 20),
    (14, "é" * 20 + "\n" + "x" * 19),
    (15, "x" * 19 + "\n " + "é" * 20),
    (16, "é" * 20 + "\n" + "x" * 19),
]


def got(df, **k):
    return sorted(map(tuple, linededup.dedup_lines(df, **k).collect()), key=repr)


@pytest.mark.parametrize("sent", [0, 500_000])
def test_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(linededup, "SENT", sent)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id long, text string, h string, line int")
    assert got(df) == plain(ROWS)
    assert got(df, least_chars=1, least_docs=2) == plain(ROWS, 1, 2)


def test_repeated_rows_and_long_texts(spark):
    long = "\n".join(f"line number {i % 700} of a long text" for i in range(60_000))
    rows = [(1, long), (1, long), (2, long), (3, long), (3, "tail\n" + long)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_hot_line(spark):
    rows = [(i, f"a line that a third of all rows hold\nown line of document {i}" if i % 3 else f"nothing shared in document {i}") for i in range(3000)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_empty(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []


def test_no_python_on_the_way(spark):
    df = linededup.dedup_lines(spark.createDataFrame(ROWS, "doc_id long, text string").where("doc_id > 1"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
