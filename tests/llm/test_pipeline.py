"""The corpus pipeline against a plain version of its stages on a small corpus."""

import random

import pandas as pd

import corpus_pipeline
from orrery.llm import decontam
from tests.llm.test_packing import ids_of
from tests.llm.test_text_operators import brute_components


def corpus(rng):
    syllables = ["tion", "er", "an", "the", "re", "on", "st", "li", "mo"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    say = lambda n: " ".join(word() for _ in range(n))
    items = [say(14) for _ in range(4)]
    docs, labels, why = [], [], {}
    for i in range(420):
        kind = ["plain"] * 7 + ["junk", "toxic", "copy", "leak"]
        kind = kind[i % 11]
        text = say(rng.randint(40, 80))
        if kind == "junk":
            text = " ".join(w + "$$$" for w in text.split())
        elif kind == "toxic":
            w = text.split()
            w[5] = w[20] = "idiot"
            text = " ".join(w)
        elif kind == "copy":
            base = next(t for t, k in ((docs[j][1], why[j]) for j in range(i - 1, -1, -1)) if k == "plain")
            text = base + " " + word()
        elif kind == "leak":
            text = f"{text} {rng.choice(items)} {say(5)}"
        why[i] = kind
        docs.append((i, text, "en", f"src{i % 3}", len(text)))
        if i % 4:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    return docs, labels, items, why


def test_whole_pipeline(spark, tmp_path):
    docs, labels, items, why = corpus(random.Random(9))
    for name, rows, columns in (("documents", docs, ["doc_id", "text", "lang", "source", "n_chars"]), ("labels", labels, ["doc_id", "quality", "toxic"]), ("benchmark", [*enumerate(items)], ["item_id", "text"])):
        pd.DataFrame(rows, columns=columns).to_parquet(tmp_path / f"{name}.parquet")
    kept = [(i, t) for i, t, *_ in docs if why[i] not in ("junk", "toxic")]
    parts = brute_components(kept, corpus_pipeline.PERCENT, corpus_pipeline.WIDTH)
    kept = [(i, t) for i, t in kept if parts[i][1] == i]
    kept = {i: t for i, t in kept if not any(decontam.fold(x) in decontam.fold(t) for x in items)}
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    # trusted rows at the ends of a band may be rejected: at most one in a hundred
    assert set(got) <= set(kept) and len(kept) - len(got) <= 0.01 * len(docs)
    assert all(got[i] == len(ids_of(kept[i])) for i in list(got)[:50])
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "n-gram Jaccard join" and {why[i] for i in got} <= {"plain", "copy"}


def test_stages_keep_columns_and_take_nothing(spark, tmp_path):
    pd.DataFrame([(1, "good words here", "en", "s", 15)], columns=["doc_id", "text", "lang", "source", "n_chars"]).iloc[:0].astype({"doc_id": "int64", "text": str, "lang": str, "source": str, "n_chars": "int64"}).to_parquet(tmp_path / "documents.parquet")
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0


def test_stages_take_odd_rows(spark, tmp_path):
    """Missing and repeated ids, missing cells, empty and long texts and columns of other names pass every stage."""
    rng = random.Random(4)
    say = lambda n: " ".join("".join(rng.choices(["er", "an", "the", "on"], k=3)) for _ in range(n))
    long = say(60_000)
    rows = [(i, say(50), "en", "s", 1, "k") for i in range(40)] + [(None, say(50), None, None, None, None), (None, None, "de", "s", 0, None), (50, "", "en", None, 0, "x"), (51, long, "en", "s", 1, "x"), (7, say(30), "fr", "s", 1, "x"), (7, say(30), "fr", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(None, 1, 1), (3, None, None), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (None, "not there at all in any text"), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = [tuple(r) for r in stage(spark, docs, str(tmp_path)).collect()]
        assert len(got) >= (len(rows) - 2 if name == "quality classifier" else len(rows)) and {x[0] for x in got} >= {None, 50}, name
    pieces = corpus_pipeline.packed(spark, docs, str(tmp_path)).collect()
    total = {}
    for r in pieces:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total[50] == 1 and total[51] == len(ids_of(long)) and total[None] == len(ids_of(rows[40][1])) + 1
