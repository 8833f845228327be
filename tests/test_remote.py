"""A remote source by batches of scopes, with failures."""

import os
import uuid

import pytest

from orrery.operators import matching
from orrery.sources import remote

SCHEMA = "item string, label string, label_type string, scope string, ord long"
ROWS = [(f"Q{i}", f"Label {i % 40}", "rdfs:label" if i % 3 else "skos:altLabel", f"S{i % 13}", i) for i in range(400)]


def service(folder, fail=0, error=TimeoutError):
    """Answers from ROWS, notes each call in a file, and fails the first calls for each batch."""

    def ask(scopes):
        own = f"{folder}/{'-'.join(scopes)}"
        os.makedirs(own, exist_ok=True)
        done = len(os.listdir(own))
        open(f"{own}/{uuid.uuid4().hex}", "w").close()
        if done < fail:
            raise error("busy")
        return [r for r in ROWS if r[3] in scopes]

    return ask


def calls(folder):
    return {b: len(os.listdir(folder / b)) for b in os.listdir(folder)}


def scopes(spark, *more):
    return spark.createDataFrame([(f"S{i}",) for i in range(13)] + [("S1",), (None,), ("none",), *more], "scope string")


def test_index_of_a_service_that_fails_twice(spark, tmp_path):
    got = remote.fetched(scopes(spark), service(tmp_path, 2), SCHEMA, batch=3, tasks=2, delay=0.01, pause=0.0)
    index = lambda df: sorted(map(repr, map(tuple, matching.label_index(df, "scope").collect())))
    table = spark.createDataFrame(ROWS, SCHEMA)
    assert index(got) == index(table) and got.count() == len(ROWS)
    asked = calls(tmp_path)
    # every scope once in a batch of at most three, each batch three times and not again for a second action
    assert sorted(s for b in asked for s in b.split("-")) == sorted({*(f"S{i}" for i in range(13)), "none"})
    assert all(len(b.split("-")) <= 3 for b in asked) and set(asked.values()) == {3}


def test_errors_and_no_scopes(spark, tmp_path):
    with pytest.raises(Exception, match="busy"):
        remote.fetched(scopes(spark), service(tmp_path, 99), SCHEMA, delay=0.0, pause=0.0)
    with pytest.raises(Exception, match="wrong"):
        remote.fetched(scopes(spark), lambda s: 1 / 0 if s == [] else (_ for _ in ()).throw(ValueError("wrong")), SCHEMA, delay=0.0)
    assert remote.fetched(scopes(spark).limit(0), service(tmp_path), SCHEMA).count() == 0


def test_files(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "mirror"))
    ask = remote.file_transport(f"file://{tmp_path}/mirror", "scope", [c.split()[0] for c in SCHEMA.split(", ")])
    got = remote.fetched(scopes(spark).where("scope in ('S2', 'S5')"), ask, SCHEMA, pause=0.0)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in ROWS if r[3] in ("S2", "S5"))
