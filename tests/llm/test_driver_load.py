"""What the driver has to keep book of and to hold: tasks of the pipeline's stages, at a fixed number of shuffle partitions, and its Python memory."""

import random
import tracemalloc

import pytest

from orrery.llm import jaccard, kneser, toxicity

PARTITIONS = 16


@pytest.fixture
def tasks(spark):
    """Calls a function and returns the number of tasks that it took."""
    held = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)

    def counted(name, f):
        sc = spark.sparkContext
        sc.setJobGroup(name, name)
        f()
        sc._jsc.clearJobGroup()
        status = sc.statusTracker()
        stages = {s for j in status.getJobIdsForGroup(name) for s in status.getJobInfo(j).stageIds}
        return sum(x.numCompletedTasks for s in stages if (x := status.getStageInfo(s)))

    yield counted
    for k, v in before.items():
        spark.conf.set(k, v)


def corpus(spark, n, words, vocabulary):
    rng = random.Random(5)
    names = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(vocabulary)]
    rows = [(i, " ".join(rng.choices(names, k=words)), "en") for i in range(n)]
    rows += [(n + i, f"{t} {names[i]}", "en") for i, (_, t, _) in enumerate(rows[:40])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2).cache()
    docs.count()
    labels = spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(n)], "doc_id long, quality int, toxic int").coalesce(1).cache()
    labels.count()
    return docs, labels


def test_tasks_of_stages(spark, tasks):
    """A step that several others read is run once, not once for each of them."""
    docs, labels = corpus(spark, 300, 60, 400)
    took = {
        "train": tasks("train", lambda: kneser.train(docs, labels)),
        "fit": tasks("fit", lambda: toxicity.fit(docs, labels)),
        "jaccard": tasks("jaccard", lambda: jaccard.link_components(docs, 80, 5).count()),
    }
    assert took["train"] <= 18 * PARTITIONS and took["fit"] <= 7 * PARTITIONS and took["jaccard"] <= 37 * PARTITIONS, took


def test_examples_are_packed(spark):
    """The driver holds a term of an example in a few bytes."""
    docs, labels = corpus(spark, 1_500, 250, 6_000)
    tracemalloc.start()
    toxicity.fit(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # about 250 terms in each of 1,125 examples
    assert peak < 130 * 250 * 1_125, peak
