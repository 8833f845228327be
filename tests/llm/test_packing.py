import math
from zlib import crc32

import numpy as np
import pytest

from orrery.llm import packing
from orrery.llm.queries import vocabulary

VOCABULARY = vocabulary("byte_bpe_50k.json")
TEXTS = ["", None, "One two  three\n\nfour ", " lead", "Straße 12²³ ½ don't x", "a\n b\t c", "wor d" * 900, "same text", "same text", "<|endoftext|> x", "é́" * 50, "x" * 5000]


def ids_of(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("length", [16, 2048])
def test_every_id_lies_in_one_piece(spark, length):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    rows = packing.pack_documents(docs, VOCABULARY, length).collect()
    for i, t in enumerate(TEXTS):
        ids, at = ids_of(t), 0
        for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_length))
    for pieces in by.values():
        at = 0
        for offset, n, size in sorted(pieces):
            assert offset == at
            at += n
        assert at == size and (size == length or size & (size - 1) == 0)


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_hilbert_neighbours_differ_by_one(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    order = packing.hilbert(cells, bits)
    assert sorted(order) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(order)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_direction_ignores_length_and_follows_content():
    rng, w = np.random.default_rng(3), packing.weights(1000)
    topics = [rng.dirichlet(np.full(1000, 0.02)) for _ in range(8)]
    docs = [(k, rng.choice(1000, size=n, p=topics[k])) for k in range(8) for n in rng.integers(20, 5000, 60)]
    cells = packing.directions(np.array([w[x].sum(0) for _, x in docs]))
    assert (packing.directions(np.array([w[x].sum(0) * 7 for _, x in docs])) == cells).all()
    rank = lambda x: np.argsort(np.argsort(x, kind="stable"))
    centre = np.sqrt(((cells - 511.5) ** 2).sum(1))
    assert abs(np.corrcoef(rank(centre), rank([len(x) for _, x in docs]))[0, 1]) < 0.2
    order = np.argsort(packing.hilbert(cells, packing.BITS))
    same = np.mean([docs[a][0] == docs[b][0] for a, b in zip(order, order[1:])])
    assert same > 0.5  # 1 in 8 by chance
    assert packing.directions(np.zeros((1, packing.DIMS + 1))).tolist() == [[512] * packing.DIMS]


def brute_curve(text):
    """Position of a text on the curve, by its ids one at a time."""
    w = packing.weights(65_536).astype(float)
    total = sum(w[i] for i in ids_of(text))
    cell = [min(1023, int((x / math.sqrt(sum(total**2)) + 1) / 2 * 1024)) for x in total[:3]]
    return int(packing.hilbert(np.array([cell]), packing.BITS)[0])


def test_pieces_follow_the_curve(spark):
    words = ["alpha beta", "Straße über", "x = y + 1", "日本語", "one two three", "<p>html</p>"]
    texts = [" ".join([words[i % 6]] * (1 + i % 13)) + f" {i}" for i in range(60)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    rows = packing.pack_documents(docs, VOCABULARY, 64).collect()
    assert all(r.curve == brute_curve(texts[r.doc_id]) for r in rows)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        at.setdefault(r.sequence_id, []).append(r.curve)
    for curve in at.values():
        assert curve == sorted(curve)
