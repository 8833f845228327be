"""Token alignment against whole-text encodings and plain counting."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from orrery.llm import crosstoken
from orrery.llm.queries import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def plain(rows):
    """From the whole text's tokens by the two libraries, byte by byte."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(x): x for x in letters} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in letters)}
    spelt_a = lambda i: bytes(back[c] for c in a_model.id_to_token(i))
    spelt_b = lambda i: bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
    held, count = [], Counter()
    for doc, text in rows:
        whole = " " + (text or "")
        a, b = (a_model.encode(whole, add_special_tokens=False).ids, b_model.encode(text)) if text else ([], [])
        if b"".join(map(spelt_a, a)) != whole.encode() or b"".join(map(spelt_b, b)) != whole.encode():
            a, b = [], []
        ends = []
        for ids, spelt in ((a, spelt_a), (b, spelt_b)):
            at, of = 0, {}
            for k, i in enumerate(ids):
                at += len(spelt(i))
                of[at] = k
            ends.append(of)
        links, groups, i, j = [], [], 0, 0
        for at in sorted(ends[0].keys() & ends[1].keys()):
            k, m = ends[0][at], ends[1][at]
            links.append((a[k], b[m]))
            groups.append(",".join(map(str, a[i : k + 1])) + "|" + ",".join(map(str, b[j : m + 1])))
            i, j = k + 1, m + 1
        count.update(links)
        held.append((doc, a, b, groups, links))
    best = defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return sorted(
        ((doc, len(a), len(b), len(g), len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), sha256(";".join(g).encode()).hexdigest() if a else "") for doc, a, b, g, x in held),
        key=repr,
    )


def got(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id long, text string, batch string, stripe int")
    return sorted(map(tuple, crosstoken.alignments(df, A, B).collect()), key=repr)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, " a  b "), (6, "tab\tand \n lines\n\n  more \r\n"), (7, "a literal ▁ is no space"), (8, "<|endoftext|> <s> </s> <0x41> <unk>"),
    (9, "nul\0 and \x1c \x1d\x85 separators   　x"), (10, "日本語の文章 と English"), (11, "ﬁ １ é é \U0001f600‍"), (12, "don't we'll I'd"), (None, "no id"), (4, "a"), (4, "another text of the same id"), (13, "\n"), (14, "x\n "),
]


@pytest.mark.parametrize("small", [False, True])
def test_rows(spark, monkeypatch, small):
    if small:
        for name, value in (("BATCH_BYTES", 64), ("MEMO", 5), ("WINDOW", 8), ("PART_BYTES", 100)):
            monkeypatch.setattr(crosstoken, name, value)
    rng = random.Random(12)
    letters = ["a", "b", "the", "ing", " ", " ", " ", "\n", "\t", "é", "1", "'s", ".", " ", "\x1c", "日", "\0", "tion"]
    rows = ODD + [(100 + i, "".join(rng.choices(letters, k=rng.randint(1, 60)))) for i in range(150)]
    assert got(spark, rows) == plain(rows)


def test_long_texts(spark):
    rows = [(1, "a" * 300_000), (2, "word and word " * 40_000), (3, "日本" * 20_000)] + [(10 + i, "copies of one text") for i in range(500)]
    assert got(spark, rows) == plain(rows)


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None)]) == plain([(1, None)])
