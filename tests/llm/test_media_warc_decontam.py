import random
from hashlib import sha256
from zlib import crc32

import pytest

from orrery.llm import decontam, matroska, warc

TEXTS = [None, "", "a", "x" * 64, "é" * 3000, "same", "same", "word " * 20_000]


def test_media_round_trip(spark):
    docs = spark.createDataFrame([(i, t, b"?", 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, media binary, n_bytes int")
    media = matroska.stored(matroska.to_matroska(docs, "doc_id", "text"))
    assert matroska.features(matroska.stored(matroska.to_matroska(docs.limit(0), "doc_id", "text")), "doc_id").count() == 0
    repeated = matroska.features(matroska.to_matroska(docs.where("doc_id = 4").union(docs.where("doc_id = 4")), "doc_id", "text"), "doc_id").collect()
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    rows = {r.doc_id: r for r in matroska.features(media, "doc_id").collect()}
    for i, t in enumerate(TEXTS):
        p = matroska.padded((t or "").encode())
        r = rows[i]
        assert len(p) % 64 == 0 and len(p) > 0
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(p), sha256(p).hexdigest(), crc32(p[-64:]))
    assert rows[5].media_sha256 == rows[6].media_sha256 and rows[5].feature == rows[6].feature
    table = matroska.packets(media, "doc_id").where("doc_id = 7").orderBy("byte_start").collect()
    assert sum(r.byte_size for r in table) == len(matroska.padded(TEXTS[7].encode())) and all(r.cued and r.codec == "A_PCM/INT/LIT" for r in table)
    assert [r.timestamp_ns for r in table] == sorted(r.timestamp_ns for r in table)


def test_all_lacings_and_unknown_sizes():
    e, u = matroska.element, matroska.uint
    frames = [b"a" * 300, b"b" * 255, b"c" * 10, b"d" * 700]
    sizes = [*map(len, frames)]
    xiph = bytes([3]) + b"".join(b"\xff" * (s // 255) + bytes([s % 255]) for s in sizes[:-1])
    ebml = bytes([3]) + matroska.put_vint(sizes[0]) + b"".join(matroska.put_vint(b - a + 8191, 2) for a, b in zip(sizes, sizes[1:-1]))
    blocks = [(2, xiph), (6, ebml), (4, bytes([1]))]
    parts = [b"".join(frames), b"".join(frames), b"ee" * 10]
    body = u(matroska.TIMESTAMP, 7) + b"".join(e(matroska.BLOCK_GROUP, e(matroska.BLOCK, b"\x81\xff\xfe" + bytes([f]) + lace + p)) for (f, lace), p in zip(blocks, parts))
    cluster = matroska.CLUSTER.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + body
    data = matroska._HEADER + matroska.SEGMENT.to_bytes(4, "big") + b"\xff" + cluster + cluster
    m = matroska.parse(data)
    assert not m.error and len(m.clusters) == 2
    got = [(p.lacing, data[p.start : p.start + p.size]) for p in m.packets if p.cluster == 0]
    assert got == [("xiph", f) for f in frames] + [("ebml", f) for f in frames] + [("fixed", b"ee" * 5)] * 2
    assert m.packets[0].timestamp == 5_000_000
    for cut in range(0, len(data), 97):
        matroska.parse(data[:cut])


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archives(spark, min_bytes):
    html = ["<p>x</p>" * 50, "", None, "<p>x</p>" * 50, "abc", "abc", "\r\n\r\n" + warc.SEPARATOR, "é" * 9000, *(f"<html>{i}</html>" * 20 for i in range(30))]
    pages = spark.createDataFrame([(i, None if i == 4 else f"http://a/{i}", h, "r") for i, h in enumerate(html)], "page_id long, url string, html string, record_type string").repartition(3)
    rows = {r.page_id: r for r in warc.archive(pages, min_bytes=min_bytes).collect()}
    assert len(rows) == len(html)
    for i, h in enumerate(html):
        raw = (h or "").encode()
        same = [j for j, x in enumerate(html) if (x or "").encode() == raw and len(raw) >= min_bytes]
        first = same[0] if same else i
        assert (rows[i].payload_bytes, rows[i].payload_digest, rows[i].record_type, rows[i].refers_to) == (len(raw), warc.digest(raw), "response" if first == i else "revisit", None if first == i else first)
        assert rows[i].intact


def test_archives_of_equal_keys(spark, monkeypatch):
    """Equal pages under the same smallest key are responses, each with a record of its own; archives stay below their size."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300)
    pages = spark.createDataFrame([(1, "u", "same"), (1, "u", "same"), (2, "v", "same"), (None, "w", "same"), (None, None, None), *((i, "x", f"{i}" * 3000) for i in range(10, 30)), (99, "y", "z" * 3_000_000)], "page_id long, url string, html string")
    rows = warc.archive(pages).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows if r.payload_bytes == 4) == [(0, "revisit", 1), (1, "response", None), (1, "response", None), (2, "revisit", 1)]
    assert len({r.record_id for r in rows}) == len(rows) == 26 and len({r.archive for r in rows}) > 5
    assert all(r.intact for r in rows) and max(r.payload_bytes for r in rows) == 3_000_000


def test_archives_of_nothing(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, c in enumerate(text, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (p != c))
    return min(row)


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcde", k=rng.randint(2, 6))) for _ in range(60)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    items = [say(12) for _ in range(8)] + [None, "", "...", "forty two", "é" * 30, words[0]]
    docs = []
    for i in range(60):
        t = list(rng.choice(items[:8]))
        for _ in range(rng.randint(0, 7)):
            at = rng.randrange(len(t))
            t[at : at + 1] = rng.choice([[], ["z"], [t[at], "q"]])
        docs.append(say(20) + " " + "".join(t).upper() + "! " + say(20) if i % 3 else say(60))
    docs += [None, "", items[0], "The answer is Forty-two!", "forty twofold", "é" * 28 + "èé", "x " * 400_000 + items[1], words[0], words[0] + "x"]
    d = spark.createDataFrame([(i, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(i, t, "k") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    want = set()
    for i, t in enumerate(docs):
        for k, item in enumerate(items):
            f, own = decontam.fold(item or ""), decontam.fold((t or "").replace("x " * 400_000, "x x "))
            if not f:
                continue
            if int(0.07 * len(f)) == 0:
                if f" {f} " in f" {own} ":
                    want.add((i, k, 0))
            elif (x := distance(f, own)) <= int(0.07 * len(f)):
                want.add((i, k, x))
    for size in (2_000_000, 100):
        assert {(r.doc_id, r.item_id, r.distance) for r in decontam.matches(d, b, block_chars=size).collect()} == want
    assert len(want) > 20 and {(i, k) for i, k, _ in want if k in (11, 12)} == {(63, 11), (65, 12)}
    twice = decontam.matches(d.where("doc_id = 62").union(d.where("doc_id = 62")), b).collect()
    assert (62, 0, 0) in want and sorted((r.doc_id, r.item_id, r.distance) for r in twice) == sorted(2 * [x for x in want if x[0] == 62])
    assert decontam.matches(d.limit(0), b).count() == decontam.matches(d, b.limit(0)).count() == 0
