import math
import random
import re
import time
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import components, htmltext, jaccard, kneser, lattice, licenses, toxicity
from orrery.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {c: c + 32 for c in range(65, 91)}


def shingles(text, width):
    w = WORD.findall((text or "").translate(AZ))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute_components(docs, percent, width):
    sets, root = {i: shingles(t, width) for i, t in docs}, {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(rng):
    vocabulary = [f"w{i}" for i in range(300)]
    docs = [None, "", " \n ", "a", "A", "a b", "b a", "É é", "é é"]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(3, 90))
        for _ in range(rng.randint(1, 9)):
            w = base[:]
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            docs.append(" ".join(w))
    return docs + ["the common line of all " + " ".join(rng.choices(vocabulary, k=9)) for _ in range(30)] + [" ".join(vocabulary)] * 20


@pytest.mark.parametrize("percent,width", [(90, 3), (80, 5)])
def test_components_match_brute_force(spark, percent, width):
    docs = [*enumerate(near_copies(random.Random(percent)))]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, key string, n int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(df, percent, width).collect()}
    assert got == brute_components(docs, percent, width)


@pytest.mark.parametrize("chunk", [jaccard.CHUNK, 50])
def test_copies_that_link_to_their_base_only(spark, monkeypatch, chunk):
    """Each copy is one edit from its base; two copies are further apart than the threshold."""
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rng, docs = random.Random(8), []
    for g in range(40):
        base = [f"g{g}w{i}" for i in range(62)]
        docs.append(" ".join(base))
        for k, at in enumerate(rng.sample(range(3, 59, 4), 8)):
            docs.append(" ".join([*base[:at], f"g{g}x{k}", *base[at + 1 :]]))
    docs = [*enumerate(docs)]
    want = brute_components(docs, 90, 3)
    assert {c for _, c in want.values()} == {9 * g for g in range(40)}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(df, 90, 3).collect()} == want


def test_rows_that_share_or_lack_an_id(spark):
    """A doc_id that stands for two texts joins what each of them links with; rows without one are nodes too."""
    say = lambda k: " ".join(f"w{k}x{i}" for i in range(120))
    near = lambda k: say(k) + " more"
    rows = [(1, say(0)), (1, say(1)), (2, near(0)), (3, near(1)), (None, near(2)), (9, say(2)), (None, say(3)), (None, say(3)), (None, None), (1, say(0)), (5, "")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, rep int").repartition(4)
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id or 0) for r in jaccard.link_components(df, 90, 3).collect())
    assert got == sorted([(1, 118, 1)] * 3 + [(2, 119, 1), (3, 119, 1), (0, 119, 9), (9, 118, 9), (0, 118, 0), (0, 118, 0), (0, 0, 0), (5, 0, 5)])


@pytest.mark.parametrize("filter_ids", [jaccard.FILTER_IDS, 0])
def test_lists_in_parts(spark, monkeypatch, filter_ids):
    """Lists of frequent shingles are dealt out in parts, and hubs too; links across parts stay, whether ids are sent out or joined."""
    for name, value in (("PART_LEVEL", 1), ("PER_HUB", 2), ("FILTER_IDS", filter_ids)):
        monkeypatch.setattr(jaccard, name, value)
    docs = [*enumerate(near_copies(random.Random(77)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(df, 80, 5).collect()} == brute_components(docs, 80, 5)


def one_list(rng, n):
    """An index list of n sets, by size, with random places, parities and components."""
    size = np.sort(rng.integers(30, 60, n))
    return {"key": np.zeros(n, np.int64), "part": np.zeros(n, np.int32), "pos": rng.integers(0, 9, n).astype(np.int32), "n": size, "bits": rng.integers(0, 1 << 8, n), "rep": np.arange(n), "component": rng.integers(0, 3, n), "list": np.repeat([1, 2], [n // 2, n - n // 2])}


@pytest.mark.parametrize("n", [2, 7, 60, 300])
def test_probes_of_a_list(n):
    """First partners and pairs across components against all pairs."""
    t = one_list(np.random.default_rng(n), n)
    order = np.lexsort((t["component"], t["n"], t["list"]))
    t = {c: v[order] for c, v in t.items()}
    a, b = np.triu_indices(n, 1)
    near = (t["list"][a] == t["list"][b]) & (90 * t["n"][b] <= 100 * t["n"][a]) & jaccard.possible(t, a, b, 90)
    pairs = {*zip(a[near].tolist(), b[near].tolist())}
    some = {x for p in pairs for x in p}
    partner = jaccard.first_partners(t, 90)
    assert {i for i in range(n) if partner[i] >= 0} == some
    assert all((min(i, p), max(i, p)) in pairs for i, p in enumerate(partner.tolist()) if p >= 0)
    got = [(int(i), int(j)) for x, y in jaccard.across(t, 90) for i, j in zip(x, y)]
    assert len(got) == len({*got}) and {*got} == {(i, j) for i, j in pairs if t["component"][i] != t["component"][j]}


def test_long_list_with_a_stranger():
    """Near copies of one component beside a stranger cost a few passes, not all pairs."""
    import time

    n = 100_000
    t = {"key": np.zeros(n, np.int64), "part": np.zeros(n, np.int32), "pos": np.zeros(n, np.int32), "n": np.sort(np.random.default_rng(1).integers(500, 520, n)), "bits": np.zeros(n, np.int64), "rep": np.arange(n), "component": np.zeros(n, np.int64), "list": np.zeros(n, np.int64)}
    t["component"][n // 2], t["bits"][n // 2] = 7, -1
    began = time.monotonic()
    partner = jaccard.first_partners(t, 99)
    assert (np.flatnonzero(partner < 0) == n // 2).all()
    t["bits"][n // 2] = 0
    assert sum(len(i) for i, _ in jaccard.across(t, 90)) == n - 1
    assert time.monotonic() - began < 10


def test_components_of_a_long_text(spark):
    long = " ".join(f"w{i}" for i in range(400_000))
    df = spark.createDataFrame([(1, long), (2, long + " x"), (3, "w " * 500_000), (4, "y")], "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(df, 90, 3).collect()} == {1: (399_998, 1), 2: (399_999, 1), 3: (1, 3), 4: (1, 4)}


def test_components_of_nothing(spark):
    assert jaccard.link_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got.values()) == {0, 100} and len(got) == 41 + 60


@pytest.mark.parametrize("opened,many,dense", [(4, 12, 1 / 16), (1, 0, 0.5), (1, 99, 0.0)])
def test_nearest_is_exact(monkeypatch, opened, many, dense):
    for name, value in (("OPENED", opened), ("MANY", many), ("DENSE", dense)):
        monkeypatch.setattr(toxicity, name, value)
    rng = np.random.default_rng(1)
    known = toxicity.Terms({b"%d" % i: i for i in range(60)}, rng.random(60) * np.linspace(3, 0.1, 60) + 0.1)
    held = []
    for _ in range(700):
        v = {int(t): int(rng.integers(1, 4)) for t in (60 * rng.random(rng.integers(1, 9)) ** 3).astype(int)}
        held.append((tuple(sorted(v)), tuple(v[t] for t in sorted(v))))
    index = toxicity.Index(known, held)
    full = np.zeros((len(held), 60))
    for i, v in enumerate(held):
        full[i, list(v[0])] = (1 + np.log(v[1])) * known.weight[list(v[0])]
    full /= np.linalg.norm(full, axis=1, keepdims=True)
    for k in (1, 15):
        for i in range(0, 700, 9):
            cosine = full @ full[i]
            got = index.nearest(known.unit(held[i]), k)
            want = np.sort(cosine)[::-1][:k]
            assert np.allclose([c for c, _ in got], want[want > 5e-7], atol=2e-6) and len({j for _, j in got}) == len(got)
            assert np.allclose(cosine[[j for _, j in got]], [c for c, _ in got], atol=2e-6)
    assert toxicity.Index(known, []).nearest(known.unit(held[0]), 3) == []


def plain_toxicity(docs, labels, scored):
    """Scores by dense vectors and plain loops: vocabulary, weights, merging of near examples, votes, calibration."""
    T = toxicity  # noqa: N806
    words = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate(AZ))
    rows = sorted((d, words(t), labels[d]) for d, t in docs if d in labels and crc32(str(d).encode()) % 4 != 2)
    prior = sum(y for *_, y in rows) / len(rows)
    weight = {}
    for w in sorted({x for _, ws, _ in rows for x in ws}):
        own = [(ws, y) for _, ws, y in rows if w in ws]
        bad = [ws for ws, y in own if y]
        if len(own) >= 2:
            rf = math.log2(2 + min(len({x[0] for x in bad}), len({x[-1] for x in bad})) / max(1, len(own) - len(bad)))
            weight[w] = (math.log((len(rows) + 1) / (len(own) + 0.5)) + 1e-6) * rf**2
    order = sorted(weight, key=lambda w: w.encode())

    def vector(ws):
        c = Counter(x for x in ws if x in weight)
        v = np.array([(1 + math.log(c[w])) * weight[w] if c[w] else 0.0 for w in order])
        return v / np.linalg.norm(v) if c else None

    def nearest(v, index, k, but=None):
        found = sorted(((-round(float(v @ x), 6), i) for i, x in enumerate(index)))[: k + (but is not None)]
        return [(-c, i) for c, i in found if c < 0 and i != but][:k]

    key = lambda ws: tuple(zip(*sorted((order.index(w), n) for w, n in Counter(x for x in ws if x in weight).items())))
    whole, none = {}, []
    for _, ws, y in rows:
        whole.setdefault(key(ws), []).append((ws, y)) if key(ws) else none.append(y)
    held = [(vector(x[0][0]), [y for _, y in x]) for _, x in sorted(whole.items())]
    group = [*range(len(held))]
    for i, (v, _) in enumerate(held):
        for c, j in nearest(v, [x for x, _ in held], 3):
            if c >= T.NEAR:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    firsts = sorted({*group})
    index = [held[g][0] for g in firsts]
    toxic = [np.mean([y for i, g in enumerate(group) if g == f for y in held[i][1]]) for f in firsts]
    empty = (sum(none) + prior) / (len(none) + 1)

    def vote(near):
        return (sum(c * c * toxic[i] for c, i in near) + T.PRIOR * prior) / (sum(c * c for c, _ in near) + T.PRIOR) if near else empty

    x = np.array([vote(nearest(v, index, T.NEIGHBOURS, i)) for i, v in enumerate(index)])
    # isotonic means: the largest over starts of the least over ends of means of runs, with a pseudo-example of the mean in each pool
    at = sorted({*x})
    sums, sizes = [sum(y for y, z in zip(toxic, x) if z == a) for a in at], [int((x == a).sum()) for a in at]
    fitted = [max(min(sum(sums[i : j + 1]) / sum(sizes[i : j + 1]) for j in range(k, len(at))) for i in range(k + 1)) for k in range(len(at))]
    out, mean = {}, float(np.mean(toxic))
    smooth = {}
    for f in {*fitted}:
        pool = [k for k, g in enumerate(fitted) if abs(g - f) < 1e-12]
        for k in pool:
            smooth[k] = (sum(sums[i] for i in pool) + mean) / (sum(sizes[i] for i in pool) + 1)
    ys = np.maximum.accumulate([smooth[k] for k in range(len(at))])
    for d, t in scored:
        v = vector(words(t))
        out[d] = empty if v is None else float(np.clip(np.interp(vote(nearest(v, index, T.NEIGHBOURS)), at, ys), 0, 1))
    return out


def test_toxicity_matches_brute_force(spark):
    rng = random.Random(12)
    plain = [f"p{i}" for i in range(60)] + ["é1"]
    docs, labels = [], {}
    for i in range(150):
        w = rng.choices(plain, k=rng.randint(3, 12))
        if i % 5 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["SCUM", "idiot"]))
        if i % 25 == 1:
            w = docs[-1][1].split() + (["more"] if i % 2 else [])
        docs.append((i, " ".join(w)))
        if i % 7:
            labels[i] = int(i % 5 == 0 or i % 25 == 1)
    docs += [(200, None), (201, ""), (202, "unknown"), (203, "scum " * 200_000), (204, docs[3][1]), (204, docs[3][1]), (None, docs[5][1])]
    labels[202] = 0
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, terms string").repartition(3)
    lab = spark.createDataFrame([*labels.items(), (5, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.classify(d, lab).collect()
    want = plain_toxicity([x for x in docs if x[0] is not None], labels, docs)
    assert len(rows) == len(docs)
    assert all(r.score == pytest.approx(want[r.doc_id], abs=2e-5) for r in rows)
    assert toxicity.classify(d.limit(0), lab).count() == 0


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(2)
    plain = [f"p{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(1500):
        bad = rng.random() < 0.15
        w = rng.choices(plain, k=30)
        if bad:
            w[rng.randrange(30)] = rng.choice(["IDIOT!", "scum,"])
        docs.append((i, " ".join(w), "labels"))
        labels.append((i, int(bad)))
    docs += [(2000, None, ""), (2001, "", "")]
    d = spark.createDataFrame(docs, "doc_id long, text string, toxic string")
    rows = {r.doc_id: r for r in toxicity.classify(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(r.held_out == (crc32(str(k).encode()) % 4 == 2) for k, r in rows.items())
    assert all(rows[i].predicted == y for i, y in labels if rows[i].held_out) and all(0 <= r.score <= 1 for r in rows.values())
    assert rows[2000].predicted == rows[2001].predicted == 0
    none = toxicity.classify(d, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in none.collect()} == {0.0}


def test_quality(spark):
    rng = random.Random(3)
    syllables = ["tion", "er", "an", "the", "re", "on", "st"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    docs, labels = [], []
    for i in range(600):
        w = [word() for _ in range(rng.randint(5, 120))]
        bad = i % 10 == 0
        text = (" ".join(w) if not bad else " ".join(x + "$$$" for x in w) if i % 20 else " ".join(x.upper() + "!!" for x in w)) if i != 10 else "word " * 60
        docs.append((i, text, "en" if i % 3 else None, 0))
        labels.append((i, int(not bad)))
    docs += [(900, None, "en", 0), (901, "", "xx", 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, keep int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = {r.doc_id: r for r in kneser.classify(d, lab).collect()}
    assert len(rows) == len(docs) and rows[900].keep and rows[901].keep
    assert sum(rows[i].keep for i, y in labels if not y) == 0
    assert sum(not rows[i].keep for i, y in labels if y) <= 6
    assert all(r.keep for r in kneser.classify(d, lab.where("quality > 5")).collect())


def plain_kneser_ney(trusted, text):
    """Bits of each character of a text by the textbook's recursion over counted n-grams."""
    marks = lambda t: ["^", "^", *kneser.ditto(t), "$"]
    same = lambda g: tuple("$" if x == "^" else x for x in g)
    c3 = Counter(same(m[i : i + 3]) for t in trusted for m in [marks(t)] for i in range(len(m) - 2))
    c2 = Counter(g[1:] for g in c3)
    c1 = Counter(g[1:] for g in c2)
    tables = {3: c3, 2: c2, 1: c1}

    def cut(c):
        n = Counter(c.values())
        if not n[1] or not n[2]:
            return [0.5, 0.75, 0.9]
        y = n[1] / (n[1] + 2 * n[2])
        d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 0.9]
        return [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]

    cuts = {k: cut(c) for k, c in tables.items()}

    def p(g):
        if not g:
            return 1 / (0x110000 + 1)
        c, d = tables[len(g)], cuts[len(g)]
        of = [n for x, n in c.items() if x[:-1] == g[:-1]]
        if not of:
            return p(g[1:])
        less = lambda n: d[min(n, 3) - 1]
        own = max(c[g] - less(c[g]), 0) if c[g] else 0
        return own / sum(of) + sum(map(less, of)) / sum(of) * p(g[1:])

    m = marks(text)
    return [-math.log2(p(same(m[i : i + 3]))) for i in range(len(m) - 2)]


@pytest.mark.parametrize("alphabet", [128, 4])
def test_perplexities_match_brute_force(spark, monkeypatch, alphabet):
    """Whether n-grams are in the dense table or meet the counts in joins; no character is lumped together with others."""
    monkeypatch.setattr(kneser, "ALPHABET", alphabet)
    rng = random.Random(alphabet)
    say = lambda letters, n: "".join(rng.choices(letters, k=n))
    trusted = [say("aabbbc é  ", rng.randint(1, 40)) for _ in range(30)] + ["the the cat", "漢字かな交じり文" * 3, "x\x16y"]
    others = ["我" * 150, "b" * 2000, "", None, "zzz 漢字", "the the the", "ab", "ab"]
    d = spark.createDataFrame([(i if i != 39 else None, t, "en", 1.0, 2) for i, t in enumerate(trusted + others)], "doc_id long, text string, lang string, bits double, n int").repartition(3)
    model = kneser.train(d, spark.createDataFrame([(i, 1) for i in range(len(trusted))], "doc_id long, quality int"))
    rows = kneser.perplexities(d, model).collect()
    want = {}
    for i, t in enumerate(trusted + others):
        b = plain_kneser_ney(trusted, t) if t else []
        want[i if i != 39 else None] = (len(b), np.mean(b) if b else None, np.std(b) if b else None)
    assert len(rows) == len(trusted + others)
    for r in rows:
        n, mean, deviation = want[r.doc_id]
        assert r.n == n and ((r.bits, r.spread) == (None, None) if not n else (r.bits == pytest.approx(mean, rel=1e-5) and r.spread == pytest.approx(deviation, rel=1e-3, abs=1e-4)))
    assert want[len(trusted)][1] > 10
    assert kneser.perplexities(d.limit(0), model).count() == 0


def test_model_counts_every_trusted_row(spark, monkeypatch):
    """More trusted rows than a sample of 20,000 would hold: each adds its own characters, whether ids are sent out or joined."""
    rows = 20_500
    d = spark.range(rows).selectExpr("id as doc_id", "concat('a', chr(200 + cast(id % 2 as int))) as text", "'en' as lang")
    labels = d.selectExpr("doc_id", "1 as quality")
    for sent in (kneser.SENT_IDS, 10):
        monkeypatch.setattr(kneser, "SENT_IDS", sent)
        assert kneser.counts(kneser.trusted_rows(d, labels)).agg({"n": "sum"}).first()[0] == 3 * rows


def segmentations(word, pieces):
    """All ways to cut `word` into pieces."""
    if not word:
        yield ()
    for j in range(1, len(word) + 1):
        if word[:j] in pieces:
            yield from ((word[:j], *rest) for rest in segmentations(word[j:], pieces))


def brute_lattice(texts, held, langs, weights, rounds):
    """The score of every text, by plain EM and sums over all segmentations of every word, for each language."""
    names = [*weights, "stop"]
    first = lambda p: p != "stop" and p[:1] == b" "
    normal = lambda n: {p: n[p] / sum(n[q] for q in names if first(q) == first(p)) for p in names}
    words = [[x.encode() for x in WORD.findall((t or "").translate(AZ))] for t in texts]
    rows = Counter(lang for lang, h in zip(langs, held) if not h)
    small, parts = lattice.SMALL, []
    kept = sorted(rows, key=lambda x: (-rows[x], x is not None, x or ""))[: lattice.GROUPS - 1]
    for lang in [*kept, "others"]:
        own = [not h and (x == lang or lang == "others" and x not in kept) for x, h in zip(langs, held)]
        p = normal({**weights, "stop": max(weights.values())})
        c = Counter(x for w, o in zip(words, own) if o for x in w)
        ways = lambda w: [(s, math.prod(p[x] for x in s) * p["stop"]) for s in segmentations(b" " + w, weights)]  # noqa: B023, E731
        for _ in range(rounds if sum(rows.values()) else 0):
            n = dict.fromkeys(names, lattice.PSEUDO)
            for w in c:
                total = sum(x for _, x in ways(w))
                for s, x in ways(w):
                    for piece in (*s, "stop"):
                        n[piece] += x / total
            p = normal(n)
        once, twice = sum(k == 1 for k in c.values()), sum(k == 2 for k in c.values())
        d = once / (once + 2 * twice) if once and twice else 0.5
        ends, tokens = sum(own), sum(c.values()) + sum(own) + 2 * small
        new = (d * len(c) + small) / tokens
        of = {w: max(c[w] - d, 0) / tokens + new * sum(x for _, x in ways(w)) for w in {x for w in words for x in w}}
        prior = (ends + small) / (sum(rows.values()) + small * (len(kept) + 1))
        parts.append([math.log(prior * (ends + small) / tokens) + sum(math.log(of[x]) for x in w) for w in words])
    return [np.logaddexp.reduce(x) / math.log(10) for x in zip(*parts)]


@pytest.mark.parametrize("common,long,trained", [(lattice.COMMON, lattice.LONG, True), (2, 3, True), (3, lattice.LONG, False)])
def test_word_model_and_lattice(spark, monkeypatch, common, long, trained):
    """Both scores against brute force, whichever words go out to the tasks and whichever meet the recursion alone."""
    monkeypatch.setattr(lattice, "LONG", long)
    monkeypatch.setattr(lattice, "COMMON", common)
    rng = random.Random(4)
    say = lambda: "".join(rng.choices("aBcé", k=rng.randint(1, 6)))
    some = [say() for _ in range(25)]
    texts = [None, "", " \t", "Ab  AB\tab é", "ab"] + [" ".join(rng.choices(some, k=rng.randint(1, 30)) + [say()]) for _ in range(60)]
    ids = [*range(len(texts) - 2), None, 3]
    weights = {bytes([b]): 1.0 for b in " abc".encode() + "é".encode()} | {b" a": 3.0, b"ab": 2.0, b"bc": 1.0, b"abc": 0.5, "é".encode(): 2.0, b" ab": 1.5, b"ca": 1.0}
    held = [i is not None and (crc32(str(i).encode()) % 7 == 2 or not trained) for i in ids]
    if not trained:
        texts, held, ids = [t for t, h in zip(texts, held) if h], [h for h in held if h], [i for i in ids if i is not None]
        ids = [next(k for k in range(1000 * n, 1000 * n + 1000) if crc32(str(k).encode()) % 7 == 2) for n in range(len(ids))]
    langs = [["en", None, "de", "en", "fr", "x", "y", "z"][k % 8] for k in range(len(ids))]
    d = spark.createDataFrame([(i, t, lang, "w", 1.0, 2) for i, t, lang in zip(ids, texts, langs)], "doc_id long, text string, lang string, word string, score double, n int").repartition(3)
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score, r.held_out, r.n_known, r.train_tokens, r.base_score) for r in lattice.score(d, lattice.trie(weights)).collect())
    tokens = [[*WORD.findall((t or "").translate(AZ)), None] for t in texts]
    c = Counter(x for w, h in zip(tokens, held) if not h for x in w)
    n, v = sum(c.values()), len(c)
    base = [sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) for w in tokens]
    want = sorted((i is None, i or 0, len(w), s, h, sum(c[x] > 0 for x in w), n, b) for i, w, s, h, b in zip(ids, tokens, brute_lattice(texts, held, langs, weights, lattice.ROUNDS), held, base))
    assert len(rows) == len(want) and all(a == pytest.approx(b) for a, b in zip(rows, want))


def textbook(own, word):
    """Log sums at every position of a word, by every slice that may be a piece."""
    known, at = dict(zip(own.given.names, own.logs[:, 0].tolist())), [0.0]
    for j in range(1, len(word) + 1):
        at.append(float(np.logaddexp.reduce([at[i] + known[word[i:j]] for i in range(max(0, j - own.longest), j) if word[i:j] in known])))
    return at


@pytest.mark.parametrize("window", [1, 7, 300])
def test_a_long_word_in_windows_equals_the_textbook_sum(monkeypatch, window):
    rng = random.Random(window)
    monkeypatch.setattr(lattice, "WINDOW", window)
    own = lattice.Lattice(lattice.pieces(vocabulary("byte_bpe_50k.tiktoken")))
    for letters in ("the quick".replace(" ", ""), "x", "日本語テキスト", "0123456789abcdef"):
        word = b" " + "".join(rng.choices(letters, k=200)).encode()
        assert own.one(word, 0) == pytest.approx(textbook(own, word))
        alone, batched = (np.zeros(len(own.logs)) for _ in range(2))
        own._expected_one(word, 0, alone)
        monkeypatch.setattr(lattice, "LONG", 1 << 20)
        own.expected([word], 0, batched)
        batched[-1] -= 1
        assert alone == pytest.approx(batched)


def test_a_word_of_a_megabyte_takes_seconds():
    own = lattice.Lattice(lattice.pieces(vocabulary("byte_bpe_50k.tiktoken")))
    rng, began = random.Random(1), time.process_time()
    word = b" " + bytes(rng.choices(b"etaoinshrdlu", k=1 << 20))
    assert math.isfinite(own.one(word, 0)[-1]) and time.process_time() - began < 30


def test_lattice_of_a_public_vocabulary(spark):
    pieces = lattice.pieces(vocabulary("byte_bpe_50k.tiktoken"))
    first = pieces.begins()
    assert np.exp(pieces.logs[first]).sum() == pytest.approx(1)
    assert np.exp(pieces.logs[~first]).sum() == pytest.approx(1)
    assert max(map(len, pieces.names)) > 16 and b" the" in pieces.names
    own = lattice.Lattice(pieces)
    words = [b" the", " übermäßig".encode(), b" " + b"x" * 5000, b" " + bytes(range(128, 200))]
    assert own.forward(words)[:, 0] == pytest.approx([textbook(own, w)[-1] + own.logs[-1, 0] for w in words])
    assert lattice.score(spark.createDataFrame([], "doc_id long, text string, lang string"), pieces).count() == 0
    long = spark.createDataFrame([(0, "word " * 300_000, "a"), (1, "y" * 300_000, None), (1, "y" * 300_000, None)], "doc_id long, text string, lang string")
    rows = lattice.score(long, pieces).collect()
    assert sorted(r.n_tokens for r in rows) == [2, 2, 300_001] and all(math.isfinite(r.score) for r in rows)


def test_lattice_sums_all_segmentations():
    rng = random.Random(5)
    own = lattice.Lattice(lattice.trie({b" ": 1.0, b" a": 2.0, b" ab": 2.5, b"a": 1.0, b"b": 1.5, b"ab": 2.0, b"ba": 2.2}))
    words = [b" " + bytes(rng.choices(b"ab", k=rng.randint(1, 9))) for _ in range(40)]
    p = dict(zip(own.given.names, np.exp(own.logs[:, 0]).tolist()))
    assert own.forward(words)[:, 0] == pytest.approx([math.log(sum(math.prod(p[x] for x in s) for s in segmentations(w, p))) + own.logs[-1, 0] for w in words])
    into = np.zeros(8)
    own.expected(words, 0, into)
    assert sum(n * len(x) for x, n in zip(own.given.names, into)) == pytest.approx(sum(map(len, words))) and into[-1] == 40


def test_licenses(spark):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choices(["alpha", "beta", "licensed", "under", "the", "work"], k=n))
    docs, want = [None, "", "License"], set()
    for i, (name, t) in enumerate(licenses.TEMPLATES.items()):
        docs += [f"{say(30 + i)}\n{t.upper()} {say(40)}", t, f"{t}\n{say(100)}\n{t}"]
        want |= {(len(docs) - 3, name), (len(docs) - 2, name), (len(docs) - 1, name)}
        w = t.split()
        if len(w) > 40:
            w[len(w) // 2] = "changed"
            docs.append(" ".join(w))
            want.add((len(docs) - 1, name))
    docs += [say(2000)]
    rows = licenses.scan(spark.createDataFrame([(i, t, "l") for i, t in enumerate(docs)], "doc_id long, text string, license string")).collect()
    # exactly its own identifier, siblings and parts of it not
    assert {(r.doc_id, r.license) for r in rows} == want


def test_license_siblings(spark):
    gpl = licenses.TEMPLATES["GPL-3.0 line"]
    bsd = licenses.TEMPLATES["BSD-3-Clause"]
    docs = {gpl: "GPL-3.0 line", gpl.replace("3", "2"): "GPL-2.0 line", gpl.replace("3", "4"): None, bsd: "BSD-3-Clause", bsd.replace("Redistributions of source", "1. Redistributions of source"): "BSD-3-Clause", bsd.replace("Neither the name of the copyright holder", "Neither the name of ACME"): "BSD-3-Clause"}
    docs |= {f"{licenses.TEMPLATES['MIT']} {licenses.TEMPLATES['MIT permission']}": "MIT"}
    rows = licenses.scan(spark.createDataFrame([*enumerate(docs)], "doc_id long, text string")).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, set()).add(r.license)
    assert [got.get(i, {None}) for i in range(6)] == [{x} for x in [*docs.values()][:6]] and got[6] == {"MIT", "MIT permission"}


def plain_containment(words, template):
    """The largest share of the template's distinct shingles in any run of words as long as the template, or a quarter longer."""
    pairs = lambda w: [*zip(w, w[1:])]
    want, n = {*pairs(template)}, len(template)
    return max((len(want & {*pairs(words[i : i + n + n // 4])}) / len(want) for i in range(max(1, len(words) - n + 1))), default=0)


def test_license_recall(spark):
    """Copies with words changed, dropped and added, against exact containment at every offset."""
    rng = random.Random(16)
    words = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", t.translate(AZ))
    names, docs, planted = [*licenses.TEMPLATES], [], []
    for i in range(300):
        planted.append(rng.choice(names))
        w = words(licenses.TEMPLATES[planted[-1]])
        for _ in range(rng.randint(0, max(1, len(w) // 14))):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], ["zz"], [w[at], "yy"]])
        docs.append([*rng.choices(["alpha", "under", "the", "license"], k=rng.randint(0, 50)), *w, *rng.choices(["beta", "of", "gamma"], k=rng.randint(0, 50))])
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    got = {(r.doc_id, r.license) for r in licenses.scan(df).collect()}
    held = {(i, n) for i, (w, n) in enumerate(zip(docs, planted)) if plain_containment(w, words(licenses.TEMPLATES[n])) >= licenses.CONTAINMENT}
    # found as what they are (an edit may take the one word that tells), and hardly anything else
    assert len(held) > 250 and len(held - got) <= 0.05 * len(held) and len(got - {*enumerate(planted)}) <= 0.05 * len(got)


@pytest.mark.parametrize("times", [1, 2, 3, 7])
def test_neighbouring_copies(spark, times):
    line = "Released under the MIT License. "
    rows = licenses.scan(spark.createDataFrame([(1, line * times), (None, line * times), (1, f"under the {line * times} the mit"), (2, "x " * 300_000 + line)], "doc_id long, text string")).where("license = 'MIT line'").collect()
    assert Counter(r.doc_id for r in rows) == {1: 2 * times, None: times, 2: 1}
    assert sorted((r.start_word, r.end_word) for r in rows if r.doc_id is None) == [(5 * i, 5 * i + 5) for i in range(times)]
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pages(spark):
    page = '<html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav><div class="cookie-notice"><p>We use cookies everywhere</p></div><div id="wrap"><div class="sideBar"><p>About us and more</p></div><article><h1>Head &amp; line</h1><p>First <b>bold</b>   text\nhere<p>Second &lt;one&gt; 3 < 4</p><ul><li>Item<li>Other</ul><script>var t="</p>"</script><form><p>Name</p></form></article><section class="comments"><p>What a long and winding comment this is, dear reader, indeed.</p></section></div><footer>&copy; me</footer></body></html>'
    cases = {page: "Head & line\nFirst bold text here\nSecond <one> 3 < 4\nItem\nOther", "": "", "<p>Only": "Only", "no tags &amp; so on": "no tags & so on", "<div><p>cut off <b": "cut off", "<nav>menu</nav>": ""}
    df = spark.createDataFrame([(i, f"u{i}", h, "t") for i, h in enumerate([*cases, None])], "page_id long, url string, html string, text string")
    rows = htmltext.extract(df).orderBy("page_id").collect()
    twice = htmltext.extract(df.where("page_id = 0").union(df.where("page_id = 0").withColumn("page_id", F.lit(None).cast("long")))).collect()
    assert [r.text for r in twice] == [cases[page]] * 2 and htmltext.extract(df.limit(0)).count() == 0
    assert [r.text for r in rows] == [*cases.values(), ""] and all(r.n_chars == len(r.text) for r in rows)
    htmltext.main_text("<div>" * 3000 + "deep" + "</p>" * 10)


def test_long_and_deep_pages():
    """Time in proportion to the page, whatever its tags are."""
    import time

    began = time.monotonic()
    text = "The one paragraph of a page that is otherwise noise, and long enough."
    pages = ["<b>" * 150_000 + "</i>" * 150_000 + text, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000 + text, "<b>" * 80_000 + "<td>" * 80_000 + text, "<div>" * 100_000 + text, "<a href='x" * 60_000 + "'>" + text, '<a b="' * 60_000 + ">" + text, "<p>" * 200_000 + text, "<!-- " + "x" * 10**6 + " -->" + text, f'<img src="data:{"A" * 900_000}">{text}', "<li>" * 150_000 + text, "< " * 300_000 + text]
    for page in pages:
        assert htmltext.main_text(page).endswith(text) or page.startswith("<a"), page[:20]
    assert time.monotonic() - began < 40


def test_densities():
    """Counts, densities and sums of a small tree, computed apart."""
    page = "<div><p>one two <a>three</a></p><p>four</p><ul><li><a>five</a></li></ul></div>"
    order = htmltext.measure(htmltext.parse(page))
    root = order[0]
    got = {(n.name, n.chars, n.tags, n.link_chars, n.link_tags) for n in order}
    assert got == {("html", 20, 8, 9, 2), ("body", 20, 7, 9, 2), ("div", 20, 6, 9, 2), ("p", 12, 1, 5, 1), ("a", 5, 0, 5, 0), ("p", 4, 0, 0, 0), ("ul", 4, 2, 4, 1), ("li", 4, 1, 4, 1), ("a", 4, 0, 4, 0)}
    share = 9 / 20

    def density(c, t, lc, lt):
        t = max(t, 1)
        return c / t * math.log(max(c / max(lc, 1) * t / max(lt, 1), 1) + math.e - 1) / math.log(c / max(c - lc, 1) * lc + share * c + math.e)

    assert all(n.density == pytest.approx(density(n.chars, n.tags, n.link_chars, n.link_tags)) for n in order)
    div = next(n for n in order if n.name == "div")
    assert div.total == pytest.approx(density(12, 1, 5, 1) + density(4, 0, 0, 0) + density(4, 2, 4, 1)) and root.total == pytest.approx(root.parts[0].density)


def test_names_that_tell_nothing():
    first, second = "The first paragraph of the text, which is long enough.", "The second one, with as many words as it takes."
    for wrapper in ('<div class="layout with-sidebar">', '<div id="page" class="has-header">', '<div class="post no-comments">', '<div class="side-by-side">'):
        assert htmltext.main_text(f"<body>{wrapper}<p>{first}</p><p>{second}</p></div></body>") == f"{first}\n{second}"
    assert htmltext.main_text(f'<body><p>{first}</p><p class="ad-free">{second}</p><p class="ad">{first}</p></body>') == f"{first}\n{second}"


@pytest.mark.parametrize("wrapper", ['div class="content-sidebar-wrap"', 'div id="page" class="has-sidebar"', 'div class="post no-comments"', 'section class="related-work"'])
def test_wrappers_with_words_of_clutter(wrapper):
    first, second = "The first paragraph of the text, which is long enough.", "The second one, with as many words as it takes."
    side = '<div class="sidebar"><p>About us and more</p></div>'
    end = f"</{wrapper.split()[0]}>"
    assert htmltext.main_text(f"<body><{wrapper}>{side}<p>{first}</p><p>{second}</p>{end}</body>") == f"{first}\n{second}"
    assert htmltext.main_text(f"<body><{wrapper}>{side}<article><p>{first}</p><p>{second}</p></article>{end}</body>") == f"{first}\n{second}"
    few = f"<body><{wrapper}><article><p>{first}</p></article>{end}<div><a href='/'>{second * 9}</a></div></body>"
    assert htmltext.main_text(few).startswith(first)
    assert htmltext.main_text(f'<body><div class="ad">{second * 9}</div><{wrapper}><article><p>{first}</p></article>{end}</body>').endswith(first)
    assert htmltext.main_text(f'<body><div class="ad">{second * 9}</div><article><p>{first}</p></article></body>') == first
