import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orrery.functions import text as X


def values(spark, fn, rows, schema="x string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(fn(*(F.col(c) for c in df.columns))).collect()]


# fixed values: documented hashes
HASHES = {
    "Deutschland": "3c2f8b8c", "Brandenburg": "2ddb2d82", "Havelland": "d4d0a03b", "Friesack": "ef3c98d9", "Behringen": "c672785b",
    "Wartburgkreis": "09060b5f", "Thüringen": "eec0c902", "Siedlung": "1972902b", "Grab": "b635ceb0", "Grab?_uncertain_54": "e5b4c377",
    "FBG": "a36e9d6d", "SBK": "cc414e20", "SBK?": "7a001224", "Q173412": "98fc5e34", "Q173387": "ddd27e7f", "Q959782": "2b73226f",
    "Ausgrabung": "1f56a08c", "Kaufmann 1976": "c5110572", "Wetzel/Beran 2023": "c54b495e", "Übernahme aus externer Datenbank": "b57e2231",
    "Printpublikation": "e6dc730e", "Strukturen des Landesdenkmalamts": "5ae20fe0",
}


def test_hashes(spark):
    assert values(spark, X.hash8, [(k,) for k in HASHES]) == [*HASHES.values()]


@pytest.mark.parametrize(
    "fn,cases",
    [
        (X.norm, {None: None, "": None, " ": None, " NaN ": None, " nan ": None, " a b ": "a b", "nano": "nano"}),
        (X.lex_decimal, {"100": "100", "12,54": "12.54", "ca. -12,50 m": "-12.50", "1.234,5": "1.234", "abc": None, " nan ": None, None: None}),
        (X.lex_integer, {"-4550": -4550, "-4550.9": -4550, "12,7": 12, "1e3": 1000, "inf": None, "x": None, None: None, "1_000": None, "9e99": None}),
        (X.uncertain, {"Grab?": True, "a?b": True, "Grab": False}),
        (X.last_part, {"http://a/entity/Q5": "Q5", "Q5": "Q5"}),
        (X.split_list, {"Q1| Q2 ||": ["Q1", "Q2"], "": []}),
        (X.na_to_null, {"NA": None, "null": None, "x": "x", "": None}),
        (lambda c: X.match_predicate(c, "k#"), {"exactMatch": "k#exactMatch", "": "k#relatedMatch", "odd": "k#relatedMatch"}),
        (lambda c: X.variants(c, "Neue Schleuse|Altstadt"), {"Grünow bei Prenzlau": ["Grünow bei Prenzlau", "Grünow"], "Frankfurt (Oder)": ["Frankfurt (Oder)", "Frankfurt"], "Berkholz zu Berkholz-Meyenburg": ["Berkholz zu Berkholz-Meyenburg", "Berkholz"], "Rathenow-Neue Schleuse": ["Rathenow-Neue Schleuse", "Rathenow"], "X": ["X"]}),
        (X.document_tokens, {"**`crm:E1`** (+2) → a/b, c": ["crm:E1", "a", "b", "c"]}),
    ],
)
def test_cells(spark, fn, cases):
    assert values(spark, fn, [(k,) for k in cases]) == [*cases.values()]


def test_points_and_bands(spark):
    cases = {("10,58", "51,03"): "POINT(10.58 51.03)", ("0", "0,0"): None, ("0", "51"): "POINT(0 51)", ("", "51"): None}
    assert values(spark, X.wkt_point, [*cases], "x string, y string") == [*cases.values()]
    bands = {"0": "high", "1": "medium", "499": "medium", "-1": "medium", "500": "low", "800": "low", "": "medium"}
    assert values(spark, lambda c: X.band(c, F.lit(True)), [(k,) for k in bands]) == [*bands.values()]
    assert values(spark, lambda c: X.band(c, F.lit(False)), [("0",)]) == ["dubious"]


def test_status(spark):
    cases = {(None, "x"): "noop", ("q", ""): "filled", ("q", "nan"): "filled", ("q", None): "filled", ("q", "q"): "confirmed", ("q", "r"): "overwritten"}
    assert values(spark, X.conforming_status, [*cases], "m string, c string") == [*cases.values()]


def test_prefixes(spark):
    df = spark.createDataFrame([("Landkreis Harz",), ("woj. Dolnośląskie",), ("pow. X",)], "x string")
    text, note = X.strip_prefixes("x", [r"landkreis\s+", r"woj\.\s*"])
    rows = df.select(X.rename_prefix(text, r"pow\.\s*", "Powiat ").alias("t"), note.alias("n")).collect()
    assert [(r.t, r.n) for r in rows] == [("Harz", "removed 'Landkreis'"), ("Dolnośląskie", "removed 'woj.'"), ("Powiat X", "")]


def test_shorten(spark):
    f = lambda c: X.shorten(c, [("http://a/", "a"), ("http://a/b#", "b")])
    assert values(spark, f, [("http://a/b#c",), ("http://z/q",), ("http://z/" + "y" * 90 + "/w",)]) == ["a:b#c", "<http://z/q>", "w"]


def indel(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
    return round(2 * row[-1] / (len(a) + len(b)), 4) if a or b else 1.0


def test_known_ratios(spark):
    cases = {("lewenstein", "levenshtein"): 0.8571, ("large bolt", "bolt large"): 1.0, ("", ""): 1.0, ("a", ""): 0.0}
    assert values(spark, X.token_sort_ratio, [*cases], "a string, b string") == [*cases.values()]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("ab cé", max_size=9), st.text("ab cé", max_size=9)), min_size=1, max_size=20))
def test_ratio_matches_definition(spark, pairs):
    got = values(spark, X.indel_ratio, pairs, "a string, b string")
    assert all(abs(x - indel(a, b)) < 2e-4 for x, (a, b) in zip(got, pairs))
