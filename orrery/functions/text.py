"""Column functions that clean and parse raw cells. All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens that a default CSV reader takes as missing (fixed values).
NA_TOKENS = ("", "NA", "N/A", "null", "None", "NaN", "nan", "NULL", "#N/A", "n/a", "<NA>", "-nan", "-NaN", "#NA", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN", "#N/A N/A")
_NUMBER = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def maybe(df: DataFrame, name: str) -> Column:
    """The column if the table has it, else null: missing columns count as empty cells."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def is_empty(c: Column | str) -> Column:
    """Null, blank, or 'nan' in any case."""
    s = strip(c)
    return F.coalesce((s == "") | (F.lower(s) == "nan"), F.lit(True))


def norm(c: Column | str) -> Column:
    """The stripped cell, null if it is empty."""
    return F.when(~is_empty(c), strip(c))


def na_to_null(c: Column | str) -> Column:
    """Null for the tokens that a default CSV reader takes as missing."""
    return F.when(~col(c).isin(*NA_TOKENS), col(c))


def blank_count(c: Column | str) -> Column:
    """Whether a cell counts as filled in completeness checks: not blank; the text 'nan' does count."""
    return F.coalesce(strip(c) != "", F.lit(False))


def lex_integer(c: Column | str) -> Column:
    """The cell as a whole number (comma as point, cut towards 0), null if it isn't a number."""
    s = F.replace(strip(c), F.lit(","), F.lit("."))
    return F.when(s.rlike(_NUMBER), s.try_cast("double").try_cast("bigint"))


def lex_decimal(c: Column | str) -> Column:
    """The first number anywhere in the cell, comma as point, as it is written; null if there is none."""
    found = F.regexp_extract(col(c), r"[-+]?\d+(?:[.,]\d+)?", 0)
    return F.nullif(F.replace(found, F.lit(","), F.lit(".")), F.lit(""))


def wkt_point(x: Column | str, y: Column | str) -> Column:
    """POINT(x y), null if a coordinate can't be read or both are 0."""
    lon, lat = lex_decimal(x), lex_decimal(y)
    zero = (lon.try_cast("double") == 0) & (lat.try_cast("double") == 0)
    return F.when(lon.isNotNull() & lat.isNotNull() & ~zero, F.concat(F.lit("POINT("), lon, F.lit(" "), lat, F.lit(")")))


def band(metres: Column | str, located: Column, high: str = "high", medium: str = "medium", low: str = "low", dubious: str = "dubious") -> Column:
    """Certainty from accuracy: 0 high, below 500 medium, from 500 low; medium if missing, dubious without a place."""
    # as a list of one, so that the cell is parsed once for all cases
    level = lambda n: F.when(n.isNull(), medium).when(n == 0, high).when(n < 500, medium).otherwise(low)
    return F.when(~located, dubious).otherwise(F.get(F.transform(F.array(lex_decimal(metres).try_cast("decimal(38,10)")), level), F.lit(0)))


def hash8(c: Column | str) -> Column:
    return F.substring(F.md5(col(c).cast("binary")), 1, 8)


def minted(base: str, prefix: str, label: Column | str) -> Column:
    """The IRI of a node that is known by its label."""
    return F.concat(F.lit(f"{base}{prefix}_"), hash8(label))


def strip_prefixes(c: Column | str, patterns: list[str]) -> tuple[Column, Column]:
    """(text without the prefixes, note of those removed): regular expressions, without case, one after another."""
    text, notes = strip(c), []
    for p in patterns:
        p = f"(?i)^{p}"
        notes.append(F.when(text.rlike(p), F.concat(F.lit("removed '"), strip(F.regexp_extract(text, p, 0)), F.lit("'"))))
        text = strip(F.regexp_replace(text, p, ""))
    return text, F.concat_ws("; ", *notes)


def rename_prefix(c: Column | str, pattern: str, to: str) -> Column:
    """`pow. X` -> `Powiat X` and the like."""
    return F.regexp_replace(col(c), f"(?i)^{pattern}", to)


def sorted_tokens(c: Column | str) -> Column:
    """Words in order, joined by single spaces."""
    return F.array_join(F.array_sort(F.filter(F.split(col(c), r"(?U)\s+"), lambda t: t != "")), " ")


def lcs_length(a: Column | str, b: Column | str) -> Column:
    """Length of the longest common subsequence: one pass over the letters of a, each folding b into the next row."""
    a, b = col(a), col(b)
    ys = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(b), F.lit(1))), lambda i: F.substr(b, i, F.lit(1)))
    xs = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(a), F.lit(1))), lambda i: F.substr(a, i, F.lit(1)))
    zero = F.transform(F.concat(F.array(F.lit("")), ys), lambda _: F.lit(0))

    def row(before: Column, x: Column) -> Column:
        def cell(now: Column, j: Column) -> Column:
            best = F.when(F.get(ys, j) == x, F.get(before, j) + 1).otherwise(F.greatest(F.get(before, j + 1), F.element_at(now, -1)))
            return F.concat(now, F.array(best))

        return F.aggregate(F.sequence(F.lit(0), F.size(ys) - 1), F.array(F.lit(0)), cell)

    found = F.element_at(F.aggregate(xs, zero, row), -1)
    return F.when((a == "") | (b == ""), 0).otherwise(found)


def indel_ratio(a: Column | str, b: Column | str) -> Column:
    """2 LCS / (m + n), 1 for two empty texts; rounded to 4 places."""
    a, b = col(a), col(b)
    total = F.char_length(a) + F.char_length(b)
    return F.when(total == 0, 1.0).when(a == b, 1.0).otherwise(F.round(2.0 * lcs_length(a, b) / total, 4))


def token_sort_ratio(a: Column | str, b: Column | str) -> Column:
    return indel_ratio(sorted_tokens(a), sorted_tokens(b))


def variants(c: Column | str, suffixes: str) -> Column:
    """A label and its shorter forms, in order: X of `X bei Y`, `X (Y)`, `X zu Y`, and `X-suffix` for known suffixes."""
    c = col(c)
    patterns = [r"^(.+?)\s+bei\s+.+$", r"^(.+?)\s*\([^)]*\)\s*$", r"^(.+?)\s+zu\s+.+$", rf"^(.+?)-(?:{suffixes})$"]
    short = [F.when(c.rlike(f"(?i){p}"), strip(F.regexp_extract(c, f"(?i){p}", 1))) for p in patterns]
    return F.array_distinct(F.array_compact(F.array(c, *short)))


def split_list(c: Column | str, separator: str = r"\|") -> Column:
    """Stripped non-empty parts."""
    return F.filter(F.transform(F.split(col(c), separator), strip), lambda x: x != "")


def last_part(c: Column | str) -> Column:
    """What follows the last slash."""
    return F.substring_index(col(c), "/", -1)


def uncertain(c: Column | str) -> Column:
    return col(c).contains("?")


def match_predicate(c: Column | str, base: str) -> Column:
    """exactMatch, closeMatch or relatedMatch; anything else is related."""
    return F.concat(F.lit(base), F.when(col(c).isin("exactMatch", "closeMatch"), col(c)).otherwise("relatedMatch"))


def shorten(c: Column | str, prefixes: list[tuple[str, str]], most: int = 80) -> Column:
    """An IRI by the first prefix that fits, else <...> if short, else its last part."""
    c = col(c)
    rest = F.when(F.char_length(c) < most, F.concat(F.lit("<"), c, F.lit(">"))).otherwise(F.regexp_extract(c, "([^/#]*)$", 1))
    return reduce(lambda out, p: F.when(c.startswith(p[0]), F.concat(F.lit(f"{p[1]}:"), F.substr(c, F.lit(len(p[0]) + 1)))).otherwise(out), reversed(prefixes), rest)


def document_tokens(c: Column | str) -> Column:
    """Terms of a documentation cell: without (+...), ** and back-ticks, split at arrows, commas and slashes."""
    c = F.regexp_replace(F.regexp_replace(col(c), r"\(\+[^)]*\)", ""), r"\*\*|`", "")
    return split_list(c, r"→|,|/")


def run_stamp(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH-mm-ss'Z'")


def iso_stamp(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def conforming_status(mapped: Column | str, current: Column | str) -> Column:
    """noop, filled, confirmed or overwritten: what a looked-up value does to a cell."""
    mapped, current = col(mapped), F.coalesce(strip(current), F.lit(""))
    return F.when(mapped.isNull(), "noop").when(current.isin("", "nan"), "filled").when(current == mapped, "confirmed").otherwise("overwritten")
