"""Entity resolution: label indexes, aliases and overrides, scoped fuzzy matching, and the containment fallback.

Every distinct value is matched once, within its scope's candidates only (an equi-join), and joined back. Ratios are
taken in Arrow, a group of values against a block of labels at a time, in a tree of the labels' beginnings where they share
enough of them (lcs.Index); an index is stored and counted first, to see whether the keys of its blocks are few enough to send out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions import lcs
from orrery.functions.text import is_empty, sorted_tokens, strip, token_sort_ratio, variants
from orrery.operators.graph import closure, stored

IDS = ("geonames", "tgn", "idai", "osm_relation")
#: What a match gives, in the order of the output columns.
RESULT = ("qid", "geonames", "match_label", "score", "reason", "tgn", "idai", "osm_relation")


def label_index(labels: DataFrame, *scope: str) -> DataFrame:
    """(scope, key, qid, label, source, ids): one row a lower-cased label; the first item wins, each id is the first that any row has.

    `labels` has item, label, label_type, ids and ord, which makes "first" defined.
    """
    own = labels.withColumn("key", F.lower(strip("label")))
    preferred = F.col("label_type") == "rdfs:label"
    order = F.struct("ord", "item")
    first = lambda c, where=None: F.min_by(F.when(where, F.col(c)) if where is not None else F.col(c), F.when(where, order) if where is not None else order)
    ids = [first(c, ~is_empty(c)).alias(c) for c in IDS if c in labels.columns]
    # the display label is that of the last preferred row, else of the first row
    shown = F.coalesce(F.max_by(F.when(preferred, F.col("label")), F.when(preferred, order)), first("label")).alias("label")
    source = F.when(F.max(preferred.cast("int")) == 1, "rdfs:label").otherwise(first("label_type")).alias("source")
    return own.groupBy(*scope, "key").agg(first("item").alias("qid"), shown, source, *ids, F.min("ord").alias("ord"))


def candidates(labels: DataFrame, langs: list[str], shortest: dict[str, int], classes: list[str] | None = None) -> DataFrame:
    """The labels that an index is made of: by language, class and least length for each kind of label, without ended items."""
    length = F.char_length("label")
    long_enough = F.lit(False)
    for kind, n in shortest.items():
        long_enough = long_enough | ((F.col("label_type") == kind) & (length > n))
    ended = labels.where("ended").select("item").distinct()
    own = labels.where(F.col("lang").isin(*langs) & long_enough)
    if classes:
        own = own.where(F.col("class").isin(*classes))
    return own.join(ended, "item", "left_anti")


def aliased(values: DataFrame, raw: str, prefixes: list[str], aliases: dict[str, str], normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """`values` with `name` (prefixes stripped, then renamed by `normalise`, then by alias on the lower-cased text) and `note`."""
    from orrery.functions.text import strip_prefixes
    from orrery.operators.tables import pairs, small

    name, note = strip_prefixes(raw, prefixes)
    name = normalise(name) if normalise else name
    table = small(pairs(values.sparkSession, aliases, "_alias", "_to"), len(aliases))
    out = values.withColumns({"_name": name, "_note": note}).join(table, F.lower("_name") == F.col("_alias"), "left")
    notes = F.concat_ws("; ", F.when(F.col("_note") != "", F.col("_note")), F.when(F.col("_to").isNotNull(), F.concat(F.lit("alias '"), F.col("_name"), F.lit("'"))))
    return out.withColumns({"name": F.coalesce("_to", "_name"), "note": notes}).drop("_name", "_note", "_alias", "_to")


def overridden(values: DataFrame, overrides: DataFrame) -> DataFrame:
    """Results of the values whose lower-cased name has an override (key, qid, label, ids): score 1."""
    ids = [c for c in IDS if c in overrides.columns]
    hit = values.join(overrides, F.lower("name") == F.col("key"))
    reason = F.concat(F.lit("Direct override | '"), F.col("raw"), F.lit("' -> QID="), F.col("qid"), F.when(F.col("note") != "", F.concat(F.lit(" | ["), F.col("note"), F.lit("]"))).otherwise(""))
    return hit.select("raw", "qid", F.col("label").alias("match_label"), F.lit(1.0).alias("score"), reason.alias("reason"), *ids)


#: Labels of a block, values that meet it at once, and blocks whose keys are broadcast at most.
BLOCK, VALUES, SMALL_INDEX = 1 << 16, 512, 100_000
_HIT = "key string, ord long, points int, compared long"


def _numbered(df: DataFrame, by: list[str], most: int, name: str, key: str) -> DataFrame:
    """`df` with a part number, such that about `most` rows share `by` and the number."""
    sizes = df.groupBy(*by).agg(F.ceil(F.count("*") / most).alias("_parts"))
    return df.join(sizes, by).withColumn(name, F.pmod(F.xxhash64(key), F.col("_parts")).cast("int")).drop("_parts")


def label_blocks(labels: DataFrame, scope: list[str]) -> DataFrame:
    """(scope, size, part, labels): the labels (key, ord, _b) of each scope and length, in blocks of about BLOCK; a scope that fits a block is one, of size -1."""
    n = labels.groupBy(*scope).agg(F.count("*").alias("_n"))
    sized = labels.join(n, scope).withColumn("size", F.when(F.col("_n") <= BLOCK, -1).otherwise(F.char_length("_b"))).drop("_n")
    return _numbered(sized, [*scope, "size"], BLOCK, "part", "key").groupBy(*scope, "size", "part").agg(F.collect_list(F.struct("ord", "key", "_b")).alias("labels"))


def _compared(asked: DataFrame, blocks: DataFrame, scope: list[str], few: bool, tasks: int) -> DataFrame:
    """(scope, _query, _HIT): for values (_query, _a, least, before) and blocks of one length, the best label of each block that has more points than `least`, or as many and an ord of `before` at most (null: any).

    `only` names the one part of that length that a value meets, `skip` one that it doesn't (-1: none). `compared` counts the labels that a value was held
    against, letters of beginnings added up to whole labels. A block lies before the groups of values that meet it, so that its labels are sent once and a task holds
    those of one block.
    """
    by = [*scope, "size"]
    kinds = {f.name: f.dataType.simpleString() for f in asked.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ords, index = [], np.zeros(0, np.int64), None
        for batch in batches:
            of_values, of_labels = batch.column("values"), batch.column("labels")
            for row in range(batch.num_rows):
                if not of_values[row].is_valid:
                    held = of_labels[row].values
                    keys, texts, ords = held.field("key").to_pylist(), held.field("_b").to_pylist(), held.field("ord").to_numpy(zero_copy_only=False)
                    # the lower ord is first, then the larger key
                    order = sorted(range(len(keys)), key=keys.__getitem__, reverse=True)
                    order = np.array(order)[np.argsort(ords[order], kind="stable")]
                    keys, texts, ords = [keys[i] for i in order], [texts[i] for i in order], ords[order]
                    index = lcs.Index(texts, np.arange(len(texts)))
                    continue
                asked_ = of_values[row].values
                before = [len(ords) if x is None else int(np.searchsorted(ords, x, side="right")) for x in asked_.field("before").to_pylist()]
                points, ranks, compared = index.best(asked_.field("_a").to_pylist(), asked_.field("least").to_numpy(zero_copy_only=False), np.array(before))
                own = [pa.array([batch.column(c)[row].as_py()] * len(ranks), to.field(c).type) for c in scope]
                found = [(keys[i], int(ords[i])) if i >= 0 else (None, None) for i in ranks.tolist()]
                rest = [pa.array([k for k, _ in found], pa.string()), pa.array([o for _, o in found], pa.int64()), pa.array(points, pa.int32()), pa.array(compared, pa.int64())]
                yield pa.RecordBatch.from_arrays([*own, asked_.field("_query").cast(pa.string()), *rest], schema=to)

    to = pa.schema([(c, _ARROW.get(kinds[c], pa.string())) for c in scope] + [("_query", pa.string()), ("key", pa.string()), ("ord", pa.int64()), ("points", pa.int32()), ("compared", pa.int64())])
    which = [*by, "only", "skip"]
    groups = _numbered(asked, which, VALUES, "_group", "_query").groupBy(*which, "_group").agg(F.collect_list(F.struct("_query", "_a", "least", "before")).alias("values"))
    keys = blocks.select(*by, "part")
    met = groups.join(F.broadcast(keys) if few else keys, by).where("(only < 0 or part = only) and part <> skip")
    first = blocks.select(*by, "part", F.lit(None).cast(groups.schema["values"].dataType).alias("values"), "labels")
    rows = first.unionByName(met.select(*by, "part", "values", F.lit(None).cast(blocks.schema["labels"].dataType).alias("labels")))
    dealt = rows.repartition(min(tasks, int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *by, "part").sortWithinPartitions(*by, "part", F.col("values").isNotNull())
    return dealt.select(*scope, "values", "labels").mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in scope), "_query string", _HIT]))


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "smallint": pa.int16()}


def _reach(a: Column, b: Column) -> Column:
    """The points that texts of these lengths can't exceed."""
    total, common = a + b, F.least(a, b)
    return F.when(total == 0, 10_000).otherwise(F.floor((40_000 * common + total) / (2 * total)))


def searched(asked: DataFrame, labels: DataFrame, scope: list[str]) -> DataFrame:
    """(scope, _query, key, ord, points, compared): candidates for each value's best label of its scope, the best among them, and how many labels were compared.

    Labels lie in blocks of one scope and length. A value first meets one block of the length that is nearest to its own; the
    best of it is what to reach in the other blocks of that length, and the best of both says which other lengths can
    still hold as good a label. Nothing is pruned that could be the best, whatever the threshold; equal scores are kept
    apart by ord and key.
    """
    blocks = stored(label_blocks(labels.select(*scope, "key", "ord", "_b"), scope))
    of_size = blocks.groupBy(*scope, "size").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    sizes = of_size.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct("size", "parts"))).alias("sizes"))
    there = blocks.agg(F.count("*").alias("blocks")).first(), sizes.agg(F.max(F.size("sizes")).alias("sizes"), F.max(F.array_max(F.transform("sizes", lambda s: F.size(s["parts"])))).alias("blocks")).first()
    few = there[0]["blocks"] <= SMALL_INDEX
    # a block lies in one task, so that more of them would start for nothing
    tasks = max(1, 2 * there[0]["blocks"])
    own = F.char_length("_a")
    near = F.array_min(F.transform("sizes", lambda s: F.struct(F.abs(s["size"] - own).alias("off"), s["size"].alias("size"), s["parts"].alias("parts"))))
    # values are dealt over the blocks of their length
    one = F.element_at("near.parts", (F.pmod(F.xxhash64("_query"), F.size("near.parts")) + 1).cast("int"))
    known = asked.join(F.broadcast(sizes) if few else sizes, scope).withColumn("near", near).withColumns({"home": F.col("near.size"), "first": one, "blocks": F.size("near.parts")}).drop("near")
    columns = [*scope, "size", "only", "skip", "_query", "_a", "least", "before"]
    none = F.lit(-1)

    def best(df: DataFrame) -> DataFrame:
        m = F.max(F.struct("points", (-F.col("ord")).alias("first")))
        return df.groupBy(*scope, "_query").agg(m.alias("m")).select(*scope, "_query", F.col("m.points").cast("int").alias("least"), (-F.col("m.first")).alias("before"))

    known = stored(known)
    start = {"size": F.col("home"), "only": F.col("first"), "skip": none, "least": F.lit(0), "before": F.lit(None).cast("long")}
    found = stored(_compared(known.withColumns(start).select(*columns), blocks, scope, few, tasks))
    if (there[1]["blocks"] or 0) > 1:
        more = known.where("blocks > 1").join(best(found), [*scope, "_query"]).withColumns({"size": F.col("home"), "only": none, "skip": F.col("first")})
        found = stored(found.unionByName(_compared(more.select(*columns), blocks, scope, few, tasks)))
    if (there[1]["sizes"] or 0) > 1:
        others = F.explode(F.filter(F.transform("sizes", lambda s: s["size"]), lambda s: (s != F.col("home")) & (_reach(s, own) >= F.col("least"))))
        open_ = known.join(best(found), [*scope, "_query"]).withColumns({"size": others, "only": none, "skip": none})
        found = found.unionByName(_compared(open_.select(*columns), blocks, scope, few, tasks))
    return found


def best_match(values: DataFrame, index: DataFrame, scope: list[str], threshold: float, scope_name: str = "global index") -> DataFrame:
    """(raw, scope, RESULT): each value's best candidate by token-sort ratio within its scope; ties go to the lower ord, then the larger key.

    Below the threshold there is no match, but the score and the reason stay. A value without candidates says so.
    Values that equal a label (but for the order of words) meet it by a join; only the others are searched for, among the
    labels of their scope, or without one in the whole index.
    """
    keyed = values.withColumn("_query", F.lower(strip("name")))
    ids = [c for c in IDS if c in index.columns]
    index = stored(index.withColumn("_b", sorted_tokens("key")))
    labels = index.select(*scope, "key", F.col("ord").cast("long").alias("ord"), "_b")
    asked = keyed.select("_query", *scope).where("_query is not null").distinct().withColumn("_a", sorted_tokens("_query"))
    same = asked.join(labels.withColumnRenamed("_b", "_a"), ["_a", *scope]).select("_query", *scope, "key", "ord", F.lit(10_000).alias("points"))
    rest = asked.join(same.select("_query", *scope).distinct(), ["_query", *scope], "left_anti")
    # without a scope all values and labels have the same one
    one = scope or ["_all"]
    all_ = (lambda df: df) if scope else (lambda df: df.withColumn("_all", F.lit(0)))
    found = searched(all_(rest), all_(labels), one).where("key is not null")
    scored = same.unionByName(found.select("_query", *scope, "key", "ord", "points"))
    best = scored.groupBy("_query", *scope).agg(F.max(F.struct("points", (-F.col("ord")).alias("first"), "key")).alias("m"))
    best = best.select("_query", *scope, F.col("m.key").alias("key"), (F.col("m.points") / 10_000.0).alias("score"))
    best = best.join(index.drop("ord", "_b"), ["key", *scope]).select("_query", *scope, F.struct("score", "key", "qid", "label", "source", *ids).alias("m"))
    out = keyed.join(best, ["_query", *scope], "left")
    ok = F.col("m.score") >= threshold
    kind = F.when(F.col("_query") == F.col("m.key"), "Exact match").otherwise(F.format_string("Fuzzy match (score=%.2f)", "m.score"))
    said = F.concat_ws(" | ", F.concat(kind, F.lit(" via "), F.col("m.source"), F.lit(f" [{scope_name}]")), F.concat(F.lit("'"), F.col("name"), F.lit("' -> '"), F.col("m.label"), F.lit("'")), F.when(F.col("note") != "", F.concat(F.lit("[normalised: "), F.col("note"), F.lit("]"))))
    below = F.format_string(f"Best candidate '%s' scored %.2f, below threshold {threshold}", "m.label", "m.score")
    reason = F.when(F.col("m").isNull(), "No candidates in index").when(ok, said).otherwise(below)
    return out.select("raw", *scope, F.when(ok, F.col("m.qid")).alias("qid"), F.when(ok, F.col("m.label")).alias("match_label"), F.col("m.score").alias("score"), reason.alias("reason"), *(F.when(ok, F.col(f"m.{c}")).alias(c) for c in ids))


def once(values: DataFrame, raw: str, *order: str) -> DataFrame:
    """One row a raw value: that of its first scope in order."""
    w = Window.partitionBy(raw).orderBy(*order)
    return values.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def widened(values: DataFrame, index: DataFrame, scope: str, wider: str) -> DataFrame:
    """`values` with the wider scope where the index has nothing for the narrow one."""
    known = index.select(F.col(scope).alias("_known")).distinct()
    out = values.join(known, F.col(scope) == F.col("_known"), "left")
    return out.withColumn(scope, F.when(F.col("_known").isNotNull(), F.col(scope)).otherwise(F.col(wider))).drop("_known")


def transitive_match(values: DataFrame, labels: DataFrame, parts: DataFrame, scope: str, suffixes: str) -> DataFrame:
    """(raw, qid, match_label, score, reason): exact label at any depth below the scope, the first of the label's variants that hits.

    `parts` has (item, parent). Ties between items go to the smallest.
    """
    tried = values.select("raw", scope, "name", "note", F.posexplode(variants("name", suffixes)).alias("variant_no", "variant"))
    named = stored(tried.join(labels.select("item", "label"), F.lower("variant") == F.lower("label")))
    # only what bears one of the labels is followed upwards
    above = closure(parts.select(F.col("item").alias("child"), "parent"), named.select("item"))
    hits = named.join(above.select(F.col("node").alias("item"), F.col("ancestor").alias(scope)), ["item", scope])
    w = Window.partitionBy("raw", scope).orderBy("variant_no", "item", "label")
    first = hits.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    own = F.col("variant") == F.col("name")
    score = F.when(own & (F.lower("variant") == F.lower("label")), 1.0).when(own, 0.9).otherwise(token_sort_ratio("raw", "label"))
    kind = F.when(own & (F.lower("variant") == F.lower("label")), "Transitive P131+ exact match").when(own, "Transitive P131+ normalised match").otherwise("Transitive P131+ variant match")
    reason = F.concat(kind, F.lit(" | '"), F.col("raw"), F.lit("' -> '"), F.col("label"), F.lit("'"), F.when(F.col("note") != "", F.concat(F.lit(" | [normalised: "), F.col("note"), F.lit("]"))).otherwise(""), F.when(~own, F.concat(F.lit(" [variant: '"), F.col("variant"), F.lit("']"))).otherwise(""))
    return first.select("raw", scope, F.col("item").alias("qid"), F.col("label").alias("match_label"), score.alias("score"), reason.alias("reason"))


def two_stage(values: DataFrame, index: DataFrame, labels: DataFrame, parts: DataFrame, scope: str, threshold: float, suffixes: str) -> DataFrame:
    """best_match, then transitive_match for those without a match; what neither finds says so."""
    first = stored(best_match(values, index, [scope], threshold, scope_name=f"P131={scope}"))
    open_ = values.join(first.where("qid is null").select("raw", scope), ["raw", scope], "left_semi")
    second = transitive_match(open_, labels, parts, scope, suffixes)
    none = open_.join(second.select("raw", scope), ["raw", scope], "left_anti").select("raw", scope, F.lit("No match in Stage 1 (fuzzy) or Stage 2 (transitive P131+)").alias("reason"))
    return first.where("qid is not null").unionByName(second, allowMissingColumns=True).unionByName(none, allowMissingColumns=True)


def appended(df: DataFrame, column: str, results: DataFrame, scope: dict[str, str] | None = None) -> DataFrame:
    """`df` with the columns <column>_<result> of each row's value; values that weren't matched are 'Not processed'.

    `scope` (column of df -> scope column of the results) tells results of one value in several scopes apart; without
    it a value's results are those of its first scope.
    """
    scope = scope or {}
    if not scope and (others := [c for c in results.columns if c not in ("raw", *RESULT)]):
        results = once(results, "raw", *others)
    named = results.select(F.col("raw").alias("_raw"), *(F.col(c).alias(f"_{c}") for c in scope.values()), *(F.col(c).alias(f"{column}_{c}") for c in RESULT if c in results.columns))
    on = F.col(column) == F.col("_raw")
    for own, other in scope.items():
        on = on & F.col(own).eqNullSafe(F.col(f"_{other}"))
    out = df.join(named, on, "left").drop("_raw", *(f"_{c}" for c in scope.values()))
    return out.withColumn(f"{column}_reason", F.coalesce(f"{column}_reason", F.lit("Not processed")))
