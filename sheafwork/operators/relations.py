"""References between kinds: three-valued resolution, pair catalog, direction ladder, value joins.

An edge is (from_kind, to_kind, from_id, to_id, column, mechanism, valid).  ``valid`` is true for a reference that its
target has, false for a dangling one, and null where the target has no rows at all, so that nothing can be said; null is
never folded into false.

Dimensions that callers give (pins, ledgers, surfaces) are joined without a hint: Spark broadcasts them by their measured size.  Hints
stand where rows are bounded by the number of kinds, and for carriers, prefixes and read positions: these are declared by hand and have
few different keys, so without a hint all rows of a key would be dealt to one task before the size is known.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.operators.graph import cut_lineage, places
from sheafwork.session import staged

EDGE = ["from_kind", "to_kind", "from_id", "to_id", "column", "mechanism", "valid"]


def references(df: DataFrame, from_kind: str, from_id: Column, to_kind: str, column: str) -> DataFrame:
    """The non-null references in a column of df, as edges without a verdict."""
    return df.where(F.col(column).isNotNull()).select(
        F.lit(from_kind).alias("from_kind"), F.lit(to_kind).alias("to_kind"), from_id.cast("string").alias("from_id"),
        F.col(column).cast("string").alias("to_id"), F.lit(column).alias("column"), F.lit("hard").alias("mechanism"),
    )


def all_references(df: DataFrame, from_kind: str, from_id: Column, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """references of several (to kind, column) in one scan of df."""
    cells = F.array(*[F.struct(F.lit(to).alias("to_kind"), F.col(c).cast("string").alias("to_id"), F.lit(c).alias("column")) for to, c in columns])
    out = df.select(from_id.cast("string").alias("from_id"), F.explode(cells).alias("x")).where("x.to_id IS NOT NULL")
    return out.select(F.lit(from_kind).alias("from_kind"), "x.to_kind", "from_id", "x.to_id", "x.column", F.lit("hard").alias("mechanism"))


def resolve(refs: DataFrame, ids: DataFrame, kinds: DataFrame | None = None) -> DataFrame:
    """Adds valid to refs (to_kind, to_id, ...) from ids (kind, id); kinds (kind) has the kinds with rows where ids has not all rows.

    The ids are made distinct before they are joined, so a repeated id multiplies no edge; the left join lets adaptive
    execution split a hot target.  Whether a kind has rows is one small aggregate, broadcast by its size of one row a kind."""
    ids = ids.where("id IS NOT NULL")
    known = ids.select(F.col("kind").alias("_kind"), F.col("id").cast("string").alias("_id")).distinct()
    has_rows = (ids if kinds is None else kinds).select(F.col("kind").alias("_has")).distinct()  # added up in each task, so only kinds are sent
    joined = refs.join(known, (F.col("to_kind") == F.col("_kind")) & (F.col("to_id") == F.col("_id")), "left")
    joined = joined.join(F.broadcast(has_rows), F.col("to_kind") == F.col("_has"), "left")
    return joined.withColumn("valid", F.when(F.col("_has").isNull(), F.lit(None).cast("boolean")).otherwise(F.col("_id").isNotNull())).drop("_kind", "_id", "_has")


def revalidate(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges whose verdict is null get one from ids that came in later; verdicts given before stay."""
    again = resolve(edges.withColumnRenamed("valid", "_old"), ids)
    return again.withColumn("valid", F.coalesce("_old", "valid")).drop("_old")


def cardinality(edges: Column, from_ids: Column, to_ids: Column) -> Column:
    """1:1, many:1, 1:many or many:many, from the number of edges and of different ends."""
    return (
        F.when((from_ids == edges) & (to_ids == edges), "1:1").when(from_ids == edges, "many:1").when(to_ids == edges, "1:many").otherwise("many:many")
    )


def pair_catalog(edges: DataFrame) -> DataFrame:
    """One row a (from_kind, to_kind): edges, different ends, cardinality, columns and mechanisms, verdicts."""
    edges = edges.select(*EDGE)
    distinct_ends = F.count_distinct("from_id").alias("from_ids"), F.count_distinct("to_id").alias("to_ids")
    rows = edges.groupBy("from_kind", "to_kind").agg(
        F.count("*").alias("edges"), *distinct_ends,
        F.array_join(F.sort_array(F.collect_set("column")), ",").alias("join_keys"), F.array_join(F.sort_array(F.collect_set("mechanism")), ",").alias("mechanisms"),
        F.count_if("valid").alias("valid_true"), F.count_if(~F.col("valid")).alias("valid_false"), F.count_if(F.col("valid").isNull()).alias("valid_null"),
    )
    return rows.withColumn("cardinality", cardinality(F.col("edges"), F.col("from_ids"), F.col("to_ids")))


def reference_catalog(refs: DataFrame, ids: DataFrame) -> DataFrame:
    """pair_catalog of references without verdicts yet, for large ones: see counted_catalog."""
    pair = ["from_kind", "to_kind"]
    by_target = refs.groupBy(*pair, "to_id", "column", "mechanism").agg(F.count("*").alias("n"))
    return counted_catalog(by_target, refs.select(*pair, "from_id").distinct().groupBy(*pair).agg(F.count("*").alias("from_ids")), ids)


INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


def target_counts(df: DataFrame, from_kind: str, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """(from_kind, to_kind, to_id, column, mechanism, n) of all_references, added up by target.  Each column is read and added up by
    itself, whole numbers as such: neither a row's references nor their texts are spread out before they are few."""

    def of(to: str, c: str) -> DataFrame:
        key = F.col(c) if dict(df.dtypes)[c] in INTEGRAL else F.col(c).cast("string")
        n = df.where(F.col(c).isNotNull()).groupBy(key.alias("_to")).agg(F.count("*").alias("n"))
        return n.select(F.lit(from_kind).alias("from_kind"), F.lit(to).alias("to_kind"), F.col("_to").cast("string").alias("to_id"), F.lit(c).alias("column"), F.lit("hard").alias("mechanism"), "n")

    return reduce(DataFrame.unionByName, [of(to, c) for to, c in columns])


def source_counts(df: DataFrame, from_kind: str, ids: Sequence[str], columns: Sequence[tuple[str, str]]) -> DataFrame:
    """(from_kind, to_kind, from_ids): how many different ids, the texts of ids with ``/`` between, refer to each kind.  An id is counted
    once whatever it refers to.  Whole numbers are compared as such where none is null, as two of them have the same text only if they
    are equal, and a text with a null left out has fewer parts; other ids are compared by their text.

    Whole numbers are counted by the bits of a mask: the lowest bits of their columns, six in all, say which bit, the others are the
    row.  So up to 64 ids that lie close are one row in the shuffle, and ids that lie apart are a row each."""
    kinds = list(dict.fromkeys(to for to, _ in columns))
    refers = [reduce(lambda a, b: a | b, [F.col(c).isNotNull() for to, c in columns if to == k]) for k in kinds]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids])

    def by_text(rows: DataFrame) -> DataFrame:
        each = rows.groupBy(F.concat_ws("/", *ids).alias("_id")).agg(*[F.bool_or(r).alias(f"_r{i}") for i, r in enumerate(refers)])
        return each.agg(*[F.count_if(F.col(f"_r{i}")).alias(f"_n{i}") for i in range(len(kinds))])

    def by_mask(rows: DataFrame) -> DataFrame:
        low = 6 // len(ids)
        number = [F.col(c).cast("bigint") for c in ids]
        place = reduce(lambda a, b: a + b, [F.shiftleft(x.bitwiseAND(F.lit((1 << low) - 1)), low * i) for i, x in enumerate(number)])
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))
        each = rows.groupBy(*[F.shiftright(x, low).alias(f"_k{i}") for i, x in enumerate(number)]).agg(*[F.bit_or(F.when(r, bit)).alias(f"_r{i}") for i, r in enumerate(refers)])
        return each.agg(*[F.coalesce(F.sum(F.bit_count(f"_r{i}").cast("bigint")), F.lit(0)).alias(f"_n{i}") for i in range(len(kinds))])

    if all(dict(df.dtypes)[c] in INTEGRAL for c in ids):
        n = by_mask(df.where(whole)).unionByName(by_text(df.where(~whole)))
    else:
        n = by_text(df)
    each = n.select(F.explode(F.array(*[F.struct(F.lit(k).alias("to_kind"), F.col(f"_n{i}").alias("n")) for i, k in enumerate(kinds)])).alias("x"))
    return each.groupBy(F.lit(from_kind).alias("from_kind"), F.col("x.to_kind").alias("to_kind")).agg(F.sum("x.n").alias("from_ids")).where("from_ids > 0")


def counted_catalog(by_target: DataFrame, from_ids: DataFrame, ids: DataFrame) -> DataFrame:
    """pair_catalog from references that are added up by target (from_kind, to_kind, to_id, column, mechanism, n) and the number of
    different from_ids of each pair: the join sees each target once, and only numbers are added up for it.  The few columns and
    mechanisms are made distinct by pair."""
    pair = ["from_kind", "to_kind"]
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    judged = resolve(by_target.groupBy(*pair, "to_id").agg(F.sum("n").alias("n")), ids)
    a = judged.groupBy(*pair).agg(F.count("*").alias("to_ids"), total(F.col("valid")).alias("valid_true"), total(~F.col("valid")).alias("valid_false"), total(F.col("valid").isNull()).alias("valid_null"))
    few = by_target.groupBy(*pair, "column", "mechanism").agg(F.sum("n").alias("n"))
    text = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",").alias
    names = few.groupBy(*pair).agg(F.sum("n").alias("edges"), text("column")("join_keys"), text("mechanism")("mechanisms"))
    out = a.join(names, pair).join(from_ids, pair).withColumn("cardinality", cardinality(F.col("edges"), F.col("from_ids"), F.col("to_ids")))
    return out.select(*pair, "edges", "from_ids", "to_ids", "join_keys", "mechanisms", "valid_true", "valid_false", "valid_null", "cardinality")


def target_verdicts(to_kind: str, refs: Sequence[tuple[str, DataFrame, str]], known: tuple[DataFrame, str] | None) -> DataFrame:
    """(from_kind, to_kind, column, edges, ends, valid_true, valid_false, valid_null) of each reference (from kind, its table, column) to one
    kind; known is its table and id column, None if it has none.  ends are the pair's different to_ids, of all its columns.

    References and ids meet by one aggregate of their union, so nothing is joined or sorted: a task adds up its rows of a target
    before they are sent, and an id is one row however often it is repeated.  Keys are whole numbers where all these columns are, as
    two of them have the same text only if they are equal; otherwise they are texts."""
    sides = [*[(df, c) for _, df, c in refs], *([known] if known else [])]
    kept = "bigint" if all(dict(df.dtypes)[c] in INTEGRAL for df, c in sides) else "string"
    cells = [df.where(F.col(c).isNotNull()).select(F.col(c).cast(kept).alias("_key"), F.lit(i).alias("_by")) for i, (df, c) in enumerate(sides)]
    n = [F.col(f"_n{i}") for i in range(len(refs))]
    met = reduce(DataFrame.unionByName, cells).groupBy("_key").agg(*[F.count_if(F.col("_by") == i).alias(f"_n{i}") for i in range(len(refs))], F.bool_or(F.col("_by") == len(refs)).alias("_has"))
    pairs = list(dict.fromkeys(k for k, *_ in refs))
    of_pair = [reduce(lambda a, b: a | b, [x > 0 for x, (k, *_) in zip(n, refs) if k == pair]) for pair in pairs]
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    out = met.agg(
        F.coalesce(F.bool_or("_has"), F.lit(False)).alias("_any"), *[F.count_if(x).alias(f"_ends{i}") for i, x in enumerate(of_pair)],
        *[total(x).alias(f"_edges{i}") for i, x in enumerate(n)], *[total(F.when(F.col("_has"), x)).alias(f"_true{i}") for i, x in enumerate(n)],
    )
    rows = []
    for i, (kind, _, c) in enumerate(refs):
        edges, true, judged, none = F.col(f"_edges{i}"), F.col(f"_true{i}"), F.col("_any"), F.lit(0).cast("bigint")
        rows.append(F.struct(
            F.lit(kind).alias("from_kind"), F.lit(to_kind).alias("to_kind"), F.lit(c).alias("column"), edges.alias("edges"), F.col(f"_ends{pairs.index(kind)}").alias("ends"),
            true.alias("valid_true"), F.when(judged, edges - true).otherwise(none).alias("valid_false"), F.when(judged, none).otherwise(edges).alias("valid_null"),
        ))
    return out.select(F.inline(F.array(*rows))).where("edges > 0")


def verdict_catalog(verdicts: DataFrame, from_ids: DataFrame) -> DataFrame:
    """pair_catalog from target_verdicts and source_counts, which have a row for each declared column and pair."""
    pair = ["from_kind", "to_kind"]
    sums = [F.sum(c).alias(c) for c in ("edges", "valid_true", "valid_false", "valid_null")]
    a = verdicts.groupBy(*pair).agg(F.array_join(F.sort_array(F.collect_set("column")), ",").alias("join_keys"), F.max("ends").alias("_ends"), *sums)
    out = a.join(F.broadcast(from_ids), pair).withColumn("cardinality", cardinality(F.col("edges"), F.col("from_ids"), F.col("_ends")))
    return out.select(*pair, "edges", "from_ids", F.col("_ends").alias("to_ids"), "join_keys", F.lit("hard").alias("mechanisms"), "valid_true", "valid_false", "valid_null", "cardinality")


def all_directions(kinds: DataFrame) -> DataFrame:
    """(a, b, side) for every unordered pair of different kinds and both directions; kinds is a small dimension, as the result has
    all its pairs."""
    a, b = kinds.select(F.col("kind").alias("a")), kinds.select(F.col("kind").alias("b"))
    pairs = a.join(F.broadcast(b), F.col("a") < F.col("b"))
    return pairs.select("a", "b", F.explode(F.array(F.lit("ab"), F.lit("ba"))).alias("side"))


def direction_ladder(kinds: DataFrame, catalog: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Every direction with its status: modeled (has edges, none dangling), partial (has edges, some dangling), ledgered
    (no edges, but a reason), missing.  unblock says what would lift it."""
    d = all_directions(kinds).withColumns({"from_kind": F.when(F.col("side") == "ab", F.col("a")).otherwise(F.col("b")), "to_kind": F.when(F.col("side") == "ab", F.col("b")).otherwise(F.col("a"))})
    d = d.join(catalog, ["from_kind", "to_kind"], "left")
    if ledger is not None:
        d = d.join(ledger.select("from_kind", "to_kind", "reason"), ["from_kind", "to_kind"], "left")
    else:
        d = d.withColumn("reason", F.lit(None).cast("string"))
    status = F.when(F.col("edges").isNull(), F.when(F.col("reason").isNotNull(), "ledgered").otherwise("missing")).when(F.col("valid_false") > 0, "partial").otherwise("modeled")
    unblock = F.when(status == "partial", "resolve dangling").when(status == "missing", "find a carrier").when(status == "ledgered", F.col("reason"))
    return d.select("a", "b", "side", status.alias("status"), F.coalesce("edges", F.lit(0)).alias("edges"), F.coalesce("cardinality", F.lit("-")).alias("cardinality"), unblock.alias("unblock"))


def first_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, value: str, out: str = "evidence") -> DataFrame:
    """The first k values of each group in the order, joined; Spark plans the rank as a group limit below the shuffle.  The values are
    taken from the rows behind the first one by the same window: to add them up by group would sort all rows once or twice more."""
    w = Window.partitionBy(*by).orderBy(*order)
    kept = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    values = F.collect_list(F.col(value).cast("string")).over(w.rowsBetween(0, k - 1))
    return kept.withColumn("_all", values).where("_rn = 1").select(*by, F.array_join("_all", ",").alias(out))


def carrier_edges(cells: DataFrame, carriers: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges of all declared carriers in one join, and the values that no target has.

    cells (kind, id, path, norm_path, value), carriers (kind, norm_path, target, method), ids (kind, id)."""
    typed = cells.join(F.broadcast(carriers), ["kind", "norm_path"]).where("value IS NOT NULL AND value <> ''")
    known = ids.select(F.col("kind").alias("target"), F.col("id").cast("string").alias("value")).distinct()
    hit = typed.join(known, ["target", "value"])
    edges = first_k(hit, ["kind", "id", "target", "value", "method"], [F.col("path")], 3, "path")
    edges = edges.select(F.col("kind").alias("from_kind"), F.col("target").alias("to_kind"), F.col("id").alias("from_id"), F.col("value").alias("to_id"), "method", "evidence")
    return edges, typed.join(known, ["target", "value"], "left_anti").select("kind", "id", "path", "target", "value").distinct()


def residual_values(cells: DataFrame, ids: DataFrame, pinned: DataFrame | None = None) -> DataFrame:
    """Directions that exact values suggest beyond the declared ones: one equi join of all values with all ids, whatever the
    kinds, without pinned (kind, norm_path) paths and references of a kind to itself."""
    if pinned is not None:
        cells = cells.join(pinned.select("kind", "norm_path").distinct(), ["kind", "norm_path"], "left_anti")
    known = ids.select(F.col("kind").alias("target"), F.col("id").cast("string").alias("value")).distinct()
    hit = cells.where("value IS NOT NULL").join(known, "value").where("kind <> target")
    by_path = hit.groupBy("kind", "target", "norm_path").agg(F.count("*").alias("hits"), F.count_distinct("value").alias("values"))
    rank = F.row_number().over(Window.partitionBy("kind", "target").orderBy(F.desc("hits"), "norm_path"))
    return by_path.withColumn("rank", rank).where("rank <= 3")


def token_targets(texts: DataFrame, id_: str, text: str, pattern: str, prefixes: DataFrame) -> DataFrame:
    """(from_id, to_kind, to_id) of tokens like ``Prefix.Name`` in scripts: the prefix picks the target kind.  prefixes (prefix, kind)."""
    found = texts.select(F.col(id_).alias("from_id"), F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("token"))
    cut = found.select("from_id", F.substring_index("token", ".", 1).alias("prefix"), F.substring_index("token", ".", -1).alias("to_id"))
    return cut.join(F.broadcast(prefixes), "prefix").select("from_id", F.col("kind").alias("to_kind"), "to_id")


def token_references(texts: DataFrame, id_: str, text: str, pattern: str, prefixes: DataFrame, ids: DataFrame) -> DataFrame:
    """token_targets with their verdicts."""
    return resolve(token_targets(texts, id_, text, pattern, prefixes), ids)


def token_reference_counts(texts: DataFrame, id_: str, text: str, pattern: str, prefixes: DataFrame, ids: DataFrame) -> DataFrame:
    """(to_kind, valid, refs): token_references counted.  Tokens are added up by target in every task before they are resolved, so a
    target that very many tokens name is one row in the join.  The targets are written, as they are used twice: only ids that are
    named are made distinct and joined, so a task does not hold its share of all ids."""
    targets = staged(token_targets(texts, id_, text, pattern, prefixes).groupBy("to_kind", "to_id").agg(F.count("*").alias("n")), "targets")
    ids = ids.where("id IS NOT NULL").select("kind", F.col("id").cast("string").alias("id"))
    named = ids.join(targets.select(F.col("to_kind").alias("kind"), F.col("to_id").alias("id")), ["kind", "id"], "left_semi")
    return resolve(targets, named, ids.select("kind").distinct()).groupBy("to_kind", "valid").agg(F.sum("n").alias("refs"))


GRAM = 3


def grams(text: Column, k: int) -> Column:
    """The different runs of k letters of a text."""
    return F.when(F.length(text) >= k, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - k + 1), lambda i: F.substring(text, i, k)))).otherwise(F.array().cast("array<string>"))


def containing(rows: DataFrame, text: Column, needles: DataFrame, needle: Column, few: int) -> DataFrame:
    """rows joined with the needles that their text contains.  Up to ``few`` needles are broadcast and tried on each row.  More
    are joined by one gram each: of a needle's grams the one that the fewest rows have, counted over all rows first, so a
    needle meets few rows that lack it, and a gram that is everywhere is nobody's choice.  Empty needles match nothing."""
    asked = needles.withColumn("_needle", needle).where("_needle <> ''")
    if asked.limit(few + 1).count() <= few:
        return rows.join(F.broadcast(asked), F.contains(text, F.col("_needle"))).drop("_needle")
    words = asked.select("_needle").distinct()
    cut = F.when(F.length("_needle") >= GRAM, grams(F.col("_needle"), GRAM)).otherwise(F.array("_needle"))
    wanted = words.select("_needle", F.explode(cut).alias("_gram"))
    every = rows.withColumn("_text", text)
    each = F.array_distinct(F.flatten(F.array(*[grams(F.col("_text"), k) for k in range(1, GRAM + 1)])))
    held = every.select(F.explode(each).alias("_gram")).join(wanted.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count("*").alias("_n"))
    rarest = wanted.join(held, "_gram").groupBy("_needle").agg(F.min(F.struct("_n", "_gram")).alias("_x"), F.count("*").alias("_found"))
    whole = rarest.join(wanted.groupBy("_needle").agg(F.count("*").alias("_all")), "_needle").where("_found = _all")  # a gram that no row has
    chosen = cut_lineage(asked.join(whole.select("_needle", F.col("_x._gram").alias("_gram")), "_needle"))
    asked_grams = chosen.select("_gram").distinct()
    met = every.select("*", F.explode(each).alias("_gram")).join(asked_grams, "_gram", "left_semi").join(chosen, "_gram")
    return met.where(F.contains("_text", "_needle")).drop("_text", "_gram", "_needle")


def substring_matches(rows: DataFrame, text: str, tokens: DataFrame, token: str, most_tokens: int = 64) -> DataFrame:
    """Rows whose text contains a token, case apart; see containing."""
    return containing(rows, F.lower(text), tokens, F.lower(token), most_tokens)


def anti_fallback(primary: DataFrame, fallback: DataFrame, on: Sequence[str]) -> DataFrame:
    """All rows of primary, and those of fallback whose key primary lacks; columns that one side lacks are null."""
    return primary.unionByName(fallback.join(primary.select(*on).distinct(), list(on), "left_anti"), allowMissingColumns=True)


def name_lookup(keys: DataFrame, key: str, *stages: tuple[DataFrame, str, str]) -> DataFrame:
    """The first name that one of several dimension tables (table, key column, name column) has, else the key itself."""
    out, names = keys, []
    for k, (dim, id_, name) in enumerate(stages):
        out = out.join(dim.select(F.col(id_).alias(f"_k{k}"), F.col(name).alias(f"_n{k}")).dropDuplicates([f"_k{k}"]), F.col(key) == F.col(f"_k{k}"), "left").drop(f"_k{k}")
        names.append(f"_n{k}")
    return out.withColumn("name", F.coalesce(*names, F.col(key).cast("string"))).drop(*names)


def banned_names(rows: DataFrame, keys: Sequence[str], names: Sequence[str], banned: DataFrame) -> DataFrame:
    """The ledger of names that may not be published: (…keys, column, name), names compared trimmed and case apart.
    banned (name)."""
    listed = banned.select(F.lower(F.trim("name")).alias("_low")).distinct()
    cells = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("name")) for n in names])).alias("x")).select(*keys, "x.*")
    return cells.withColumn("_low", F.lower(F.trim("name"))).join(listed, "_low", "left_semi").drop("_low")


def constants_of(owners: DataFrame, id_: str, indexes: str, pool: DataFrame) -> DataFrame:
    """Fields by their place in a pool (index, value): (id, field, value), value null for a place the pool lacks."""
    fields = owners.select(F.col(id_).alias("id"), F.posexplode(indexes).alias("field", "index"))
    return fields.join(pool.select("index", "value"), "index", "left").select("id", "field", "value")


def aligned(left: DataFrame, right: DataFrame, by: Sequence[str], place: str) -> DataFrame:
    """The n-th row of left beside the n-th of right within each group, and what one side has beyond the other: side says
    both, left or right.  place is each row's number."""
    on = [*by, place]
    both = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), on, "full_outer")
    return both.withColumn("side", F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left").otherwise("right")).drop("_l", "_r")


def drift(entities: DataFrame, bridged: DataFrame, absent: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """For each kind: entities against the sum of bridged and absent ones (distinct keys); off is what is unaccounted for."""
    tagged = [d.select(*by, key, F.lit(t).alias("_t")).distinct() for d, t in ((entities, "entities"), (bridged, "bridged"), (absent, "absent"))]
    every = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    n = every.groupBy(*by).agg(*[F.count_if(F.col("_t") == t).alias(t) for t in ("entities", "bridged", "absent")])
    return n.withColumn("off", F.col("entities") - F.col("bridged") - F.col("absent"))


def family_classes(families: DataFrame, directions: DataFrame, self_kinds: DataFrame) -> DataFrame:
    """families (family, from_kind, to_kind, edges, mechanisms) with class: ``derived`` for a direction without edges of its own,
    ``fold`` for one that has some, ``fold-self`` or ``self-chain`` from a kind to itself (the first where self_kinds (kind) has
    it), ``stray`` for a pair that is no direction."""
    known = directions.select("from_kind", "to_kind", F.col("status").isin("modeled", "partial").alias("_own")).distinct()
    own = self_kinds.select(F.col("kind").alias("from_kind"), F.lit(True).alias("_self")).distinct()
    out = families.join(known, ["from_kind", "to_kind"], "left").join(own, "from_kind", "left")
    kind = F.when(F.col("from_kind") == F.col("to_kind"), F.when(F.col("_self"), "fold-self").otherwise("self-chain"))
    return out.withColumn("class", kind.when(F.col("_own").isNull(), "stray").when(F.col("_own"), "fold").otherwise("derived")).drop("_own", "_self")


def wire_evidence(directions: DataFrame, classed: DataFrame, ledger: DataFrame) -> DataFrame:
    """directions (from_kind, to_kind, status, unblock, ...) with what family_classes and a ledger (from_kind, to_kind, reason) say
    of them: evidence and evidence_edges of derived families, folds onto directions that have edges of their own, reason, and
    standing: modeled, derived, ledgered or open.  Counts of a direction's own edges stay as they were."""
    pair = ["from_kind", "to_kind"]
    names = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(F.col("class") == c, F.col("family")))), ",")
    held = classed.where("class IN ('derived', 'fold')").groupBy(*pair).agg(
        F.nullif(names("derived"), F.lit("")).alias("evidence"), F.sum(F.when(F.col("class") == "derived", F.col("edges"))).alias("evidence_edges"),
        F.nullif(names("fold"), F.lit("")).alias("folds"), F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.split("mechanisms", r"\+"))))), "+").alias("_mech"),
    )
    listed = ledger.groupBy(*pair).agg(F.min("reason").alias("reason"))
    out = directions.join(held, pair, "left").join(listed, pair, "left")
    standing = F.when(F.col("status").isin("modeled", "partial"), "modeled").when(F.col("evidence").isNotNull(), "derived").when(F.col("reason").isNotNull(), "ledgered").otherwise("open")
    wired = F.concat(F.lit("wired: "), "evidence", F.lit(" · E="), F.col("evidence_edges").cast("string"), F.lit(" · mech="), "_mech")
    unblock = F.when(standing == "derived", wired).when(standing == "ledgered", F.concat(F.lit("ledgered: "), "reason")).otherwise(F.col("unblock"))
    return out.withColumns({"standing": standing, "unblock": unblock}).drop("_mech")


def evidence_conflicts(directions: DataFrame, classed: DataFrame, ledger: DataFrame) -> DataFrame:
    """(from_kind, to_kind, rule): families and ledger rows outside the directions, and ledger rows of a direction that has edges
    of its own or families.  Empty if directions are split into modeled, derived and ledgered ones."""
    pair = ["from_kind", "to_kind"]
    stray = classed.where("class = 'stray'").select(*pair, F.lit("family_outside").alias("rule"))
    listed = ledger.select(*pair).distinct().join(directions.select(*pair, F.col("status").alias("_status")), pair, "left")
    listed = listed.join(classed.select(*pair, F.lit(True).alias("_family")).distinct(), pair, "left")
    rules = F.array(F.when(F.col("_status").isNull(), "ledger_outside"), F.when(F.col("_status").isin("modeled", "partial"), "ledger_modeled"), F.when(F.col("_family"), "ledger_family"))
    return stray.distinct().unionByName(listed.select(*pair, F.explode(F.array_compact(rules)).alias("rule")))


def scene_owners(folders: DataFrame, scenes: DataFrame, folder: str, scene: str, ending: str = ".dat", scene_ending: str = ".prefab") -> DataFrame:
    """(folder, owner, evidence) of each different folder ``<up>/<stem><ending>``: the scene beside it of the same stem, else of the
    stem without its last ``.part``, else the shortest (then smallest) one whose stem goes on from it, else none (unowned).

    Three equi joins: scenes are listed under all beginnings of their stems, so a directory with very many of them is no hot key."""
    name = r"^(?:(.*)/)?([^/]*)$"

    def cut(df: DataFrame, path: str, end: str) -> DataFrame:
        p = F.col(path)
        df = df.where(p.isNotNull()).select(p.alias("_path")).distinct()
        stem = F.regexp_extract("_path", name, 2)
        return df.select("_path", F.regexp_extract("_path", name, 1).alias("_up"), F.when(stem.endswith(end), F.expr(f"left(regexp_extract(_path, '{name}', 2), length(regexp_extract(_path, '{name}', 2)) - {len(end)})")).otherwise(stem).alias("_stem"))

    s = cut(scenes.where(F.col(scene).endswith(scene_ending)), scene, scene_ending)
    begins = s.where("_stem <> ''").select("_up", "_path", F.explode(F.transform(F.sequence(F.lit(1), F.length("_stem")), lambda n: F.left(F.col("_stem"), n))).alias("_stem"))
    begins = begins.groupBy("_up", "_stem").agg(F.min(F.struct(F.length("_path").alias("n"), F.col("_path").alias("p"))).alias("x")).select("_up", "_stem", F.col("x.p").alias("_longer"))
    f = cut(folders, folder, ending).withColumn("_less", F.when(F.contains("_stem", F.lit(".")), F.regexp_extract("_stem", r"^(.*)\.[^.]*$", 1)))
    f = f.join(s.select("_up", "_stem", F.col("_path").alias("_same")), ["_up", "_stem"], "left").join(begins, ["_up", "_stem"], "left")
    f = f.join(s.select("_up", F.col("_stem").alias("_less"), F.col("_path").alias("_cut")), ["_up", "_less"], "left")
    evidence = F.when(F.col("_same").isNotNull(), "same-stem").when(F.col("_cut").isNotNull(), "strip-dot-variant").when(F.col("_longer").isNotNull(), "prefix-match").otherwise("unowned")
    return f.select(F.col("_path").alias("folder"), F.coalesce("_same", "_cut", "_longer").alias("owner"), evidence.alias("evidence"))


def operands_read(ops: DataFrame, keys: Sequence[str], op: str, args: str, reads: DataFrame) -> DataFrame:
    """(…keys, place, register): the operands that each operation reads, by a table reads (op, places: 0-based positions)."""
    at = ops.join(F.broadcast(reads.select(F.col("op").alias("_op"), "places")), F.col(op) == F.col("_op"))
    found = at.select(*keys, args, F.explode("places").alias("place"))
    return found.select(*keys, "place", F.get(args, F.col("place")).alias("register")).where("register IS NOT NULL")


def surfaces(universe: DataFrame, mapped: DataFrame, key: str) -> DataFrame:
    """Every member of a universe with its surface, or ``deferred`` where mapped (key, surface) has none: no silent rest."""
    m = mapped.groupBy(key).agg(F.min("surface").alias("surface"))
    return universe.select(key).distinct().join(m, key, "left").select(key, F.coalesce("surface", F.lit("deferred")).alias("surface"))


def allocated_ids(owners: DataFrame, width: int = 4) -> DataFrame:
    """owners (folder, owner, ...) with id: the stem of the owner's path, or ``unowned``, and a number by folder within it."""
    stem = F.regexp_replace(F.regexp_extract("owner", r"([^/]*)$", 1), r"\.[^.]*$", "")
    named = owners.withColumn("_stem", F.coalesce(stem, F.lit("unowned")))
    n = F.col("_n").cast("string")
    numbered_ = places(named, ["_stem"], ["folder"], "_n")
    return numbered_.withColumn("id", F.concat("_stem", F.lit("-"), F.lpad(n, F.greatest(F.length(n), F.lit(width)), F.lit("0")))).drop("_stem", "_n")


def ledger_classes(directions: DataFrame, derived: DataFrame, declared: DataFrame, residual: DataFrame, terminal: DataFrame, top: int = 3) -> DataFrame:
    """(from_kind, to_kind, class, unblock) of the directions (from_kind, to_kind, status) without edges of their own, each by the first rule
    that holds: ``derived-evidence`` for a direction of derived; ``schema-empty`` where declared (from_kind, to_kind) has a column for
    it; ``unadjudicated-name-hits`` where residual (from_kind, to_kind, norm_path, hits) has equal names, with their sum and the
    ``top`` paths; the class of a terminal (from_kind, class, reason) kind; else ``no-carrier``.  Every direction has one."""
    pair = ["from_kind", "to_kind"]
    flag = lambda df, name: df.select(*pair, F.lit(True).alias(name)).distinct()
    rank = F.row_number().over(Window.partitionBy(*pair).orderBy(F.desc("hits"), "norm_path"))
    shown = F.when(F.col("_rn") <= top, F.concat("norm_path", F.lit("×"), F.col("hits").cast("string")))
    by_path = residual.groupBy(*pair, "norm_path").agg(F.sum("hits").alias("hits")).withColumn("_rn", rank)
    hits = by_path.groupBy(*pair).agg(F.sum("hits").alias("_hits"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(shown.isNotNull(), F.struct("_rn", shown.alias("t"))))), lambda x: x["t"]), "; ").alias("_paths"))
    out = directions.where("status NOT IN ('modeled', 'partial')").select(*pair)
    out = out.join(flag(derived, "_derived"), pair, "left").join(flag(declared, "_declared"), pair, "left").join(hits, pair, "left").join(terminal.select("from_kind", F.col("class").alias("_class"), "reason"), "from_kind", "left")
    found = F.concat(F.col("_hits").cast("string"), F.lit(" equal names; "), "_paths")
    kind = F.when(F.col("_derived"), "derived-evidence").when(F.col("_declared"), "schema-empty").when(F.col("_hits").isNotNull(), "unadjudicated-name-hits").when(F.col("_class").isNotNull(), F.col("_class")).otherwise("no-carrier")
    text = F.when(kind == "schema-empty", F.concat(F.lit("a column of "), "from_kind", F.lit(" names "), "to_kind", F.lit(" and is never filled"))).when(kind == "unadjudicated-name-hits", found).when(kind == F.col("_class"), F.col("reason")).when(kind == "no-carrier", "find a carrier")
    return out.select(*pair, kind.alias("class"), text.alias("unblock"))


def deferred_ledger(columns: DataFrame, edges: DataFrame, rows: DataFrame, residual: DataFrame) -> DataFrame:
    """(class, entries, cells, detail) of what a catalog does not say, in six classes: ``negated-polarity``, ``compound`` and
    ``schema-empty`` columns of columns (schema, column, cells, class), ``unresolved`` and ``no-target`` references of edges (to_kind,
    valid), and ``anonymous`` rows (kind, id null); and ``residual-names`` that residual (target, hits) adds.  detail lists what is
    in a class by name, a class without entries has none of it and is there all the same."""
    tagged = columns.select(F.when(F.col("class") == "negated", "negated-polarity").when(F.col("class").startswith("compound"), "compound").when(F.col("class") == "schema_empty", "schema-empty").alias("kind"), F.concat_ws(".", "schema", "column").alias("name"), "cells").where("kind IS NOT NULL")
    bad = edges.where("valid IS NULL OR NOT valid").groupBy(F.when(F.col("valid").isNull(), "no-target").otherwise("unresolved").alias("kind"), F.col("to_kind").alias("name")).agg(F.count("*").alias("cells"))
    nameless = rows.where("id IS NULL").groupBy(F.lit("anonymous").alias("kind"), F.col("kind").alias("name")).agg(F.count("*").alias("cells"))
    names = residual.groupBy(F.lit("residual-names").alias("kind"), F.col("target").alias("name")).agg(F.sum("hits").alias("cells"))
    every = tagged.unionByName(bad).unionByName(nameless).unionByName(names)
    sums = every.groupBy("kind").agg(F.count("*").alias("entries"), F.sum("cells").alias("cells"), F.array_join(F.sort_array(F.collect_set("name")), ",").alias("detail"))
    classes = columns.sparkSession.createDataFrame([(c,) for c in ("negated-polarity", "compound", "schema-empty", "unresolved", "no-target", "anonymous", "residual-names")], "class string")
    out = classes.join(sums, F.col("class") == F.col("kind"), "left")
    return out.select("class", F.coalesce("entries", F.lit(0)).alias("entries"), F.coalesce("cells", F.lit(0)).alias("cells"), F.coalesce("detail", F.lit("")).alias("detail"))
