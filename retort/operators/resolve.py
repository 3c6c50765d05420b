"""Identity: registries, unique symbols, memo tables, pairings and differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retort.functions import text as t
from retort.functions import vocab
from retort.storage import materialize

#: What parts words: everything but letters and digits.
_BETWEEN = r"[^\p{L}\p{N}]+"


def two_key_lookup(rows: DataFrame, registry: DataFrame, scope: Sequence[str], key: str, name: str) -> DataFrame:
    """rows with `found` and `match`: the registry's name under the key as it is, else under the key with case aside.

    registry: scope, key, name and an optional `pos`; of several entries that differ in case the first counts.
    """
    pos = F.col("pos") if "pos" in registry.columns else F.col(key)
    exact = registry.groupBy(*scope, F.col(key).alias("_k")).agg(F.min_by(name, pos).alias("_exact"))
    folded = registry.groupBy(*scope, F.lower(key).alias("_l")).agg(F.min_by(name, F.struct(pos, F.col(key))).alias("_folded"))
    out = rows.withColumn("_k", F.col(key)).withColumn("_l", F.lower(key)).join(exact, [*scope, "_k"], "left").join(folded, [*scope, "_l"], "left")
    match = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_folded").isNotNull(), "folded").otherwise("none")
    return out.select(*rows.columns, F.coalesce("_exact", "_folded").alias("found"), match.alias("match"))


def registry_status(name: Column, symbol: Column, found: Column, is_substrate: Column, inferred: Column) -> Column:
    """`resolved` (the registry's name replaces this one), `verified`, `conflict` (the name stays) or `none`."""
    text = t.clean_text(name)
    weak = (text == "") | (t.normalize_symbol(name) == t.normalize_symbol(symbol)) | F.lower(text).rlike(r"\A(?:compound|substrate|product|ligand|catalyst)\s+\w{1,5}\z") | t.underspecified_label(name, symbol)
    weak = weak | inferred | (is_substrate & F.lower(text).isin(*vocab.GENERIC_NAMES))
    return F.when(found.isNull(), "none").when(weak, "resolved").when(t.normalize_iupac(name) == t.normalize_iupac(found), "verified").otherwise("conflict")


def align_registry(compounds: DataFrame, registry: DataFrame) -> DataFrame:
    """compounds (source_paper, field, compound struct, ...) with the registry's word on each: found, status, name.

    registry: source_paper, symbol, name, pos. Looked up are the symbol or label, then the symbol in a label such as
    "ligand L1", then the name, each as it is and then with case aside; all keys are looked up in one join.
    """
    c = F.col("compound")
    generic = F.regexp_extract(F.coalesce(c["label"], c["name"]), r"(?i)\A(?:ligand|catalyst|product|substrate|compound)\s+(\S{1,6})\z", 1)
    keys = F.filter(F.array(F.struct(F.lit(1).alias("rank"), t.first_text(c["symbol"], c["label"]).alias("key")), F.struct(F.lit(2).alias("rank"), generic.alias("key")), F.struct(F.lit(3).alias("rank"), t.clean_text(c["name"]).alias("key"))), lambda k: k["key"] != "")
    numbered = compounds.withColumn("_row", F.monotonically_increasing_id())
    asked = numbered.select("_row", "source_paper", F.inline(keys)).withColumnRenamed("key", "symbol")
    told = two_key_lookup(asked, registry.select("source_paper", "symbol", "name", "pos"), ["source_paper"], "symbol", "name").filter("found is not null")
    best = told.groupBy("_row").agg(F.min(F.struct("rank", "found")).alias("_best"))
    out = numbered.join(best, "_row", "left").withColumn("found", F.col("_best.found")).drop("_row", "_best")
    inferred = F.coalesce(c["resolution_source"], F.lit("")) == "product_inferred"
    status = registry_status(c["name"], F.coalesce(c["symbol"], c["label"]), F.col("found"), F.col("field") == "substrates", inferred)
    return out.withColumn("status", status).withColumn("name", F.when(F.col("status") == "resolved", F.col("found")).otherwise(c["name"]))


def symbol_identities(rows: DataFrame, scope: Sequence[str], symbol: str, identity: Sequence[str], order: Sequence[str]) -> DataFrame:
    """scope, symbol, n_identities and the first identity of each symbol; identities are compared with case aside."""
    same = F.struct(*[F.lower(F.coalesce(F.col(i).cast("string"), F.lit(""))).alias(i) for i in identity])
    first = F.min(F.struct(*order, *identity))
    return rows.filter(F.coalesce(F.col(symbol).cast("string"), F.lit("")) != "").groupBy(*scope, symbol).agg(F.count_distinct(same).alias("n_identities"), first.alias("_f")).select(*scope, symbol, "n_identities", *[F.col(f"_f.{i}").alias(i) for i in identity])


def resolve_symbols(targets: DataFrame, sources: DataFrame, scope: Sequence[str], symbol: str, identity: Sequence[str], order: Sequence[str]) -> DataFrame:
    """targets with the sources' identity of their symbol where just one is known, and `resolution`: resolved, ambiguous or none."""
    known = symbol_identities(sources, scope, symbol, identity, order).select(*scope, symbol, "n_identities", *[F.col(i).alias(f"resolved_{i}") for i in identity])
    out = targets.join(known, [*scope, symbol], "left")
    status = F.when(F.col("n_identities") == 1, "resolved").when(F.col("n_identities") > 1, "ambiguous").otherwise("none")
    out = out.withColumn("resolution", status)
    return out.select(*targets.columns, *[F.when(F.col("resolution") == "resolved", F.col(f"resolved_{i}")).alias(f"resolved_{i}") for i in identity], "resolution")


def confidence(direction: Column, smiles: Column, iupac: Column) -> Column:
    """Text to image is `medium`; image to text only with a structure or a systematic name, else `low`."""
    return F.when((direction == "text_to_image") | (t.first_text(smiles, iupac) != ""), "medium").otherwise("low")


def same_as(left: DataFrame, right: DataFrame, scope: Sequence[str], key: str, left_id: str, right_id: str) -> DataFrame:
    """Distinct pairs of ids that share scope and a non-empty normalised key."""
    a = left.filter(F.col(key) != "").select(*scope, key, F.col(left_id).alias("left_id")).distinct()
    b = right.filter(F.col(key) != "").select(*scope, key, F.col(right_id).alias("right_id")).distinct()
    return a.join(b, [*scope, key])


def candidates(open_rows: DataFrame, aligned: DataFrame, others: DataFrame, scope: Sequence[str], keys: Sequence[str], row_id: str, other_id: str) -> DataFrame:
    """row_id, other_id and method: rows not aligned yet that share any of the keys with others, each pair by its first key."""
    rest = open_rows.join(aligned.select(row_id).distinct(), row_id, "left_anti")
    return first_key_pairs(rest, others, scope, keys, row_id, other_id)


#: Pairs that a part of a key may make in first_key_pairs(), the least rows of a part, and the most ids in a block.
PART_PAIRS, PART_ROWS, BLOCK_IDS = 50_000_000, 1024, 512


def first_key_pairs(rows: DataFrame, others: DataFrame, scope: Sequence[str], keys: Sequence[str], row_id: str, other_id: str) -> DataFrame:
    """row_id, other_id and method: rows and others that share scope and a non-empty key, each pair by its first key.

    A row meets blocks of others' ids that are alike in the key and those before it, so keys are compared once a block, and
    pairs go out as they are made and aren't gathered again. A pair that an earlier key gives is left out where it meets.
    Only those of ids with several different rows can be given twice, and are gathered. Keys that many share are dealt in
    parts, each with some of the rows and all the others.
    """
    rows, others = materialize(rows.select(*scope, *keys, row_id).distinct()), materialize(others.select(*scope, *keys, other_id).distinct())
    on, before = [*scope, "_rank", "_key"], [f"_before{i}" for i in range(len(keys) - 1)]
    several = _several(rows, row_id) or _several(others, other_id)

    def asked(df: DataFrame, i: str) -> DataFrame:
        """A row for each key that is given, with the keys before it."""
        twice = F.lit(False)
        if several:
            df = df.join(df.groupBy(i).agg((F.count("*") > 1).alias("_twice")), i, "left")
            twice = F.coalesce("_twice", F.lit(False))
        each = F.array(*[F.struct(F.lit(r).alias("_rank"), F.col(k).cast("string").alias("_key"), *[(F.col(keys[e]) if e < r else F.lit(None)).cast("string").alias(c) for e, c in enumerate(before)]) for r, k in enumerate(keys)])
        return df.select(*scope, F.col(i), twice.alias("_twice"), F.inline(each)).filter("_key <> ''")

    a, b = asked(rows, row_id), asked(others, other_id)
    n, k = F.col("_a").cast("double"), F.col("_b").cast("double")
    parts = F.greatest(F.lit(1), F.least(F.ceil(n * k / PART_PAIRS), F.ceil(n / PART_ROWS))).cast("int")
    shared = materialize(a.groupBy(*on).agg(F.count("*").alias("_a")).join(b.groupBy(*on).agg(F.count("*").alias("_b")), on).select(*on, "_b", parts.alias("_parts")))
    a = a.join(shared.drop("_b"), on).withColumn("_part", F.pmod(F.xxhash64(row_id), "_parts").cast("int")).drop("_parts")
    ids = F.collect_list(other_id)
    ids = F.when(F.count_if(F.col(other_id).isNull()) > 0, F.concat(ids, F.array(F.lit(None)))).otherwise(ids)
    b = b.join(shared, on).withColumn("_block", F.pmod(F.hash(other_id), F.ceil(F.col("_b") / BLOCK_IDS)))
    b = materialize(b.groupBy(*on, *before, "_twice", "_parts", "_block").agg(ids.alias("_ids")))
    b = b.select(*on, *[F.col(c).alias(f"{c}_b") for c in before], F.col("_twice").alias("_twice_b"), "_ids", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    # A number of partitions keeps them apart: what their pairs take isn't seen by their sizes.
    tasks = 8 * rows.sparkSession.sparkContext.defaultParallelism
    met = a.repartition(tasks, *on, "_part").join(b.repartition(tasks, *on, "_part"), [*on, "_part"])
    for c in before:
        met = met.filter(~F.coalesce((F.col(c) != "") & (F.col(c) == F.col(f"{c}_b")), F.lit(False)))
    method = F.element_at(F.array(*map(F.lit, keys)), F.col("_rank") + 1)
    told = [row_id, "method", *(["_rank", (F.col("_twice") | F.col("_twice_b")).alias("_twice")] if several else [])]
    found = met.withColumn("method", method).select(*told, "_ids").withColumn(other_id, F.explode("_ids")).drop("_ids")
    if not several:
        return found.select(row_id, other_id, "method")
    gathered = found.filter("_twice").groupBy(row_id, other_id).agg(F.min_by("method", "_rank").alias("method"))
    return found.filter("NOT _twice").select(row_id, other_id, "method").unionByName(gathered)


def _several(rows: DataFrame, key: str) -> bool:
    """Whether a key has several rows."""
    return bool(rows.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").limit(1).count())


def memo_join(rows: DataFrame, memo: DataFrame, key: Column, memo_key: str, *values: str) -> DataFrame:
    """rows with the memo's values under the case-folded, single-spaced key, and `memo_hit`."""
    fold = lambda c: F.lower(t.squeeze(c))
    known = memo.select(fold(F.col(memo_key)).alias("_key"), *values, F.lit(True).alias("memo_hit")).dropDuplicates(["_key"])
    return rows.withColumn("_key", fold(key)).join(known, "_key", "left").drop("_key").withColumn("memo_hit", F.coalesce("memo_hit", F.lit(False)))


def memo_misses(rows: DataFrame, memo: DataFrame, key: Column, memo_key: str) -> DataFrame:
    """The distinct keys that the memo lacks: what a provider has to be asked."""
    fold = lambda c: F.lower(t.squeeze(c))
    return rows.select(fold(key).alias("key")).filter("key <> ''").distinct().join(memo.select(fold(F.col(memo_key)).alias("key")), "key", "left_anti")


def merge_memos(memo: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """One row for each key: the first with a value, else the last of all."""
    w = Window.partitionBy(key).orderBy(F.col(value).isNull(), F.when(F.col(value).isNotNull(), F.struct(*order)).asc(), F.struct(*order).desc())
    return memo.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def pair_by_position(left: DataFrame, right: DataFrame, key: str, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Full outer pairing on (key, n): the n-th of a key on one side with the n-th on the other, either of which may lack."""
    a = left.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(*left_order)))
    b = right.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(*right_order)))
    return a.join(b, [key, "n"], "full_outer")


def positional_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, before and after of the positions whose values differ, null being a value."""
    a, b = before.select(*keys, F.col(value).alias("before")), after.select(*keys, F.col(value).alias("after"))
    return a.join(b, list(keys), "full_outer").filter(~F.col("before").eqNullSafe(F.col("after")))


def contains_join(rows: DataFrame, aliases: DataFrame, text: str, alias: str, block_chars: int = 4_000_000) -> DataFrame:
    """rows x aliases where the text holds the alias.

    The aliases are a stated set that meets all rows in blocks of about block_chars characters, each of them broadcast;
    one block is usual. An alias with a word between two others can only stand in a text that has this word as a whole
    one: such aliases are joined by the longest of their inner words, and only then compared. The others (single words,
    their parts, pairs of words) are looked for in every row. Null texts and aliases meet nothing.
    """
    words = lambda c: F.split(c, _BETWEEN)
    inner = F.filter(F.slice(words(F.col(alias)), 2, F.greatest(F.size(words(F.col(alias))) - 2, F.lit(0))), lambda w: w != "")
    longest = F.try_element_at(F.array_sort(F.transform(inner, lambda w: F.struct((-F.char_length(w)).alias("n"), w.alias("w")))), F.lit(1))["w"]
    keyed = aliases.withColumn("_word", longest)
    found = None
    for by_word in (True, False):
        some = keyed.filter(F.col("_word").isNotNull() if by_word else F.col("_word").isNull())
        n, size = some.agg(F.count("*"), F.coalesce(F.sum(F.char_length(alias) + 64), F.lit(0))).first()
        blocks = 1 + size // block_chars if n else 0
        hit = F.contains(F.col(text), F.col(alias))
        for b in range(blocks):
            part = some if blocks == 1 else some.filter(F.pmod(F.xxhash64(alias), F.lit(blocks)) == b)
            if by_word:
                has = rows.withColumn("_has", F.explode(F.array_distinct(words(F.col(text)))))
                met = has.join(F.broadcast(part), F.col("_has") == F.col("_word")).filter(hit).drop("_has", "_word")
            else:
                met = rows.join(F.broadcast(part.drop("_word")), hit)
            found = met if found is None else found.unionByName(met)
    return rows.join(F.broadcast(aliases.limit(0)), F.lit(True)) if found is None else found


#: Pairs that a block of a bin may make in range_join(), and its least and most tasks.
BLOCK_PAIRS, BLOCK_TASKS = 10_000_000, (8, 2000)


def range_join(points: DataFrame, spans: DataFrame, point: str, low: str, high: str, width: int) -> DataFrame:
    """points with each span whose bounds hold them, both ends included.

    Spans are cut into bins of `width`, so that this is an equi-join on the bin and not a loop over all pairs. Where a bin
    would make many pairs, its points are dealt into blocks, each of which meets the spans of the bin: few bins, or a
    frequent one, keep all tasks busy.
    """
    bin_of = F.floor(F.col(point) / width)
    cut = spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    each = points.groupBy(bin_of.alias("_bin")).agg(F.count("*").alias("n")).join(cut.groupBy("_bin").agg(F.count("*").alias("k")), "_bin")
    # blocks of a bin: as many as its pairs need, but never so many that its spans outnumber its points
    blocks = F.greatest(F.lit(1), F.least(F.ceil(F.col("n").cast("double") * F.col("k") / BLOCK_PAIRS), F.ceil(F.col("n") / F.col("k")) * 8)).cast("int")
    sized = materialize(each.select("_bin", blocks.alias("_blocks")))
    total, most = sized.agg(F.sum("_blocks"), F.max("_blocks")).first()
    if most is None or most <= 1:
        return points.withColumn("_bin", bin_of).join(cut, "_bin").filter(F.col(point).between(F.col(low), F.col(high))).drop("_bin")
    tasks = max(BLOCK_TASKS[0], min(BLOCK_TASKS[1], total))
    dealt = points.withColumn("_bin", bin_of).join(sized, "_bin").withColumn("_block", F.pmod(F.xxhash64(*points.columns), F.col("_blocks")).cast("int")).drop("_blocks")
    laid = cut.join(sized, "_bin").withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")
    met = dealt.repartition(tasks, "_bin", "_block").join(laid.repartition(tasks, "_bin", "_block"), ["_bin", "_block"])
    return met.filter(F.col(point).between(F.col(low), F.col(high))).drop("_bin", "_block")


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, order: str, *values: str) -> DataFrame:
    """left with the values of the last row of right at or before it in its key.

    Both sides are laid in one sequence and the last right row is carried forward: one shuffle and no pairs.
    """
    kind = lambda df, k: df.withColumn("_kind", F.lit(k))
    marks = kind(right.select(*keys, F.col(at).alias("_at"), F.struct(*values).alias("_v")), 0).withColumn("_o", F.lit(None).cast(dict(left.dtypes)[order]))
    rows = kind(left.select(*keys, F.col(at).alias("_at"), F.col(order).alias("_o"), F.struct(*left.columns).alias("_row")), 1)
    w = Window.partitionBy(*keys).orderBy("_at", "_kind", "_o").rowsBetween(Window.unboundedPreceding, 0)
    both = marks.unionByName(rows, allowMissingColumns=True).withColumn("_last", F.last("_v", ignorenulls=True).over(w))
    return both.filter("_kind = 1").select("_row.*", *[F.col(f"_last.{v}").alias(v) for v in values])


def uncovered(expected: DataFrame, seen: DataFrame, *keys: str) -> DataFrame:
    return expected.select(*keys).distinct().join(seen.select(*keys).distinct(), list(keys), "left_anti")
