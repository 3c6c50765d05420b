"""Merkle manifest of a dataset: leaves by record, authentication paths by traversal, proofs checked by folding."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retort.llm.common import crc_of_id, parts_for, read, stored

#: Nodes that become one, and levels that one block climbs. A block is what one call of a task traverses.
ARITY, HEIGHT = 8, 3
BLOCK = ARITY**HEIGHT
#: Rows that one task numbers at once.
RUN_ROWS = 65536
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels_of(total: int) -> int:
    """How many levels the block of a tree of `total` nodes climbs: all of its own if it is the only one."""
    if total > BLOCK:
        return HEIGHT
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


class Treehash:
    """The nodes of one level above consecutive leaves, with one stack: a run of ARITY nodes goes as soon as it is full."""

    def __init__(self, level: int) -> None:
        self.stack: list[list[str]] = [[] for _ in range(level)]
        self.done: list[str] = []

    def push(self, node: str) -> None:
        for run in self.stack:
            run.append(node)
            if len(run) < ARITY:
                return
            node = digest(run)
            run.clear()
        self.done.append(node)

    def finish(self) -> None:
        """No leaf follows: what is left of each run, even one node, becomes a node."""
        node = None
        for run in self.stack:
            if node is not None:
                run.append(node)
            node = digest(run) if run else None
            run.clear()
        if node is not None:
            self.done.append(node)


def block_root(leaves: Sequence[str], levels: int) -> str:
    tree = Treehash(levels)
    for leaf in leaves:
        tree.push(leaf)
    if not tree.done:
        tree.finish()
    return tree.done[0]


def traverse(leaves: Sequence[str], levels: int) -> Iterator[tuple[list[int], list[str]]]:
    """Leaf by leaf its path up `levels` levels: its places in the runs, and the other nodes of each run, joined.

    Every level holds the run that it is in and a stack that makes the next one, which takes one leaf a step and so is
    ready when the leaves get there: ARITY nodes a level and stack row, however many leaves there are.
    """
    n = len(leaves)
    runs, ahead = [], []
    for level in range(levels):
        span, first = ARITY ** (level + 1), Treehash(level)
        for leaf in leaves[:span]:
            first.push(leaf)
        if n <= span:
            first.finish()
        runs.append(first.done)
        ahead.append(Treehash(level))
    for i in range(n):
        places = [i // ARITY**level % ARITY for level in range(levels)]
        yield places, ["".join(run[:at] + run[at + 1 :]) for at, run in zip(places, runs, strict=True)]
        for level in range(levels):
            span = ARITY ** (level + 1)
            if i + span < n:
                ahead[level].push(leaves[i + span])
                if i + span == n - 1:
                    ahead[level].finish()
            if (i + 1) % span == 0:
                runs[level], ahead[level] = ahead[level].done, Treehash(level)


def leaf_of(text: Column | None = None) -> Column:
    """The leaf of a record: SHA-256 of its fields, each `-` if null or else its UTF-8 bytes, `:` and itself."""
    values = [F.col(f).cast("string") for f in FIELDS[:-1]] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]).cast("binary"), 256)


def lowered(text: Column) -> Column:
    """A text with A-Z lower-cased and all else as it is."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows with pos, their place from 0 in their tree by `order`, and total, the rows of that tree.

    Rows are sorted by ranges, so a tree of any size is dealt out; a row's place is its place in its range behind the
    sizes of the tree's earlier ranges. Rows alike in all of `order` are told apart by a number of their own.
    """
    by = ["tree", *order, "_turn"]
    parts = parts_for(rows.count(), RUN_ROWS)
    turned = rows.withColumn("_turn", F.monotonically_increasing_id())
    ranged = turned.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_turn")
    ranged = stored(ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    sizes = ranged.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("tree", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("total"))
    return ranged.join(sizes, ["tree", "_part"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before")


def climbed(nodes: DataFrame) -> DataFrame:
    """tree, pos, total and node of the roots of all blocks of nodes (tree, pos, total, node)."""

    def roots(block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        total = block.column("total")[0].as_py()
        root = block_root(block.column("node").to_pylist(), levels_of(total))
        return pa.table({"tree": block.column("tree").slice(0, 1), "pos": [block.column("pos")[0].as_py() // BLOCK], "total": [-(-total // BLOCK)], "node": [root]})

    blocks = nodes.select("tree", "pos", "total", "node", F.floor(F.col("pos") / BLOCK).alias("_block")).groupBy("tree", "_block")
    return blocks.applyInArrow(roots, "tree string, pos long, total long, node string")


def storeys(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(tables of nodes from the leaves on, each but the last the blocks of the next; the table of roots), all stored."""
    tables = [leaves.select("tree", "pos", "total", "node")]
    while True:
        most = tables[-1].agg(F.max("total")).first()[0]
        tables.append(stored(climbed(tables[-1])))
        if most is None or most <= BLOCK:
            return tables[:-1], tables[-1]


def descended(nodes: DataFrame, upper: DataFrame, *keep: str) -> DataFrame:
    """tree, pos, the kept columns, places and others of every node, and subroot: the path in its block, and behind it
    that of the block's root in upper (tree, pos, subroot, places, others), which all nodes of the block share."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.select("tree", "pos", *keep).schema), "subroot string, places array<int>, others array<string>"])

    def paths(block: pa.Table, above: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        shared = {name: above.column(name)[0].as_py() for name in ("subroot", "places", "others")}
        places, others = [], []
        for at, rest in traverse(block.column("node").to_pylist(), levels_of(block.column("total")[0].as_py())):
            places.append(at + shared["places"])
            others.append(rest + shared["others"])
        made = {"subroot": pa.array([shared["subroot"]] * len(places), pa.string()), "places": pa.array(places, pa.list_(pa.int32())), "others": pa.array(others, pa.list_(pa.string()))}
        return pa.table({name: block.column(name) for name in ("tree", "pos", *keep)} | made)

    left = nodes.select("tree", "pos", "total", *dict.fromkeys(("node", *keep)), F.floor(F.col("pos") / BLOCK).alias("_block"))
    right = upper.select("tree", F.col("pos").alias("_block"), "subroot", "places", "others")
    return left.groupBy("tree", "_block").cogroup(right.groupBy("tree", "_block")).applyInArrow(paths, schema)


def fold(node: Column, places: Column, others: Column) -> Column:
    """The root that a node and its path give."""
    step = F.arrays_zip(places.alias("at"), others.alias("rest"))
    at = lambda x: x["at"] * 64  # noqa: E731  the hex digits of a digest
    return F.aggregate(step, node, lambda acc, x: F.sha2(F.concat(F.substring(x["rest"], F.lit(1), at(x)), acc, F.substr(x["rest"], at(x) + 1)).cast("binary"), 256))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, tampered_leaf, subroot, root, places and others of every row of docs.

    A record's leaf is the hash of its five fields, null ones included. The leaves of a lang, by doc_id, are one tree,
    in which every 8 consecutive nodes become one until one is left, the subroot; the subroots by lang, null first, are
    the tree of the root. `places` and `others` are a leaf's path: at each level up to the root its place in its run
    and the run's other digests, so that `fold` gives the root. tampered is a text to be hashed in place of the
    record's, null where it is untouched; tampered_leaf is that record's leaf.

    Trees are worked in aligned blocks of 512 nodes: a first pass gives the blocks' roots, which are the nodes above;
    from the top down each block is traversed and its shared upper path appended. Null ids come first, rows that
    repeat an id follow by leaf, rows alike in everything are leaves of their own; empty and very long texts are
    hashed as they are; an empty table gives an empty result; other columns are ignored.
    """
    changed = F.when(tampered.isNotNull(), leaf_of(tampered)) if tampered is not None else F.lit(None).cast("string")
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # null before all others
    leaves = stored(docs.select(*FIELDS).select("doc_id", tree.alias("tree"), leaf_of().alias("node"), changed.alias("tampered_leaf")))
    leaves = stored(placed(leaves, ["doc_id", "node"]))
    floors, subroots = storeys(leaves)
    langs = stored(placed(subroots.select("tree", F.col("node").alias("subroot")).select(F.lit("").alias("tree"), F.col("tree").alias("lang"), F.col("subroot").alias("node")), ["lang"]))
    upper_floors, roots = storeys(langs)
    found = roots.first()
    nothing = [F.lit(None).cast("string").alias("subroot"), F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("others")]
    upper = roots.select("tree", "pos", *nothing)
    for nodes in reversed(upper_floors[1:]):
        upper = stored(descended(nodes, upper))
    upper = descended(langs, upper, "lang", "node").select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("node").alias("subroot"), "places", "others")
    upper = stored(upper)
    for nodes in reversed(floors[1:]):
        upper = stored(descended(nodes, upper))
    out = descended(leaves, upper, "doc_id", "node", "tampered_leaf")
    return out.select("doc_id", F.col("node").alias("leaf"), "tampered_leaf", "subroot", F.lit(found.node if found else None).cast("string").alias("root"), "places", "others")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", *FIELDS)
    found = manifest(docs, F.when(F.pmod(F.coalesce(crc_of_id("doc_id"), F.lit(0)), F.lit(3)) == 0, lowered(F.col("text"))))
    folded = fold(F.coalesce("tampered_leaf", "leaf"), F.col("places"), F.col("others"))
    out = found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("others", "").cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels of the tree of a lang and of the tree of langs that the SQL has, enough for 2,097,152 documents and 64 langs.
_LEVELS, _LANG_LEVELS = 7, 2
#: CRC-32 of the decimal digits of doc_id, bit by bit.
_SQL_STEP = "xor(c, b)"
_SQL_CRC = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
    f"lambda c, b: CASE WHEN {_SQL_STEP} & 1 = 1 THEN xor({_SQL_STEP} >> 1, 3988292384) ELSE {_SQL_STEP} >> 1 END), 4294967295)"
)


def _sql_field(value: str) -> str:
    return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"


def _sql_levels(first: str, levels: int) -> str:
    """CTEs of the levels above a table (tree, pos, node): `{first}{k}` its nodes and `{first}r{k}` their runs."""
    out = []
    for k in range(levels):
        runs = f"SELECT tree, pos // {ARITY} AS pos, list(node ORDER BY pos) AS nodes, any_value(c) AS c FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {first}{k}) GROUP BY ALL"
        out.append(f"{first}r{k} AS ({runs})")
        out.append(f"{first}{k + 1} AS (SELECT tree, pos, CASE WHEN c > 1 THEN sha256(array_to_string(nodes, '')) ELSE nodes[1] END AS node FROM {first}r{k})")
    return ",\n".join(out)


def _sql_paths(first: str, levels: int, start: str, result: str) -> str:
    """CTEs that fold rows (doc, tree, pos, folded, proof) of `start` up these levels."""
    out, last = [], start
    for k in range(levels):
        at = f"(x.pos // {ARITY**k}) % {ARITY}"
        before, after = f"array_to_string(list_slice(nodes, 1, {at}), '')", f"array_to_string(list_slice(nodes, {at} + 2, len(nodes)), '')"
        name = result if k == levels - 1 else f"{first}p{k}"
        out.append(
            f"{name} AS (SELECT doc, x.tree, x.pos, CASE WHEN c > 1 THEN sha256({before} || folded || {after}) ELSE folded END AS folded,"
            f" CASE WHEN c > 1 THEN proof || {before} || {after} ELSE proof END AS proof FROM {last} x JOIN {first}r{k} r ON x.tree = r.tree AND x.pos // {ARITY ** (k + 1)} = r.pos)"
        )
        last = name
    return ",\n".join(out)


OP11_SQL = f"""
WITH t AS (SELECT *, CASE WHEN {_SQL_CRC} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM documents),
h AS (SELECT doc_id, coalesce('=' || lang, '') AS tree,
 sha256({" || ".join(_sql_field(f"{f}::VARCHAR") for f in FIELDS)}) AS leaf,
 sha256({" || ".join(_sql_field(f"{f}::VARCHAR") for f in (*FIELDS[:-1], "changed"))}) AS tampered FROM t),
d AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER () AS doc FROM h),
a0 AS (SELECT tree, pos, leaf AS node FROM d),
{_sql_levels("a", _LEVELS)},
b0 AS (SELECT '' AS tree, tree AS lang, row_number() OVER (ORDER BY tree) - 1 AS pos, node FROM a{_LEVELS}),
{_sql_levels("b", _LANG_LEVELS)},
start AS (SELECT doc, tree, pos, tampered AS folded, '' AS proof FROM d),
{_sql_paths("a", _LEVELS, "start", "to_subroot")},
again AS (SELECT doc, '' AS tree, b0.pos, folded, proof FROM to_subroot s JOIN b0 ON s.tree = b0.lang),
{_sql_paths("b", _LANG_LEVELS, "again", "to_root")}
SELECT doc_id, leaf, s.node AS subroot, root.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.node AS verified
FROM d JOIN to_root r ON d.doc = r.doc JOIN b0 s ON s.lang = d.tree JOIN b{_LANG_LEVELS} root ON root.tree = ''
"""
