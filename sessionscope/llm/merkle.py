"""A Merkle manifest of the documents, with proofs.

Every row is a leaf. The leaves of a language ascend by doc_id; every eight
consecutive nodes become one until a single one, the subroot, is left, and the
subroots in the order of their languages become the root in the same way.

Where a leaf stands is found without sorting. Per language the doc_ids are bits
of bitmaps: a node of 1,024 ids keeps its non-zero 64-bit words with the
popcounts before each, and directories above (of 2^16 entries each) keep the
counts before a node. A row's place is the sum of those counts, one join with
the nodes. Rows are then dealt by (language, place / 4096): a slot array of at
most 4,096 hashes reduces four levels of the tree in one task, and its proofs
are joined from above in the same dealing. No step holds more than a block.

Rows that repeat a doc_id stand next to each other, ordered by their leaf; rows
without a doc_id come first. Equal rows are stored once with their number.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise

FAN = 8
LEVELS = 4  # levels of the tree that one slot array reduces
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_WORDS = 16  # 64-bit words of a bitmap node
_NODE_BITS = 10  # 2 ** _NODE_BITS ids
_DIRECTORY_BITS = 16
_NO_ID = -(1 << 60)  # the bitmap node of rows without an id: before all others
_PATH = "array<struct<left string, right string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(columns: list[Column]) -> Column:
    """The leaf of a row: each value as ``-`` or its UTF-8 length, a colon and itself."""
    def listed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(listed, columns)).cast("binary"), 256)


# ------------------------------------------------- places by popcounts --
def _coordinates(rows: DataFrame, key: str) -> DataFrame:
    """The bitmap node of a row's key, its word there and its bit."""
    low = F.col(key).bitwiseAND(F.lit((1 << _NODE_BITS) - 1))
    return rows.withColumns({
        "node": F.coalesce(F.shiftright(key, _NODE_BITS), F.lit(_NO_ID)),
        "low": F.coalesce(low, F.lit(0)).cast("int"),
    })


def _directories(counts: DataFrame) -> DataFrame:
    """(group, node, before): rows of the group in earlier nodes, by levels of at most 2^16 entries."""
    out = counts.select("group", "node", F.lit(0).cast("long").alias("before"))
    for level in range(4):
        own = F.shiftright("node", _DIRECTORY_BITS * level)
        above = F.shiftright("entry", _DIRECTORY_BITS) if level < 3 else F.lit(0)
        entries = counts.groupBy("group", own.alias("entry")).agg(F.sum("count").alias("count")) if level else \
            counts.select("group", F.col("node").alias("entry"), "count")
        earlier = Window.partitionBy("group", above).orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)
        entries = entries.select("group", "entry", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("more"))
        out = out.withColumn("entry", own).join(entries, ["group", "entry"]) \
            .select("group", "node", (F.col("before") + F.col("more")).alias("before"))
    return out


def bitmap_index(rows: DataFrame, key: str) -> DataFrame:
    """The bitmaps of (group, key, n) with their directories, one row per node.

    ``present`` tells which words are kept in ``words``; ``popcounts`` are the
    keys before each; ``extra`` lists the keys with more than one row (their
    further rows, and whether other leaves share them).
    """
    keyed = _coordinates(rows, key)
    mask = F.expr("shiftleft(1L, low & 63)")
    word = F.shiftright("low", 6)
    merged = keyed.groupBy("group", "node").agg(
        *[F.bit_or(F.when(word == w, mask).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(_WORDS)],
        F.sum("n").alias("count"))
    words = [F.col(f"w{w}") for w in range(_WORDS)]
    bits = [F.bit_count(w).cast("long") for w in words]
    before = [reduce(Column.__add__, bits[:w], F.lit(0).cast("long")) for w in range(_WORDS)]
    kept = F.filter(F.array(*[F.struct(w.alias("word"), b.alias("before")) for w, b in zip(words, before)]),
                    lambda x: x["word"] != 0)
    nodes = materialise(merged.select(
        "group", "node", "count", reduce(Column.__add__, bits).alias("keys"), kept.alias("kept"),
        reduce(Column.bitwiseOR, [F.when(w != 0, F.lit(1 << i)).otherwise(F.lit(0)) for i, w in enumerate(words)])
        .alias("present")), "bitmaps")
    repeated = nodes.where("count > keys")
    extra = keyed.join(repeated.select("group", "node"), ["group", "node"], "left_semi") \
        .groupBy("group", "node", "low").agg((F.sum("n") - 1).alias("more"), (F.count("*") > 1).alias("tied")) \
        .where("more > 0").groupBy("group", "node").agg(F.collect_list(F.struct("low", "more", "tied")).alias("extra"))
    none = F.array().cast("array<struct<low int, more bigint, tied boolean>>")
    if repeated.isEmpty():
        full = nodes.withColumn("extra", none)
    else:
        full = nodes.join(extra, ["group", "node"], "left").withColumn("extra", F.coalesce("extra", none))
    totals = nodes.groupBy("group").agg(F.sum("count").alias("total"))
    return materialise(
        full.join(_directories(nodes.select("group", "node", "count")), ["group", "node"]).join(totals, "group")
        .select("group", "node", "present", F.transform("kept", lambda x: x["word"]).alias("words"),
                F.transform("kept", lambda x: x["before"]).alias("popcounts"), "extra", "before", "total"), "index")


def ranks(rows: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``start`` (rows of the group with a smaller key), ``total`` and ``tied``."""
    at = F.expr("bit_count(present & ((1 << shiftright(low, 6)) - 1))")
    inside = F.expr("bit_count(words[at] & ~shiftleft(-1L, low & 63))")
    further = F.expr("aggregate(filter(extra, e -> e.low < low), 0L, (s, e) -> s + e.more)")
    return _coordinates(rows, key).join(index, ["group", "node"]).withColumn("at", at).select(
        *rows.columns, (F.col("before") + F.expr("popcounts[at]") + inside + further).alias("start"), "total",
        F.expr("exists(extra, e -> e.low = low AND e.tied)").alias("tied"))


def places(rows: DataFrame) -> DataFrame:
    """(group, doc_id, leaf, altered, n) with ``start`` and ``total``: where its first copy stands in its group."""
    index = bitmap_index(rows, "doc_id")
    found = ranks(rows, index, "doc_id")
    if index.where(F.exists("extra", lambda e: e["tied"])).isEmpty():
        return found.drop("tied")
    # different rows of one doc_id: ranked alike by their leaves' first 60 bits, the rest by the whole leaf
    tied = found.where("tied").drop("tied").withColumnsRenamed({"start": "first", "total": "all"}) \
        .withColumns({"language": F.col("group"),
                      "group": F.concat("group", F.lit("|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))),
                      "prefix": F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long")})
    tied = materialise(tied, "tied")
    alike = Window.partitionBy("group", "prefix").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    settled = ranks(tied, bitmap_index(tied, "prefix"), "prefix") \
        .withColumn("start", F.col("first") + F.col("start") + F.coalesce(F.sum("n").over(alike), F.lit(0))) \
        .select(F.col("language").alias("group"), *[c for c in rows.columns if c != "group"], "start",
                F.col("all").alias("total"))
    return found.where("NOT tied").drop("tied").unionByName(settled)


# ------------------------------------------------------- the tree itself --
def _steps(total: int, most: int) -> int:
    """Levels, at most ``most``, that a slot array of a group of ``total`` nodes reduces."""
    steps = 0
    while total > 1 and steps < most:
        total, steps = -(-total // FAN), steps + 1
    return steps


def _slot_array(table: pa.Table) -> list[str]:
    """The hashes of a block by slot; a row fills the slots [first, upto)."""
    first, upto = table.column("first").to_pylist(), table.column("upto").to_pylist()
    slots = [""] * max(upto)
    for lo, hi, h in zip(first, upto, table.column("hash").to_pylist()):
        slots[lo:hi] = [h] * (hi - lo)
    return slots


def _levels(slots: list[str], steps: int) -> list[list[str]]:
    """The slots and the levels above them."""
    levels = [slots]
    for _ in range(steps):
        below = levels[-1]
        levels.append([digest("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def _dealt(nodes: DataFrame, start: Column, upto: Column, levels: int) -> DataFrame:
    """Nodes at places [start, upto) dealt to the blocks of ``FAN ** levels`` places they touch."""
    slots = FAN ** levels
    size = F.lit(slots)
    return nodes.withColumns({"_from": start, "_upto": upto}) \
        .withColumn("block", F.explode(F.expr(f"sequence(_from div {slots}, (_upto - 1) div {slots})"))) \
        .withColumn("first", (F.greatest("_from", F.col("block") * size) - F.col("block") * size).cast("int")) \
        .withColumn("upto", (F.least("_upto", (F.col("block") + 1) * size) - F.col("block") * size).cast("int")) \
        .drop("_from", "_upto")


_NODE_TYPE = "group string, total long, place long, hash string"


def _reduced(nodes: DataFrame, levels: int) -> DataFrame:
    """(group, total, place, hash): the node that each block becomes."""
    schema = pa.schema([("group", pa.string()), ("total", pa.int64()), ("place", pa.int64()), ("hash", pa.string())])

    def run(table: pa.Table) -> pa.Table:
        total = table.column("total")[0].as_py()
        steps = _steps(total, levels)
        (top,) = _levels(_slot_array(table), steps)[-1]
        return pa.Table.from_pydict({"group": [table.column("group")[0].as_py()], "total": [-(-total // FAN ** steps)],
                                     "place": [table.column("block")[0].as_py()], "hash": [top]}, schema=schema)

    return nodes.select("group", "total", "block", "first", "upto", "hash").groupBy("group", "block") \
        .applyInArrow(run, _NODE_TYPE)


def _climb(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Dealt nodes of every round, from the given ones to those that are one per group."""
    rounds = [nodes]
    most = nodes.agg(F.max("total")).first()[0]
    while True:
        up = materialise(_dealt(_reduced(rounds[-1], levels), F.col("place"), F.col("place") + 1, levels), "nodes")
        rounds.append(up)
        most = -(-most // FAN ** levels)
        if most <= 1:
            return rounds


def _paths(nodes: DataFrame, above: DataFrame, levels: int, extra: list[str], finish, schema: str) -> DataFrame:
    """``finish`` gets each node's row, its slots' paths up to the block's node, and the path from there on."""
    def run(own: pa.Table, path: pa.Table) -> pa.Table:
        slots = _slot_array(own)
        tree = _levels(slots, _steps(own.column("total")[0].as_py(), levels))
        return finish(own, tree, [(p["left"], p["right"]) for p in path.column("path")[0].as_py()],
                      path.column("subroot")[0].as_py())

    columns = ["group", "total", "block", "first", "upto", "hash", *extra]
    up = above.select("group", F.col("place").alias("block"), "path", "subroot")
    return nodes.select(*columns).groupBy("group", "block").cogroup(up.groupBy("group", "block")).applyInArrow(run, schema)


def _siblings(levels: list[list[str]], slot: int) -> list[tuple[str, str]]:
    """The others of each run above a slot: those to the left, those to the right."""
    found = []
    for level in levels[:-1]:
        run = slot - slot % FAN
        found.append(("".join(level[run:slot]), "".join(level[slot + 1:run + FAN])))
        slot //= FAN
    return found


def _down(rounds: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """(group, place, path, subroot) of the nodes of the first round, from those of the last."""
    schema = pa.schema([("group", pa.string()), ("place", pa.int64()), ("subroot", pa.string()),
                        ("path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))])

    def finish(own: pa.Table, tree: list[list[str]], above: list, subroot: str | None) -> pa.Table:
        group, block = own.column("group")[0].as_py(), own.column("block")[0].as_py()
        n = len(tree[0])
        paths = [[{"left": a, "right": b} for a, b in _siblings(tree, i) + above] for i in range(n)]
        return pa.Table.from_pydict({"group": [group] * n, "place": [block * FAN ** levels + i for i in range(n)],
                                     "subroot": [subroot] * n, "path": paths}, schema=schema)

    for nodes in reversed(rounds[1:-1]):
        top = materialise(_paths(nodes, top, levels, [], finish, f"group string, place long, subroot string, path {_PATH}"),
                          "paths")
    return top


def _ordered(tops: DataFrame, levels: int) -> DataFrame:
    """One dealt node per group, placed in the order of the groups, all of one group ``root``."""
    names = tops.select("group", "hash").repartitionByRange("group").sortWithinPartitions("group")

    def number(batches):
        task, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "language": batch.column(0), "hash": batch.column(1), "task": pa.array([task] * batch.num_rows, pa.int32()),
                "place": pa.array(range(place, place + batch.num_rows), pa.int64())})
            place += batch.num_rows

    numbered = materialise(names.mapInArrow(number, "language string, hash string, task int, place long"), "subroots")
    tasks = numbered.groupBy("task").agg(F.count("*").alias("n"))  # a row per task
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = numbered.join(bases, "task").select(
        F.lit("root").alias("group"), F.lit(numbered.count()).cast("long").alias("total"),
        (F.col("place") + F.col("base")).alias("place"), "hash", "language")
    return materialise(_dealt(placed, F.col("place"), F.col("place") + 1, levels), "languages")


_RESULT = ("doc_id long, lang string, place long, leaf string, subroot string, root string, proof_sha256 string, "
           "folded_root string, verified boolean")


def manifest(docs: DataFrame, tampered: Column | None = None, fields: tuple[str, ...] = FIELDS,
             proofs: bool = False, levels: int = LEVELS) -> DataFrame:
    """Every row's leaf, place, proof and what its proof makes of the tampered row.

    Columns: doc_id, lang, place (from 0 in its language), leaf, subroot, root,
    proof_sha256 (of all siblings, from the leaf up, left to right),
    folded_root (from the leaf of the row with ``tampered`` for its text, where
    that is not null, and the original siblings), verified (folded_root equals
    root) and, with ``proofs``, proof: the siblings by level, those to the left
    and those to the right. ``fields`` are the hashed columns; doc_id, lang and
    text must be among the columns; ``levels`` are reduced by one slot array.

    Null values hash as ``-``; rows without a doc_id come first, those of the
    null language form a language of their own, before all others. Equal rows
    stay rows, each with its own place and proof. Other columns are not read,
    whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    columns = {c: F.col(f"`{c}`") for c in dict.fromkeys((*fields, "doc_id", "lang", "text"))}
    own = leaf([columns[c] for c in fields])
    altered = F.lit(None).cast("string") if tampered is None else \
        F.when(tampered.isNotNull(), leaf([tampered if c == "text" else columns[c] for c in fields]))
    group = F.coalesce(F.concat(F.lit("v"), columns["lang"].cast("string")), F.lit("n"))
    read = docs.select(group.alias("group"), columns["doc_id"].cast("long").alias("doc_id"), own.alias("leaf"),
                       altered.alias("altered"))
    rows = materialise(read.groupBy("group", "doc_id", "leaf")
                       .agg(F.max("altered").alias("altered"), F.count("*").alias("n")), "leaves")
    result = _RESULT + f", proof {_PATH}" * proofs
    if rows.isEmpty():
        return spark.createDataFrame([], result)
    placed = places(rows).withColumn("hash", F.col("leaf"))
    leaves = materialise(_dealt(placed, F.col("start"), F.col("start") + F.col("n"), levels), "placed")

    rounds = _climb(leaves.select("group", "total", "block", "first", "upto", "hash"), levels)
    languages = _ordered(rounds[-1], levels)
    over = _climb(languages, levels)
    root = over[-1].first()["hash"]
    empty = F.array().cast(_PATH)
    top = over[-1].select("group", F.lit(0).cast("long").alias("place"), empty.alias("path"),
                          F.lit(None).cast("string").alias("subroot"))
    top = _down(over, top, levels)
    schema = pa.schema([("group", pa.string()), ("place", pa.int64()), ("subroot", pa.string()),
                        ("path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))])

    def of_language(table: pa.Table, tree: list[list[str]], above: list, _: str | None) -> pa.Table:
        names, slots, hashes = (table.column(c).to_pylist() for c in ("language", "first", "hash"))
        return pa.Table.from_pydict(
            {"group": names, "place": [0] * len(names), "subroot": hashes,
             "path": [[{"left": a, "right": b} for a, b in _siblings(tree, i) + above] for i in slots]}, schema=schema)

    top = materialise(_paths(languages, top, levels, ["language"], of_language,
                             f"group string, place long, subroot string, path {_PATH}"), "paths")
    top = _down(rounds, top, levels)

    out_schema = pa.schema([
        ("doc_id", pa.int64()), ("lang", pa.string()), ("place", pa.int64()), ("leaf", pa.string()),
        ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()),
        ("verified", pa.bool_())])
    if proofs:
        out_schema = out_schema.append(schema.field("path").with_name("proof"))

    def of_leaves(table: pa.Table, tree: list[list[str]], above: list, subroot: str | None) -> pa.Table:
        group, block = table.column("group")[0].as_py(), table.column("block")[0].as_py()
        lang = group[1:] if group[0] == "v" else None
        out: dict[str, list] = {f.name: [] for f in out_schema}
        for lo, hi, doc_id, own, other in zip(*(table.column(c).to_pylist() for c in
                                                ("first", "upto", "doc_id", "hash", "altered"))):
            for slot in range(lo, hi):
                path = _siblings(tree, slot) + above
                folded = own if other is None else other
                for left, right in path:
                    folded = digest(left + folded + right)
                proof = digest("".join(left + right for left, right in path))
                for name, value in zip(out, (doc_id, lang, block * FAN ** levels + slot, own, subroot, root, proof, folded,
                                             folded == root, [{"left": a, "right": b} for a, b in path] if proofs else None)):
                    out[name].append(value)
        return pa.Table.from_pydict(out, schema=out_schema)

    return _paths(leaves, top, levels, ["doc_id", "altered"], of_leaves, result)
