"""Operator 13: Merkle manifest of a dataset as a persistent, path-copying tree.

Every row is a leaf (sha256 of its fields).  The leaves of a group (source) ascend by id; every
``ARITY`` consecutive digests become the sha256 of their concatenated hex text until one remains,
the group's subroot; the subroots, ordered by group, become the root in the same way.

Spread: rows are numbered within their group by one range partitioning, counts per partition and
offsets.  Aligned blocks of ``ARITY ** HEIGHT`` nodes are whole subtrees: a task builds a block's
tree and passes on its top, the tops form the blocks of the next level, and so on (the number
of levels is the logarithm of the largest group).  On the way back every block gets its upper
path: the digests left and right of it, level by level up to the root.

A changed leaf makes a version of its block's tree that shares all untouched nodes and copies only
the leaf's ancestors (``put``); the version's top goes on along the upper path, copying one ancestor
a level, in the task that holds the block.  No version copies a tree, and no task holds more than a
block's rows.  Texts are hashed where they are read; only digests are shuffled.

Nulls and edge cases: a null field counts as ``-``; null groups come first, null ids first in their
group; rows that repeat an id are leaves of their own, ordered by their digests; a row without an id
is never tampered by the contract's rule; a lone leaf is its subroot, a lone subroot the root, and a proof
without siblings the sha256 of nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martcraft.session import materialize

ARITY = 3
HEIGHT = 7                       # levels of a block: 2,187 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

Step = tuple[str, str]           # digests left and right of a node within its run, as hex text


class Node(NamedTuple):
    digest: str
    kids: tuple[Node, ...] = ()


def join(kids: tuple[Node, ...]) -> Node:
    return Node(sha256("".join([k.digest for k in kids]).encode()).hexdigest(), kids)


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def grow(digests: list[str], levels: int) -> Node:
    nodes = [Node(d) for d in digests]
    for _ in range(levels):
        nodes = [join(tuple(nodes[i:i + ARITY])) for i in range(0, len(nodes), ARITY)]
    return nodes[0]


def put(top: Node, at: int, levels: int, digest: str) -> Node:
    """The version of the tree with another leaf: its ancestors are copied, all other nodes shared."""
    if levels == 0:
        return Node(digest)
    k, rest = divmod(at, ARITY ** (levels - 1))
    kids = top.kids
    return join((*kids[:k], put(kids[k], rest, levels - 1, digest), *kids[k + 1:]))


def steps(top: Node, at: int, levels: int) -> list[Step]:
    """The siblings of a leaf and of its ancestors, from the leaf up."""
    out: list[Step] = []
    while levels:
        levels -= 1
        k, at = divmod(at, ARITY ** levels)
        out.append(("".join([n.digest for n in top.kids[:k]]), "".join([n.digest for n in top.kids[k + 1:]])))
        top = top.kids[k]
    return out[::-1]


def climb(digest: str, path: list[Step]) -> str:
    """The top above a node, an ancestor copied at each step."""
    for left, right in path:
        digest = sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    """sha256 (32 bytes) of the columns, each with its length in bytes before it."""
    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def number_rows(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (0, 1, ... by ``order`` within ``group``, nulls first) and ``n`` (rows of the group).

    One range partitioning, so a group may be of any size; a window only sees a row per partition."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ([group] if group else []) + order + ["__tie"]
    line = materialize(rows.withColumn("__tie", F.monotonically_increasing_id())
                       .repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("__tie")
                       # the partition's number in the upper bits, the place in it in the lower ones
                       .withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33).alias("__part")
    g = F.col(group) if group else F.lit(0)
    cells = line.groupBy(part, g.alias("__g")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__c"))
    whole = W.partitionBy("__g")
    before = whole.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("__part", "__g", "__first", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"),
                         F.sum("__c").over(whole).alias("n"))
    found = line.join(cells, (part == cells["__part"]) & g.eqNullSafe(F.col("__g")))
    return found.select(*rows.columns, (F.col("__at") - F.col("__first") + F.col("__off")).alias("pos"), "n")


def _by_block(nodes: DataFrame, levels: int) -> DataFrame:
    block = F.expr(f"pos div {ARITY ** levels}")
    return nodes.withColumn("block", block).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block; columns grp and block lead."""
    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if held and (held[0]["grp"], held[0]["block"]) != (row["grp"], row["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


_PATH = "array<struct<left: string, right: string>>"


def _as_rows(path: list[Step]) -> list[dict]:
    return [{"left": left, "right": right} for left, right in path]


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """nodes (grp, pos, n, digest) -> the tops of their blocks, of the same columns."""
    def run(batches):
        for rows in _runs(batches):
            n = rows[0]["n"]
            top = grow([r["digest"].hex() for r in rows], min(levels, height(n)))
            yield pa.RecordBatch.from_pylist([{"grp": rows[0]["grp"], "pos": rows[0]["block"], "n": -(-n // ARITY ** levels),
                                               "digest": bytes.fromhex(top.digest)}])

    return materialize(_by_block(nodes, levels).select("grp", "block", "n", "digest").mapInArrow(
        run, "grp long, pos long, n long, digest binary"))


def _paths(nodes: DataFrame, levels: int) -> DataFrame:
    """nodes (grp, pos, n, digest) -> grp, pos, block, path: each node's siblings up to its block's top."""
    def run(batches):
        for rows in _runs(batches):
            h = min(levels, height(rows[0]["n"]))
            top = grow([r["digest"].hex() for r in rows], h)
            yield pa.RecordBatch.from_pylist([{"grp": r["grp"], "pos": r["pos"], "block": r["block"],
                                               "path": _as_rows(steps(top, i, h))} for i, r in enumerate(rows)], schema)

    schema = pa.schema([("grp", pa.int64()), ("pos", pa.int64()), ("block", pa.int64()),
                        ("path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))])
    return _by_block(nodes, levels).select("grp", "block", "pos", "n", "digest").mapInArrow(
        run, f"grp long, pos long, block long, path {_PATH}")


def _tower(nodes: DataFrame, most: int, span: int) -> tuple[DataFrame, DataFrame]:
    """(top nodes, one per group; grp, pos, path of the bottom blocks' tops up to them).

    ``most``: nodes of the largest group; ``span``: levels of a block."""
    levels = [_tops(nodes, span)]
    while most > ARITY ** span:
        most = -(-most // ARITY ** span)
        levels.append(_tops(levels[-1], span))
    path = levels[-1].select("grp", "pos", F.array().cast(_PATH).alias("path"))
    for below in levels[-2::-1]:
        up = path.select("grp", F.col("pos").alias("block"), F.col("path").alias("up"))
        path = materialize(_paths(below, span).join(up, ["grp", "block"]).select(
            "grp", "pos", F.concat("path", "up").alias("path")))
    return levels[-1], path


class Manifest(NamedTuple):
    """A dataset's tree: ``leaves`` (id, grp, pos, n, digest, forged), ``groups`` (group, n, subroot, root) and
    ``paths`` (grp, block, path up to the subroot, above to the root), over blocks of ``levels`` levels."""
    leaves: DataFrame
    groups: DataFrame
    paths: DataFrame
    levels: int


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
          forged: dict[str, Column] | None = None, tampered: Column | None = None, levels: int = HEIGHT) -> Manifest:
    """The tree over ``docs``.  Where ``tampered`` holds, ``forged`` gives the changed values of some fields."""
    changed = F.lit(None).cast("binary")
    if tampered is not None:
        changed = F.when(tampered, leaf_digest([(forged or {}).get(f, F.col(f)) for f in fields]))
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp_key"),
                       leaf_digest([F.col(f) for f in fields]).alias("digest"), changed.alias("forged"))
    line = number_rows(rows, "grp_key", ["id", "digest"])
    groups = number_rows(line.groupBy("grp_key").agg(F.max("n").alias("size")), None, ["grp_key"])
    groups = materialize(groups.withColumnRenamed("pos", "grp"))
    numbers = groups.select(F.col("grp_key").alias("key"), "grp")
    leaves = materialize(line.join(numbers, F.col("grp_key").eqNullSafe(F.col("key"))).drop("grp_key", "key"))
    bounds = groups.agg(F.max("size"), F.max("n")).first()
    most, n_groups = bounds[0] or 0, bounds[1] or 0
    subroots, paths = _tower(leaves.select("grp", "pos", "n", "digest"), most, levels)
    line = subroots.select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("pos"),
                           F.lit(n_groups).cast("long").alias("n"), "digest")
    root, above = _tower(line, n_groups, levels)
    # the path of a subroot: within its block, then from the block's top on
    own = _paths(line, levels).join(above.select(F.col("pos").alias("block"), F.col("path").alias("up")), "block").select(
        F.col("pos").alias("grp"), F.concat("path", "up").alias("above"))
    hexed = lambda c: F.lower(F.hex(c))
    tops = subroots.select("grp", hexed("digest").alias("subroot")).join(own, "grp").crossJoin(
        F.broadcast(root.select(hexed("digest").alias("root"))))          # one row
    tops = materialize(tops)
    paths = paths.select("grp", F.col("pos").alias("block"), "path").join(tops, "grp")
    kept = groups.join(tops.drop("above"), "grp").select(F.col("grp_key").alias(group_col), F.col("size").alias("n"),
                                                         "subroot", "root")
    return Manifest(leaves, kept, paths, levels)


def audit(tree: Manifest, id_col: str = "doc_id", with_proof: bool = False) -> DataFrame:
    """Per leaf: id, leaf, subroot, root, proof_sha256, folded_root (of its version: the forged leaf, where there is
    one, under the original siblings), verified; with ``proof`` (the siblings, left to right, level by level)."""
    id_type = tree.leaves.schema["id"].dataType
    span = tree.levels
    items = tree.leaves.withColumn("block", F.expr(f"pos div {ARITY ** span}"))
    heads = tree.paths.withColumn("pos", F.lit(-1).cast("long"))
    both = heads.select("grp", "block", "pos", F.lit(None).cast("long").alias("n"), F.lit(None).cast(id_type).alias("id"),
                        F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("binary").alias("forged"),
                        "path", "above", "subroot", "root").unionByName(items, allowMissingColumns=True)
    both = both.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")

    def pairs(steps_: list[dict]) -> list[Step]:
        return [(s["left"], s["right"]) for s in steps_]

    def run(batches):
        id_arrow = None

        def noted():
            nonlocal id_arrow
            for b in batches:
                id_arrow = b.schema.field("id").type
                yield b

        for rows in _runs(noted()):
            head, rows = rows[0], rows[1:]
            up = pairs(head["path"]) + pairs(head["above"])
            up_text = "".join([left + right for left, right in up])
            h = min(span, height(rows[0]["n"]))
            top = grow([r["digest"].hex() for r in rows], h)
            out: dict[str, list] = {name: [] for name in names}
            for i, r in enumerate(rows):
                own = steps(top, i, h)
                leaf = r["digest"].hex()
                version = put(top, i, h, leaf if r["forged"] is None else r["forged"].hex())
                folded = climb(version.digest, up)
                text = "".join([left + right for left, right in own]) + up_text
                values = (r["id"], leaf, head["subroot"], head["root"], sha256(text.encode()).hexdigest(), folded,
                          folded == head["root"])
                if with_proof:
                    values += ([text[k:k + 64] for k in range(0, len(text), 64)],)
                for name, v in zip(names, values):
                    out[name].append(v)
            ids = pa.array(out[id_col], id_arrow)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(out[n], kinds[n]) for n in names[1:])], names)

    kinds = {"leaf": pa.string(), "subroot": pa.string(), "root": pa.string(), "proof_sha256": pa.string(),
             "folded_root": pa.string(), "verified": pa.bool_()}
    if with_proof:
        kinds["proof"] = pa.list_(pa.string())
    names = [id_col, *kinds]
    ddl = {"verified": "boolean", "proof": "array<string>"}
    schema = f"`{id_col}` {id_type.simpleString()}, " + ", ".join(f"{k} {ddl.get(k, 'string')}" for k in kinds)
    return both.mapInArrow(run, schema)


def without_line_breaks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The contract's tampering: ids with an even crc32 of their decimal text lose the line breaks of their text."""
    return {"forged": {text_col: F.replace(F.col(text_col), F.lit("\n"), F.lit(""))},
            "tampered": F.coalesce(F.crc32(F.col(id_col).cast("string")) % 2 == 0, F.lit(False))}


def verify(docs: DataFrame, **names) -> DataFrame:
    """The contract's rows: every document's proof, and the root that its possibly tampered leaf folds to."""
    return audit(build(docs, **without_line_breaks(docs), **names))
