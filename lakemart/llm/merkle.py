"""Merkle manifest of a data set by cogrouped subtree exchange (operator 12).

Tree. A document is a leaf: the lowercase hex SHA-256 of its columns, each as its length
in UTF-8 bytes, a colon and its value, or ``-`` if null. Per source the leaves ascend by
id; runs of three consecutive nodes become the hash of their hex texts, also a last run
of one, until one node is left. These subroots, by source, are nodes of one more tree of
that kind, whose last node is the root of the data set.

Method. Superblocks are ``3 ** levels`` consecutive nodes of a source. Upwards, each is reduced
to its top, tops are grouped into superblocks again, and so on; sources with many
documents take more rounds, and no group is larger than a superblock. Sources smaller than
that share groups of about its size, so a million sources of one document each don't make a
million groups. Downwards, the nodes of
a superblock and the outer nodes that its proofs need (the siblings of its top and of what is
above, at most two a level) are cogrouped by superblock in one applyInPandas, which reduces
the block again, joins inner and outer siblings to a proof for each node, and, at the
leaves, folds a leaf and its proof to a root. What comes out for a top is what the cogroup
below takes as outer nodes.

Places of documents come from a range sort: a count per source and sorted part, so a
source may hold any share of the rows.

Defined cases. A null source comes first; null ids come first in their source and count as
empty text where a checksum of the id is taken. Rows that repeat an id are leaves each, in
order of their hashes. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from lakemart.llm.common import Steps, import_on_executors, remainder

ARITY = 3
LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(columns: Sequence[Column]) -> Column:
    """The leaf of a row, as a column."""
    parts = []
    for column in columns:
        value = column.cast("string")
        known = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.when(column.isNull(), F.lit("-")).otherwise(known))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def heights(nodes: list[str], of_source: int, levels: int) -> list[list[str]]:
    """The nodes of a superblock, then those of each level above, up to its top.

    ``of_source`` is how many nodes the source has at the lowest of these levels. A source that
    fits into one superblock ends at its last node; in larger ones every superblock goes
    all levels up, the last one too.
    """
    out = [nodes]
    large = of_source > ARITY**levels
    while len(out) <= levels if large else len(out[-1]) > 1:
        held = out[-1]
        out.append([digest("".join(held[at : at + ARITY])) for at in range(0, len(held), ARITY)])
    return out


def siblings(held: list[str], place: int) -> tuple[str, str]:
    """The other nodes of a node's run: those before it and those after it, each joined."""
    run = place // ARITY * ARITY
    return "".join(held[run:place]), "".join(held[place + 1 : run + ARITY])


def inner_path(rows: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    """Siblings of a node of the lowest level, level by level up to the top."""
    before, after = [], []
    for held in rows[:-1]:
        left, right = siblings(held, place)
        before.append(left)
        after.append(right)
        place //= ARITY
    return before, after


def fold(node: str, before: Sequence[str], after: Sequence[str]) -> str:
    """What a node and its siblings, level by level, come to."""
    for left, right in zip(before, after):
        node = digest(left + node + right)
    return node


_NODE = "key string, position long, n long, node string"
_PATH = "key string, position long, n long, subroot string, before array<string>, after array<string>"


@dataclass
class Layer:
    """Nodes with ``key``, ``position`` and ``n`` of their source; buckets for small sources."""

    nodes: DataFrame
    buckets: int


def _sources(block: pd.DataFrame) -> Iterator[dict[str, list]]:
    """The nodes of each source in a group, by position."""
    block = block.sort_values(["key", "position"])
    keys = block["key"].to_numpy()
    bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    columns = {name: block[name].tolist() for name in block.columns}
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield {name: values[a:b] for name, values in columns.items()}


def _top(levels: int) -> Callable:
    size = ARITY**levels

    def top(block: pd.DataFrame) -> pd.DataFrame:
        out = []
        for nodes in _sources(block):
            n = nodes["n"][0]
            (node,) = heights(nodes["node"], n, levels)[-1]
            out.append((nodes["key"][0], nodes["position"][0] // size, -(-n // size), node))
        return pd.DataFrame(out, columns=["key", "position", "n", "node"])

    return top


def _placed(rows: DataFrame, small: Column, block: Column, buckets: int) -> DataFrame:
    """Rows with their group: a superblock of a source, or a bucket of small sources."""
    bucket = -1 - F.pmod(F.xxhash64("key"), F.lit(buckets))
    return rows.withColumns(
        {
            "group": F.when(small, F.lit("")).otherwise(F.col("key")),
            "block": F.when(small, bucket).otherwise(block).cast("long"),
        }
    )


def _grouped(layer: Layer, columns: Sequence[str], levels: int) -> GroupedData:
    size = ARITY**levels
    block = F.floor(F.col("position") / F.lit(size))
    placed = _placed(layer.nodes.select(*columns), F.col("n") <= size, block, layer.buckets)
    return placed.groupBy("group", "block")


def _up(steps: Steps, nodes: DataFrame, levels: int) -> list[Layer]:
    """The nodes, the tops of their superblocks, and so on until each key has one."""
    layers: list[Layer] = []
    while True:
        few = F.count(F.when(F.col("n") <= ARITY**levels, 1))
        most, small = nodes.agg(F.max("n"), few).first()
        layers.append(Layer(nodes, small // ARITY**levels + 1))
        if len(layers) > 1 and (most or 1) == 1:
            return layers
        tops = _grouped(layers[-1], ["key", "position", "n", "node"], levels)
        nodes = steps.keep(tops.applyInPandas(_top(levels), _NODE))


def _outer(right: pd.DataFrame) -> dict[str, tuple[str | None, list[str], list[str]]]:
    """For each source the subroot above its nodes, if it is known, and the siblings outside."""
    rows = zip(right["key"], right["subroot"], right["before"], right["after"])
    return {key: (subroot, list(before), list(after)) for key, subroot, before, after in rows}


_NOTHING: tuple[None, list[str], list[str]] = (None, [], [])


def _paths(levels: int, of_subroots: bool) -> Callable:
    """Proofs of a group's nodes, which are the outer nodes of the blocks below them."""

    def paths(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out, outer = [], _outer(right)
        for nodes in _sources(left):
            key, n = nodes["key"][0], nodes["n"][0]
            rows = heights(nodes["node"], n, levels)
            subroot, outer_before, outer_after = outer.get(key, _NOTHING)
            for place, (position, owner, node) in enumerate(zip(nodes["position"], nodes["owner"], nodes["node"])):
                before, after = inner_path(rows, place)
                at = (owner, 0, 1, node) if of_subroots else (key, position, n, subroot)
                out.append((*at, before + outer_before, after + outer_after))
        return pd.DataFrame(out, columns=["key", "position", "n", "subroot", "before", "after"])

    return paths


def _leaf_rows(levels: int, root: str, columns: list[str], make: Callable) -> Callable:
    def rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out, outer = [], _outer(right)
        for nodes in _sources(left):
            held = heights(nodes["node"], nodes["n"][0], levels)
            subroot, outer_before, outer_after = outer[nodes["key"][0]]
            for place, (doc_id, node, changed) in enumerate(zip(nodes["doc_id"], nodes["node"], nodes["changed"])):
                before, after = inner_path(held, place)
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                found = make(node, changed, before + outer_before, after + outer_after, root)
                out.append((doc_id, node, subroot, root, *found))
        frame = pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", *columns])
        return frame.astype({"doc_id": "Int64"})

    return rows


def _down(
    layer: Layer, columns: Sequence[str], outer: DataFrame, levels: int, function: Callable, schema: str
) -> DataFrame:
    """What a function makes of the nodes of each group and the outer nodes they need."""
    # a source is small in a layer if one node is left of it in the layer above
    right = _placed(outer, F.col("n") == 1, F.col("position"), layer.buckets).groupBy("group", "block")
    return _grouped(layer, columns, levels).cogroup(right).applyInPandas(function, schema)


def ranked(steps: Steps, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``position`` among those of their ``key`` and ``n``, how many these are."""
    sort = ["key", *order]
    laid = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    laid = steps.keep(laid.withColumn("row", F.monotonically_increasing_id()))
    laid = laid.withColumn("part", F.shiftright("row", 33))
    parts = laid.groupBy("key", "part").agg(F.count(F.lit(1)).alias("held"), F.min("row").alias("first"))
    of_key = Window.partitionBy("key")
    earlier = of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "key",
        "part",
        (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(of_key).alias("n"),
    )
    # a row per part and per source: it may grow with the sources, so it isn't broadcast
    placed = laid.join(parts.hint("merge"), ["key", "part"])
    return placed.withColumn("position", F.col("row") + F.col("shift")).drop("row", "part", "shift")


def _manifest(
    docs: DataFrame,
    columns: Sequence[str],
    id_col: str,
    group_col: str,
    changed: Column | None,
    levels: int,
    names: list[str],
    schema: str,
    make: Callable,
) -> DataFrame:
    import_on_executors(docs.sparkSession)
    steps = Steps(docs.sparkSession)
    leaf, other = leaf_of([docs[c] for c in columns]), changed if changed is not None else F.lit(None)
    source = docs[group_col].cast("string")
    leaves = steps.keep(
        docs.select(
            # a null source comes before all others, also before an empty one
            F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source)).alias("key"),
            docs[id_col].cast("long").alias("doc_id"),
            leaf.alias("node"),
            other.cast("string").alias("changed"),
            # equal rows are told apart, so that any number of them can be spread
            F.monotonically_increasing_id().alias("given"),
        )
    )
    leaves = steps.keep(ranked(steps, leaves, ["doc_id", "node", "given"]).drop("given"))
    trees = _up(steps, leaves, levels)
    subroots = trees[-1].nodes.select(F.col("key").alias("owner"), F.lit("").alias("key"), "node")
    subroots = steps.keep(ranked(steps, subroots, ["owner"]))
    forest = _up(steps, subroots, levels)
    last = forest[-1].nodes.first()
    root = last["node"] if last else ""

    columns = ["key", "position", "n", "node", "owner"]
    above = [Layer(x.nodes.withColumn("owner", F.lit(None).cast("string")), x.buckets) for x in forest[1:-1]]
    outer = docs.sparkSession.createDataFrame([], _PATH)
    for layer in reversed(above):
        outer = steps.keep(_down(layer, columns, outer, levels, _paths(levels, False), _PATH))
    outer = steps.keep(_down(forest[0], columns, outer, levels, _paths(levels, True), _PATH))
    above = [Layer(x.nodes.withColumn("owner", F.lit(None).cast("string")), x.buckets) for x in trees[1:-1]]
    for layer in reversed(above):
        outer = steps.keep(_down(layer, columns, outer, levels, _paths(levels, False), _PATH))
    steps.drop_all_but(leaves, outer)
    rows = _leaf_rows(levels, root, names, make)
    schema = f"doc_id long, leaf string, subroot string, root string, {schema}"
    columns = ["key", "position", "n", "node", "doc_id", "changed"]
    return _down(trees[0], columns, outer, levels, rows, schema)


def _proof(node: str, changed: str | None, before: list[str], after: list[str], root: str) -> tuple:
    return before, after


def _audit(node: str, changed: str | None, before: list[str], after: list[str], root: str) -> tuple:
    proof = digest("".join([left + right for left, right in zip(before, after)]))
    folded = fold(changed if isinstance(changed, str) else node, before, after)
    return proof, folded, folded == root


def merkle_proofs(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "source",
    levels: int = LEVELS,
) -> DataFrame:
    """doc_id, leaf, subroot, root and the proof of each document.

    The proof is two arrays with an entry a level: the siblings before and those after the
    node, each joined; ``fold`` makes the root of a leaf and these.
    """
    schema = "before array<string>, after array<string>"
    return _manifest(docs, columns, id_col, group_col, None, levels, ["before", "after"], schema, _proof)


def merkle_audit(
    docs: DataFrame,
    changed: Column | None = None,
    columns: Sequence[str] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "source",
    levels: int = LEVELS,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``changed`` is the leaf as found later, null where it is the recorded one. It is folded
    with the recorded siblings; ``verified`` tells whether that gives the recorded root.
    ``proof_sha256`` is the hash of all siblings, level by level, left to right.
    """
    names = ["proof_sha256", "folded_root", "verified"]
    schema = "proof_sha256 string, folded_root string, verified boolean"
    return _manifest(docs, columns, id_col, group_col, changed, levels, names, schema, _audit)


def without_line_feeds(docs: DataFrame, columns: Sequence[str] = COLUMNS) -> Column:
    """Leaves of documents that lost their line feeds, for ids with an even checksum; else null."""
    text = F.replace(docs["text"].cast("string"), F.lit("\n"), F.lit(""))
    found = leaf_of([text if c == "text" else docs[c] for c in columns])
    return F.when(remainder(docs["doc_id"], 2) == 0, found)
