"""N-gram Jaccard join: documents whose word n-gram sets are alike (operator 1).

Method. Each text becomes the set of its word 5-grams (A-Z lowered, words split
at ASCII white space). Texts with one and the same set form a class and travel
as one row. MinHash values are cut into bands; their number is the least that
finds a pair at the threshold with the target recall. Classes that share a band
are compared by all their MinHash values, which leaves plausible pairs; those
that hang together form candidate groups. In each candidate group all pairs that
these values leave plausible are verified on the full n-gram sets, so a pair that no band
caught is found too if it hangs together with others.

Large groups. Buckets and candidate groups of more than ``block`` members are
cut into blocks, and pairs of blocks go to different tasks. In such a candidate group MinHash
values, which are small, tell first which pairs of blocks a member has a plausible
partner in, and its full set goes to those only: in a chain, where each text is like
a few others, sets don't meet the rest of the group. Tasks return edges
of spanning trees and sums of links, never pairs, so rows grow with the members
and not with their square.

The text of a class is fetched by the id and a hash of the text of one of its rows, so
rows without an id, or of one id, don't meet each other.

Defined cases. Null text is empty. A text without words has no n-gram and links
to nothing, not even to another empty text. A text of one to four words has one
n-gram, all its words. Rows that repeat an id are documents of their own; a
group is named by its least id, or by a negative number if all its ids are null.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import Steps, binaries, chunks, complete_runs, id_and_text, words_of
from lakemart.llm.graph import components

ROWS = 4
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
WORDS = 5
BLOCK = 256

_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """The least number of bands that catch a pair at the threshold so surely."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def ngram_sets(text: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams of the texts, one after another, and their starts."""
    words, starts = words_of(text)
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    hashes = np.array(
        [xxhash.xxh3_64_intdigest(word) for word in coded.dictionary.to_pylist()], dtype=np.uint64
    )
    ids = coded.indices.to_numpy(zero_copy_only=False)
    values = hashes[ids] if len(ids) else np.zeros(0, dtype=np.uint64)
    counts = np.diff(starts)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(grams)])
    # position of each n-gram's first word
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts[:-1], grams)
    left = np.repeat(starts[1:], grams) - at
    out = np.zeros(len(at), dtype=np.uint64)
    padded = np.concatenate([values, np.zeros(n, dtype=np.uint64)])
    for k in range(n):
        word = np.where(left > k, padded[at + k], np.uint64(k + 1))
        out = mixed(out * np.uint64(0x100000001B3) + word)
    return out, offsets


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(31))


def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(_MIX[0]))
    return seeds[:n] | np.uint64(1), seeds[n:]


def minhashes(grams: np.ndarray, offsets: np.ndarray, n: int, piece: int = 1 << 15) -> np.ndarray:
    """``n`` least 32-bit hash values per set; sets must not be empty."""
    factors, masks = _factors(n)
    out = np.full((len(offsets) - 1, n), 0xFFFFFFFF, dtype=np.uint32)
    at = 0
    while at < len(offsets) - 1:
        # so many sets that their hashes stay in the processor's cache
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + piece, "right")) - 1)
        part = grams[offsets[at] : offsets[to]]
        begins = offsets[at:to] - offsets[at]
        for k in range(n):
            values = ((part ^ masks[k]) * factors[k] >> np.uint64(32)).astype(np.uint32)
            out[at:to, k] = np.minimum.reduceat(values, begins)
        at = to
    return out


def _sets(text: pa.Array, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The n-gram set of each text, sorted, and whether it has any."""
    grams, offsets = ngram_sets(text, n)
    sets = [np.unique(grams[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return sets, np.diff(offsets) > 0


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    digests = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
    return np.frombuffer(digests, dtype="<i8").reshape(-1, 2)


def _sketches(bands: int, rows: int, n: int) -> Callable:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 36
        for batch in chunks(batches):
            sets, filled = _sets(batch.column("text"), n)
            halves = _digests(sets)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(filled)
            least = np.zeros((len(sets), bands * rows), dtype=np.uint32)
            if len(full):
                kept = np.concatenate([sets[i] for i in full])
                least[full] = minhashes(
                    kept, np.concatenate([[0], np.cumsum(sizes[full])]), bands * rows
                )
            keys = np.zeros((len(sets), bands), dtype=np.uint64)
            for k in range(rows):
                keys = mixed(keys * np.uint64(_MIX[0]) + least[:, k::rows])
            keys = mixed(keys + np.arange(bands, dtype=np.uint64))
            short = (least & np.uint32(0xFF)).astype(np.uint8)
            yield pa.record_batch(
                {
                    "row": pa.array(task + np.arange(len(sets)), pa.int64()),
                    "doc_id": batch.column("doc_id"),
                    "t1": batch.column("t1"),
                    "t2": batch.column("t2"),
                    "h1": pa.array(halves[:, 0]),
                    "h2": pa.array(halves[:, 1]),
                    "grams": pa.array(sizes),
                    "sketch": binaries(list(short)),
                    "bands": pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1) * bands, pa.int32()),
                        pa.array(keys.view(np.int64).ravel()),
                    ),
                }
            )
            task += len(sets)

    return sketch


_SKETCH = (
    "row long, doc_id long, t1 long, t2 long, h1 long, h2 long, grams long, sketch binary, "
    "bands array<long>"
)


def _in_blocks(df: DataFrame, key: str, node: str, block: int, steps: Steps) -> DataFrame:
    """Rows with block numbers ``bi`` <= ``bj`` and their own ``side``.

    A key with up to ``block`` rows has one block. A larger one has each row in
    the pairs of its own block with every block of the key.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
    sizes = steps.keep(sizes.select(F.struct(key).alias("_key"), "size"))
    blocks = F.coalesce(F.ceil(F.col("size") / block), F.lit(1)).cast("int")
    placed = (
        df.join(sizes, F.struct(df[key]) == sizes["_key"], "left")
        .withColumn("side", F.pmod(F.xxhash64(node), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    )
    return placed.select(
        *df.columns,
        "side",
        F.least("side", "other").alias("bi"),
        F.greatest("side", "other").alias("bj"),
    )


#: Blocks of full sets for each block of MinHash values.
WIDER = 8


def _places(candidates: DataFrame, block: int, least: int, steps: Steps) -> DataFrame:
    """Where full sets go: node with ``places``, its side and pair of blocks in each.

    A candidate group of up to ``block`` members is one block. In a larger one a member
    goes to the pairs of blocks in which it has a plausible partner.
    """
    sizes = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
    sizes = steps.keep(sizes.withColumnRenamed("component", "large"))
    sided = candidates.select("component", "node", "sketch").join(sizes, F.col("component") == F.col("large"), "left")
    alone = sided.where("size is null").select(
        "node", F.lit(0).alias("side"), F.lit(0).alias("bi"), F.lit(0).alias("bj")
    )
    blocks = F.ceil(F.col("size") / block).cast("int")
    large = sided.where("size is not null").withColumn("side", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    wide = F.floor(F.col("side") / WIDER).cast("int")
    last = F.floor((blocks - 1) / WIDER).cast("int")
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), last))).select(
        "component", "node", "sketch", "side", F.least(wide, "other").alias("wi"), F.greatest(wide, "other").alias("wj")
    )
    partners = _grouped(large, ["component", "wi", "wj"], "node").mapInArrow(
        _partners(least), "node long, side int, bi int, bj int"
    )
    places = alone.union(partners).groupBy("node").agg(F.collect_list(F.struct("side", "bi", "bj")).alias("places"))
    return steps.keep(places)


def _partners(least: int) -> Callable:
    """For each member the pairs of blocks in which another one is plausibly alike."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in complete_runs(batches, ["component", "wi", "wj"]):
            nodes, sides = (rows.column(name).to_numpy() for name in ("node", "side"))
            apart = rows.column("wi").to_numpy() != rows.column("wj").to_numpy()
            sketches = rows.column("sketch")
            out: list[np.ndarray] = []
            for a, b in zip(starts[:-1], starts[1:]):
                raw = b"".join(sketches.slice(a, b - a).to_pylist())
                values = np.frombuffer(raw, dtype=np.uint8).reshape(b - a, -1)
                own = sides[a:b]
                every = np.arange(b - a)
                for i in range(b - a):
                    near = agree(values, i, every) >= least
                    near[i] = False
                    if apart[a]:
                        near &= own // WIDER != own[i] // WIDER
                    found = np.unique(own[near])
                    place = np.full((len(found), 4), nodes[a + i])
                    place[:, 1] = own[i]
                    place[:, 2], place[:, 3] = np.minimum(found, own[i]), np.maximum(found, own[i])
                    out.append(place)
            found = np.concatenate(out) if out else np.zeros((0, 4), dtype=np.int64)
            yield pa.record_batch(
                [pa.array(found[:, 0])] + [pa.array(found[:, k], pa.int32()) for k in (1, 2, 3)],
                names=["node", "side", "bi", "bj"],
            )

    return find


def _grouped(df: DataFrame, keys: list[str], node: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, node)


def _plausible(least: int) -> Callable:
    """Edges that connect what the sketches say is alike, within each run of a bucket."""

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in complete_runs(batches, ["bucket", "bi", "bj"]):
            size = np.diff(starts)
            if not (size > 1).any():
                continue
            nodes = rows.column("node").to_numpy()
            sketches = rows.column("sketch")
            froms, tos = [], []
            for at, n in zip(starts[:-1][size > 1], size[size > 1]):
                raw = b"".join(sketches.slice(at, n).to_pylist())
                values = np.frombuffer(raw, dtype=np.uint8).reshape(n, -1)
                for a, b in spanning(n, lambda i, rest: agree(values, i, rest) >= least):
                    froms.append(nodes[at + a])
                    tos.append(nodes[at + b])
            if froms:
                yield pa.record_batch({"a": pa.array(froms, pa.int64()), "b": pa.array(tos, pa.int64())})

    return connect


def agree(values: np.ndarray, i: int, rest: np.ndarray) -> np.ndarray:
    return (values[rest] == values[i]).sum(axis=1)


def spanning(n: int, alike: Callable) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the graph that ``alike(i, rest)`` tells the edges of."""
    rest = np.arange(n)
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            near = alike(i, rest)
            for j in rest[near]:
                yield i, int(j)
                queue.append(int(j))
            rest = rest[~near]


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows with one id and text the first in each chunk, as one is enough."""
    for batch in chunks(batches):
        ids = batch.column("doc_id")
        columns = [ids.is_null().cast(pa.int64()), pc.fill_null(ids, 0), batch.column("t1"), batch.column("t2")]
        keys = np.stack([column.to_numpy(zero_copy_only=False) for column in columns])
        _, first = np.unique(keys, axis=1, return_index=True)
        yield batch.take(pa.array(np.sort(first)))


def _texts(n: int) -> Callable:
    """Full n-gram sets of the candidates; texts of another class go."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found, _ = _sets(batch.column("text"), n)
            halves = _digests(found)
            own = (halves[:, 0] == batch.column("h1").to_numpy()) & (
                halves[:, 1] == batch.column("h2").to_numpy()
            )
            kept = batch.select(["component", "node", "copies"]).filter(pa.array(own))
            yield kept.append_column(
                "grams", binaries([s for s, o in zip(found, own) if o])
            )

    return sets


def _verified(threshold: float) -> Callable:
    """Links of each node within its run, and edges of a spanning forest of the links."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in complete_runs(batches, ["component", "bi", "bj"]):
            out: list[tuple] = []
            nodes = rows.column("node").to_numpy()
            copies = rows.column("copies").to_numpy()
            sides = rows.column("side").to_numpy()
            apart = rows.column("bi").to_numpy() != rows.column("bj").to_numpy()
            for a, b in zip(starts[:-1], starts[1:]):
                # repeated rows of one class follow each other
                own = a + np.flatnonzero(np.append(True, nodes[a + 1 : b] != nodes[a : b - 1]))
                sets = [np.frombuffer(rows.column("grams")[int(i)].as_buffer(), np.uint64) for i in own]
                linked = links(sets, threshold)
                pairs = linked & (sides[own][:, None] != sides[own]) if apart[a] else linked
                texts, documents = pairs.sum(axis=1), pairs @ copies[own]
                edge = dict()
                for i, j in spanning(len(own), lambda i, rest: linked[i, rest]):
                    edge.setdefault(j, i)
                for k, i in enumerate(own):
                    to = nodes[own[edge[k]]] if k in edge else nodes[i]
                    out.append((nodes[i], int(texts[k]), int(documents[k]), to))
            yield pa.record_batch(
                [pa.array(column, pa.int64()) for column in zip(*out)],
                names=["node", "texts", "documents", "to"],
            )

    return verify


def links(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether the Jaccard similarity of two different sets of sorted values reaches the threshold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    common = np.zeros((n, n), dtype=np.float32)
    if n <= 4:
        for i in range(n):
            for j in range(i):
                common[i, j] = common[j, i] = len(np.intersect1d(sets[i], sets[j], True))
    else:
        values, column, count = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True
        )
        row = np.repeat(np.arange(n), sizes)
        shared = count[column] > 1
        number = np.cumsum(count > 1) - 1
        row, column = row[shared], number[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        width = 4096
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [low, low + width])
            part = np.zeros((n, width), dtype=np.float32)
            part[row[a:b], column[a:b] - low] = 1
            common += part @ part.T
    # whole numbers below 2**24, so exact; compared without division
    total = sizes[:, None] + sizes - common.astype(np.int64)
    out = common.astype(np.float64) >= threshold * total - 1e-9
    np.fill_diagonal(out, False)
    return out


def ngram_jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    n: int = WORDS,
    rows: int = ROWS,
    recall: float = TARGET_RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_copies, n_text_links, n_links.

    ``class_id`` is the least doc_id among the documents that links connect.
    ``n_copies`` counts documents with the same n-gram set, itself included,
    ``n_text_links`` the other sets at ``threshold`` or more, ``n_links`` the
    other documents at ``threshold`` or more, copies included.
    """
    sketches, members, steps = _members(docs, id_col, text_col, threshold, n, rows, recall, block)
    names = members.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    names = names.select(F.struct("component").alias("_key"), "class_id")
    named = members.join(names, F.struct(members["component"]) == names["_key"])
    named = steps.keep(
        named.select(
            "h1",
            "h2",
            F.coalesce("class_id", -1 - F.col("component")).alias("class_id"),
            F.col("copies").alias("n_copies"),
            F.coalesce("texts", F.lit(0)).alias("n_text_links"),
            (F.coalesce("documents", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    steps.drop_all_but(sketches, named)
    return sketches.select("doc_id", "row", "h1", "h2").join(named, ["h1", "h2"], "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id", -1 - F.col("row")).alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def first_of_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    n: int = WORDS,
    rows: int = ROWS,
    recall: float = TARGET_RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One ``key`` per group of documents with words that links connect.

    The key is that of ``row_key``, of a document with the group's least id; a
    null id comes last.
    """
    _, members, steps = _members(docs, id_col, text_col, threshold, n, rows, recall, block)
    steps.drop_all_but(members)
    return members.groupBy("component").agg(F.min("least").alias("least")).select("least.key")


def row_key(id_col: Column, text_col: Column) -> Column:
    """What tells rows apart: the id and a 128-bit hash of the text, where null counts as empty."""
    text = F.coalesce(text_col.cast("string"), F.lit(""))
    return F.struct(
        id_col.cast("long").alias("doc_id"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
    )


def _members(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    threshold: float,
    n: int,
    rows: int,
    recall: float,
    block: int,
) -> tuple[DataFrame, DataFrame, Steps]:
    """Sketches of all rows, and the classes of equal sets with their groups and links."""
    spark = docs.sparkSession
    steps = Steps(spark)
    bands = bands_for(threshold, rows, recall)
    # 0.25 below the threshold is over five standard errors of 72 values
    least = math.floor((threshold - 0.25) * bands * rows)

    texts = id_and_text(docs, id_col, text_col)
    hashed = texts.select("*", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    sketches = steps.keep(
        hashed.select("doc_id", "text", "key.t1", "key.t2").mapInArrow(
            _sketches(bands, rows, n), _SKETCH
        )
    )
    key = F.struct("doc_id", "t1", "t2")
    classes = steps.keep(
        sketches.where("grams > 0")
        .groupBy("h1", "h2")
        .agg(
            F.min("row").alias("node"),
            F.min("doc_id").alias("doc_id"),
            F.min(F.struct(F.col("doc_id").isNull().alias("last"), key.alias("key"))).alias("least"),
            F.count(F.lit(1)).alias("copies"),
            F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"),
        )
    )
    banded = classes.select(F.explode("bands").alias("bucket"), "node", "sketch")
    # a pair of blocks of sketches is small, so blocks may be larger here
    banded = _in_blocks(banded, "bucket", "node", 8 * block, steps).drop("side")
    plausible = _grouped(banded, ["bucket", "bi", "bj"], "node").mapInArrow(
        _plausible(least), "a long, b long"
    )
    found = steps.keep(components(plausible, steps))
    wanted = F.col("least.key").alias("wanted")
    candidates = found.join(classes.select("h1", "h2", "node", "copies", "sketch", wanted), "node")
    candidates = steps.keep(candidates)
    once = hashed.select("doc_id", "text", "key.t1", "key.t2").mapInArrow(
        _once, "doc_id long, text string, t1 long, t2 long"
    )
    # candidates grow with the documents, so they aren't broadcast even where they are few
    fetched = once.join(candidates.drop("sketch").hint("merge"), key == F.col("wanted"))
    sets = fetched.select("component", "node", "copies", "h1", "h2", "text").mapInArrow(
        _texts(n), "component long, node long, copies long, grams binary"
    )
    # where sets go is known from the candidates, which are smaller than their sets
    places = _places(candidates, block, least, steps)
    placed = sets.join(places, "node").select("*", F.inline("places")).drop("places")
    verified = steps.keep(
        _grouped(placed, ["component", "bi", "bj"], "node").mapInArrow(
            _verified(threshold), "node long, texts long, documents long, to long"
        )
    )
    groups = components(verified.select(F.col("node").alias("a"), F.col("to").alias("b")), steps)
    counted = verified.groupBy("node").agg(
        F.sum("texts").alias("texts"), F.sum("documents").alias("documents")
    )
    members = classes.select("h1", "h2", "node", "doc_id", "least", "copies").join(groups, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node"))
    members = steps.keep(members.join(counted, "node", "left"))
    return sketches, members, steps
