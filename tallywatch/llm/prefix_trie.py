"""A trie of conversation prefixes with count-min screening.

A conversation is a sequence of turns (role, text); its prefixes are the nodes
of a trie. Each prefix has a 128-bit digest that is the exclusive or of one
digest per turn and depth, so blocks of a very long conversation are digested
apart and put together by running totals.

Each task counts the digests of its prefixes in a count-min sketch whose cells
stop at two; sketches are merged in levels and broadcast (``CELLS_MOST`` bounds
the size). A sketch never counts too low, so an estimate of one proves that no
other conversation has the prefix: such tails are finished where they are.
Only prefixes that may be shared are shuffled and grouped by the whole digest.
On tables that fill the largest sketch fewer tails are proven; the result does
not change.

Conversations with the same prefix are its members, and the smallest member
names the node. On the path of one conversation the smallest member never
falls, and once it is the conversation itself it stays so: every conversation
owns a chain that hangs from another one's node and runs down to its own end.
That turns sums over subtrees into sums over members, without a pass by level.

Defined results: turns are ordered by ``turn`` (null first), ties by a digest
of role and text; null role or text counts as empty; repeated rows are turns of
their own; rows without ``conv_id`` take no part; an empty table has no nodes.
Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.common import save_and_reload

BLOCK = 512
SHARE = 100
HEADS = 6
SKETCH_ROWS = 3
CELLS_LEAST, CELLS_MOST = 1 << 12, 1 << 23
PIECES = 16
FAN_IN = 64
IDS_A_CHUNK = 4096
DIGEST = ["k1", "k2"]


def _earlier(per_block: DataFrame, key: str, block: str, totals: dict[str, Column]) -> DataFrame:
    """Totals of all earlier blocks of the same key, one row a block."""
    before = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select(key, block, *[total.over(before).alias(name) for name, total in totals.items()])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``t1``, ``t2`` (digest of role and text) and ``chars``.

    Rows that repeat are combined first and counted. Turns are then sorted into
    ranges, which cut a very long conversation, and numbered within a range
    after the turns of the same conversation in earlier ranges.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars")
    )
    combined = turns.groupBy("conv_id", "turn", "digest", "chars").agg(F.count(F.lit(1)).alias("times"))
    ranged = combined.repartitionByRange("conv_id", "turn", "digest").withColumn("part", F.spark_partition_id())
    ranged = save_and_reload(ranged, "turn-ranges")
    inside = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "digest")
    parts = ranged.groupBy("conv_id", "part").agg(F.sum("times").alias("held"))
    earlier = _earlier(parts, "conv_id", "part", {"earlier": F.sum("held")})
    first = (F.coalesce("earlier", F.lit(0)) + F.col("upto") - F.col("times") + 1).alias("first")
    placed = ranged.withColumn("upto", F.sum("times").over(inside)).join(earlier, ["conv_id", "part"])
    return placed.select("conv_id", "digest", "chars", "times", first).select(
        "conv_id",
        F.explode(F.sequence("first", F.col("first") + F.col("times") - 1)).alias("place"),
        *[F.conv(F.substring("digest", at, 15), 16, 10).cast("long").alias(name) for name, at in (("t1", 1), ("t2", 16))],
        "chars",
    )


def rebuilt_turns(turns: DataFrame, share: int = SHARE, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations that begin like the first of their hundred.

    Conversation c takes the first h turns of conversation ``c - c % share``,
    h being the hash of its id modulo ``heads``, then its own turns after its
    first h. Returns ``conv_id``, ``depth`` (from 1), ``t1``, ``t2``, ``chars``
    per turn, and ``conv_id``, ``last`` (its number of turns) per conversation.
    A head is copied to ``share`` conversations at most.
    """
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    plans = sizes.select("conv_id", "size", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % share).alias("base"))
    base_sizes = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    plans = plans.join(base_sizes, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_size", F.lit(0))).alias("head"), "size"
    )
    plans = save_and_reload(plans, "conversations")
    tails = turns.join(plans.select("conv_id", "h", "head"), "conv_id").where("place > h").select(
        "conv_id", (F.col("head") + F.col("place") - F.col("h")).alias("depth"), "t1", "t2", "chars"
    )
    openings = turns.where(F.col("place") < heads).withColumnRenamed("conv_id", "base")
    copied = plans.select("conv_id", "base", "h").join(openings, "base").where("place <= h").select(
        "conv_id", F.col("place").alias("depth"), "t1", "t2", "chars"
    )
    last = F.col("head") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    return tails.unionByName(copied), plans.select("conv_id", last.alias("last"))


def prefix_digests(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, ``k1``, ``k2`` (digest of the first ``depth`` turns) and the turn's ``chars``."""
    term = {"k1": F.xxhash64("depth", "t1", "t2"), "k2": F.xxhash64("t2", F.lit("second"), "depth", "t1")}
    marked = turns.select("conv_id", "depth", F.floor(F.col("depth") / BLOCK).alias("block"), *[c.alias(n) for n, c in term.items()], "chars")
    marked = save_and_reload(marked, "turn-digests")
    totals = marked.groupBy("conv_id", "block").agg(*[F.bit_xor(k).alias(k) for k in DIGEST])
    earlier = _earlier(totals, "conv_id", "block", {f"before_{k}": F.bit_xor(F.col(k)) for k in DIGEST})
    run = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    upto = marked.select("conv_id", "block", "depth", "chars", *[F.bit_xor(F.col(k)).over(run).alias(k) for k in DIGEST])
    # only conversations of several blocks have anything before a block
    earlier = earlier.where("before_k1 IS NOT NULL")
    whole = [F.col(k).bitwiseXOR(F.coalesce(f"before_{k}", F.lit(0))).alias(k) for k in DIGEST]
    return upto.join(earlier, ["conv_id", "block"], "left").select("conv_id", "depth", *whole, "chars")


def _cells(k1: np.ndarray, k2: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each digest in every row of a sketch; ``width`` is a power of two."""
    first, second = k1.view(np.uint64), k2.view(np.uint64) | np.uint64(1)
    return [((first + np.uint64(i) * second) & np.uint64(width - 1)).astype(np.int64) + i * width for i in range(SKETCH_ROWS)]


def _digests(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in DIGEST)


def _pack(cells: np.ndarray, pieces, salt: int) -> pa.RecordBatch:
    packed = [zlib.compress(piece.tobytes(), 1) for piece in cells]
    columns = [pa.array(list(pieces), pa.int32()), pa.array([salt] * len(packed), pa.int64()), pa.array(packed, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["piece", "salt", "packed"])


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def count_min_sketch(prefixes: DataFrame, width: int) -> np.ndarray:
    """Cells (0, 1, or 2 for more) of a sketch over the digests of ``prefixes``.

    Every task sends one sketch in ``PIECES`` pieces; equal pieces are merged in
    levels of ``FAN_IN``, so the driver reads one sketch of bounded size.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, salt = np.zeros(SKETCH_ROWS * width, np.uint8), None
        for batch in batches:
            if batch.num_rows:
                k1, k2 = _digests(batch)
                salt = int(k1[0]) if salt is None else salt
                for spots in _cells(k1, k2, width):
                    hit, times = np.unique(spots, return_counts=True)
                    cells[hit] = np.minimum(cells[hit] + np.minimum(times, 2), 2)
        if salt is not None:
            yield _pack(cells.reshape(PIECES, -1), range(PIECES), salt)

    def merge(found: pa.Table) -> pa.Table:
        total = 0
        for packed in found.column("packed"):
            total = np.minimum(total + _unpack(packed.as_py()), 2).astype(np.uint8)
        return pa.Table.from_batches([_pack(total[None, :], [found.column("piece")[0].as_py()], found.column("salt")[0].as_py())])

    schema = "piece int, salt long, packed binary"
    sketches = save_and_reload(prefixes.select(*DIGEST).mapInArrow(tally, schema), "prefix-sketches")
    groups = -(-sketches.count() // PIECES)
    while groups > 1:
        groups = -(-groups // FAN_IN)
        place = F.pmod(F.xxhash64("salt", F.lit(groups)), F.lit(groups)).alias("salt")
        sketches = sketches.select("piece", place, "packed").groupBy("piece", "salt").applyInArrow(merge, schema)
    cells = np.zeros((PIECES, SKETCH_ROWS * width // PIECES), np.uint8)
    for row in sketches.select("piece", "packed").toLocalIterator():
        cells[row.piece] = np.minimum(cells[row.piece] + _unpack(row.packed), 2)
    return cells.ravel()


def screened(prefixes: DataFrame, least: int = CELLS_LEAST, most: int = CELLS_MOST) -> DataFrame:
    """``prefixes`` with ``alone``: proven to belong to one conversation only."""
    rows = prefixes.count()
    width = least
    while width < min(4 * rows, most):
        width *= 2
    shared = prefixes.sparkSession.sparkContext.broadcast(count_min_sketch(prefixes, width))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = _cells(*_digests(batch), width)
            estimate = np.minimum.reduce([shared.value[spot] for spot in spots])
            yield batch.append_column("alone", pa.array(estimate == 1))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema)
    return prefixes.mapInArrow(screen, f"{fields}, alone boolean")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def joined_digests(ends: DataFrame) -> DataFrame:
    """Per node (``conv_id``, ``depth``) the hash of its ascending ids ``member``, comma-joined.

    Ids of a range become one text each, at most ``IDS_A_CHUNK`` long as ids
    are distinct; the texts of a node are hashed in order as they stream by, so
    no task holds a node's ids.
    """
    reach = F.floor(F.col("member") / IDS_A_CHUNK).alias("reach")
    chunks = ends.groupBy("conv_id", "depth", reach).agg(F.array_sort(F.collect_list("member")).alias("ids"))
    chunks = chunks.select("conv_id", "depth", "reach", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        names = ["conv_id", "depth", "ends_sha256"]
        for batch in batches:
            done = []
            for conv_id, depth, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 3)]):
                if (conv_id, depth) == node:
                    state.update(b"," + ids.encode())
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (conv_id, depth), hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*done)], names=names)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([value]) for value in (*node, state.hexdigest())], names=names)

    ordered = chunks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "reach")
    return ordered.mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


def trie_nodes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """All nodes of the prefixes of ``turns``; ``conversations`` has ``conv_id`` and ``last``.

    Returns ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256`` per node.
    """
    prefixes = save_and_reload(prefix_digests(turns), "prefixes")
    marked = save_and_reload(screened(prefixes).join(conversations, "conv_id"), "screened")
    proven = marked.where("alone").select("conv_id", "depth", "last")
    maybe = marked.where("NOT alone").select("conv_id", "depth", *DIGEST, "chars", "last")
    groups = maybe.groupBy(*DIGEST, "depth").agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"))
    members = maybe.join(groups, [*DIGEST, "depth"]).select("conv_id", "depth", "node", "n_convs", "chars", "last")
    members = save_and_reload(members, "members")
    named = members.select("conv_id", "depth", "node").unionByName(proven.select("conv_id", "depth", F.col("conv_id").alias("node")))

    # the chain each conversation owns: from where, and whose node it hangs from
    first = conversations.agg(F.min("conv_id")).first()[0]
    own, other = F.col("node") == F.col("conv_id"), F.col("node") < F.col("conv_id")
    chains = named.groupBy("conv_id").agg(F.min(F.when(own, F.col("depth"))).alias("from"), F.max(F.when(other, F.col("node"))).alias("hangs"))
    chains = chains.where(F.col("from").isNotNull())
    chains = chains.select("conv_id", "from", F.coalesce("hangs", F.lit(first).cast("long")).alias("hangs"))
    chains = save_and_reload(chains.join(conversations, "conv_id"), "chains")
    # other chains that begin right below a node; those at depth 1 hang from the root
    hung = chains.where(F.col("from") > 1).groupBy(F.col("hangs").alias("conv_id"), (F.col("from") - 1).alias("depth"))
    hung = hung.agg(F.count(F.lit(1)).alias("hung"))
    below = chains.join(hung.withColumnRenamed("depth", "last"), ["conv_id", "last"], "left")
    leaves = save_and_reload(below.select("conv_id", F.col("hung").isNull().cast("long").alias("leaf")), "chain-ends")

    # what a conversation's own chain saves from a depth on, summed over members
    value = F.when(F.col("node") == F.col("conv_id"), (F.col("n_convs") - 1) * F.col("chars")).otherwise(F.lit(0))
    valued = members.select("conv_id", "depth", "node", value.alias("value"), F.floor(F.col("depth") / BLOCK).alias("block"))
    per_block = valued.groupBy("conv_id", "block").agg(F.sum("value").alias("held"))
    later = Window.partitionBy("conv_id").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    later_blocks = per_block.select("conv_id", "block", F.sum("held").over(later).alias("later")).where("later IS NOT NULL")
    onward = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(0, Window.unboundedFollowing)
    saving = valued.withColumn("onward", F.sum("value").over(onward)).join(later_blocks, ["conv_id", "block"], "left")
    saving = saving.join(leaves, "conv_id", "left").groupBy(F.col("node").alias("conv_id"), "depth").agg(
        F.sum(F.col("onward") + F.coalesce("later", F.lit(0))).alias("saved_tokens"),
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
    )

    # conversations that end at a node
    ending = members.where("depth = last").select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    ended = ending.groupBy("conv_id", "depth").agg(F.count(F.lit(1)).alias("n_ends"), F.min("member").alias("end"))
    ended = save_and_reload(ended, "ends")
    several = joined_digests(ending.join(ended.where("n_ends > 1").select("conv_id", "depth"), ["conv_id", "depth"]))
    one = ended.where("n_ends = 1").select("conv_id", "depth", _sha256(F.col("end").cast("string")).alias("ends_sha256"))

    nodes = members.where("node = conv_id").select("conv_id", "depth", "n_convs")
    shared = (
        nodes.join(saving, ["conv_id", "depth"])
        .join(one.unionByName(several), ["conv_id", "depth"], "left")
        .join(hung, ["conv_id", "depth"], "left")
        .join(chains.select("conv_id", "from", "hangs", "last"), "conv_id")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > F.col("from"), F.col("conv_id")).otherwise(F.col("hangs")).alias("parent_conv_id"),
            "n_convs",
            ((F.col("depth") < F.col("last")).cast("long") + F.coalesce("hung", F.lit(0))).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", _sha256(F.lit(""))).alias("ends_sha256"),
        )
    )
    ends_here = F.col("depth") == F.col("last")
    tails = proven.join(chains.select("conv_id", "from", "hangs"), "conv_id").select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > F.col("from"), F.col("conv_id")).otherwise(F.col("hangs")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        (~ends_here).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        _sha256(F.when(ends_here, F.col("conv_id").cast("string")).otherwise(F.lit(""))).alias("ends_sha256"),
    )
    return shared.unionByName(tails).unionByName(_root(members, conversations, chains, leaves))


def _root(members: DataFrame, conversations: DataFrame, chains: DataFrame, leaves: DataFrame) -> DataFrame:
    """The node without turns, from totals of the tables that describe the others."""
    total = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    children = chains.agg(F.count_if(F.col("from") == 1).alias("n_children"))
    below = leaves.agg(F.coalesce(F.sum("leaf"), F.lit(0)).alias("below"))
    own = F.col("node") == F.col("conv_id")
    saved = members.agg(F.coalesce(F.sum(F.when(own, (F.col("n_convs") - 1) * F.col("chars"))), F.lit(0)).alias("saved_tokens"))
    turnless = conversations.where("last = 0").select(F.lit(0).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member"))
    ends = joined_digests(turnless).agg(F.max("ends_sha256").alias("ends_sha256"))
    # one row of totals each, put together by the maximum of every column
    parts = [total, children, below, saved, ends]
    names = [name for part in parts for name in part.columns]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = rows.agg(*[F.max(name).alias(name) for name in names])
    return row.where("conv_id IS NOT NULL").select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.greatest(F.col("below"), F.lit(1)).alias("n_leaves"),
        "saved_tokens",
        F.coalesce("ends_sha256", _sha256(F.lit(""))).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations of a table of ``conv_id``, ``turn``, ``role`` and ``text``."""
    turns = save_and_reload(numbered_turns(conversations), "turns")
    rebuilt, plans = rebuilt_turns(turns)
    return trie_nodes(rebuilt, plans)
