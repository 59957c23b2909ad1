"""Operator 11: the trie of all conversations' prefixes.

A conversation c is rebuilt: the first h turns of conversation c - c % 100,
then its own turns after its first h, h = crc32(c in decimal) % 6. Every
distinct sequence of a rebuilt conversation's first turns (role, text) is a
node; the root is the empty one.

1. Each turn becomes a SHA-256 digest (128 bits of it) and a length, in the
   one pass that reads texts. Turns are put in order, numbered, rebuilt and
   numbered again by range partitions and carried sums (``running``), so one
   conversation may lie in many tasks.
2. A prefix's digest is the sum of hashes of (depth, turn), modulo 2**64 and
   twice. A count-min sketch of all prefix digests is merged over tasks, its
   width following the number of turns. An estimate of one proves that a
   prefix belongs to one conversation alone, as do then all that follow it:
   these tails are emitted where they are.
3. Only possibly shared prefixes are shuffled and grouped by digest. A group
   whose rows don't agree in their last turn and their parent's digest would
   be two prefixes that collide; then everything is hashed anew with another
   seed, so equal digests are equal sequences, by induction over depth.
4. Sums over subtrees are sums over members: of each member's later turns in
   which it isn't the node's smallest member (saved), and of members that are
   the smallest of a leaf. They are carried from the end of each conversation
   and summed by node, so depth costs no rounds.
5. Nodes at which several conversations end get their SHA-256 from blocks of
   sorted ids, made by range partitions and streamed through it in order.

Nodes that hold more than a thousandth of the rows joined are broadcast, of
which there are fewer than a thousand.

Defined results: null role or text is empty; a null turn comes first; turns
with one number are ordered by the SHA-256 of their content; rows without
conv_id take no part; repeated rows are turns of their own; a conversation
without turns after rebuilding ends at the root; an empty table gives no rows.
Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sketch
from .jaccard import written
from .joins import join_heavy
from .running import PART, ordered, running

#: Most turns that come from another conversation.
MOST_HEAD = 5
#: Conversations to which one lends its head.
SPAN = 100
#: Cells of the sketch for each prefix, and bounds of its width in bits.
CELLS_EACH, LEAST_BITS, MOST_BITS = 8, 16, 29
#: Ids in a block.
BLOCK = 1 << 13

KEY = ["d", "a", "b"]


def head_length(conv: Column) -> Column:
    return (F.crc32(conv.cast("string")) % (MOST_HEAD + 1)).cast("int")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, hi, lo, chars): digests order as the hexadecimal SHA-256 does."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)

    def half(at: int) -> Column:
        return F.conv(F.substring("digest", at, 16), 16, -10).cast("bigint").bitwiseXOR(F.lit(-2 ** 63))

    return (conversations.where(conversations["conv_id"].isNotNull())
            .select(conversations["conv_id"].cast("bigint").alias("conv"), conversations["turn"].alias("turn"),
                    digest.alias("digest"), F.length(text).cast("bigint").alias("chars"))
            .select("conv", "turn", half(1).alias("hi"), half(17).alias("lo"), "chars"))


def rebuilt(numbered: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, d, hi, lo, chars, is_end), ordered, of ``numbered`` turns (conv, p, ...)."""
    turn = ["hi", "lo", "chars"]
    lent = numbered.where(F.col("p") <= MOST_HEAD).select(F.col("conv").alias("base"), "p", *turn)
    heads = convs.where("h > 0").join(lent, "base").where("p <= h").select("conv", F.lit(0).alias("side"), "p", *turn)
    own = numbered.where(F.col("p") > head_length(F.col("conv"))).select("conv", F.lit(1).alias("side"), "p", *turn)
    rows = ordered(heads.unionByName(own).withColumn("one", F.lit(1)), "conv", ["side", "p"])
    return running(rows, "conv", {"one": ("d", "_")}, last="is_end").select("conv", "d", *turn, "is_end", PART)


def digested(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with the digests of their prefix (a, b) and its parent (pa, pb), checkpointed."""
    for k, name in enumerate(("e", "f")):
        rows = rows.withColumn(name, F.xxhash64(F.lit(2 * seed + k), "d", "hi", "lo"))
    return (running(rows, "conv", {"e": ("a", "pa"), "f": ("b", "pb")}).drop("e", "f")
            .withColumn("z", F.xxhash64(*KEY)).checkpoint())


def screened(rows: DataFrame) -> DataFrame:
    """``rows`` with gone (over 0: proven to be in one conversation) and gone_before (the row above)."""
    n = rows.count()
    bits = min(max(int(CELLS_EACH * max(n, 1)).bit_length(), LEAST_BITS), MOST_BITS)

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield np.asarray(batch.column(0)).view(np.uint64)

    met = sketch.shared(rows, sketch.over(sketch.partition_sketches(rows.select("z"), hashes, bits), [2], bits)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            single = ~met.value.holds(np.asarray(batch.column("z")).view(np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(single.astype(np.int32))], schema.names)

    schema = T.StructType([*rows.schema.fields, T.StructField("single", T.IntegerType())])
    return running(rows.mapInArrow(run, schema), "conv", {"single": ("gone", "gone_before")})


def grouped(shared: DataFrame) -> DataFrame:
    """One row for each possibly shared prefix."""
    same = ("hi", "lo", "pa", "pb")
    return shared.groupBy(*KEY).agg(
        F.min("conv").alias("rep"), F.count("*").alias("n"), F.sum("is_end").alias("n_ends"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in same for f in (F.min, F.max)])


def collide(groups: DataFrame) -> bool:
    differ = F.lit(False)
    for c in ("hi", "lo", "pa", "pb"):
        differ = differ | (F.col(f"min_{c}") != F.col(f"max_{c}"))
    return not groups.where(differ).isEmpty()


def ends_digest(ends: DataFrame) -> DataFrame:
    """(d, a, b, ends_sha256) of the conversations ``ends`` (d, a, b, conv): ids in order, joined by commas."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.stack([np.asarray(batch.column(c)) for c in KEY])
            cuts = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0)))) if batch.num_rows else []
            at = sorted({*cuts, *range(0, batch.num_rows, BLOCK), batch.num_rows})
            ids = np.asarray(batch.column("conv"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[j, at[:-1]]) for j in range(3)] + [pa.array(ids[at[:-1]])]
                + [pa.array([",".join(map(str, ids[x:y].tolist())) for x, y in zip(at, at[1:])], pa.string())],
                names=[*KEY, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, state = None, None

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([x]) for x in have), pa.array([state.hexdigest()])],
                                              names=[*KEY, "ends_sha256"])

        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if key != have:
                    if have is not None:
                        yield made()
                    have, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if have is not None:
            yield made()

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = (ends.repartitionByRange(n, *KEY, "conv").sortWithinPartitions(*KEY, "conv")
              .mapInArrow(blocks, "d bigint, a bigint, b bigint, first bigint, ids string"))
    return (packed.repartition(*KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(digest, "d bigint, a bigint, b bigint, ends_sha256 string"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (code points) and ends_sha256."""
    spark = conversations.sparkSession
    t = ordered(turns(conversations).withColumn("one", F.lit(1)), "conv", ["turn", "hi", "lo"])
    numbered = written(running(t, "conv", {"one": ("p", "_")}).select("conv", "p", "hi", "lo", "chars"), "trie-turns")
    conv = F.col("conv")
    convs = written(numbered.groupBy("conv").agg(F.max("p").alias("n")).select(
        "conv", "n", head_length(conv).alias("h"), (conv - conv % SPAN).alias("base")), "trie-convs")
    turnless = convs.where("n <= h").join(convs.select(F.col("conv").alias("base")), "base", "left_anti").select("conv")

    again = rebuilt(numbered, convs)
    for seed in range(8):
        rows = screened(digested(again, seed))
        shared = written(rows.where("gone = 0").drop("z", PART, "single", "gone", "gone_before"), "trie-shared")
        groups = written(grouped(shared), "trie-groups")
        if not collide(groups):
            break
    else:
        raise RuntimeError("prefix digests collide under every seed")

    tails = rows.where("gone > 0")
    first = written(tails.where("gone_before = 0").select("conv", *KEY, "pa", "pb", "is_end"), "trie-tails")
    none = F.sha2(F.lit(""), 256)

    def own_end(is_end: Column, name: str) -> Column:
        return F.when(is_end, F.sha2(F.col(name).cast("string"), 256)).otherwise(none)

    # sums over subtrees, from the end of each conversation
    flagged = written(join_heavy(shared.select("conv", *KEY, "chars", "is_end"), groups.select(*KEY, "rep", "n", "n_ends"),
                                 KEY, "n").select(
        "conv", *KEY, "is_end", "n_ends", F.when(F.col("rep") != conv, F.col("chars")).otherwise(0).alias("saved"),
        ((F.col("is_end") == 1) & (F.col("n_ends") == F.col("n")) & (F.col("rep") == conv)).cast("int").alias("leaf")), "trie-flagged")
    both = flagged.select("conv", *KEY, "saved", "leaf", F.lit(1).alias("keep")).unionByName(
        first.select("conv", *KEY, F.lit(0).cast("bigint").alias("saved"), F.lit(1).alias("leaf"), F.lit(0).alias("keep")))
    upward = running(ordered(both.withColumn("up", -F.col("d")), "conv", ["up"]), "conv",
                     {"saved": ("saved_from", "_s"), "leaf": ("leaf_from", "_l")})
    sums = upward.where("keep = 1").groupBy(*KEY).agg(F.sum("saved_from").alias("saved_tokens"),
                                                     F.sum("leaf_from").alias("n_leaves"))
    ends = ends_digest(flagged.where("is_end = 1 and n_ends > 1").select(*KEY, "conv"))
    only = flagged.where("is_end = 1 and n_ends = 1").select(*KEY, F.sha2(conv.cast("string"), 256).alias("ends_sha256"))

    # children and parents
    top = {c: F.lit(0).cast("bigint") for c in KEY}
    root = convs.agg(F.min("conv").alias("rep"), F.count("*").alias("n")).where("n > 0")
    kids = (groups.select("rep", *KEY, F.col("min_pa").alias("pa"), F.col("min_pb").alias("pb"), F.lit(0).alias("tail"),
                          F.lit(0).alias("is_end"))
            .unionByName(first.withColumnRenamed("conv", "rep").withColumn("tail", F.lit(1)))
            .withColumn("pd", F.col("d") - 1))
    born = written(kids.groupBy(F.col("pd").alias("d"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count("*").alias("n_children")), "trie-children")
    above = written(groups.select(*KEY, "rep").unionByName(root.select("rep").withColumns(top)).join(born, KEY).select(
        F.col("d").alias("pd"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("rep").alias("parent_conv_id"),
        "n_children"), "trie-parents")
    named = join_heavy(kids, above, ["pd", "pa", "pb"], "n_children").drop("n_children")

    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    def tail(df: DataFrame, name: str) -> DataFrame:
        is_end = F.col("is_end") == 1
        return df.select(F.col(name).alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", one.alias("n_convs"),
                         F.when(is_end, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"),
                         zero.alias("saved_tokens"), own_end(is_end, name).alias("ends_sha256"))

    nodes = (groups.select(*KEY, "rep", F.col("n").alias("n_convs"))
             .join(sums, KEY).join(named.where("tail = 0").select(*KEY, "parent_conv_id"), KEY)
             .join(born, KEY, "left").join(only.unionByName(ends), KEY, "left")
             .select(F.col("rep").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs",
                     F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
                     F.coalesce("ends_sha256", none).alias("ends_sha256")))
    leaves = both.agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")).withColumns(top)
    crown = (root.withColumns(top).join(born, KEY, "left")
             .join(ends_digest(turnless.withColumns(top)), KEY, "left").join(leaves, KEY)
             .select(F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"),
                     F.col("n").alias("n_convs"), F.coalesce("n_children", zero).alias("n_children"),
                     F.coalesce("n_leaves", one).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"),
                     F.coalesce("ends_sha256", none).alias("ends_sha256")))
    return (tail(named.where("tail = 1"), "rep")
            .unionByName(tail(tails.where("gone_before > 0").withColumn("parent_conv_id", conv), "conv"))
            .unionByName(nodes).unionByName(crown).select(*out))
