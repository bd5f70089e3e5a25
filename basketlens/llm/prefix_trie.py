"""Prefix trie of conversations, by digests of blocks of turns.

1. A turn is known by two 64-bit marks of role and text; texts are read once and do not move. Marks salted
   with the turn's place are summed by exclusive or along the conversation, so a sum tells the whole path up
   to a turn, and sums of blocks of turns can be made apart from each other, however long a conversation is.
2. Conversations are grouped by the path at the end of each block of ``BLOCK`` turns first. A block whose
   group is as large as the group of the block before it holds no fork: its turns are nodes as they
   are. Only where siblings diverge, paths are told apart turn by turn inside the block, from the groups.
3. A node belongs to its smallest member. What a conversation owns is the lower end of its path, so what lies
   under a node is the rest of its owner's path, and all that is owned by those members that leave the path
   below it. Totals of the first kind run along the path; those of the second kind are sent once to every
   node above, block by block, and added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.runs import running
from basketlens.llm.tables import keep

BLOCK = 4
NODE = ["depth", "x1", "x2"]
#: conv_ids are joined to text by this many bits' worth of them at once.
CHUNK_BITS = 12


def marked_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, m1, m2, size) of every turn: place from 0, marks of role and text, bytes of the text.

    Turns go by ``turn``, null first; turns that tie go by their marks. Null roles and texts are empty.
    Rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    marks = [F.xxhash64(F.lit(n), role, text).alias(f"m{n}") for n in (1, 2)]
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), *marks, F.octet_length(text).cast("bigint").alias("size"),
        F.monotonically_increasing_id().alias("row"), F.lit(1).cast("bigint").alias("one"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("m1"), F.col("m2"), F.col("row")]
    return running(keep(rows), "conv_id", order, ["one"]).select("conv_id", F.col("before_one").alias("pos"), "m1", "m2", "size")


def with_shared_starts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the start of another one, and all their ids.

    Conversation c takes the first h = crc32(c) % 9 turns of conversation c - c % 5 (all if that has fewer)
    and then its own turns after its first h. So a conversation that lends turns gives at most eight of them
    to at most four others.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    lender = F.col("conv_id") - F.col("conv_id") % 5
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    ids = keep(sizes.withColumns({"h": taken, "lender": lender}))
    lent = ids.select("conv_id", "h", "lender").join(sizes.select(F.col("conv_id").alias("lender"), F.col("n").alias("there")), "lender", "left")
    lent = lent.select("conv_id", F.least("h", F.coalesce("there", F.lit(0))).alias("head"))
    own = turns.withColumn("h", taken).where("pos >= h").join(lent, "conv_id")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "m1", "m2", "size")
    starts = turns.where("pos < 8").select(F.col("conv_id").alias("lender"), "pos", "m1", "m2", "size")
    starts = starts.join(ids.select("conv_id", "h", "lender"), "lender").where("pos < h").select("conv_id", "pos", "m1", "m2", "size")
    return own.unionByName(starts), ids.select("conv_id")


def _joined_ids(ends: DataFrame) -> DataFrame:
    """Per node of (NODE, conv_id) the SHA-256 of its conv_ids, in numeric order and joined by commas.

    Ids are joined to pieces of text by ranges of 2^CHUNK_BITS ids first; a node's pieces then pass through its
    digest one after the other, so no node's ids are ever together.
    """
    pieces = ends.groupBy(*NODE, F.shiftright("conv_id", CHUNK_BITS).alias("range")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if own != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "sha"], d, strict=True)) for d in done], schema)
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "sha"], (*node, digest.hexdigest()), strict=True))], schema)

    schema = pa.schema([*[(c, pa.int64()) for c in NODE], ("sha", pa.string())])
    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "range").select(*NODE, "range", "ids")
    return dealt.mapInArrow(run, "depth bigint, x1 bigint, x2 bigint, sha string")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _turns(table: DataFrame, *more: str) -> DataFrame:
    return table.select(F.explode("turns").alias("t"), *more).select("t.*", *more)


def trie(turns: DataFrame, members: DataFrame, block: int = BLOCK) -> DataFrame:
    """The prefix trie of conversations.

    ``turns`` has (conv_id, pos, m1, m2, size) with places from 0 without gaps, ``members`` all conv_ids,
    those without turns too. Returns a row per node, the root included: ``conv_id`` (smallest member) and
    ``depth``, which name the node, ``parent_conv_id`` (the parent is at depth - 1; null at the root),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes under it or itself), ``saved_tokens`` (bytes of
    the turns that need not be stored again in its subtree) and ``ends_sha256`` (digest of the conv_ids that
    end there). No conversations give no nodes.
    """
    salted = turns.withColumns({f"x{n}": F.xxhash64(F.lit(n), "pos", "m1", "m2") for n in (1, 2)}).drop("m1", "m2")
    paths = running(salted, "conv_id", [F.col("pos")], [], ["x1", "x2"])
    turn = F.struct(
        (F.col("pos") + 1).alias("depth"), F.col("x1").bitwiseXOR(F.col("before_x1")).alias("x1"), F.col("x2").bitwiseXOR(F.col("before_x2")).alias("x2"),
        F.col("before_x1").alias("q1"), F.col("before_x2").alias("q2"), "size",
    )
    blocks = paths.groupBy("conv_id", F.floor(F.col("pos") / block).alias("block")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    last, first = F.element_at("turns", -1), F.element_at("turns", 1)
    blocks = keep(blocks.select("conv_id", last["depth"].alias("depth"), last["x1"].alias("x1"), last["x2"].alias("x2"), "turns"), "blocks")

    all_of_them = members.agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).first()
    groups = keep(blocks.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"), F.first("turns").alias("turns")), "groups")
    above = groups.select(F.col("depth").alias("up"), F.col("x1").alias("u1"), F.col("x2").alias("u2"), F.col("n").alias("n_up"))
    begun = groups.withColumns({"up": first["depth"] - 1, "u1": first["q1"], "u2": first["q2"]})
    tops = begun.where("up = 0").withColumn("n_up", F.lit(all_of_them["n"]))
    known = keep(begun.where("up > 0").join(above, ["up", "u1", "u2"]).unionByName(tops).select("n", "n_up", "conv", "turns"), "groups")
    whole = _turns(known.where("n = n_up"), "n", "conv")
    forked = _turns(known.where("n < n_up"), "n", "conv").groupBy(*NODE, "q1", "q2", "size").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"))
    nodes = whole.unionByName(forked).withColumn("n_children", _zero())
    root = members.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv")).where("n > 0")
    root = root.select(*[_zero().alias(c) for c in [*NODE, "q1", "q2", "size"]], "n", "conv", _zero().alias("n_children"))
    nulls = {c: F.lit(None).cast("bigint").alias(c) for c in ["q1", "q2", "size", "n", "conv"]}
    children = nodes.select((F.col("depth") - 1).alias("depth"), F.col("q1").alias("x1"), F.col("q2").alias("x2"), *nulls.values(), F.lit(1).cast("bigint").alias("n_children"))
    nodes = nodes.unionByName(root).unionByName(children).groupBy(*NODE).agg(*[F.max(c).alias(c) for c in nulls], F.sum("n_children").alias("n_children"))
    saved = (F.col("n") - 1) * F.col("size")
    nodes = keep(nodes.withColumns({"saved": saved, "leaves": (F.col("n_children") == 0).cast("bigint")}), "nodes")

    # what a conversation owns from a node on downwards, and in all
    chains = running(nodes.where("depth > 0"), "conv", [F.col("depth").desc()], ["saved", "leaves"])
    owned = keep(nodes.where("depth > 0").groupBy("conv").agg(F.min("depth").alias("top"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")), "owned")
    added = ["saved", "leaves"]
    sent = blocks.join(owned.withColumnRenamed("conv", "conv_id"), "conv_id").where(first["depth"] < F.col("top"))
    to_blocks = sent.where("depth < top").groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in added], F.first("turns").alias("turns"))
    to_turns = _turns(sent.where("depth >= top"), *added, "top").where("depth < top").drop("top")
    to_root = owned.select(*[_zero().alias(c) for c in NODE], *added)
    messages = _turns(to_blocks, *added).unionByName(to_turns).select(*NODE, *added).unionByName(to_root)

    heads = chains.join(owned.select("conv", F.col("top").alias("depth")), ["conv", "depth"]).where("depth > 1")
    heads = heads.select("conv", "depth", (F.col("depth") - 1).alias("up"), F.col("q1").alias("u1"), F.col("q2").alias("u2"))
    parents = nodes.select(F.col("depth").alias("up"), F.col("x1").alias("u1"), F.col("x2").alias("u2"), F.col("conv").alias("parent"))
    heads = heads.join(parents, ["up", "u1", "u2"]).select("conv", "depth", "parent")

    ended = blocks.groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("end")).select("conv_id", "end.*")
    ended = members.join(ended, "conv_id", "left").select("conv_id", *[F.coalesce(c, _zero()).alias(c) for c in NODE])
    ends = _joined_ids(ended)

    own = chains.select(*NODE, "conv", "n", "n_children", *[(F.col(c) + F.col(f"before_{c}")).alias(c) for c in added])
    own = own.unionByName(nodes.where("depth = 0").select(*own.columns))
    facts = own.withColumn("sha", F.lit(None).cast("string"))
    for more in (messages, ends):
        facts = facts.unionByName(more, allowMissingColumns=True)
    found = facts.groupBy(*NODE).agg(*[F.max(c).alias(c) for c in ["conv", "n", "n_children", "sha"]], *[F.sum(c).alias(c) for c in added])
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") == 1, F.lit(all_of_them["least"])).otherwise(F.coalesce("parent", "conv"))
    return found.join(heads, ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"), "depth", parent.cast("bigint").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


#: The same by paths spelled out, for conversations of a moderate length. CRC-32 goes bit by bit over the digits.
SQL = """
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
taken AS (
  SELECT c, c - c % 5 AS lender, xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 9 AS h
  FROM ids),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT taken.c, 0 AS part, i, role, text FROM taken JOIN turns ON turns.c = lender AND i < h
  UNION ALL SELECT taken.c, 1, i, role, text FROM taken JOIN turns ON turns.c = taken.c AND i >= h),
placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d, strlen(text) AS size, strlen(role) || ':' || role || strlen(text) || ':' || text AS own FROM rebuilt),
paths AS (
  SELECT c, d, size, sha256(string_agg(own, '') OVER (PARTITION BY c ORDER BY d)) AS path FROM placed
  UNION ALL SELECT c, 0, 0, '' FROM ids),
nodes AS (SELECT d, path, min(c) AS conv, count(*) AS n, (count(*) - 1) * min(size) AS w FROM paths GROUP BY d, path),
family AS (
  SELECT u.d, u.path, u.conv, u.n, u.w, p.path AS up_path
  FROM nodes u LEFT JOIN paths p ON p.c = u.conv AND p.d = u.d - 1),
children AS (SELECT d - 1 AS d, up_path AS path, count(*) AS n_children FROM family WHERE d > 0 GROUP BY 1, 2),
marked AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM family u LEFT JOIN children k ON k.d = u.d AND k.path = u.path),
under AS (
  SELECT p.d, p.path, sum(w)::BIGINT AS saved, count(*) FILTER (n_children = 0) AS n_leaves
  FROM marked u JOIN paths p ON p.c = u.conv AND p.d <= u.d GROUP BY p.d, p.path),
ends AS (
  SELECT d, path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT c, d, path, row_number() OVER (PARTITION BY c ORDER BY d DESC) AS back FROM paths) WHERE back = 1 GROUP BY d, path)
SELECT u.conv AS conv_id, u.d AS depth, v.conv AS parent_conv_id, u.n AS n_convs, u.n_children, under.n_leaves, under.saved AS saved_tokens,
  sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM marked u JOIN under ON under.d = u.d AND under.path = u.path
LEFT JOIN nodes v ON v.d = u.d - 1 AND v.path = u.up_path
LEFT JOIN ends ON ends.d = u.d AND ends.path = u.path
"""
