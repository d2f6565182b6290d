"""Prefix trie of conversations by truncation peeling.

Conversations are sorted by their turns' digests, so that every trie node is one run of consecutive rows.  Blocks of
consecutive rows are peeled each on its own: from the greatest depth down, conversations that end there merge with the
nodes that survive from the depth below, each node's last turn is stripped, and what agrees is grouped again; nodes are
found and summed up in the same pass.  A node that holds neither the first nor the last row of its block lies wholly in
it and is finished.  The others, the two spines of a block, go on as paths with what they have gathered so far, and are
sorted and peeled again until one block is left.  No prefix, however common, gathers its conversations in one task.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from portflow.llm.common import crc32_sql, written

#: bounds of a block: rows, and turns of its rows (one row always fits)
BLOCK_ROWS, BLOCK_TURNS = 4096, 100_000
#: paths up to which the last block is peeled whole
LAST_ROWS = 2000
ROWS_PER_TASK = 1000
#: a conversation takes up to three turns of the first of its twenty
FAMILY, HEADS = 20, 4
IDS_PER_CHUNK = 20_000

WORDS = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()

_LONGS = T.ArrayType(T.LongType())


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


#: a path: turn digests, words of each turn, and what each node on it has gathered so far (index 0: the root)
PATHS = _fields(path=T.ArrayType(T.StringType()), words=_LONGS, members=_LONGS, least=_LONGS, kids=_LONGS, leaves=_LONGS, saved=_LONGS)
NODES = _fields(block=T.StringType(), node=T.StringType(), depth=T.LongType(), conv_id=T.LongType(), parent=T.StringType(), parent_conv_id=T.LongType(), n_convs=T.LongType(),
                n_children=T.LongType(), n_leaves=T.LongType(), saved_tokens=T.LongType())
PEELED = T.StructType([*NODES.fields, T.StructField("spine", PATHS), T.StructField("keys", T.ArrayType(T.StringType()))])


def node_keys(path: list[str]) -> list[str]:
    """The names of a path's nodes, from the root: digests of the turns' digests up to each."""
    sha, out = hashlib.sha256(), []
    for turn in ["", *path]:
        sha.update(turn.encode())
        out.append(sha.hexdigest())
    return out


class _Node:
    """What is known of one node while its block is peeled."""

    __slots__ = ("kids", "leaves", "least", "members", "open", "rows", "saved", "words")

    def __init__(self, words: int, is_open: bool):
        self.members = self.kids = self.leaves = self.saved = 0
        self.words, self.open, self.least, self.rows = words, is_open, None, []

    def take(self, members: int, least: int | None, kids: int, leaves: int, saved: int) -> None:
        self.members, self.kids, self.leaves, self.saved = self.members + members, self.kids + kids, self.leaves + leaves, self.saved + saved
        if least is not None and (self.least is None or least < self.least):
            self.least = least


def peel(block: str, rows: list[dict], last: bool) -> list[dict]:
    """Finished nodes of consecutive rows (PATHS), and their spines unless this is the last block."""
    keys = []
    for k, r in enumerate(rows):  # equal prefixes of neighbours share their keys
        same = k and r["path"] == rows[k - 1]["path"]
        keys.append(keys[-1] if same else node_keys(r["path"]))
    ends = (keys[0], keys[-1])
    spines = set() if last else {x for own in ends for x in own}
    holding = defaultdict(list)  # by depth: rows that have gathered something there
    for k, r in enumerate(rows):
        for depth, members in enumerate(r["members"]):
            if members or r["kids"][depth]:
                holding[depth].append(k)
    deepest = max(len(r["path"]) for r in rows)
    reaching = defaultdict(list)  # by depth: rows whose path ends there
    for k, r in enumerate(rows):
        reaching[len(r["path"])].append(k)
    out, gathered = [], {}
    alive: dict[str, int] = {}  # key of a node of this depth -> a row that passes through it
    state: dict[str, _Node] = {}
    for depth in range(deepest, -1, -1):
        for k in reaching[depth]:
            alive.setdefault(keys[k][depth], k)
        for key, k in alive.items():
            if key not in state:
                state[key] = _Node(rows[k]["words"][depth - 1] if depth else 0, key in spines)
        for k in holding[depth]:
            r = rows[k]
            state[keys[k][depth]].take(r["members"][depth], r["least"][depth], r["kids"][depth], r["leaves"][depth], r["saved"][depth])
        above: dict[str, int] = {}
        parents: dict[str, _Node] = {}
        for key, k in alive.items():
            node = state[key]
            if depth:  # strip the last turn and group again
                up = keys[k][depth - 1]
                if up not in parents:
                    above[up], parents[up] = k, _Node(rows[k]["words"][depth - 2] if depth > 1 else 0, up in spines)
            if node.open:
                gathered[key] = node
            else:
                leaves = node.leaves if node.kids else 1
                saved = node.saved + (node.members - 1) * node.words
                row = {"block": block, "node": key, "depth": depth, "conv_id": node.least, "parent": up if depth else None, "parent_conv_id": None, "n_convs": node.members,
                       "n_children": node.kids, "n_leaves": leaves, "saved_tokens": saved, "spine": None, "keys": None}
                out.append(row)
                for child in node.rows:
                    child["parent_conv_id"] = node.least
                if depth:
                    parents[up].take(node.members, node.least, 1, leaves, saved)
                    if not parents[up].open:
                        parents[up].rows.append(row)
        alive, state = above, parents
    if not last:
        told: set[str] = set()
        for k in dict.fromkeys((0, len(rows) - 1)):
            if k and keys[k] == keys[0]:
                continue
            own = [gathered[x] if x not in told else _Node(0, True) for x in keys[k]]
            told.update(keys[k])
            spine = {"path": rows[k]["path"], "words": rows[k]["words"]} | {name: [getattr(x, name) for x in own] for name in ("members", "least", "kids", "leaves", "saved")}
            out.append(dict.fromkeys(NODES.fieldNames()) | {"block": block, "spine": spine, "keys": keys[k]})
    return out


# on Spark --------------------------------------------------------------------------------------------------------------

def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, path (digests of role and text), words: the conversations in the order of their turns, written once.

    Only digests of turns travel.  Turns of one number are ordered by digest; rows without conv_id belong to none.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words")).alias("turn"))
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return written(lists.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.words").alias("words")), "turns")


def rebuilt(lists: DataFrame) -> DataFrame:
    """conv_id, path, words with the first turns taken from the first conversation of each twenty."""
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    own = lists.select("conv_id", "path", "words", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), heads.alias("heads"))
    base = lists.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), *(F.slice(c, 1, HEADS - 1).alias(f"base_{c}") for c in ("path", "words")))

    def joined(c: str) -> Column:
        none = F.array().cast(lists.schema[c].dataType)
        return F.concat(F.coalesce(F.slice(f"base_{c}", F.lit(1), F.col("heads")), none), F.slice(c, F.col("heads") + 1, F.size(c))).alias(c)

    return written(own.join(base, "base", "left").select("conv_id", joined("path"), joined("words")), "rebuilt")


def _peeled(paths: DataFrame, last: bool, rows: int, turns: int, turn_round: int, left: int) -> DataFrame:
    """One round of peeling over sorted paths; equal paths are split by the order they are read in."""
    dealt = (-(-left // ROWS_PER_TASK),) if turn_round else ()  # later rounds: so few tasks that paths get fewer
    spread = paths.withColumn("_tie", F.monotonically_increasing_id())
    if last:
        ordered = spread.repartition(1).sortWithinPartitions("path", "_tie").drop("_tie")
    else:
        ordered = spread.repartitionByRange(*dealt, "path", "_tie").sortWithinPartitions("path", "_tie").drop("_tie")
    paths.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    arrow = to_arrow_schema(PEELED)

    def run(batches):
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if not last and held and (len(held) >= rows or size + len(r["path"]) > turns and len(held) >= 8):
                    yield pa.RecordBatch.from_pylist(peel(f"{turn_round}/{part}/{n}", held, False), schema=arrow)
                    n, held, size = n + 1, [], 0
                held.append(r)
                size += len(r["path"])
        if held:
            yield pa.RecordBatch.from_pylist(peel(f"{turn_round}/{part}/{n}", held, last), schema=arrow)

    return written(ordered.mapInArrow(run, PEELED), "peeled")


def trie_nodes(conversations: DataFrame, rows: int = BLOCK_ROWS, turns: int = BLOCK_TURNS, last_rows: int = LAST_ROWS) -> DataFrame:
    """node, depth, conv_id, parent, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens of ``conversations`` (conv_id, path, words)."""
    zeros = F.array_repeat(F.lit(0).cast("long"), F.size("path") + 1)
    one = F.concat(F.array_repeat(F.lit(0).cast("long"), F.size("path")), F.array(F.lit(1).cast("long")))
    least = F.concat(F.array_repeat(F.lit(None).cast("long"), F.size("path")), F.array("conv_id"))
    paths = conversations.select("path", "words", one.alias("members"), least.alias("least"), zeros.alias("kids"), zeros.alias("leaves"), zeros.alias("saved"))
    left, found, turn_round = conversations.count(), [], 0
    while True:
        last = left <= last_rows
        out = _peeled(paths, last, rows, turns, turn_round, left)
        found.append(out)
        if last:
            break
        paths = out.where("spine IS NOT NULL").select("spine.*")
        left, turn_round = paths.count(), turn_round + 1
    nodes = [x.where("spine IS NULL").select(*NODES.fieldNames()) for x in found]
    every = nodes[0]
    for x in nodes[1:]:
        every = every.unionByName(x)
    if len(found) == 1:
        return every.drop("block")
    # a finished node whose parent was a spine: the spine's nodes are finished in later rounds, asked for block by block
    finished = nodes[1]
    for x in nodes[2:]:
        finished = finished.unionByName(x)
    spines = found[0].where("spine IS NOT NULL").select("block", "keys")
    for x in found[1:-1]:
        spines = spines.unionByName(x.where("spine IS NOT NULL").select("block", "keys"))
    asked = spines.select("block", F.explode("keys").alias("parent")).distinct()
    told = asked.join(finished.select(F.col("node").alias("parent"), F.col("conv_id").alias("_told")), "parent")
    return every.join(told, ["block", "parent"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_told")).drop("block", "_told")


def end_digests(conversations: DataFrame) -> DataFrame:
    """node, ends_sha256: of the ids, in order, of the conversations that end there.

    Ids are sorted and joined chunk by chunk; one task streams a node's chunks through one hash.
    """
    ends = conversations.select(F.sha2(F.array_join("path", "").cast("binary"), 256).alias("node"), "conv_id")
    ends = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    conversations.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    chunk_schema = _fields(node=T.StringType(), first=T.LongType(), ids=T.StringType())
    chunk_arrow = to_arrow_schema(chunk_schema)

    def chunks(batches):
        node, held, out = None, [], []
        for batch in batches:
            for name, conv_id in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if held and (name != node or len(held) == IDS_PER_CHUNK):
                    out.append({"node": node, "first": held[0], "ids": ",".join(map(str, held))})
                    held = []
                node = name
                held.append(conv_id)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=chunk_arrow)
                out = []
        if held:
            yield pa.RecordBatch.from_pylist([{"node": node, "first": held[0], "ids": ",".join(map(str, held))}], schema=chunk_arrow)

    packed = ends.mapInArrow(chunks, chunk_schema)
    ordered = packed.repartition("node").sortWithinPartitions("node", "first")
    schema = _fields(node=T.StringType(), ends_sha256=T.StringType())
    arrow = to_arrow_schema(schema)

    def hashes(batches):
        node, sha = None, None
        for batch in batches:
            out = []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if name != node:
                    if sha:
                        out.append({"node": node, "ends_sha256": sha.hexdigest()})
                    node, sha = name, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if sha:
            yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": sha.hexdigest()}], schema=arrow)

    return ordered.mapInArrow(hashes, schema)


def prefix_trie(conversations: DataFrame, rows: int = BLOCK_ROWS, turns: int = BLOCK_TURNS, last_rows: int = LAST_ROWS) -> DataFrame:
    """One row per trie node: node (its digest), conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; a null turn comes first and turns of one number are ordered by the digest of role
    and text; repeated rows are turns each.  Rows without conv_id belong to no conversation and are left out.  A
    conversation's digests are held whole in one task, its texts never are.  Other columns are ignored; an empty table
    gives no rows.
    """
    whole = rebuilt(turn_lists(conversations))
    nodes = trie_nodes(whole, rows, turns, last_rows)
    return nodes.join(end_digests(whole), "node", "left").select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                                               F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def digest(trie: DataFrame) -> DataFrame:
    return trie.drop("node")


def oracle() -> str:
    """DuckDB SQL for the query's rows."""
    heads = f"{crc32_sql('conv_id::VARCHAR')} % {HEADS}"
    digest_of = "sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"
    count = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
    return f"""
WITH lists AS (
  SELECT conv_id, list({{'d': {digest_of}, 'w': {count}}} ORDER BY turn NULLS FIRST, {digest_of}) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM (SELECT *, {heads} AS h FROM lists) o LEFT JOIN lists b ON b.conv_id = o.conv_id - o.conv_id % {FAMILY}),
prefixes AS (
  SELECT conv_id, len(turns) AS n, d AS depth, array_to_string(list_transform(turns[1:d], lambda t: t.d), '') AS node,
         array_to_string(list_transform(turns[1:d - 1], lambda t: t.d), '') AS parent, CASE WHEN d > 0 THEN turns[d].w ELSE 0 END AS w
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, node, CASE WHEN depth > 0 THEN any_value(parent) END AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM prefixes GROUP BY depth, node),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent, depth),
below AS (
  SELECT p.depth, p.node, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum(n.own) AS saved_tokens
  FROM nodes n JOIN prefixes x ON x.conv_id = n.conv_id AND x.depth = n.depth JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  LEFT JOIN kids k ON k.parent = n.node AND k.depth = n.depth GROUP BY p.depth, p.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (depth, node) LEFT JOIN nodes u ON u.node = n.parent AND u.depth = n.depth - 1 LEFT JOIN kids k ON k.parent = n.node AND k.depth = n.depth"""
