"""Merkle manifest of a table with octopus multiproofs.

A row is a leaf; leaves of one language, in order, form a tree of fan-out eight, and the languages' roots form the tree
above.  Sorted leaves lie in blocks of consecutive ones (the leaf partitions).  A block hashes what lies wholly inside
it and passes on only its fringe, the largest complete nodes; the few fringe nodes are joined level by level to the
roots.  For the proofs each block computes the least set of node coordinates that it misses, as an octopus multiproof
does, gets them by one join, derives the interiors that its leaves share once, and expands each leaf's own proof.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from portflow.llm.common import crc32_sql, written

FANOUT = 8
#: most leaves of a block
BLOCK = 8192
#: rows of block offsets or top proofs that are broadcast; beyond, an ordinary join
BROADCAST_ROWS = 50_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def node_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def sizes(total: int, fanout: int = FANOUT) -> list[int]:
    """Nodes of each level, from the leaves to the root."""
    out = [total]
    while out[-1] > 1:
        out.append(-(-out[-1] // fanout))
    return out


def missing(positions: np.ndarray, total: int, fanout: int = FANOUT) -> list[np.ndarray]:
    """For each level below the root the indices that the leaves at ``positions`` need beside what they give themselves."""
    known, out = np.unique(np.asarray(positions, np.int64)), []
    for size in sizes(total, fanout)[:-1]:
        parents = np.unique(known // fanout)
        family = (parents[:, None] * fanout + np.arange(fanout)).ravel()
        out.append(np.setdiff1d(family[family < size], known, assume_unique=True))
        known = parents
    return out


def fringe(first: int, leaves: list[str], total: int, fanout: int = FANOUT) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of the largest nodes that lie wholly in the run of leaves from ``first``."""
    low, nodes = first, leaves
    for level, size in enumerate(sizes(total, fanout)):
        high = low + len(nodes)
        up_low = -(-low // fanout)
        up_high = -(-high // fanout) if high == size else high // fanout
        if size == 1 or up_high <= up_low:
            yield from ((level, low + k, x) for k, x in enumerate(nodes))
            return
        inner = range(up_low * fanout, min(up_high * fanout, size))
        yield from ((level, low + k, x) for k, x in enumerate(nodes) if low + k not in inner)
        nodes = [node_hash("".join(nodes[k * fanout - low:(k + 1) * fanout - low])) for k in range(up_low, up_high)]
        low = up_low


def derive(first: int, leaves: list[str], total: int, fetched: dict[tuple[int, int], str], fanout: int = FANOUT) -> tuple[list[tuple[int, list[str]]], str]:
    """Per level (index of the first node, nodes) of all families on the leaves' ways up, and the root."""
    rows, low, nodes = [], first, leaves
    for level, size in enumerate(sizes(total, fanout)[:-1]):
        start, stop = low // fanout * fanout, min(-(-(low + len(nodes)) // fanout) * fanout, size)
        row = [fetched[level, k] for k in range(start, low)] + nodes + [fetched[level, k] for k in range(low + len(nodes), stop)]
        rows.append((start, row))
        nodes = [node_hash("".join(row[k:k + fanout])) for k in range(0, len(row), fanout)]
        low = start // fanout
    return rows, nodes[0]


def expand(first: int, count: int, rows: list[tuple[int, list[str]]], fanout: int = FANOUT) -> Iterator[list[tuple[str, str]]]:
    """Each leaf's proof: per level the digests before and after it in its family."""
    sides = [{} for _ in rows]

    def side(level: int, index: int) -> tuple[str, str]:
        if index not in sides[level]:
            start, row = rows[level]
            family = index // fanout * fanout - start
            sides[level][index] = "".join(row[family:index - start]), "".join(row[index - start + 1:family + fanout])
        return sides[level][index]

    above: dict[int, list[tuple[str, str]]] = {}
    for position in range(first, first + count):
        parent = position // fanout
        if rows and parent not in above:
            above = {parent: [side(level, position // fanout ** level) for level in range(1, len(rows))]}
        yield [side(0, position), *above[parent]] if rows else []


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    for before, after in proof:
        leaf = node_hash(before + leaf + after)
    return leaf


# on Spark --------------------------------------------------------------------------------------------------------------

def _part(name: str, text: Column | None = None) -> Column:
    value = (F.col(f"`{name}`") if text is None else text).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(text: Column | None = None) -> Column:
    return F.sha2(F.concat(*[_part(x) for x in FIELDS[:-1]], _part("text", text)).cast("binary"), 256)


def hashed(docs: DataFrame) -> DataFrame:
    """tree, id, leaf, tampered (null where the row isn't tampered with): one narrow row a document, written once."""
    a_to_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return written(docs.select(tree_name(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("id"), leaf_hash().alias("leaf"),
                               F.when(third, leaf_hash(F.translate("text", a_to_z, a_to_z.lower()))).alias("tampered")), "leaves")


def tree_name(lang: Column) -> Column:
    """Never null; null comes first and names keep their bytewise order."""
    return F.when(lang.isNull(), "").otherwise(F.concat(F.lit("="), lang.cast("string")))


def arrow_pass(df: DataFrame, fn, schema: T.StructType, rows: int) -> DataFrame:
    """``mapInArrow`` of dicts of rows; ``rows`` is the size of Arrow batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    arrow = to_arrow_schema(schema)

    def run(batches):
        for out in fn(batches):
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return df.mapInArrow(run, schema)


def _type(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


def blocks(leaves: DataFrame, block: int = BLOCK) -> DataFrame:
    """block, tree, part, at (index in tree and part), n, ids, leaves, tampered: runs of at most ``block`` consecutive leaves of a tree.

    Sorted by tree, id (null first) and leaf; equal rows are split by the order they are read in, so no key is too hot.
    """
    spread = leaves.withColumn("_tie", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange("tree", "id", "leaf", "_tie").sortWithinPartitions("tree", "id", "leaf", "_tie").drop("_tie")
    schema = T.StructType([_type("block", T.StringType()), _type("tree", T.StringType()), _type("part", T.IntegerType()), _type("at", T.LongType()), _type("n", T.LongType()),
                           _type("ids", T.ArrayType(leaves.schema["id"].dataType)), _type("leaves", T.ArrayType(T.StringType())), _type("tampered", T.ArrayType(T.StringType()))])

    def run(batches):
        part, tree, at, held = TaskContext.get().partitionId(), None, 0, []

        def row() -> list[dict]:
            ids, digests, tampered = zip(*held)
            return [{"block": f"{part}/{tree}/{at}", "tree": tree, "part": part, "at": at, "n": len(held), "ids": ids, "leaves": digests, "tampered": tampered}]

        for batch in batches:
            for name, *leaf in zip(*(batch.column(c).to_pylist() for c in ("tree", "id", "leaf", "tampered"))):
                if held and (name != tree or len(held) == block):
                    yield row()
                    at, held = at + len(held), []
                if name != tree:
                    tree, at = name, 0
                held.append(leaf)
        if held:
            yield row()

    return written(arrow_pass(ordered, run, schema, 10_000), "blocks")


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcasting if it has few rows, else as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def placed(found: DataFrame) -> DataFrame:
    """Blocks with ``first`` (the first leaf's position in its tree) and ``total`` (leaves of the tree)."""
    counts = found.groupBy("tree", "part").agg(F.sum("n").alias("here"))
    whole = Window.partitionBy("tree")
    offsets = written(counts.select("tree", "part", (F.sum("here").over(whole.orderBy("part")) - F.col("here")).alias("offset"), F.sum("here").over(whole).alias("total")), "offsets")
    return found.join(small(offsets), ["tree", "part"]).withColumn("first", F.col("offset") + F.col("at")).drop("part", "at", "offset")


NODES = T.StructType([_type("tree", T.StringType()), _type("total", T.LongType()), _type("level", T.IntegerType()), _type("index", T.LongType()), _type("digest", T.StringType())])


def nodes(found: DataFrame) -> DataFrame:
    """tree, total, level, index, digest: every node that no block has wholly inside a larger complete node, up to the roots."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield [{"tree": r["tree"], "total": r["total"], "level": level, "index": index, "digest": digest} for level, index, digest in fringe(r["first"], r["leaves"], r["total"])]

    given = written(arrow_pass(found.select("tree", "total", "first", "leaves"), run, NODES, 16), "fringe")
    levels = len(sizes(given.agg(F.max("total")).first()[0] or 1)) - 1
    out, up = given, None
    for level in range(levels):
        kids = given.where(F.col("level") == level)
        kids = (kids if up is None else kids.unionByName(up)).where(F.col("total") > FANOUT ** level)
        family = F.sort_array(F.collect_list(F.struct("index", "digest")))
        up = written(kids.groupBy("tree", "total", F.expr(f"index div {FANOUT}").alias("parent")).agg(F.sha2(F.array_join(family["digest"], "").cast("binary"), 256).alias("digest"))
                     .select("tree", "total", F.lit(level + 1).cast("int").alias("level"), F.col("parent").alias("index"), "digest"), "level")
        out = out.unionByName(up)
    return out


def roots(tree_nodes: DataFrame) -> DataFrame:
    return tree_nodes.where(F.pow(F.lit(float(FANOUT)), F.col("level")) >= F.col("total")).select("tree", F.col("digest").alias("root"))


def fetched(found: DataFrame, tree_nodes: DataFrame) -> DataFrame:
    """block, given: the digests at all coordinates that a block misses, got by one join."""
    schema = T.StructType([_type("block", T.StringType()), _type("tree", T.StringType()), _type("level", T.IntegerType()), _type("index", T.LongType())])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                gaps = missing(np.arange(r["first"], r["first"] + r["n"]), r["total"])
                yield [{"block": r["block"], "tree": r["tree"], "level": level, "index": int(k)} for level, ks in enumerate(gaps) for k in ks]

    wanted = arrow_pass(found.select("block", "tree", "first", "n", "total"), run, schema, 256)
    return wanted.join(tree_nodes.select("tree", "level", "index", "digest"), ["tree", "level", "index"]).groupBy("block").agg(F.collect_list(F.struct("level", "index", "digest")).alias("given"))


def _proofs(r: dict) -> tuple[Iterator[list[tuple[str, str]]], str]:
    given = {(x["level"], x["index"]): x["digest"] for x in r["given"] or ()}
    rows, root = derive(r["first"], r["leaves"], r["total"], given)
    return expand(r["first"], r["n"], rows), root


PATH = T.ArrayType(T.StructType([_type("before", T.StringType()), _type("after", T.StringType())]))


def proofs(leaves: DataFrame, block: int = BLOCK) -> DataFrame:
    """id, tree, leaf, path (per level the digests before and after it), root: one row per row of ``leaves``.

    ``leaves`` has tree (a string, not null), id (null first), leaf (a hex digest) and tampered (any digest or null).
    An empty table gives no rows; a lone leaf is its own root with an empty path.
    """
    found = placed(blocks(leaves, block))
    schema = T.StructType([_type("id", leaves.schema["id"].dataType), _type("tree", T.StringType()), _type("leaf", T.StringType()), _type("path", PATH), _type("root", T.StringType())])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                paths, root = _proofs(r)
                yield [{"id": i, "tree": r["tree"], "leaf": leaf, "path": [{"before": b, "after": a} for b, a in path], "root": root} for i, leaf, path in zip(r["ids"], r["leaves"], paths)]

    return arrow_pass(found.join(fetched(found, nodes(found)), "block", "left").drop("tampered"), run, schema, 4)


def manifest(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Nulls in any column are hashed as ``-``; a null lang is a tree of its own, before all others; null doc_ids come
    first and are never tampered with (they have no decimal form).  Repeated doc_ids are ordered by their leaf, wholly
    equal rows stand next to each other.  Texts of any length are hashed whole in the scan; other columns are ignored;
    an empty table gives no rows.
    """
    leaves = hashed(docs)
    found = placed(blocks(leaves, block))
    tree_nodes = nodes(found)
    subroots = roots(tree_nodes)
    top = proofs(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("root").alias("leaf"), F.lit(None).cast("string").alias("tampered")), block)
    top = written(top.select(F.col("id").alias("tree"), F.col("leaf").alias("subroot"), F.col("path").alias("top"), F.col("root").alias("root")), "top")
    ready = found.join(fetched(found, tree_nodes), "block", "left").join(small(top), "tree")
    schema = T.StructType([_type("doc_id", T.LongType()), *(_type(x, T.StringType()) for x in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), _type("verified", T.BooleanType())])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                paths, _ = _proofs(r)
                top = [(x["before"], x["after"]) for x in r["top"]]
                out = []
                for doc_id, leaf, tampered, path in zip(r["ids"], r["leaves"], r["tampered"], paths):
                    path = path + top
                    folded = fold(leaf if tampered is None else tampered, path)
                    out.append({"doc_id": doc_id, "leaf": leaf, "subroot": r["subroot"], "root": r["root"], "proof_sha256": node_hash("".join(b + a for b, a in path)),
                                "folded_root": folded, "verified": folded == r["root"]})
                yield out

    return arrow_pass(ready, run, schema, 4)


def oracle() -> str:
    """DuckDB SQL for the query's rows."""
    part = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')".format
    head = " || ".join(part(x) for x in FIELDS[:-1])
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(name: str, first: str) -> str:
        return f"""
{name} AS (
  SELECT tree, count(*) OVER (PARTITION BY tree) AS size, 0 AS level, pos, digest FROM ({first})
  UNION ALL
  SELECT tree, (size + {FANOUT - 1}) // {FANOUT}, level + 1, pos // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos)) FROM {name} WHERE size > 1 GROUP BY tree, size, level, pos // {FANOUT}),
{name}_families AS (SELECT tree, level, pos // {FANOUT} AS up, list(digest ORDER BY pos) AS family FROM {name} WHERE size > 1 GROUP BY tree, level, pos // {FANOUT}),
{name}_paths AS (
  SELECT tree, n.pos, list({{'b': array_to_string(family[1:(n.pos // step) % {FANOUT}], ''), 'a': array_to_string(family[(n.pos // step) % {FANOUT} + 2:], '')}} ORDER BY f.level) AS path
  FROM {name} n JOIN (SELECT *, ({FANOUT} ^ level)::BIGINT AS step FROM {name}_families) f USING (tree)
  WHERE n.level = 0 AND (n.pos // step) // {FANOUT} = f.up GROUP BY tree, n.pos)"""

    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({head} || {part("text")}) AS leaf,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN sha256({head} || {part(lower)}) END AS tampered FROM documents),
ordered AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
{tree("nodes", "SELECT tree, pos, leaf AS digest FROM ordered").lstrip()},
subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE size = 1),
{tree("tops", "SELECT '' AS tree, pos, digest FROM subroots").lstrip()},
paths AS (
  SELECT doc_id, leaf, tampered, s.digest AS subroot, (SELECT digest FROM tops WHERE size = 1) AS root, list_concat(coalesce(p.path, []), coalesce(t.path, [])) AS path
  FROM ordered o JOIN subroots s USING (tree) LEFT JOIN nodes_paths p ON p.tree = o.tree AND p.pos = o.pos LEFT JOIN tops_paths t ON t.pos = s.pos),
folded AS (
  SELECT *, sha256(array_to_string(list_transform(path, lambda p: p.b || p.a), '')) AS proof_sha256,
         list_reduce(list_concat([{{'b': '', 'a': coalesce(tampered, leaf)}}], path), lambda x, y: {{'b': '', 'a': sha256(y.b || x.a || y.a)}}).a AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded"""
