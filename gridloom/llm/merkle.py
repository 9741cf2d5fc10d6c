"""Merkle manifest: every row is a leaf, runs of eight nodes hash to their parent, group trees hang under one root.

Leaves are numbered in their tree without a sort in one task and cut into superblocks of 512.
A first pass reduces every superblock to its root; what is left is reduced the same way until each
tree has one node, and the trees' roots become a tree of their own. On the way back each superblock
meets the nodes outside of it that its proofs need, one row of them, in a cogroup that reduces it
again, completes the proofs and folds every claimed leaf up to the root.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import ascii_lower, stored, table

FANOUT = 8
#: Levels that a superblock reduces, so that it has 512 leaves.
LEVELS = 3
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "tree string, pos long, n long, h string"
_PATH = "tree string, pos long, at array<int>, runs array<string>, root string"


def digest(*values: Column) -> Column:
    """sha256 in lower-case hex over the values: ``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (v.cast("string") for v in values)]
    return F.sha2(F.concat(*parts), 256)


def hash_nodes(nodes: str) -> str:
    """The digest of node digests that stand one after the other."""
    return hashlib.sha256(nodes.encode()).hexdigest()


def reduced(nodes: list[str], levels: int | None) -> list[list[str]]:
    """The nodes and their parents, grandparents, ...: ``levels`` steps of eight to one, or until one node remains."""
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        last = out[-1]
        out.append([hash_nodes("".join(last[i : i + FANOUT])) for i in range(0, len(last), FANOUT)])
    return out


def siblings(at: int, run: str) -> str:
    return run[: HEX * at] + run[HEX * (at + 1) :]


def folded(node: str, at: int, run: str) -> str:
    """The parent of a run whose node number ``at`` is ``node``."""
    return hash_nodes(run[: HEX * at] + node + run[HEX * (at + 1) :])


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``pos``, the number from 0 in the order of ``order`` (nulls first) within ``tree``, and ``n``, the rows of the tree.

    Rows are dealt by range and sorted in their partitions; a window over one row per
    partition and tree chains them. Equal rows are told apart by their place in the input, so
    many copies of one row are dealt to several partitions as well.
    """
    by = ["tree", *order, "__row"]
    ordered = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("__row")
    ordered = stored(ordered.withColumn("__at", F.monotonically_increasing_id()), "merkle-order").withColumn("__part", F.shiftright("__at", 33))
    pieces = ordered.groupBy("tree", "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__c"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("__c").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = stored(pieces.select("tree", "__part", "__first", before.alias("__before"), F.sum("__c").over(tree).alias("n")), "merkle-pieces")
    placed = ordered.join(pieces, ["tree", "__part"])
    return placed.withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__part", "__first", "__before")


def _block(levels: int) -> Column:
    return F.shiftright("pos", 3 * levels).alias("block")


def _local(nodes: pd.DataFrame, levels: int) -> list[list[str]]:
    """The levels of a superblock's nodes, which stand in their order; the only one of a tree is reduced to one node."""
    return reduced(list(nodes["h"]), None if nodes["n"].iloc[0] <= FANOUT**levels else levels)


def _steps(local: list[list[str]], i: int) -> list[tuple[int, str]]:
    """Place in its run, and the run, of node ``i`` and its ancestors within a superblock."""
    out = []
    for nodes in local[:-1]:
        start = i - i % FANOUT
        out.append((i % FANOUT, "".join(nodes[start : start + FANOUT])))
        i //= FANOUT
    return out


def climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The node tables from the leaves up, each with the trees that are not reduced yet, and ``tree, h, level`` of all tree roots.

    The number of tables is the logarithm of the largest tree to the base of a superblock's size.
    """
    size = FANOUT**levels

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        first = pdf.iloc[0]
        return pd.DataFrame({"tree": [first["tree"]], "pos": [first["pos"] // size], "n": [-(-first["n"] // size)], "h": [_local(pdf, levels)[-1][0]]})

    tables, roots = [nodes.select("tree", "pos", "n", "h")], None
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        up = stored(tables[-1].groupBy("tree", _block(levels)).applyInPandas(reduce, _NODE), "merkle-level")
        done = up.where("n = 1").select("tree", "h", F.lit(len(tables) - 1).alias("level"))
        roots = done if roots is None else roots.unionByName(done)
        if most <= size:
            return tables, roots
        tables.append(up.where("n > 1"))
        most = -(-most // size)


def paths(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """``tree, pos, at, runs, root`` of every node: its place in each run up to the root, and the runs.

    ``outer`` has ``tree, block, at, runs, root`` of the superblocks; one without a row ends at its own root.
    """

    def join(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=["tree", "pos", "at", "runs", "root"])
        pdf = pdf.sort_values("pos")
        local = _local(pdf, levels)
        at, runs, root = ([], [], local[-1][0]) if above.empty else (list(above["at"].iloc[0]), list(above["runs"].iloc[0]), above["root"].iloc[0])
        steps = [_steps(local, i) for i in range(len(pdf))]
        return pd.DataFrame({"tree": pdf["tree"].to_numpy(), "pos": pdf["pos"].to_numpy(), "at": [[a for a, _ in s] + at for s in steps], "runs": [[r for _, r in s] + runs for s in steps], "root": root})

    blocks = nodes.select("tree", "pos", "n", "h", _block(levels))
    return blocks.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(join, _PATH)


def manifest(leaves: DataFrame, proofs: bool = False, levels: int = LEVELS) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``leaves(tree, id, leaf, claimed)``.

    ``tree`` names the group and is not null; groups ascend by it. In a group leaves
    ascend by ``id``, null first, equal ids by leaf. ``claimed`` is the leaf that somebody shows, or
    null for the leaf itself: it is folded with the siblings of the manifest, and ``verified`` says
    whether that gives the root. ``proofs`` adds ``proof``, the siblings from the leaf's run up to the root.

    A superblock and its row of outer nodes are all that a task holds, so a group of a third
    of all rows is as many groups as it has superblocks. No rows: no rows.
    """
    placed = stored(numbered(leaves.select("tree", "id", "leaf", "claimed"), "id", "leaf"), "merkle-leaves")
    tables, roots = climb(placed.withColumnRenamed("leaf", "h"), levels)
    roots = stored(roots, "merkle-roots")
    top = stored(numbered(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "h", "level"), "name"), "merkle-top")
    top_tables, _ = climb(top, levels)
    spark = leaves.sparkSession
    path = spark.createDataFrame([], "tree string, block long, at array<int>, runs array<string>, root string")
    for nodes in reversed(top_tables):
        path = stored(paths(nodes, path, levels), "merkle-path").withColumnRenamed("pos", "block")
    ends = top.select("pos", "name", "level", F.col("h").alias("subroot")).join(path.select(F.col("block").alias("pos"), "at", "runs", "root"), "pos")
    ends = stored(ends.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "at", "runs", "root", "subroot", "level"), "merkle-ends")
    outer = ends.where(F.col("level") == len(tables) - 1).drop("level", "subroot")
    for level in range(len(tables) - 1, 0, -1):
        above = paths(tables[level], outer, levels).withColumnRenamed("pos", "block")
        outer = stored(above.unionByName(ends.where(F.col("level") == level - 1).drop("level", "subroot")), "merkle-outer")

    subroots = ends.select("tree", "subroot")
    kind = leaves.schema["id"].dataType.simpleString()
    columns = ["id", "leaf", "root", "proof", "folded_root", "tree"]

    def finish(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=columns)
        pdf = pdf.sort_values("pos")
        local = _local(pdf, levels)
        beyond = list(zip(above["at"].iloc[0], above["runs"].iloc[0]))
        rest = "".join(siblings(a, r) for a, r in beyond)
        known: dict[str, str] = {}  # superblock root → root
        proof, ends = [], []
        for i, (leaf, claimed) in enumerate(zip(pdf["h"], pdf["claimed"])):
            steps = _steps(local, i)
            node = leaf if claimed is None else claimed
            for a, r in steps:
                node = folded(node, a, r)
            if node not in known:
                end = node
                for a, r in beyond:
                    end = folded(end, a, r)
                known[node] = end
            ends.append(known[node])
            text = "".join(siblings(a, r) for a, r in steps) + rest
            proof.append(text if proofs else hash_nodes(text))
        out = {"id": pdf["id"].to_numpy(), "leaf": pdf["h"].to_numpy(), "root": above["root"].iloc[0], "proof": proof, "folded_root": ends, "tree": pdf["tree"].to_numpy()}
        return pd.DataFrame(out, columns=columns)

    blocks = placed.select("tree", "pos", "n", "id", F.col("leaf").alias("h"), "claimed", _block(levels))
    done = blocks.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, f"id {kind}, leaf string, root string, proof string, folded_root string, tree string")
    shown = [F.sha2("proof", 256).alias("proof_sha256"), "proof"] if proofs else [F.col("proof").alias("proof_sha256")]
    return done.join(subroots, "tree").select("id", "leaf", "subroot", "root", *shown, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``tree, id, leaf, claimed`` of documents: the digest of the five fields; where ``tampered`` holds, ``claimed`` is that with A-Z of the text in lower case.

    Trees are languages, null first, then by their bytes. Columns beyond the five stay behind.
    """
    fields = [F.col(name) for name in FIELDS]
    claimed = F.lit(None).cast("string") if tampered is None else F.when(tampered, digest(*fields[:-1], ascii_lower(F.col("text"))))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    return docs.select(tree.alias("tree"), F.col("doc_id").alias("id"), digest(*fields).alias("leaf"), claimed.alias("claimed"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest(stored(document_leaves(docs, tampered), "merkle-digests")).withColumnRenamed("id", "doc_id")


def _levels_sql(nodes: str, rows: str, name: str, levels: int) -> str:
    """CTEs that reduce ``nodes(tree, pos, h)`` and fold ``rows(r, tree, pos, cur, proof)`` along, ``levels`` steps."""
    out = []
    for k in range(levels):
        before = (nodes, rows) if k == 0 else (f"{name}_t{k}", f"{name}_d{k}")
        out.append(f"""{name}_r{k} AS MATERIALIZED (
  SELECT tree, pos // 8 AS pos, string_agg(h, '' ORDER BY pos) AS run, any_value(h) AS h, any_value(c) AS c
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {before[0]}) GROUP BY tree, pos // 8
), {name}_t{k + 1} AS MATERIALIZED (SELECT tree, pos, CASE WHEN c > 1 THEN sha256(run) ELSE h END AS h FROM {name}_r{k}
), {name}_d{k + 1} AS MATERIALIZED (
  SELECT r, d.tree, n.pos, CASE WHEN c > 1 THEN sha256(left(run, 64 * (d.pos % 8)) || cur || substr(run, 64 * (d.pos % 8) + 65)) ELSE cur END AS cur,
         CASE WHEN c > 1 THEN proof || left(run, 64 * (d.pos % 8)) || substr(run, 64 * (d.pos % 8) + 65) ELSE proof END AS proof
  FROM {before[1]} d JOIN {name}_r{k} n ON d.tree = n.tree AND d.pos // 8 = n.pos
)""")
    return ", ".join(out)


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_HEAD_SQL = " || ".join(_field_sql(name) for name in FIELDS[:-1])
#: Trees of up to 8 ** 8 rows and 8 ** 3 languages.
OP12_SQL = f"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS tree, sha256({_HEAD_SQL} || {_field_sql("text")}) AS leaf,
         sha256({_HEAD_SQL} || {_field_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS other,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 3 = 0 AS tampered
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, CASE WHEN tampered THEN other ELSE leaf END AS cur, '' AS proof FROM doc
), start_nodes AS (SELECT tree, pos, leaf AS h FROM leaves
), start_rows AS (SELECT r, tree, pos, cur, proof FROM leaves
), {_levels_sql("start_nodes", "start_rows", "low", 8)}, top AS MATERIALIZED (
  SELECT tree AS name, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM low_t8
), top_nodes AS (SELECT '' AS tree, pos, subroot AS h FROM top
), top_rows AS (SELECT r, '' AS tree, top.pos, cur, proof FROM low_d8 JOIN top ON low_d8.tree = top.name
), {_levels_sql("top_nodes", "top_rows", "high", 3)}
SELECT doc_id, leaf, subroot, high_t3.h AS root, sha256(d.proof) AS proof_sha256, d.cur AS folded_root, d.cur = high_t3.h AS verified
FROM high_d3 d JOIN leaves USING (r) JOIN top ON leaves.tree = top.name CROSS JOIN high_t3
"""
