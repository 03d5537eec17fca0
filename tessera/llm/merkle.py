"""Merkle manifest of a dataset: one tree a group of rows, one tree over the groups.

A leaf is the SHA-256 of a row's fields, each ``-`` if NULL, else its UTF-8
byte count, ``:`` and its value.  The leaves of a group ascend by key (NULL
first; equal keys by leaf, so repeated rows are interchangeable); every FANOUT
consecutive nodes become the hash of their hex digests until one is left, the
group's subroot.  Subroots, by group (NULL first, UTF-8 bytewise), become the
root in the same way.  A lone leaf is its group's subroot.

How it is spread: rows get their place in the group from a range partitioning
(no window over a group), so a group that holds a third of all rows is cut into
superblocks of FANOUT ** DEPTH neighbours like any other.

* Up: every superblock becomes one node; the nodes of a group are numbered by
  superblock, and the next table is a FANOUT ** DEPTH-th as long.
* Down: nodes and the outer nodes their superblock needs - the runs on its way
  to the root - are cogrouped by superblock.  The task finishes the local
  levels again, joins local and outer runs to proofs and, for leaves, folds
  every (tampered) leaf to a root along its proof.

No task sees more than a superblock and one way to the root.  Every table
between two steps is written to the shared folder.

Defined results: an empty table gives no rows; NULL in any field is ``-``; a row
with NULL key is never tampered with; repeated rows are leaves of their own.
Columns that are not fields are not read, whatever their names.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: nodes a run; levels that a superblock is reduced by at once
FANOUT, DEPTH = 16, 2
SPAN = FANOUT ** DEPTH
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields, each with its length before it."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def lowered_text(key: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """The tampering of the query: A-Z of every text whose crc32(key) is a multiple of 5 lower-cased."""
    hit = F.crc32(F.encode(F.col(key).cast("string"), "utf-8")) % 5 == 0
    return {text: F.when(hit, F.translate(text, UPPER, LOWER)).otherwise(F.col(text))}


# ------------------------------------------------------------------ places
def numbered(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place within ``group`` by ``order``, and ``n``, the group's rows.

    ``order`` must tell rows apart.  Ranges of (group, order) are written with
    a running number; the first number of each (group, range) and the rows of
    the group before it give the place.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = cut(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), f"{name}-ranged")
    spans = ranged.groupBy(group, "part").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    # a row for each range that a group reaches into: at most as many as there are ranges
    spans = spans.selectExpr(group, "part",
                             f"sum(rows) over (partition by {group} order by part) - rows - first as shift",
                             f"sum(rows) over (partition by {group}) as n")
    return cut(ranged.join(spans, [group, "part"]).withColumn("pos", F.col("row") + F.col("shift")).drop("part", "row", "shift"), f"{name}-numbered")


# ------------------------------------------------------------------- local
def levels_left(n: int) -> int:
    """Reductions until one of ``n`` nodes is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def local_levels(nodes: list[str], steps: int) -> list[list[str]]:
    """The nodes of a superblock, level by level upwards."""
    levels = [nodes]
    for _ in range(steps):
        below = levels[-1]
        levels.append([digest(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return levels


def way(levels: list[list[str]], i: int) -> list[str]:
    """The runs that node ``i`` passes within its superblock, as ``place:digests``."""
    out = []
    for below in levels[:-1]:
        low = i - i % FANOUT
        out.append(f"{i % FANOUT}:{''.join(below[low:low + FANOUT])}")
        i //= FANOUT
    return out


def siblings(path: Sequence[str]) -> str:
    """The digests a proof consists of: every run of the way without the node itself."""
    out = []
    for step in path:
        at, run = step.split(":")
        low = 64 * int(at)
        out.append(run[:low] + run[low + 64:])
    return "".join(out)


def fold(node: str, path: Sequence[str]) -> str:
    """The root that a leaf and the siblings on its way lead to."""
    for step in path:
        at, run = step.split(":")
        low = 64 * int(at)
        node = digest((run[:low], node, run[low + 64:]))
    return node


# ---------------------------------------------------------------- up, down
NODE = "grp string, pos long, n long, node binary"


def _sorted_nodes(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list[list[str]]]:
    pdf = pdf.sort_values("pos", ignore_index=True)
    steps = min(DEPTH, levels_left(int(pdf["n"].iloc[0])))
    return pdf, local_levels([x.hex() for x in pdf["node"]], steps)


def _up(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf, levels = _sorted_nodes(pdf)
    n = int(pdf["n"].iloc[0])
    for _ in levels[1:]:
        n = -(-n // FANOUT)
    return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "n": [n], "node": [bytes.fromhex(levels[-1][0])]})


def ascend(nodes: DataFrame, name: str) -> list[DataFrame]:
    """``nodes`` and the tables above it, up to the one with one node a group."""
    tables = [nodes]
    while True:
        blocks = tables[-1].select("grp", F.floor(F.col("pos") / SPAN).cast("long").alias("block"), "pos", "n", "node")
        tables.append(cut(blocks.groupBy("grp", "block").applyInPandas(_up, NODE), f"{name}-up"))
        if (tables[-1].agg(F.max("n")).first()[0] or 0) <= 1:
            return tables


WAY = "grp string, pos long, node binary, path string, subroot string, root string"


def _down(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    if nodes.empty:
        return pd.DataFrame({c.split()[0]: [] for c in WAY.split(", ")})
    nodes, levels = _sorted_nodes(nodes)
    above = outer["path"].iloc[0].split("/") if outer["path"].iloc[0] else []
    return pd.DataFrame({"grp": nodes["grp"], "pos": nodes["pos"], "node": nodes["node"],
                         "path": ["/".join(way(levels, i) + above) for i in range(len(nodes))],
                         "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0]})


def with_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / SPAN).cast("long"))


def descend(tables: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """The way of every node of the first table, from the ways of the last table's nodes."""
    for nodes in reversed(tables[:-1]):
        tops = cut(with_blocks(nodes).groupBy("grp", "block").cogroup(tops.groupBy("grp", "pos"))
                   .applyInPandas(_down, WAY), f"{name}-down")
    return tops


def _proved(with_proof: bool):
    def prove(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows, levels = _sorted_nodes(rows)
        above = outer["path"].iloc[0].split("/") if len(outer) and outer["path"].iloc[0] else []
        ways = [way(levels, i) + above for i in range(len(rows))]
        out = {"id": rows["id"], "leaf": levels[0], "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0],
               "proof_sha256": [digest((siblings(w),)) for w in ways],
               "folded_root": [fold(levels[0][i] if rows["tampered"].iloc[i] is None else rows["tampered"].iloc[i].hex(), w)
                               for i, w in enumerate(ways)]}
        if with_proof:
            out["proof"] = ["/".join(w) for w in ways]
        return pd.DataFrame(out)

    return prove


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS,
             tampered: dict[str, Column] | None = None, with_proof: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) for every row.

    ``tampered`` replaces fields of the rows that are folded; leaves, proofs and
    roots are those of the untampered table.  ``with_proof`` adds ``proof``, the
    runs from the leaf to the root as ``place:digests`` joined by ``/`` (see
    :func:`fold`, :func:`siblings`).
    """
    changed = leaf([(tampered or {}).get(f, F.col(f)) for f in fields])
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
                         F.col(key).alias("id"), F.unhex(leaf([F.col(f) for f in fields])).alias("node"),
                         F.unhex(changed).alias("tampered"))
    leaves = cut(leaves.select("grp", "id", "node", F.when(F.col("tampered") != F.col("node"), F.col("tampered")).alias("tampered"),
                               F.monotonically_increasing_id().alias("tie")), "merkle-leaves")
    leaves = numbered(leaves, "grp", ["id", "node", "tie"], "merkle")
    groups = ascend(leaves.select("grp", "pos", "n", "node"), "merkle")

    # the tree over the subroots: the same, with the one group ""
    subroots = groups[-1].select(F.lit("").alias("all"), F.col("grp").alias("name"), "node")
    subroots = numbered(subroots, "all", ["name"], "merkle-top")
    top = ascend(subroots.select(F.col("all").alias("grp"), "pos", "n", "node"), "merkle-top")
    start = top[-1].select("grp", "pos", "node", F.lit("").alias("path"), F.lit("").alias("subroot"), F.lower(F.hex("node")).alias("root"))
    ways = descend(top, start, "merkle-top")
    ways = subroots.select("pos", "name").join(ways, "pos").select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("pos"), "node", "path", F.lower(F.hex("node")).alias("subroot"), "root")

    ways = descend(groups[1:], ways, "merkle")
    kind = docs.schema[key].dataType.simpleString()
    ddl = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string" + ", proof string" * with_proof
    proved = (with_blocks(leaves).groupBy("grp", "block").cogroup(ways.groupBy("grp", "pos")).applyInPandas(_proved(with_proof), ddl))
    return proved.select(F.col("id").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"), *["proof"] * with_proof)


def report(docs: DataFrame) -> DataFrame:
    """The manifest of the documents with lower-cased texts as tampering (``op13_merkle_manifest``)."""
    return manifest(docs, tampered=lowered_text())


def _field(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def _tree(name: str, start: str) -> str:
    """A recursive CTE of the levels over ``start`` (grp, pos, node), runs of 16."""
    return f"""{name} AS (
  SELECT 0 AS level, grp, pos, node FROM {start}
  UNION ALL
  SELECT level + 1, grp, pos // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS c FROM {name}) WHERE c > 1 GROUP BY level, grp, pos // 16),
{name}_top AS (SELECT *, max(level) OVER (PARTITION BY grp) AS top FROM {name})"""


def _steps(tree: str, key: str, grp: str, pos: str, start: str, no: int) -> str:
    """For every row of ``start`` and level, the siblings before and after its node."""
    own = f"({pos} // CAST(pow(16, u.level) AS BIGINT))"
    return f"""SELECT {key} AS rid, {no} AS tree, u.level,
  coalesce(string_agg(u.node, '' ORDER BY u.pos) FILTER (WHERE u.pos < {own}), '') || '|' ||
  coalesce(string_agg(u.node, '' ORDER BY u.pos) FILTER (WHERE u.pos > {own}), '') AS step
FROM {start} JOIN {tree}_top u ON u.grp = {grp} AND u.level < u.top AND u.pos // 16 = {own} // 16 GROUP BY ALL"""


#: CRC-32 of a text bit by bit: polynomial 0xEDB88320 (fixed value)
_CRC = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::UBIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295)"""

#: DuckDB SQL for the rows of :func:`report`
ORACLE = f"""WITH RECURSIVE docs AS (SELECT row_number() OVER () AS rid, *, CAST(doc_id AS VARCHAR) AS s FROM documents),
flagged AS (SELECT *, coalesce({_CRC} % 5 = 0, false) AS hit FROM docs),
leaves AS (
  SELECT rid, doc_id, coalesce('=' || source, '') AS grp, hit, sha256({" || ".join(_field(f) for f in FIELDS)}) AS node,
    sha256({" || ".join(_field("translate(text, '" + UPPER + "', '" + LOWER + "')" if f == "text" else f) for f in FIELDS)}) AS lowered
  FROM flagged),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, node) - 1 AS pos FROM leaves),
{_tree("inner_tree", "placed")},
subroots AS (SELECT '' AS grp, grp AS name, node, row_number() OVER (ORDER BY grp) - 1 AS pos FROM inner_tree_top WHERE level = top),
{_tree("outer_tree", "subroots")},
steps AS (
  {_steps("inner_tree", "p.rid", "p.grp", "p.pos", "placed p", 0)}
  UNION ALL
  {_steps("outer_tree", "p.rid", "s.grp", "s.pos", "placed p JOIN subroots s ON s.name = p.grp", 1)}),
ways AS (SELECT rid, list(step ORDER BY tree, level) AS way FROM steps GROUP BY rid),
folded AS (
  SELECT p.doc_id, p.node AS leaf, s.node AS subroot, r.node AS root,
    sha256(replace(array_to_string(coalesce(way, []), ''), '|', '')) AS proof_sha256,
    list_reduce(list_concat([CASE WHEN hit THEN lowered ELSE p.node END], coalesce(way, [])),
      lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root
  FROM placed p JOIN subroots s ON s.name = p.grp CROSS JOIN (SELECT node FROM outer_tree_top WHERE level = top) r
  LEFT JOIN ways w ON w.rid = p.rid)
SELECT *, folded_root = root AS verified FROM folded"""
