"""A Merkle manifest of a dataset, by checkpoint and recompute.

Every row is a leaf; the leaves of a source are a tree whose nodes join up to 16
consecutive ones; the sources' roots are joined likewise. Only every other level
is written (``STRIDE``): nodes whose height is a multiple of it, and the roots.
A proof needs the siblings on all levels. They are extracted subtree by subtree,
from the top down: a subtree's stored nodes are read together with the path
above it, its missing interior nodes are computed anew, the siblings of each
stored node are emitted, and the interior is forgotten.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakemart.llm.common import cut, discard, prepare, ranked, to_batch

#: Nodes joined to one.
FANOUT = 16
#: Levels from one written level to the next; an aligned subtree has FANOUT ** STRIDE nodes at most.
STRIDE = 2
SUBTREE = FANOUT**STRIDE
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(values: Sequence[Column]) -> Column:
    """sha256 of the values in order, each as its UTF-8 byte count, a colon and itself, or `-` if null."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def join_digests(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def interior(nodes: Sequence[str], levels: int) -> list[list[str]]:
    """``nodes`` and the levels above them, ``levels`` of them."""
    out = [list(nodes)]
    for _ in range(levels):
        below = out[-1]
        out.append([join_digests(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def siblings(tree: Sequence[Sequence[str]], i: int) -> list[tuple[str, str]]:
    """For node i of the lowest level, the others of its run before and after
    it, on each level below the topmost."""
    path = []
    for level in tree[:-1]:
        run = i // FANOUT * FANOUT
        path.append(("".join(level[run:i]), "".join(level[i + 1 : run + FANOUT])))
        i //= FANOUT
    return path


def fold(digest: str, path: Sequence[Sequence[str]]) -> str:
    """The root that a node and its path of siblings lead to."""
    for before, after in path:
        digest = hashlib.sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


def _levels(count: Column) -> Column:
    """Levels from a tree's ``count`` nodes to its root."""
    out = F.lit(0)
    for k in range(1, 16):  # FANOUT ** 15 passes the range of places
        out = out + F.when(count > F.lit(FANOUT ** (k - 1)), 1).otherwise(0)
    return out


@dataclass
class Tree:
    """The written levels of a set of trees, from the lowest up, and (tree, root)."""

    levels: list[DataFrame]
    roots: DataFrame


def _subtrees(nodes: DataFrame) -> DataFrame:
    """One row for each aligned subtree: its nodes' digests in order, and how many levels it has."""
    group = F.shiftright("pos", 4 * STRIDE).alias("above")
    gathered = nodes.groupBy("tree", group, "height").agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("run"))
    return gathered.select("tree", "above", "height", F.least("height", F.lit(STRIDE)).alias("up"), F.col("run.digest").alias("run"))


def _up(run: Column) -> Column:
    """The level above a run of digests."""
    starts = F.sequence(F.lit(1), F.size(run), F.lit(FANOUT))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(run, i, FANOUT), "").cast("binary"), 256))


def grow(leaves: DataFrame, purpose: str) -> Tree:
    """Trees over ``leaves`` (tree, pos, digest; pos from 0 without gaps in each tree).

    A subtree's at most 256 digests are joined in one row; levels between the
    written ones are never stored. The rounds grow with the logarithm of the
    largest tree; one number a round reaches the driver."""
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("n")).select("tree", _levels(F.col("n")).alias("height"))
    nodes = cut(leaves.join(sizes, "tree").select("tree", "pos", "digest", "height"), f"{purpose}-0")
    levels, roots = [nodes], nodes.where("height = 0").select("tree", F.col("digest").alias("root"))
    while True:
        tallest = nodes.agg(F.coalesce(F.max("height"), F.lit(0))).first()[0]
        if not tallest:
            return Tree(levels, roots)
        higher = _subtrees(nodes.where("height > 0"))
        digest = F.when(F.col("up") == 1, F.element_at(_up(F.col("run")), 1))
        for k in range(2, STRIDE + 1):
            run = F.col("run")
            for _ in range(k):
                run = _up(run)
            digest = digest.when(F.col("up") == k, F.element_at(run, 1))
        higher = higher.select("tree", F.col("above").alias("pos"), digest.alias("digest"), (F.col("height") - F.col("up")).alias("height"))
        nodes = cut(higher, f"{purpose}-{len(levels) * STRIDE}")
        levels.append(nodes)
        roots = roots.unionByName(nodes.where("height = 0").select("tree", F.col("digest").alias("root")))


_PATH = "array<struct<before: string, after: string>>"
_ARROW_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, a few turned to Python objects at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, 8):
            yield from batch.slice(i, 8).to_pylist()


def _extract(subtrees: DataFrame) -> DataFrame:
    """tree, above, up, run, path (of the subtree's root) -> tree, pos, path of each node of the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            rebuilt = interior(row["run"], row["up"])
            paths = [[{"before": b, "after": a} for b, a in siblings(rebuilt, i)] + row["path"] for i in range(len(row["run"]))]
            pos = [row["above"] * SUBTREE + i for i in range(len(paths))]
            yield to_batch(tree=[row["tree"]] * len(paths), pos=pos, path=pa.array(paths, _ARROW_PATH))

    return subtrees.mapInArrow(run, f"tree string, pos long, path {_PATH}")


def paths_below(tree: Tree, roots: DataFrame, to: int, purpose: str) -> DataFrame:
    """tree, pos, path for the nodes of written level ``to``, from the path of
    each tree's root (``roots``: tree, path), level by level from the top."""
    known = None
    for k in range(len(tree.levels) - 1, to - 1, -1):
        nodes = tree.levels[k]
        ends = nodes.where("height = 0").join(roots, "tree").select("tree", "pos", "path")
        if known is not None:
            inner = _subtrees(nodes.where("height > 0")).join(known.withColumnRenamed("pos", "above"), ["tree", "above"])
            ends = ends.unionByName(_extract(inner.select("tree", "above", "up", "run", "path")))
        known = cut(ends, f"{purpose}-paths-{k}")
    return known


@dataclass
class Manifest:
    """A dataset's manifest: ``rows`` (tree, pos, doc_id, source, digest, tampered),
    the sources' trees, and the tree over their roots."""

    rows: DataFrame
    sources: Tree
    top: Tree
    roots: DataFrame  # tree (of a source), pos among the sources, digest (its root)


def _tree_key(source: Column) -> Column:
    """Never null; ordered as the sources bytewise, null first."""
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source))


def build_manifest(docs: DataFrame, altered: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS) -> Manifest:
    """The manifest of ``docs``: ``fields`` are its id, its source and what else
    a leaf is made of. ``altered`` gives other values of fields, for a second
    digest of each row (``tampered``) to hold against the manifest.

    The leaves of a source are ordered by id (nulls first; equal ids by digest);
    equal rows are leaves of their own. Null fields count as such, a null source
    is a source, the first. An empty table has no trees. The order is found by a
    range sort over all rows, so a source of any size is many tasks."""
    values = [F.col(f"`{f}`") for f in fields]
    changed = [(altered or {}).get(f, v) for f, v in zip(fields, values, strict=True)]
    # nothing but digests leaves the tasks that read the texts
    digests = docs.select(
        values[0].alias("doc_id"), values[1].alias("source"), _tree_key(values[1]).alias("tree"),
        leaf_digest(values).alias("digest"), leaf_digest(changed).alias("tampered"),
    )
    digests = cut(digests, "leaf-digests")
    rows = cut(ranked(digests, "tree", ["doc_id", "digest"], "pos", "ordered-leaves"), "leaves")
    discard(digests)
    sources = grow(rows.select("tree", "pos", "digest"), "sources")
    roots = sources.roots.select(F.lit("").alias("all"), F.col("tree"), F.col("root").alias("digest"))
    roots = cut(ranked(roots, "all", ["tree"], "pos", "subroots"), "ordered-subroots")
    top = grow(roots.select(F.lit("").alias("tree"), "pos", "digest"), "top")
    return Manifest(rows, sources, top, roots)


def verify(manifest: Manifest) -> DataFrame:
    """One row per leaf: doc_id, source, leaf, subroot, root, proof_sha256 (of
    all its siblings, level by level), folded_root (from the row's second digest
    and the original siblings), verified (it equals root).

    The paths of the lowest written level's subtrees are joined to the subtrees,
    not to the rows: a row's siblings exist only while its digests are made."""
    prepare(manifest.rows.sparkSession)
    above = manifest.top.roots.select("tree", F.array().cast(_PATH).alias("path"))
    to_sources = paths_below(manifest.top, above, 0, "top").select("pos", "path")
    roots = manifest.roots.join(to_sources, "pos").select("tree", "path", F.col("digest").alias("subroot"))
    root = manifest.top.roots.select("root").first()  # one digest
    roots = cut(roots.select("*", F.lit(root["root"] if root else "").alias("root")), "source-paths")
    subtrees = _leaf_subtrees(manifest, roots)
    id_field, source_field = manifest.rows.schema["doc_id"], manifest.rows.schema["source"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            leaves, root = row["run"], row["root"]
            rebuilt = interior([r["digest"] for r in leaves], row["up"])
            tail = [(s["before"], s["after"]) for s in row["path"]]
            proof_tail = "".join(before + after for before, after in tail)
            proofs, folded = [], []
            upper: dict[str, str] = {}  # of a subtree's root, the root of all that it leads to
            for i, leaf in enumerate(leaves):
                own = siblings(rebuilt, i)
                proofs.append(join_digests([before + after for before, after in own] + [proof_tail]))
                node = fold(leaf["tampered"], own)
                if node not in upper:
                    upper[node] = fold(node, tail)
                folded.append(upper[node])
            yield to_batch(
                doc_id=pa.array([r["doc_id"] for r in leaves], id_type),
                source=pa.array([r["source"] for r in leaves], pa.string()),
                leaf=rebuilt[0],
                subroot=[row["subroot"]] * len(leaves),
                root=[root] * len(leaves),
                proof_sha256=proofs,
                folded_root=folded,
                verified=[f == root for f in folded],
            )

    id_type = to_arrow_type(id_field.dataType)
    return subtrees.mapInArrow(
        run,
        f"doc_id {id_field.dataType.simpleString()}, source {source_field.dataType.simpleString()}, leaf string, "
        "subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )


def _leaf_subtrees(manifest: Manifest, roots: DataFrame) -> DataFrame:
    """One row for each lowest subtree of a source: its rows in order, the path
    above it, and its source's root and the root of all."""
    heights = manifest.sources.levels[0].groupBy("tree").agg(F.max("height").alias("height"))
    group = F.shiftright("pos", 4 * STRIDE).alias("above")
    run = F.sort_array(F.collect_list(F.struct("pos", "doc_id", "source", "digest", "tampered"))).alias("run")
    gathered = manifest.rows.groupBy("tree", group).agg(run).join(heights, "tree")
    ends = roots.select("tree", "path", "subroot", "root")
    # a tree of one leaf has no subtree: its row meets the path of its root
    up = F.least("height", F.lit(STRIDE)).alias("up")
    if len(manifest.sources.levels) == 1:
        known = roots.select("tree", F.lit(0).cast("long").alias("above"), "path")
    else:
        lone = manifest.sources.levels[0].where("height = 0").join(roots, "tree").select("tree", F.col("pos").alias("above"), "path")
        higher = paths_below(manifest.sources, roots.select("tree", "path"), 1, "sources")
        known = lone.unionByName(higher.withColumnRenamed("pos", "above"))
    joined = gathered.join(known, ["tree", "above"]).join(ends.drop("path"), "tree")
    return joined.select(up, "run", "path", "subroot", "root")


def op13_merkle_manifest(docs: DataFrame) -> DataFrame:
    """The contract's rows. The rows whose id's crc32 is divisible by 5 are
    tampered with: their text's A-Z in lower case (a null id never is)."""
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    lowered = F.when(chosen, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    found = verify(build_manifest(docs, {"text": lowered}))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sql_leaf(values: Sequence[str]) -> str:
    texts = [f"CAST({v} AS VARCHAR)" for v in values]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


#: crc32 in SQL is a helper of its own: the polynomial's table and a fold over the id's digits.
_SQL_CRC = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([CAST(i AS BIGINT)] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
crcs AS (
  SELECT d.doc_id, xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(d.doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
         lambda c, b: xor(t.t[(xor(c, b) & 255) + 1], c >> 8))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) d, crc_table t)"""

_SQL_UP = "SELECT tree, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16 FROM {t} WHERE n > 1 GROUP BY tree, level, pos // 16"

#: The same rows in DuckDB SQL: all levels of both kinds of trees by recursion, then the siblings of each leaf's way.
ORACLE_SQL = f"""
WITH RECURSIVE {_SQL_CRC},
rows AS (
  SELECT row_number() OVER () AS id, d.*, coalesce('1' || d.source, '0') AS tree,
         CASE WHEN c.crc % 5 = 0 THEN translate(d.text, '{_UPPER}', '{_LOWER}') ELSE d.text END AS changed
  FROM documents d LEFT JOIN crcs c ON c.doc_id = d.doc_id),
leaves AS (SELECT id, doc_id, tree, {_sql_leaf(FIELDS)} AS leaf, {_sql_leaf((*FIELDS[:-1], "changed"))} AS tampered FROM rows),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes(tree, level, pos, digest, n) AS (
  SELECT tree, 0, pos, leaf, n FROM placed UNION ALL {_SQL_UP.format(t="nodes")}),
subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS nth, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(tree, level, pos, digest, n) AS (
  SELECT 'top', 0, nth, digest, n FROM subroots UNION ALL {_SQL_UP.format(t="tops")}),
runs AS (
  SELECT tree, level, pos // 16 AS run, list(digest ORDER BY pos) AS ds FROM (SELECT * FROM nodes UNION ALL SELECT * FROM tops)
  WHERE n > 1 GROUP BY ALL),
ways AS (
  SELECT p.id, r.level, r.ds, CAST((p.pos >> (4 * r.level)) % 16 AS INTEGER) AS i
  FROM placed p JOIN runs r ON r.tree = p.tree AND r.run = p.pos >> (4 * (r.level + 1))
  UNION ALL
  SELECT p.id, 1000 + r.level, r.ds, CAST((s.nth >> (4 * r.level)) % 16 AS INTEGER)
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN runs r ON r.tree = 'top' AND r.run = s.nth >> (4 * (r.level + 1))),
steps AS (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY level) AS step,
         array_to_string(ds[1:i], '') AS before, array_to_string(ds[i + 2:], '') AS after
  FROM ways),
folded(id, step, digest) AS (
  SELECT id, 0, tampered FROM placed
  UNION ALL
  SELECT f.id, s.step, sha256(s.before || f.digest || s.after) FROM folded f JOIN steps s ON s.id = f.id AND s.step = f.step + 1),
ends AS (SELECT id, arg_max(digest, step) AS folded_root FROM folded GROUP BY id),
proofs AS (SELECT id, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY id),
root AS (SELECT digest AS root FROM tops WHERE n = 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.root, sha256(coalesce(q.proof, '')) AS proof_sha256, e.folded_root, e.folded_root = r.root AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN ends e ON e.id = p.id LEFT JOIN proofs q ON q.id = p.id, root r
"""
