"""A Merkle manifest of a dataset: one tree per partition value, and a tree over the roots of these.

A node is the SHA-256 of its children's hex digests, two at a time; the last node of a level may have one child.
Only every eighth level is stored (a stratum). Proofs go from the top down: for each aligned subtree
of 256 nodes of a stratum the levels between are made again from the stored nodes, siblings are handed
out, and the levels are dropped. A tree of any size is many such subtrees, so none of them is a
group of unbounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from changetide.llm.common import map_arrow, stored
from changetide.llm.order import batches_of, placed, runs, side_by_side
from changetide.session import drop_scratch

#: Levels from one stored stratum to the next, and nodes of an aligned subtree.
LEVELS = 8
SPAN = 1 << LEVELS
#: First byte of a proof step: a node without sibling, a sibling to the right, one to the left.
LONE, RIGHT, LEFT = b"\0", b"\1", b"\2"


def parent(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def interior(nodes: list[bytes], whole: bool) -> list[list[bytes]]:
    """Levels of a subtree, from the stored nodes up: to a single node of a whole tree, else the next stratum."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([parent(below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def steps(level: list[bytes]) -> list[bytes]:
    """The proof step of each node of a level."""
    if len(level) % 2:
        return [*steps(level[:-1]), LONE] if len(level) > 1 else [LONE]
    return [LEFT + level[i - 1] if i % 2 else RIGHT + level[i + 1] for i in range(len(level))]


def _subtree(place: str = "place") -> Column:
    return F.floor(F.col(place) / SPAN)


def strata(nodes: DataFrame) -> tuple[list[DataFrame], list[str]]:
    """Stored strata of trees, and their folders: tree, place, size (nodes of the tree there), node.

    The first is `nodes`, which may have more columns; the last has the root of each tree.
    """
    first, folder = stored(nodes, "stratum")
    found, folders = [first], [folder]
    largest = first.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        below = found[-1].select("tree", "place", "size", "node", _subtree().alias("subtree"))
        schema = "tree string, place bigint, size bigint, node binary"

        def up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("size", pa.int64()), ("node", pa.binary())])

            def tops():
                for run in runs(batches, ["tree", "subtree"]):
                    size = run["size"][0]
                    top = interior(run["node"], size <= SPAN)[-1]
                    yield {"tree": run["tree"][:1], "place": run["subtree"][:1], "size": [-(-size // SPAN)], "node": top}

            return batches_of(tops(), kinds)

        above, folder = stored(map_arrow(side_by_side(below, ["tree", "subtree"], ["place"]), up, schema), "stratum")
        found.append(above)
        folders.append(folder)
        largest = -(-largest // SPAN)
    return found, folders


def proofs(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first stratum with `proof` (steps from a node to the root) and `top`, the node of its tree's root.

    `above` has the steps from each tree's root on: tree, proof. A step is a byte that tells the
    side, followed by the sibling's digest if there is one.
    """
    roots = levels[-1].alias("r").join(above.alias("a"), F.col("r.tree") == F.col("a.tree"))
    paths = roots.select("r.tree", "r.place", F.col("a.proof").alias("proof"), F.col("r.node").alias("top"))
    if len(levels) == 1:
        same = (F.col("n.tree") == F.col("p.tree")) & (F.col("n.place") == F.col("p.place"))
        return levels[0].alias("n").join(paths.alias("p"), same).select("n.*", "p.proof", "p.top")
    for stratum in reversed(levels[:-1]):
        paths = _down(stratum, paths)
    return paths


def _down(stratum: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes of a stratum with their proofs, from those of the stratum above, which lie first in each subtree."""
    below = stratum.withColumn("subtree", _subtree())
    lead = paths.select("tree", F.col("place").alias("subtree"), F.lit(-1).cast("long").alias("place"), "proof", "top")
    both = below.unionByName(lead, allowMissingColumns=True)
    result = stratum.select("*", F.lit(None).cast("array<binary>").alias("proof"), F.lit(None).cast("binary").alias("top"))
    kinds = to_arrow_schema(result.schema)

    def down(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes():
            for run in runs(batches, ["tree", "subtree"]):
                upper, top = run["proof"][0], run["top"][0]
                run = {n: v[1:] for n, v in run.items()}
                made = [steps(level) for level in interior(run["node"], run["size"][0] <= SPAN)[:-1]]
                run["proof"] = [[level[i >> k] for k, level in enumerate(made)] + upper for i in range(len(run["node"]))]
                run["top"] = [top] * len(run["node"])
                yield run

        return batches_of(nodes(), kinds, 2048)

    return map_arrow(side_by_side(both, ["tree", "subtree"], ["place"]), down, result.schema.simpleString()[7:-1])


def fold(leaf: Column, proof: Column) -> Column:
    """The root (hex) that a leaf (hex) and its proof lead to."""

    def up(below: Column, step: Column) -> Column:
        sibling = F.lower(F.hex(F.substring(step, 2, 32)))
        side = F.substring(step, 1, 1)
        both = F.when(side == LEFT, F.concat(sibling, below)).when(side == RIGHT, F.concat(below, sibling)).otherwise(below)
        return F.sha2(both, 256)

    return F.aggregate(proof, leaf, up)


def siblings_digest(proof: Column) -> Column:
    """Hash of the siblings of a proof, in order."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.lower(F.hex(F.substring(s, 2, 32)))), ""), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(*columns: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def prove_rows(leaves: DataFrame) -> DataFrame:
    """Rows with a Merkle proof each, from rows with `part` (partition value), `id` (their order) and `leaf` (hex).

    Adds `subroot` and `root` (hex) and `proof`. A null part is a partition of its own and comes first; null ids
    come first; rows of the same id are ordered by their leaves, equal rows are leaves each.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("part").cast("string")), F.lit(""))
    named = leaves.select("*", tree.alias("tree"), F.unhex("leaf").alias("node"))
    nodes, ordered = placed(named, ["tree"], ["id", "node"], "leaves")
    forest, folders = strata(nodes)
    roots, ordered_roots = placed(forest[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node"), ["tree"], ["name"], "roots")
    crown, crown_folders = strata(roots)
    start = F.array().cast("array<binary>").alias("proof")
    above = proofs(crown, crown[-1].select("tree", start))
    above, above_folder = stored(above.select(F.col("name").alias("tree"), "proof", F.col("top").alias("root")), "above")
    root = above.select("root").first()
    proved = proofs(forest, above)
    for folder in (ordered, ordered_roots, *crown_folders):
        drop_scratch(leaves.sparkSession, folder)
    hexed = lambda c: F.lower(F.hex(c))
    return proved.select(
        *leaves.columns,
        hexed(F.col("top")).alias("subroot"),
        hexed(F.lit(bytes(root[0]) if root else None).cast("binary")).alias("root"),
        "proof",
    )


def dataset_manifest(docs: DataFrame, id_column: str = "doc_id", part_column: str = "lang", size_column: str = "n_chars", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256, folded_root, verified. See `prove_rows`.

    A leaf is the hash of the named columns in order, a null told from an empty text. Rows whose
    id has a CRC-32 that 7 divides are tampered with by 1 more in the size column; their folded root is
    made from that. A null id or size is not tampered with. Copies have a leaf each; other columns are not
    read. An empty table gives no rows.
    """
    changed = F.coalesce(F.crc32(F.col(id_column).cast("string")) % 7 == 0, F.lit(False))
    tampered = [F.col(c) + 1 if c == size_column else F.col(c) for c in columns]
    leaves = docs.select(
        F.col(id_column).alias("id"),
        F.col(part_column).alias("part"),
        row_hash(*(F.col(c) for c in columns)).alias("leaf"),
        F.when(changed, row_hash(*tampered)).alias("tampered"),
    )
    proved = prove_rows(leaves).withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return proved.select(
        F.col("id").alias(id_column),
        "leaf",
        "subroot",
        "root",
        siblings_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
