"""A Merkle tree over a dataset, a proof for every row, and a version of the tree for every tampered one.

Rows are ranked within their part by a range sort whose partitions are counted, so that no part is one
task's. A tree is cut into aligned blocks of 1024 nodes: one task makes a block's lower levels, the
blocks' roots are the nodes of the next cut, and so on until one node remains. The way from a block's
root up to the top is worked out once a block, from the top down.

The tree is never changed. A tampered leaf makes a version: new nodes on the way from the leaf to its
block's root, then on the way further up; everything beside that way is read from the shared tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.storage import stored

BITS = 10  # a block has 2^BITS nodes

# one step of the way up: no sibling, or the sibling on the left or right
_ALONE, _LEFT, _RIGHT = "=", "<", ">"


def node(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


class Block:
    """The nodes of an aligned block, level by level. Versions share them and add their own."""

    def __init__(self, nodes: list[str], height: int):
        self.levels = [nodes]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([node(*below[i : i + 2]) for i in range(0, len(below), 2)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def way(self, at: int) -> list[str]:
        """The siblings from a leaf up to the block's root."""
        steps = []
        for level in self.levels[:-1]:
            beside = at ^ 1
            steps.append((_LEFT if at & 1 else _RIGHT) + level[beside] if beside < len(level) else _ALONE)
            at >>= 1
        return steps


def copied(leaf: str, way: list[str]) -> list[str]:
    """The nodes that a version with this leaf has for its own: the leaf and all above it."""
    path = [leaf]
    for step in way:
        side, beside = step[0], step[1:]
        path.append(node(beside, path[-1]) if side == _LEFT else node(path[-1], beside))
    return path


def height(size: int, bits: int = BITS) -> int:
    """Levels that a block of a tree of `size` nodes adds: all of its own, or up to the only node."""
    return bits if size > 1 << bits else max(0, (size - 1).bit_length())


def ranked(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """`rows` with `pos`, the rank within `tree` from 0 on, and `size`, the number of the tree's rows.

    One range sort of all trees together. Each sorted partition is counted; what the counts before it sum
    up to is where it starts. The counts are a row a partition and tree that meet, so they are broadcast.
    """
    ordered = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    placed = stored(ordered.withColumn("_at", F.monotonically_increasing_id()), name)
    run = F.shiftright("_at", 33)
    runs = placed.groupBy(F.col(tree).alias("_tree"), run.alias("_run")).agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first")
    )
    whole = Window.partitionBy("_tree")
    before = whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_tree",
        "_run",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("size"),
    )
    met = placed.join(F.broadcast(runs), (F.col(tree) == F.col("_tree")) & (run == F.col("_run")))
    return met.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_tree", "_run", "_shift")


def _blocks(nodes: DataFrame, bits: int, members: list[str], name: str) -> DataFrame:
    """tree, size, block and its members in order, at most 2^bits."""
    grouped = nodes.groupBy("tree", "size", F.shiftright("pos", bits).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", *members))).alias("members")
    )
    return stored(grouped, name)


def _roots(blocks: DataFrame, bits: int) -> DataFrame:
    """tree, size, pos, node: the blocks' roots as nodes of the next cut."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = batch["size"].to_pylist(), batch["nodes"].to_pylist()
            roots = [Block(n, height(s, bits)).root for s, n in zip(sizes, nodes, strict=True)]
            after = [-(-s >> bits) if s > 1 << bits else 1 for s in sizes]
            yield pa.RecordBatch.from_arrays(
                [batch["tree"], pa.array(after, pa.int64()), batch["block"], pa.array(roots, pa.string())],
                names=["tree", "size", "pos", "node"],
            )

    nodes = F.transform("members", lambda m: m["node"]).alias("nodes")
    return blocks.select("tree", "size", "block", nodes).mapInArrow(
        work, "tree string, size long, pos long, node string"
    )


def _cuts(nodes: DataFrame, bits: int, members: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every cut from the leaves up, and the one node of each tree that remains."""
    cuts = []
    while True:
        cuts.append(_blocks(nodes, bits, members, "merkle-blocks"))
        nodes, members = stored(_roots(cuts[-1], bits), "merkle-nodes"), ["node"]
        if nodes.filter("size > 1").isEmpty():
            return cuts, nodes


def _ways(blocks: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """tree, block, way: from each member of the blocks to the top, the member being a block below."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block([m["node"] for m in row["members"]], height(row["size"], bits))
                ways = [block.way(k) + row["way"] for k in range(len(row["members"]))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(ways), pa.string()),
                        pa.array([m["pos"] for m in row["members"]], pa.int64()),
                        pa.array(ways, pa.list_(pa.string())),
                    ],
                    names=["tree", "block", "way"],
                )

    met = blocks.join(above, ["tree", "block"])
    return met.select("tree", "size", "members", "way").mapInArrow(work, "tree string, block long, way array<string>")


def _top_down(cuts: list[DataFrame], above: DataFrame, bits: int) -> DataFrame:
    """tree, block, way of the lowest blocks; `above` has those of the highest."""
    for blocks in reversed(cuts[1:]):
        above = stored(_ways(blocks, above, bits), "merkle-ways")
    return above


def _digest(values: list[Column]) -> Column:
    """H of a row's values: `-` for null, else bytes, `:`, value."""
    text = [v.cast("string") for v in values]
    each = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.sha2(F.concat(*each), 256)


PROOFS = """doc_id long, lang string, position long, leaf string, subroot string, root string,
    proof string, siblings int, top string, version array<string>"""


def prove(
    docs: DataFrame,
    tampered: Column | None = None,
    changes: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    part_col: str = "lang",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    bits: int = BITS,
) -> DataFrame:
    """The tree over `docs`, with the columns of PROOFS for every row.

    A leaf is the digest of `columns`; leaves ascend by id within a part, parts by name, null first in
    both. proof is the siblings' digests from the leaf to the root, left to right, as one text. Where
    `tampered` is true the row's version has the values of `changes`: version is its own nodes from the
    leaf up (null elsewhere), top the last of them; for other rows top is refolded from the leaf. Rows
    alike in all columns are leaves of their own. No rows, no result. Other columns are ignored.
    """
    values = [F.col(c) for c in columns]
    changed = [(changes or {}).get(c, F.col(c)) for c in columns]
    hit = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    leaves = docs.select(
        # a prefix puts null before every name, also the empty one
        F.coalesce(F.concat(F.lit("="), F.col(part_col)), F.lit("-")).alias("tree"),
        F.col(id_col).cast("long").alias("doc_id"),
        _digest(values).alias("node"),
        F.when(hit, _digest(changed)).alias("other"),
    )
    leaves = ranked(stored(leaves, "merkle-leaves"), "tree", ["doc_id", "node", "other"], "merkle-order")
    cuts, subroots = _cuts(leaves, bits, ["doc_id", "node", "other"])

    parts = subroots.select(F.lit("").alias("all"), F.col("tree").alias("part"), "node")
    parts = ranked(parts, "all", ["part"], "merkle-parts").withColumnRenamed("all", "tree")
    upper, root = _cuts(parts, bits, ["part", "node"])
    start = root.select("tree", F.col("pos").alias("block"), F.array().cast("array<string>").alias("way"))
    tops = _ways_of_parts(upper[0], _top_down(upper, start, bits), bits)
    tops = tops.join(F.broadcast(root.select(F.col("tree").alias("all"), F.col("node").alias("root"))), "all")  # one row
    tops = tops.drop("all").join(subroots.select("tree", F.col("node").alias("subroot")), "tree")
    tops = stored(tops, "merkle-tops")

    start = tops.select("tree", F.lit(0).cast("long").alias("block"), "way")
    above = _top_down(cuts, start, bits)
    met = cuts[0].join(above, ["tree", "block"]).join(tops.drop("way"), "tree")
    return met.select("tree", "size", "members", "way", "subroot", "root").mapInArrow(_proofs(bits), PROOFS)


def _ways_of_parts(blocks: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """all (the tree of the parts), tree, way: from the subroot of each part to the top."""
    ways = _ways(blocks, above, bits).select(F.col("tree").alias("all"), F.col("block").alias("pos"), "way")
    names = blocks.select(F.col("tree").alias("all"), F.explode("members").alias("m"))
    names = names.select("all", "m.pos", F.col("m.part").alias("tree"))
    return names.join(ways, ["all", "pos"]).select("all", "tree", "way")


def _proofs(bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in PROOFS.replace("\n", " ").split(",")]
        for batch in batches:
            for k in range(batch.num_rows):  # a block at a time
                row = batch.slice(k, 1).to_pylist()[0]
                members = row["members"]
                block = Block([m["node"] for m in members], height(row["size"], bits))
                lang = None if row["tree"] == "-" else row["tree"][1:]
                out = []
                for at, m in enumerate(members):
                    way = block.way(at) + row["way"]
                    path = copied(m["other"] or m["node"], way)
                    beside = [step[1:] for step in way if step != _ALONE]
                    out.append(
                        (m["doc_id"], lang, m["pos"], m["node"], row["subroot"], row["root"], "".join(beside),
                         len(beside), path[-1], path if m["other"] else None)
                    )
                kinds = [pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.int32(), pa.string(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names
                )

    return work


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every document.

    Where 7 divides the crc32 of the id, tampering adds 1 to n_chars; a null there stays, and so verifies.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    found = prove(docs, hit, {"n_chars": more})
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        F.col("top").alias("folded_root"),
        (F.col("top") == F.col("root")).alias("verified"),
    )


MANIFEST_SQL = """
WITH RECURSIVE named AS (
  SELECT doc_id, lang, n_chars,
         concat(coalesce(concat(strlen(doc_id::varchar), ':', doc_id::varchar), '-'),
                coalesce(concat(strlen(source), ':', source), '-'), coalesce(concat(strlen(lang), ':', lang), '-')) AS before,
         coalesce(concat(strlen(text), ':', text), '-') AS after FROM documents),
leaves AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
         sha256(concat(before, coalesce(concat(strlen(n_chars::varchar), ':', n_chars::varchar), '-'), after)) AS leaf,
         sha256(concat(before, coalesce(concat(strlen((n_chars + 1)::varchar), ':', (n_chars + 1)::varchar), '-'), after)) AS other,
         (xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, strlen(doc_id::varchar) + 1),
            lambda i: ascii(substr(doc_id::varchar, i::int, 1))::ubigint)),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384::ubigint * (x & 1)))),
          4294967295::ubigint)) % 7 = 0 AS hit FROM named),
tree AS (
  SELECT lang, 0 AS lv, list(leaf ORDER BY pos) AS nodes FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, lv + 1, list_transform(range(0, (len(nodes) + 1) // 2),
         lambda i: sha256(concat(nodes[2 * i + 1], coalesce(nodes[2 * i + 2], '')))) FROM tree WHERE len(nodes) > 1),
subroots AS (
  SELECT lang, lv AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
  FROM tree WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS lv, list(subroot ORDER BY pos) AS nodes FROM subroots
  UNION ALL
  SELECT lv + 1, list_transform(range(0, (len(nodes) + 1) // 2),
         lambda i: sha256(concat(nodes[2 * i + 1], coalesce(nodes[2 * i + 2], '')))) FROM top WHERE len(nodes) > 1),
steps AS (
  SELECT l.doc_id, t.lv, (l.pos >> t.lv) & 1 AS odd, t.nodes[xor(l.pos >> t.lv, 1) + 1] AS beside
  FROM leaves l JOIN tree t ON l.lang IS NOT DISTINCT FROM t.lang WHERE len(t.nodes) > 1
  UNION ALL
  SELECT l.doc_id, s.height + t.lv, (s.pos >> t.lv) & 1, t.nodes[xor(s.pos >> t.lv, 1) + 1]
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, top t WHERE len(t.nodes) > 1),
fold AS (
  SELECT doc_id, 0 AS lv, CASE WHEN hit THEN other ELSE leaf END AS cur, '' AS proof FROM leaves
  UNION ALL
  SELECT f.doc_id, f.lv + 1, sha256(CASE WHEN s.odd = 1 THEN concat(s.beside, f.cur) ELSE concat(f.cur, coalesce(s.beside, '')) END),
         concat(f.proof, coalesce(s.beside, '')) FROM fold f JOIN steps s ON f.doc_id = s.doc_id AND f.lv = s.lv),
folded AS (SELECT doc_id, arg_max(cur, lv) AS folded_root, arg_max(proof, lv) AS proof FROM fold GROUP BY doc_id)
SELECT l.doc_id, l.leaf, s.subroot, r.nodes[1] AS root, sha256(f.proof) AS proof_sha256, f.folded_root,
       f.folded_root = r.nodes[1] AS verified
FROM leaves l JOIN folded f USING (doc_id) JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, top r
WHERE len(r.nodes) = 1
"""
