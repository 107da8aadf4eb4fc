"""Merkle manifest of a dataset: a persistent tree whose versions share their nodes.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a source, in the order of
their ids, are a tree in which each run of RUN nodes has one parent; the roots of the
sources, in the order of the sources, are the leaves of the dataset's own tree.  Digests go
into their parent's as lowercase hex text, one after the other.

A changed leaf makes a version of the tree by path copying: only the leaf's ancestors are
new, every other node is the one of the tree before.  Trees are cut into aligned blocks of
RUN ** LEVELS leaves: a block is one row with its leaves packed, so a source of any size is
spread over many tasks.  Tops of blocks are the leaves of the level of blocks above, and so
on; this upper tree is built once, and what comes back to a block is its own path: the
siblings of its ancestors.  A version copies the ancestors within its block and then goes on
along that path, wherever the block lies, so no task sees the versions of two blocks.

Leaves of equal id are in the order of their digests, null ids come first.  A null source is
a source of its own and comes first.  Null fields count as ``-``, so they differ from empty
ones.  An empty table has no leaves and no root.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import lookup, stage
from ledgerline.sources.tables import Tables

RUN = 3  # nodes that share a parent
LEVELS = 7  # of a block; one row holds RUN ** LEVELS leaves at most
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROWS = 256


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each as its UTF-8 byte count, a colon and the value."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*map(framed, fields)), 256))


def parent(children: Sequence[bytes]) -> bytes:
    return sha256(b"".join(children).hex().encode()).digest()


class Block:
    """One version of an aligned block; ``levels[0]`` are its leaves.  A tree of one block
    ends where one node remains, other blocks have ``whole`` levels whatever they hold."""

    def __init__(self, leaves: list[bytes], whole: int | None):
        self.levels = [leaves]
        while len(self.levels) <= whole if whole is not None else len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([parent(below[i : i + RUN]) for i in range(0, len(below), RUN)])

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def path(self, leaf: int) -> list[tuple[int, list[bytes]]]:
        """From the leaf up: its place in the run, and the others of the run."""
        out = []
        for nodes in self.levels[:-1]:
            first = leaf - leaf % RUN
            run = nodes[first : first + RUN]
            out.append((leaf - first, run[: leaf - first] + run[leaf - first + 1 :]))
            leaf //= RUN
        return out


def copied(digest: bytes, path: list[tuple[int, list[bytes]]]) -> list[bytes]:
    """The nodes that a version with this leaf has of its own: the leaf's ancestors."""
    out = []
    for at, others in path:
        digest = parent([*others[:at], digest, *others[at:]])
        out.append(digest)
    return out


def pack_path(path: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes([at, len(others)]) + b"".join(others) for at, others in path)


def unpack_path(data: bytes) -> list[tuple[int, list[bytes]]]:
    out, i = [], 0
    while i < len(data):
        at, n = data[i], data[i + 1]
        i += 2
        out.append((at, [data[i + 32 * k : i + 32 * k + 32] for k in range(n)]))
        i += 32 * n
    return out


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with pos, their number in ``order`` within their tree, and n, the tree's rows.

    The rows are range-partitioned and sorted; a (tree, partition) holds consecutive rows,
    and prefix sums of the counts of these, one row a partition at most, give the numbers.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(
        rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
        .select("*", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("at")),
        "merkle-sorted",
    )
    counts = dealt.groupBy(tree, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    every = Window.partitionBy(tree)
    before = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        tree, "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(every).alias("n"),
    )
    return dealt.join(counts, [tree, "part"]).select(*rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "n")


def pack(nodes: DataFrame, payload: Sequence[str], levels: int) -> DataFrame:
    """One row per aligned block: tree, n, block and its nodes in order."""
    block = F.floor(F.col("pos") / F.lit(RUN**levels)).alias("block")
    return stage(
        nodes.groupBy("tree", "n", block).agg(F.array_sort(F.collect_list(F.struct("pos", *payload))).alias("nodes")),
        "merkle-blocks",
    )


def _blocks(batches: Iterator[pa.RecordBatch], leaf: str, levels: int) -> Iterator[tuple[dict, pa.StructArray, Block]]:
    """Each packed row: its other columns, its nodes, and the block they make."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch[name][i].as_py() for name in batch.schema.names if name != "nodes"}
            nodes = batch["nodes"][i].values
            leaves = nodes.field(leaf).to_pylist()
            yield row, nodes, Block(leaves, levels if row["n"] > RUN**levels else None)


def paths_above(packed: DataFrame, leaf: str, levels: int) -> DataFrame:
    """Of each block of each tree (tree, block): the packed path from its top to the root of
    the tree, and that root.  One round for each factor of RUN ** levels in the largest tree."""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, block in _blocks(batches, leaf, levels):
            n = -(-row["n"] // RUN**levels)
            yield pa.RecordBatch.from_pylist([{"tree": row["tree"], "pos": row["block"], "n": n, "digest": block.top}])

    tops_of = stage(packed.mapInArrow(tops, "tree string, pos long, n long, digest binary"), "merkle-tops")
    block = F.col("pos").alias("block")
    done = tops_of.filter("n = 1").select("tree", block, F.lit(b"").alias("path"), F.col("digest").alias("root"))
    rest = tops_of.filter("n > 1")
    if rest.isEmpty():
        return done
    upper = pack(rest, ["digest"], levels)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, nodes, built in _blocks(batches, "digest", levels):
            at = nodes.field("pos").to_pylist()
            yield pa.RecordBatch.from_pylist([
                {"tree": row["tree"], "block": p, "path": pack_path(built.path(i)) + row["path"], "root": row["root"]}
                for i, p in enumerate(at)
            ])

    paths = upper.join(paths_above(upper, "digest", levels), ["tree", "block"]).mapInArrow(extend, "tree string, block long, path binary, root binary")
    return done.unionByName(stage(paths, "merkle-paths"))


def manifest(
    docs: DataFrame, change: Column | None = None, fields: Sequence[str] = FIELDS, id_col="doc_id", group_col="source",
    text_col="text", levels: int = LEVELS,
) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot (of its source), root, proof (the siblings on
    its way to the root, 32 bytes each), copied (the nodes, lowest first, that the version
    with the leaf's ``text_col`` changed to ``change`` has of its own) and folded, the root
    of that version.  Where ``change`` leaves the text as it is, or there is none, the
    copied nodes are those of the tree itself.  Digests are binary.
    """
    source = F.col(group_col).cast("string")
    changed = F.col(text_col) if change is None else change
    leaves = docs.select(
        # the order of these keys is: null first, then the bytes of the source
        F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source)).alias("tree"),
        F.col(id_col).cast("long").alias("doc_id"), leaf_digest([F.col(c) for c in fields]).alias("leaf"),
        leaf_digest([changed if c == text_col else F.col(c) for c in fields]).alias("changed"),
    )
    packed = pack(numbered(stage(leaves, "merkle-leaves"), "tree", ["doc_id", "leaf"]), ["doc_id", "leaf", "changed"], levels)
    above = paths_above(packed, "leaf", levels)
    # the roots of the sources are the leaves of one more tree
    subroots = stage(above.filter("block = 0").select(F.col("tree").alias("name"), F.lit("").alias("tree"), F.col("root").alias("digest")), "merkle-subroots")
    sources = pack(numbered(subroots, "tree", ["name"]), ["name", "digest"], levels)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, nodes, built in _blocks(batches, "digest", levels):
            names = nodes.field("name").to_pylist()
            yield pa.RecordBatch.from_pylist([
                {"tree": name, "over": pack_path(built.path(i)) + row["path"], "top": row["root"]} for i, name in enumerate(names)
            ])

    over = sources.join(paths_above(sources, "digest", levels), ["tree", "block"]).mapInArrow(extend, "tree string, over binary, top binary")
    blocks = above.groupBy("tree").agg(F.count(F.lit(1)).alias("blocks"))
    above = lookup(stage(above, "merkle-above"), stage(over.join(blocks, "tree"), "merkle-sources"), "tree", "blocks")

    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.binary()) for c in ("leaf", "subroot", "root", "proof", "copied", "folded"))])

    def versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, nodes, built in _blocks(batches, "leaf", levels):
            ids, leaves, changes = (nodes.field(c).to_pylist() for c in ("doc_id", "leaf", "changed"))
            higher = unpack_path(row["path"]) + unpack_path(row["over"])
            for lo in range(0, len(ids), ROWS):
                out = []
                for i in range(lo, min(lo + ROWS, len(ids))):
                    path = built.path(i) + higher
                    new = copied(changes[i], path)
                    proof = b"".join(x for _, others in path for x in others)
                    out.append((ids[i], leaves[i], row["root"], row["top"], proof, b"".join(new), new[-1] if new else changes[i]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    columns = ["tree", "block", "n", "nodes", "path", "root", "over", "top"]
    return packed.join(above, ["tree", "block"]).select(columns).mapInArrow(
        versions, "doc_id long, " + ", ".join(f"{c} binary" for c in schema.names[1:])
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir)["documents"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    change = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    hexed = lambda c: F.lower(F.hex(c))
    return manifest(docs, change).select(
        "doc_id", *(hexed(c).alias(c) for c in ("leaf", "subroot", "root")),
        F.sha2(hexed("proof"), 256).alias("proof_sha256"), hexed("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS[:-1]) + " || {})"
OP11_SQL = rf"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('1' || source, '0') AS src, {_LEAF.format(_FIELD.format("text"))} AS leaf,
         {_LEAF.format(_FIELD.format("replace(text, chr(10), '')"))} AS other,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
             lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, src, leaf, CASE WHEN crc % 2 = 0 THEN other ELSE leaf END AS changed,
         row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY src) AS n
  FROM rows
), tree AS (
  SELECT src, 0 AS level, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT src, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
  FROM tree WHERE n > 1 GROUP BY src, level, pos // 3, n
), tops AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY src) - 1 AS pos, src, digest, count(*) OVER () AS n FROM tree WHERE n = 1
), over_tree AS (
  SELECT level, pos, digest, n FROM tops
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
  FROM over_tree WHERE n > 1 GROUP BY level, pos // 3, n
), fold AS (
  SELECT src, pos AS leaf_pos, 0 AS level, pos, changed AS cur, '' AS proof, n FROM leaves
  UNION ALL
  SELECT f.src, f.leaf_pos, f.level + 1, f.pos // 3,
         sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.cur ELSE t.digest END, '' ORDER BY t.pos)),
         f.proof || coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos <> f.pos), ''), (f.n + 2) // 3
  FROM fold f JOIN tree t ON t.src = f.src AND t.level = f.level AND t.pos // 3 = f.pos // 3
  WHERE f.n > 1 GROUP BY f.src, f.leaf_pos, f.level, f.pos, f.cur, f.proof, f.n
), over_fold AS (
  SELECT f.src, f.leaf_pos, 0 AS level, s.pos, f.cur, f.proof, s.n FROM fold f JOIN tops s ON s.src = f.src WHERE f.n = 1
  UNION ALL
  SELECT f.src, f.leaf_pos, f.level + 1, f.pos // 3,
         sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.cur ELSE t.digest END, '' ORDER BY t.pos)),
         f.proof || coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos <> f.pos), ''), (f.n + 2) // 3
  FROM over_fold f JOIN over_tree t ON t.level = f.level AND t.pos // 3 = f.pos // 3
  WHERE f.n > 1 GROUP BY f.src, f.leaf_pos, f.level, f.pos, f.cur, f.proof, f.n
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root,
       f.cur = r.digest AS verified
FROM leaves l JOIN tops s ON s.src = l.src JOIN over_fold f ON f.src = l.src AND f.leaf_pos = l.pos AND f.n = 1
CROSS JOIN (SELECT digest FROM over_tree WHERE n = 1) r
"""
