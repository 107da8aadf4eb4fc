"""N-gram Jaccard self-join by T-occurrence search, and the groups that its links make.

Documents with equal shingle sets are one class; classes whose sets have a Jaccard
similarity of at least PERCENT / 100 are linked.  A set of n shingles needs an overlap of
at least T = ceil(0.8 n) with any partner, which prunes exactly, in four steps:

1. Every text gives its class and n.
2. Of each set the n - T + l smallest hashes are looked at (a prefix in the order of the
   hash).  Linked sets share at least min(l, l') of them, so a class with fewer shingles
   there that another class has, too, has no partner.  The postings are packed by bucket of
   the hash, and a task sends a hash that several of its own classes have only once.
3. Of the classes left, the frequency of every shingle is counted; shingles of one class
   are dropped, and classes with fewer than T left.  Linked classes then share one of their
   s - T + 1 rarest shingles (s that are left): classes connected by those are a block.
4. Blocks are searched: for a query, the lists of its shortest inverted lists are merged
   with a heap, the L longest are only probed (DivideSkip), and candidates that reach the
   required overlap are links.  Pairs that earlier links already connect are not compared,
   so a group of m near copies takes about m comparisons and gives m - 1 links.

Small blocks share tasks.  A large block is cut into chunks of a bounded number of
shingles: all chunks are first compared with the block's hub (a member with the least
shingles of its own), then only the members not linked to the hub are searched for, in
tasks of one chunk of queries and one chunk of members.  No task holds more than that.

Shingles are compared by 64-bit hashes of five words.

The operator gives components and no list of links: pairs that earlier links connect are not
compared, so of a group of m texts m - 1 links are found, a spanning tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import merge
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import lookup, releasing, small_batches, stage
from ledgerline.llm.components import connected
from ledgerline.llm.words import NOT_SPACE, mix, words_of
from ledgerline.sources.tables import Tables

SIZE = 5  # words of a shingle
PERCENT = 80
EXTRA = 0.1  # l, as a share of n
FLUSH = 1 << 19  # postings packed together
BUCKET_BYTES = 16 << 20  # text whose postings make up a bucket
CHUNK = 250_000  # shingles of a chunk, and of a task of small blocks
MU = 0.01  # of DivideSkip: how much cheaper a probe is than a step of the merge

_FACTOR = np.random.default_rng(7).integers(1, 1 << 63, SIZE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def required(n):
    """The least overlap that a set of n shingles needs with any partner."""
    return (PERCENT * n + 99) // 100


def is_link(overlap: int, n: int, m: int) -> bool:
    return 100 * overlap >= PERCENT * (n + m - overlap)


def extra(n: int) -> int:
    return max(1, int(EXTRA * n))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.  Fewer than SIZE words are one
    shingle, none is the empty set; null texts have no words."""
    for count, words in words_of(texts, NOT_SPACE):
        h = words.hashes
        runs = max(0, len(h) - SIZE + 1)
        whole = np.zeros(runs, np.uint64)
        for j in range(SIZE):
            whole += h[j : j + runs] * _FACTOR[j]
        whole = mix(whole)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if b - a >= SIZE:
                yield np.unique(whole[a : b - SIZE + 1])
            else:
                short = np.append(h[a:b] * _FACTOR[: b - a], np.full(b - a, _FACTOR[SIZE]))
                yield mix(short.sum(keepdims=True))[: b - a]


def class_of(found: np.ndarray) -> bytes:
    return hashlib.md5(found.tobytes()).digest()


def class_number(name: bytes) -> int:
    return int.from_bytes(name[:8], "little") | 1  # 0 stands for "several"


# ------------------------------------------------------------------ 1. documents, classes
def classes_of(docs: DataFrame) -> DataFrame:
    """doc_id, key (of id and text), n and class of each document; ``docs``: doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, names = [], []
            for found in shingle_sets(batch["text"]):
                n.append(len(found))
                names.append(class_of(found))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["key"], pa.array(n, pa.int64()), pa.array(names, pa.binary())],
                names=["doc_id", "key", "n", "class"],
            )

    return small_batches(docs).mapInArrow(releasing(run), "doc_id long, key long, n long, class binary")


# --------------------------------------------------------- 2. shingles that others have, too
def pack_postings(buckets: int):
    def flush(sets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate(list(sets.values()))
        owners = np.repeat(np.array(list(sets), np.uint64), [len(x) for x in sets.values()])
        order = np.argsort(hashes, kind="stable")
        hashes, owners = hashes[order], owners[order]
        begin = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        several = np.diff(np.append(begin, len(hashes))) > 1
        names, counts = np.unique(owners[np.repeat(several, np.diff(np.append(begin, len(hashes))))], return_counts=True)
        hashes, owners = hashes[begin], np.where(several, np.uint64(0), owners[begin])
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [
            {"bucket": b, "hashes": hashes[order[x:y]].tobytes(), "owners": owners[order[x:y]].tobytes(), "counts": None}
            for b, (x, y) in enumerate(zip(edges[:-1], edges[1:]))
            if y > x
        ]
        if len(names):  # shared within this task
            some = int(names[0] % np.uint64(buckets))
            rows.append({"bucket": some, "hashes": None, "owners": names.tobytes(), "counts": counts.astype(np.int64).tobytes()})
        fields = [("bucket", pa.int64()), ("hashes", pa.binary()), ("owners", pa.binary()), ("counts", pa.binary())]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for found in shingle_sets(batch["text"]):
                n = len(found)
                if not n or (name := class_number(class_of(found))) in held:
                    continue
                held[name] = found[: n - required(n) + extra(n)]
                size += len(held[name])
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = {}, 0
        if size:
            yield from flush(held)

    return run


def count_shared(table: pa.Table) -> pa.Table:
    """Of the postings of a bucket: each class and its shingles that another class has."""
    names, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for h, o, c in zip(*(table[x] for x in ("hashes", "owners", "counts"))):
        o = np.frombuffer(o.as_py(), np.uint64)
        if c.is_valid:
            names.append(o)
            counts.append(np.frombuffer(c.as_py(), np.int64))
        else:
            hashes.append(np.frombuffer(h.as_py(), np.uint64))
            owners.append(o)
    hashes, owners = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((owners, hashes))
    hashes, owners = hashes[order], owners[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1]))[: len(hashes)]
    hashes, owners = hashes[new], owners[new]
    begin = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
    length = np.diff(np.append(begin, len(hashes)))
    shared = owners[np.repeat(length > 1, length)]
    found, n = np.unique(shared[shared > 0], return_counts=True)
    names.append(found)
    counts.append(n)
    return pa.table({"number": np.concatenate(names).view(np.int64), "shared": np.concatenate(counts).astype(np.int64)})


def may_link(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """key, class and n of a document of each class that may have a partner; ``classes``:
    class, number, key, n."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * partitions, size // BUCKET_BYTES + 1)
    packed = small_batches(docs.select("text")).mapInArrow(releasing(pack_postings(buckets)), "bucket long, hashes binary, owners binary, counts binary")
    shared = packed.groupBy("bucket").applyInArrow(count_shared, "number long, shared long")
    # a partner has at least required(n) shingles, and an ``extra`` to that
    least = F.greatest(F.lit(1), F.floor(F.lit(EXTRA) * F.floor((PERCENT * F.col("n") + 99) / 100)))
    enough = shared.groupBy("number").agg(F.sum("shared").alias("shared"))
    return classes.join(enough, "number").filter(F.col("shared") >= least).select("key", "class", "n")


# -------------------------------------------------------------- 3. frequencies and blocks
def full_sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """class and the shingles of one document of each chosen class, as an array of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            sets = list(shingle_sets(batch["text"]))
            arrays = pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([class_of(x) for x in sets], pa.binary()), arrays], names=["class", "shingles"])

    # never a broadcast: the chosen keys grow with the documents
    texts = docs.join(chosen.select("key").hint("merge"), "key", "left_semi").select("text")
    return small_batches(texts).mapInArrow(releasing(run), "class binary, shingles array<long>").dropDuplicates(["class"])


def frequent_parts(sets: DataFrame) -> DataFrame:
    """Of the classes that still may have a partner: class, n, shared (the shingles that
    another class has, in order of the hash), rare (the rarest shared - T + 1 of them)."""
    each = stage(sets.select("class", F.explode("shingles").alias("shingle")), "shingles")
    counted = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    parts = lookup(each, stage(counted, "shingle-df"), "shingle", "df").groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("by_df")
    )
    n = F.size("shingles")
    needed = F.floor((PERCENT * n + 99) / 100)
    rare = F.slice("by_df", F.lit(1), (F.size("by_df") - needed + 1).cast("int"))
    return (
        parts.join(sets, "class").filter(F.size("by_df") >= needed)
        .select(
            "class", n.cast("long").alias("n"), F.array_sort(F.col("by_df.shingle")).alias("shared"),
            F.transform(rare, lambda x: x["shingle"]).alias("rare"),
        )
    )


def blocks_of(parts: DataFrame) -> DataFrame:
    """``parts`` without rare, with block: the label of the classes connected by rare ones."""
    members = parts.select(F.col("class").alias("item"), F.explode("rare").alias("group"))
    labels = connected(members).select(F.col("item").alias("class"), F.col("label").alias("block"))
    return parts.drop("rare").join(labels, "class")


# ------------------------------------------------------------------------- 4. the search
class Groups:
    """Which members are connected so far."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: int, b: int) -> None:
        self.root[self.root == self.root[a]] = self.root[b]


def search(table: pa.Table) -> pa.Table:
    """Links among the rows of a task: class, n, shared, query and member (its roles), core
    (whether it is already linked to the block's hub).  Only links between members not yet
    connected are returned."""
    names, sizes = table["class"].to_pylist(), table["n"].to_pylist()
    sets = [np.asarray(x.values) for x in table["shared"]]
    member, query = np.flatnonzero(table["member"]), np.flatnonzero(table["query"])
    elements = np.concatenate([np.empty(0, np.int64), *(sets[i] for i in member)])
    owners = np.repeat(member, [len(sets[i]) for i in member])
    order = np.argsort(elements, kind="stable")
    elements, owners = elements[order], owners[order]
    begin = np.flatnonzero(np.append(True, elements[1:] != elements[:-1])[: len(elements)])
    keys, ends = elements[begin], np.append(begin[1:], len(elements))
    groups = Groups(len(names))
    core = np.flatnonzero(table["core"])
    if len(core):
        groups.root[core] = core[0]
    links = []
    # those with the fewest shingles of their own come first: they link to the most others
    for x in sorted(query.tolist(), key=lambda i: (len(sets[i]) / sizes[i], i), reverse=True):
        at = np.searchsorted(keys, sets[x])
        at = np.minimum(at, max(0, len(keys) - 1))
        lists = at[keys[at] == sets[x]] if len(keys) else at[:0]
        need = required(sizes[x])
        if len(lists) < need:
            continue
        length = ends[lists] - begin[lists]
        long = min(need - 1, int(need / (MU * log2(int(length.max()) + 1) + 1)))
        lists = lists[np.argsort(length, kind="stable")]
        short, probed = lists[: len(lists) - long], lists[len(lists) - long :]
        apart = [o[groups.root[o] != groups.root[x]].tolist() for o in (owners[begin[k] : ends[k]] for k in short)]
        probes = np.sort(keys[probed])
        for y, run in groupby(merge(*(o for o in apart if o))):
            seen = sum(1 for _ in run)
            if seen < need - long or groups.root[x] == groups.root[y] or not required(sizes[y]) <= sizes[x] or not need <= sizes[y]:
                continue
            where = np.minimum(np.searchsorted(sets[y], probes), len(sets[y]) - 1)
            if is_link(seen + int((sets[y][where] == probes).sum()), sizes[x], sizes[y]):
                links.append({"a": names[x], "b": names[y]})
                groups.join(x, y)
    return pa.Table.from_pylist(links, pa.schema([("a", pa.binary()), ("b", pa.binary())]))


def compare_with_hub(table: pa.Table) -> pa.Table:
    """Links of the members of a chunk to the hub of their block, one of the rows."""
    hub = table.filter(table["hub"]).slice(0, 1).to_pylist()[0]
    own = np.array(hub["shared"])
    links = []
    for name, n, shared in zip(table["class"].to_pylist(), table["n"].to_pylist(), table["shared"]):
        overlap = len(np.intersect1d(own, np.asarray(shared.values), assume_unique=True))
        if name != hub["class"] and is_link(overlap, hub["n"], n):
            links.append({"a": hub["class"], "b": name})
    return pa.Table.from_pylist(links, pa.schema([("a", pa.binary()), ("b", pa.binary())]))


def find_links(blocks: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is linked; ``blocks``: class, n, shared, block."""
    link = "a binary, b binary"
    size = blocks.groupBy("block").agg(
        F.sum("n").alias("size"), F.count(F.lit(1)).alias("members"),
        F.max_by("class", F.struct(F.size("shared") / F.col("n"), "n", "class")).alias("hub"),
    )
    size = stage(size.filter("members > 1").withColumn("chunks", F.ceil(F.col("size") / CHUNK)), "blocks")
    total = size.agg(F.sum("size")).first()[0] or 0
    rows = stage(lookup(blocks, size, "block", "members"), "block-members")
    small = rows.filter("chunks = 1")
    bins = total // CHUNK + 1
    yes = F.lit(True)
    links = (
        small.select("class", "n", "shared", yes.alias("query"), yes.alias("member"), F.lit(False).alias("core"),
                     F.pmod(F.xxhash64("block"), F.lit(bins)).alias("bin"))
        .groupBy("bin").applyInArrow(search, link)
    )
    large = rows.filter("chunks > 1").withColumn("chunk", F.pmod(F.xxhash64("class", F.lit(1)), "chunks"))
    if large.isEmpty():
        return links
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    is_hub = F.col("class") == F.col("hub")
    members = large.select("block", "chunk", "class", "n", "shared", F.lit(False).alias("hub"))
    hubs = large.filter(is_hub).select("block", every.alias("chunk"), "class", "n", "shared", yes.alias("hub"))
    to_hub = stage(members.unionByName(hubs).groupBy("block", "chunk").applyInArrow(compare_with_hub, link), "hub-links")
    linked = to_hub.select(F.col("b").alias("class"), yes.alias("linked"))
    known = stage(large.join(linked, "class", "left").withColumn("core", is_hub | F.col("linked").isNotNull()).drop("linked"), "large-blocks")
    stray = known.filter(~F.col("core"))
    roles = ["block", "class", "n", "shared", "core"]
    # each chunk of queries with each chunk of members
    tasks = known.select(*roles, F.col("chunk").alias("of"), every.alias("by"), F.lit(False).alias("query"), yes.alias("member")).unionByName(
        stray.select(*roles, every.alias("of"), F.col("chunk").alias("by"), yes.alias("query"), F.lit(False).alias("member"))
    )
    return links.unionByName(to_hub).unionByName(tasks.groupBy("block", "of", "by").applyInArrow(search, link))


def group_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, key (a hash of id and text), n_shingles, label (of the
    component, null without shingles), and component_id, the smallest doc_id that its links
    reach.

    Null and empty texts, and texts of white space, have no shingle and are linked with
    nothing: their component is their own id.  Documents of null id take part; they are
    never the smallest, and where a component has no other its id is null.  Repeated rows
    are documents of one class.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    each = stage(classes_of(rows), "classes-of-documents")
    classes = stage(
        each.filter("n > 0").groupBy("class").agg(
            F.min("doc_id").alias("first"), F.min("key").alias("key"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")
        ),
        "classes",
    )
    number = F.conv(F.hex(F.concat(*[F.substring("class", i, 1) for i in range(8, 0, -1)])), 16, -10).cast("long")
    chosen = stage(may_link(rows, classes.withColumn("number", number.bitwiseOR(F.lit(1).cast("long")))), "may-link")
    sets = stage(full_sets(rows, chosen), "sets")
    blocks = stage(blocks_of(stage(frequent_parts(sets), "parts")), "blocks-of-classes")
    links = stage(find_links(blocks), "links").withColumn("group", F.monotonically_increasing_id())
    links = stage(links, "numbered-links")
    ends = links.select(F.col("a").alias("item"), "group").unionByName(links.select(F.col("b").alias("item"), "group"))
    labels = connected(ends).select(F.col("item").alias("class"), "label")
    named = stage(classes.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class")), "labelled")
    least = named.groupBy("label").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    named = stage(lookup(named, stage(least, "components"), "label", "classes").select("class", "label", "component_id", "copies"), "class-components")
    with_words = lookup(each.filter("n > 0"), named, "class", "copies")
    without = each.filter("n = 0").select("*", F.lit(None).cast("binary").alias("label"), F.col("doc_id").alias("component_id"))
    columns = ["doc_id", "key", F.col("n").alias("n_shingles"), "label", "component_id"]
    return with_words.select(columns).unionByName(without.select(columns))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest doc_id, null ids
    last, one row of it.  Documents without words stay."""
    found = stage(group_near_copies(docs), "near-copies").filter("n_shingles > 0")
    best = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("best"))
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("key"))
    with_words = rows.join(best.select(F.col("best.key").alias("key")), "key", "left_semi").dropDuplicates(["key"])
    without = docs.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return with_words.select("doc.*").unionByName(without)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_near_copies(Tables(spark, sf_dir)["documents"]).select("doc_id", "n_shingles", "component_id")
