"""N-gram Jaccard self-join by chosen paths.

Sets of five-word shingles are embedded into ``POSITIONS`` MinHash values, so
that a position agrees with the probability of the Jaccard similarity.  A run
is a tree over the collection: a node samples 1 / threshold positions (one, and
a second in a quarter of the nodes) by its path, and its sets go to one child
for each sampled position and value, so a pair at the threshold shares one
child on average.  Buckets of at most ``LEAF`` sets are searched by brute force
on the MinHash values; larger ones are split again, until a child keeps most of
its parent (``DENSE``: a group of near copies, which sampling does not divide)
or at ``MAX_DEPTH``; a bucket that is then still large is taken as one group.
``RUNS`` trees are repeated; ``recall`` gives the share of pairs at the
threshold that some run must find.

What brute force finds joins sets into candidate groups; all pairs of a group
are then verified on exact shingle sets, again in pairs of blocks, so links are
exact, each is counted once, and pairs that no run met directly are found too.
Copies (equal sets) are one set throughout and are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, table
from .graph import components, roots, runs
from .words import U64, mix, shingles, slices, words

SHINGLE, THRESHOLD = 5, 0.8
POSITIONS, RUNS, MIN_DEPTH, MAX_DEPTH = 128, 12, 3, 8
#: A child with this share of its parent's sets is not split again.
DENSE = 0.75
#: Sets in a bucket for brute force, and in a block of a candidate group.
LEAF, BLOCK = 400, 500
#: Share of agreeing positions from which a pair is a candidate: four standard
#: errors below the threshold.
CANDIDATE = THRESHOLD - 4 * (THRESHOLD * (1 - THRESHOLD) / POSITIONS) ** 0.5

_RNG = np.random.default_rng(977)
_A = _RNG.integers(1, 2**63, POSITIONS, dtype=np.uint64) * U64(2) + U64(1)
_B = _RNG.integers(1, 2**63, POSITIONS, dtype=np.uint64)


def recall(depth: int = MIN_DEPTH, trees: int = RUNS, similarity: float = THRESHOLD) -> float:
    """Share of pairs of this similarity that share a node at ``depth``."""
    found = 1.0
    for _ in range(depth):
        child = similarity * found
        found = 0.75 * child + 0.25 * (1 - (1 - child) ** 2)
    return 1 - (1 - found) ** trees


def minhash(sets: np.ndarray) -> np.ndarray:
    """32-bit MinHash values of one non-empty set of 64-bit hashes."""
    out = np.full(POSITIONS, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(sets), 2048):
        h = ((sets[lo:lo + 2048, None] * _A + _B) >> U64(32)).astype(np.uint32)
        np.minimum(out, h.min(0), out=out)
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    a, b = mix(s), mix(s * U64(0x9E3779B97F4A7C15) + U64(1))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int((np.bitwise_xor.reduce(b) if len(b) else U64(0)).view(np.int64))


def children(path: np.ndarray, which: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(path, which) of the children: ``which`` is a row of ``sig``."""
    first = (mix(path ^ U64(0x51ED)) % U64(POSITIONS)).astype(np.int64)
    two = (mix(path ^ U64(0xC2B2)) & U64(3)) == 0
    shift = (mix(path ^ U64(0x27D4)) % U64(POSITIONS - 1)).astype(np.int64) + 1
    second = (first + shift) % POSITIONS

    def child(p: np.ndarray, w: np.ndarray, at: np.ndarray) -> np.ndarray:
        return mix(p * U64(0x9FB21C651E98DF25) + at.astype(np.uint64) * U64(0xD6E8FEB86659FD93) + sig[w, at].astype(np.uint64))

    return (np.concatenate([child(path, which, first), child(path[two], which[two], second[two])]),
            np.concatenate([which, which[two]]))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, k1, k2, sig): number of shingles, name and MinHash of the set."""
    names = ["doc_id", "n", "k1", "k2", "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo, hi in slices(rb.column(1)):
                sets = shingles(words(rb.column(1).slice(lo, hi - lo)), SHINGLE)
                keys = [set_key(s) for s in sets]
                sig = [minhash(s).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [rb.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
                     pa.array([k[1] for k in keys], pa.int64()), pa.array(sig, pa.binary())], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n long, k1 long, k2 long, sig binary")


def _signatures(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, POSITIONS)


def first_nodes(sigs: DataFrame) -> DataFrame:
    """(rep, path, was): nodes at ``MIN_DEPTH`` of every run.  The nodes above hold
    a fixed share of the collection and are always split.  ``was`` is the size
    of the node above."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            sig, n = _signatures(rb.column(1)), rb.num_rows
            path = np.repeat(mix(np.arange(1, RUNS + 1, dtype=np.uint64)), n)
            which = np.tile(np.arange(n), RUNS)
            for _ in range(MIN_DEPTH):
                path, which = children(path, which, sig)
            yield pa.RecordBatch.from_arrays([rb.column(0).take(pa.array(which)), pa.array(path.view(np.int64))], ["rep", "path"])

    return sigs.select("rep", "sig").mapInArrow(run, "rep long, path long").withColumn("was", F.lit(2**62))


def next_nodes(nodes: DataFrame, sigs: DataFrame) -> DataFrame:
    """(rep, path, was): the children of large nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            path, which = children(rb.column(1).to_numpy().view(np.uint64), np.arange(rb.num_rows), _signatures(rb.column(2)))
            at = pa.array(which)
            yield pa.RecordBatch.from_arrays([rb.column(0).take(at), pa.array(path.view(np.int64)), rb.column(3).take(at)], ["rep", "path", "was"])

    return nodes.join(sigs.select("rep", "sig"), "rep").select("rep", "path", "sig", "size").mapInArrow(run, "rep long, path long, was long")


def leaves(sigs: DataFrame) -> DataFrame:
    """(rep, path, size, least rep) of the final buckets: two sets or more, and
    each membership once, however many paths lead to it."""
    out, nodes = None, first_nodes(sigs)
    for depth in range(MIN_DEPTH, MAX_DEPTH + 1):
        nodes = staged(nodes, "op1-nodes")
        sizes = (nodes.groupBy("path").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("rep")).alias("members"), F.min("was").alias("was"), F.min("rep").alias("least"))
                 .where("size > 1").withColumn("split", (F.col("size") > LEAF) & (F.col("size") < DENSE * F.col("was")) & F.lit(depth < MAX_DEPTH)))
        # Equal final buckets are searched once.  Those that split go on apart,
        # however equal: the runs' chances multiply only while they are apart.
        once = F.when(F.col("split"), F.col("path"))
        sizes = sizes.groupBy("size", "members", "least", "split", once.alias("own")).agg(F.min("path").alias("path")).drop("members", "own")
        sized = staged(nodes.select("rep", "path").join(sizes, "path"), "op1-sized")
        large = sized.where("split").drop("split")
        done = depth == MAX_DEPTH or large.isEmpty()
        found = sized.where("NOT split").drop("split")
        out = found if out is None else out.unionByName(found)
        if done:
            return out
        nodes = next_nodes(large, sigs)
    return out


def blocks(members: DataFrame, group: str, member: str, size: str, most: int) -> DataFrame:
    """Add (i, j, side): a group of more than ``most`` members is dealt into
    blocks, and each member goes to every pair of blocks that its own is in."""
    n = F.ceil(F.col(size) / most).cast("int")
    mine = F.pmod(F.xxhash64(member, group), n).cast("int")
    return (members.withColumn("side", mine).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")).drop("other"))


def candidate_edges(found: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b): in each bucket, a star over each set of sets that candidate
    pairs join; in a large one, a star over all of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, 1):
            rep, n, sig = t.column(1).to_numpy(), t.column(2).to_numpy(), _signatures(t.column(3))

            def near() -> Iterator[tuple[int, np.ndarray]]:
                for i in range(len(rep) - 1):
                    same = (sig[i + 1:] == sig[i]).sum(1) >= CANDIDATE * POSITIONS
                    same &= np.minimum(n[i + 1:], n[i]) >= THRESHOLD * np.maximum(n[i + 1:], n[i])
                    yield i, np.flatnonzero(same) + i + 1

            root = roots(len(rep), near())
            at = np.flatnonzero(root != np.arange(len(rep)))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(rep[root[at]])], ["a", "b"])

    small = found.where(F.col("size") <= LEAF).select("path", "rep")
    edges = (small.join(sigs.select("rep", "n", "sig"), "rep").select("path", "rep", "n", "sig")
             .repartition("path").sortWithinPartitions("path").mapInArrow(run, "a long, b long"))
    return edges.union(found.where(F.col("size") > LEAF).select("rep", "least"))


def verified(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rep, texts, documents, root): exact links of each set within a pair of
    blocks of its group - to how many sets, standing for how many documents."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo, hi in slices(rb.column(6)):
                part = rb.slice(lo, hi - lo)
                sets = shingles(words(part.column(6)), SHINGLE)
                keys = list(zip(part.column(4).to_pylist(), part.column(5).to_pylist()))
                ok = [set_key(s) == k for s, k in zip(sets, keys)]  # rows may share an id
                at = pa.array(np.flatnonzero(ok))
                yield pa.RecordBatch.from_arrays([*[c.take(at) for c in part.columns[:4]], pa.array([s.tobytes() for s, y in zip(sets, ok) if y], pa.binary())],
                                                 ["root", "rep", "copies", "size", "shingles"])

    own = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    held = (own.join(groups, "rep").select("root", "rep", "copies", "size", "k1", "k2", "text")
            .mapInArrow(encode, "root long, rep long, copies long, size long, shingles binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, 3):
            rep, once = np.unique(t.column(3).to_numpy(), return_index=True)  # repeated rows
            t = t.take(pa.array(once))
            copies, side = t.column(4).to_numpy(), t.column(5).to_numpy()
            within = t.column(1)[0].as_py() == t.column(2)[0].as_py()
            sets = [np.frombuffer(b, dtype=np.uint64) for b in t.column(6).to_pylist()]
            n = np.array([len(s) for s in sets])
            whole, held_by = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
            _, name, df = np.unique(whole, return_inverse=True, return_counts=True)
            shared = df[name] > 1
            place = np.cumsum(df > 1) - 1
            width = (int(place[-1]) + 1 + 63) // 64 if len(place) else 0
            bits = np.zeros((len(sets), width * 8), dtype=np.uint8)
            col, row = place[name[shared]], held_by[shared]
            np.bitwise_or.at(bits, (row, col >> 3), (1 << (col & 7)).astype(np.uint8))
            bits = bits.view(np.uint64)
            texts, documents = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)

            def near() -> Iterator[tuple[int, np.ndarray]]:
                for i in range(len(rep) - 1):
                    rest = np.flatnonzero((np.minimum(n[i + 1:], n[i]) >= THRESHOLD * np.maximum(n[i + 1:], n[i])) & (within | (side[i + 1:] != side[i]))) + i + 1
                    common = np.bitwise_count(bits[rest] & bits[i]).sum(1, dtype=np.int64)
                    js = rest[common * (1 + THRESHOLD) >= THRESHOLD * (n[rest] + n[i]) - 1e-9]
                    texts[i] += len(js)
                    documents[i] += copies[js].sum()
                    texts[js] += 1
                    documents[js] += copies[i]
                    yield i, js

            root = roots(len(rep), near())
            at = np.flatnonzero(texts)
            yield pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(texts[at]), pa.array(documents[at]), pa.array(rep[root[at]])],
                                             ["rep", "texts", "documents", "root"])

    dealt = blocks(held, "root", "rep", "size", BLOCK).select("root", "i", "j", "rep", "copies", "side", "shingles")
    return dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(run, "rep long, texts long, documents long, root long")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest id that links join it
    to), copy_id (smallest id with the same shingles), n_links (other documents
    at the threshold or above, copies included), n_text_links (other shingle
    sets), n_shingles.

    A text of fewer than five words, but not none, is one shingle.  Null, empty
    and wordless texts link to nothing, not even to each other: class and copy
    are the document itself.  Rows that share an id are one document: repeats
    as such, and of different texts the one whose set has the largest name.  A
    row without an id has no class and no links.  Other columns are not read.
    """
    every = staged(sketches(docs, id_col, text_col), "op1-sketches")
    named = every.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.struct(F.col("n") > 0, "k1", "k2", "n")).alias("set")).select(
        "doc_id", "set.n", "set.k1", "set.k2")
    ids = named.where("n > 0")
    c = ids.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    c = c.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "rep", "copies")
    sigs = staged(every.join(c, (F.col("doc_id") == F.col("rep")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")))
                  .select("rep", "n", "copies", "k1", "k2", "sig").dropDuplicates(["rep", "k1", "k2"]), "op1-signatures")
    classes = sigs.select("rep", "copies", "k1", "k2")

    groups = staged(components(candidate_edges(leaves(sigs), sigs), "op1-candidates"), "op1-groups")
    sizes = groups.groupBy("root").agg(F.count("*").alias("size"))
    members = (groups.join(sizes, "root").select(F.col("node").alias("rep"), "root", "size")
               .join(classes, "rep").select("rep", "root", "size", "copies", "k1", "k2"))
    links = staged(verified(docs, members, id_col, text_col), "op1-links")

    linked = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")), "op1-linked")
    counts = links.groupBy("rep").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    per_class = (classes.join(counts, "rep", "left").join(linked.select(F.col("node").alias("rep"), F.col("root")), "rep", "left")
                 .select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "rep", "copies", "texts", "documents", "root"))
    zero = F.lit(0).cast("long")
    out = ids.join(per_class, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))).select(
        "doc_id", F.coalesce("root", "rep").alias("class_id"), F.col("rep").alias("copy_id"),
        (F.coalesce("documents", zero) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("texts", zero).alias("n_text_links"), F.col("n").alias("n_shingles"))
    rest = named.where("n = 0").select("doc_id", "n").union(every.where("doc_id IS NULL").select("doc_id", "n").distinct()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), zero.alias("n_links"), zero.alias("n_text_links"), F.col("n").alias("n_shingles"))
    return out.unionByName(rest)


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n, sha256(string_agg(g, '|' ORDER BY g)) AS name FROM sh GROUP BY 1),
c AS (SELECT name, min(doc_id) AS copy_id, count(*) AS copies, any_value(n) AS n FROM n GROUP BY 1),
sc AS (SELECT sh.* FROM sh JOIN c ON sh.doc_id = c.copy_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sc a JOIN sc b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT p.a, p.b, y.copies FROM p JOIN c x ON x.copy_id = p.a JOIN c y ON y.copy_id = p.b
  WHERE p.shared * 10 >= 8 * (x.n + y.n - p.shared)),
reach AS (
  SELECT copy_id AS node, copy_id AS tip FROM c
  UNION SELECT reach.node, e.b FROM reach JOIN e ON e.a = reach.tip),
root AS (SELECT node, min(tip) AS class_id FROM reach GROUP BY 1),
l AS (SELECT a, count(*) AS texts, sum(copies) AS docs FROM e GROUP BY 1)
SELECT d.doc_id, coalesce(root.class_id, d.doc_id) AS class_id, coalesce(c.copy_id, d.doc_id) AS copy_id,
       CAST(coalesce(l.docs, 0) + coalesce(c.copies, 1) - 1 AS BIGINT) AS n_links, CAST(coalesce(l.texts, 0) AS BIGINT) AS n_text_links,
       CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (name) LEFT JOIN root ON root.node = c.copy_id LEFT JOIN l ON l.a = c.copy_id
"""
