"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

Texts are sets of five-word shingles (a text of one to four words is one shingle).
Two texts link if the Jaccard similarity of their sets is ``THRESHOLD`` or more.

1. Each text gets a signature of TREES x DEPTH minima.  Texts with the same set are
   copies: from here on one row stands for them, with its number of copies.
2. A tree of the forest is the table of texts sorted by its DEPTH minima; texts that
   share a prefix are candidates.  A pair of similarity s shares a prefix of length k
   in some tree with probability 1 - (1 - s^k)^TREES, which is least at the threshold,
   so the prefix is the longest whose recall there reaches ``RECALL``: six minima,
   0.9993 (0.99983 at similarity 0.82, 0.99998 at 0.85).  Among candidates, signatures that agree in ``SKETCH`` of the minima or more link
   for now; a bucket reports a spanning forest of these links, never its pairs.
3. The components of those links are checked exactly: all pairs inside a component,
   in chunks of ``CHUNK`` texts, from the whole shingle sets.  That counts every
   link of a text and finds the final components.

Words are runs of characters other than ASCII white space.  Empty and null texts
have no shingles and link to nothing, not even to one another.  Every row is a text of
its own, whatever its id: rows are numbered when they are first written, and ids are
only read again to name the classes.  A row without an id links like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealwise.llm.common import small_batches, stored, utf8
from dealwise.llm.components import components

SHINGLE = 5
THRESHOLD = (4, 5)  # as a fraction, so that the check is exact
TREES, DEPTH = 24, 8
RECALL = 0.999
#: Share of equal minima that makes a candidate pair worth the exact check: five
#: standard deviations below the threshold.
SKETCH = 0.655
CHUNK = 2048

_M = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = np.random.default_rng(20240607).integers(1 << 62, size=TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; ``known`` caches words."""
    words = raw.split()
    if not words:
        return np.zeros(0, np.uint64)
    for w in set(words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(SHINGLE, len(h))
    g = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        g = g * _M + h[j:j + len(g)]
    return np.unique(_mixed(g))


def signature(shingle_set: np.ndarray) -> bytes:
    """TREES x DEPTH minima, 16 bits of each."""
    least = np.full(len(_MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingle_set), 512):  # bounded temporary memory
        part = shingle_set[at:at + 512]
        least = np.minimum(least, (_MULTIPLIERS[:, None] * part[None, :]).min(axis=1))
    return (_mixed(least) & np.uint64(0xFFFF)).astype(">u2").tobytes()


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    two = np.array([(s * np.uint64(0xD6E8FEB86659FD93)).sum(), _mixed(s ^ _M).sum()], np.uint64)
    a, b = _mixed(two + np.uint64(len(s))).view(np.int64).tolist()
    return a, b


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    for batch in batches:
        if len(known) > 200_000:  # a cache: bounded
            known = {}
        rows = [shingles(raw, known) for raw in utf8(batch.column(1))]
        prints = [_fingerprint(s) if len(s) else (None, None) for s in rows]
        yield pa.RecordBatch.from_arrays([
            batch.column(0).cast(pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
            pa.array([p[1] for p in prints], pa.int64()),
            pa.array([signature(s) if len(s) else None for s in rows], pa.binary())], ["id", "fp1", "fp2", "sig"])


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of rows that agree in the first ``keys`` (integer) columns; input is sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)])
        cuts = np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            key = tuple(cols[:, a].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the sketch links of each bucket."""
    out: tuple[list[int], list[int], list[float]] = ([], [], [])
    need = SKETCH * TREES * DEPTH
    for t in _runs(batches, 3):
        # sorted by signature, as in the trie: like texts are neighbours and join early
        ids = t.column("id").to_numpy()
        own = t.column("chunk").to_numpy()
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(len(ids), -1)
        order = np.lexsort(sig.T[::-1][-DEPTH:])
        ids, own, sig = ids[order], own[order], sig[order]
        forest = _Forest(len(ids))
        a, b = t.column("a")[0].as_py(), t.column("b")[0].as_py()
        for i in range(1, len(ids)):
            same = (sig[:i] == sig[i]).sum(axis=1)
            good = same >= need
            if a != b:  # two chunks of one large bucket: only pairs across them
                good &= own[:i] != own[i]
            for j in np.flatnonzero(good)[::-1].tolist():
                if forest.join(i, j):
                    out[0].append(int(ids[i]))
                    out[1].append(int(ids[j]))
                    out[2].append(float(same[j]) / (TREES * DEPTH))
        if len(out[0]) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.float64())], ["u", "v", "s"])
            out = ([], [], [])
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                      pa.array(out[2], pa.float64())], ["u", "v", "s"])


def _chunked(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows of groups of two and more, with their chunk and once for each pair (a, b) of
    chunks of their group; a group of up to ``size`` rows has the one pair (0, 0).

    A group's size is a map-side combined count, and its rows are dealt to chunks by a hash
    of their id, so that no group is sorted or numbered in one task.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / size).cast("int")
    rows = rows.join(sizes, key).withColumn("chunk", F.pmod(F.xxhash64("id"), chunks).cast("int"))
    return (rows.withColumn("x", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .withColumn("a", F.least("x", "chunk")).withColumn("b", F.greatest("x", "chunk")).drop("n", "x"))


def _prefix_links(texts: DataFrame, depth: int) -> DataFrame:
    """(u, v, s): sketch links of texts that share a prefix of ``depth`` minima in a tree."""
    prefixes = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(
        t, F.substring(F.col("sig"), t * (2 * DEPTH) + 1, F.lit(2 * depth))))
    keys = texts.select("id", F.explode(prefixes).alias("key"))
    near = _chunked(keys, "key", CHUNK).join(texts.select("id", "sig"), "id")
    near = (near.select("key", "a", "b", "chunk", "id", "sig").repartition("key", "a", "b")
            .sortWithinPartitions("key", "a", "b"))
    return near.mapInArrow(_candidates, "u long, v long, s double")


def prefix_depth(recall: float = RECALL) -> int:
    """The longest prefix at which pairs at the threshold are met with probability ``recall``."""
    share = THRESHOLD[0] / THRESHOLD[1]
    return next((k for k in range(DEPTH, 1, -1) if 1 - (1 - share ** k) ** TREES >= recall), 1)


def forest_links(texts: DataFrame, recall: float = RECALL) -> DataFrame:
    """Sketch links at the longest prefix whose recall at the threshold reaches ``recall``."""
    return stored(_prefix_links(texts, prefix_depth(recall)), "forest")


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    for batch in batches:
        if len(known) > 200_000:
            known = {}
        rows = [shingles(raw, known) for raw in utf8(batch.column(batch.schema.get_field_index("text")))]
        keep = [k for k, (s, fp) in enumerate(zip(rows, batch.column(batch.schema.get_field_index("fp1")).to_pylist()))
                if len(s) and _fingerprint(s)[0] == fp]
        batch = batch.take(pa.array(keep, pa.int64()))
        lists = pa.array([rows[k].view(np.int64) for k in keep], pa.list_(pa.int64()))
        names = ["root", "a", "b", "chunk", "id", "copies"]
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names] + [lists],
                                         [*names, "set"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links of each chunk pair: (u, v, null) spans them, (u, null, n) counts them."""
    up, down = THRESHOLD
    for t in _runs(batches, 3):
        ids, own = t.column("id").to_numpy(), t.column("chunk").to_numpy()
        _, first = np.unique(ids, return_index=True)  # rows that repeat an id
        t = t.take(pa.array(first))
        ids, own, copies = ids[first], own[first], t.column("copies").to_numpy()
        sets = t.column("set").combine_chunks()
        sizes = np.asarray(sets.value_lengths(), np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        values, words = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        across = t.column("a")[0].as_py() != t.column("b")[0].as_py()
        has = np.zeros(len(values), np.int64)
        links, forest = np.zeros(len(ids), np.int64), _Forest(len(ids))
        us, vs = [], []
        for i in range(len(ids) - 1):
            mine = words[starts[i]:starts[i + 1]]
            has[mine] = 1
            both = np.add.reduceat(has[words[starts[i + 1]:]], starts[i + 1:-1] - starts[i + 1])
            has[mine] = 0
            good = down * both >= up * (sizes[i] + sizes[i + 1:] - both)
            if across:
                good &= own[i + 1:] != own[i]
            js = np.flatnonzero(good) + i + 1
            links[i] += copies[js].sum()
            links[js] += copies[i]
            for j in js.tolist():
                if forest.join(i, j):
                    us.append(int(ids[i]))
                    vs.append(int(ids[j]))
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([
            pa.array(us + ids[some].tolist(), pa.int64()), pa.array(vs + [None] * len(some), pa.int64()),
            pa.array([None] * len(us) + links[some].tolist(), pa.int64())], ["u", "v", "n"])


def numbered(df: DataFrame, name: str = "id") -> DataFrame:
    """``df`` written once with a number for every row, which holds from then on."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def near_classes(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """(id, class, n_links) for every row of ``docs`` (id: a number of its own, text).

    ``class`` is the least id of the row's component of links, ``n_links`` the number of
    other rows that link to it, copies included.  Rows without words have a class each.
    """
    small_batches(docs.sparkSession)
    members = stored(docs.select("id", "text").mapInArrow(_signed, "id long, fp1 long, fp2 long, sig binary"), "members")
    texts = stored(members.where("fp1 is not null").groupBy("fp1", "fp2")
                   .agg(F.min(F.struct("id", "sig")).alias("x"), F.count("*").alias("copies"))
                   .select("fp1", "fp2", "copies", "x.id", "x.sig"), "texts")
    near = components(forest_links(texts, recall).select("u", "v"))
    inside = near.withColumnRenamed("node", "id").join(texts.select("id", "copies", "fp1"), "id")
    inside = _chunked(inside, "root", CHUNK)
    sets = (inside.join(docs.select("id", "text"), "id").mapInArrow(
        _shingled, "root long, a int, b int, chunk int, id long, copies long, set array<long>")
        .repartition("root", "a", "b").sortWithinPartitions("root", "a", "b"))
    checked = stored(sets.mapInArrow(_verified, "u long, v long, n long"), "checked")
    roots = components(checked.where("v is not null").select("u", "v"))
    links = checked.where("n is not null").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n"))
    classes = (texts.select("fp1", "fp2", "copies", "id")
               .join(roots.withColumnRenamed("node", "id"), "id", "left").join(links, "id", "left")
               .select(F.col("fp1").alias("f1"), F.col("fp2").alias("f2"), F.coalesce("root", "id").alias("class"),
                       (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    # a text without words has a null fingerprint and finds no class: it is its own
    return (members.select("id", "fp1", "fp2")
            .join(classes, (F.col("fp1") == F.col("f1")) & (F.col("fp2") == F.col("f2")), "left")
            .select("id", F.coalesce("class", "id").alias("class"),
                    F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """One row per row of ``df``: its id, ``class_id`` (the least id of its component of
    links; null if no row of it has one) and ``n_links`` (other rows that link to it)."""
    rows = numbered(df.select(F.col(doc_id).alias("own"), F.col(text).alias("text")))
    found = stored(near_classes(rows, recall).join(rows.select("id", "own"), "id"), "classes")
    named = found.groupBy(F.col("class").alias("c")).agg(F.min("own").alias("class_id"))
    return found.join(named, F.col("class") == F.col("c")).select(F.col("own").alias(doc_id), "class_id", "n_links")
