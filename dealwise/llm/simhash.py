"""SimHash near duplicates by covering locality-sensitive hashing.

1. Each text gets a 64-bit fingerprint: bit k is set if over half of the XXH64 values of
   its word shingles have it set.  Texts are hashed in Arrow batches, long ones in pieces.
2. Equal fingerprints are one node from here on (a map-side combined aggregate), so a
   group of copies of any size is one row.
3. Covering masks (Pagh, "CoveringLSH"): bit i has a code c(i) of RADIUS + 1 bits, and
   table v keeps the bits whose code has odd parity with v.  The codes of RADIUS bits
   span less than the whole space, so some v is orthogonal to all of them: its table
   keeps none of the differing bits, and the pair meets there for certain.  Seven
   tables, each of about 36 bits.
4. Nodes that meet another one in some table are linked without forming pairs: a node
   goes to the points at distance one along the bits that its tables leave out.  Two
   nodes at one point differ in at most two bits, and two that differ in at most two of
   those bits share a point.  A point holds at most 65 nodes, so no group is large.
5. Components over these links, by alternating stars.

Null and empty texts and texts without words have fingerprint zero and link like any
other.  Rows without an id are fingerprinted and link; a component's id is its least
id that is not null, and null if it has none.  Every row, repeated ones too, gives one
row.  Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealwise.llm.common import small_batches, stored, utf8
from dealwise.llm.components import components

BITS, RADIUS, SHINGLE, SEED = 64, 2, 3, 42
#: Shingles whose bits are counted at a time.
PIECE = 1 << 16


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Bit masks such that any ``radius`` bits are all absent from one of them."""
    width = radius + 1
    codes = [1 + i % ((1 << width) - 1) for i in range(bits)]
    return [sum(1 << i for i, c in enumerate(codes) if (c & v).bit_count() & 1) for v in range(1, 1 << width)]


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a UTF-8 text (unsigned)."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[len(words) - n:].tolist()
    hash_of = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, PIECE):
        h = np.array([hash_of(line[a:b], seed) for a, b in zip(starts[k:k + PIECE], ends[k:k + PIECE])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = pa.array([_signed(fingerprint(t)) for t in utf8(batch.column(1))], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["doc_id", "fp"])


def _masked(fp: Column, mask: int) -> Column:
    return fp.bitwiseAND(F.lit(_signed(mask)))


def near_links(nodes: DataFrame) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that connect exactly those
    within RADIUS bits of each other."""
    masks = covering_masks()
    tables = F.array(*[F.struct(F.lit(t).alias("t"), _masked(F.col("fp"), m).alias("key")) for t, m in enumerate(masks)])
    met = nodes.select("fp", F.inline(tables))
    shared = met.groupBy("t", "key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low != high")
    left_out = F.element_at(F.array(*[F.lit(_signed(~m & (1 << BITS) - 1)) for m in masks]), F.col("t") + 1)
    members = (met.join(shared.select("t", "key"), ["t", "key"], "left_semi")
               .groupBy("fp").agg(F.bit_or(left_out).alias("free")))
    bits = F.array(*[F.lit(_signed(1 << i)) for i in range(BITS)])
    points = F.concat(F.array("fp"), F.transform(F.filter(bits, lambda b: F.col("free").bitwiseAND(b) != 0),
                                                 lambda b: F.col("fp").bitwiseXOR(b)))
    points = members.select("fp", F.explode(points).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low != high")
    return points.join(least, "point").where("fp != low").select(F.col("fp").alias("u"), F.col("low").alias("v"))


def simhash_components(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``df``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the least id that
    links of at most two differing bits reach.
    """
    small_batches(df.sparkSession)
    given = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    prints = stored(given.mapInArrow(_print_batches, f"doc_id {kind}, fp long"), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("own"))
    groups = components(near_links(nodes.select("fp")))
    named = groups.join(nodes, F.col("node") == F.col("fp"))
    least = named.groupBy("root").agg(F.min("own").alias("least"))
    linked = named.select("node", "root").join(least, "root").select("node", "least")
    place = nodes.join(linked, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("print"), F.coalesce("least", "own").alias("component_id"))
    # written, so that the join deals the rows by itself and can split a fingerprint of very many rows
    place = stored(place, "fingerprint-classes")
    return prints.join(place, F.col("fp") == F.col("print")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
