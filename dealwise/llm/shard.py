"""Minimax contiguous partition of texts into shards, DataFrame functions only.

Rows with equal texts are one atomic group.  Groups are ordered by the md5 of
their text (texts with one md5 form one group).  The smallest shard capacity for
which a greedy pass needs no more than the wanted shards is found by binary search
over the group sizes, and the order is cut there.

Group sizes are not collected.  The driver sees a summary: bytes by prefix of the
md5, a prefix being split further only where a cut may fall.  Counting a prefix as
one atom gives a capacity that suffices, counting it as divisible at will one that
is needed; every prefix that a cut can meet under a capacity between the two is
split by one more hex digit, until those prefixes hold single groups (heavy ones
are split first, so that no large group blurs the bounds).  Then the
greedy pass over the summary is the greedy pass over the groups, and its binary
search gives the optimum.  The summary has a bounded number of rows at any input
size: 16**START prefixes and 16 for each one split.

Slots are numbered in hash buckets of (doc_id, text), whose number grows with the rows.

Null texts have no bytes and form a group with the empty ones.  Empty tables give
no rows.  Rows that repeat are rows like any other; equal texts take slots by doc_id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dealwise.llm.common import checked_broadcast, stored

#: Hex digits of the first summary.
START = 3
#: A prefix may weigh this part of an even shard before cuts are looked for.
HEAVY = 64
#: Bytes that a row weighs besides its text.
ROW_BYTES = 8
#: Rows of a shard that one task numbers, about; buckets that the driver's table may name.
SLOT_ROWS, SLOT_BUCKETS = 1_000, 1 << 20


@dataclass(frozen=True)
class Atom:
    prefix: str
    size: int
    single: bool  # one group, which cannot be split


def needs(atoms: list[tuple[int, bool]], capacity: int, shards: int) -> list[int] | None:
    """Greedy ends (in bytes) of each shard, or None if ``shards`` are too few.

    An atom is (size, divisible); a divisible one fills a shard to the brim.
    """
    ends, used, done = [], 0, 0
    for size, divisible in atoms:
        if not divisible:
            if size > capacity:
                return None
            if used + size > capacity:
                ends.append(done)
                used = 0
            used += size
        else:
            room = capacity - used
            rest = size
            while rest > room:
                done += room
                rest -= room
                size -= room
                ends.append(done)
                if len(ends) >= shards:
                    return None
                used, room = 0, capacity
            used += rest
        done += size
        if len(ends) >= shards:
            return None
    return [*ends, done]


def smallest(atoms: list[tuple[int, bool]], shards: int) -> int:
    """Binary search for the least capacity that ``shards`` shards can keep."""
    total = sum(size for size, _ in atoms)
    low, high = max(1, -(-total // shards)), max(1, total)
    while low < high:
        mid = (low + high) // 2
        if needs(atoms, mid, shards) is None:
            low = mid + 1
        else:
            high = mid
    return low


def _greedy_ends(sizes: list[int], capacity: int) -> list[int]:
    """Ends (in bytes) of greedy shards of whole atoms, each of at most ``capacity``."""
    ends, used, done = [], 0, 0
    for size in sizes:
        if used + size > capacity:
            ends.append(done)
            used = 0
        used += size
        done += size
    return [*ends, done]


def _open_prefixes(atoms: list[Atom], shards: int) -> list[str]:
    """Prefixes of several groups that have to be split.

    First those that weigh too much: a very large group must stand alone.  Then those
    that a cut can meet under any capacity still possible.  The greedy end of shard j
    over groups is no earlier than that over whole prefixes at the least capacity, and
    no later than that over divisible ones at the greatest.
    """
    total = sum(a.size for a in atoms)
    heavy = [a.prefix for a in atoms if not a.single and a.size * shards * HEAVY > total]
    if heavy:
        return heavy
    fluid = [(a.size, not a.single) for a in atoms]
    low, high = smallest(fluid, shards), smallest([(a.size, False) for a in atoms], shards)
    early = _greedy_ends([a.size for a in atoms], low)
    late = needs(fluid, high, shards) or [total]
    windows = [(min(early[j], end) if j < len(early) else end, end) for j, end in enumerate(late)]
    out, done, j = [], 0, 0
    for a in atoms:
        while j < len(windows) and windows[j][1] < done:
            j += 1
        # windows rise at both ends, so the first that is not over decides
        if not a.single and j < len(windows) and windows[j][0] <= done + a.size:
            out.append(a.prefix)
        done += a.size
    return out


def cut_points(atoms: list[Atom], shards: int) -> tuple[int, list[str]]:
    """The least capacity and the first prefix of each shard but the first.

    Any cut that leaves a feasible rest keeps the capacity; among those the one
    nearest to an even split of the rest is taken, so the last shards are not short.
    """
    sizes = [a.size for a in atoms]
    capacity = smallest([(s, False) for s in sizes], shards)
    total, n = sum(sizes), len(atoms)
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    # least[j]: the first atom from which j shards suffice for all the rest
    least, i = [n], n
    for _ in range(shards):
        top = ends[i]
        while i and top - ends[i - 1] <= capacity:
            i -= 1
        least.append(i)
    cuts, at = [], 0
    for left in range(shards - 1, 0, -1):
        low = max(at, least[left])
        high = at
        while high < n and ends[high + 1] - ends[at] <= capacity:
            high += 1
        want = ends[at] + (total - ends[at]) / (left + 1)
        best = min(range(low, high + 1), key=lambda k: abs(ends[k] - want)) if low <= high else low
        cuts.append(atoms[best].prefix if best < n else "g")  # 'g' sorts behind any hex digest
        at = best
    return capacity, cuts


def _summary(groups: DataFrame, prefix: Column) -> list[Atom]:
    rows = (groups.groupBy(prefix.alias("p"))
            .agg(F.sum("size").alias("size"), F.min("key").alias("a"), F.max("key").alias("b")).collect())
    # a prefix with one group is written in full, so that it is never split again
    return [Atom(r["a"] if r["a"] == r["b"] else r["p"], r["size"], r["a"] == r["b"]) for r in rows]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """Capacity and cut keys for ``groups`` (key: hex digest, size: bytes)."""
    atoms = sorted(_summary(groups, F.substring("key", 1, START)), key=lambda a: a.prefix)
    while todo := _open_prefixes(atoms, shards):
        digits = min(map(len, todo))  # prefixes of one length at a time
        split = {p for p in todo if len(p) == digits}
        inside = groups.where(F.substring("key", 1, digits).isin(*sorted(split)))
        atoms = sorted([a for a in atoms if a.prefix not in split] + _summary(inside, F.substring("key", 1, digits + 1)),
                       key=lambda a: a.prefix)
    return cut_points(atoms, shards)


def shard_texts(df: DataFrame, shards: int = 24, text: str = "text", doc_id: str = "doc_id",
                out: str = "placed") -> DataFrame:
    """Add the struct column ``out``: ``size`` (UTF-8 bytes and 8), ``text_crc32``,
    ``law`` ('bytes'), ``shard`` (0 .. shards - 1), ``slot`` (gapless from 0 in a shard)
    and ``grown_shard`` (null under this law).

    Equal texts share a shard, and the largest shard is as small as contiguous cuts
    allow.  A column already named ``out`` is replaced; all other columns stay.
    """
    body = F.coalesce(F.col("row").getField(text), F.lit(""))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()]).alias("row"))
    keyed = rows.select("row", F.md5(body.cast("binary")).alias("key"),
                        (F.octet_length(body) + ROW_BYTES).cast("bigint").alias("size"),
                        F.crc32(body.cast("binary")).alias("crc"))
    groups = stored(keyed.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("rows")), "shard-groups")
    rows_in_all = groups.agg(F.sum("rows")).first()[0] or 0
    buckets = min(max(1, -(-rows_in_all // (shards * SLOT_ROWS))), SLOT_BUCKETS // shards or 1)
    _, cuts = minimax_cuts(groups, shards)
    shard = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("key"))) if cuts else F.lit(0)
    placed = keyed.withColumn("shard", shard.cast("int")).withColumn(
        "bucket", F.pmod(F.xxhash64(F.col("row").getField(doc_id), F.col("key")), F.lit(buckets)).cast("int"))
    # a slot is its place in a hash bucket behind the buckets before it: no shard is sorted in one task
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = counts.select(F.col("shard").alias("s"), F.col("bucket").alias("b"), F.coalesce(
        F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0)).alias("base"))
    first = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("key", F.col("row").getField(doc_id))) - 1
    slots = placed.withColumn("place", first).join(
        checked_broadcast(before, shards * buckets),
        (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b")))
    return slots.select("row.*", F.struct(
        "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("place")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard")).alias(out))
