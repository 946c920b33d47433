"""Substring deduplication with repeated-phrase automata.

A window is ``window`` consecutive words of one text; it recurs if its words also
start anywhere else, in the same text too.  Every word that a recurring window
covers is removed.  Windows are judged on the input.

Texts are dealt by a hash of id and text into blocks of about ``BLOCK_BYTES``; the
blocks are shuffled once and read three times.

1. Every window has a *phrase*: of the ``phrase``-word sequences in it the one with
   the least hash.  Equal windows have equal phrases.  A block reports its phrases,
   counted; those that occur twice in all texts can belong to recurring windows.
2. A block reports the distinct windows of such phrases as fingerprints, counted,
   and they are summed by (phrase, fingerprint): 128 bits confirm the recurring
   passages.  A window with any number of copies in a block is one row there, so a
   hot passage costs a row for each block and not for each copy.
3. The words of confirmed phrases come with their confirmation to each block that
   reported them, and are compiled into its Aho-Corasick automaton (a shard of the
   automata: each holds what can occur in its block).  All texts of the block are
   streamed through it, and only the automaton says where phrases are: around each
   located phrase the windows that hold it are checked against the confirmed ones,
   and covered words go.

Null and empty texts have no words.  Rows that repeat are texts of their own, so
all their windows recur.  Other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealwise.llm.common import utf8

WINDOW = 35
PHRASE = 8
BLOCK_BYTES = 512 << 10
#: Windows whose confirmation travels as the bits of one number.
BITS = 60

_M = 0x9E3779B97F4A7C15
_INV = pow(_M, -1, 1 << 64)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding(a: np.ndarray, width: int, best) -> np.ndarray:
    """Best of each ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        a = best(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return best(a[:len(a) - rest], a[rest:]) if rest else a


class Block:
    """Words, phrases and window fingerprints of the texts of one block."""

    def __init__(self, raws: list[bytes], window: int, phrase: int):
        self.texts = [raw.split() for raw in raws]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.words = [w for t in self.texts for w in t]
        n = len(self.words)
        self.window, self.phrase = window, phrase
        if n < window:
            self.valid = np.zeros(0, bool)
            self.prints = self.keys = self.grams = np.zeros(0, np.uint64)
            return
        known = {w: xxhash.xxh3_64_intdigest(w) for w in set(self.words)}
        h = np.fromiter(map(known.__getitem__, self.words), np.uint64, n)
        power = np.full(n, _M, np.uint64)
        power[0] = 1
        inverse = np.full(n, _INV, np.uint64)
        inverse[0] = 1
        power, inverse = np.cumprod(power), np.cumprod(inverse)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power)))

        def grams(k: int, salt: int) -> np.ndarray:
            return _mixed((total[k:] - total[:-k]) * inverse[:n - k + 1], salt)

        text_of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        m = n - window + 1
        self.valid = text_of[:m] == text_of[window - 1:]
        self.prints = grams(window, 0x5851F42D4C957F2D)
        self.grams = grams(phrase, 0x14057B7EF767814F)
        self.keys = _sliding(self.grams, window - phrase + 1, np.minimum)

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of the block's windows and how often each occurs (two stands for more)."""
        if not self.valid.any():
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        width = self.window - self.phrase + 1
        pad = np.zeros(width - 1, np.uint64)
        most = _sliding(np.concatenate((pad, np.where(self.valid, self.keys, np.uint64(0)), pad)), width, np.maximum)
        keys, n = np.unique(self.grams[most == self.grams], return_counts=True)
        return keys, np.minimum(n, 2)

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (phrase, fingerprint) of the windows that start at ``at``: phrase, fingerprint,
        count (two stands for more), number within the phrase and one start, in sorted order."""
        key, mark = self.keys[at], self.prints[at]
        order = np.lexsort((mark, key))
        at, key, mark = at[order], key[order], mark[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])
        first = np.flatnonzero(new)
        count = np.minimum(np.diff(np.append(first, len(key))), 2)
        at, key, mark = at[first], key[first], mark[first]
        head = np.ones(len(key), bool)
        head[1:] = key[1:] != key[:-1]
        heads = np.flatnonzero(head)
        number = np.arange(len(key)) - np.repeat(heads, np.diff(np.append(heads, len(key))))
        return key, mark, count, number, at

    def spelled(self, starts: np.ndarray) -> list[bytes]:
        """The phrase of each window that starts at ``starts``, its words joined by a space."""
        out = []
        for start in starts.tolist():
            span = self.grams[start:start + self.window - self.phrase + 1]
            at = start + int(span.argmin())
            out.append(b" ".join(self.words[at:at + self.phrase]))
        return out

    def covered(self, phrases: list[bytes], keys: np.ndarray, parts: np.ndarray, masks: np.ndarray) -> np.ndarray:
        """For each word of the block whether a confirmed window covers it.

        ``phrases`` are the spelled phrases of ``keys``; ``masks`` confirm their windows."""
        edge = np.zeros(len(self.words) + 1, np.int64)
        near = self._around(dict(zip(phrases, keys.tolist()))) if len(keys) and len(self.prints) else ()
        if len(near):
            key, mark, _, number, _ = self.windows(near)
            have = {(k, p): m for k, p, m in zip(keys.tolist(), parts.tolist(), masks.tolist())}
            bits = np.fromiter((have.get(kp, 0) for kp in zip(key.tolist(), (number // BITS).tolist())), np.int64, len(key))
            good = (bits >> (number % BITS)) & 1 == 1
            starts = near[_found(self.prints[near], np.sort(mark[good]))]
            edge[starts] += 1
            edge[starts + self.window] -= 1
        return np.cumsum(edge)[:-1] > 0

    def _around(self, phrases: dict[bytes, int]) -> np.ndarray:
        """Starts of the windows whose phrase is one of ``phrases``: the automaton over
        them finds each occurrence, and the windows that hold it follow."""
        symbols: dict[bytes, str] = {}
        machine = ahocorasick.Automaton()
        for phrase, key in phrases.items():
            words = phrase.split(b" ")
            for w in words:
                if w not in symbols:
                    n = len(symbols) + 1
                    symbols[w] = chr(n if n < 0xD800 else n + 0x800)  # no surrogates
            machine.add_word("".join([symbols[w] for w in words]), key)
        machine.make_automaton()
        get = symbols.get
        places: list[int] = []
        found: list[int] = []
        last = self.phrase - 1
        for start, text in zip(self.starts.tolist(), self.texts):
            if len(text) >= self.window:
                for end, key in machine.iter("".join([get(w, "\0") for w in text])):
                    places.append(start + end - last)
                    found.append(key)
        where, key = np.array(places, np.int64), np.array(found, np.uint64)
        near = where[:, None] - np.arange(self.window - self.phrase + 1)
        key = np.broadcast_to(key[:, None], near.shape)
        inside = (near >= 0) & (near < len(self.prints))
        near, key = near[inside], key[inside]
        return np.unique(near[self.valid[near] & (self.keys[near] == key)])


def _found(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   phrase: int = PHRASE) -> DataFrame:
    """One row per input row: the id, ``n_words``, ``n_removed``, ``kept`` (the words left,
    joined by one space) and ``removed`` (ranges ``[start, end)`` of word numbers)."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)).cast("bigint")).first()[0]
    blocks = size // BLOCK_BYTES + 1
    docs = df.select(F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(blocks)).alias("block"), F.col(doc_id).alias("id"),
                     F.col(text).alias("text"))
    # one exchange by block, shared by the three passes
    docs = docs.repartition("block")

    def report_phrases(left: pa.Table) -> pa.Table:
        keys, n = Block(utf8(left.column("text").combine_chunks()), window, phrase).phrases()
        block = left.column("block")[0].as_py()
        return pa.table({"key": keys.view(np.int64), "block": np.full(len(keys), block, np.int64),
                         "n": n.astype(np.int64)})

    seen = docs.groupBy("block").applyInArrow(report_phrases, "key long, block long, n long")
    often = (seen.withColumn("all", F.sum("n").over(W.partitionBy("key"))).where("all > 1").select("block", "key"))

    def report_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return windows_schema.empty_table()
        found = Block(utf8(left.column("text").combine_chunks()), window, phrase)
        at = np.flatnonzero(found.valid & _found(found.keys, np.sort(_unsigned(right.column("key")))))
        key, mark, count, number, start = found.windows(at)
        first = np.flatnonzero(number % BITS == 0)
        offsets = pa.array(np.append(first, len(key)).astype(np.int32))
        return pa.table([
            pa.array(key[first].view(np.int64)),
            pa.array(np.full(len(first), left.column("block")[0].as_py(), np.int64)),
            pa.array((number[first] // BITS).astype(np.int32)),
            pa.array(found.spelled(start[first]), pa.binary()),
            pa.ListArray.from_arrays(offsets, pa.array(mark.view(np.int64))),
            pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int8)))], schema=windows_schema)

    windows_schema = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("part", pa.int32()), ("phrase", pa.binary()),
                                ("marks", pa.list_(pa.int64())), ("ns", pa.list_(pa.int8()))])
    windows = (docs.groupBy("block").cogroup(often.groupBy("block"))
               .applyInArrow(report_windows, "key long, block long, part int, phrase binary, marks array<long>, ns array<tinyint>"))
    # all windows of a phrase are in one partition, so the sums need no further exchange
    single = (windows.repartition("key")
              .select("key", "block", "part", "phrase", F.posexplode(F.arrays_zip("marks", "ns")).alias("i", "w"))
              .withColumn("phrase", F.when(F.col("i") == 0, F.col("phrase"))))  # once a row of windows, not in each sort row
    sums = single.withColumn("n", F.sum("w.ns").over(W.partitionBy("key", "w.marks")))
    confirmed = (sums.groupBy("key", "block", "part")
                 .agg(F.expr("bit_or(if(n > 1, shiftleft(1L, i), 0L))").alias("mask"), F.max("phrase").alias("phrase"))
                 .where("mask <> 0"))

    out_type = T.StructType([
        T.StructField("id", df.schema[doc_id].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
        T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                                           T.StructField("end", T.IntegerType())])))])

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        found = Block(utf8(left.column("text").combine_chunks()), window, phrase)
        gone = found.covered(right.column("phrase").to_pylist(), _unsigned(right.column("key")), right.column("part").to_numpy(),
                             right.column("mask").to_numpy().astype(np.int64))
        kept, n_removed, ranges = [], [], []
        for words, a, b in zip(found.texts, found.starts[:-1].tolist(), found.starts[1:].tolist()):
            own = gone[a:b]
            n = int(np.count_nonzero(own))
            n_removed.append(n)
            kept.append(b" ".join(compress(words, (~own).tolist()) if n else words))
            step = np.flatnonzero(np.diff(np.concatenate(([0], own.astype(np.int8), [0])))) if n else np.zeros(0, np.int64)
            ranges.append([{"start": int(x), "end": int(y)} for x, y in zip(step[::2], step[1::2])])
        return pa.table({
            "id": left.column("id"), "n_words": pa.array(found.sizes), "n_removed": pa.array(n_removed, pa.int64()),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            "removed": pa.array(ranges, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))})

    done = docs.groupBy("block").cogroup(confirmed.groupBy("block")).applyInArrow(remove, out_type)
    return done.withColumnRenamed("id", doc_id)
