"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Normalising lower-cases A-Z and makes every other ASCII character that is no
digit a space, byte for byte, so an offset in the normalised text is the offset
in the original.  A window is ``window`` consecutive words of an item (a shorter
item is one window).  The automaton runs over words, one symbol a word, and each
text is scanned once.  A worker process builds it once, whatever the number of tasks
and batches that it gets.

Items of more than ``BLOCK_BYTES`` make one automaton a block, so that a worker never
holds more than one of them: texts wait until ``WAIT_BYTES`` are together, and each
automaton is built once for all of them.

Null and empty texts have no words and no hits; items without words never occur.
Rows, repeats and other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealwise.llm.common import small_batches, utf8

WINDOW = 10
#: Texts of items that one automaton holds (a few hundred MB of nodes at most)...
BLOCK_BYTES = 1 << 20
#: ... and that one function carries to the workers.
GROUP_BYTES = 16 << 20
#: Texts that wait for the automata of several blocks.
WAIT_BYTES = 64 << 20

_KEEP = set(range(48, 58)) | set(range(97, 123)) | set(range(128, 256))
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEEP else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


class Automaton:
    """All windows of a block of items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        windows: dict[tuple[bytes, ...], set[str]] = {}
        for item, words in items:
            k = min(window, len(words))
            for i in range(len(words) - k + 1):
                windows.setdefault(tuple(words[i:i + k]), set()).add(item)
        self.symbols: dict[bytes, str] = {}
        for seq in windows:
            for word in seq:
                if word not in self.symbols:
                    n = len(self.symbols) + 1
                    self.symbols[word] = chr(n if n < 0xD800 else n + 0x800)  # no surrogates
        self.machine = ahocorasick.Automaton()
        for seq, ids in windows.items():
            self.machine.add_word("".join(self.symbols[w] for w in seq), (len(seq), frozenset(ids)))
        self.some = bool(windows)
        if self.some:
            self.machine.make_automaton()

    def scan(self, words: list[bytes], runs: list[tuple[int, int]], items: set[str]) -> None:
        """Add the word ranges and items of all occurrences."""
        if not self.some:
            return
        get = self.symbols.get
        for end, (size, ids) in self.machine.iter("".join([get(w, "\0") for w in words])):
            runs.append((end - size + 1, end + 1))
            items |= ids


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _offsets(raw: bytes, norm: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as code-point ranges of the original text."""
    spans = [m.span() for m in _WORD.finditer(norm)]
    lead = np.frombuffer(raw, np.uint8) & 0xC0 != 0x80
    points = np.concatenate(([0], np.cumsum(lead)))
    return [{"start": int(points[spans[a][0]]), "end": int(points[spans[b - 1][1]])} for a, b in runs]


def _pieces(words: list[bytes], window: int, size: int) -> Iterator[list[bytes]]:
    """Runs of words of about ``size`` bytes that together hold every window: neighbours
    share ``window - 1`` words."""
    start = end = 0
    while end < len(words):
        start = max(0, end - window + 1)
        end, room = start, size
        while end < len(words) and (room > 0 or end - start < window):
            room -= len(words[end]) + 1
            end += 1
        yield words[start:end]


def _blocks(items: list[tuple[str, list[bytes]]], size: int, window: int) -> list[list[tuple[str, list[bytes]]]]:
    out: list[list[tuple[str, list[bytes]]]] = [[]]
    room = size
    for item, words in items:
        for piece in _pieces(words, window, size):
            cost = sum(map(len, piece)) + len(piece)
            if out[-1] and cost > room:
                out.append([])
                room = size
            out[-1].append((item, piece))
            room -= cost
    return out


#: The automaton that this worker process built last, with the digest of its block.
_held: dict[str, Automaton] = {}


def _automaton(digest: str, block: list[tuple[str, list[bytes]]], window: int) -> Automaton:
    if digest not in _held:
        _held.clear()  # before the next one is built: one automaton in memory at a time
        _held[digest] = Automaton(block, window)
    return _held[digest]


def _waiting(batches: Iterator[tuple[pa.Array, ...]], size: int) -> Iterator[list[tuple[pa.Array, ...]]]:
    """Batches gathered until their texts have ``size`` bytes."""
    wait, room = [], size
    for batch in batches:
        wait.append(batch)
        room -= batch[0].nbytes
        if room <= 0:
            yield wait
            wait, room = [], size
    if wait:
        yield wait


def _hits_udf(items: list[tuple[str, list[bytes]]], window: int):
    blocks = [(hashlib.sha256(repr((window, block)).encode()).hexdigest(), block)
              for block in _blocks(items, BLOCK_BYTES, window)]
    wait = WAIT_BYTES if len(blocks) > 1 else 0
    ddl = "struct<n_words bigint, n_hit bigint, runs array<int>, items array<string>, spans array<struct<start int, end int>>>"
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("runs", pa.list_(pa.int32())),
                      ("items", pa.list_(pa.string())), ("spans", pa.list_(span))])

    @F.arrow_udf(ddl)
    def hits(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for together in _waiting(batches, wait):
            runs = [[list(zip(r[::2], r[1::2])) if r else [] for r in old.to_pylist()] for _, old, _ in together]
            found = [[set(x or ()) for x in old.to_pylist()] for _, _, old in together]
            sizes: list[list[int]] = [[]] * len(together)
            for digest, block in blocks:
                automaton = _automaton(digest, block, window)
                for b, batch in enumerate(together):
                    words = [raw.translate(_TABLE).split() for raw in utf8(batch[0])]
                    sizes[b] = [len(own) for own in words]
                    for k, own in enumerate(words):
                        automaton.scan(own, runs[b][k], found[b][k])
            for b, batch in enumerate(together):
                rows = []
                for raw, n, r, ids in zip(utf8(batch[0]), sizes[b], runs[b], found[b]):
                    r = _merged(r)
                    rows.append({"n_words": n, "n_hit": sum(b - a for a, b in r),
                                 "runs": [x for run in r for x in run], "items": sorted(ids),
                                 "spans": _offsets(raw, raw.translate(_TABLE), r) if r else []})
                yield pa.array(rows, kind)

    return hits


def benchmark_hits(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", out: str = "hits", window: int = WINDOW) -> DataFrame:
    """Add the struct column ``out``: ``n_words``, ``n_hit`` (words inside an occurrence of
    a window), ``items`` (ids of items with occurring windows, sorted as strings) and
    ``spans`` (code-point ranges ``[start, end)`` of the original text, merged).

    ``benchmark`` is read to the driver in groups of at most ``GROUP_BYTES`` of text,
    and each group is sent to the workers with its own function, so what is
    broadcast at once is bounded however many items there are.  Items with a null
    id count as the id ``''``.  A column already named ``out`` is replaced.
    """
    small_batches(df.sparkSession)
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    groups = size // GROUP_BYTES + 1
    if groups > 1:
        items = items.distinct()
    runs, ids = F.lit(None).cast("array<int>"), F.lit(None).cast("array<string>")
    for g in range(groups):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(groups)) == g) if groups > 1 else items
        rows = [(r["i"], r["t"].encode().translate(_TABLE).split()) for r in part.collect()]
        udf = _hits_udf([x for x in rows if x[1]], window)
        df = df.withColumn(out, udf(F.col(text), runs, ids))
        runs, ids = F.col(out)["runs"], F.col(out)["items"]
    return df
