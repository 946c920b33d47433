"""Quality rules as a short-circuit cascade.

Each rule reads a few features of a text.  On a bounded sample the rules' cost
(seconds a text) and selectivity (share rejected) are measured; the rules then
run in falling order of rejection per cost, and a text that one rule rejects is
not shown to the later ones.  Features are computed at first use, so a rejected
text never pays for the dear ones.  The verdict is the same in any order, only
the work differs.

Words are runs of characters other than space and ``\\t\\n\\v\\f\\r``.  Null and
empty texts have no words and are rejected by ``few_words``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealwise.llm.common import small_batches, utf8

WINDOW = 5
#: Texts on which the order of the rules is measured.
SAMPLE_ROWS = 500
_CONTINUATION = bytes(range(0x80, 0xC0))
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))


def _repeat_words(words: list[bytes]) -> int:
    """Words inside a window of five words that occurs twice or more in the text."""
    n = len(words)
    m = n - WINDOW + 1
    if m < 2:
        return 0
    # a word's id is its last position; ids of windows are exact, not hashed
    last = dict(zip(words, range(n)))
    ids = np.fromiter(map(last.__getitem__, words), np.int64, n)
    grams, size = ids[:m], n
    for j in range(1, WINDOW):
        if size * n >= 1 << 62:
            uniq, grams = np.unique(grams, return_inverse=True)
            size = len(uniq)
        grams = grams * n + ids[j:j + m]
        size *= n
    ordered = np.sort(grams)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    starts = np.flatnonzero(np.isin(grams, again))
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edge)))


class Text:
    """One text; features are computed once, at first use."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self._have: dict[str, object] = {}

    def get(self, name: str):
        if name not in self._have:
            self._have[name] = FEATURES[name](self)
        return self._have[name]


FEATURES: dict[str, Callable[[Text], object]] = {
    "words": lambda t: t.raw.split(),
    "lines": lambda t: [x for x in t.raw.split(b"\n") if x.strip()],
    "n_words": lambda t: len(t.get("words")),
    "word_chars": lambda t: len(t.raw.translate(None, _CONTINUATION + _SPACE)),
    "n_symbols": lambda t: len(t.raw) - len(t.raw.translate(None, _SYMBOLS)),
    "n_upper": lambda t: len(t.raw) - len(t.raw.translate(None, _UPPER)),
    "n_lines": lambda t: len(t.get("lines")),
    "n_dup_lines": lambda t: t.get("n_lines") - len(set(t.get("lines"))),
    "n_repeat_words": lambda t: _repeat_words(t.get("words")),
}


@dataclass(frozen=True)
class Rule:
    """``rejects(text)`` is true for a text that the rule throws out."""

    name: str
    rejects: Callable[[Text], bool]


#: The two rules that every text must pass.
BASE = (
    Rule("few_words", lambda t: t.get("n_words") < 10),
    Rule("repeats", lambda t: 100 * t.get("n_repeat_words") > 20 * t.get("n_words")),
)
#: Production rules: the base and four lenient ratios.
RULES = BASE + (
    Rule("symbols", lambda t: 10 * t.get("n_symbols") > 3 * t.get("n_words")),
    Rule("word_length", lambda t: not 2 * t.get("n_words") <= t.get("word_chars") <= 15 * t.get("n_words")),
    Rule("dup_lines", lambda t: 10 * t.get("n_dup_lines") > 3 * t.get("n_lines")),
    Rule("shouting", lambda t: 2 * t.get("n_upper") > t.get("word_chars")),
)


def rule_order(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
               sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, share rejected), best rejection per cost first.

    Measured on at most ``sample_rows`` texts, a hash-chosen eighth of the first
    splits: they are taken one split after the other, so no further pass over the
    table is made.  An empty table leaves the rules in the order given.
    """
    sample = df.select(F.col(text).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(8)) == 0).take(sample_rows)
    raws = [(r["text"] or "").encode() for r in sample]
    stats = []
    for rule in rules:
        began = time.perf_counter()
        hits = sum(bool(rule.rejects(Text(raw))) for raw in raws)
        stats.append((rule.name, (time.perf_counter() - began) / max(len(raws), 1), hits / max(len(raws), 1)))
    return sorted(stats, key=lambda x: -x[2] / max(x[1], 1e-9))


def quality_cascade(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", out: str = "quality",
                    measures: tuple[str, ...] = (), order: list[str] | None = None) -> DataFrame:
    """Add the struct column ``out``: ``kept``, ``rule`` (the first that rejected, else
    null) and the features named in ``measures``, which are computed for every text.

    Rows stay as they are, whatever other columns or repeats there are; a column
    already named ``out`` is replaced.  ``order`` skips the sample.
    """
    small_batches(df.sparkSession)
    by_name = {r.name: r for r in rules}
    ordered = [by_name[n] for n in (order or [x[0] for x in rule_order(df, rules, text)])]
    kind = pa.struct([("kept", pa.bool_()), ("rule", pa.string()), *((m, pa.int64()) for m in measures)])

    @F.arrow_udf("struct<kept boolean, rule string" + "".join(f", {m}: bigint" for m in measures) + ">")
    def judge(column: pa.Array) -> pa.Array:
        rows = []
        for raw in utf8(column):
            t = Text(raw)
            failed = next((r.name for r in ordered if r.rejects(t)), None)
            rows.append({"kept": failed is None, "rule": failed, **{m: t.get(m) for m in measures}})
        return pa.array(rows, kind)

    return df.withColumn(out, judge(F.col(text)))
