"""Toxicity scores after noisy-channel deobfuscation.

Obfuscated spans (leetspeak, letters set apart, letters repeated, letters of other scripts
that look like Latin ones, invisible characters inside words) become lattices:
each seen character offers the letters it may stand for, or nothing, at a channel
cost.  Viterbi finds the best path under a character trigram model, whose counts
come from all texts.  Tokens of any length are decoded, also those of digits and symbols
only, and so are three and more single characters in a row.  The restored words are then scored with a lexicon learned
from labelled rows.

* Trigrams: 28 symbols (a-z, other letters, boundary), counted over every text and
  summed by Spark; the model has 28**3 numbers at any corpus size.
* Lexicon: whole words and word beginnings that labelled toxic texts use
  significantly more often (likelihood ratio ``MIN_G2``), chosen one after the other
  and weighed by logistic regression.  It is fitted on at most ``SAMPLE`` = (toxic,
  other) labelled rows, chosen by hash of the id; all rows are scored.
* Score: the regression's probability for the distinct words of a text.

Null and empty texts score like a text without toxic words.  Of rows that repeat an id
the one with the least text is learned from, with each label that the id has; labels
that are null do not count.  Without toxic labels the lexicon is
empty and every score is the share of toxic labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealwise.llm.common import checked_broadcast, hash_sample, small_batches, stored, utf8

SAMPLE = (2000, 4000)
MIN_G2 = 24.0
MIN_PRECISION = 0.3
#: Precision from which a feature explains its texts alone.
SURE = 0.9
#: Share of the toxic texts from which a sure feature is taken whatever others explain.
COMMON = 0.03
RIDGE = 0.02
#: A feature counts at most so many distinct words of a text.
MOST = 3

# The letters that a character commonly stands for in leetspeak.
LEET = {"4": "a", "@": "a", "8": "b", "(": "c", "3": "e", "€": "e", "6": "g", "9": "g", "#": "h", "1": "il",
        "!": "il", "|": "il", "0": "o", "5": "s", "$": "s", "7": "t", "+": "t", "2": "z"}
SEPARATORS = ".-_* /"
# Cyrillic and Greek lower-case letters that look like a Latin one.
LOOKALIKES = {"а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o",
              "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
              "ρ": "p", "τ": "t", "υ": "u"}
# Soft hyphen, zero-width space, non-joiner and joiner, word joiner, byte order mark.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Channel costs in nats.
SWAP, DROP_REPEAT, DROP_SEPARATOR, KEEP_SEPARATOR = 0.5, 0.3, 0.1, 2.5

SYMBOLS = 28
_OTHER = 27
_CLASS = bytes(b - 96 if 97 <= b <= 122 else b - 64 if 65 <= b <= 90 else _OTHER if b >= 128 else 0 for b in range(256))

_TAIL = re.compile(r"(?:([^\w\s])\1\1+|[.,;:!?\"')\]}>])+$")
_HEAD = re.compile(r"^(?:([^\w\s])\1\1+|[.,;:\"'(\[{<])+")
_APART = re.compile(r" (\S(?: \S){2,})(?!\S)")
_LONG_RUN = re.compile(r"([^\W\d_])\1{3,}")
_REPEAT = re.compile(r"([^\W\d_])\1\1")
_DOTTED = re.compile(r"\w(?:[.\-_*/]\w){2,}")
_LEETISH = re.compile("[" + re.escape("".join(LEET)) + "]")
_SYMBOLS_ONLY = re.compile("[" + re.escape("".join(LEET) + SEPARATORS) + "]+")
_LETTER = re.compile(r"[^\W\d_]")
_LATIN = re.compile("[a-z]")
_HIDDEN = re.compile("[" + "".join(LOOKALIKES) + INVISIBLE + "]")


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else _OTHER if c.isalpha() else 0


class CharModel:
    """Interpolated character trigrams."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
        p1 = (uni + 1) / (uni.sum() + SYMBOLS)
        p2 = (bi + 2 * p1) / (bi.sum(axis=1, keepdims=True) + 2)
        p3 = (tri + 2 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 2)
        self.cost = (-np.log(p3)).ravel().tolist()
        self.known: dict[str, str] = {}

    def restore(self, seen: str) -> str:
        """The best reading of ``seen``: letters, and a space where a word ends."""
        if len(seen) > 64:
            return self._decoded(seen)
        if seen not in self.known:
            if len(self.known) > 100_000:  # a cache: bounded
                self.known = {}
            self.known[seen] = self._decoded(seen)
        return self.known[seen]

    def _decoded(self, seen: str) -> str:
        # (last two symbols) -> (cost, text); a boundary is not repeated
        states = {(0, 0): (0.0, "")}
        run, done = 0, []
        for i, c in enumerate(seen):
            if i % 64 == 63:  # what all paths share is settled: time and memory stay linear
                shared = commonprefix([text for _, text in states.values()])
                done.append(shared)
                states = {key: (cost, text[len(shared):]) for key, (cost, text) in states.items()}
            run = run + 1 if i and c == seen[i - 1] else 1
            long_run = run > 1 and (run > 2 or seen[i + 1:i + 2] == c)
            options: list[tuple[str, float]] = []
            if c.isalpha():
                options.append((c, 0.0))
                if c in LOOKALIKES:
                    options.append((LOOKALIKES[c], SWAP))
                if long_run:
                    options.append(("", DROP_REPEAT))
            else:
                options += [(x, SWAP) for x in LEET.get(c, "")]
                if c in INVISIBLE:
                    options.append(("", 0.0))
                elif c in SEPARATORS:
                    options += [("", DROP_SEPARATOR), (" ", KEEP_SEPARATOR)]
                elif c not in LEET:
                    options.append((" ", 0.0))
            new: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (cost, text) in states.items():
                for out, extra in options:
                    if not out:
                        key, total, grown = (a, b), cost + extra, text
                    else:
                        s = _symbol(out)
                        key, total, grown = (b, s), cost + extra + self.cost[(a * SYMBOLS + b) * SYMBOLS + s], text + out
                    if key not in new or total < new[key][0]:
                        new[key] = (total, grown)
            states = new
        best = min((cost + self.cost[(a * SYMBOLS + b) * SYMBOLS], text) for (a, b), (cost, text) in states.items())[1]
        return "".join([*done, best])


def char_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts over all texts; what reaches the driver is one number per trigram."""
    small_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in batches:
            raw = b" ".join([b" ", *utf8(batch.column(0)), b" "]).translate(_CLASS)
            s = np.frombuffer(raw, np.uint8)
            s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))].astype(np.int32)  # one boundary between words
            s = np.concatenate(([0], s))
            if len(s) > 2:
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS ** 3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(total[some])], ["gram", "n"])

    rows = (df.select(F.col(text).alias("text")).mapInArrow(count, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(SYMBOLS ** 3, np.int64)
    for r in rows:
        counts[r["gram"]] = r["n"]
    return counts


def obfuscated(token: str) -> str | None:
    """The part of a lower-case token that needs decoding, or None."""
    core = _TAIL.sub("", _HEAD.sub("", token))
    if not _LETTER.search(token):  # digits and symbols only; a run at the end may be letters too
        core = token.lstrip(".,;:\"'([{<").rstrip(".,;:!?\"')]}>")
        return core if _SYMBOLS_ONLY.fullmatch(core) and len(set(core) & LEET.keys()) > 1 else None
    if not core:
        return None
    core = _LONG_RUN.sub(r"\1\1\1", core)  # else a long run outweighs the rest of its word
    if core.isalpha():
        return core if _REPEAT.search(core) or _disguised(core) else None
    if _LETTER.search(core) and (_LEETISH.search(core) or _REPEAT.search(core) or _DOTTED.fullmatch(core) or _disguised(core)):
        return core
    return None


def _disguised(core: str) -> bool:
    """Whether Latin letters stand beside look-alikes of other scripts or invisible characters;
    words wholly of another script are none."""
    return not core.isascii() and _HIDDEN.search(core) is not None and _LATIN.search(core) is not None


def words_of(token: str, model: CharModel) -> list[str]:
    """Plain words of a lower-case token after restoring; an obfuscated token also keeps its plain reading."""
    plain = re.findall(r"[^\W\d_]+", token)
    core = obfuscated(token)
    return plain if core is None else [*plain, *model.restore(core).split()]


def features(word: str) -> list[str]:
    """The whole word (marked) and its beginnings of 3 to 8 letters."""
    return [word + "|", *[word[:k] for k in range(3, min(8, len(word)) + 1)]]


def _tokens(text: str) -> tuple[set[str], list[str]]:
    """Distinct lower-case tokens, and spans of single characters set apart."""
    low = text.lower()
    return set(low.split()), [m[1] for m in _APART.finditer(" " + " ".join(low.split()))] if " " in low else []


class Lexicon:
    """Logistic regression over how many distinct words of a text show each feature."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.index = {f: k for k, f in enumerate(weights)}
        self.weights = list(weights.values())
        self.bias = bias

    def shown(self, words: list[str]) -> list[int]:
        """Features that any reading of a token shows."""
        index = self.index
        return sorted({index[f] for w in words for f in features(w) if f in index})

    def score(self, tokens: list[list[int]]) -> float:
        counts = Counter(k for shown in tokens for k in shown)
        z = self.bias + sum(self.weights[k] * min(n, MOST) for k, n in sorted(counts.items()))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def _g2(tox: np.ndarray, rest: np.ndarray, n_tox: int, n_rest: int) -> np.ndarray:
    """Likelihood ratio of a feature's share in toxic and in other texts."""
    def entropy(k, n):
        k = np.asarray(k, float)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(k > 0, k * np.log(k / n), 0) + np.where(k < n, (n - k) * np.log((n - k) / n), 0)
    return 2 * (entropy(tox, n_tox) + entropy(rest, n_rest) - entropy(tox + rest, n_tox + n_rest))


def _select(x: np.ndarray, toxic: np.ndarray, share: float) -> list[int]:
    """Columns of ``x`` (texts by features, counts): first the sure ones that many toxic
    texts show, then each that is significant in the texts without a sure one; so words
    that merely travel with toxic ones stay out."""
    has = x > 0
    left, open_, chosen = np.ones(len(x), bool), np.ones(x.shape[1], bool), []
    n_tox, n_rest = int(toxic.sum()), int((~toxic).sum())
    common = has[toxic].mean(axis=0) >= COMMON
    while open_.any():
        rows = np.ones(len(x), bool) if common.any() else left
        tox, rest = has[rows & toxic].sum(axis=0), has[rows & ~toxic].sum(axis=0)
        a, b = share * tox / n_tox, (1 - share) * (rest + 0.5) / n_rest
        precision = a / (a + b)
        fits = open_ & (common & (precision >= SURE) if common.any() else precision >= MIN_PRECISION)
        g2 = np.where(fits, _g2(tox, rest, n_tox, n_rest), 0)
        k = int(g2.argmax())
        if g2[k] < MIN_G2:
            if not common.any():
                break
            common[:] = False
            continue
        chosen.append(k)
        if precision[k] >= SURE:
            left &= ~has[:, k]
        both, one = (has & has[:, [k]]).sum(axis=0), has.sum(axis=0)
        open_ &= both < 0.8 * (one + one[k] - both)  # another form of the same words
    return chosen


def _regress(x: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Weights and bias by Newton steps; classes weigh as among all labelled rows."""
    x = np.concatenate((np.minimum(x, MOST), np.ones((len(x), 1))), axis=1).astype(float)
    weight = np.where(toxic, share / max(toxic.sum(), 1), (1 - share) / max((~toxic).sum(), 1)) * len(x)
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + ridge * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_lexicon(df: DataFrame, labels: DataFrame, model: CharModel, doc_id: str, text: str,
                sample: tuple[int, int] = SAMPLE) -> Lexicon:
    """Lexicon from the rows of ``labels`` (id, toxic), which must be training rows."""
    known = labels.where("toxic is not null and id is not null")
    n = {bool(r["y"]): r["n"] for r in known.groupBy((F.col("toxic") == 1).alias("y")).agg(F.count("*").alias("n")).collect()}
    share = n.get(True, 0) / max(sum(n.values()), 1)
    none = Lexicon({}, math.log((share + 1e-3) / (1 - share + 1e-3)))
    chosen = (hash_sample(known.where("toxic = 1"), sample[0], ["id"], n.get(True, 0))
              .union(hash_sample(known.where("toxic <> 1"), sample[1], ["id"], n.get(False, 0))))
    chosen = checked_broadcast(chosen.withColumnRenamed("id", "label_id"), sum(sample))
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(chosen, F.col("id") == F.col("label_id"))
    # one text a label: rows that repeat an id must not swell the sample
    rows = rows.groupBy("id", "toxic").agg(F.min("text").alias("text"))
    rows = stored(rows.select("text", "toxic"), "toxic-sample")

    def words(body: str | None) -> set[str]:
        tokens, apart = _tokens(body or "")
        return {w for t in tokens for w in words_of(t, model)} | {w for s in apart for w in model.restore(s).split()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for body, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = hits[1 if toxic == 1 else 0]
                own.update({f for w in words(body) for f in features(w)})
                own[""] += 1  # texts
        names = list(hits[0].keys() | hits[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([hits[1][f] for f in names], pa.int64()),
                                          pa.array([hits[0][f] for f in names], pa.int64())], ["f", "tox", "rest"])

    sums = (rows.mapInArrow(count, "f string, tox long, rest long")
            .groupBy("f").agg(F.sum("tox").alias("tox"), F.sum("rest").alias("rest")))
    found = {r["f"]: (r["tox"], r["rest"]) for r in sums.where("f = '' or (tox >= 3 and tox > rest / 20)").collect()}
    n_tox, n_rest = found.pop("", (0, 0))
    if not n_tox or not n_rest or not found:
        return none
    tox, rest = np.array(list(found.values())).T
    a, b = share * tox / n_tox, (1 - share) * (rest + 0.5) / n_rest
    good = (_g2(tox, rest, n_tox, n_rest) >= MIN_G2) & (a / (a + b) >= MIN_PRECISION)
    # of beginnings that fit alike the longest comes first
    names = sorted((f for f, ok in zip(found, good.tolist()) if ok), key=lambda f: (-len(f), f))
    if not names:
        return none
    every = Lexicon(dict.fromkeys(names, 0.0), 0.0)

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [Counter(k for w in words(body) for k in every.shown([w])) for body in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([t == 1 for t in batch.column(1).to_pylist()], pa.bool_()),
                pa.array([list(c.keys()) for c in seen], pa.list_(pa.int32())),
                pa.array([list(c.values()) for c in seen], pa.list_(pa.int32()))], ["toxic", "k", "n"])

    # the sample's bound is that of what is collected here
    shown = sorted(tuple(r) for r in rows.mapInArrow(show, "toxic boolean, k array<int>, n array<int>").collect())
    x, toxic = np.zeros((len(shown), len(names)), np.int16), np.array([r[0] for r in shown])
    for i, (_, ks, ns) in enumerate(shown):
        x[i, ks] = ns
    chosen_features = _select(x, toxic, share)
    if not chosen_features:
        return none
    w = _regress(x[:, chosen_features], toxic, share)
    return Lexicon({names[k]: float(v) for k, v in zip(chosen_features, w)}, float(w[-1]))


def toxicity(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
             label_id: str = "doc_id", out: str = "toxicity", sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """Add the struct column ``out``: ``score`` (0 to 1) and ``restored`` (decoded spans
    that read differently: ``seen``, ``read``).

    ``labels`` are the labelled rows to learn from.  Rows, repeats and other columns
    stay; a column already named ``out`` is replaced.
    """
    small_batches(df.sparkSession)
    model = CharModel(char_counts(df, text))
    known = labels.select(F.col(label_id).alias("id"), F.col(label).alias("toxic"))
    lexicon = fit_lexicon(df, known, model, doc_id, text, sample)
    pair = pa.struct([("seen", pa.string()), ("read", pa.string())])
    kind = pa.struct([("score", pa.float64()), ("restored", pa.list_(pair))])

    @F.arrow_udf("struct<score double, restored array<struct<seen string, read string>>>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: set[str] = set()
        toxic: dict[str, list[int]] = {}
        read: dict[str, str] = {}
        for column in batches:
            if len(seen) > 300_000:  # caches: bounded
                seen, toxic, read = set(), {}, {}
            rows = []
            for body in column.to_pylist():
                tokens, apart = _tokens(body or "")
                for token in tokens - seen:
                    if shown := lexicon.shown(words_of(token, model)):
                        toxic[token] = shown
                    core = obfuscated(token)
                    if core is not None and (best := model.restore(core)) != core:
                        read[token] = best
                seen |= tokens
                changed = [{"seen": t, "read": read[t]} for t in sorted(read.keys() & tokens)]
                evidence = {t: toxic[t] for t in toxic.keys() & tokens}
                for span in apart:
                    best = model.restore(span)
                    changed.append({"seen": span, "read": best})
                    evidence[best] = lexicon.shown(best.split())
                rows.append({"score": lexicon.score(list(evidence.values())), "restored": changed})
            yield pa.array(rows, kind)

    return df.withColumn(out, score(F.col(text)))
