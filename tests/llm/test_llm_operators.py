"""Operators against brute force, round trips and edge cases."""

import hashlib
import itertools
import math
import random
import re
import textwrap

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dealwise.llm import chat, common, components, decontaminate, html, licenses, mix, neardups, quality, shard, substrings, toxicity

DOCS = "doc_id long, text string, source string, quality string, n_words string"
#: Nulls, empties, ties, repeats, a long text, and columns named like results.
EDGE = [
    (1, "a b c d e f g h i j k l m n", "s", "x", "y"), (2, None, None, None, None), (3, "", "s", "", ""),
    (4, "one", "s", "x", "y"), (4, "one", "s", "x", "y"), (None, "lost id with some words in it to count", "s", "x", "y"),
    (5, "\n\n \t", "t", "x", "y"), (6, "é" * 50 + " \U0001F600 zz", "t", "x", "y"),
    (7, " ".join(f"w{i}" for i in range(60_000)), "t", "x", "y"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_text(rng, n, vocab=40):
    return " ".join(f"v{rng.randrange(vocab)}" for _ in range(n))


# ------------------------------------------------------------------ 9

def test_quality_edges(edge, empty):
    out = quality.quality_cascade(edge, measures=("n_words", "n_repeat_words"))
    assert out.columns == edge.columns  # the clashing name is replaced in its place
    rows = out.select("doc_id", "quality.*").collect()
    assert len(rows) == len(EDGE)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["rule"] == "word_length" and by[7]["kept"] and by[7]["n_words"] == 60_000
    assert by[2]["rule"] is not None and not by[3]["kept"] and by[2]["n_words"] == 0
    assert quality.quality_cascade(empty).count() == 0


def test_quality_order_never_changes_the_verdict(edge):
    names = [r.name for r in quality.RULES]
    verdicts = {tuple(r["kept"] for r in quality.quality_cascade(edge, order=o).select("quality.kept").collect())
                for o in (names, names[::-1])}
    assert len(verdicts) == 1


def test_rule_order_puts_cheap_rejection_first(spark):
    slow = quality.Rule("slow", lambda t: sum(range(20_000)) < 0)
    fast = quality.Rule("fast", lambda t: t.get("n_words") < 100)
    df = spark.range(400).select(F.concat(F.lit("text "), F.col("id")).alias("text"))
    assert [r[0] for r in quality.rule_order(df, (slow, fast))] == ["fast", "slow"]


def test_repeat_words_brute():
    rng = random.Random(3)
    for _ in range(200):
        words = words_text(rng, rng.randrange(0, 60), 3).split()
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        cover = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        assert quality._repeat_words([w.encode() for w in words]) == len(cover)


# ------------------------------------------------------------------ 4

def test_decontaminate_offsets_and_edges(spark, edge, empty):
    bench = spark.createDataFrame([(10, "The QUICK brown, fox!"), (None, "quick brown"), (11, None), (12, "?!")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, "É the-quick (Brown) fox jumps", 0), (2, None, 0)], "doc_id long, text string, hits int")
    rows = {r["doc_id"]: r["hits"] for r in decontaminate.benchmark_hits(docs, bench, window=3).collect()}
    assert rows[2]["n_hit"] == 0 and rows[2]["items"] == []
    hit = rows[1]
    assert (hit["n_words"], hit["n_hit"], hit["items"]) == (6, 4, ["", "10"])
    (span,) = hit["spans"]
    assert "É the-quick (Brown) fox jumps"[span["start"]:span["end"]] == "the-quick (Brown) fox"
    assert decontaminate.benchmark_hits(edge, bench).count() == len(EDGE)
    assert decontaminate.benchmark_hits(empty, bench).count() == 0
    assert decontaminate.benchmark_hits(edge, bench.limit(0)).where("hits.n_hit > 0").count() == 0


def test_decontaminate_in_blocks_is_the_same(spark, monkeypatch):
    rng = random.Random(1)
    items = [(i, words_text(rng, 25, 30)) for i in range(30)]
    docs = spark.createDataFrame([(i, words_text(rng, 80, 30)) for i in range(40)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.benchmark_hits(docs, bench, window=3).orderBy("doc_id").collect()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 700)
    assert decontaminate.benchmark_hits(docs, bench, window=3).orderBy("doc_id").collect() == whole


def test_decontaminate_builds_once_a_worker(monkeypatch):
    built = []

    class Counted(decontaminate.Automaton):
        def __init__(self, items, window):
            built.append(len(items))
            super().__init__(items, window)

    rng = random.Random(5)
    items = [(str(i), [b"%d" % rng.randrange(50) for _ in range(30)]) for i in range(40)]
    texts = [pa.array([" ".join(str(rng.randrange(50)) for _ in range(200)) for _ in range(20)]) for _ in range(30)]
    batches = [(t, pa.nulls(20, pa.list_(pa.int32())), pa.nulls(20, pa.list_(pa.string()))) for t in texts]
    monkeypatch.setattr(decontaminate, "Automaton", Counted)
    decontaminate._held.clear()
    udf = decontaminate._hits_udf(items, 2)
    whole = [list(udf.func(iter(batches))) for _ in range(3)][0]  # three tasks of one process
    assert built == [40]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1000)
    del built[:]
    parts = list(decontaminate._hits_udf(items, 2).func(iter(batches)))
    assert 1 < len(built) < 10 and [p.to_pylist() for p in parts] == [w.to_pylist() for w in whole]
    decontaminate._held.clear()


def test_decontaminate_pieces_hold_every_window():
    rng = random.Random(6)
    for n in range(40):
        words = [b"x" * rng.randrange(1, 9) for _ in range(n)]
        words = [w + b"%d" % i for i, w in enumerate(words)]
        for window, size in ((1, 1), (3, 1), (3, 40), (10, 60), (50, 7)):
            def windows(seq):
                k = min(window, len(seq))
                return {tuple(seq[i:i + k]) for i in range(len(seq) - k + 1)} if seq else set()
            pieces = list(decontaminate._pieces(words, window, size))
            assert set().union(*map(windows, pieces)) == windows(words) if words else not pieces


# ------------------------------------------------------------------ 3

def test_substrings_brute(spark):
    rng = random.Random(7)
    texts = [words_text(rng, rng.randrange(0, 60), 200) for _ in range(60)]
    shared = words_text(rng, 12, 200)
    texts += [words_text(rng, 5) + " " + shared + " " + words_text(rng, 5) for _ in range(5)]
    texts += ["r " * 30, texts[0], None, "", "x y " * 20]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    size, seen = 7, {}
    split = [(t or "").split() for t in texts]
    for d, ws in enumerate(split):
        for i in range(len(ws) - size + 1):
            seen.setdefault(tuple(ws[i:i + size]), []).append((d, i))
    gone = {(d, i + k) for at in seen.values() if len(at) > 1 for d, i in at for k in range(size)}
    want = sorted((len(ws), " ".join(w for i, w in enumerate(ws) if (d, i) not in gone)) for d, ws in enumerate(split))
    rows = substrings.remove_repeats(docs, window=size, phrase=3).collect()
    assert sorted((r["n_words"], r["kept"]) for r in rows) == want
    assert all(r["n_removed"] == sum(x["end"] - x["start"] for x in r["removed"]) for r in rows)


def test_substrings_hot_phrase_brute(spark, monkeypatch):
    """A phrase with more windows than one mask confirms, in several blocks."""
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 2000)
    rng = random.Random(8)
    texts = [words_text(rng, 150, 12) for _ in range(12)]
    size, seen = 3, {}
    split = [t.split() for t in texts]
    for d, ws in enumerate(split):
        for i in range(len(ws) - size + 1):
            seen.setdefault(tuple(ws[i:i + size]), []).append((d, i))
    gone = {(d, i + k) for at in seen.values() if len(at) > 1 for d, i in at for k in range(size)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["kept"] for r in substrings.remove_repeats(docs, window=size, phrase=1).collect()}
    assert got == {d: " ".join(w for i, w in enumerate(ws) if (d, i) not in gone) for d, ws in enumerate(split)}
    assert len(seen) > 12 * substrings.BITS  # of twelve phrases one has more


def test_substrings_are_located_by_the_automaton():
    block = substrings.Block([b"a b c d e f g x a b c d e f g", b"h i j k l m n"], 5, 2)
    key, _, _, number, start = block.windows(np.flatnonzero(block.valid))
    spelled = block.spelled(start)
    masks = np.full(len(key), (1 << substrings.BITS) - 1, np.int64)
    parts = number // substrings.BITS
    assert block.covered(spelled, key, parts, masks).all()
    # a phrase that the automaton does not hold hides its windows, whatever is confirmed
    without = [b"no phrase" for _ in spelled]
    assert not block.covered(without, key, parts, masks).any()
    one = block.covered(spelled[:1], key[:1], parts[:1], masks[:1])
    assert one.any() and not one.all()


def test_substrings_edges(edge, empty):
    rows = {r["doc_id"]: r for r in substrings.remove_repeats(edge).collect()}
    assert rows[2]["n_words"] == 0 and rows[2]["kept"] == "" and rows[7]["n_removed"] == 0
    assert substrings.remove_repeats(empty).count() == 0


# ------------------------------------------------------------------ 7

def jaccard_classes(texts):
    sets = {}
    for i, t in texts.items():
        ws = (t or "").split()
        k = min(5, len(ws))
        sets[i] = {tuple(ws[j:j + k]) for j in range(len(ws) - k + 1)} if ws else set()
    ids = sorted(sets)
    links = {i: [j for j in ids if j != i and sets[i] and sets[j]
                 and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in ids}
    out = {}
    for i in ids:
        group, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        out[i] = (min(group), len(links[i]))
    return out


def test_neardups_brute(spark, monkeypatch):
    monkeypatch.setattr(neardups, "CHUNK", 16)  # the chunked way too
    rng = random.Random(11)
    texts = {}
    for base in range(6):
        words = words_text(rng, 120, 5000).split()
        for _ in range(25):
            own = list(words)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(own)
    texts[len(texts)] = None
    texts[len(texts)] = ""
    texts[len(texts)] = texts[0]
    texts[len(texts)] = "two words"
    texts[len(texts)] = "two  words"
    # repeated rows, one id with several texts, copies and near copies without an id
    rows = [*texts.items(), (3, texts[3]), (4, texts[30]), (4, "another text"), (None, "no id"), (None, "no id"),
            (None, texts[60]), (None, None)]
    found = jaccard_classes(dict(enumerate(t for _, t in rows)))
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[found[n][0]] = min(least.get(found[n][0], i), i)
    want = [(i, least.get(found[n][0]), found[n][1]) for n, (i, _) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(repr, map(tuple, neardups.near_duplicates(docs).collect()))) == sorted(map(repr, want))


def test_chunks_are_dealt_without_a_window(spark, monkeypatch):
    """A group is counted and dealt by hash; every pair of its rows meets in one chunk pair."""
    rows = spark.range(500).select("id", F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("key"))
    out = neardups._chunked(rows, "key", 64)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    met = {}
    for r in out.collect():
        met.setdefault((r["a"], r["b"]), set()).add(r["id"])
    assert {i for ids in met.values() for i in ids} == set(range(400))
    pairs = {(x, y) for ids in met.values() for x in ids for y in ids if x < y}
    assert len(pairs) == 400 * 399 // 2


def test_neardups_meets_pairs_at_the_threshold(spark):
    """Many pairs close to the threshold beside many closer ones: none may be lost to the average."""
    rng = random.Random(12)
    rows = []
    for pair in range(4000):
        words = [f"p{pair}w{i}" for i in range(104)]
        own = list(words)
        if pair < 1000:  # 100 shingles of each, 89 in both: 89 / 111 = 0.80
            own[-11:] = [f"p{pair}x{i}" for i in range(11)]
        else:
            own[-5:] = [f"p{pair}x{i}" for i in range(5)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(own))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["n_links"] for r in neardups.near_duplicates(docs).collect()}
    lost = sum(got[2 * pair] == 0 for pair in range(1000))
    assert lost <= 4 and all(got[2 * pair] == 1 for pair in range(1000, 4000)), lost
    worst = 1 - (1 - 0.8 ** neardups.prefix_depth()) ** neardups.TREES
    assert worst >= neardups.RECALL and neardups.prefix_depth(0.98) == neardups.DEPTH and neardups.prefix_depth(1.0) == 1


def test_neardups_edges(edge, empty):
    rows = sorted(((r["doc_id"] or 0, r["class_id"], r["n_links"]) for r in neardups.near_duplicates(edge).collect()))
    assert rows == [(0, None, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (4, 4, 1), (5, 5, 0), (6, 6, 0), (7, 7, 0)]
    assert neardups.near_duplicates(empty).count() == 0


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    assert got == {x: root(x) for a, b in pairs if a != b for x in (a, b)}


# ------------------------------------------------------------------ 2

def test_chat_round_trip(spark):
    rng = random.Random(2)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "<\\\\/s>", "[\\INST]", "\\", "\n", "é", "<", "[", "/s>", "ok ", "$1"]
    rows = [(c, t if t < 5 else None, rng.choice(["user", "assistant", None, "[/INST]", "a</s>"]),
             rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randrange(12)))]))
            for c in [*range(40), None] for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df).withColumn("turns", chat.parse(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("formatted"), F.col("spans"))).collect()
    assert len(out) == 41
    for r in out:
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"]))
        assert [(x["role"], x["text"]) for x in r["turns"]] == [(a, b) for _, _, a, b in own]
        assert r["identical"] and r["loss"] == "".join(b for _, _, a, b in own if a == "assistant")
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_leaves_no_bare_control_string(spark):
    rows = [(k, 0, role, text) for k, (role, text) in enumerate([
        ("user", "[INST] a"), ("user", "a [/INST] b"), ("user", "<s>"), ("user", "</s>"), ("<s>", "a"), ("[INST]", "b"),
        ("user", "plain < [ text"), ("user", "<\\s>")])]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for r in out:
        assert r["identical"]
        assert [r["formatted"].count(c) for c in ("<s>", "[INST]", "[/INST]", "</s>")] == [1, 1, 1, 1], r["formatted"]


# ------------------------------------------------------------------ 6

def test_licenses(spark, edge, empty):
    mit = licenses.TEMPLATES["MIT"]
    df = spark.createDataFrame([(1, "text\nReleased under the MIT License\nmore"), (2, mit.replace("Software", "Program")),
                                (3, None), (4, "nothing of the kind is here")], "doc_id long, text string")
    rows = {(r["doc_id"], r["line"], r["license"]) for r in licenses.license_matches(df).collect()}
    assert (1, 1, "MIT-released") in rows and (2, 0, "MIT") in rows and not {d for d, _, _ in rows} & {3, 4}
    assert licenses.license_matches(edge).count() == 0 and licenses.license_matches(empty).count() == 0


def test_license_bounds_lose_nothing(spark):
    rng = random.Random(4)
    words = re.findall(licenses.WORD, licenses.TEMPLATES["Apache-2.0-notice"].lower())
    texts = [" ".join(w for w in words if rng.random() > p) for p in np.linspace(0, 0.4, 40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["license"]) for r in licenses.license_matches(df).where("line = 0").collect()}
    want = set()
    for i, t in enumerate(texts):
        own = set(licenses.template_bigrams({"x": t})["x"])
        for name, grams in licenses.template_bigrams(licenses.TEMPLATES).items():
            if own and 2 * len(own & set(grams)) / (len(own) + len(grams)) >= licenses.THRESHOLD:
                want.add((i, name))
    assert got == want and want


def test_license_at_the_size_bound(spark):
    df = spark.createDataFrame([(1, "All rights reserved here")], "doc_id long, text string")
    assert [tuple(r) for r in licenses.license_matches(df).collect()] == [(1, 0, "ARR", 0.8)]


def test_license_passages(spark, edge, empty):
    rng = random.Random(13)
    wrap = lambda name: "\n".join(textwrap.wrap(licenses.TEMPLATES[name], 78))
    prose = lambda n: words_text(rng, n, 300)
    docs = {k: f"{prose(80)}\n{prose(9)}\n{wrap(name)}\n{prose(90)}" for k, name in enumerate(
        ["MIT", "ISC", "GPL-3.0-notice", "Apache-2.0-notice"])}
    docs[4] = prose(40) + ". Licensed under the MIT License. More " + prose(40)
    docs[5] = prose(20) + "\nReleased under the MIT License.\n" + prose(20)  # a unit: not again
    docs[6] = prose(30) + " licensed software " + prose(30)
    docs[7] = prose(30) + " " + " ".join(w for w in wrap("ISC").split() if rng.random() > 0.08) + " " + prose(30)
    df = spark.createDataFrame([*docs.items(), (8, None), (None, docs[4])], "doc_id long, text string")
    got = {}
    for r in licenses.license_passages(df).collect():
        got.setdefault((r["doc_id"], r["license"]), []).append((r["line"], round(r["dice"], 6)))
    for k, name in enumerate(["MIT", "ISC", "GPL-3.0-notice", "Apache-2.0-notice"]):
        assert got[k, name] == [(2, 1.0)]
    assert got[4, "MIT-notice"] == got[None, "MIT-notice"] == [(0, 1.0)]
    assert not {d for d, _ in got} & {5, 6, 8}
    # the best of all runs, by brute force
    grams = set(licenses.template_bigrams(licenses.TEMPLATES)["ISC"])
    ws = re.findall(licenses.WORD, docs[7].lower())
    own = [f"{a} {b}" for a, b in zip(ws, ws[1:])]
    best = max(2 * len(grams & set(own[i:j])) / (len(grams) + len(set(own[i:j])))
               for i in range(len(own)) for j in range(i + 1, min(len(own), i + 200) + 1))
    assert got.get((7, "ISC")) == [(0, round(best, 6))] and best < 1
    assert licenses.license_passages(edge).count() == 0 and licenses.license_passages(empty).count() == 0


def brute_passages(text):
    """Every run from every bigram of a template; the best stays where they overlap."""
    grams, found = licenses.template_bigrams(licenses.TEMPLATES), []
    words = lambda x: re.findall(licenses.WORD, x.lower())
    pairs = lambda ws: [f"{a} {b}" for a, b in zip(ws, ws[1:])]
    dice = lambda own, other: 2 * len(set(own) & set(other)) / (len(set(own)) + len(other))
    lines = [words(x) for x in text.split("\n")]
    units = [{n for n, other in grams.items() if dice(pairs(ws), other) >= licenses.THRESHOLD} for ws in lines]
    line_of, g = [k for k, ws in enumerate(lines) for _ in ws], pairs([w for ws in lines for w in ws])
    for name, other in grams.items():
        if dice(g, other) >= licenses.THRESHOLD:
            continue
        span, runs, kept = licenses.SPAN * (len(words(licenses.TEMPLATES[name])) - 1), [], []
        for a in (k for k, x in enumerate(g) if x in other):
            ends = [b for b in range(a, min(len(g), a + span)) if g[b] in other]
            runs.append(max((dice(g[a:b + 1], other), -a, -b) for b in ends))
        for score, a, b in sorted((r for r in runs if r[0] >= licenses.THRESHOLD), reverse=True):
            if all(-a > y + 1 or x > -b + 1 for x, y in kept):
                kept.append((-a, -b))
                first, until = line_of[-a], line_of[-b + 1]
                if not any(name in u for u in units[first:until + 1]) and not (first == until and units[first]):
                    found.append((first, name, round(score, 9)))
    return found


def test_license_passages_brute(spark):
    rng = random.Random(5)
    kinds, docs = list(licenses.TEMPLATES), []
    for _ in range(40):  # several templates a text, whole, damaged and side by side, with lines cut anywhere
        parts = []
        for _ in range(rng.randint(1, 5)):
            harm = rng.choice([0, 0, 0.05, 0.15])
            parts.append(words_text(rng, rng.choice([0, 0, 1, 3, 20]), 200))
            parts.append(" ".join(w for w in licenses.TEMPLATES[rng.choice(kinds)].split() if rng.random() >= harm))
            parts.append(rng.choice(["", licenses.TEMPLATES[rng.choice(kinds)]]))
        docs.append("".join(w + rng.choice(["\n"] + [" "] * 11) for w in " ".join(parts).split()))
    docs += ["\n".join(["All rights reserved. Licensed under CC BY 4.0. x"] * 3), "All rights reserved. " * 9 + "and more", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["line"], r["license"], round(r["dice"], 9)) for r in licenses.license_passages(df).collect())
    want = sorted((k, *r) for k, text in enumerate(docs) for r in brute_passages(text))
    assert got == want and len(want) > 100


def test_license_passages_long_text(spark):
    """One text of a thousand licence lines: a thousand passages, in time that grows with its words."""
    text = "a new part. Licensed under CC BY 4.0. It goes on here\n" * 1000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert {r["line"] for r in licenses.license_passages(df).collect()} == set(range(1000))


# ------------------------------------------------------------------ 8

def least_capacity(sizes, shards):
    cap = max(max(sizes), -(-sum(sizes) // shards))
    while True:
        n, used = 1, 0
        for s in sizes:
            if used + s > cap:
                n, used = n + 1, 0
            used += s
        if n <= shards:
            return cap
        cap += 1


@pytest.mark.parametrize("hot", [False, True])
def test_shards_brute(spark, hot):
    rng = random.Random(8)
    texts = [words_text(rng, rng.randrange(0, 40), 60) for _ in range(300)] + [None, "", "same", "same"]
    texts += ["a hot text " * 3] * (200 if hot else 0)
    df = spark.createDataFrame([(i % 290, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, shard int")
    rows = [(r["text"], r["placed"]) for r in shard.shard_texts(df, 7).collect()]
    assert len(rows) == len(texts)
    groups = {}
    for t in texts:
        key = hashlib.md5((t or "").encode()).hexdigest()
        groups[key] = groups.get(key, 0) + len((t or "").encode()) + 8
    loads, slots, of = {}, {}, {}
    for text, p in rows:
        loads[p["shard"]] = loads.get(p["shard"], 0) + p["size"]
        slots.setdefault(p["shard"], []).append(p["slot"])
        assert of.setdefault(text or "", p["shard"]) == p["shard"]
    assert max(loads.values()) == least_capacity([groups[k] for k in sorted(groups)], 7)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_edges(edge, empty):
    assert shard.shard_texts(edge, 3).count() == len(EDGE)
    assert shard.shard_texts(empty, 3).count() == 0
    clash = edge.withColumnRenamed("quality", "Placed")
    assert shard.shard_texts(clash, 3).columns == [c for c in clash.columns if c != "Placed"] + ["placed"]


def test_slots_do_not_depend_on_the_run(spark, monkeypatch):
    monkeypatch.setattr(shard, "SLOT_ROWS", 7)  # several buckets a shard
    rows = [(i % 50 if i % 5 else None, f"text {i % 20}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    runs = [sorted(repr((r["doc_id"], r["text"], r["placed"]["slot"])) for r in shard.shard_texts(d, 3).collect())
            for d in (df, df.repartition(5))]
    assert runs[0] == runs[1]


# ------------------------------------------------------------------ 10

def test_mix_shares_and_edges(spark, edge, empty):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "big").otherwise("small").alias("source"),
                                    F.lit("same length").alias("text"))
    out = mix.poisson_mix(df, {"big": 0.2, "small": 0.8})
    n = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(n["small"] / sum(n.values()) - 0.8) < 0.02 and abs(sum(n.values()) / 20_000 - 1) < 0.03
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, mix.poisson_mix(df.repartition(3), {"big": 0.2, "small": 0.8}).collect()))
    large = mix.poisson_mix(df.limit(200), {"big": 1.0}, epochs=60.0).where("source = 'big'").count()
    assert abs(large / (60 * 200) - 1) < 0.1  # drawn in steps
    assert mix.poisson_mix(edge, {"s": 0.5}, copy=None).columns == edge.columns
    assert mix.poisson_mix(empty, {"s": 0.5}).count() == 0
    clash = edge.withColumnRenamed("quality", "Copy")
    assert mix.poisson_mix(clash, {"s": 0.5}).columns == [c for c in clash.columns if c != "Copy"] + ["copy"]


def test_rows_without_an_id_draw_and_spread_each_by_itself(spark):
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("one text").alias("text"),
                                  F.col("id").alias("row"))
    out = common.stored(mix.poisson_mix(df, {"s": 1.0}), "test")
    times = {r["row"]: r["n"] for r in out.groupBy("row").agg(F.count("*").alias("n")).collect()}
    assert abs(sum(times.values()) / 4000 - 1) < 0.06 and abs(len(times) / 4000 - (1 - np.exp(-1))) < 0.03
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = mix.poisson_mix(df, {"s": 1.0}).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * sum(r["count"] for r in sizes) / 8


def test_cdf():
    for mean in (0.0, 0.3, 5.0, 16.0):
        c = mix.cdf(mean)
        assert all(a <= b for a, b in zip(c, c[1:])) and abs(c[-1] - 1) < 1e-12


# ------------------------------------------------------------------ 1

def test_toxicity_restores_and_learns(spark):
    rng = random.Random(9)
    syllables = ["ra", "to", "mi", "len", "dor", "sa", "ne", "idi", "ot", "ka"]
    def prose(n):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    rows = []
    for i in range(600):
        text = prose(40)
        if i % 3 == 0:
            bad = rng.choice(["wretch", "vermin"])
            text += " " + bad if i < 540 else " " + {"wretch": "w r e t c h", "vermin": "v3rm1n"}[bad]
        rows.append((i, text + " " + prose(10)))
    docs = spark.createDataFrame([*rows, (None, None), (1000, ""), (1001, "vermiiiin")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(540)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 603
    wrong = [i for i in range(540, 600) if (got[i]["score"] >= 0.7) != (i % 3 == 0)]
    assert not wrong, [(rows[i], got[i]) for i in wrong[:3]]
    assert got[1001]["score"] >= 0.7 and {"seen": "vermiiiin", "read": "vermin"} in [x.asDict() for x in got[1001]["restored"]]
    assert got[None]["score"] < 0.7 and got[1000]["score"] == got[None]["score"]
    none = toxicity.toxicity(docs, labels.where("toxic = 0")).select("toxicity.score").distinct().collect()
    assert len(none) == 1 and none[0][0] < 0.7
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_toxicity_decodes_long_symbol_only_and_short_spaced_words(spark):
    rng = random.Random(10)
    prose = [" ".join(rng.choice(["rato", "milen", "dorsa", "neka", "tora"]) for _ in range(30)) for _ in range(400)]
    rows = [(i, t + (" " + ("ass", "wretch")[i % 2] if i % 4 < 2 else "")) for i, t in enumerate(prose)]
    odd = ["a s s", "@$$", "455", "(@$$!)", "wr" + "e" * 70 + "tch", ".".join("wretch" * 12)]
    plain = ["2024-01-05", "!!!", "x" * 80, "10.5"]
    docs = spark.createDataFrame(rows + [(1000 + k, prose[0] + " " + t) for k, t in enumerate(odd + plain)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 < 2)) for i in range(400)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxicity"]["score"] for r in toxicity.toxicity(docs, labels).where("doc_id >= 1000").collect()}
    assert [t for k, t in enumerate(odd + plain) if (got[1000 + k] >= 0.7) != (t in odd)] == []


def channel(seen):
    """What each seen character may stand for, with its cost."""
    out = []
    for i, c in enumerate(seen):
        before = len(seen[:i + 1]) - len(seen[:i + 1].rstrip(c))
        repeated = before > 2 or (before == 2 and seen[i + 1:i + 2] == c)
        if c.isalpha():
            own = [(c, 0.0)] + [(x, toxicity.SWAP) for x in toxicity.LOOKALIKES.get(c, "")]
            own += [("", toxicity.DROP_REPEAT)] if repeated else []
        else:
            own = [(x, toxicity.SWAP) for x in toxicity.LEET.get(c, "")]
            if c in toxicity.INVISIBLE:
                own += [("", 0.0)]
            elif c in toxicity.SEPARATORS:
                own += [("", toxicity.DROP_SEPARATOR), (" ", toxicity.KEEP_SEPARATOR)]
            elif not own:
                own = [(" ", 0.0)]
        out.append(own)
    return out


def reading_cost(model, text):
    syms = [0, 0, *map(toxicity._symbol, text), 0]
    return sum(model.cost[(a * 28 + b) * 28 + c] for a, b, c in zip(syms, syms[1:], syms[2:]))


def test_toxicity_viterbi_against_every_path():
    """Every path of small lattices is walked; the decoder's reading costs no more than the best."""
    rng = random.Random(12)
    several = 0
    for case in range(150):
        model = toxicity.CharModel(np.random.default_rng(case).integers(0, 50, toxicity.SYMBOLS ** 3))
        seen = "".join(rng.choice("aab1!@$.-* ιо\u200b?é") * rng.choice((1, 1, 1, 3)) for _ in range(rng.randrange(1, 6)))
        best = {}
        for path in itertools.product(*channel(seen)):
            text = "".join(x for x, _ in path)
            best[text] = min(best.get(text, math.inf), sum(c for _, c in path) + reading_cost(model, text))
        several += len(best) > 8
        assert best[model.restore(seen)] == pytest.approx(min(best.values()), abs=1e-9), seen
    assert several > 40


def test_toxicity_long_tokens_read_like_their_whole_lattice():
    rng = random.Random(13)
    for case in range(20):
        model = toxicity.CharModel(np.random.default_rng(case).integers(0, 50, toxicity.SYMBOLS ** 3))
        seen = "".join(rng.choice("ab1!@.-ι?") * rng.choice((1, 1, 3)) for _ in range(rng.choice((40, 64, 65, 300))))
        # all texts of the lattice kept whole, nothing settled on the way
        states = {(0, 0): (0.0, "")}
        for own in channel(seen):
            new = {}
            for (a, b), (cost, text) in states.items():
                for x, extra in own:
                    s = toxicity._symbol(x) if x else None
                    key = (b, s) if x else (a, b)
                    total = cost + extra + (model.cost[(a * 28 + b) * 28 + s] if x else 0.0)
                    if key not in new or total < new[key][0]:
                        new[key] = (total, text + x)
            states = new
        best = min((cost + model.cost[(a * 28 + b) * 28], text) for (a, b), (cost, text) in states.items())
        assert model.restore(seen) == best[1]


def test_toxicity_reads_lookalikes_and_invisible_characters(spark):
    rng = random.Random(14)
    prose = [" ".join(rng.choice(["rato", "milen", "dorsa", "neka", "tora", "wreath", "pitch"]) for _ in range(30)) for _ in range(400)]
    rows = [(i, t + (" wretch" if i % 4 < 2 else "")) for i, t in enumerate(prose)]
    odd = ["wrеtch", "wre\u200btch", "w\u00adr\u200de\u2060tch", "WRΕTCH", "wretсh,"]
    plain = ["теска", "μετρο", "na\u200cmeh", "\U0001F468\u200d\U0001F467"]
    docs = spark.createDataFrame(rows + [(1000 + k, prose[0] + " " + t) for k, t in enumerate(odd + plain)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 < 2)) for i in range(400)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxicity"]["score"] for r in toxicity.toxicity(docs, labels).where("doc_id >= 1000").collect()}
    assert [t for k, t in enumerate(odd + plain) if (got[1000 + k] >= 0.7) != (t in odd)] == []


def test_toxicity_held_out(spark):
    from dealwise.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op1_toxicity"](spark, sf).where("held_out").collect()}
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in got}
    hits = sum(got[i]["predicted"] == 1 and t == 1 for i, t in truth.items())
    false = sum(got[i]["predicted"] == 1 and t == 0 for i, t in truth.items())
    assert hits >= 0.6 * sum(truth.values()) and false <= 0.05 * len(truth)


# ------------------------------------------------------------------ 5

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy now.</div>
<{tag}><h1>Head &amp; tail</h1><p>First   line<br>goes on &lt;here&gt;, with more words to read.
<p><b>Second paragraph, unclosed, is also quite long and has a <a href="/c">link</a> in it.
<p>Third one, as long as the others and with a comma, or two.</p></{tag}>
<section id="comments"><h2>Comments</h2><p>Nice!</p><p>I agree with that, more or less.</p></section><footer>&copy; x</footer>"""
WANT = ("Head & tail\nFirst line goes on <here>, with more words to read.\nSecond paragraph, unclosed, is also quite long "
        "and has a link in it.\nThird one, as long as the others and with a comma, or two.")


def test_html_extracts_and_survives(spark):
    given = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    odd = ["", "plain words only", "<", "<p", "</p></p>", "<div class='x' <p>a<b", "<!-- open", "<script>x"]
    pages = [PAGE.format(tag=t) for t in ("article", "main")] + given + odd
    df = spark.createDataFrame([(i, f"u{i}", p, "x") for i, p in enumerate([*pages, None])], "page_id long, url string, html string, main string")
    got = {r["page_id"]: r["main"]["text"] for r in html.main_text(df).collect()}
    assert got[0] == WANT and got[1] == WANT
    assert got[len(pages)] == "" and len(got) == len(pages) + 1
    for i, p in enumerate(given):
        m = re.search(r"<article>(.*)</article>", p, re.S)
        want = [re.sub(r"\s+", " ", html.entities.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:h1|p)>", m[1])]
        assert got[i + 2] == "\n".join(b for b in want if b)
    assert html.main_text(df.limit(0)).count() == 0


def test_html_decoding_is_consistent(spark):
    rng = random.Random(6)
    nodes, _ = html.parse(PAGE.format(tag="div"))
    for _ in range(100):
        yes = [rng.uniform(-5, 0) for _ in nodes]
        no = [rng.uniform(-5, 0) for _ in nodes]
        inside = html.decode(nodes, yes, no)
        for node, ok in zip(nodes, inside):
            path, up = [], node
            while up is not None:
                path.append(inside[up.order])
                up = up.up
            assert "".join("1" if x else "0" for x in path[::-1]).strip("0").count("0") == 0
