"""The pipeline's stages against brute force, and its edges."""

import re

import corpus_pipeline as P
from dealwise.llm import common
from pyspark.sql import functions as F
from test_llm_operators import jaccard_classes

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.table(spark, SF, "documents")
    before = docs.collect()
    out = {}
    for name, stage in P.STAGES:
        docs = common.stored(stage(spark, docs, SF), "test")
        out[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == list(before[0].asDict())
    kept = {r["doc_id"]: r["text"] for r in out["quality rules"]}
    assert set(kept) == {r["doc_id"] for r in before if good(r["text"])}
    classes = jaccard_classes(kept)
    assert {r["doc_id"] for r in out["near duplicates"]} == {i for i, (c, _) in classes.items() if c == i}
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    clean = {r["doc_id"] for r in out["near duplicates"] if not any(
        tuple(w[i:i + k]) in windows for w in [words(r["text"])] for k in {len(x) for x in windows} for i in range(len(w)))}
    assert {r["doc_id"] for r in out["decontamination"]} == clean
    assert {r["doc_id"] for r in out["mixing"]} <= clean
    assert sorted(r["text"] for r in out["sharding"]) == sorted(r["text"] for r in out["mixing"])
    slots = {}
    for r in out["sharding"]:
        slots.setdefault(r["placed"]["shard"], []).append(r["placed"]["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def good(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(ws)
    grams = [tuple(ws[i:i + 5]) for i in range(n - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    repeat = len({i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)})
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = sum(map(len, ws))
    return not (n < 10 or 100 * repeat > 20 * n or 10 * len(re.findall(r"[#*$%&|<>]", text)) > 3 * n
                or not 2 * n <= chars <= 15 * n or 10 * (len(lines) - len(set(lines))) > 3 * len(lines)
                or 2 * len(re.findall("[A-Z]", text)) > chars)


def test_edges(spark):
    rows = [(1, "a good text of more than ten words that stays in " + c, "en", "src0", 1, "x", 2) for c in "abc"]
    rows += [(None, None, None, None, None, None, None), (None, rows[0][1], "en", "src0", 1, "x", 2), (2, "", "en", None, 0, "x", 2), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality string, placed int")
    for table in (docs, docs.limit(0)):
        now = table
        for name, stage in P.STAGES:
            now = common.stored(stage(spark, now, SF), "test")
            if name == "near duplicates" and table is docs:
                assert sorted(r["text"][-1] for r in now.collect()) == ["a", "b", "c"]  # three texts of one id
                assert {r["doc_id"] for r in now.collect()} == {1}
        assert now.where(F.col("placed.shard").isNull()).count() == 0


def test_near_duplicates_without_and_with_repeated_ids(spark):
    base = [f"w{i}" for i in range(60)]
    near, other = " ".join([*base[:-1], "changed"]), " ".join(f"u{i}" for i in range(30))
    alone, base = " ".join(f"z{i}" for i in range(30)), " ".join(base)
    lost = [(None, base), (None, near), (None, alone), (None, alone), (None, " "), (None, None)]
    docs = spark.createDataFrame([(5, base), (6, near), (7, ""), (7, other), (8, other + " end"), *lost], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in P.near_duplicate_stage(spark, docs, SF).collect()))
    # copies without an id go, each text of an id is judged by itself, empty texts link to nothing
    assert got == [(0, ""), (0, " "), (0, alone), (5, base), (7, ""), (7, other)]
