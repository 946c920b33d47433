"""Conversation repair, centroid clustering and SimHash against brute force."""

import hashlib
import itertools
import math
import random
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from dealwise.llm import centroids, repair, simhash

# ------------------------------------------------------------------ 11: repair


def all_edits(marks, entry, exits):
    """Every cheapest audit, by going through all edit sequences without useless inserts."""
    best = []

    def go(i, q, cost, audit, inserts):
        if i == len(marks) and q in exits:
            best.append((cost, audit, q))
        if i < len(marks):
            m = marks[i]
            go(i + 1, q, cost + 2, audit + "D", 0)
            if m != "x":
                more = 5 if m.isupper() else 0
                kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(m.lower(), {}).get(q)
                if kept is not None:
                    go(i + 1, kept, cost + more, audit + "K", 0)
                go(i + 1, 3 if q == 2 else 2, cost + 1 + more, audit + "R", 0)
        if inserts < 3:
            go(i, 3 if q == 2 else 2, cost + 5, audit + "I", inserts + 1)

    go(0, entry, 0, "", 0)
    return min(best, key=lambda b: b[:2]) if best else None


def test_least_edits_against_all_sequences():
    rng = random.Random(5)
    short = ["".join(m) for n in range(3) for m in itertools.product("suaoSUAOx", repeat=n)]
    long = ["".join(rng.choice("suauauaUAox") for _ in range(rng.randrange(3, 6))) for _ in range(60)]
    for marks in short + long:
        for entry in repair.STATES:
            for exits in (repair.ENDS, (1,), (2,)):
                assert repair.least_edits(marks, entry, exits) == all_edits(marks, entry, exits), (marks, entry, exits)


def suffix_edits(marks):
    """(cost, audit) by dynamic programming from the end, for conversations of any length."""
    def least(*ways):
        return min((w for w in ways if w), default=None)

    def put(c, letter, way):
        return way and (way[0] + c, letter + way[1])

    now = {0: (0, ""), 1: (10, "II"), 2: (5, "I"), 3: (0, "")}
    for m in reversed(marks):
        raw = {}
        for q in range(4):
            more = 5 if m.isupper() else 0
            kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(m.lower(), {}).get(q)
            raw[q] = least(put(2, "D", now[q]), m != "x" and put(1 + more, "R", now[3 if q == 2 else 2]),
                           kept is not None and put(more, "K", now[kept]))
        two = least(raw[2], put(5, "I", raw[3]))
        now = {0: least(raw[0], put(5, "I", two)), 1: least(raw[1], put(5, "I", two)), 2: two,
               3: least(raw[3], put(5, "I", raw[2]))}
    return now[0]


def brute_repair(rows):
    """The report of one conversation, row by row."""
    rows = sorted(((t is not None, t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda v: (v[0], v[1] or 0, v[2], v[3]))
    said, marks, counts = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, role, text in rows:
        tail = text.rstrip(repair.WHITE)
        fault = "blank" if not tail else "duplicate" if (role, text) in said else "truncated" if tail[-1] not in ".!?" else None
        said.add((role, text))
        if fault:
            counts[fault] += 1
        kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
        marks += "x" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    firsts = [r[:1] for _, _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
    cost, audit = suffix_edits(marks)
    lines, i, left = [], 0, False
    for letter in audit:
        if letter == "I":
            lines.append((("assistant", "user")[not left], ""))
            left = not left
            continue
        role, text = rows[i][2:]
        i += 1
        if letter == "D":
            continue
        if letter == "R":
            role = ("assistant", "user")[not left]
        left = role[:1] == "u" if role[:1] in "ua" else left
        lines.append((role, text))
    done = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, done), lines


def conversations(rng):
    roles, texts = ["user", "assistant", "system", "tool", None, ""], ["Yes.", "No", "ok!", "", " \n", None, "Why? ", "a "]
    rows = []
    for conv in [None, *range(40)]:
        for k in range(rng.randrange(1, 40 if conv else 60)):
            role = rng.choice(roles) if rng.random() < 0.2 else ("user", "assistant")[k % 2]
            text = rng.choice(texts) if rng.random() < 0.3 else f"turn {k} of {rng.randrange(30)}."
            rows.append((conv, k if rng.random() < 0.9 else rng.choice([None, k - 1, k + 3]), role, text, "x"))
    rows += rows[:7]
    return rows


@pytest.mark.parametrize("block", [1024, 3])
def test_repair_report_brute(spark, monkeypatch, block):
    """Blocks of three turns and conversations over several tasks change nothing."""
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    rows = conversations(random.Random(7))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string")
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair_report(df).collect()}
    by = {}
    for conv, *row in rows:
        by.setdefault(conv, []).append(tuple(row[:3]))
    assert got == {conv: brute_repair(rs)[0] for conv, rs in by.items()}
    turns = {}
    for r in repair.repaired_turns(df).collect():
        turns.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    for conv, rs in by.items():
        want = [(k, *line) for k, line in enumerate(brute_repair(rs)[1])]
        assert sorted(turns.get(conv, [])) == want


def test_repair_spreads_one_conversation(spark):
    """One conversation is cut by ranges of its turns, so its blocks come from several tasks."""
    df = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
                                    F.concat(F.lit("line "), F.col("id"), F.lit(".")).alias("text"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = repair.conversation_blocks(df).groupBy("part").count().count()
        row = repair.repair_report(df).collect()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert parts > 1
    assert row["cost"] == 10_000 and len(row["audit"]) == 20_000 and row["audit"] == "KR" * 10_000


def test_repair_long_text_and_empty_table(spark):
    long = "word " * 200_000 + "."
    df = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")
    row = repair.repair_report(df).collect()[0]
    assert row["audit"] == "KK" and row["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()
    assert repair.repair_report(df.limit(0)).collect() == []
    assert repair.repaired_turns(df.limit(0)).collect() == []


def test_damage_codes(spark):
    rows = [(c, t, "assistant", "Well. Yes!") for c in (None, 1, 2) for t in (None, *range(40))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "Well Yes"}.get(code, text)
        want += [(c, t, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    assert sorted(map(repr, map(tuple, repair.damaged(df).collect()))) == sorted(map(repr, want))


# ------------------------------------------------------------------ 12: centroids

def brute_clusters(rows, k, rounds, dim, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    mids = [q for _, q in first[:k]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, m)), c) for c, m in enumerate(mids))

    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(near(q)[1], []).append(q)
        mids = [[sum(col) // len(groups[c]) for col in zip(*groups[c])] if c in groups else m for c, m in enumerate(mids)]
    placed = [(i, *near(q)) for i, q in kept]
    total = sum(d for _, d, _ in placed)
    return [(i, c, d, sum(e for _, e, f in placed if f == c), total, hashlib.sha256(",".join(map(str, mids[c])).encode()).hexdigest())
            for i, d, c in placed]


def test_centroids_brute(spark):
    rng = random.Random(9)
    rows = [(i if i % 11 else None, [rng.uniform(-3, 3) + 5 * (i % 3) for _ in range(6)]) for i in range(200)]
    rows += [(500, [1.0] * 5), (501, None), (502, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (503, [float("nan")] * 6), (504, [float("-inf")] * 6), (505, [])]
    rows += [(7, rows[7][1])] * 150 + [(7, [0.0] * 6)]  # repeated rows, one id with two vectors
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, v array<float>, placed string")
    given = [(r["vec_id"], r["v"]) for r in df.collect()]
    out = centroids.cluster_vectors(df, "vec_id", "v", k=5, rounds=3, dim=6, scale=16)
    assert out.columns == df.columns
    got = [(r["vec_id"], *[r["placed"][c] for c in ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")])
           for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_clusters(given, 5, 3, 6, 16)))


def test_centroids_few_or_no_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, -0.5]), (2, [0.5, -0.5])], "vec_id long, v array<double>")
    out = centroids.cluster_vectors(df, vector="v", dim=2).collect()
    assert [(r["placed"]["cluster"], r["placed"]["distance"], r["placed"]["centroid"]) for r in out] == [(0, 0, [32, -32])] * 2
    none = centroids.cluster_vectors(df.limit(0), vector="v", dim=2)
    assert none.collect() == [] and none.schema["placed"].dataType.names == out[0].asDict()["placed"].__fields__
    with pytest.raises(Exception, match="exceeds"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e30, 0.0])], df.schema), vector="v", dim=2).collect()


def test_centroid_sums_are_one_codegen_aggregate(spark):
    df = spark.createDataFrame([(1, [0.5] * 64)], "vec_id long, v array<float>")
    q = centroids.integer_vectors(df, "v")
    at = q.select("q", centroids.nearest("q", [[0] * 64] * 16)["cluster"].alias("cluster"))
    plan = at.groupBy("cluster").agg(*[F.sum(F.col("q")[i]) for i in range(64)])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Python" not in plan and plan.count("transform(") == 1


# ------------------------------------------------------------------ 13: SimHash

def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair(radius):
    masks = simhash.covering_masks(radius, 24)
    for bits in itertools.combinations(range(24), radius):
        assert any(not any(m >> b & 1 for b in bits) for m in masks)
    assert all(m for m in masks)


def test_links_connect_exactly_the_near_fingerprints(spark):
    rng = random.Random(11)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for _ in range(300):  # chains of neighbours one to four bits apart
        x = rng.choice(sorted(prints))
        for b in rng.sample(range(64), rng.choice([1, 2, 2, 3, 4])):
            x ^= 1 << b
        prints.add(x)
    prints = sorted(prints)
    nodes = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    links = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in simhash.near_links(nodes).collect()]
    assert all(0 < (u ^ v).bit_count() <= 2 for u, v in links)
    at = {p: i for i, p in enumerate(prints)}
    root = list(range(len(prints)))
    for _ in prints:
        for u, v in links:
            root[at[u]] = root[at[v]] = min(root[at[u]], root[at[v]])
    classes = brute_components(prints)
    assert len(set(zip(root, classes))) == len(set(root)) == len(set(classes))


def test_simhash_brute(spark):
    rng = random.Random(13)
    texts = [None, "", " \n\t", "One", "one", "one two", "É x", " a b", "Zz " * 9]
    base = [f"w{rng.randrange(50)}" for _ in range(400)]
    for k in range(60):
        words = list(base if k % 2 else [f"v{rng.randrange(9)}" for _ in range(rng.randrange(1, 30))])
        words[rng.randrange(len(words))] = "new"
        texts.append(" ".join(words))
    texts += [texts[12]] * 30
    rows = [(i if i % 9 else None, t, "x") for i, t in enumerate(texts)] + [(4, "same id, other text", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    prints = [brute_print(t) for _, t, _ in rows]
    classes = brute_components(prints)
    least = {}
    for (i, _, _), c in zip(rows, classes):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = [(i, f"{p:016x}", least.get(c)) for (i, _, _), p, c in zip(rows, prints, classes)]
    got = [tuple(r) for r in simhash.simhash_components(df).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert simhash.simhash_components(df.limit(0)).collect() == []


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5_000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(text.encode()) == whole == brute_print(text)
