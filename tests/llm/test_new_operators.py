"""Importance resampling, the prefix trie and the Hamming join against plain code, and their odd inputs."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import hamming_join, importance, prefix_trie
from tests.llm.test_edges import COLUMNS, LONG, ROWS, by_id, docs, none  # noqa: F401

# --- importance resampling ------------------------------------------------------


def features(text):
    words, word = [], bytearray()
    for byte in (text or "").encode():
        byte += 32 if 65 <= byte <= 90 else 0
        if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128:
            word.append(byte)
        elif word:
            words, word = [*words, bytes(word)], bytearray()
    words += [bytes(word)] if word else []
    return len(words), [zlib.crc32(b" ".join(words[i : i + k])) % 10_000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_resampling(rows, target, percent=5, least=20):
    own = [(i, *features(t)) for i, t in rows]
    s, t = (Counter(b for f in fs for b in f) for fs in ([f for _, _, f in own], [features(x)[1] for x in target]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    scored = []
    for i, n, fs in own:
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, fs))
        scored.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    k = percent * len(fit) // 100
    return sorted([(*r, None) for r in scored if r[1] < least] + [(*r, i + 1 if i < k else None) for i, r in enumerate(fit)], key=str)


def test_resampling_equals_plain_code(spark):
    random.seed(5)
    word = lambda: random.choice(["Ab", "É-tude", "x1", "naïve", "the", "of", "Z", "日本"])
    rows = [(i, " ".join(word() for _ in range(random.randint(0, 60)))) for i in range(400)] + [(7, "a b " * 15)] * 9 + [(None, "c d " * 20), (401, None)]
    target = [" ".join(word() for _ in range(30)) for _ in range(5)] + [None, ""]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 50, 100):
        got = importance.resampled(frame, goal, percent).collect()
        assert sorted(map(tuple, got), key=str) == plain_resampling(rows, target, percent)


def test_quickselect_finds_every_place(spark, monkeypatch):
    random.seed(3)
    keys = [(random.randint(0, 30), 0, random.randint(0, 5), 1) for _ in range(300)]
    rows = spark.createDataFrame(keys, ", ".join(f"{c} long" for c in importance.KEY)).cache()
    ordered = sorted(keys)
    for k in (1, 17, 150, 299, 300):
        place = importance.kth_key(rows, importance.KEY, k, pivots=3)
        assert place.key == ordered[k - 1] and place.before == ordered.index(place.key)


def test_resampling_edges(spark, docs, none):  # noqa: F811
    goal = docs.limit(0)
    out = importance.resampled(docs, goal)
    assert by_id(out.select("doc_id", "n_words", "n_features")) == sorted(((i, *map_len(features(t))) for i, t, *_ in ROWS), key=str)
    assert importance.resampled(none, docs).count() == 0


def map_len(pair):
    return pair[0], len(pair[1])


# --- prefix trie ------------------------------------------------------------------


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    built = {c: own.get(c - int(math.fmod(c, 5)), [])[: h[c]] + own[c][h[c] :] for c in own}
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    cost = {n: (len(m) - 1) * len(n[-1][1].encode()) if n else 0 for n, m in members.items()}
    children = Counter(n[:-1] for n in members if n)
    out = []
    for node, m in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(node)))
        out.append((
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node],
            sum(not children[n] for n in below), sum(cost[n] for n in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string"


def some_turns():
    random.seed(11)
    rows = []
    for c in [*range(-12, 40), *range(100, 130)]:
        if c % 7 == 3:
            continue
        for turn in range(random.randint(1, 11)):
            rows.append((c, turn, random.choice(["user", "assistant"]), random.choice(["hi", "é", "", "hello there"]) if turn > 2 else "start"))
    rows += [(5, None, None, None), (5, 1, "user", "hi"), (5, 1, "user", "hi"), (None, 1, "user", "lost"), (300, 0, "user", LONG)]
    return rows


@pytest.mark.parametrize("shard", [1, 3, 1_000])
def test_trie_equals_plain_code(spark, shard):
    rows = some_turns()
    frame = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("clash")).withColumn("hi", F.lit("clash")).repartition(6)
    got = sorted(map(tuple, prefix_trie.trie(frame, shard).collect()), key=str)
    assert got == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0


def test_running_totals_of_one_large_key(spark):
    rows = [(1, i, 1) for i in range(500)] + [(k, i, 1) for k in range(2, 9) for i in range(3)]
    frame = spark.createDataFrame(rows, "k long, o long, v long").repartition(4)
    got = {(r["k"], r["o"]): r["total_v"] for r in prefix_trie.running(frame, "k", ["o"], ["v"], pieces=7).collect()}
    assert got == {(k, o): o + 1 for k, o, _ in rows}


def test_queue_spills_and_adds_up():
    random.seed(2)
    items = [(random.randint(-9, 0), random.randint(0, 5), 0, 1, random.randint(0, 9), 1) for _ in range(500)]
    queue = prefix_trie.SpillingQueue(held=16)
    for item in items:
        queue.push(item)
    assert queue.spills > 20
    for key in sorted({i[:3] for i in items}):
        assert queue.pop((key[0], key[1], -1)) is None
        assert queue.pop(key) == [sum(i[n] for i in items if i[:3] == key) for n in (3, 4, 5)]
    assert not queue.heap and not queue.heads


def test_totals_do_not_depend_on_what_is_held():
    nodes = [(d, x, 0, x // 2, 0, d == 0, 1, 0, 0, 0) for d in range(7, -1, -1) for x in range(2**d)]
    assert list(prefix_trie.passed_up(iter(nodes), held=5)) == list(prefix_trie.passed_up(iter(nodes)))
    assert list(prefix_trie.passed_up(iter(nodes), held=5))[-1] == (2, 128, 255)


# --- Hamming join -----------------------------------------------------------------


def shingles(text):
    words = (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})).split()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)} or ({tuple(words)} if words else set())


def plain_groups(rows):
    sets = [shingles(t) for _, t in rows]
    label = {i: i for i, _ in rows if i is not None}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            if i is not None and j is not None and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return sorted(((i, len(s), None if i is None else root(i), i is None or i == root(i)) for (i, _), s in zip(rows, sets)), key=str)


def near_copies():
    random.seed(4)
    rows, n = [], 0
    for base in range(6):
        words = [f"w{base}x{random.randint(0, 5000)}" for _ in range(random.choice([12, 40, 120]))]
        for _ in range(random.choice([1, 5, 60])):
            edited = [random.choice(["new", f"e{n}"]) if random.random() < 0.02 else w for w in words]
            rows.append((n := n + 1, " ".join(edited)))
    random.shuffle(rows)
    return rows + [(rows[0][0], "a second text of the same id that links with another one"), (900, "A second text of the same id that links with another one"), (901, "short"), (902, "Short")]


@pytest.mark.parametrize("long", [3, 16, 1_000])
def test_hamming_join_equals_all_pairs(spark, monkeypatch, long):
    monkeypatch.setattr(hamming_join.candidates, "__defaults__", (long,))
    rows = near_copies()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, hamming_join.grouped(frame).collect()), key=str) == plain_groups(rows)


def test_hamming_join_edges(docs, none):  # noqa: F811
    rows = [(i, t) for i, t, *_ in ROWS]
    assert sorted(map(tuple, hamming_join.grouped(docs).collect()), key=str) == plain_groups(rows)
    assert hamming_join.grouped(none).count() == 0


def test_pigeonhole_guarantee(spark):
    """However the allowed errors fall, two signatures share a key."""
    random.seed(9)
    one = [random.randint(0, 2**16 - 1) for _ in range(hamming_join.VALUES)]
    rows = [(0, one)]
    for i in range(1, 200):
        other = list(one)
        for at in random.sample(range(hamming_join.VALUES), hamming_join.THRESHOLD):
            other[at] ^= 1
        rows.append((i, other))
    keys = spark.createDataFrame(rows, "id long, signature array<int>").select("id", hamming_join.index_keys(F.col("signature")).alias("k"))
    first, *others = [set(r["k"]) for r in keys.orderBy("id").collect()]
    assert len(first) == 40 and all(first & other for other in others)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (800, 100, 100))
    differ = []
    for turn in range(30):
        odd = np.uint64(2 * turn + 1)
        flat = np.concatenate([shared * odd, a * odd, shared * odd, b * odd])
        x, y = hamming_join.minima(flat, np.array([0, 900]))
        differ.append((x != y).mean())
    assert abs(np.mean(differ) - 0.2) < 0.03
