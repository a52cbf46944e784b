"""Conversation trie, sharding and importance resampling on small tables, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from litwire.llm import queries, resample, shards, trie
from litwire.llm.running import running

# Running values ---------------------------------------------------------------


def test_running_values_across_pieces(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 2, None]), i, rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, at long, x long").where("g is not null").repartition(7)
    got = running(df, ["g"], [F.col("at")], {"s": (F.sum, F.col("x")), "b": (F.bit_xor, F.xxhash64("x") * 0 + F.col("x"))}).collect()
    sums, xors = Counter(), Counter()
    for g, at, x in rows:
        if g is not None:
            sums[g] += x
            xors[g] ^= x
            rows_at = (sums[g], xors[g])
            assert rows_at == next((r["s"], r["b"]) for r in got if r["at"] == at) if at % 200 == 0 else True
    assert len(got) == sum(1 for r in rows if r[0] is not None)


# Conversation trie ------------------------------------------------------------


def brute_trie(rows) -> dict:
    """(conv_id, depth) to the other columns, by walking every prefix of every rebuilt conversation."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            convs[conv].append(((turn is not None, turn or 0), digest, role, text))
    turns = {c: [(role, text) for _, _, role, text in sorted(t, key=lambda x: x[:2])] for c, t in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
    members = defaultdict(set)
    for c, sequence in rebuilt.items():
        for d in range(len(sequence) + 1):
            members[sequence[:d]].add(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not children[p]
    out = {}
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if rebuilt[c] == p)))
        parent = min(members[p[:-1]]) if p else None
        out[min(m), len(p)] = (parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
    return out


def trie_rows(spark, rows, tmp_path):
    spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, ka string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_conversation_trie(spark, str(tmp_path)).collect()
    found = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in got}
    assert len(found) == len(got)
    return found


def test_trie_equals_brute_force(spark, tmp_path):
    rng, rows = random.Random(3), []
    for c in [*range(-7, 60), 905, 907]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "ä€", "", None])))
    rows += [(3, None, "user", "first"), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (4, 1, "a", "x"), (4, 1, "b", "x")]
    rows += [(None, 1, "user", "no conversation")]
    # One opening for many conversations, one conversation many times, and a very long one.
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1200) for t in range(3)]
    rows += [(2000, t, "user", str(t % 2)) for t in range(1500)] + [(2001, 0, "user", "long " * 50_000)]
    rng.shuffle(rows)
    assert trie_rows(spark, rows, tmp_path) == brute_trie(rows)


def test_trie_of_turnless_and_of_no_conversations(spark, tmp_path):
    # No conversation 10: 11 keeps nothing if its only turn is taken by the opening.
    turnless = next(c for c in range(11, 10_000) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(turnless, 0, "user", "gone")]
    assert trie_rows(spark, rows, tmp_path / "one") == brute_trie(rows) == {(turnless, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())}
    assert trie_rows(spark, [], tmp_path / "none") == {}


def test_nodes_get_their_turns_back(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (2, 1, "bot", None)], "conv_id long, turn long, role string, text string")
    ordered = trie.ordered_turns(turns)
    sequences = trie.whole(ordered)
    found = trie.prefix_trie(sequences)
    rows = trie.node_turns(found.nodes, sequences, turns).collect()
    assert {(r["conv_id"], r["depth"], r["role"], r["text"], r["n_convs"]) for r in rows} == {(1, 0, None, None, 2), (1, 1, "user", "a", 2), (1, 2, "bot", "b", 1), (2, 2, "bot", "", 1)}
    assert {(r["depth"], r["ids"]) for r in trie.end_lists(found.ends).collect()} == {(2, "1"), (2, "2")}


def test_end_lists_come_in_pieces(spark, monkeypatch):
    ends = spark.range(25).select(F.lit(1).cast("long").alias("depth"), F.lit(5).cast("long").alias("ka"), (F.col("id") % 2).alias("kb"), F.col("id").alias("conv_id"))
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    got = {r["kb"]: r["ends_sha256"] for r in trie.end_digests(ends).collect()}
    assert got == {k: hashlib.sha256(",".join(str(i) for i in range(25) if i % 2 == k).encode()).hexdigest() for k in (0, 1)}


# Sharding ---------------------------------------------------------------------


def brute_best_fit(sizes, capacity):
    room, bins = [], []
    for size in sizes:
        fits = [(r, b) for b, r in enumerate(room) if r >= size]
        if fits:
            bin = min(fits)[1]
        else:
            bin = len(room)
            room.append(max(capacity, size))
        room[bin] -= size
        bins.append(bin)
    return bins


@pytest.mark.parametrize("seed", range(20))
def test_tree_finds_the_tightest_bin(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randrange(1, 120) for _ in range(400)), reverse=True)
    for capacity in (7, 100, 1000):
        assert shards.best_fit(sizes, capacity) == brute_best_fit(sizes, capacity)


@pytest.mark.parametrize("seed", range(10))
def test_even_fit_is_even_and_within_the_number_of_shards(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.choice([rng.randrange(1, 50), rng.randrange(1, 900)]) for _ in range(1500)), reverse=True)
    filled = Counter()
    for size, bin in zip(sizes, shards.even_fit(sizes, 16), strict=True):
        filled[bin] += size
    assert set(filled) <= set(range(16))
    assert max(filled.values()) <= 1.01 * sum(sizes) / 16
    assert shards.even_fit([900, 10, 9, 8], 2) == [0, 1, 1, 1]
    assert shards.even_fit([], 4) == []


def shard_documents(spark, texts, ids):
    rows = [(i, t, "old", 5, 6, "x") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int, _row int, _ka string")


def check_shards(rows, group):
    by_shard, shard_of = defaultdict(list), defaultdict(set)
    for r in rows:
        by_shard[r["shard"]].append((r["doc_id"] is None, r["doc_id"] or 0, r["slot"]))
        shard_of[group(r)].add(r["shard"])
    assert all(len(s) == 1 for s in shard_of.values())
    for members in by_shard.values():
        assert [slot for *_, slot in sorted(members)] == list(range(len(members)))


def test_groups_stay_together_and_slots_have_no_gaps(spark):
    rng = random.Random(2)
    texts = ["w" * rng.randrange(1, 400) + str(rng.randrange(10**6)) for _ in range(1200)]
    texts += ["copy " * 20] * 150 + [None, None, "", "x" * 60_000]
    ids = [*range(len(texts) - 3), None, 5, 5]
    docs = shard_documents(spark, texts, ids)
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    rows = shards.shard_rows(docs, [F.coalesce("text", F.lit(""))], size, shards=16).collect()
    assert len(rows) == len(texts) and {r["shard"] for r in rows} <= set(range(16))
    assert sorted(map(repr, (r["text"] for r in rows))) == sorted(map(repr, texts)) and {r["_ka"] for r in rows} == {"x"}
    check_shards(rows, lambda r: r["text"] or "")
    filled = Counter()
    for r in rows:
        assert r["size"] == len((r["text"] or "").encode()) + 1
        filled[r["shard"]] += r["size"]
    rest = sorted(filled.values())[:-1]  # the largest text has a shard of its own
    assert filled.most_common(1)[0][1] == 60_001 and max(rest) <= 1.02 * min(rest)


def test_fixed_capacity(spark, monkeypatch):
    monkeypatch.setattr(shards, "SECTION", 4)
    rng = random.Random(4)
    texts = ["w" * rng.randrange(1, 90) + str(i) for i in range(900)]
    docs = shard_documents(spark, texts, list(range(900)))
    size = F.octet_length("text")
    rows = shards.shard_rows(docs, [F.col("text")], size, capacity=1000).collect()
    filled = Counter()
    for r in rows:
        filled[r["shard"]] += r["size"]
    check_shards(rows, lambda r: r["text"])
    total = sum(filled.values())
    assert max(filled.values()) <= 1000 and set(filled) == set(range(len(filled)))
    # At most one shard more for each section.
    assert len(filled) <= math.ceil(total / 1000 * 1.02) + total // 4000 + 1


def test_shards_of_an_empty_table_and_wrong_arguments(spark):
    docs = shard_documents(spark, [], [])
    assert shards.shard_rows(docs, [F.col("text")], F.lit(1), shards=16).collect() == []
    assert shards.shard_rows(docs, [F.col("text")], F.lit(1), capacity=9).collect() == []
    with pytest.raises(ValueError):
        shards.shard_rows(docs, [F.col("text")], F.lit(1))


def test_sharding_query(spark, tmp_path):
    shard_documents(spark, ["aé", None, "", "aé", "b"], [3, 1, 2, 1, None]).drop("shard").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_sharding(spark, str(tmp_path)).collect()
    sizes = sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in rows)
    crc = [zlib.crc32(t.encode()) for t in ("b", "", "aé", "")]
    assert sizes == [(-1, 2, crc[0]), (1, 1, 0), (1, 4, crc[2]), (2, 1, 0), (3, 4, crc[2])]
    check_shards(rows, lambda r: r["text_crc32"])
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


# Importance resampling --------------------------------------------------------


def grams_of(text) -> list[str]:
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def brute_draw(docs, target, percent=5) -> list:
    def counts(texts):
        return Counter(zlib.crc32(g.encode()) % 10_000 for t in texts for g in grams_of(t)[0])

    raw, wanted = counts(t for _, t in docs), counts(target)
    s_all, t_all = sum(raw.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        grams, words = grams_of(text)
        weight = sum(gain[zlib.crc32(g.encode()) % 10_000] for g in grams)
        name = "" if doc_id is None else str(doc_id)
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    eligible = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: len(eligible) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


WORDS = ["alpha", "Beta", "ÄÖ", "x1", "the", "of", "don't", "w" * 70, "é" * 40, "A" * 200, "ß", "7"]


def test_draw_equals_brute_force(spark):
    rng = random.Random(6)
    lines = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 9))) + rng.choice(["", " ", "\r", "-"]) for _ in range(60)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 12))) for _ in range(260)]
    texts += [None, "", " \n\t\n", "one", "one\ntwo", "one\n\n\ntwo\nthree", "ä\nb\nc\nd", "\n" * 3000, "w " * 20_000, "x" * 50_000 + "\n" + "y" * 50_000, "nul\x00byte A"]
    ids = [*range(len(texts) - 4), None, None, 7, 7]
    texts[-2:] = [texts[7], texts[7]]  # equal rows
    target = [lines[3] + "\n" + lines[4], None, "the of the\nof alpha", ""]
    docs = list(zip(ids, texts, strict=True))
    schema = "doc_id long, text string, o int, t string, line string, weight int, score string"
    frame = spark.createDataFrame([(*d, 1, "t", "l", 2, "s") for d in docs], schema).repartition(5)
    wanted = spark.createDataFrame([(i, t, 3) for i, t in enumerate(target)], "item_id long, text string, doc_id int")
    got = resample.importance_draw(frame, wanted, percent=20)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = sorted(map(tuple, got.collect()), key=repr)
    expected = brute_draw(docs, target, 20)
    # Equal rows tie in score and id: which of them is drawn is open.
    assert [r[:4] for r in rows] == [r[:4] for r in expected]
    assert sorted(r[4] or 0 for r in rows) == sorted(r[4] or 0 for r in expected)
    single = Counter(r[0] for r in rows)
    assert [r for r in rows if single[r[0]] == 1] == [r for r in expected if single[r[0]] == 1]
    drawn = resample.drawn_documents(frame, got)
    assert {r["doc_id"] for r in drawn.collect()} == {r[0] for r in rows if r[4] and r[0] is not None}


def test_draw_from_nothing_and_towards_nothing(spark):
    schema = "doc_id long, text string"
    empty = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(1, "a b"), (2, None)], schema)
    assert resample.importance_draw(empty, one).collect() == []
    assert sorted(map(tuple, resample.importance_draw(one, empty).collect()), key=repr) == brute_draw([(1, "a b"), (2, None)], [])


def test_hashes_of_runs_equal_crc32():
    rng = random.Random(9)
    words = ["w" * n for n in (1, 63, 64, 65, 128, 129, 1000)] + ["".join(rng.choice("abcé0") for _ in range(rng.randrange(1, 90))) for _ in range(300)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    start, length, row = resample.words_of(data, np.array([0, len(data)]))
    mask = [np.ones(len(start), bool) for _ in range(3)]
    mask[1][-1:] = mask[2][-2:] = False
    got = resample.gram_buckets(data, start, length, mask, 10_000)
    for n in (1, 2, 3):
        assert [int(x) for x in got[: len(words) - n + 1, n - 1]] == [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for i in range(len(words) - n + 1)]
    assert not row.any()


def test_steps_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(resample, "STEP", 40)
    import pyarrow as pa

    texts = ["abc def", None, "", "x" * 100, "a\nb c d", "e f"]
    steps = list(resample._texts(pa.array(texts)[1:]))
    assert sum(s[0] for s in steps) == 5 and b"".join(s[1].tobytes() for s in steps) == b"".join((t or "").encode() for t in texts[1:])
