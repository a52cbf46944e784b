"""The dealt operators on small tables, against brute force."""

from __future__ import annotations

import random
import re
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from litwire.llm import jaccard, langid, licenses, lines, lm, mixing, pieces, pii, quality, topk
from litwire.llm.queries import PIECE_MODEL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, _t long, score string, n_lines int"


def documents(spark, texts: list, ids: list | None = None, langs: list | None = None):
    """Texts as documents, with nulls and columns whose names clash with inner ones."""
    ids = list(range(len(texts))) if ids is None else ids
    langs = [None] * len(texts) if langs is None else langs
    rows = [(i, t, g, None, None, "other", 7, "x", None) for i, t, g in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " \n\t ", "one", "a b c d", "ÄÖ ünï\x0bcode\r\nend", "x" * 50_000, "w " * 20_000, "\n" * 3_000]


def random_texts(seed: int, count: int) -> list[str]:
    rng = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]
    base = [" ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(rng.randrange(5, 80))) for _ in range(count // 4)]
    texts = []
    for _ in range(count):
        chosen = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            chosen[rng.randrange(len(chosen))] = "new" + str(rng.randrange(1000))
        texts.append(" ".join(chosen))
    return texts


# Jaccard join -----------------------------------------------------------------


def brute_components(texts: dict) -> dict:
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    a_root, b_root = sorted((root(a), root(b)))
                    parent[b_root] = a_root
    return {i: (len(sets[i]), root(i)) for i in texts}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, seed):
    texts = dict(enumerate(random_texts(seed, 160) + ODD))
    got = jaccard.jaccard_components(documents(spark, list(texts.values()))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(texts)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(120):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(120)] = f"edit{k}-{rng.randrange(9)}"
        texts.append(" ".join(copy))
    texts = dict(enumerate(texts))
    got = jaccard.jaccard_components(documents(spark, list(texts.values()))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(texts)


def test_fragments_hide_no_link(spark):
    # Two near copies, and every passage that they share as a document of its own: leaders of quite another size.
    texts = []
    for seed in range(80):
        words = [f"s{seed}w{i}" for i in range(14)]
        texts += [" ".join(words), " ".join([*words[:-1], f"s{seed}new"])]
        texts += [" ".join(words[i : i + 5]) for i in range(9)]
    texts = dict(enumerate(texts))
    got = jaccard.jaccard_components(documents(spark, list(texts.values()))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(texts)


def test_neighbouring_sizes_are_in_neighbouring_bands(spark):
    for share in (50, 80, 100):
        rows = spark.range(1, 3000).select("id", (F.floor(F.col("id") * 100 / share)).alias("most"))
        got = rows.select((jaccard._band(F.col("most"), share) - jaccard._band(F.col("id"), share)).alias("d")).distinct().collect()
        assert {r["d"] for r in got} <= {0, 1}


def test_signature_never_rules_out_a_link(spark):
    rng = np.random.default_rng(3)
    for _ in range(50):
        own = np.unique(rng.integers(0, 1 << 60, rng.integers(1, 900)).astype(np.uint64))
        other = np.unique(np.concatenate((own[rng.random(len(own)) < 0.95], rng.integers(0, 1 << 60, 9).astype(np.uint64))))
        bits = sum(int(x).bit_count() for x in (jaccard.signature(own) ^ jaccard.signature(other)).view(np.uint64))
        assert bits <= len(np.setxor1d(own, other))


def test_wide_signature_folds_and_never_rules_out_a_link(spark):
    rng = np.random.default_rng(4)
    rows = []
    for size in (300, 500, 520, 1000, 1030, 4000, 70000):
        own = np.unique(rng.integers(0, 1 << 60, size).astype(np.uint64))
        near = np.unique(np.concatenate((own[rng.random(len(own)) < 0.94], rng.integers(0, 1 << 60, size // 20).astype(np.uint64))))
        far = np.unique(rng.integers(0, 1 << 60, size).astype(np.uint64))
        for other in (near, far):
            common = len(np.intersect1d(own, other))
            linked = 100 * common >= 80 * (len(own) + len(other) - common)
            rows.append((linked, *[(len(s), jaccard.wide_signature(s).tolist()) for s in (own, other)]))
    mark = "struct<n: bigint, wide: array<bigint>>"
    df = spark.createDataFrame(rows, f"linked boolean, x {mark}, y {mark}")
    got = df.select("linked", "x.n", jaccard._wide_may_link("x", "y", 80).alias("may")).collect()
    assert all(r["may"] for r in got if r["linked"]) and sum(r["linked"] for r in got) == 7
    assert not any(r["may"] for r in got if not r["linked"] and 520 <= r["n"] <= 4000)


def test_borderline_copies_over_many_shapes(spark):
    # Families whose members differ by about the share, of sizes across bands, with a passage that all families hold.
    for seed in (11, 12):
        rng = random.Random(seed)
        shared = [f"common{i}" for i in range(7)]
        texts = []
        for family in range(12):
            base = [f"f{family}w{i}" for i in range(rng.choice([9, 25, 60, 110]))]
            for _ in range(9):
                copy = list(base)
                for _ in range(rng.randrange(1, 4)):
                    at = rng.randrange(len(copy))
                    copy[at : at + rng.randrange(2)] = [f"x{rng.randrange(4)}"]
                texts.append(" ".join(rng.choice([copy, copy + shared, shared + copy])))
        texts = dict(enumerate(texts))
        got = jaccard.jaccard_components(documents(spark, list(texts.values()))).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(texts)


def test_repeated_rows_and_missing_ids_in_components(spark):
    docs = documents(spark, ["a b c d e f g", "a b c d e f g", "a b c d e f g", "h i"], [4, 4, None, 9])
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in jaccard.jaccard_components(docs).collect())
    assert got == [(-1, None), (4, 4), (4, 4), (9, 9)]
    kept = jaccard.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 4, 9]


# Line dedup -------------------------------------------------------------------


def brute_lines(rows: list[tuple]) -> list[tuple]:
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    order = lambda i: lines.LAST if i is None else i
    holders: dict = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(order(i))
    out = []
    for i, text in rows:
        own = (text or "").split("\n")
        gone = [len(key(x)) >= 10 and len(holders[key(x)]) > 1 and order(i) > min(holders[key(x)]) for x in own]
        out.append((order(i), len(own), sum(gone), "\n".join(x for x, g in zip(own, gone, strict=True) if not g)))
    return sorted(out)


def test_lines_equal_brute_force(spark):
    rng = random.Random(2)
    pool = ["A shared line here", "a SHARED line here \t", "short", "", "another common line", "ünïcödé line of text", "\x0bpadded shared line\r"]
    texts = ["\n".join(rng.choice([*pool, f"own line number {rng.randrange(500)}"]) for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    rows = list(zip([*range(148), 3, None], texts, strict=True)) + list(zip(range(200, 200 + len(ODD)), ODD, strict=True)) + [(7, texts[7])]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = lines.dedup_lines(docs)
    assert set(docs.columns) <= set(got.columns)
    found = [(lines.LAST if r["doc_id"] is None else r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()]
    assert sorted(found) == brute_lines(rows)


def test_perfect_hash_is_minimal_and_packs():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 5000).astype(np.uint64))
    table = lines.PerfectHash.unpack(*lines.PerfectHash.build(keys).pack())
    assert sorted(table.slots(keys)) == list(range(len(keys)))
    assert lines.PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]


# Quality rules ----------------------------------------------------------------


def test_counts_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a", "b", "c#", "Dé", "e|f"]) for _ in range(rng.randrange(0, 60))) + rng.choice(["", "\nx y\nx y"]) for _ in range(80)] + ODD
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.apply_rules(documents(spark, texts), labels).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        often = {w for w in windows if windows.count(w) > 1} if len(words) < 1000 else set(windows)
        repeated = len({k + j for k, w in enumerate(windows) if w in often for j in range(5)})
        seen, duplicates = set(), 0
        for line in (text or "").split("\n"):
            if line.strip(" \t\n\x0b\x0c\r"):
                duplicates += line in seen
                seen.add(line)
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), duplicates, repeated)
        assert tuple(got[i][c] for c in quality.COUNTS) == expected
        failed = len(words) < 10 or 100 * repeated > 20 * len(words)
        assert got[i]["base_failed"] == failed
        assert not (failed and got[i]["kept"])


def test_cutoffs_hold_their_risk():
    assert quality.binomial_tail(0, 100, 0.05) == pytest.approx(0.95**100)
    assert quality.binomial_tail(3, 3, 0.5) == 1.0
    good = {(0, h, 1, "symbols", b): 1000 if b < 2 else 1 for h in (False, True) for b in range(6)}
    bad = {(0, h, 0, "symbols", b): 50 for h in (False, True) for b in range(2, 40)}
    cutoff = quality.choose_cutoffs(good | bad, 1)[0, "symbols"]
    assert 2 <= cutoff <= 6
    # Few labelled documents certify nothing.
    few = {k: 1 for k in good} | bad
    assert quality.choose_cutoffs(few, 1) == {}


# Language model ---------------------------------------------------------------


def test_pseudo_likelihood_equals_the_table(spark):
    texts = ["the cat sat on the mat"] * 30 + ["the dog sat on the rug"] * 30 + ["mat mat mat mat"] + ODD[:6]
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in lm.pseudo_likelihood(docs).collect()}
    words = lm.frequent_words(docs, "text")
    kinds = lm.TokenKinds(words)
    counts = np.zeros((lm.KINDS,) * 3, np.float32)
    rows = [[kinds[w] for w in (t or "").encode().lower().split()] for t in texts]
    for row in rows:
        full = [lm.EDGE, *row, lm.EDGE]
        for left, token, right in zip(full, full[1:], full[2:], strict=False):
            counts[left, right, token] += 1
    table = lm.train(counts)
    assert np.allclose(np.exp(table[..., : lm.EDGE]).sum(-1), 1, atol=1e-3)
    for i, row in enumerate(rows):
        full = [lm.EDGE, *row, lm.EDGE]
        expected = sum(float(table[a, c, b]) for a, b, c in zip(full, full[1:], full[2:], strict=False))
        assert got[i]["n_tokens"] == len(row)
        assert got[i]["pll"] == pytest.approx(expected, rel=1e-3, abs=1e-3)
    assert got[len(texts) - 6]["pll_per_token"] is None


# Language identification ------------------------------------------------------


def brute_ranks(text: str, most: int) -> list:
    words = re.findall(r"[^\W\d_]+", text.lower())
    counts: dict = {}
    for w in words:
        padded = f" {w} "
        for n in (1, 2, 3):
            for k in range(len(padded) - n + 1):
                gram = padded[k : k + n]
                if gram.strip():
                    counts[gram] = counts.get(gram, 0) + 1
    return counts


def test_grams_equal_brute_force():
    for text in ["Hello, wörld! hello", "a", "x1y  z", "ÀÉ 12 -- ß"]:
        keys, counts = langid.grams(text.encode())
        named = {}
        for key, n in zip(keys.tolist(), counts.tolist(), strict=True):
            chars = [key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF]
            named["".join(chr(c) for c in chars if c)] = n
        assert named == brute_ranks(text, 400)


def test_languages_are_told_apart(spark):
    rng = random.Random(1)
    words = {"en": "the of and ing tion that with".split(), "de": "der und ein schaft ung nicht für".split(), "fr": "le de la que eau tion ment".split()}
    texts, langs = [], []
    for i in range(240):
        lang = rng.choice(list(words))
        texts.append(" ".join(rng.choice(words[lang]) for _ in range(40)))
        langs.append(lang)
    docs = documents(spark, texts + [None, "", "12 34 !!"], [*range(len(texts)), 1000, 1001, None], [*langs, "en", None, "de"])
    rows = langid.train_and_identify(docs)
    assert set(docs.columns) <= set(rows.columns)
    got = {r["doc_id"]: r for r in rows.collect()}
    assert sum(got[i]["lang_pred"] == lang for i, lang in enumerate(langs)) > 0.97 * len(langs)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in (1000, 1001, None)] == ["und"] * 3
    nothing = langid.train_and_identify(documents(spark, ["some text"], [1], [None])).first()
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0.0)


# Personal data ----------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text: str) -> str:
    found = []
    for order, (kind, pattern) in enumerate(BASE_PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(f[2] for f in sorted(found))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(9)
    atoms = ["a@b.c", "x_y@mail.example.com", "a@b.com_x@c.de", "..@..", "1.2.3.4", "256.1.1.1", "001.02.3.255.9", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824", "+49", "+1((((", "é☃🙂", "@", "a@b..c", "12345678901234567890123"]
    texts = ["".join(rng.choice(atoms) + rng.choice(["", " ", ".", "\n", "x"]) for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    texts += ODD + ["a@b" + ".c" * 5000, "1" * 30_000, "a" * 30_000 + "@"]
    docs = documents(spark, texts)
    rows = pii.find_personal_data(docs).select("doc_id", pii.span_text(F.col("base")).alias("base")).collect()
    assert {r["doc_id"]: r["base"] for r in rows} == {i: brute_spans(t or "") for i, t in enumerate(texts)}


def test_weak_supervision_adds_secrets(spark):
    rng = random.Random(2)
    tokens = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(40)]
    texts = [f'settings token = "{t}" and more' for t in tokens] + ["plain words only"] * 40
    rows = pii.find_personal_data(documents(spark, texts)).select(pii.span_text(F.concat("base", "added")).alias("s")).collect()
    # A secret that holds a valid card number keeps the base span instead.
    assert sum("secret:18:58" in r["s"] or "card:" in r["s"] for r in rows) == 40
    assert sum(r["s"] == "" for r in rows) == 40


def test_texts_full_of_numbers_take_time_in_proportion(spark):
    rng = random.Random(8)
    numbers = " ".join(str(rng.randrange(10, 10**6)) for _ in range(60_000))
    phones = ", ".join(f"+1 555 {i:07d}" for i in range(5_000))
    texts = [numbers, phones, "1.2.3.4 " * 3_000]
    started = time.monotonic()
    rows = pii.find_personal_data(documents(spark, texts)).select("doc_id", pii.span_text(F.col("base")).alias("base")).collect()
    assert {r["doc_id"]: r["base"] for r in rows} == {i: brute_spans(x) for i, x in enumerate(texts)}
    assert time.monotonic() - started < 60


# Mixing -----------------------------------------------------------------------


def test_rates_match_targets(spark):
    texts = [f"fine words in order {i} here now" for i in range(60)] + [f"junk ### $$$ %%% {i}" for i in range(60)] + [None, ""]
    labelled = spark.createDataFrame([(i, "good" if i < 60 else "poor") for i in range(0, 120, 2)] + [(None, "good")], "doc_id long, domain string")
    targets = {"good": 0.9, "poor": 0.1}
    rows = mixing.document_rates(documents(spark, texts), labelled, targets).collect()
    assert len(rows) == len(texts)
    total = sum(r["n_tokens"] for r in rows)
    for domain, share in targets.items():
        assert sum(r["rate"] * r["n_tokens"] * r[f"p_{domain}"] for r in rows) / total == pytest.approx(share, rel=0.02)
    assert all(r["rate"] >= 0 and abs(r["copies"] - r["rate"]) < 1 for r in rows)
    assert all(abs(r["p_good"] + r["p_poor"] - 1) < 1e-9 for r in rows)


def test_rates_equal_plain_descent(spark):
    # The same objective by plain projected gradient over documents.
    p = np.array([[0.9, 0.1], [0.2, 0.8], [0.5, 0.5]])
    n = np.array([100.0, 300.0, 50.0])
    goal = np.array([0.7, 0.3]) * n.sum()
    rate = np.ones(3)
    for _ in range(20000):
        gap = (p * (rate * n)[:, None]).sum(0) - goal
        rate = np.maximum(0, rate - 0.05 * (p @ (gap / goal) + mixing.RIDGE * (rate - 1)))
    table = spark.createDataFrame([(p[i].tolist(), int(n[i])) for i in range(3)], "_p array<double>, _tokens long")
    steps, _ = mixing.fit_rates(table, [0.7, 0.3])
    got = [r[0] for r in table.select(mixing.rate_of(steps, 2)).collect()]
    totals = (p * (np.array(got) * n)[:, None]).sum(0)
    assert totals == pytest.approx((p * (rate * n)[:, None]).sum(0), rel=0.01)


@pytest.mark.parametrize(
    ("targets", "clear", "vague"),
    [([0.97, 0.02, 0.01], 0.999, 0.849), ([0.97, 0.02, 0.01], 0.97, 0.82), ([0.97, 0.02, 0.01], 1.0, 0.6), ([1.0, 0.0, 0.0], 0.97, 0.82), ([0.001, 0.001, 0.998], 0.97, 0.82)],
)
def test_rates_are_the_minimum(spark, targets, clear, vague):
    # Shares as in the labels of sf0.1, targets as in the query. The objective is convex: no projected gradient, no better rates.
    p, n = [], []
    for i, share in enumerate([0.77, 0.11, 0.12]):
        for top, part in ((clear, 0.7), (vague, 0.3)):
            p.append([top if j == i else (1 - top) / 2 for j in range(3)])
            n.append(int(1_000_000 * share * part))
    p, n, goal = np.array(p), np.array(n, float), np.maximum(targets, 1e-9) * sum(n)
    table = spark.createDataFrame([(row.tolist(), int(k)) for row, k in zip(p, n, strict=True)], "_p array<double>, _tokens long")
    steps, gaps = mixing.fit_rates(table, targets)
    rate = np.array([r[0] for r in table.select(mixing.rate_of(steps, 3)).collect()])
    assert len(steps) < 40
    gap = ((p * (rate * n)[:, None]).sum(0) - goal) / goal
    gradient = p @ gap + mixing.RIDGE * (rate - 1)
    scale = 1 + np.abs(gap).max()
    assert (rate >= 0).all()
    assert np.abs(gradient[rate > 0]).max() < 1e-6 * scale
    assert (gradient[rate == 0] > -1e-6 * scale).all()
    assert gaps == pytest.approx(gap, abs=1e-6 * scale)


@pytest.mark.parametrize("seed", range(6))
def test_rates_of_random_patterns_are_the_minimum(spark, seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 7))
    p = rng.dirichlet(np.full(k, 0.3), 150)
    n = rng.integers(0, 10_000, 150).astype(float)
    targets = rng.dirichlet(np.full(k, 0.4))
    goal = np.maximum(targets, 1e-9) * n.sum()
    table = spark.createDataFrame([(row.tolist(), int(m)) for row, m in zip(p, n, strict=True)], "_p array<double>, _tokens long")
    steps, _ = mixing.fit_rates(table, targets.tolist())
    rate = np.array([r[0] for r in table.select(mixing.rate_of(steps, k)).collect()])
    gap = ((p * (rate * n)[:, None]).sum(0) - goal) / goal
    gradient = p @ gap + mixing.RIDGE * (rate - 1)
    scale = 1 + np.abs(gap).max()
    assert (rate >= 0).all()
    assert np.abs(gradient[rate > 0]).max() < 1e-6 * scale
    assert (gradient[rate == 0] > -1e-6 * scale).all()


def test_targets_out_of_reach_are_reported(spark):
    texts = [f"fine words in order {i} here now" for i in range(30)] + [f"junk ### $$$ %%% {i}" for i in range(30)]
    labelled = spark.createDataFrame([(i, "good" if i < 30 else "poor") for i in range(60)], "doc_id long, domain string")
    with pytest.warns(UserWarning, match="poor"):
        rows = mixing.document_rates(documents(spark, texts[:30]), labelled, {"good": 0.1, "poor": 0.9})
    (gaps,) = rows.select("gap_good", "gap_poor").distinct().collect()
    assert gaps["gap_poor"] < -0.01


# Top-k ------------------------------------------------------------------------


def test_top_k_keeps_rows_of_one_id(spark):
    # Ids 7 (a candidate) and 0 (a query) twice with different vectors; an equal row of id 3.
    rows = [(0, [4.0, 1.0]), (0, [1.0, 5.0]), (7, [9.0, 9.0]), (7, [8.0, 9.0]), (3, [2.0, 2.0]), (3, [2.0, 2.0]), (4, [1.0, 1.0]), (5, [0.5, 0.5]), (6, [-1.0, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_inner_products(table, F.col("vec_id") == 0).orderBy("query_id", "rank").collect()]
    whole = {(i, tuple(int(256 * x) for x in v)) for i, v in rows}
    pairs = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), j) for i, q in whole if i == 0 for j, v in whole if j != 0)
    assert got == [(0, rank, j, -score) for rank, (score, j) in enumerate(pairs[:5], 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (400, 12)) * rng.lognormal(0, 1, (400, 1))
    x[100:200] = x[7]
    rows = [(i, [float(v) for v in x[i]], "other") for i in range(400)]
    rows += [(1000, None, None), (1050, [None] * 12, None), (1100, [float("nan")] * 12, None), (1150, [float("inf")] * 12, None), (1200, [], None), (50, rows[50][1], None), (None, rows[3][1], None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, norm string")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_inner_products(vectors, F.col("vec_id") % 50 == 0).collect()]
    q = np.floor(256 * x.astype(np.float32).astype(np.float64)).astype(np.int64)
    expected = []
    for i in range(0, 400, 50):
        scores = q @ q[i]
        order = [j for j in np.lexsort((np.arange(400), -scores)) if j != i][:5]
        expected += [(i, rank + 1, int(j), int(scores[j])) for rank, j in enumerate(order)]
    assert sorted(got) == sorted(expected)


# Pieces -----------------------------------------------------------------------


def test_pieces_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdeftheing  \n\t.,▁☃éß漢🙂\x00-=*1") for _ in range(rng.choice([0, 1, 3, 30, 200]))) for _ in range(150)]
    texts += [t for t in ODD if t is not None] + ["the same words again and again"] * 20
    rows = pieces.decode(pieces.encode(documents(spark, [*texts, None]), PIECE_MODEL), PIECE_MODEL).collect()
    got = {r["doc_id"]: r for r in rows}
    for i, text in enumerate(texts):
        assert list(got[i]["piece_ids"]) == library.encode(text)
        assert got[i]["decoded"] == text.replace("▁", " ")
    assert list(got[len(texts)]["piece_ids"]) == [] and got[len(texts)]["decoded"] == ""
    once = pieces.encode_and_decode(documents(spark, [*texts, None]), PIECE_MODEL).collect()
    assert {r["doc_id"]: r for r in once} == got


def test_merges_at_once_equal_single_ones():
    model = pieces.Model.load(PIECE_MODEL)
    rng = random.Random(8)
    units = {"".join(rng.choice("▁eeaathinosr.,=-é☃漢") for _ in range(rng.randint(1, pieces.SHORT))) for _ in range(3000)}
    got = pieces.Merges(model).encode(sorted(units))
    assert len(got) > 500
    assert all(np.frombuffer(ids, "<i4").tolist() == model.encode_unit(unit) for unit, ids in got.items())
    assert pieces.Merges(model).encode([]) == {}


def test_folds_equal_the_task_recurrences(spark):
    rng = random.Random(4)
    units = sorted({"".join(rng.choice("abcdehint.,é☃") for _ in range(rng.choice([1, 2, 3, 5, 9]))) for _ in range(120)} | {"▁the", "▁▁a", "▁"})
    table = spark.createDataFrame([(u,) for u in units], "unit string")
    for algorithm in (pieces.BPE, pieces.UNIGRAM):
        model = pieces.Model.load(PIECE_MODEL)
        model.algorithm = algorithm
        got = {r["unit"]: list(r["ids"]) for r in pieces.encode_units(table, model).collect()}
        assert got == {u: model.encode_unit(u) for u in units}


# Licences ---------------------------------------------------------------------


def test_base_places_equal_brute_force(spark):
    rng = random.Random(6)
    words = ["CC", "by", "general", "Public", "License", "all", "rights", "reserved", "x", "é", "nc", "3"]
    texts = [rng.choice([" ", "-", ", "]).join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(200)] + ODD
    got = {r["doc_id"]: r for r in licenses.scan_licenses(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        starts, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES.items():
            parts = phrase.split()
            for k in range(len(own)) if len(own) < 1000 else ():
                if own[k : k + len(parts)] == parts:
                    starts.append(k)
                    labels.add(label)
        row = got[i]
        assert (row["n_words"], row["n_base"]) == (len(own), len(starts))
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert row["base_labels"] == ",".join(sorted(labels))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


def test_expressions():
    def value(text):
        return licenses.evaluate(licenses.postfix(licenses.TOKEN.findall(text)))

    assert licenses.postfix("a or b and c with d".split()) == ["a", "b", "c", "d", "with", "and", "or"]
    assert licenses.postfix(["(", "a", "or", "b", ")", "and", "c"]) == ["a", "b", "or", "c", "and"]
    assert value("MIT OR GPL-3.0-only") == 0.9
    assert value("MIT AND GPL-3.0-only") == 0.4
    assert value("GPL-2.0 WITH Classpath-exception-2.0") == pytest.approx(0.5)
    assert value("(MIT OR (GPL-2.0") == 0.9
    assert value(") AND MIT AND") == 0.9
    assert value("") == 0.0
    row = licenses.scan_text(b"SPDX-License-Identifier: (Apache-2.0 OR MIT) AND GPL-2.0 WITH x-exception\n", licenses.Automaton([*licenses.LABELS, licenses.TAG]))
    assert row[5] == "apache-2.0,gpl-2.0,mit" and row[6] == pytest.approx(0.5)


# All --------------------------------------------------------------------------


def test_empty_tables(spark):
    docs = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    domains = spark.createDataFrame([], "doc_id long, domain string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for frame in (
        quality.apply_rules(docs, labels),
        lm.pseudo_likelihood(docs),
        jaccard.jaccard_components(docs),
        langid.train_and_identify(docs),
        pii.find_personal_data(docs),
        mixing.document_rates(docs, domains, {"good": 1.0, "poor": 1.0}),
        topk.top_inner_products(vectors, F.col("vec_id") % 50 == 0),
        pieces.encode(docs, PIECE_MODEL),
        lines.dedup_lines(docs),
        licenses.scan_licenses(docs),
    ):
        assert frame.collect() == []


def test_pipeline_stages_over_odd_rows(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(1)
    english = ["the of and that with from".split(), "der und ein nicht mit von".split()]
    texts = [" ".join(rng.choice(english[i % 2]) + rng.choice(["", "s", "n"]) for _ in range(60)) for i in range(60)]
    texts += [texts[0], texts[2] + " more", None, "", "123 456"]
    langs = ["en" if i % 2 == 0 else "de" for i in range(60)] + ["en", "en", None, None, None]
    documents(spark, texts, None, langs).select(*corpus_pipeline.COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, str(tmp_path)))
        kept[name] = docs
        if name != "sentencepiece":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert {r["doc_id"] for r in kept["language_id"].collect()} == set(range(62))
    assert {r["doc_id"] for r in kept["ngram_jaccard_join"].collect()} <= set(range(62)) - {60, 61}
    assert all(r["round_trip"] for r in kept["sentencepiece"].collect())


def test_driver_holds_no_doubles_for_all_cells_of_the_sketch(spark):
    docs = spark.createDataFrame([(f"w{i % 3} x y z q",) for i in range(9)], "text string")
    tracemalloc.start()
    levels = jaccard.sketch_counts(docs, "text")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(levels[levels > 0].tolist()) == [2, 2, 2] and len(levels) == jaccard.SKETCH
    assert peak < 8 * jaccard.SKETCH
