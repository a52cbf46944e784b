"""Small rules on literal rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions import dates, text
from litwire.functions.fuzzy import _partial, lcs_lengths
from litwire.operators import translation
from litwire.operators.identity import split_conflicts, with_identity
from litwire.operators.relevance import filter_relevant, relevance


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for j, d in enumerate(b):
            new.append(max(row[j + 1], new[-1], row[j] + (c == d)))
        row = new
    return row[-1]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_common_subsequence_matches_plain_rule():
    rng = random.Random(5)
    sizes = [0, 1, 5, 63, 64, 65, 128, 200, 256, 257, 300]
    words = ["".join(rng.choice("abé 汉") for _ in range(rng.choice(sizes))) for _ in range(160)]
    a, b = words[:80], words[80:]
    assert list(lcs_lengths(a, b)) == [plain_lcs(x, y) for x, y in zip(a, b)]


def test_partial_ratio_matches_all_windows():
    rng = random.Random(6)
    for _ in range(80):
        a = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 10)))
        b = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 25)))
        s, g = sorted((a, b), key=len)
        n = len(s)
        spans = [g[max(0, e - n) : min(e, len(g))] for e in range(1, len(g) + n)]
        assert abs(_partial(a, b) - max(200 * plain_lcs(s, w) / (n + len(w)) for w in spans)) < 1e-9


def test_clean_space_decodes_and_normalises(spark):
    assert one(spark, text.clean_space(F.lit(" A&amp;B  ﬁ\n１ "))) == "A&B fi 1"


def test_boilerplate_becomes_empty(spark):
    line = "Comprehensive up-to-date news coverage, aggregated from sources all over the world by Google News."
    assert one(spark, text.remove_boilerplate(F.lit(line))) == ""


def test_json_recovery(spark):
    for raw in ('```json\n{"a": 1}\n```', 'so: {"a": 1} ok', '{"a": 1}'):
        assert one(spark, F.to_json(text.recover_json(F.lit(raw)))) == '{"a":1}'
    assert one(spark, text.recover_json(F.lit("none"))) is None


def test_dates(spark):
    cases = {"2024-02-30": None, "on 2024/3/5": dt.date(2024, 3, 5), "2023": dt.date(2023, 1, 1), "x": None}
    for raw, want in cases.items():
        assert one(spark, dates.parse_date(F.lit(raw))) == want
    assert one(spark, dates.date_from_parts(F.lit("2024"), F.lit("Mar"), F.lit(""))) == dt.date(2024, 3, 1)


def test_availability_prefers_window_then_past(spark):
    rows = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), dt.date(2024, 5, 3)), (2, dt.date(2024, 1, 1), None), (3, dt.date(2025, 1, 1), None)],
        "id int, online_date date, print_date date",
    )
    start, end = dates.date_window(dt.date(2024, 5, 8))
    out = {r.id: (r.availability_date_basis, r.in_window) for r in dates.filter_window(rows, start, end).collect()}
    assert out == {1: ("print_date", True), 2: ("online_date", False)}


def test_negative_only_mention_is_dropped(spark):
    terms = spark.createDataFrame([("hantavirus", "hantavirus"), ("hantavirus", "Orthohantavirus")], "profile_id string, term string")
    rows = spark.createDataFrame(
        [("a", "Detection of porcine circovirus", "All samples tested negative for hantavirus."), ("b", "Hantavirus", "")],
        "record_id string, title string, abstract string",
    )
    assert [r.record_id for r in filter_relevant(relevance(rows, terms)).collect()] == ["b"]


def test_translation_checks(spark):
    repaired = one(spark, translation.repair(F.lit("WHO宣布宋病毒疫情结束"), []))
    assert "汉坦病毒" in repaired and "宋病毒" not in repaired
    check = translation.check_translation
    assert one(spark, check(F.lit("13 cases and 3 deaths"), F.lit("共报告13例，其中3例死亡"))) == "ok"
    assert one(spark, check(F.lit("13 cases"), F.lit("共报告十三例"))) == "number_loss"
    assert one(spark, check(F.lit(""), F.lit("好好好好好好好"))) == "repeated_character_gibberish"


def test_glossary_longest_first_and_back(spark):
    entries = [("virus", "病毒"), ("Seoul virus", "汉城病毒")]
    hidden = one(spark, translation.protect(F.lit("SEOUL VIRUS and virus"), entries))
    assert hidden == "[T0000] and [T0001]"
    assert one(spark, translation.restore(F.lit(hidden), entries)) == "汉城病毒 and 病毒"


def sequential_conflicts(rows):
    """The rule one record at a time, for comparison."""
    out, heads = set(), {}
    for ord_, key, norm, families in sorted(rows):
        if key not in heads:
            heads[key] = (norm, set(families))
            continue
        head, seen = heads[key]
        ratio = 200 * plain_lcs(head, norm) / (len(head) + len(norm))
        if ratio < fixed.CONFLICT_RATIO and not (seen & set(families)):
            out.add(ord_)
        else:
            seen.update(families)
    return out


def test_conflict_split_spreads_family_names_in_order(spark):
    rng = random.Random(2)
    titles = ["alpha beta gamma", "alpha beta gamme", "zzz qqq xxx www", "kkk lll mmm"]
    raw = [(i, f"10.1/{rng.randint(0, 2)}", rng.choice(titles), rng.sample(["Ann A", "Bo B", "Cy C", "Di D"], rng.randint(0, 2))) for i in range(40)]
    papers = spark.createDataFrame(
        [(i, str(i), d, t, a, None) for i, d, t, a in raw],
        "ord bigint, record_id string, doi string, title string, authors array<string>, source_ids map<string,string>",
    )
    got = {r.ord for r in split_conflicts(with_identity(papers)).collect()}
    assert got == sequential_conflicts([(i, d, t, [x.split()[-1].lower() for x in a]) for i, d, t, a in raw])


def test_sentences_keep_digits_that_equal_their_place(spark):
    told = [f"{i} cases were counted in week {i}." for i in range(12)]
    assert one(spark, text.split_sentences(F.lit(" ".join(told)))) == told
    ends = [f"The total of the day {i} came to {i}" for i in range(12)]
    assert one(spark, text.split_sentences(F.lit("；".join(ends)))) == [e + "；" for e in ends[:-1]] + ends[-1:]
