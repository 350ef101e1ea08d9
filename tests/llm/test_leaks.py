import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import leaks

ITEMS = [
    (1, "Suppose rookery and palisade are rival yardarm funds whose slow average turns on Friday and what is the total after nine bars"),
    (2, "假定茱萸岚山三百在2016年3月8日以3.408开盘，随后因两批数据不一致苍耳账户反手做空共3500份，问现金多少？"),
    (3, ""),
]


def brute_chain(cells):
    best = {}
    for d, i in sorted(cells):
        best[(d, i)] = 1 + max((v for (a, b), v in best.items() if a < d and b < i), default=0)
    return max(best.values(), default=0)


def brute_leaks(lists, text, coverage):
    """Every place of every common run of at least RUN_WORDS words, chained; an item shorter than that whole."""
    out = {}
    for item, ts in lists:
        n = leaks.RUN_WORDS if len(ts) >= leaks.RUN_WORDS else len(ts)
        starts = [(d, i) for d in range(len(text) - n + 1) for i in range(len(ts) - n + 1) if n and text[d : d + n] == ts[i : i + n]]
        held = brute_chain({(d + k, i + k) for d, i in starts for k in range(n)})
        if ts and held and held >= coverage * len(ts):
            out[item] = held / len(ts)
    return out


def found(spark, docs, items=ITEMS, **k):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r["doc_id"], r["item_id"]) for r in leaks.find_leaks(d, i, **k).collect())


def test_chain_equals_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        cells = {(rng.randrange(12), rng.randrange(12)) for _ in range(rng.randrange(20))}
        kept = leaks.chain(cells)
        assert len(kept) == brute_chain(cells) and set(kept) <= cells
        assert all(a < c and b < d for (a, b), (c, d) in zip(kept, kept[1:], strict=False))


def test_runs_are_the_longest_matches():
    rng = random.Random(5)
    lists = [(k, [rng.choice("abc") for _ in range(15)]) for k in range(3)]
    auto = leaks.Automaton(lists)
    subs = {tuple(ts[a:b]) for _, ts in lists for a in range(15) for b in range(a + 1, 16)}
    for _ in range(100):
        ts = [rng.choice("abcd") for _ in range(20)]
        got = {at: n for at, _, n in auto.runs(auto.number(ts), 1)}
        for at in range(20):
            assert got.get(at, 0) == max(m for m in range(at + 2) if m == 0 or tuple(ts[at + 1 - m : at + 1]) in subs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", max_size=12), min_size=1, max_size=6), st.text("abcd", max_size=40), st.sampled_from([0.3, 0.5, 0.8]))
def test_every_item_is_credited_like_brute_force(items, text, coverage):
    lists = [(k, list(x)) for k, x in enumerate(items)]
    auto = leaks.Automaton(lists)
    got = {auto.ids[k]: len(x) / int(auto.sizes[k]) for k, x in auto.held(auto.number(list(text)), coverage).items()}
    assert got == pytest.approx(brute_leaks(lists, list(text), coverage))
    cleaned, n = leaks.without_leaks(auto, " ".join(text), coverage, 8)
    assert (n > 0) == bool(got or any(auto.long_runs(auto.number(list(text)), 8)))
    rest = leaks.tokens(cleaned)
    assert not leaks.leaks(auto, cleaned, coverage) and (n or rest == list(text))


def words(*spans):
    return [f"w{k}q" for a, b in spans for k in range(a, b)]


def test_an_item_more_does_not_hide_a_leak(spark):
    """Items of 20 words that share the 12 in the middle: a text with 16 words of one leaks all, however many they are."""
    for n in (12, 13, 40):
        items = [(k, " ".join(words((1000 * k, 1000 * k + 4), (0, 12), (1000 * k + 12, 1000 * k + 16)))) for k in range(1, n + 1)]
        text = "so " + " ".join(words((5000, 5002), (5002, 5004), (0, 12))) + " and on"
        assert found(spark, [(1, text)], items) == [(1, k) for k in range(1, n + 1)]


def test_distance_and_length_of_the_text_do_not_matter(spark):
    item = words((0, 12))
    for apart in (10, 40, 80, 5000):
        filler = " ".join(["bar"] * apart)
        text = f"{filler} {' '.join(item[:4])} {filler} {' '.join(item[4:8])} {filler} {' '.join(item[8:])} {filler}"
        assert found(spark, [(1, text)], [(7, " ".join(item))]) == [(1, 7)]


def test_near_equal_items_do_not_hide_each_other(spark):
    a, b = words((0, 10)), words((0, 8), (50, 52))
    assert found(spark, [(1, " ".join(a))], [(1, " ".join(a)), (2, " ".join(b))]) == [(1, 1), (1, 2)]


def test_shards_change_nothing(spark):
    rng = random.Random(11)
    items = [(k, " ".join(f"v{rng.randrange(40)}" for _ in range(12))) for k in range(30)]
    docs = [(k, " ".join(items[rng.randrange(30)][1].split()[2:] + [f"v{rng.randrange(40)}" for _ in range(30)])) for k in range(20)]
    whole = found(spark, docs, items)
    assert whole and found(spark, docs, items, shard_chars=100) == whole
    d, i = spark.createDataFrame([*docs, (99, None), (98, "")], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    cleaned = leaks.remove_leaks(d, i, shard_chars=100)
    assert leaks.find_leaks(cleaned, i).count() == 0
    rows = {r["doc_id"]: r for r in cleaned.collect()}
    assert rows[99]["text"] is None and rows[98]["text"] == "" and rows[99]["removed_chars"] == 0 and len(rows) == 22


def test_only_what_leaks_is_removed():
    auto = leaks.Automaton([(1, leaks.tokens(ITEMS[0][1])), (2, leaks.tokens(ITEMS[1][1]))])
    for item in (ITEMS[0][1], ITEMS[1][1].rstrip("？")):
        text, n = leaks.without_leaks(auto, f"Thé first bar. {item} 然后 last bar.")
        assert text == f"Thé first bar.  {leaks.MARK}  然后 last bar." and n == len(item)
    plain = "nothing of the kind in this text at all"
    assert leaks.without_leaks(auto, plain) == (plain, 0)
    long = " ".join(words((0, 300)))
    auto = leaks.Automaton([(1, leaks.tokens(long))])
    assert not leaks.leaks(auto, " ".join(words((20, 70))))
    assert leaks.without_leaks(auto, "a " + " ".join(words((20, 70))) + " b")[0] == f"a  {leaks.MARK}  b"
    assert leaks.without_leaks(auto, "a " + " ".join(words((20, 50))) + " b")[1] == 0


def test_whole_part_altered_and_unrelated(spark):
    en, zh = ITEMS[0][1], ITEMS[1][1]
    words = en.split()
    docs = [
        (1, f"Intro. {en} Outro."), (2, en.upper().replace("ROOKERY", "ROKOERY")), (3, " ".join(words[:14])), (4, " ".join(words[:5])), (5, f"before{zh}after"),
        (6, zh[: len(zh) // 4]), (7, None), (8, ""), (9, "   "), (10, en.replace(" ", " ").replace("total", "to​tal")), (11, " ".join(reversed(words))),
        (12, " ".join(words[:10]) + " something else was put here " + " ".join(words[10:])), (1, en),
    ]
    assert found(spark, docs) == [(1, 1), (1, 1), (2, 1), (3, 1), (5, 2), (10, 1), (12, 1)]


def test_empty_tables_and_equal_items(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, ITEMS[0][1])], []) == []
    assert found(spark, [(1, ITEMS[0][1])], [(1, ITEMS[0][1]), (9, ITEMS[0][1])]) == [(1, 1), (1, 9)]


def test_a_long_text_of_phrases_leaks_nothing_and_a_long_text_with_a_passage_does(spark):
    filler = "the fund waited one more bar and the stop was moved " * 20_000
    assert found(spark, [(1, filler), (2, filler + ITEMS[0][1] + filler)]) == [(2, 1)]


def test_leaking_documents(spark):
    d = spark.createDataFrame([(1, 2, 0.5), (1, 1, 0.9), (2, 1, 1.0)], "doc_id long, item_id long, share double")
    assert sorted(map(tuple, leaks.leaking_documents(d).collect())) == [(1, [1, 2], 0.9), (2, [1], 1.0)]
