import random
import time

import pytest

from barloom.llm import persons

PARTS = [("Kerrin", "given", "en"), ("Amber", "given", "en"), ("Wren", "given", "en"), ("Hexwater", "family", "en"), ("O'Marrin", "family", "en"), ("柴", "family", "zh"), ("予安", "given", "zh"), (None, None, None)]
F = persons.Finder(PARTS)

CASES = [
    ("Write to kerrin.h@post.example tonight.", [("email", "kerrin.h@post.example")]),
    ("邮箱：wren_66 (at) post dot test 柱状", [("email", "wren_66 (at) post dot test")]),
    ("My address is <rune29 AT mail DOT quill DOT example>, write", [("email", "rune29 AT mail DOT quill DOT example")]),
    ("cc a-b[at]post[dot]test; x", [("email", "a-b[at]post[dot]test")]),
    ("mailto:DORRIT+BARS@BARS.TEST", [("email", "DORRIT+BARS@BARS.TEST")]),
    ("Limit 3.120 @ open; bars@2.3.1 broke it. shares bought at 8.860, price", []),
    ("Tel: +44 (0)7700 900 361", [("phone", "+44 (0)7700 900 361")]),
    ("ring ((020) 7946-0118) if", [("phone", "(020) 7946-0118")]),
    ("电话010-05682348，找交易台。有信号就打 0086-12835354089 叫我", [("phone", "010-05682348"), ("phone", "0086-12835354089")]),
    ("0491 570 239 rang twice; 802-555-0165; +1.429.555.0138", [("phone", "0491 570 239"), ("phone", "802-555-0165"), ("phone", "+1.429.555.0138")]),
    ("手机：12396937447", [("phone", "12396937447")]),
    ("Order ref 2467 3003 9170, Contract 300510-2203-0417, Batch 2041-88-3157, version 10.24.36.48", []),
    ("Ticket 182315520811824669 covers; 委托号 202103150093120047 已撤", []),
    ("KYC file: 990-78-2896 (copy)", [("id_number", "990-78-2896")]),
    ("身份证号：953718199308161888 若", [("id_number", "953718199308161888")]),
    ("证件920831 19830723 3011已核对", [("id_number", "920831 19830723 3011")]),
    ("ID: QQ 15 43 56 C and passport Q74 620207", [("id_number", "QQ 15 43 56 C"), ("id_number", "Q74 620207")]),
    ("parcel for 63 Bellfounder Rd., Carrowfield 31774 came back", [("address", "63 Bellfounder Rd., Carrowfield 31774")]),
    ("Home: Flat 34, 214 Hopyard Avenue, Skerrydale since", [("address", "Flat 34, 214 Hopyard Avenue, Skerrydale")]),
    ("to No. 94, Quarryfold Avenue, Room 621 in spring", [("address", "No. 94, Quarryfold Avenue, Room 621")]),
    ("客户住在岚陵县云栖路69号16幢附近", [("address", "岚陵县云栖路69号16幢")]),
    ("账单寄到青砖巷23号 问", [("address", "青砖巷23号")]),
    ("Main Road resistance at 4.118, Park Lane pattern; Road Map section 4; 第118号公告，3栋厂房", []),
    ("Ms Kerrin Hexwater signed the sheet", [("name", "Kerrin Hexwater")]),
    ("Dr. K. O'Marrin disagreed with the grid", [("name", "K. O'Marrin")]),
    ("on leave: HEXWATER, Kerrin (back)", [("name", "HEXWATER, Kerrin")]),
    ("thanks to corwin hexwater for the bars", [("name", "corwin hexwater")]),
    ("账单寄到82 Hopyard Terrace, Eastmere 93109 问", [("address", "82 Hopyard Terrace, Eastmere 93109")]),
    ("客户住在Flat 21, 163 Bellfounder Rd., Wexcombe附近。", [("address", "Flat 21, 163 Bellfounder Rd., Wexcombe")]),
    ("账户撤回委托。 （0086-12563455492，周末勿扰）", [("phone", "0086-12563455492")]),
    ("I live at 12 Elm Way, Boston", [("address", "12 Elm Way, Boston")]),
    ("the sample is too small W. Hexwater女士已签字", [("name", "W. Hexwater")]),
    ("Kestrel Ridge desk said no; the Salt Grove account called", []),
    ("柴砺今天请假；对方不同意加仓，成交量请假", [("name", "柴砺")]),
    ("昨天和Corwin Netherby聊过，请柴予安先生复核", [("name", "Corwin Netherby"), ("name", "柴予安")]),
    ("联系人：苗砺。", [("name", "苗砺")]),
    ("the Amber Lock book, the Wren Field strategy", []),
]


@pytest.mark.parametrize("text,want", CASES)
def test_mentions(text, want):
    assert [(k, text[a:b]) for k, a, b in F.mentions(text)] == want


def test_places_are_code_points_and_rest_is_unchanged():
    text = "😀 İ 电话010-05682348，找 x"
    assert F.mentions(text) == [("phone", text.index("0"), text.index("，"))]
    assert F.replace(text) == "😀 İ 电话[PHONE]，找 x"
    assert F.replace(None) is None and F.replace("") == "" and F.mentions(None) == []


def test_replaced_text_has_no_mention_left():
    for text, _ in CASES:
        assert F.mentions(F.replace(text)) == []


def test_very_long_text():
    text = "a quiet bar. " * 100_000 + "Tel: 07700 900316" + " x@" * 10_000
    assert [k for k, _, _ in F.mentions(text)] == ["phone"]


def test_frames(spark):
    d = spark.createDataFrame([(1, "Tel: 07700 900316", "a"), (1, "Tel: 07700 900316", "b"), (2, None, "c"), (3, "", "d")], "doc_id long, text string, kind string")
    p = spark.createDataFrame(PARTS, "name_part string, part_kind string, lang string")
    assert [tuple(r) for r in persons.find_mentions(d, p).collect()] == [(1, "phone", 5, 17)] * 2
    assert sorted(map(tuple, persons.replace_mentions(d, p).collect()), key=str) == [(1, "Tel: [PHONE]"), (1, "Tel: [PHONE]"), (2, None), (3, "")]
    assert persons.find_mentions(d.limit(0), p).collect() == [] and persons.find_mentions(d, None).count() == 2
    with pytest.raises(ValueError):
        persons.find_mentions(d, p, most=2)


#: Frames and names written after the parser and not used to make it; no part of these names is listed.
UNSEEN = [
    "I met {} yesterday", "Reviewed by {} on Monday", "Approved by: {}", "{} called me at noon", "The audit was led by {} last year", "Please forward this to {} before lunch", "According to {}, the gap will close",
    "My colleague {} will join the call", "We hired {} as an analyst", "{} said the fill was late", "Signed: {}", "Reporter: {}", "Hi {}, can you check the fill?", "Dear {},\nthe statement is attached.", "Kind regards,\n{}",
    "Best,\n{}\nTrading", "I had lunch with {} and we agreed", "{} and I rebalanced the list", "cc: {}", "Mrs {} lives nearby", "Prof. {} published the note", "On behalf of {} we closed it", "{} retired in March.",
    "The idea came from {} originally", "Interview with {}, head of risk", "{}'s phone is off", "Assignee: {} (due Friday)", "This was written by {} in a hurry", "{} thinks the rule is weak", "We told {} about the gap",
    "Ask {} for the file", "Prepared by {}", "{} resigned on Friday", "the desk manager, {}, disagreed", "Yours sincerely,\n{}", "Employee: {}", "I spoke with {} on Tuesday", "Thank {} for the help", "{} wrote back at once", "Meeting with {} at 3pm",
]
NAMES = ["Olga Petrova", "Priya Raghunathan", "Tomasz K. Wieczorek", "Léa Fontaine", "Amir El-Sayed"]


def test_most_names_in_unseen_sentences_are_found():
    bare = persons.Finder([])
    hits = sum(("name", t.index(n), t.index(n) + len(n)) in bare.mentions(t) for f in UNSEEN for n in NAMES for t in [f.format(n)])
    assert hits >= 0.85 * len(UNSEEN) * len(NAMES)


def test_settlement_equals_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        found = {(rng.randrange(4), a, a + rng.randrange(1, 9), rng.choice("xy")) for a in (rng.randrange(30) for _ in range(rng.randrange(12)))}
        taken = []
        for _, a, neg, kind in sorted((r, a, -b, k) for r, a, b, k in found):
            if all(-neg <= x or a >= y for _, x, y in taken):
                taken.append((kind, a, -neg))
        assert persons.settle(found) == sorted(taken, key=lambda m: m[1])


def test_time_grows_with_the_mentions_and_no_faster():
    text = "Mr Olga Petrova wrote x@post.example. " * 16_000
    began = time.perf_counter()
    assert len(text) == 608_000 and len(F.mentions(text)) == 32_000
    assert time.perf_counter() - began < 10  # a quadratic settlement took 49 s


def test_parts_are_learnt_where_only_persons_stand(spark):
    texts = ["Ms Corwin Netherby was here", "Regards,\nCorwin Netherby", "Account holder: Corwin Netherby", "the Iron Reed desk", "corwin netherby again", "联系人：苗砺。", "苗砺女士到了", "请苗砺先生", "然后苗砺走了", "Dr. Ravi Solo"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(persons.learn_parts(d, [])) == [("corwin", "given", ""), ("netherby", "family", ""), ("砺", "given", ""), ("苗", "family", "")]
    got = sorted((r["doc_id"], texts[r["doc_id"]][r["start_at"] : r["end_at"]]) for r in persons.find_mentions(d, None).collect())
    assert got == [(0, "Corwin Netherby"), (1, "Corwin Netherby"), (2, "Corwin Netherby"), (4, "corwin netherby"), (5, "苗砺"), (6, "苗砺"), (7, "苗砺"), (8, "苗砺"), (9, "Ravi Solo")]
    assert persons.learn_parts(d.limit(0), []) == [] and persons.learn_parts(d.withColumn("text", F_null()), []) == []


def F_null():
    from pyspark.sql import functions as F

    return F.lit(None).cast("string")
