"""Personal information inside free text.

Anchor expansion: an Aho-Corasick automaton finds anchors (at-signs and how
they are spelt out, telephone and identity cues, number prefixes, street
words, name parts, titles, labels and words that persons do or have done to
them); a deterministic local parser of each kind expands the text around an
anchor to the whole mention and validates it.  Every mention is replaced by a
placeholder of its type; the rest of the text is unchanged.

Kinds: email, phone, id_number, address, name.  A mention's start is that of
its first character as written: a leading + or bracket of a phone number
belongs to it, a title does not, an address starts at its first part.

A name is believed on general evidence, not on whole sentences: two known
parts; or a title, a label of a person or the closing of a letter beside it;
or, for capitalised words none of which is an ordinary one, a verb of speech
or dealing, an agent's "by" or a label, unless an article before or a noun
such as fund or desk behind makes it a thing.  The list of parts is
incomplete; what stands where only a person can, throughout the corpus, is
learnt as further parts first.

Scale: texts are scanned where they lie, in Arrow batches, without a shuffle of
texts; a parser looks at a bounded surrounding of its anchor only and
candidates are settled in one sweep for each rank, so time is n log n in the
text, however long it is.  Learning takes one pass of the texts and an
aggregate of words; what it gives is bounded, as every learnt part holds a
fixed share of all.  Listed parts are a small fixed table whose size is checked.

Defined results: null texts have no mentions and stay null; empty and blank
texts have none; overlapping candidates are settled in favour of the more
strictly validated kind, then the first, then the longer one; repeated texts
are each reported; without a list of name parts, names are found by cues only.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import spread

KINDS = ("email", "id_number", "phone", "address", "name")
#: The list of name parts must not exceed this many rows.
MOST_NAME_PARTS = 100_000
#: A part is learnt if it stands where only a person can in this many documents and in this share of all such places.
LEAST_SEEN, LEAST_PART = 3, 0.0001

_HAN = "㐀-䶿一-鿿"
_LATIN = "A-Za-zÀ-ÖØ-öø-ž"
# ---- anchors, fixed values -------------------------------------------------
AT = ("@", "＠", "(at)", "[at]", "{at}", "<at>", " at ", "[ at ]", "( at )")
PHONE_CUES = ("phone", "tel", "call", "mobile", "cell", "text me on", "ring", "line is", "reach me", "whatsapp", "fax", "电话", "手机", "拨打", "就打", "致电", "热线")
PHONE_PREFIXES = ("+", "(", "（", "00", "01", "02", "03", "04", "05", "06", "07", "08", "09", "12", "13", "14", "15", "16", "17", "18", "19", "555")
CENTURIES = ("19", "20")
ID_CUES = ("id:", "id no", "identity", "identification", "kyc", "tax payer", "taxpayer", "passport", "social security", "national insurance", "ssn", "身份证", "证件", "护照", "实名")
NO_PERSON_CUES = ("order", "ref", "ticket", "contract", "batch", "version", "build", "委托", "合同", "工单", "版本", "编号")
STREETS = ("road", "street", "lane", "avenue", "close", "terrace", "drive", "court", "square", "crescent", "way", "place", "row", "gardens", "mews", "quay", "parade", "boulevard", "rd", "st", "ave", "ln", "dr", "blvd", "路", "街", "巷", "大道", "胡同", "弄")
TITLES = ("mr", "ms", "mrs", "miss", "dr", "prof", "professor", "sir", "madam")
#: Labels of a person's field: what stands before a colon.
LABELS = ("name", "owner", "holder", "trader", "contact", "attn", "attention", "manager", "analyst", "author", "signed", "by", "from", "to", "cc", "client", "customer", "employee", "staff", "caller", "witness", "applicant", "tenant", "sender", "recipient", "assignee", "reporter", "reviewer", "editor", "leave", "absent", "present", "attendee", "attendees", "chair", "secretary", "payee", "beneficiary", "person", "user")
#: How letters close.
CLOSINGS = ("regards", "sincerely", "yours", "cheers", "best", "wishes", "faithfully", "respectfully", "thanks")
#: Words directly before a person who is spoken to, dealt with or has done something.
BEFORE = ("by", "with", "from", "ask", "asked", "tell", "told", "met", "meet", "called", "phoned", "emailed", "contact", "contacted", "thank", "thanks to", "spoke to", "spoke with", "speak to", "speak with", "talk to", "talked to", "talk with", "talked with", "meeting with", "call with", "behalf of", "according to", "wrote to", "write to", "reply to", "replied to", "introduced", "hired", "invited", "colleague", "named", "i am", "i'm", "my name is", "dear", "hi", "hello")
#: Words directly behind a person who speaks, writes, thinks or deals.
BEHIND = ("wrote", "writes", "said", "says", "signed", "signs", "disagreed", "disagrees", "agreed", "agrees", "asked", "asks", "called", "told", "tells", "thinks", "thought", "believes", "noted", "explained", "reviewed", "approved", "confirmed", "reported", "joined", "resigned", "replied", "answered", "sent", "forwarded", "phoned", "emailed", "lives", "works", "retired", "promised", "complained", "admitted", "suggested", "objected", "insisted", "argued", "apologised", "apologized", "remembers", "forgot", "who")
#: Nouns of things that bear names: before them capitalised words are no person.
THINGS = frozenset("desk fund funds book strategy strategies setup account portfolio mandate sleeve basket bank street road lane avenue company ltd inc plc group index board team capital partners partnership trust office branch pattern section chapter drill lot side ticket session model system report gap rule cross line".split())
ARTICLES = frozenset("the a an this that these those our their its his her my your each every no some any".split())
ZH_BEHIND = ("女士", "先生", "小姐", "老师", "经理", "主任")
ZH_VERBS = ("请假", "休假", "聊", "谈", "说", "表示", "认为", "提供", "告诉", "通知", "回复", "来电", "打来", "签字", "签署", "复核", "审批", "批准", "负责", "确认", "建议", "提出", "反对", "离职", "入职", "出差", "汇报", "写道", "指出", "转发", "解释", "强调", "补充", "来访", "参加", "主持", "介绍", "询问", "要求", "发来", "寄来")
ZH_WHEN = ("今天", "昨天", "明天", "今早", "昨晚", "上周", "本周", "下周", "已经", "已", "刚刚", "刚", "正在", "曾")
ZH_LEADS = ("感谢", "联系", "转告", "请", "和", "与", "跟", "同", "向", "找", "问", "由", "让", "给", "谢", "据", "经", "叫", "是")
ZH_LABELS = ("人", "经办", "姓名", "客户", "复核", "审批", "签字", "交易员", "经理", "收件", "寄件", "用户", "负责")

# ---- parsers ---------------------------------------------------------------
_AT_ANY = r"(?:\s?(?:@|＠|[(\[{<]\s?at\s?[)\]}>])\s?|\s(?:at|AT)\s)"
_DOT = r"(?:\.|\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\s(?:dot|DOT)\s)"
_EMAIL = re.compile(rf"([A-Za-z0-9](?:[A-Za-z0-9._%+'\-]{{0,62}}[A-Za-z0-9])?)({_AT_ANY})([A-Za-z0-9][A-Za-z0-9\-]{{0,62}}(?:{_DOT}[A-Za-z0-9][A-Za-z0-9\-]{{0,62}}){{1,4}})", re.IGNORECASE)
_EMAIL_AROUND = 90

_SEP = r"[\s\-.·]?"
_PHONES = [
    r"(?:\+|00)44\s?(?:[(（]0[)）]\s?)?\d{2,4}[\s\-]?\d{3,4}[\s\-]?\d{3,4}",
    r"(?:\+|00)86[\s\-]?1\d{2}[\s\-]?\d{4}[\s\-]?\d{4}",
    r"(?:\+|00)86[\s\-]?(?:[(（]?0?\d{2,3}[)）]?)[\s\-]?\d{3,4}[\s\-]?\d{4}",
    r"\+1[\s.\-]?[(（]?\d{3}[)）]?[\s.\-]?\d{3}[\s.\-]?\d{4}",
    r"\+\d{1,3}[\s.\-]?[(（]?\d{1,4}[)）]?(?:[\s.\-]?\d{2,4}){2,4}",
    r"[(（]0\d{2,4}[)）]\s?\d{3,4}[\s\-]?\d{4}",
    r"[(（]\d{3}[)）]\s?\d{3}[\s\-.]\d{4}",
    r"0\d{2,3}-\d{7,8}",
    r"02\d\s\d{4}\s\d{4}",
    r"0[17]\d{3}\s?\d{6}",
    r"04\d{2}\s\d{3}\s\d{3}",
    r"\d{3}[\-.]\d{3}[\-.]\d{4}",
    r"\d{3}\s555\s\d{4}",
    r"1[2-9]\d\s\d{4}\s\d{4}",
    r"1[2-9]\d-\d{4}-\d{4}",
    r"1[2-9]\d{9}",
]
_PHONE = re.compile(r"(?<![\d.,\-/A-Za-z])(?:" + "|".join(_PHONES) + r")(?![\d]|[\-.,/]\d)")
_PHONE_LOOSE = re.compile(r"[+(（]?\d(?:[\d\s\-.()（）]{5,20})\d(?!\d)")
_CN_ID = re.compile(r"(?<!\d)\d{6}[\s\-]?\d{8}[\s\-]?\d{3}[\dXx](?![\dA-Za-z])")
_SSN = re.compile(r"(?<![\d\-.])\d{3}([\- ])\d{2}\1\d{4}(?![\d\-])")
_NINO = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-D](?![A-Za-z0-9])", re.IGNORECASE)
_PASSPORT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,2}\d{2}\s?\d{5,7}(?![A-Za-z0-9])", re.IGNORECASE)
_WEIGHTS, _CHECKS = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2), "10X98765432"

_STREET_EN = r"(?:Road|Street|Lane|Avenue|Close|Terrace|Drive|Court|Square|Crescent|Way|Place|Row|Gardens|Mews|Quay|Parade|Boulevard|Rd|St|Ave|Ln|Dr|Blvd)\b\.?"
_ADDRESS_EN = re.compile(
    rf"(?<![A-Za-z0-9_.])(?:(?:Flat|Apt|Apartment|Unit|Suite|Room|No\.?|Number)\s?\d+[A-Za-z]?,?\s+)?\d{{1,5}}[A-Za-z]?,?\s(?:[A-Z][A-Za-z0-9'’\-]+\s){{1,3}}{_STREET_EN}"
    rf"(?:,\s(?:Apt|Flat|Room|Unit|Suite|Apartment)\.?\s?\d+[A-Za-z]?)?(?:,\s[A-Z][A-Za-z\-]+(?:\s(?=[A-Z])[A-Z][A-Za-z\-]+)?(?:\s\d{{5}}(?!\d))?)?"
    rf"|(?<![A-Za-z0-9_.])No\.?\s?\d{{1,5}}[A-Za-z]?,?\s(?:[A-Z][A-Za-z0-9'’\-]+\s){{1,3}}{_STREET_EN}(?:,\s(?:Apt|Flat|Room|Unit|Suite)\.?\s?\d+[A-Za-z]?)?")
_ADDRESS_AROUND = 60
_REGION = rf"(?:[{_HAN}]{{2,3}}(?:省|自治区))?(?:[{_HAN}]{{2,3}}(?:市|州|盟))?(?:[{_HAN}]{{2,3}}(?:区|县|旗|镇|乡))?"
_STREET_ZH = re.compile(rf"(?P<road>[{_HAN}]{{1,3}}?(?:大道|胡同|路|街|巷|弄))(?P<no>\s?\d{{1,5}}\s?(?:号|弄))(?P<rest>(?:\s?\d{{1,4}}\s?(?:栋|幢|号楼|座|单元|室|楼|层|号))*)")
_REGION_END = re.compile(rf"{_REGION}$")
_BEFORE_ROAD = re.compile(rf"(?:住在|寄到|位于|地址[：:]?|住址[：:]?|在|到|是|于|至|往|从|搬到)$")


def _valid_cn(s: str) -> bool:
    s = re.sub(r"[\s\-]", "", s).upper()
    if not ("1900" <= s[6:10] <= "2099" and "01" <= s[10:12] <= "12" and "01" <= s[12:14] <= "31"):
        return False
    return _CHECKS[sum(int(a) * w for a, w in zip(s[:17], _WEIGHTS, strict=True)) % 11] == s[17]


_WORD = rf"[{_LATIN}](?:[{_LATIN}]|['’\-](?=[{_LATIN}]))+"
_INITIAL = r"[A-Za-z]\."
_END = rf"(?:(?<=\.)|(?![{_LATIN}0-9_@\-]))"
_START = rf"(?<![{_LATIN}0-9_@.\-+])"
#: first and last part, of "Given Family", "Given I. Family", "I. Family"; "Family, Given"; "Given I."
_FORWARD = re.compile(rf"(?P<first>{_WORD}|{_INITIAL})(?P<mid>(?:\s{_INITIAL})?)\s(?P<last>{_WORD}){_END}")
_COMMA = re.compile(rf"(?P<last>{_WORD}),\s(?P<first>{_WORD}|{_INITIAL}){_END}")
_SHORT = re.compile(rf"(?P<first>{_WORD})\s(?P<last>[A-Z]\.)(?!\s?[a-z]?\w*@)")
_LAST_WORDS = re.compile(rf"{_START}(?:{_WORD}(?:,\s(?:{_WORD}|{_INITIAL})|(?:\s{_INITIAL})?\s{_WORD}|\s[A-Z]\.)|{_INITIAL}(?:\s{_INITIAL})?\s{_WORD})$")
_TITLE = re.compile(r"(?:Mr|Ms|Mrs|Miss|Dr|Prof|Professor|Sir|Madam)\.?\s", re.IGNORECASE)
_ZH = re.compile(f"[{_HAN}]")


def _lower(text: str) -> str:
    low = text.lower()  # a few characters change their length
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def settle(found: set[tuple[int, int, int, str]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) without overlaps: of (rank, start, end, kind) lower ranks first, then what starts
    first, then what is longer.  One sweep over what is kept so far for each rank."""
    kept: list[tuple[int, int, str]] = []
    for rank in sorted({x[0] for x in found}):
        at, last, new = 0, 0, []
        for a, neg, kind in sorted((a, -b, kind) for r, a, b, kind in found if r == rank):
            while at < len(kept) and kept[at][1] <= a:
                at += 1
            if a >= last and not (at < len(kept) and kept[at][0] < -neg):
                new.append((a, -neg, kind))
                last = -neg
        kept = list(heapq.merge(kept, new))
    return [(kind, a, b) for a, b, kind in kept]


class Finder:
    """Finds the mentions of one text.  parts: (part, kind given or family, language)."""

    def __init__(self, parts: list[tuple[str, str, str]]):
        self.parts = parts
        clean = {(p.strip(), k) for p, k, _ in parts if p and p.strip() and k}
        han = {(p, k) for p, k in clean if re.fullmatch(f"[{_HAN}]+", p)}
        self.given = {p.casefold() for p, k in clean - han if k == "given"}
        self.family = {p.casefold() for p, k in clean - han if k == "family"}
        self.zh_family = {p for p, k in han if k == "family"}
        self.zh_given = {p for p, k in han if k == "given"}
        auto = ahocorasick.Automaton()

        def add(words, tag):
            for w in words:
                tags = auto.get(w, ()) if w in auto else ()
                auto.add_word(w, (*tags, (tag, len(w))))

        add(AT, "email")
        add(PHONE_CUES, "phone_cue")
        add(PHONE_PREFIXES, "phone")
        add(CENTURIES, "century")
        add(ID_CUES, "id_cue")
        add(STREETS, "street")
        add([f"{t}{dot} " for t in TITLES for dot in ("", ".")], "title")
        add((":", "："), "label")
        add(CLOSINGS, "closing")
        add([f"{w} " for w in BEFORE], "before")
        add([f" {w}" for w in BEHIND], "behind")
        add(ZH_BEHIND, "zh_title")
        add(ZH_VERBS, "zh_verb")
        add(self.family | self.given, "name")
        add(self.zh_family, "zh_name")
        auto.make_automaton()
        self.auto = auto

    def __reduce__(self):
        return Finder, (self.parts,)

    def mentions(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end), ordered by start, not overlapping."""
        if not text:
            return []
        low = _lower(text)
        found: set[tuple[int, int, int, str]] = set()
        for end, tags in self.auto.iter(low):
            for tag, n in tags:
                getattr(self, "_" + tag)(text, low, end + 1 - n, end + 1, found)
        return settle(found)

    # each parser gets the anchor's place and adds (rank, start, end, kind)
    def _email(self, text, low, a, b, found):
        lo = max(0, a - _EMAIL_AROUND)
        for m in _EMAIL.finditer(text, lo, min(len(text), b + _EMAIL_AROUND)):
            if m.start(2) <= a < m.end(2) or a <= m.start(2) < b:
                plain = any(c in m[2] for c in "@＠([{<")
                tail = re.split(_DOT, m[3], flags=re.IGNORECASE)
                if not plain and not re.search(r"\sdot\s", m[3], re.IGNORECASE):
                    continue  # an ordinary "at"
                if len(tail[-1]) < 2 or any(x.isdigit() for x in tail) or (m.start() == lo and lo > 0 and text[lo - 1].isalnum()):
                    continue
                found.add((0, m.start(), m.end(), "email"))

    def _business(self, low, a):
        """Within the clause before, the number is said to be one of business."""
        clause = re.split(r"[。，；！？.,;!?\n]", low[max(0, a - 14) : a])[-1]
        return any(c in clause for c in NO_PERSON_CUES)

    def _id_cue(self, text, low, a, b, found):
        """The first identity number within a few words behind the cue, or else the last one before it;
        before it first where the cue says what something serves as."""
        best = None
        sides = [(b, min(len(text), b + 48), True), (max(0, a - 40), a, False)]
        for lo, hi, behind in sides[::-1] if re.search(r"\b(?:as|for)\s[\w\s]*$", low[max(0, a - 14) : a]) else sides:
            for p in (_CN_ID, _SSN, _NINO, _PASSPORT):
                for m in p.finditer(text, lo, hi):
                    if (p is not _CN_ID or _valid_cn(m[0])) and (best is None or (m.start() < best.start()) == behind):
                        best = m
            if best:
                break
        if best and not self._business(low, best.start()):
            found.add((1, best.start(), best.end(), "id_number"))

    def _century(self, text, low, a, b, found):
        """The year of birth within a national identity number, which its own check digit confirms."""
        for lead in (6, 7):
            if a >= lead and text[a - 1] in "0123456789 -" and text[a - lead] in "0123456789":
                m = _CN_ID.match(text, a - lead)
                if m and _valid_cn(m[0]) and not self._business(low, m.start()):
                    found.add((1, m.start(), m.end(), "id_number"))

    def _phone(self, text, low, a, b, found):
        """A prefix that begins a number, or the exchange within one."""
        if low[a] == "5":
            m = next((m for m in _PHONE.finditer(text, max(0, a - 8), min(len(text), b + 8)) if m.start() < a < m.end()), None)
        elif a and (low[a - 1].isdigit() or low[a - 1] in ".,-/"):
            return
        else:
            m = _PHONE.match(text, a)
        if m and not self._business(low, m.start()):
            found.add((2, m.start(), m.end(), "phone"))

    def _phone_cue(self, text, low, a, b, found):
        m = _PHONE_LOOSE.match(text, next((k for k in range(b, min(b + 6, len(text))) if text[k] in "+(（0123456789"), b))
        if m and 9 <= sum(c.isdigit() for c in m[0]) <= 14 and not re.match(r"\d{4}[\-/.]\d{1,2}[\-/.]\d{1,2}|\d+\.\d+(?!\.)", m[0]):
            found.add((5, m.start(), m.end(), "phone"))

    def _street(self, text, low, a, b, found):
        if text[a] > "⺀":
            for m in _STREET_ZH.finditer(text, max(0, a - 3), min(len(text), b + 40)):
                if not m.start() <= a < m.end("road"):
                    continue
                start = m.start("road")
                # the road's name is the two characters before the street word, or all from the region on
                name_at = text.rfind(m["road"][-1], start, m.end("road"))
                suffix = 2 if m["road"].endswith(("大道", "胡同")) else 1
                name_at = m.end("road") - suffix
                best = None
                for k in (1, 2, 3, 4):
                    region = _REGION_END.search(text, max(0, name_at - k - 12), name_at - k)
                    if region and region[0]:
                        best = region.start()
                        lead = _BEFORE_ROAD_IN.search(region[0])
                        if lead:
                            best += lead.end()
                        break
                start = best if best is not None else max(0, name_at - 2)
                found.add((3, start, m.end(), "address"))
                return
        if (a and low[a - 1].isalnum()) or (b < len(low) and low[b].isalnum()):
            return
        for m in _ADDRESS_EN.finditer(text, max(0, a - _ADDRESS_AROUND), min(len(text), b + _ADDRESS_AROUND)):
            if m.start() <= a < m.end():
                found.add((3, m.start(), m.end(), "address"))

    # ---- names
    def _known(self, m: re.Match) -> int:
        """How many of the two parts are known."""
        return (m["first"].casefold() in self.given) + (m["last"].casefold() in self.family)

    @staticmethod
    def _like_a_name(m: re.Match) -> bool:
        if m["first"][0].isupper() != m["last"][0].isupper():
            return False
        return not ({m["first"].casefold(), m["last"].casefold()} & _ORDINARY or _TITLE.match(m["first"] + " "))

    @staticmethod
    def _a_thing(text: str, a: int, b: int) -> bool:
        """An article before or a noun of things behind."""
        before = re.search(r"([A-Za-z]+)\s+$", text[max(0, a - 12) : a])
        behind = re.match(r"\s+([A-Za-z]+)", text[b : b + 16])
        return bool(before and before[1].lower() in ARTICLES or behind and behind[1].lower() in THINGS)

    def _shapes(self, text: str, a: int):
        """What can be a name from place ``a`` on, likelier shapes first."""
        hi = min(len(text), a + 60)
        m = _COMMA.match(text, a, hi)
        if m and (m["last"].casefold() in self.family or m["first"].casefold() in self.given or m["last"].isupper() and len(m["last"]) > 2):
            yield m
        for p in (_FORWARD, _SHORT):
            if m := p.match(text, a, hi):
                yield m

    def _name(self, text, low, a, b, found):
        """A known part: with a second one, or with an initial, it is a name."""
        if (a and (low[a - 1].isascii() and low[a - 1].isalnum() or low[a - 1] in "@_")) or (b < len(low) and (low[b].isascii() and low[b].isalnum() or low[b] in "@_")):
            return
        starts = [a] + [m.start() for m in re.finditer(rf"{_START}(?:{_WORD}|{_INITIAL})(?=,?\s)", text[max(0, a - 40) : a])]
        for s in [a] + [max(0, a - 40) + k for k in starts[1:]]:
            for m in self._shapes(text, s):
                if not (m.start() <= a and b <= m.end()):
                    continue
                first, last = m["first"].casefold() in self.given, m["last"].casefold() in self.family
                initial = m["first"].endswith(".") and len(m["first"]) == 2
                if m.re is _SHORT:
                    sure = first
                else:
                    sure = last and (first or initial) or m.re is _FORWARD and bool(m["mid"]) and (first or last) and m["first"][0].isupper() and m["last"][0].isupper() and self._like_a_name(m)
                if sure and not (m.re is _COMMA and not (first or initial)):
                    found.add((4, m.start(), m.end(), "name"))
                    return

    def _here(self, text, a, found, strong, shouted=False):
        """A name from place ``a`` on, beside a cue."""
        if t := _TITLE.match(text, a, a + 11):
            a, strong = t.end(), True
        for m in self._shapes(text, a):
            if self._believed(text, m, strong, shouted):
                found.add((4, m.start(), m.end(), "name"))
                return

    def _believed(self, text, m, strong, shouted):
        """Strong cues are enough for any two words that are no ordinary ones; others ask for capitals
        (for a known part where the cue itself is in capitals, or there are none) and no sign of a thing."""
        if not self._like_a_name(m):
            return False
        known = self._known(m)
        capital = m["first"][0].isupper() and m["last"][0].isupper()
        if self._a_thing(text, m.start(), m.end()) and known < 2:
            return False
        if m.re is _SHORT:
            return capital and (strong or known > 0)
        return strong or (known > 0 if shouted or not capital else True)

    def _title(self, text, low, a, b, found):
        if not (a and low[a - 1].isascii() and low[a - 1].isalnum()):
            self._here(text, b, found, True)

    def _label(self, text, low, a, b, found):
        """A field's label: a word of persons makes its value a name; another label asks for more."""
        word = re.search(r"([A-Za-z]+)[\"'\s]*$", text[max(0, a - 20) : a])
        at = b
        while at < len(text) and at < b + 4 and text[at] in " \t\"'":
            at += 1
        if word:
            if word[1].lower() in LABELS:
                self._here(text, at, found, True)
        elif a and _ZH.match(text[a - 1]) and text[max(0, a - 4) : a].endswith(ZH_LABELS):
            self._here(text, at, found, True)
            self._zh_here(text, at, found)

    def _closing(self, text, low, a, b, found):
        m = re.compile(r",?[ \t]*\r?\n\s*|,\s*").match(text, b, b + 12)
        if m and not (a and low[a - 1].isalnum()):
            self._here(text, m.end(), found, True)

    def _before(self, text, low, a, b, found):
        if not (a and low[a - 1].isascii() and low[a - 1].isalnum()):
            self._here(text, b, found, False, text[a:b].strip().isupper() and len(text[a:b].strip()) > 1)

    def _behind(self, text, low, a, b, found):
        if b < len(low) and low[b].isascii() and low[b].isalnum():
            return
        self._there(text, a, found, text[a:b].strip().isupper())

    def _there(self, text, b, found, shouted=False, strong=False):
        """A name up to place ``b``, before a cue."""
        lo = max(0, b - 60)
        if m := _LAST_WORDS.search(text[lo:b]):
            a = lo + m.start()
            words = list(re.finditer(rf"{_START}(?:{_WORD}|{_INITIAL})", text[a:b]))
            for w in words:  # a word too many may stand before the name
                for x in self._shapes(text, a + w.start()):
                    if x.end() == b and not (x.re is _FORWARD and x["mid"] == "" and x["first"].endswith(".") and w is not words[0]):
                        opens = strong or self._opens(text, x.start())
                        if self._believed(text, x, strong, shouted) and (opens or self._known(x)):
                            found.add((4, x.start(), x.end(), "name"))
                            return

    @staticmethod
    def _opens(text, a):
        """A sentence, a line or a clause begins here, or a title stands before."""
        lead = text[max(0, a - 12) : a].rstrip(" ")
        return not lead or lead[-1] in ".!?;:,)(\n\r\t\"'“>|–—" or _ZH.match(lead[-1]) is not None or lead.lower().rstrip(".").endswith(TITLES) or lead.lower().endswith(("and", "but", "that", "when", "because", "then"))

    # Han names
    def _zh_here(self, text, b, found):
        """Two to four characters from ``b`` to where the run of Han characters ends or a person's word begins."""
        run = re.compile(f"[{_HAN}]{{2,10}}").match(text, b)
        if not run:
            return
        for size in (2, 3, 4):
            rest = text[b + size : b + size + 4]
            if size <= len(run[0]) and (size == len(run[0]) or rest.startswith(ZH_BEHIND + ZH_WHEN + ZH_VERBS)):
                if size < 4 or text[b : b + 2] in self.zh_family:
                    found.add((6, b, b + size, "name"))
                return

    def _zh_there(self, text, e, found, sure):
        """Two to four characters up to ``e`` behind a break or a word that leads to a person.  Unless ``sure``,
        the first must be a known family name."""
        for size in (2, 3, 4):
            a = e - size
            if a < 0 or not _ZH.match(text[a]):
                return
            lead = text[max(0, a - 2) : a]
            if (not lead or not _ZH.match(lead[-1]) or lead.endswith(ZH_LEADS)) and not text[a:e].startswith(ZH_LEADS):
                if (sure and size < 4) or text[a] in self.zh_family or text[a : a + 2] in self.zh_family:
                    found.add((6, a, e, "name"))
                    return

    def _zh_title(self, text, low, a, b, found):
        self._zh_there(text, a, found, True)
        self._there(text, a, found, strong=True)

    def _zh_verb(self, text, low, a, b, found):
        for when in ZH_WHEN:
            if text.endswith(when, max(0, a - 4), a) if a else False:
                a -= len(when)
                break
        self._zh_there(text, a, found, False)
        self._there(text, a, found)

    def _zh_name(self, text, low, a, b, found):
        for size in (2, 1, 3):
            if text[b : b + size] in self.zh_given and b + size <= len(text):
                found.add((4, a, b + size, "name"))
                return

    def sure_parts(self, text: str | None) -> list[tuple[str, str]]:
        """(part, kind) of the names that stand where only a person can: behind a title, a label of
        persons or the closing of a letter, or before a title."""
        if not text:
            return []
        low = _lower(text)
        out = []
        for end, tags in self.auto.iter(low):
            for tag, n in tags:
                if tag in ("title", "label", "closing", "zh_title"):
                    found: set[tuple[int, int, int, str]] = set()
                    getattr(self, "_" + tag)(text, low, end + 1 - n, end + 1, found)
                    for _, a, b, _ in found:
                        name = text[a:b]
                        if _ZH.match(name):
                            if len(name) < 4:
                                out += [(name[0], "family"), (name[1:], "given")]
                            continue
                        for m in list(self._shapes(name, 0))[:1]:
                            if name[0].isupper():
                                out += [(m[k].casefold(), kind) for k, kind in (("first", "given"), ("last", "family")) if not m[k].endswith(".")]
        return out

    def replace(self, text: str | None) -> str | None:
        """The text with every mention as a placeholder of its type."""
        if not text:
            return text
        out, last = [], 0
        for kind, a, b in self.mentions(text):
            out += [text[last:a], f"[{kind.upper()}]"]
            last = b
        return "".join(out) + text[last:]


_ORDINARY = frozenset(
    "the a an and or of for to in on at by with from this that my our his her their it we you he she they lot bar bars before after about again desk fund funds order nobody everyone someone regards as is was are were be been has have had will would can could may might must shall should not no yes "
    "two one three all any some each every both loads readers here there where when why what who which how if then so but while during between because until since only also just now today tomorrow yesterday please thanks dear hi hello "
    "monday tuesday wednesday thursday friday saturday sunday january february march april june july august september october november december "
    "mr ms mrs miss dr prof professor sir madam me him us them i your its total price cash slippage account portfolio strategy market team bank desk".split())
_BEFORE_ROAD_IN = re.compile("^.*(?:住在|寄到|位于|地址|住址|在|到|于)")


def learn_parts(documents: DataFrame, listed: list[tuple[str, str, str]], least: int = LEAST_SEEN, share: float = LEAST_PART) -> list[tuple[str, str, str]]:
    """Further name parts: what stands where only a person can in at least ``least`` documents and in
    ``share`` of all such places, over the whole corpus; so there are at most 2 / ``share`` of them."""
    shared = documents.sparkSession.sparkContext.broadcast(Finder(listed))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = shared.value
        for b in batches:
            yield pd.DataFrame([x for text in b["text"] for x in set(f.sure_parts(text))], columns=["part", "kind"])

    seen = documents.select("text").where("text is not null").mapInPandas(scan, "part string, kind string")
    counts = seen.groupBy("part", "kind").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("kind"))
    kept = counts.withColumn("all", total).where((F.col("n") >= least) & (F.col("n") >= share * F.col("all")))
    return [(r["part"], r["kind"], "") for r in kept.orderBy("part", "kind").select("part", "kind").collect()]


def _finder(documents: DataFrame, name_parts: DataFrame | None, most: int):
    rows = []
    if name_parts is not None:
        rows = [(r["name_part"], r["part_kind"], r["lang"]) for r in name_parts.select("name_part", "part_kind", "lang").limit(most + 1).collect()]
        if len(rows) > most:
            raise ValueError("the list of name parts exceeds the size that may be sent to the executors")
    rows = sorted(rows, key=str)
    return documents.sparkSession.sparkContext.broadcast(Finder(rows + learn_parts(documents, rows)))


def find_mentions(documents: DataFrame, name_parts: DataFrame | None, most: int = MOST_NAME_PARTS) -> DataFrame:
    """doc_id, kind, start_at, end_at: a row per mention; places are 0-based code points."""
    documents = spread(documents.select("doc_id", "text"))
    finder = _finder(documents, name_parts, most)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = finder.value
        for b in batches:
            yield pd.DataFrame([(doc, *m) for doc, text in zip(b["doc_id"], b["text"], strict=True) for m in f.mentions(text)], columns=["doc_id", "kind", "start_at", "end_at"])

    return documents.where("text is not null").mapInPandas(scan, "doc_id long, kind string, start_at long, end_at long")


def replace_mentions(documents: DataFrame, name_parts: DataFrame | None, most: int = MOST_NAME_PARTS) -> DataFrame:
    """doc_id, text: every document with its mentions replaced."""
    documents = spread(documents.select("doc_id", "text"))
    finder = _finder(documents, name_parts, most)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = finder.value
        for texts in batches:
            yield texts.map(f.replace, na_action="ignore")

    return documents.select("doc_id", clean("text").alias("text"))
