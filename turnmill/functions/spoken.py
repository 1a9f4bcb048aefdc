"""Written forms as they are spoken.

Rules in order of precedence; of overlapping matches the earlier rule's stays. A form that can be spoken in several ways
keeps all of them as options, the first is put into the text. Spelling numbers out needs Python; it runs in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------------------------------------------
ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "zero ten twenty thirty forty fifty sixty seventy eighty ninety".split()
SCALES = ((10**12, "trillion"), (10**9, "billion"), (10**6, "million"), (1000, "thousand"), (100, "hundred"))
DECADES = {"twenty": "twenties", "thirty": "thirties", "forty": "forties", "fifty": "fifties", "sixty": "sixties", "seventy": "seventies", "eighty": "eighties", "ninety": "nineties", "ten": "tens", "hundred": "hundreds"}
LETTERS = dict(zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "Ay Bee See Dee Ee Ef Gee Aitch Eye Jay Kay El Em En Oh Pee Cue Ar Ess Tee You Vee Double-You Ex Why Zee".split()))
ROMAN = {"II": 2, "III": 3, "IV": 4, "V": 5, "VI": 6, "VII": 7, "VIII": 8, "IX": 9, "X": 10, "XI": 11, "XII": 12, "XIII": 13, "XIV": 14, "XV": 15}
ORDINALS = "zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth".split()
HEADERS = r"(?:RESUMED ORAL ARGUMENT OF|ORAL ARGUMENT OF|REBUTTAL OF)(?: [A-Z][A-Z.,'’-]*)*"
REMARKS = r"[(\[](?:inaudible|voice\s*overlap|laughter|coughing|cough|audio\s*cut|recess|noise|indiscernible|mirth|sneezes|sighs|applause|break|luncheon|lunch|interruption|banging)\.?[)\]]"
NOT_SPELLED = frozenset("IT DO US SO OR NO IF AS AT BE BY HE ME WE AN II III IV VI VII VIII IX XI XII I A THE AND".split())
# --------------------------------------------------------------------------------------------------------------------


def number_words(n: int) -> str:
    """A whole number in words."""
    if n < 0:
        return "minus " + number_words(-n)
    if n < 20:
        return ONES[n]
    if n < 100:
        return TENS[n // 10] + (f" {ONES[n % 10]}" if n % 10 else "")
    for size, name in SCALES:
        if n >= size:
            rest = n % size
            return f"{number_words(n // size)} {name}" + (f" {number_words(rest)}" if rest else "")
    return str(n)


def digit_words(s: str, zero: str = "oh") -> str:
    """Digits one by one."""
    return " ".join(zero if c == "0" else ONES[int(c)] for c in s)


def year_words(y: int) -> str:
    """A year as a pair of numbers."""
    a, b = divmod(y, 100)
    if y % 1000 == 0 or 2000 < y < 2010:
        return number_words(y)
    if b == 0:
        return f"{number_words(a)} hundred"
    return f"{number_words(a)} {'oh ' if b < 10 else ''}{number_words(b)}"


def pair_words(s: str) -> str:
    """Digits in pairs, as dockets and section numbers are read."""
    if len(s) <= 2:
        return digit_words(s) if s.startswith("0") else number_words(int(s))
    head = len(s) % 2
    parts = ([s[:1]] if head else []) + [s[i:i + 2] for i in range(head, len(s), 2)]
    return " ".join(digit_words(p) if len(p) == 2 and p[0] == "0" else number_words(int(p)) for p in parts)


def _money(m: re.Match) -> list[str]:
    whole, cents, scale = m.group(1).replace(",", ""), m.group(2), m.group(3)
    if scale:
        return [number_words(int(whole)) + (f" point {digit_words(cents, 'zero')}" if cents else "") + f" {scale.lower()} dollars"]
    s = number_words(int(whole)) + (" dollar" if int(whole) == 1 else " dollars")
    return [s + (f" and {number_words(int(cents))} cents" if cents and len(cents) == 2 and int(cents) else "")]


def _decade(m: re.Match) -> list[str]:
    w = year_words(int(m.group(1))).split()
    return [" ".join(w[:-1] + [DECADES.get(w[-1], w[-1] + "s")])]


def _near(text: str, a: int, b: int, words: str) -> bool:
    return bool(re.search(rf"(?i)\b(?:{words})\b", text[max(0, a - 40):b + 40]))


Rule = tuple[str, re.Pattern, Callable[[re.Match], "list[str] | None"]]

RULES: list[Rule] = [
    ("header", re.compile(HEADERS), lambda m: [""]),
    ("remark", re.compile(REMARKS, re.I), lambda m: [""]),
    ("editorial", re.compile(r"\[=\s*([^\]]*)\]"), lambda m: [spoken_text(m.group(1).strip())]),
    ("number_of", re.compile(r"\bNo\.\s+(\d{1,4})-(\d+)\b"), lambda m: [f"number {pair_words(m.group(1))} {pair_words(m.group(2))}"]),
    ("vote", re.compile(r"(?<![\d-])(\d)-(\d)(?![\d-])"), lambda m: [f"{ONES[int(m.group(1))]} to {ONES[int(m.group(2))]}"] if _near(m.string, *m.span(), "vote[sd]?|held|decision|decided|split") else None),
    ("range", re.compile(r"(?<![\d-])(\d{1,4})[-–—](\d{1,4})(?![\d-])"),
     lambda m: [f"{number_words(int(m.group(1)))} to {number_words(int(m.group(2)))}"] if _near(m.string, *m.span(), "between|pages?|pp|employees|years|from|days|percent") or len(m.group(1)) == 1 else None),
    ("docket", re.compile(r"(?<![\d-])(\d{1,2})-(\d{2,5})(?![\d-])"), lambda m: [f"{pair_words(m.group(1))} {pair_words(m.group(2))}"]),
    ("code", re.compile(r"(?<![\d-])\d{1,4}(?:-\d{1,4}){2,}(?![\d-])"), lambda m: [" dash ".join(digit_words(p) if len(p) < 3 else pair_words(p) for p in m.group().split("-"))]),
    ("versus", re.compile(r"(?<=[\w.])\s(vs?\.)\s(?=[A-Z])"), lambda m: [" Vee ", " Versus "]),
    ("title", re.compile(r"\b(Mr|Mrs|Ms)\."), lambda m: {"Mr": ["Mister"], "Mrs": ["Missus"], "Ms": ["Ms.", "Miz"]}[m.group(1)]),
    ("decade", re.compile(r"\b((?:1[0-9]|20)\d0)s\b"), _decade),
    ("currency", re.compile(r"\$(\d[\d,]*)(?:\.(\d+))?(?:\s(hundred|thousand|million|billion|trillion)\b)?", re.I), _money),
    ("percent", re.compile(r"(?<![\d.])(\d+)(?:\.(\d+))?(?:%|\s+percent\b)"), lambda m: [number_words(int(m.group(1))) + (f" point {digit_words(m.group(2), 'zero')}" if m.group(2) else "") + " percent"]),
    ("section", re.compile(r"(?:\b(Section|Sec\.)|§)\s*(\d+)((?:\([a-zA-Z0-9]+\))*)"),
     lambda m: ["Section " + " ".join(w.capitalize() for w in pair_words(m.group(2)).split()) + "".join(f" {x}" for x in re.findall(r"\((\w+)\)", m.group(3)))]),
    ("statute", re.compile(r"\b(\d+)\s*U\.?\s?S\.?\s?C\.?(?=\s|$|[,;)])"), lambda m: [f"{number_words(int(m.group(1)))} U S C"]),
    ("statute", re.compile(r"\bTitle\s+(\d+)\b"), lambda m: [f"Title {number_words(int(m.group(1)))}"]),
    ("year", re.compile(r"(?<![\d.,$-])((?:1\d|20)\d{2})(?![\d-]|[.,]\d)"), lambda m: [year_words(int(m.group(1)))]),
    ("roman", re.compile(r"\b(Amendment|Circuit|Article|Title|Part|Chapter|Art\.)\s+([IVX]+)\b"), lambda m: [f"{m.group(1)} {number_words(ROMAN[m.group(2)])}"] if m.group(2) in ROMAN else None),
    ("roman", re.compile(r"\b([IVX]{2,4})\s+(?=Amendment|Circuit)"), lambda m: [ORDINALS[ROMAN[m.group(1)]].capitalize() + " "] if m.group(1) in ROMAN else None),
    ("letters", re.compile(r"\b(?:[A-Z]\.){3,}"), lambda m: [" ".join(LETTERS[c] for c in m.group() if c != ".")]),
    ("letters", re.compile(r"\b[A-Z]{2,5}\b"), lambda m: None if m.group() in NOT_SPELLED or m.group() in ROMAN else [" ".join(LETTERS[c] for c in m.group())]),
    ("et_al", re.compile(r"\bet\s+al\b\.?", re.I), lambda m: ["et al.", "and others"]),
    ("decimal", re.compile(r"(?<![\d.])\.(\d+)\b"), lambda m: ["point " + digit_words(m.group(1), "zero")]),
    ("ordinal", re.compile(r"\b(\d{1,2})(?:st|nd|rd|th)\b"), lambda m: [ORDINALS[int(m.group(1))]] if int(m.group(1)) < len(ORDINALS) else None),
    ("age", re.compile(r"\b(\d{1,2})(?=[ -](?:years?[ -]old|year-olds?)\b)"), lambda m: [number_words(int(m.group(1)))]),
]
_PLAIN = str.maketrans({"“": '"', "”": '"', "‘": "'", "’": "'", "–": "-", "—": "-", "…": ""})


def spoken_forms(text: str) -> list[tuple[int, int, str, list[str]]]:
    """(start, end, rule, options) in order, none overlapping."""
    found: list[tuple[int, int, str, list[str]]] = []
    for name, rx, say in RULES:
        for m in rx.finditer(text):
            if any(a < m.end() and m.start() < b for a, b, _, _ in found):
                continue
            options = say(m)
            if options is not None:
                found.append((m.start(), m.end(), name, options))
    return sorted(found)


def spoken_text(text: str) -> str:
    """The text with the first option of every form, plain quotes and dashes, single blanks."""
    out, p = [], 0
    for a, b, _, options in spoken_forms(text):
        out += [text[p:a], options[0]]
        p = b
    return " ".join("".join([*out, text[p:]]).translate(_PLAIN).split())


def normalize(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, ``spoken`` and ``forms`` (start, stop, rule, options) of every text; null stays null, an empty text has no forms."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    n = len(keys)
    form = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("rule", pa.string()), ("options", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(n).to_pylist()
            cols = {k: b.column(i) for i, k in enumerate(keys)}
            cols["spoken"] = pa.array([spoken_text(t) if t is not None else None for t in texts], pa.string())
            cols["forms"] = pa.array([[{"start": a, "stop": e, "rule": r, "options": o} for a, e, r, o in spoken_forms(t)] if t is not None else None for t in texts], form)
            yield pa.RecordBatch.from_pydict(cols)

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", spoken string, forms array<struct<start:int,stop:int,rule:string,options:array<string>>>"
    return df.select(*keys, F.col(text).cast("string")).mapInArrow(run, schema)
