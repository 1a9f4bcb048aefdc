"""Labels, clock times, hesitation sounds and sound remarks in the text of one turn.

An Aho-Corasick automaton finds the marks that set off, the words that remarks are made of, offices before a colon, colons
and hesitation sounds in one pass; rules on what stands around a hit decide whether it is one (a remark is all that
stands between its marks, a hesitation sound must stand alone and not be quoted). Names before a colon can be in no
lexicon and clock times are numbers: both are told by their form, at the colons and marks that were hit. All positions
count code points; nothing depends on how far apart two hits are.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import ahocorasick

# --- fixed values: lexicons ---------------------------------------------------------------------------------------
#: What a set-off remark on a sound, a silence or the recording can be made of: heads, one of which must occur ...
REMARK_HEADS = (
    "applause applauds applauding audio banging bang beep beeping bell buzzer buzzing chatter chuckle chuckles chuckling clapping click "
    "clicking clears cough coughing coughs crosstalk crying cheering door echo fades feedback gap gasp gasps gavel groans hum humming "
    "inaudible indiscernible interference interruption knocking laugh laughing laughs laughter mic microphone mumbling mumbles murmur murmuring "
    "murmurs music muffled noise noises overlap overlapping pause pauses phone recess recording ringing rings rustling screaming shouting "
    "shouts sigh sighing sighs silence silent simultaneous singing siren sneeze sneezes sneezing sniffling sobbing sound sounds speech static tape "
    "throat thud unintelligible video voice voices whisper whispering whispers whistle whistling yawn yawns "
    "risas risa aplausos aplauso música silencio pausa tos inaudible ininteligible ruido murmullos suspiro "
    "rires rire applaudissements musique toux bruit murmures soupir inaudibles "
    "gelächter lachen lacht applaus beifall musik stille husten räuspern unverständlich geräusch seufzt seufzer "
    "risate applausi silenzio rumore risos aplausos pausas silêncio ruído gelach "
    "смех аплодисменты музыка пауза тишина кашель неразборчиво шум вздох γέλια χειροκροτήματα μουσική παύση σιωπή βήχας θόρυβος "
    "笑 笑い 笑声 大笑 拍手 音楽 沈黙 咳 雑音 鼓掌 咳嗽 沉默 音乐 听不清 噪音 웃음 박수 음악 침묵 기침 잡음 ضحك تصفيق موسيقى صمت سعال ضوضاء "
    "हँसी तालियाँ संगीत मौन खाँसी शोर เสียงหัวเราะ เสียงปรบมือ ดนตรี เงียบ เสียงไอ").split()
#: ... and words that can stand beside them.
REMARK_REST = (
    "0 a again an and another audience audible b background begins blank brief briefly by continue continues courtroom cross cuts cut damaged distant "
    "down end ends faint for from general goes heard his her in is it laughter light long loud lost low malfunction missing multiple no of off on one "
    "open out over papers paper people phrase poor portion quality resumes room second seconds short skips slam slams slight soft someone speaker speakers starts "
    "stops talk talking the their then to turned two unclear up with word words "
    "de del la el los las en sala público y dans le les du des salle et im in der die das den saal und publikum allgemeines allgemeine générale generales generale в зале").split()
#: Openers with their closers; a run of openers is closed by a run of closers.
SET_OFF = {"(": ")", "[": "]", "{": "}", "<": ">", "*": "*", "【": "】", "（": "）", "［": "］", "〔": "〕", "〈": "〉", "♪": "♪"}
#: Hesitation sounds, and phrases that mean nothing when a comma or a dash sets them off.
SOUNDS = ("uh uhh uhhh um umm ummm uhm uhmm erm ermm er err hm hmm hmmm mm mmm mhm ah ahh eh mm-hmm uh-huh uh-uh mm-mm mhm-mm "
          "euh heu hum äh ähm öh öhm ehm э-э э-э-э эм えーと ええと えっと うーん あのー 嗯 呃 음 어").split()
EMPTY_PHRASES = ("you know", "i mean")
#: Words before a phrase that give it meaning.
GOVERNING = frozenset("as do did does if what would that said whether how when because like than lets let".split())
#: Titles before a name in a label, and labels that name an office only.
TITLES = frozenset("mr mrs ms miss dr mister madam justice judge counsel attorney general solicitor the hon honorable prof sir chief associate senator gov mx".split())
OFFICES = frozenset((
    "chief justice", "the chief justice", "mr chief justice", "madam chief justice", "the court", "court", "question", "answer", "counsel", "speaker", "unknown speaker", "unidentified speaker",
    "unknown", "voice", "the clerk", "clerk", "the marshal", "marshal", "the witness", "interpreter", "the interpreter", "q", "a", "justice", "unidentified justice", "unknown justice", "unidentified"))
# ------------------------------------------------------------------------------------------------------------------

_HEADS, _REMARK_WORDS = frozenset(REMARK_HEADS), frozenset(REMARK_HEADS) | frozenset(REMARK_REST)
_BEFORE = " \n\t\r\u00a0\u2009\u202f\u3000\"'“”‘’„«»‹›()[]{}<>*【】（）「」『』—–-.,;:!?…、。！？，։؟¡¿/"
CLOCK = re.compile(
    r"[\[(<{【（]\s*(?:\d{1,2}:)?\d{1,3}:\d\d(?:[.,]\d{1,3})?\s*[\])>}】）]"
    r"|[\[(<{【（]\s*(?:\d{1,2}h\s?)?\d{1,3}m\s?\d{1,2}(?:\.\d{1,3})?s\s*[\])>}】）]"
    r"|(?<![\w:.,$])\d{1,2}:\d\d:\d\d(?:[.,]\d{1,3})?(?![\w:])")
_DIGITS = re.compile(r"\d+")
_LABEL_WORD = re.compile(r"[^\W\d_][\w.'’‑-]*,?$")
_PARTICLES = ("van", "de", "von", "del")
_PUNCT = ".…!?~-_ \t"

KINDS = ("annotation", "timestamp", "filler", "label")
#: What a hit is.
_OPENER, _CLOSER, _COLON, _OFFICE, _HEAD, _SOUND, _PHRASE = range(7)


def _automaton() -> ahocorasick.Automaton:
    found: dict[str, list[tuple[int, str]]] = {}

    def add(word: str, kind: int, name: str) -> None:
        found.setdefault(word, []).append((kind, name))

    for opener, closer in SET_OFF.items():
        add(opener, _OPENER, opener)
        add(closer, _CLOSER, closer)
    for colon in ":：":
        add(colon, _COLON, colon)
        for office in OFFICES:
            add(office + colon, _OFFICE, office + colon)
    for word in _HEADS:
        add(word, _HEAD, word)
    for kind, phrases in ((_SOUND, SOUNDS), (_PHRASE, EMPTY_PHRASES)):
        for phrase in phrases:
            for c in _BEFORE:
                add(c + phrase, kind, phrase)
    a = ahocorasick.Automaton()
    for word, what in found.items():
        a.add_word(word, tuple(what))
    a.make_automaton()
    return a


_AUTOMATON = _automaton()


def _only_remark_words(content: str) -> bool:
    s = content.replace("_", " ").strip(_PUNCT)
    if s[:2].lower() == "b:":
        s = s[2:]
    head = False
    for m in re.finditer(r"[^\s/-]+", s):
        w = _DIGITS.sub("0", m.group().lower()).strip(".,;…!?–—'\"")
        if w not in _REMARK_WORDS and w:
            return False
        head = head or w in _HEADS
    return head


_short_remark = lru_cache(maxsize=65536)(_only_remark_words)


def is_remark(content: str) -> bool:
    """Whether the content of a bracket, however long, is a remark on a sound, a silence or the recording."""
    return _short_remark(content) if len(content) < 64 else _only_remark_words(content)


def _bracket(text: str, at: int, closers: list[int], heads: list[int]) -> tuple[int, int] | None:
    """The set-off remark that opens at ``at``, with all its marks; ``heads`` are where words that can head one end."""
    opener = text[at]
    closer = SET_OFF[opener]
    n, size = at, len(text)
    while n < size and text[n] == opener and n - at < 3:
        n += 1
    i = bisect_left(closers, n)
    if i == len(closers):
        return None
    end = closers[i]
    j = bisect_right(heads, n)
    if j == len(heads) or heads[j] > end or not is_remark(text[n:end]):
        return None
    run = end
    while run < size and text[run] == closer and run - end < n - at:
        run += 1
    return (at, run) if run - end == n - at else (n - (run - end), run)


def _speech_before(text: str, p: int, starts: list[int], stops: list[int]) -> int:
    """The end of what is said before ``p``, past blanks and spans."""
    while True:
        while p > 0 and text[p - 1] in " \n\t":
            p -= 1
        i = bisect_left(stops, p)
        if i == len(stops) or stops[i] != p:
            return p
        p = starts[i]


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) in order, none overlapping; kind is an index into KINDS.

    An empty text has none. Repeated and nested marks belong to their remark. Where two finds overlap the one that starts first stays.
    """
    low = text.lower()
    if len(low) != len(text):  # a few letters grow in lower case
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    found: list[tuple[int, int, int]] = []
    if ":" in text or "s]" in low or "s)" in low or "s>" in low:
        found = [(m.start(), m.end(), 1) for m in CLOCK.finditer(text)]
    openers, colons, heads, sounds = [], [], [], []
    closers: dict[str, list[int]] = {}
    offices: dict[int, int] = {}
    for end, what in _AUTOMATON.iter(" " + low):
        for kind, name in what:
            if kind == _OPENER:
                openers.append(end - 1)
            elif kind == _CLOSER:
                closers.setdefault(name, []).append(end - 1)
            elif kind == _COLON:
                colons.append(end - 1)
            elif kind == _OFFICE:
                offices[end - 1] = max(offices.get(end - 1, 0), len(name))
            elif kind == _HEAD:
                heads.append(end)
            else:
                sounds.append((end - len(name), end, kind, name))
    done, size = 0, len(text)
    for at in openers if heads else ():
        if at >= done and (b := _bracket(text, at, closers.get(SET_OFF[text[at]], []), heads)):
            found.append((b[0], b[1], 0))
            done = b[1]
    if sounds:
        taken = sorted(found)
        starts, stops = [x[0] for x in taken], [x[1] for x in taken]
        for a, b, kind, phrase in sounds:
            nxt = text[b] if b < size else ""
            if nxt and (nxt.isalnum() or nxt in "_@" or (nxt in "'’-‑" and b + 1 < size and text[b + 1].isalnum())):
                continue
            i = bisect_right(starts, a) - 1
            if i >= 0 and a < stops[i]:
                continue
            prev = text[a - 1] if a else ""
            if prev and prev in "\"“”‘’'«„" and nxt and nxt in "\"“”‘’'»":
                continue  # quoted as a word
            if kind == _SOUND:
                if phrase == "er" or phrase == "eh" or phrase == "err":
                    after = text[b:b + 3].lstrip()
                    if text[a:b].isupper() or not (after == "" or after[0] in ",.…—–-!?[(<{*【"):
                        continue
                elif len(phrase) == 2 and text[a:b].isupper() and prev not in ("", " ", "\n"):
                    continue
                if prev in ("-", "–", "—", ".", "/") and a > 1 and text[a - 2].isalnum() and prev in "-/." and not (prev == "." and text[a].isupper()):
                    continue
            else:
                j = b
                while j < size and text[j] == " ":
                    j += 1
                if j < size and text[j] not in ",-–—.…!?" or (j < size and text[j] == "-" and text[j + 1:j + 2].isalnum()):
                    continue
                p = q = _speech_before(text, a, starts, stops)
                while q > 0 and text[q - 1].isalpha():
                    q -= 1
                if text[q:p].lower() in GOVERNING:
                    continue
            found.append((a, b, 2))
    if len(found) > 1:
        found.sort()
        kept, last = [], -1
        for f in found:
            if f[0] >= last:
                kept.append(f)
                last = f[1]
        found = kept
    lab = _label(text, found, colons, offices)
    if lab:
        found = sorted([f for f in found if f[1] <= lab[0] or f[0] >= lab[1]] + [(lab[0], lab[1], 3)])
    return found


def _label(text: str, found: list[tuple[int, int, int]], colons: list[int], offices: dict[int, int]) -> tuple[int, int] | None:
    """The label at the head, past clock times, remarks and hesitation sounds: what stands before the first colon there."""
    if not colons:
        return None
    p, i, size = 0, 0, len(text)
    while True:
        while p < size and (text[p].isspace() or text[p] in ",-–—>." or text[p] == "…"):
            p += 1
        if i < len(found) and found[i][0] <= p:
            if found[i][1] > p:
                p = found[i][1]
            i += 1
            continue
        break
    k = bisect_left(colons, p)
    if k == len(colons) or colons[k] == p:
        return None
    c = colons[k]
    if offices.get(c) == c + 1 - p or is_label(text[p:c]):
        return p, c + 1
    return None


def _names_speaker(head: str) -> bool:
    names = 0
    for m in re.finditer(r"\S+", head):
        w = m.group()
        s = w.strip(".,()").lower()
        if s in TITLES or s in ("j", "cj", "c.j", "jr", "sr", "esq", "ii", "iii"):
            continue
        particle = w.lower() in _PARTICLES
        if not _LABEL_WORD.match(w) or not (w[0].isupper() or particle) or w[-1:] == "." and len(w) > 3:
            return False
        names += not particle
        if names > 3:
            return False
    return names > 0


def _is_label(head: str) -> bool:
    return _names_speaker(head) or " ".join(w.strip(".,()").lower() for w in head.split()) in OFFICES


_short_label = lru_cache(maxsize=65536)(_is_label)


def is_label(head: str) -> bool:
    """Whether words before a colon name a speaker: an office, or a name with or without titles."""
    return _short_label(head) if len(head) < 64 else _names_speaker(head)
