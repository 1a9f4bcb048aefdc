"""Sentence boundaries across languages and scripts.

A hidden-event n-gram model: between the words of a text lies a hidden event, boundary or none. Its terms are
P(event | word before, mark), P(word after | event) and P(event | event before, words between), the first two backed off to
the shapes of the words. It is trained on the corpus itself: gaps whose answer is plain start it, expectation maximisation
over all gaps' counts settles the rest (abbreviations, ordinals, quotations, scripts without capitals). Forward and
backward passes over the gaps of a text give each one's posterior; a boundary is where that is above one half.

In a text that writes sentence marks, gaps without one are pruned: no boundary can lie there. In scripts without
sentence marks, and in Han and kana written without any, the gaps are the spaces. In other texts without a single mark
the boundary is looked for between all words (``turnmill.llm.unmarked``). Counts are kept in tables of a given number of
bins (BINS, a parameter of ``train``), so the model that is sent to the executors has one size whatever the corpus.
The counts of the model of texts without marks are exact and stay tables (``with_chances``).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.scan import scan
from turnmill.llm.unmarked import COUNTED, GRAM, Tables, Unmarked, asked_grams, count_grams
from turnmill.operators.current import beside

#: Bins of each count table; with three float32 tables a model is at most 3 * BINS * 4 bytes.
BINS = 1 << 17
#: Rounds of expectation maximisation.
ROUNDS = 3

_CLOSE = "\"'”’“‘»›«‹)]}）】」』〉》"
_GREEK = "Ͱ-Ͽἀ-῿"
#: Scripts that write no sentence marks and no spaces between words: Thai, Lao, Myanmar, Khmer, Tibetan.
_BARE = "฀-๿຀-໿က-႟ក-៿ༀ-࿿"
_CJK = "぀-ヿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ"
#: Sentence marks; where a text is plain ASCII the short set will do.
_MARKS_ASCII = re.compile(r"[.!?]+")
_MARKS = re.compile(rf"[.!?…։。！？｡।॥؟۔።;;]+|(?<=[{_BARE}])[ \u200b\u00a0]+(?=\S)")
#: Any sentence mark, inside of words and numbers too.
_ANY_MARK = re.compile("[.!?…։。！？｡।॥؟۔;]")
_CJK_SPACES = re.compile(rf"(?<=[{_CJK}])[ \u3000]+(?=[{_CJK}])")
#: Marks whose writer would write sentence marks too.
_OTHER_MARKS = re.compile("[,;:،、，“”„«»「」]")
_ANY_WORD = re.compile(rf"[{_CJK}]|[^\s{_CJK}]+")
_GREEK_BEFORE = re.compile(f"[{_GREEK}]")
_NOT_AFTER = frozenset(",:;،、，_@/")
_DIGIT = re.compile(r"\d")
_WORD = re.compile(rf"[{_CJK}]{{1,2}}|[{_BARE}]{{1,6}}|[^\s{_CJK}]+")
_OPENERS = "\"'“‘„«‹([{<*【（「『¿¡"
_AFTER = "\"'”’»›)]}>*】）」』;:-–—"
_TRIM = "\"'“”‘’„«»‹›()[]{}<>*【】（）「」『』¿¡,;:-–—"


def _hash(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass"))


def shape(word: str) -> str:
    """Class of a word: what kind of letters it begins with, how long it is, points inside."""
    if not word:
        return "_"
    c = word[0]
    if c.isdigit():
        k = "9"
    elif c.isupper():
        k = "A"
    elif c.islower():
        k = "a"
    elif c.isalpha():
        k = "o"
    else:
        k = "-"
    n = len(word)
    return k + ("1" if n == 1 else "s" if n < 4 else "m" if n == 4 else "l") + ("." if "." in word else "")


def _plain(word: str) -> str:
    """A word as the model knows it: digits are all alike."""
    if any(map(str.isdigit, word)):
        word = _DIGIT.sub("0", word)
    return word.replace("\t", " ")


def _quiet(text: str, p: int, stop: int, spans: list[tuple[int, int, int]], k: int) -> bool:
    """Whether nothing but hesitation sounds, remarks, times and labels stands there; ``k`` spans end before ``stop``."""
    while True:
        last = spans[k - 1] if k and spans[k - 1][1] > p else None
        if any(map(str.isalnum, text[last[1] if last else p:stop])):
            return False
        if last is None:
            return True
        stop, k = last[0], k - 1
        if stop <= p:
            return True


#: A gap: end of its mark, "before<tab>mark<tab>after", and a code: 2 * min(words since the gap before, 2) + 1 if only sounds lie between.
Gap = tuple[int, str, int]


def lay_out(text: str, spans: list[tuple[int, int, int]] | None = None) -> tuple[int, list[Gap]] | None:
    """Where speech ends, and the gaps of a text past its label, clock times and remarks; None where nothing is said."""
    spans = scan(text) if spans is None else spans
    size = end = len(text)
    i = len(spans) - 1
    while end > 0:
        if text[end - 1].isspace():
            end -= 1
            continue
        while i >= 0 and spans[i][2] == 2 and spans[i][1] > end:
            i -= 1
        if i >= 0 and spans[i][1] == end and spans[i][2] != 2:
            end = spans[i][0]
            i -= 1
        else:
            break
    if end == 0:
        return None
    ascii_only = text.isascii()
    marks = _MARKS_ASCII if ascii_only else _MARKS
    gaps = _gaps(text, end, spans, marks)
    if not gaps and _writes_no_marks(text, end, spans, marks):
        gaps = _gaps(text, end, spans, _CJK_SPACES) if not ascii_only else []
        gaps = gaps or _word_gaps(text, end, spans)
    return end, gaps


def _writes_no_marks(text: str, end: int, spans: list[tuple[int, int, int]], marks: re.Pattern) -> bool:
    """Whether no mark of any kind stands in what is said but inside of words and numbers, and speech doesn't break off with a dash."""
    if text[end - 1] in "-–—":
        return False
    n = len(spans)
    for rx in (marks, _OTHER_MARKS):
        k = 0
        for m in rx.finditer(text, 0, end):
            while k < n and spans[k][1] <= m.start():
                k += 1
            if (k == n or spans[k][0] > m.start()) and not (text[m.end():m.end() + 1].isalnum() and text[max(0, m.start() - 1):m.start()].isalnum()):
                return False
    return True


def _word_gaps(text: str, end: int, spans: list[tuple[int, int, int]]) -> list[Gap]:
    """All gaps between the words of what is said, with an empty mark."""
    words, k, n = [], 0, len(spans)
    for m in _ANY_WORD.finditer(text, 0, end):
        while k < n and spans[k][1] <= m.start():
            k += 1
        if (k == n or spans[k][0] >= m.end()) and any(map(str.isalnum, m.group())):
            words.append((m.end(), _plain(m.group())))
    return [(a[0], f"{a[1]}\t\t{b[1]}", 4) for a, b in zip(words, words[1:])]


def _gap_words(keys: list[str]) -> list[str]:
    """The words of a text with a gap between all of them."""
    return [k.split("\t")[0] for k in keys] + [keys[-1].split("\t")[2]]


def _gaps(text: str, end: int, spans: list[tuple[int, int, int]], marks: re.Pattern) -> list[Gap]:
    """The gaps at marks in what is said."""
    gaps: list[Gap] = []
    k, n, last_end, size = 0, len(spans), 0, len(text)
    ascii_only = text.isascii()
    for m in marks.finditer(text, 0, end):
        a, b = m.start(), m.end()
        while k < n and spans[k][1] <= a:
            k += 1
        if k < n and spans[k][0] <= a:
            continue
        mark = m.group()
        bare = mark[0] in " \u200b\u00a0\u3000"
        if not bare:
            if b >= end:
                break
            c = text[b]
            if mark == ".":
                if c.isdigit() or c.islower() or c in _NOT_AFTER:
                    continue
                if c.isupper() and (a < 2 or not text[a - 2].isalnum()):
                    continue  # between initials
            if mark in ";;" and not _GREEK_BEFORE.match(text[a - 1] if a else " "):
                continue
            while b < end:
                c = text[b]
                if c in _CLOSE:
                    b += 1
                elif c in "  \u202f" and b + 1 < end and text[b + 1] in "»›":
                    b += 2
                else:
                    break
            if b >= end:
                break
            c = text[b]
            if c in _NOT_AFTER or c in ".!?-" or (c.isdigit() and mark[0] not in "。！？｡।"):
                continue
        # the word after, past what is no speech
        j, r = b, k
        while True:
            while j < size and text[j].isspace():
                j += 1
            while r < n and spans[r][1] <= j:
                r += 1
            if r < n and spans[r][0] <= j:
                sound = spans[r][2] == 2
                j = spans[r][1]
                if sound:
                    while j < size and text[j] in ",.-–—… ":
                        j += 1
                continue
            break
        if j >= end:
            break  # only sounds, remarks or times follow: the sentence goes on to the end
        while j < end and text[j] in _OPENERS:
            j += 1
        w = _WORD.match(text, j) if j < end else None
        if w is None or not any(map(str.isalnum, w.group())):
            if not any(map(str.isalnum, text[j:end])):
                break
        after = w.group() if w else text[j:j + 1]
        if r < n and spans[r][0] < j + len(after):
            after = after[: max(1, spans[r][0] - j)]
        after = after.rstrip(_AFTER) or after or "-"
        if len(after) == 1 and text[j - 1:j] == "(":
            after = "(" + after  # a numbered clause
        if bare:
            before, mark = text[max(0, a - 4):a], " "
        else:
            z = a - 1 if text[a - 1:a] == " " else a
            s = max(text.rfind(" ", last_end, z) + 1, text.rfind("\n", last_end, z) + 1, last_end)
            if k and spans[k - 1][1] > s:
                s = min(spans[k - 1][1], z)
            before = text[s:z].lstrip(_TRIM)
            if not ascii_only and before and "\u3040" <= before[-1] <= "\u9fff":
                before = before[-1]
            mark = text[z:b]
            if len(mark) > 1:
                if mark[0] in "!?" and mark[1] in "!?":
                    mark = mark[0] + mark.lstrip("!?")
            if not text[b].isspace():
                mark += "_"
        code = 2 * min(text.count(" ", last_end, a), 2) if last_end else 4
        if _quiet(text, last_end, a, spans, k):
            code += 1
        if bare:
            b = a
        gaps.append((b, f"{_plain(before)}\t{mark}\t{_plain(after)}", code))
        last_end = b
    return gaps


# --- fixed values ---------------------------------------------------------------------------------------------------
#: Shortened words that stand before a name.
BEFORE_NAMES = frozenset("mr mrs ms mx dr prof gov sen rep hon rev messrs mmes st mt ft v vs dra sra mme mlle".split())
#: Common words that, with a capital, begin sentences.
COMMON_OPENERS = frozenset((
    "the it he she they we you this that these those there here his her their our your its a an in on at but and so if when while what who why how where which as for of to with from not do does did is are was "
    "were has have had will would can could should may must then thus now one some all any each every no nobody el la los las der die das ein eine wer man le les une qui il elle").split())
# --------------------------------------------------------------------------------------------------------------------


def start_odds(before: str, mark: str, after: str) -> float:
    """What is plain at the outset: the probability of a boundary from shapes alone."""
    c = after[0]
    cased = c.isupper() or c.islower() or c == "("
    core = mark.rstrip("_")
    if not core or mark == " ":
        return 0.97
    m, closed = core.lstrip()[0], len(core) > 1 and core[-1] in _CLOSE
    if m in "։。！？｡।॥؟۔።":
        return 0.5 if closed else 0.98
    strong = m in "!?;" or m == "…"
    if c.islower():
        return 0.03 if closed else (0.25 if strong and m != "…" else 0.05)
    if c.isdigit():
        return 0.08 if (not before or before[0].isdigit() or shape(before)[1] != "l") and not strong else 0.4
    if mark.endswith("_") and not cased:
        return 0.2
    if strong:
        return 0.9 if closed or not cased else 0.97
    if core.lstrip().startswith("..") or m == " ":
        return 0.93
    if before.lower() in BEFORE_NAMES and not closed:
        return 0.05
    if c.isupper() and after.rstrip(",").lower() in COMMON_OPENERS and len(before) > 1:
        return 0.92
    k = shape(before)
    if k[0] == "9":
        return 0.6
    if k[0] in "ao" and k[1] in "l" and "." not in before:
        return 0.5 if closed and not cased else (0.97 if cased else 0.8)
    if k[0] == "a" and k[1] in "sm" and len(before) > 2 and "." not in before:
        return 0.75 if cased else 0.6
    return 0.5


#: Weight, at the outset, of an unclear gap as evidence for the word after none.
UNCLEAR = 0.1


class Model:
    """Count tables of boundary and no boundary, and their logarithmic odds."""

    def __init__(self, left: np.ndarray, right: np.ndarray, step: np.ndarray, unmarked: Unmarked | Tables | None = None):
        self.left, self.right, self.step, self.unmarked = left, right, step, unmarked
        self.bins = left.shape[1]
        self._n = right[:, _hash("\x05") % self.bins] + 1e-9
        self._cache: dict[str, float] = {}

    def sendable(self) -> tuple:
        """What the executors make the model of; texts without marks bring what they asked its tables for (``with_chances``)."""
        return self.left.astype(np.float32), self.right.astype(np.float32), self.step, self.unmarked.shell() if isinstance(self.unmarked, Tables) else self.unmarked

    def odds(self, key: str) -> float:
        """log P(boundary | words) - log P(none | words), without the event before."""
        x = self._cache.get(key)
        if x is not None:
            return x
        before, mark, after = key.split("\t")
        L, R, n, bins = self.left, self.right, self._n, self.bins
        bm, bs, bl = _hash("\x02" + mark) % bins, _hash("\x01" + shape(before) + "\t" + mark) % bins, _hash(before + "\t" + mark) % bins
        pm = (L[1, bm] + start_odds(before, mark, after)) / (L[0, bm] + L[1, bm] + 1.0)
        ps = (L[1, bs] + 2 * pm) / (L[0, bs] + L[1, bs] + 2.0)
        pl = min(max((L[1, bl] + 2 * ps) / (L[0, bl] + L[1, bl] + 2.0), 1e-4), 1 - 1e-4)
        s, r = _hash("\x01" + shape(after)) % bins, _hash(after) % bins
        # a word seen rarely leans on its shape
        g = [(R[e, s] + 0.5) / (n[e] + 1.0) * 2.0 / max((R[0, s] + R[1, s]) / (R[0, r] + R[1, r] + 1.0), 1.0) for e in (0, 1)]
        p0, p1 = ((R[e, r] + g[e]) / (n[e] + 1.0) for e in (0, 1))
        x = math.log(pl / (1 - pl)) + min(max(math.log(max(p1, 1e-12) / max(p0, 1e-12)), -9.0), 9.0)
        if len(self._cache) > 200_000:
            self._cache.clear()
        self._cache[key] = x
        return x

    def posteriors(self, keys: list[str], codes: list[int], chances: list[dict] | None = None) -> list[float]:
        """Forward and backward passes over the gaps of one text; ``chances`` as of ``with_chances``."""
        n = len(keys)
        if keys[0].split("\t")[1] == "":
            if not self.unmarked:
                return [0.0] * n
            known = self.unmarked if chances is None else self.unmarked.knowing({tuple(c[g] for g in GRAM): c["p"] for c in chances})
            return known.posteriors(_gap_words(keys))
        odds = self.odds
        e = [math.exp(min(max(odds(k), -30.0), 30.0)) for k in keys]
        if n == 1:
            return [e[0] / (1 + e[0])]
        T = self.step
        ts = [T[c >> 1] for c in codes]
        f = [e[0]]  # mass of boundary to that of none
        x = e[0]
        for i in range(1, n):
            t = ts[i]
            x = (t[0][1] + x * t[1][1]) * e[i] / (t[0][0] + x * t[1][0])
            f.append(x)
        b, out = 1.0, [0.0] * n
        for i in range(n - 1, -1, -1):
            p = f[i] * b
            out[i] = p / (1 + p)
            t = ts[i]
            y = e[i] * b
            b = (t[1][0] + t[1][1] * y) / (t[0][0] + t[0][1] * y)
        return out

    def ends(self, end: int, at: list[int], keys: list[str], codes: list[int], chances: list[dict] | None = None) -> list[int]:
        """Sentence ends of a text that was laid out."""
        out = []
        if keys:
            quiet = True
            for x, p, c in zip(at, self.posteriors(keys, codes, chances), codes):
                quiet = quiet and c & 1 == 1
                if p > 0.5 and not quiet:  # hesitation sounds alone make no sentence before another
                    out.append(x)
                    quiet = True
        out.append(end)
        return out


def sentence_ends(text: str | None, model: Model) -> list[int]:
    """Ends of the sentences of one text, in order.

    A null, empty or blank text, and one of labels, clock times and remarks only, has none. A text of hesitation
    sounds only is one sentence. The last sentence ends where speech ends.
    """
    laid = lay_out(text) if text else None
    if laid is None:
        return []
    end, gaps = laid
    return model.ends(end, [g[0] for g in gaps], [g[1] for g in gaps], [g[2] for g in gaps])


def expected(rows: Iterable[tuple[str, int]], model: Model | None, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """Expected counts of (key, n) rows. At the outset an unclear gap weighs little and as none for the word after it, so that
    words which begin a sentence only where that is unclear (names after titles, say) don't pass for such as begin one."""
    left, right = np.zeros((2, bins), np.float64), np.zeros((2, bins), np.float64)
    for key, n in rows:
        before, mark, after = key.split("\t")
        k, w = shape(before), n
        if model is None:
            p = q = start_odds(before, mark, after)
            if 0.1 < p < 0.8:
                q, w = 0.0, n * UNCLEAR
        else:
            p = q = 1 / (1 + math.exp(-min(max(model.odds(key), -30), 30)))
        for b in (_hash(before + "\t" + mark) % bins, _hash("\x01" + k + "\t" + mark) % bins, _hash("\x02" + mark) % bins):
            left[1, b] += p * n
            left[0, b] += (1 - p) * n
        for b in (_hash(after) % bins, _hash("\x01" + shape(after)) % bins, _hash("\x05") % bins):
            right[1, b] += q * w
            right[0, b] += (1 - q) * w
    return left, right


def step_factors(steps: np.ndarray) -> np.ndarray:
    """How the event before changes the odds, by words between; from counts [between, event before, event]."""
    t = steps / steps.sum(axis=2, keepdims=True)
    share = steps.sum(axis=1) / steps.sum(axis=(1, 2))[:, None]
    return t / share[:, None, :]


LAID = "laid_end int, laid_at array<int>, laid_keys array<string>, laid_codes array<int>"


def _types(df: DataFrame, keys: list[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{k}` {kinds[k]}" for k in keys)


def lay_out_all(df: DataFrame, keys: list[str], column: str, silent: bool = False, said: bool = False) -> DataFrame:
    """``keys`` with the gaps of each text. Texts in which nothing is said are left out, or with ``silent`` kept with a
    null end and no gaps. With ``said`` also what is said between the gaps (``said_parts``). Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(len(keys)).to_pylist()
            spans = [scan(t) if t else None for t in texts]
            laid = [lay_out(t, s) if t else None for t, s in zip(texts, spans)]
            at = [i for i, x in enumerate(laid) if silent or x is not None]
            spoken = [laid[i] or (None, []) for i in at]
            take = pa.array(at, pa.int32())
            size = np.fromiter((len(g) for _, g in spoken), np.int32, len(spoken))
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            flat = [g for _, gs in spoken for g in gs]
            cols = {k: b.column(i).take(take) for i, k in enumerate(keys)}
            cols["laid_end"] = pa.array([e for e, _ in spoken], pa.int32())
            cols["laid_at"] = pa.ListArray.from_arrays(offsets, pa.array([g[0] for g in flat], pa.int32()))
            cols["laid_keys"] = pa.ListArray.from_arrays(offsets, pa.array([g[1] for g in flat], pa.string()))
            cols["laid_codes"] = pa.ListArray.from_arrays(offsets, pa.array([g[2] for g in flat], pa.int32()))
            if said:
                cols["laid_said"] = pa.array([said_parts(texts[i], spans[i], *laid[i]) if laid[i] else None for i in at], pa.list_(pa.string()))
            yield pa.RecordBatch.from_pydict(cols)

    return df.select(*keys, F.col(column).cast("string")).mapInArrow(run, f"{_types(df, keys)}, {LAID}{', laid_said array<string>' if said else ''}")


def _sum_tables(sums: pd.DataFrame, bins: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = np.zeros((2, bins)), np.zeros((2, bins))
    for which, t in ((0, left), (1, right)):
        part = sums[sums["which"] == which]
        t[0, part["bin"]], t[1, part["bin"]] = part["none"], part["some"]
    return left, right


def train(laid: DataFrame, texts: DataFrame | None = None, column: str = "text", rounds: int = ROUNDS, bins: int = BINS) -> Model:
    """Fit the model to all texts that were laid out (see ``lay_out_all``).

    Only bin sums, a fixed number, come to the driver. No rows at all give a model of shapes. Words that share a bin share
    their counts: at 2^17 bins and 60,000 different words one in three does; ``bins`` is to grow with the vocabulary.
    Where texts without any mark occur, their model is fitted on all ``texts`` that have marks, in ``column`` or laid out
    with what they say; without ``texts`` no boundary is found inside such texts.
    """
    from turnmill.session import durable

    spark = laid.sparkSession
    counts = durable(laid.select(F.explode("laid_keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    marked = counts.where(~F.col("key").contains("\t\t"))
    model: Model | None = None
    for _ in range(rounds + 1):
        sent = spark.sparkContext.broadcast(None if model is None else (model.left.astype(np.float32), model.right.astype(np.float32)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = None if sent.value is None else Model(*sent.value, None)

            def rows() -> Iterator[tuple[str, int]]:
                for b in batches:
                    yield from zip(*(c.to_pylist() for c in b.columns))

            left, right = expected(rows(), m, bins)
            for which, t in ((0, left), (1, right)):
                at = np.nonzero(t.sum(axis=0))[0]
                yield pa.RecordBatch.from_pydict({"which": pa.array(np.full(len(at), which, np.int32)), "bin": pa.array(at.astype(np.int32)),
                                                  "none": pa.array(t[0, at]), "some": pa.array(t[1, at])})

        sums = (marked.select("key", "n").mapInArrow(run, "which int, bin int, none double, some double")
                .groupBy("which", "bin").agg(F.sum("none").alias("none"), F.sum("some").alias("some")).toPandas())  # at most 2 * bins rows
        model = Model(*_sum_tables(sums, bins), None)
        sent.unpersist()
    model.step = step_factors(_step_counts(laid, model)).tolist()
    if texts is not None and counts.where(F.col("key").contains("\t\t")).limit(1).count():
        if "laid_said" not in texts.columns:
            texts = lay_out_all(texts.select(F.lit(0).alias("k"), F.col(column).alias("t")), ["k"], "t", said=True)
        model.unmarked = fit_unmarked(texts, model)
    return model


def _bare_word(word: str) -> str:
    """A word without marks at its edges, digits alike."""
    return _plain(word).strip(".!?…։。！？｡।॥؟۔،؛-–—'" + _TRIM)


def said_parts(text: str, spans: list[tuple[int, int, int]], end: int, gaps: list[Gap]) -> list[str] | None:
    """What is said before each gap and after the last in a text that writes marks, past labels, remarks, times and sounds; None of other texts."""
    if not gaps or gaps[0][1].split("\t")[1] == "" or not _ANY_MARK.search(text):
        return None
    out, p, k, n = [], 0, 0, len(spans)
    for e in (*(g[0] for g in gaps), end):
        while k < n and spans[k][1] <= p:
            k += 1
        if k == n or spans[k][0] >= e:
            out.append(text[p:e])
        else:
            words = []
            for m in _ANY_WORD.finditer(text, p, e):
                while k < n and spans[k][1] <= m.start():
                    k += 1
                if k == n or spans[k][0] >= m.end():
                    words.append(m.group())
            out.append((" " if text[p].isspace() else "") + " ".join(words))
        p = e
    return out


def _said_sentences(said: list[str], ends: list[int], at: list[int]) -> list[list[str]]:
    """The words of each sentence, with their marks; ``said`` as of ``said_parts``, ``ends`` as of ``Model.ends``."""
    stops, out, parts = set(ends), [], []
    for part, e in zip(said, (*at, ends[-1])):
        parts.append(part)
        if e in stops:
            one = "".join(parts)
            out.append(one.split() if one.isascii() else _ANY_WORD.findall(one))
            parts = []
    return out


def sentence_words(text: str, model: Model) -> list[list[str]]:
    """The words of each sentence of a text that writes marks, without them; none of other texts."""
    spans = scan(text)
    end, gaps = lay_out(text, spans) or (0, [])
    said = said_parts(text, spans, end, gaps)
    if said is None:
        return []
    at = [g[0] for g in gaps]
    return [[w for w in map(_bare_word, s) if w] for s in _said_sentences(said, model.ends(end, at, [g[1] for g in gaps], [g[2] for g in gaps]), at)]


def fit_unmarked(laid: DataFrame, model: Model) -> Tables:
    """The model of texts without marks, from all texts with marks that were laid out with what they say, whatever their number and length."""
    sent = laid.sparkSession.sparkContext.broadcast(model.sendable())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        return count_grams((_said_sentences(said, m.ends(end, at, ks, codes), at) for said, end, at, ks, codes in rows), _bare_word)

    return Tables(laid.where("laid_said is not null").select("laid_said", "laid_end", "laid_at", "laid_keys", "laid_codes").mapInArrow(run, COUNTED))


def with_chances(laid: DataFrame, keys: list[str], model: Model) -> list[DataFrame]:
    """``laid`` in parts: the texts with marks as they are, those without any with ``laid_chances`` at the end, what the tables of
    the model say on their words. All in one where the model has no tables."""
    if not isinstance(model.unmarked, Tables):
        return [laid]
    from turnmill.session import durable

    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams = [asked_grams(_gap_words(ks)) for ks in b.column(n).to_pylist()]
            take = pa.array(np.repeat(np.arange(len(grams)), [len(g) for g in grams]))
            cols = {k: b.column(i).take(take) for i, k in enumerate(keys)}
            for i, name in enumerate(GRAM):
                cols[name] = pa.array([g[i] for gs in grams for g in gs], pa.string())
            yield pa.RecordBatch.from_pydict(cols)

    bare = F.coalesce(F.get("laid_keys", F.lit(0)).contains("\t\t"), F.lit(False))
    asked = durable(laid.where(bare).select(*keys, "laid_keys").mapInArrow(run, f"{_types(laid, keys)}, {', '.join(f'{g} string' for g in GRAM)}"))
    known = asked.join(model.unmarked.chances(asked.select(*GRAM).distinct()), GRAM).groupBy(*keys).agg(F.collect_list(F.struct(*GRAM, "p")).alias("laid_chances"))
    return [laid.where(~bare), beside(laid.where(bare), known, keys)]


def _step_counts(laid: DataFrame, model: Model) -> np.ndarray:
    """Expected counts [words between, event before, event] of neighbouring gaps; at most twelve rows come to the driver.

    Each task walks over the gaps of its texts; a key's probability is worked out once in it.
    """
    sent = laid.sparkSession.sparkContext.broadcast((model.left.astype(np.float32), model.right.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, sums, seen = Model(*sent.value, None), [[0.0] * 4 for _ in range(3)], {}
        for b in batches:
            for keys, codes in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p = None
                for key, code in zip(keys, codes):
                    q = seen.get(key)
                    if q is None:
                        if len(seen) > 200_000:
                            seen.clear()
                        q = seen[key] = 1 / (1 + math.exp(-min(max(m.odds(key), -30), 30)))
                    if p is not None:
                        s, both = sums[code >> 1], p * q
                        s[0] += 1 - p - q + both
                        s[1] += q - both
                        s[2] += p - both
                        s[3] += both
                    p = q
        at = np.indices((3, 2, 2)).reshape(3, -1).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"between": pa.array(at[0]), "was": pa.array(at[1]), "now": pa.array(at[2]), "n": pa.array(np.array(sums).ravel())})

    steps = np.ones((3, 2, 2))
    several = laid.where((F.size("laid_keys") > 1) & ~F.get("laid_keys", F.lit(0)).contains("\t\t")).select("laid_keys", "laid_codes")
    for r in several.mapInArrow(run, "between int, was int, now int, n double").groupBy("between", "was", "now").agg(F.sum("n").alias("n")).collect():
        steps[r["between"], r["was"], r["now"]] += r["n"]
    return steps


def sentences(laid: DataFrame, keys: list[str], model: Model) -> DataFrame:
    """One row per sentence: ``keys``, ``sentence_no`` (from 0), ``start_char`` (the previous end), ``end_char``."""
    sent = laid.sparkSession.sparkContext.broadcast(model.sendable())
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for b in batches:
            ends = [m.ends(*x) for x in zip(*(c.to_pylist() for c in b.columns[n:]))]
            counts = np.fromiter((len(e) for e in ends), np.int64, len(ends))
            at = pa.array(np.repeat(np.arange(len(ends)), counts))
            cols = {k: b.column(i).take(at) for i, k in enumerate(keys)}
            cols["sentence_no"] = pa.array([i for e in ends for i in range(len(e))], pa.int32())
            cols["start_char"] = pa.array([x for e in ends for x in (0, *e[:-1])], pa.int64())
            cols["end_char"] = pa.array([x for e in ends for x in e], pa.int64())
            yield pa.RecordBatch.from_pydict(cols)

    parts = with_chances(laid.select(*keys, "laid_end", "laid_at", "laid_keys", "laid_codes"), keys, model)
    schema = f"{_types(laid, keys)}, sentence_no int, start_char bigint, end_char bigint"
    return reduce(DataFrame.unionAll, [part.mapInArrow(run, schema) for part in parts])
