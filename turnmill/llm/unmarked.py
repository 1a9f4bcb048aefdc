"""Sentence boundaries in texts that write no sentence marks at all.

A hidden-event trigram model over words and a boundary token: the boundary may stand in every gap between two words. A
state is whether a boundary stands just before the present word, so that the two tokens before the next one are known;
forward and backward passes over the two states give each gap's posterior. The model is fitted on sentences of texts
that do write marks, without the marks and in lower case; it backs off from three tokens to two and to one.

Its counts grow with the corpus, so in Spark they stay tables (``Tables``): a text asks for the chances of its own grams by joins.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The boundary, and what stands for a word that was never seen.
BOUNDARY, UNKNOWN = "\x02", "\x03"
_EDGES = "\"'“”‘’„«»‹›()[]{}<>*【】（）「」『』¿¡,;:-–—…"


#: Columns of a gram, the last token last.
GRAM = ["gram_a", "gram_b", "gram_c"]
#: Counts of three tokens, the first null at the beginning of a text. Where the second is null, how often words begin with a capital: by boundary before, capital.
COUNTED = "gram_a string, gram_b string, gram_c string, n bigint"
#: Words that a task holds before it passes their counts on.
HELD = 2_000_000


def known_form(word: str) -> str:
    """A word as the model counts it: lower case, without marks at its edges, digits alike."""
    w = word.lower().strip(_EDGES)
    return "".join("0" if c.isdigit() else c for c in w) if any(map(str.isdigit, w)) else w


class Unmarked:
    """Counts of one, two and three tokens, and how often words with capitals begin sentences or stand inside of them."""

    def __init__(self) -> None:
        self.tokens: Counter[tuple[str, ...]] = Counter()
        self.after: Counter[tuple[str, ...]] = Counter()  # tokens that followed a history
        self.kinds: Counter[tuple[str, ...]] = Counter()  # different ones of them
        self.capital = [[1.0, 1.0], [1.0, 1.0]]  # [boundary before][small, capital]
        self._seen: dict[tuple[str, ...], float] = {}

    def fit(self, texts: Iterable[list[list[str]]]) -> Unmarked:
        """Count the sentences, as lists of words, of each text."""
        for sentences in texts:
            stream = [BOUNDARY]
            for words in sentences:
                forms = [f for f in map(known_form, words) if f]
                for i, w in enumerate(words):
                    if w[:1].isupper() or w[:1].islower():
                        self.capital[i == 0][w[:1].isupper()] += 1
                if forms:
                    stream += [*forms, BOUNDARY]
            for i in range(1, len(stream)):
                for k in range(min(3, i + 1)):
                    gram = tuple(stream[i - k:i + 1])
                    if not self.tokens[gram]:
                        self.kinds[gram[:-1]] += 1
                    self.tokens[gram] += 1
                    self.after[gram[:-1]] += 1
        self._seen.clear()
        return self

    def knowing(self, chances: dict[tuple[str, ...], float]) -> Unmarked:
        """This model with the chances that a text asked ``Tables`` for."""
        self._seen = chances
        return self

    def chance(self, *gram: str) -> float:
        """P(last token | those before), drawn to the shorter history by the number of different followers (Witten and Bell)."""
        got = self._seen.get(gram)
        if got is None:
            history = gram[:-1]
            lower = self.chance(*gram[1:]) if history else 1.0 / (self.kinds[()] + 1.0)
            n, t = self.after[history], self.kinds[history]
            got = (self.tokens[gram] + t * lower) / (n + t) if n else lower
            if len(self._seen) > 500_000:
                self._seen.clear()
            self._seen[gram] = got
        return got

    def posteriors(self, words: list[str], chain: bool = True) -> list[float]:
        """Probability of a boundary in each gap between the words; without ``chain`` each gap is looked at by itself."""
        n = len(words)
        forms = [known_form(w) or UNKNOWN for w in words]
        cased = any(w != w.lower() for w in words) and any(w != w.upper() for w in words)
        upper = [self.capital[e][1] / sum(self.capital[e]) for e in (0, 1)]
        # steps[i][was][is]: from the state at word i to that at word i + 1
        steps = []
        for i in range(n - 1):
            w, x = forms[i], forms[i + 1]
            c = [1.0, 1.0]
            if cased and (words[i + 1][:1].isupper() or words[i + 1][:1].islower()):
                c = [u if words[i + 1][:1].isupper() else 1.0 - u for u in upper]
            row = []
            for u in (forms[i - 1] if i else BOUNDARY, BOUNDARY):
                row.append((c[0] * self.chance(u, w, x), c[1] * self.chance(u, w, BOUNDARY) * self.chance(w, BOUNDARY, x)))
            steps.append(row)
        if not chain:
            return [s[0][1] / (s[0][0] + s[0][1]) for s in steps]
        forward = [(0.0, 1.0)]
        for s in steps:
            a, b = forward[-1]
            x, y = a * s[0][0] + b * s[1][0], a * s[0][1] + b * s[1][1]
            forward.append((x / (x + y), y / (x + y)))
        last = [self.chance(forms[-2] if n > 1 else BOUNDARY, forms[-1], BOUNDARY), self.chance(BOUNDARY, forms[-1], BOUNDARY)]
        out, back = [0.0] * (n - 1), (last[0], last[1])
        for i in range(n - 1, 0, -1):
            a, b = forward[i][0] * back[0], forward[i][1] * back[1]
            out[i - 1] = b / (a + b)
            s = steps[i - 1]
            x, y = s[0][0] * back[0] + s[0][1] * back[1], s[1][0] * back[0] + s[1][1] * back[1]
            top = math.fsum((x, y))
            back = (x / top, y / top)
        return out


class _Asking(Unmarked):
    """Notes which chances are asked for."""

    def chance(self, *gram: str) -> float:
        self.tokens[gram] = 1
        return 1.0


def asked_grams(words: list[str]) -> list[tuple[str, ...]]:
    """All grams, of three tokens, whose chances the posteriors of a text ask for."""
    a = _Asking()
    a.posteriors(words)
    return list(a.tokens)


class _Words(dict):
    """Numbers of words; by number, that of their form (0 a text's beginning, 1 the boundary, -1 nothing) and 1 for a small letter first, 2 for a capital."""

    def __init__(self, bare: Callable[[str], str]):
        self.bare, self.forms, self.form, self.letter = bare, {None: 0, BOUNDARY: 1}, [0, 1], [0, 0]

    def __missing__(self, word: str) -> int:
        w = self.bare(word)
        f = known_form(w)
        self.form.append(self.forms.setdefault(f, len(self.forms)) if f else -1)
        self.letter.append(2 if w[:1].isupper() else int(w[:1].islower()))
        self[word] = n = len(self.form) - 1
        return n


def _counted(words: _Words, stream: list[int]) -> pa.RecordBatch:
    form, letter = np.array(words.form), np.array(words.letter)
    at = np.array(stream, np.int64)
    at = at[form[at] >= 0]
    at = at[~((at == 1) & (np.append(-1, at[:-1]) == 1))]  # a sentence without words
    first, begins = np.append(-1, at[:-1]) == 1, letter[at]
    capital = [[int(np.sum((first == e) & (begins == u))) for u in (1, 2)] for e in (0, 1)]
    t = form[at]
    a, b, c = t[:-2], t[1:-1], t[2:]
    keep = (b > 0) & (c > 0)
    a, b, c = a[keep], b[keep], c[keep]
    if len(words.forms) < 1 << 21:
        codes, n = np.unique(a << 42 | b << 21 | c, return_counts=True)
        a, b, c = codes >> 42, codes >> 21 & (1 << 21) - 1, codes & (1 << 21) - 1
    else:
        rows, n = np.unique(np.stack([a, b, c], 1), axis=0, return_counts=True)
        a, b, c = rows.T
    known = pa.array(list(words.forms), pa.string())
    cols = [pa.concat_arrays([known.take(pa.array(x)), pa.array(y, pa.string())]) for x, y in ((a, list("0011")), (b, [None] * 4), (c, list("0101")))]
    return pa.RecordBatch.from_arrays([*cols, pa.array([*n.tolist(), *capital[0], *capital[1]], pa.int64())], names=[*GRAM, "n"])


def count_grams(texts: Iterable[list[list[str]]], bare: Callable[[str], str]) -> Iterator[pa.RecordBatch]:
    """Rows of COUNTED over texts, given as the words of their sentences; ``bare`` takes marks from a word."""
    words, stream = _Words(bare), []
    for sentences in texts:
        stream += (0, 1)
        for s in sentences:
            stream += map(words.__getitem__, s)
            stream.append(1)
        if len(stream) >= HELD:
            yield _counted(words, stream)
            words, stream = _Words(bare), []
    yield _counted(words, stream)


class Tables:
    """The counts of ``Unmarked`` over a whole corpus, as tables. Only totals come to the driver."""

    def __init__(self, counted: DataFrame):
        from turnmill.session import durable

        sums = durable(counted.groupBy(*GRAM).agg(F.sum("n").alias("n")))
        self.capital = [[1.0, 1.0], [1.0, 1.0]]
        for r in sums.where("gram_b is null").collect():  # four rows
            self.capital[int(r["gram_a"])][int(r["gram_c"])] += r["n"]
        # every token but the boundary that a text begins with is the last of one row
        two = durable(sums.where("gram_b is not null").groupBy("gram_b", "gram_c").agg(F.sum("n").alias("n")))
        self.grams = [two.groupBy("gram_c").agg(F.sum("n").alias("n")), two, sums.where("gram_a is not null and gram_b is not null")]
        r = self.grams[0].agg(F.sum("n").alias("after"), F.count(F.lit(1)).alias("kinds")).first()
        self.after, self.kinds = r["after"] or 0, r["kinds"]

    def shell(self) -> Unmarked:
        """What the executors make the model of a text of, with the chances it asked for (``Unmarked.knowing``)."""
        out = Unmarked()
        out.capital = self.capital
        return out

    def chances(self, asked: DataFrame) -> DataFrame:
        """``asked`` (GRAM, none twice) with ``p``, the same as ``Unmarked.chance``. Shorter grams are settled first, each once."""
        names: list[str] = []
        p = None
        for name in reversed(GRAM):
            names = [name, *names]
            history = names[:-1]
            counted = self.grams[len(history)]
            rows = asked.select(*names).distinct()
            if p is None:
                rows = rows.select("*", F.lit(1.0 / (self.kinds + 1.0)).alias("p"), F.lit(self.after).cast("long").alias("after"), F.lit(self.kinds).cast("long").alias("kinds"))
            else:
                followers = counted.join(rows.select(*history).distinct(), history, "left_semi").groupBy(*history).agg(F.sum("n").alias("after"), F.count(F.lit(1)).alias("kinds"))
                rows = rows.join(p, names[1:]).join(followers, history, "left")
            rows = rows.join(counted, names, "left")
            p = rows.select(*names, F.when(F.col("after") > 0, (F.coalesce("n", F.lit(0)) + F.col("kinds") * F.col("p")) / (F.col("after") + F.col("kinds"))).otherwise(F.col("p")).alias("p"))
        return p
