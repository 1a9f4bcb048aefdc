"""Speech transcripts as clean, ordered speaker turns.

One pass over each text (``turnmill.llm.scan``: Aho-Corasick hits settled by context rules) gives labels, clock times,
remarks and hesitation sounds; subtracting these intervals leaves the clean text. The speaker is the given id, else the
person that the label or the written name means, looked up among those of the recording, then among all known ones.
Windows over each recording join neighbouring turns of one person.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.scan import KINDS, TITLES, scan

#: Turns of a recording that one task orders at once; the seams between such blocks are joined afterwards.
BLOCK = 4096

_NOISE = re.compile(r"\([^)]*\)|\[[^\]]*\]|[:：?]|\b(?:esq|jr|sr|ii|iii)\b\.?", re.I)
_JUDGE = re.compile(r",?\s*\bC?\.?J{1,2}\.?\s*$")
#: Written instead of a name.
NOBODY = frozenset("unknown unidentified voice speaker male female man woman audience inaudible none null n/a na anonymous various all".split())
CHIEF = "\x00chief"


def name_parts(name: str | None) -> tuple[str, str] | None:
    """(first name or '', surname) in lower case of a name however written; CHIEF as surname for that office; None for none."""
    if not name:
        return None
    s = " ".join(_NOISE.sub(" ", name.replace(" ", " ")).split())
    low = s.lower().strip(" .,")
    if "chief justice" in low and len(low.split()) <= 4:
        return "", CHIEF
    s = _JUDGE.sub("", s).strip(" ,")
    turned = ""
    if "," in s:
        last, _, rest = s.partition(",")
        turned, s = last.strip(), rest.strip()
    words = [w for w in (x.strip(".,'\"") for x in s.lower().split()) if w and w not in TITLES and w not in ("j", "for", "petitioner", "respondent", "the") or len(w) == 1]
    if turned:
        sur = [w for w in turned.lower().split() if w.strip(".") not in TITLES]
        words = [w for w in words if w] + ([" ".join(sur)] if sur else [])
    words = [w for w in words if w]
    if not words or all(w in NOBODY for w in words):
        return None
    sur = words[-1]
    if len(sur) < 2 or not any(map(str.isalpha, sur)):
        return None
    first = words[0] if len(words) > 1 else ""
    return ("" if words[:-1] == ["j"] else first), sur  # J. before a surname alone stands for the office


MARKED = "spans array<struct<kind:int,start:int,stop:int>>, said boolean, clean_text string, label string, written array<struct<rank:int,first:string,surname:string>>"


def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text without its spans; punctuation and spaces that only they needed go too."""
    parts, p = [], 0
    for a, b, kind in spans:
        parts.append(text[p:a])
        if kind == 2:
            while b < len(text) and text[b] in ",":
                b += 1
            m = re.match(r"\s*(?:--|—|–)\s+", text[b:b + 6])
            if m:
                b += m.end()
        p = b
        if parts[-1] and not parts[-1][-1].isspace():
            parts.append(" ")
    parts.append(text[p:])
    s = " ".join("".join(parts).split())
    s = re.sub(r"\s+([,.;:?!。，！？])", r"\1", s)
    return re.sub(r"^[\s,;.–—-]+(?=\w)", "", s)


def mark(df: DataFrame, keys: list[str], text: str, speaker_id: str, speaker_name: str) -> DataFrame:
    """``keys``, ``speaker_id`` and the MARKED columns of every row.

    A null, empty or blank text says nothing; so does one that consists of spans and punctuation.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", speaker_id bigint, {MARKED}"
    n = len(keys)
    span_t = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
    name_t = pa.list_(pa.struct([("rank", pa.int32()), ("first", pa.string()), ("surname", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, names, texts = (b.column(n + i).to_pylist() for i in range(3))
            spans, said, cleaned, labels, written = [], [], [], [], []
            for i, who, t in zip(ids, names, texts):
                found = scan(t) if t else []
                spans.append([{"kind": k, "start": a, "stop": e} for a, e, k in found])
                p, some = 0, False
                for a, e, _ in found:
                    if any(map(str.isalnum, t[p:a])):
                        some = True
                        break
                    p = e
                if not some and t:
                    some = any(map(str.isalnum, t[p:]))
                said.append(some)
                cleaned.append(clean(t, found) if found else (" ".join(t.split()) if t else t))
                lab = next((t[a:e - 1] for a, e, k in found if k == 3), None)
                labels.append(lab)
                w = []
                if i is None:
                    for rank, x in ((0, lab), (1, who)):
                        parts = name_parts(x)
                        if parts:
                            w.append({"rank": rank, "first": parts[0], "surname": parts[1]})
                written.append(w)
            cols = {k: b.column(j) for j, k in enumerate(keys)}
            cols |= {"speaker_id": b.column(n), "spans": pa.array(spans, span_t), "said": pa.array(said, pa.bool_()), "clean_text": pa.array(cleaned, pa.string()),
                     "label": pa.array(labels, pa.string()), "written": pa.array(written, name_t)}
            yield pa.RecordBatch.from_pydict(cols)

    return df.select(*keys, F.col(speaker_id).cast("long").alias("speaker_id"), F.col(speaker_name).cast("string"), F.col(text).cast("string")).mapInArrow(run, schema)


def _variants(name: Column) -> Column:
    """The name and every form of it with one letter less: two names within one slip of each other share one."""
    return F.array_distinct(F.concat(F.array(name), F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1))), lambda i: F.concat(F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, F.length(name))))))


def _name_columns(name: Column) -> tuple[Column, Column]:
    words = F.split(F.lower(F.trim(name)), r"\s+")
    return F.element_at(words, 1), F.element_at(words, -1)


def settle_speakers(marked: DataFrame, keys: list[str], recording: str, people: DataFrame, present: DataFrame, chiefs: DataFrame) -> DataFrame:
    """``marked`` with ``person``: the given id, else the one that is meant, else -1.

    people: (speaker_id, name), everyone known; present: (recording, speaker_id), who is known to speak there; chiefs:
    (recording, speaker_id), who presides there. A written name is looked up among those present, with at most one slip
    in the surname, then among all with the same full name, then among all with the same surname; where that names
    several, nothing tells who speaks. Joins are on names and their variants; no pairs of all with all are made, and names that
    several people share are reduced to one row, or none, before they are joined.
    """
    named = people.where(F.col("speaker_id").isNotNull() & F.col("name").isNotNull()).groupBy("speaker_id").agg(F.min("name").alias("name"))
    first, sur = _name_columns(F.col("name"))
    named = named.select("speaker_id", first.alias("first0"), sur.alias("sur0"))
    unknown = (marked.where(F.col("speaker_id").isNull() & (F.size("written") > 0))
               .select(*keys, F.explode("written").alias("w")).select(*keys, "w.rank", "w.first", "w.surname"))
    first_ok = (F.col("first") == "") | (F.substring("first", 1, 1) == F.substring("first0", 1, 1)) | ((F.length("first") > 3) & (F.levenshtein("first", "first0") <= 1))
    here = present.where(F.col("speaker_id").isNotNull()).distinct().join(named, "speaker_id").withColumn("v", F.explode(_variants(F.col("sur0"))))
    near = (unknown.withColumn("v", F.explode(_variants(F.col("surname")))).join(here.select(recording, "v", "speaker_id", "first0", "sur0"), [recording, "v"])
            .where(first_ok).select(*keys, "rank", "speaker_id", F.when(F.col("surname") == F.col("sur0"), 0).otherwise(1).alias("step")).distinct())
    # one row per full name, however many people have it
    same = named.groupBy("sur0", "first0").agg(F.min("speaker_id").alias("speaker_id"), F.max("speaker_id").alias("hi")).where("speaker_id = hi").drop("hi")
    full = (unknown.where("first <> ''").join(same, (F.col("surname") == F.col("sur0")) & (F.col("first") == F.col("first0")))
            .select(*keys, "rank", "speaker_id", F.lit(2).alias("step")))
    only = named.groupBy("sur0").agg(F.count(F.lit(1)).alias("n"), F.min("speaker_id").alias("speaker_id"), F.min("first0").alias("first0")).where("n = 1")
    wide = (unknown.join(only, F.col("surname") == F.col("sur0")).where(first_ok).select(*keys, "rank", "speaker_id", F.lit(3).alias("step")))
    head = (unknown.where(F.col("surname") == CHIEF).join(chiefs.where(F.col("speaker_id").isNotNull()).distinct(), recording)
            .select(*keys, "rank", "speaker_id", F.lit(0).alias("step")))
    hits = near.unionByName(full).unionByName(wide).unionByName(head)
    best = (hits.groupBy(*keys, "rank", "step").agg(F.min("speaker_id").alias("lo"), F.max("speaker_id").alias("hi"))
            .where("lo = hi").groupBy(*keys).agg(F.min(F.struct("rank", "step", "lo")).alias("m")).select(*keys, F.col("m.lo").alias("_meant")))
    return marked.join(best, keys, "left").withColumn("person", F.coalesce("speaker_id", "_meant", F.lit(-1))).drop("_meant")


def runs_of_one_person(turns: DataFrame, recording: str, index: str, person: str, block: int = BLOCK) -> DataFrame:
    """Longest runs of turns by one person: ``recording``, ``first_index``, ``last_index``, ``person``, ``turns``.

    Turns with person -1 stand alone. Each block of a recording is ordered by itself; of each only the first and the last
    run go on to the joining of the seams, so a recording of any length reaches one task as 2 rows per block.
    """
    rows = turns.select(recording, F.col(index).cast("long").alias("_i"), F.col(person).alias("_p")).where(F.col(recording).isNotNull() & F.col("_i").isNotNull())
    rows = rows.withColumn("_b", F.floor(F.col("_i") / F.lit(block)).cast("long"))
    w = Window.partitionBy(recording, "_b").orderBy("_i")
    new = F.coalesce((F.lag("_p").over(w) != F.col("_p")) | (F.col("_p") == -1), F.lit(True))
    rows = rows.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    local = rows.groupBy(recording, "_b", "_run", "_p").agg(F.min("_i").alias("_a"), F.max("_i").alias("_z"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(recording, "_b")
    local = local.withColumn("_edge", (F.col("_run") == 1) | (F.col("_run") == F.max("_run").over(whole)))
    out = ["_a", "_z", "_p", "_n"]
    inner = local.where(~F.col("_edge")).select(recording, *out)
    along = Window.partitionBy(recording).orderBy("_a")
    seam = local.where("_edge").withColumn("_cut", F.coalesce(
        (F.lag("_p").over(along) != F.col("_p")) | (F.col("_p") == -1) | (F.lag("_b").over(along) == F.col("_b")), F.lit(True)).cast("int"))
    seam = (seam.withColumn("_g", F.sum("_cut").over(along.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(recording, "_g", "_p").agg(F.min("_a").alias("_a"), F.max("_z").alias("_z"), F.sum("_n").alias("_n")).select(recording, *out))
    return inner.unionByName(seam).select(recording, F.col("_a").alias("first_index"), F.col("_z").alias("last_index"), F.col("_p").alias("person"), F.col("_n").alias("turns"))


def item_rows(marked: DataFrame, keys: list[str]) -> DataFrame:
    """One row per span: ``keys``, ``item``, ``start_char``, ``end_char``."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return marked.select(*keys, F.explode("spans").alias("s")).select(
        *keys, F.get(kinds, F.col("s.kind")).alias("item"), F.col("s.start").cast("long").alias("start_char"), F.col("s.stop").cast("long").alias("end_char"))
