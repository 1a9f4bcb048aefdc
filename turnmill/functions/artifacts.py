"""Written forms in transcripts that need care before they are spoken: one expression for all categories.

``artifact_entries`` gives every (category, token) of a text, so that a scan and one generator feed any count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------------------------------------------
#: Category, pattern, group of the token.
PATTERNS = (
    ("years", r"\b(19\d{2}|20\d{2})\b", 1),
    ("abbreviations", r"(?i)\b(?:Inc|No|Jr|Sr|Mr|Mrs|Ms|Dr|Gen|Gov|Hon|Sec|Rep|Sen|Prof|St|Vol|Ed|Rev|cf|e\.g|i\.e|etc|vs)\.(?=\s|$|[,)])", 0),
    ("versus", r"(?i)\b(vs?\.?)\s+(?=[A-Z])", 1),
    ("ordinals", r"(?i)\b(\d+)(st|nd|rd|th)\b", 0),
    ("section_refs", r"(?i)(§|¶|\bSection\s+\d+[\w()\-]*)", 1),
    ("dates_month_year", r"(?i)\b(January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s*\d{4}\b", 0),
    ("likely_initials", r"(?<=\s)([A-Z])\.(?=\s|$)", 0),
    ("historical_years", r"\b(1[0-8]\d{2})\b", 1),
    ("no_dot_context", r"(?i)\bNo\.\s+(\S+)", 1),
    ("no_dot_citation", r"(?i)\bNo\.\s+(\d+-\d+)", 0),
    ("roman_numerals", r"\b(II|III|IV|V|VI|VII|VIII|IX|X|XI|XII)\b", 1),
    ("decades", r"\b(19|20)\d{2}s\b", 0),
    ("ordinals_word", r"(?i)\b(First|Second|Third|Fourth|Fifth|Sixth|Seventh|Eighth|Ninth|Tenth|Eleventh|Twelfth)\b", 1),
    ("statute_citation", r"(?i)\d+\s*U\.?S\.?C\.?", 0),
    ("statute_citation", r"(?i)Title\s+\d+", 0),
    ("awareness_mixed_case", r"\b[A-Z][a-z]+[A-Z]\w*\b", 0),
    ("awareness_all_caps_long", r"\b[A-Z]{6,}\b", 0),
    ("awareness_brackets_numbered", r"\b\d+\)", 0),
    ("numbered_list_marker", r"\b\d+\)", 0),
    ("editorial_square_bracket", r"\[=\s*([^\]]*)\]", 0),
    ("dash_range", r"\d+[–—-]\d+", 0),
    ("structural_bracket", r"\(([a-zA-Z])\)", 0),
    ("structural_bracket", r"\((\d{1,2})\)", 0),
    ("awareness_leading_decimal", r"(?<!\d)(\.\d+)", 1),
)
CASE_ID, VOTE = r"\b(\d{1,2}-\d+)\b", r"^\d-\d$"
ACRONYM = r"\b([A-Z]{2,5})\b"
NOT_ACRONYMS = ("IT", "DO", "US", "SO", "OR", "NO", "IF", "AS", "AT", "BE", "BY", "HE", "ME", "WE", "AN")
CURRENCY, PERCENTAGE, ET_AL = r"\$[\d,]+(?:\.[\d]+)?", r"\d+%|\d+\s*percent", r"(?i)\bet\s+al\.?"
HEADERS = ("ORAL ARGUMENT OF", "REBUTTAL OF", "RESUMED ORAL ARGUMENT OF")
SYMBOLS = ("…", "–", "—", "†", "‡", "•")
BRACKETS = (("awareness_brackets_parens", "(", ")", r"\(([^)]*)\)", True), ("awareness_brackets_square", "[", "]", r"\[([^\]]*)\]", True),
            ("awareness_brackets_curly", "{", "}", r"\{([^}]*)\}", False))
BRACKET_LENGTH = 80
NON_SPEECH = (r"(?i)^(inaudible|voice\s*overlap|laughter|coughing|audio\s*cut|recess|dollars|noise|ph|indiscernible|mirth|sneezes|sighs|"
              r"applause|break|luncheon|lunch|interruption|banging|attempt\s*to\s*laughter)\.?$")
#: Rules that need examples: label and categories.
RULES = (
    ("case_ids", "case_ids", ("case_ids",)), ("versus", "versus", ("versus",)), ("title_mr", "Title (Mr. / Ms.)", ("abbreviations",)), ("years", "years", ("years",)),
    ("historical_years", "Historical year (1xxx)", ("historical_years",)), ("age", "Age / small number", ()), ("currency", "currency", ("currency",)),
    ("section_refs", "Section number (legal)", ("section_refs",)), ("acronyms", "acronyms", ("acronyms",)), ("no_negation", '"No." (negation)', ("no_dot_context",)),
    ("no_number", '"No." (number/citation)', ("no_dot_citation",)), ("unspoken_headers", "Unspoken section headers", ("unspoken_headers",)),
    ("vote_tally", "Vote tally (9-0, 7-2)", ("vote_tally",)), ("roman_numerals", "Roman numeral (VII, IV)", ("roman_numerals",)),
    ("percentages", "Percentage (50%, 25 percent)", ("percentages",)), ("decades", "Decade (1980s, 1930s)", ("decades",)),
    ("ordinals_word", "Ordinal (word): Fifth, Seventh", ("ordinals_word",)), ("statute_citation", "Statute citation (21 U.S.C., Title 18)", ("statute_citation",)))
# --------------------------------------------------------------------------------------------------------------------


def code_point(char: Column) -> Column:
    """'U+XXXX' of a character."""
    digits = F.hex(F.ascii(char))
    return F.concat(F.lit("U+"), F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits))


def _tagged(category: str, tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.struct(F.lit(category).alias("category"), t.alias("token")))


def _tidy(tokens: Column) -> Column:
    """Without outer blanks, double blanks made single once, empty ones dropped."""
    return F.filter(F.transform(tokens, lambda t: F.trim(F.replace(F.trim(t), F.lit("  "), F.lit(" ")))), lambda t: t != "")


def _set_off(opener: str, closer: str) -> Callable[[Column], Column]:
    return lambda x: F.concat(F.lit(opener), x, F.lit(closer))


def artifact_entries(text: Column) -> Column:
    """Array of (category, token), with repetitions; empty for a null or empty text."""
    t = F.coalesce(text, F.lit(""))
    # digits, blanks and word boundaries of all scripts
    found = lambda p, g: F.regexp_extract_all(t, F.lit("(?U)" + p), F.lit(g))
    parts = [_tagged(c, _tidy(found(p, g))) for c, p, g in PATTERNS]
    ids = found(CASE_ID, 1)
    parts.append(F.transform(ids, lambda x: F.struct(F.when(x.rlike(VOTE), "vote_tally").otherwise("case_ids").alias("category"), x.alias("token"))))
    parts.append(_tagged("acronyms", F.filter(found(ACRONYM, 1), lambda x: ~x.isin(list(NOT_ACRONYMS)))))
    parts.append(_tagged("currency", F.transform(found(CURRENCY, 0), lambda x: F.replace(x, F.lit(","), F.lit("")))))
    parts.append(_tagged("percentages", F.transform(found(PERCENTAGE, 0), lambda x: F.regexp_replace(F.replace(F.trim(x), F.lit(" "), F.lit("")), "percent$", "%"))))
    parts.append(_tagged("abbreviations", F.transform(found(ET_AL, 0), lambda x: F.lit("et al."))))
    parts.append(_tagged("unspoken_headers", F.array_compact(F.array(*[F.when(t.contains(h), h) for h in HEADERS]))))
    chars = F.filter(F.split(t, ""), lambda c: (c != "") & (F.ascii(c) > 127))
    parts.append(_tagged("awareness_non_ascii", F.transform(chars, code_point)))
    parts.append(_tagged("awareness_symbols", F.array_compact(F.array(*[F.when(t.contains(s), f"U+{ord(s):04X}") for s in SYMBOLS], F.when(t.contains("..."), "...")))))
    for category, a, b, pattern, speech in BRACKETS:
        inner = F.transform(found(pattern, 1), lambda x: F.trim(x))
        short = F.transform(inner, lambda x: F.when(F.length(x) > BRACKET_LENGTH, F.concat(F.substring(x, 1, BRACKET_LENGTH), F.lit("..."))).otherwise(x))
        whole = _set_off(a, b)
        parts.append(_tagged(category, F.transform(short, whole)))
        if speech:
            said = F.filter(short, lambda x: F.trim(F.regexp_replace(F.trim(x), r"\.+$", "")).rlike(NON_SPEECH))
            parts.append(_tagged("non_speech_brackets", F.transform(said, whole)))
    parts.append(_tagged("ellipsis", F.transform(found(r"\.\.\.", 0), lambda x: F.lit("..."))))
    parts.append(_tagged("ellipsis", F.transform(found("…", 0), lambda x: F.lit("U+2026"))))
    decimals = found(r"(?<!\d)(\.\d+)", 1)
    parts.append(_tagged("leading_decimal", F.filter(decimals, lambda x: (F.length(x) != 5) | ~(x.startswith(".1") | x.startswith(".2")))))
    return F.concat(*parts)


def name_entries(name: Column) -> Column:
    """Suffixes and initials in a speaker's name as (category, token)."""
    n = F.coalesce(name, F.lit(""))
    return F.concat(
        _tagged("abbreviations", F.array_compact(F.array(F.when(n.contains(" Jr."), "Jr."), F.when(n.contains(" Sr."), "Sr.")))),
        _tagged("likely_initials", F.regexp_extract_all(n, F.lit(r"(?U)\b([A-Z])\."), F.lit(0))))


def artifact_counts(df: DataFrame, text: str) -> DataFrame:
    """(category, token, n) over all texts."""
    return df.select(F.explode(artifact_entries(F.col(text))).alias("e")).groupBy("e.category", "e.token").agg(F.count(F.lit(1)).alias("n"))


def artifact_paths(df: DataFrame, text: str, path: str) -> DataFrame:
    """(category, paths): the distinct places in which a category occurs, as rows so that no list grows without bound."""
    return df.select(path, F.explode(artifact_entries(F.col(text))).alias("e")).select(F.col("e.category").alias("category"), F.col(path).alias("path")).distinct()


def artifacts_by_place(df: DataFrame, text: str, path: str) -> DataFrame:
    """(category, path, n): how often a category occurs in each place; counts and places of categories follow from it."""
    return df.select(path, F.explode(artifact_entries(F.col(text))).alias("e")).groupBy(F.col("e.category").alias("category"), F.col(path).alias("path")).agg(F.count(F.lit(1)).alias("n"))


def rules_wanting_examples(counts: DataFrame, paths: DataFrame, least: int, examples: int = 15) -> DataFrame:
    """Rules whose categories have fewer than ``least`` tokens: rule_id, label, current, need and up to ``examples`` places, fewest first."""
    spark = counts.sparkSession
    rules = spark.createDataFrame([(r, label, list(c)) for r, label, c in RULES], "rule_id string, label string, categories array<string>")  # eighteen rows
    by_rule = rules.select("rule_id", "label", F.explode_outer("categories").alias("category"))
    n = by_rule.join(counts.groupBy("category").agg(F.sum("n").alias("n")), "category", "left").groupBy("rule_id", "label").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("current"))
    w = Window.partitionBy("rule_id").orderBy("path")
    some = (by_rule.join(paths, "category").select("rule_id", "path").distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= examples)
            .groupBy("rule_id").agg(F.array_sort(F.collect_list("path")).alias("examples")))
    return (n.where(F.col("current") < least).join(some, "rule_id", "left")
            .select("rule_id", "label", "current", (F.lit(least) - F.col("current")).alias("need"), F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))
            .orderBy("current", "label"))
