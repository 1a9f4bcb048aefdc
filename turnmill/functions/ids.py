"""Column functions on identifiers, titles, dates, urls and hashes of recordings and documents.

Null gives null unless said otherwise; an input that cannot be read gives the stated fallback and never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------------------------------------------
#: Marks inside a recording id, the first that occurs counts.
RECORDING_MARKS = (("-opinion-dissent", "dissent"), ("-opinion-concurrence", "concurrence"), ("-opinion-concur", "concurrence"), ("-opinion", "opinion"), ("-argument", "oral_argument"))
#: Letter after the date at the head of an older recording id.
RECORDING_LETTERS = {"a": "oral_argument", "o": "opinion", "r": "oral_argument"}
#: Names in the text of an error that say that there is nothing to fetch.
GONE = "NoSuchKey|AccessDenied|Unrecognized (?:S3 )?URL"
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
#: First term that was recorded digitally.
DIGITAL_FROM = 2006
MEDIA_KINDS = {"audio/mpeg": "mp3", "audio/ogg": "ogg", "application/x-mpegURL": "hls"}
EXTENSIONS = {
    "application/json": ".json", "text/json": ".json", "text/html": ".html", "text/plain": ".txt", "text/xml": ".xml", "application/xml": ".xml",
    "text/css": ".css", "text/javascript": ".js", "application/javascript": ".js", "image/png": ".png", "image/jpeg": ".jpg", "image/gif": ".gif",
    "image/webp": ".webp", "audio/mpeg": ".mp3", "audio/wav": ".wav", "video/mp4": ".mp4", "application/pdf": ".pdf", "application/octet-stream": ".bin"}
#: Date at the head of an older recording id, with its letter after it, and inside a newer one.
OLD_DATE, OLD_LETTER, NEW_DATE = r"^(\d{8})[a-z]_", r"^\d{8}([a-z])_", r"_(\d{8})-"
#: Month, day and year in a title.
TITLE_DATE = r"[-,] ([A-Za-z]+) (\d{1,2}), (\d{4})(?:\s|$|[(\s])"
#: Speakers in titles, and how titles of plain kinds begin.
DISSENT, CONCURRENCE, DISSENT_BY = r"^Dissenting Opinion - (\w+) - ", r"^Concurring Opinion - (\w+) - ", r"\(Dissent by (\w+)\)"
ARGUMENT_HEAD, OPINION_HEAD = "Oral Argument", "Opinion Announcement"
# --------------------------------------------------------------------------------------------------------------------


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def _found(s: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    x = F.regexp_extract(s, pattern, group)
    return F.when(x != "", x)


def epoch_date(seconds: Column) -> Column:
    """Date (yyyy-MM-dd, UTC) of seconds since 1970, which may be negative."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")), "yyyy-MM-dd")


def recording_type(recording_id: Column) -> Column:
    """oral_argument, opinion, dissent, concurrence or unknown."""
    c = F.lit(None).cast("string")
    for mark, kind in reversed(RECORDING_MARKS):
        c = F.when(recording_id.contains(mark), F.lit(kind)).otherwise(c)
    letter = F.regexp_extract(recording_id, OLD_LETTER, 1)
    return F.coalesce(c, _lookup(RECORDING_LETTERS)[letter], F.when(recording_id.isNotNull(), "unknown"))


def _date_struct(y: Column, m: Column, d: Column, ok: Column) -> Column:
    return F.when(ok, F.struct(y.alias("year"), m.alias("month"), d.alias("day")))


def recording_date(recording_id: Column) -> Column:
    """(year, month, day) at the head of an older id or between '_' and '-' of a newer one; months and days are only held to 1-12 and 1-31."""
    s = F.coalesce(_found(recording_id, OLD_DATE), _found(recording_id, NEW_DATE))
    y, m, d = (F.substring(s, a, n).cast("int") for a, n in ((1, 4), (5, 2), (7, 2)))
    return _date_struct(y, m, d, m.between(1, 12) & d.between(1, 31))


def title_date(title: Column) -> Column:
    """(year, month, day) after a dash or comma in a title: full month name, day 1-31, year from 1900."""
    p = TITLE_DATE
    month = F.array_position(F.array(*[F.lit(x.lower()) for x in MONTHS]), F.lower(F.regexp_extract(title, p, 1))).cast("int")
    y, d = _found(title, p, 3).cast("int"), _found(title, p, 2).cast("int")
    return _date_struct(y, month, d, (month > 0) & d.between(1, 31) & (y >= 1900))


def iso_date(date: Column) -> Column:
    """Text of a (year, month, day) struct; the year is not padded."""
    return F.when(date.isNotNull(), F.concat_ws("-", date["year"].cast("string"), F.lpad(date["month"].cast("string"), 2, "0"), F.lpad(date["day"].cast("string"), 2, "0")))


def date_mismatch(a: Column, b: Column) -> Column:
    """Whether two dates are both known and differ."""
    return F.coalesce(a != b, F.lit(False))


def recording_id_of_url(url: Column) -> Column:
    """Base name of a url up to its first point."""
    base = F.split_part(F.trim(F.element_at(F.split(url, "/"), -1)), F.lit("."), F.lit(1))
    return F.when(base != "", base)


def recording_id_of_path(path: Column) -> Column:
    """File name without extension and without '.delivery'."""
    return F.regexp_replace(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", ""), r"\.delivery$", "")


def term_and_docket(path: Column) -> Column:
    """Struct of the two folders after 'case_data', null where there are none."""
    t, d = (_found(path, r"(?:^|/)case_data/([^/]+)/([^/]+)", i) for i in (1, 2))
    return F.when(t.isNotNull(), F.struct(t.alias("term"), d.alias("docket")))


def opinion_title(title: Column) -> Column:
    """(type, speaker) of an opinion's title: dissent, concurrence or majority."""
    d, c, old = _found(title, DISSENT), _found(title, CONCURRENCE), _found(title, DISSENT_BY)
    kind = F.when(d.isNotNull(), "dissent").when(c.isNotNull(), "concurrence").when(old.isNotNull(), "dissent").when(title.isNotNull(), "majority")
    return F.struct(kind.alias("type"), F.coalesce(d, c, old).alias("speaker"))


def transcript_title(title: Column) -> Column:
    """(type, speaker) of a transcript's title: oral_argument, dissent, concurrence, opinion or unknown."""
    d, c = _found(title, DISSENT), _found(title, CONCURRENCE)
    kind = (F.when(title.startswith(ARGUMENT_HEAD), "oral_argument").when(d.isNotNull(), "dissent").when(c.isNotNull(), "concurrence")
            .when(title.startswith(OPINION_HEAD), "opinion").when(title.isNotNull(), "unknown"))
    return F.struct(kind.alias("type"), F.coalesce(d, c).alias("speaker"))


def era(term: Column) -> Column:
    """digital, analog, or unknown for a term that is no number (or null)."""
    y = term.try_cast("int")
    return F.when(y >= DIGITAL_FROM, "digital").when(y < DIGITAL_FROM, "analog").otherwise("unknown")


def format_order(term: Column) -> Column:
    """The preferred audio format and the other."""
    return F.when(term.try_cast("int") < DIGITAL_FROM, F.array(F.lit("ogg"), F.lit("mp3"))).otherwise(F.array(F.lit("mp3"), F.lit("ogg")))


def slug(name: Column) -> Column:
    """Lower-case name with single underscores; an empty or null name gives ''."""
    s = F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)[^\w\s]", ""))
    return F.lower(F.regexp_replace(F.regexp_replace(s, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", "_"))


def audio_urls(media: Column) -> Column:
    """Map of format to address of media files; the last of a kind counts, other kinds and null elements are passed over."""

    def entry(mime: str, name: str) -> Column:
        own = F.filter(F.coalesce(media, F.array()), lambda m: m.isNotNull() & m["href"].isNotNull() & (m["mime"] == mime))
        return F.when(F.size(own) > 0, F.struct(F.lit(name).alias("key"), F.try_element_at(own, F.lit(-1))["href"].alias("value")))

    return F.map_from_entries(F.array_compact(F.array(*[entry(k, v) for k, v in MEDIA_KINDS.items()])))


def request_key(method: Column, url: Column) -> Column:
    """First 16 digits of the SHA-256 of 'METHOD:url'."""
    return F.substring(F.sha2(F.concat(method, F.lit(":"), url), 256), 1, 16)


def content_hash(content: Column) -> Column:
    """First 16 digits of the SHA-256 of the content."""
    return F.substring(F.sha2(content, 256), 1, 16)


def extension(content_type: Column) -> Column:
    """File extension of a content type with or without parameters; '.bin' where nothing fits."""
    base = F.lower(F.trim(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1))))
    return F.coalesce(_lookup(EXTENSIONS)[base], F.when(base.contains("json"), ".json").when(base.contains("xml"), ".xml").when(base.contains("html"), ".html").otherwise(".bin"))


def url_host(url: Column) -> Column:
    """Host of a url with its port."""
    return _found(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)")


def bucket_and_key(url: Column) -> Column:
    """Struct of bucket and key of an object store's address, in path style or with the bucket in the host; null for others."""
    vb, vk = (_found(url, r"^https?://([^/.][^/]*?)\.s3[.-][^/]*/(.+)$", i) for i in (1, 2))
    pb, pk = (_found(url, r"^https?://s3[.-][^/]*/([^/]+)/(.+)$", i) for i in (1, 2))
    return F.when(pb.isNotNull(), F.struct(pb.alias("bucket"), pk.alias("key"))).when(vb.isNotNull(), F.struct(vb.alias("bucket"), vk.alias("key")))


def fetch_class(status: Column, error: Column, from_cache: Column, store: bool = False) -> Column:
    """cached, new, skipped (403, 404 or a name for these), transient (to be tried again) or failed."""
    again = [429, 502, 503, 504] + ([500] if store else [])
    gone = status.isin(403, 404) | error.rlike(GONE)
    return (F.when(F.coalesce(from_cache, F.lit(False)), "cached").when(status.between(200, 299), "new").when(F.coalesce(gone, F.lit(False)), "skipped")
            .when(status.isNull() | status.isin(again), "transient").otherwise("failed"))
