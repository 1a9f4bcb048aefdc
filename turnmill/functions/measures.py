"""Column functions on durations, rates, counts and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------------------------------------------
#: Upper bounds in minutes, and their labels; above them '100h+'.
SPOKEN_BUCKETS = ((1, "<1m"), (5, "1-5m"), (15, "5-15m"), (30, "15-30m"), (60, "30-60m"), (120, "1-2h"), (300, "2-5h"), (600, "5-10h"), (3000, "10-50h"), (6000, "50-100h"))
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")
#: Seconds from and up to which a segment belongs to a split.
DURATION_SPLITS = (("lt1m", 0, 60), ("lt5m", 60, 300), ("lt30m", 300, 1800))
#: Words per minute outside of which speech is abnormal, and seconds up to which it isn't judged.
SLOWEST, FASTEST, JUDGED_FROM = 30, 600, 10
#: Seconds that two turns can overlap, seconds that times may disagree, and share of a recording that a turn can fill.
OVERLAP, DRIFT, LARGEST_SHARE = 3, 1, 0.5
# --------------------------------------------------------------------------------------------------------------------


def recordings_bucket(n: Column) -> Column:
    """1, 2, 3-5 (0 too), 6-10 or 11+."""
    return F.when(n == 1, "1").when(n == 2, "2").when(n <= 5, "3-5").when(n <= 10, "6-10").when(n.isNotNull(), "11+")


def spoken_bucket(seconds: Column) -> Column:
    """Class of time spoken."""
    c = None
    for limit, label in SPOKEN_BUCKETS:
        c = F.when(seconds / 60 < limit, label) if c is None else c.when(seconds / 60 < limit, label)
    return c.when(seconds.isNotNull(), "100h+")


def duration_split(seconds: Column) -> Column:
    """Split of a duration, null beyond the last; a null duration counts as 0."""
    d = F.coalesce(seconds, F.lit(0.0))
    c = None
    for name, lo, hi in DURATION_SPLITS:
        hit = (d >= lo) & (d < hi)
        c = F.when(hit, name) if c is None else c.when(hit, name)
    return c


def words_per_minute(words: Column, seconds: Column) -> Column:
    """0 where the duration is not positive."""
    return F.when(seconds <= 0, F.lit(0.0)).otherwise(words / (seconds / 60.0))


def word_count(text: Column) -> Column:
    """Words between white space of any kind; 0 for null."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != ""))


def human_size(n: Column) -> Column:
    """A number of bytes in steps of 1024 with one decimal."""
    c = None
    for i, unit in enumerate(SIZE_UNITS):
        last = i == len(SIZE_UNITS) - 1
        x = F.concat(F.format_string("%.1f", n / float(1024**i)), F.lit(f" {unit}"))
        hit = F.lit(True) if last else n < float(1024 ** (i + 1))
        c = F.when(hit, x) if c is None else c.when(hit, x)
    return F.when(n.isNotNull(), c)


def hours(seconds: Column) -> Column:
    """Hours with a thousands separator and one decimal."""
    return F.format_number(seconds / 3600, 1)


def hms(seconds: Column) -> Column:
    """Hours, minutes and seconds in words of one letter."""
    s = F.floor(seconds).cast("long")
    return F.concat((s / 3600).cast("long").cast("string"), F.lit("h "), ((s % 3600) / 60).cast("long").cast("string"), F.lit("m "), (s % 60).cast("string"), F.lit("s"))


def turn_problem(duration: Column, text: Column, words: Column, overlap: Column) -> Column:
    """The first of: invalid_duration, empty_text, wpm_too_low, wpm_too_high (both only for more than ten seconds), overlap; null for none."""
    rate = words_per_minute(words, duration)
    long = duration > JUDGED_FROM
    return (F.when(F.coalesce(duration, F.lit(0.0)) <= 0, "invalid_duration")
            .when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty_text")
            .when(long & (rate < SLOWEST), "wpm_too_low").when(long & (rate > FASTEST), "wpm_too_high")
            .when(overlap > OVERLAP, "overlap"))


def turn_problem_text(problem: Column, duration: Column, words: Column, overlap: Column) -> Column:
    """The problem with its figure, as it is written into records."""
    rate = words_per_minute(words, duration)
    return (F.when(problem.isin("wpm_too_low", "wpm_too_high"), F.concat(problem, F.lit(":"), F.format_string("%.1f", rate)))
            .when(problem == "overlap", F.concat(problem, F.lit(":"), F.format_string("%.1fs", overlap))).otherwise(problem))


def scaled_samples(samples: Column, bits: int) -> Column:
    """Integer samples as fractions of full scale."""
    return F.transform(samples, lambda x: (x / float(1 << (bits - 1))).cast("float"))


def segment(samples: Column, rate: Column, start: Column, stop: Column) -> Column:
    """Samples from start to stop seconds, cut down to whole samples and to what is there; null where nothing is asked for or start is not before stop."""
    a = F.greatest(F.lit(0), F.floor(start * rate)).cast("int")
    b = F.least(F.size(samples), F.floor(stop * rate)).cast("int")
    return F.when((start < stop) & (b > a), F.slice(samples, a + 1, b - a))


def segment_rounded(samples: Column, rate: Column, start: Column, stop: Column) -> Column:
    """As ``segment``, with boundaries at the nearest sample (half to even)."""
    a = F.greatest(F.lit(0), F.bround(start * rate).cast("int"))
    b = F.least(F.size(samples), F.bround(stop * rate).cast("int"))
    return F.when((start < stop) & (b > a), F.slice(samples, a + 1, b - a))


def strict_segment(samples: Column, rate: Column, start: Column, stop: Column) -> Column:
    """As ``segment``, but an error where start is not before stop or stop is beyond the samples."""
    bad = (start >= stop) | (stop * rate > F.size(samples) + 1)
    return F.when(bad, F.raise_error(F.lit("segment outside of the recording")).cast("array<float>")).otherwise(segment(samples, rate, start, stop))


def frame_energies(samples: Column, frame: int) -> Column:
    """Root mean square of every whole frame; all samples are one frame where there are fewer."""
    n = F.size(samples)
    rms = lambda part: F.sqrt(F.aggregate(part, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / F.size(part))
    many = F.transform(F.sequence(F.lit(0), F.floor(n / frame).cast("int") - 1), lambda i: rms(F.slice(samples, i * frame + 1, frame)))
    return F.when(n >= frame, many).when(n > 0, F.array(rms(samples)))


def mean_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)


def variation(energies: Column) -> Column:
    """Population standard deviation over mean; 0 where the mean is below a millionth."""
    m = mean_of(energies)
    sd = F.sqrt(F.aggregate(energies, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)) / F.size(energies))
    return F.when(m < 1e-6, F.lit(0.0)).otherwise(sd / m)


def audio_problem(samples: Column, energies: Column) -> Column:
    """silent, constant_noise (variation below a quarter) or null; no samples are silent."""
    total = F.sqrt(F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / F.size(samples))
    return F.when(F.coalesce(F.size(samples) <= 0, F.lit(True)) | (total < 1e-6), "silent").when(variation(energies) < 0.25, "constant_noise")
