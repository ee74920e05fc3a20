"""X9 timestamps, X15-X17 labels and column names, X19 ids."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecensus.functions.scalars import parse_ts, partition_type_label, storage_mode_label, strip_bracket_name

UTC = dt.timezone.utc


def py_parse_ts(value):
    """The extractor's rule, restated: falsy -> None; strip; Z -> +00:00; ISO parse."""
    if not value:
        return None
    try:
        d = dt.datetime.fromisoformat(str(value).strip().replace("Z", "+00:00"))
    except ValueError:
        return None
    return d.astimezone(UTC).replace(tzinfo=None) if d.tzinfo else d


def test_parse_ts_cases(spark):
    cases = ["2024-01-02T03:04:05Z", "2024-01-02T05:04:05+02:00", "2024-01-02T03:04:05", "2024-01-02",
             "2024-01-02T03:04:05.1234567Z", "  2024-01-02T03:04:05Z  ", "2024-01-02 03:04:05.5",
             "junk", "", None, "2024-01-02T03:04:05ZZ"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r[0] for r in df.select(parse_ts(F.col("s")).cast("timestamp_ntz")).collect()]
    for c, g in zip(cases, got):
        assert g == py_parse_ts(c), c


def odd_forms(r):
    """A text near the grammar of timestamps: any date and time build, separators, offsets, slips."""
    year = r.choice(["2024", "2020", "0001", "9999", "0000", "1969", "2015", "2026"])
    date = r.choice([
        f"{year}-{r.randint(0, 13):02}-{r.randint(0, 32):02}", f"{year}{r.randint(1, 12):02}{r.randint(1, 31):02}",
        f"{year}-W{r.randint(0, 54):02}", f"{year}W{r.randint(0, 54):02}",
        f"{year}-W{r.randint(1, 53):02}-{r.randint(0, 9)}", f"{year}W{r.randint(1, 53):02}{r.randint(0, 9)}"])

    def clock(hours=24):
        h, m, s = r.randint(0, hours), r.randint(0, 60), r.randint(0, 60)
        if r.random() < 0.7:
            h, m, s = h % 24, m % 60, s % 60
        return r.choice([f"{h:02}", f"{h:02}:{m:02}", f"{h:02}{m:02}", f"{h:02}:{m:02}:{s:02}", f"{h:02}{m:02}{s:02}", f"{h:02}:{m:02}{s:02}"])

    def fraction():
        return r.choice(["", "", r.choice([".", ",", ":", ""]) + "".join(r.choice("0123456789") for _ in range(r.randint(0, 9)))])

    time = clock() + fraction() + r.choice(["", "", "", r.choice([" ", "x", ":", ".", "  ", "5", "é", "xyz"])]) if r.random() < 0.85 else ""
    offset = r.choice(["", "", "Z", "+00:00", r.choice("+-") + clock(25) + fraction() + r.choice(["", "", "", ":", " "])])
    separator = r.choice(["T", " ", "T", " ", "x", "-", "+", "1", "", "\n", "é", "😀", "TT", ":"])
    if not time and r.random() < 0.7:
        separator, offset = "", ""
    pads = ["", "", "", "\t", "\n", " ", "\x85", "\u2003", "\x1c", "\u200b"]
    text = r.choice(pads) + date + separator + time + offset + r.choice(pads)
    if r.random() < 0.1:
        at = r.randrange(len(text))
        text = text[:at] + r.choice(["", "x", "-", ":", "1", "W"]) + text[at + 1:]
    return text


def test_parse_ts_takes_the_whole_grammar(spark):
    import random

    r = random.Random(20)
    values = [odd_forms(r) for _ in range(20000)] + ["2024", "2024-1-2", "20240102T030405", "2024-W01-1", "2024-01-02T03:04 +01:00",
                                                     "2024-01-02T03:04:05,123", "2024-01-02T03", "2024-01-02T03:04:05+00:00:00"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, s string").repartition(8)
    got = dict(df.select("i", F.unix_micros(parse_ts(F.col("s")))).collect())
    valid = 0
    for i, v in enumerate(values):
        try:
            want = py_parse_ts(v)
        except OverflowError:  # moved out of the years 1 to 9999 by its offset
            continue
        valid += want is not None
        want = None if want is None else (want - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert got[i] == want, v
    assert valid > 4000


def py_strip(key):
    clean = key.strip()
    if clean.startswith("["):
        clean = clean[1:]
    if clean.endswith("]"):
        clean = clean[:-1]
    return clean.split("].[")[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="[]. abT\t\n\x0b\x1c\x85\xa0\u2003\u200b", max_size=12), min_size=1, max_size=8))
def test_strip_bracket_name_property(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(strip_bracket_name(F.col("k"))).collect()]
    assert got == [py_strip(k) for k in keys]


def test_strip_bracket_examples(spark):
    keys = ["[C]", "[T].[C]", "C", " [Partition].[QueryDefinition] "]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r[0] for r in df.select(strip_bracket_name(F.col("k"))).collect()] == ["C", "C", "C", "QueryDefinition"]


def test_labels(spark):
    df = spark.range(-1, 9).select(F.col("id").cast("int").alias("c"))
    rows = df.select(partition_type_label(F.col("c")), storage_mode_label(F.col("c"))).collect()
    assert [r[0] for r in rows] == ["Unknown", "Unknown", "Data", "M", "DAX", "SQL", "Unknown", "Unknown", "Historical", "Unknown"]
    assert [r[1] for r in rows][:7] == ["Unknown", "Import", "DirectQuery", "Default", "Push", "Streaming", "PushStreaming"]


@st.composite
def iso_strings(draw):
    d = draw(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2200, 12, 31)))
    s = d.isoformat()
    if draw(st.booleans()):
        t = draw(st.times())
        s += draw(st.sampled_from(["T", " "])) + f"{t.hour:02d}:{t.minute:02d}"
        if draw(st.booleans()):
            s += f":{t.second:02d}"
            digits = draw(st.integers(min_value=0, max_value=7))
            if digits:
                s += "." + f"{t.microsecond:06d}{draw(st.integers(0, 9))}"[:digits]
        zone = draw(st.sampled_from(["", "Z", "+00:00", "+02:00", "-05:30", "+14:00"]))
        s += zone
    pad = draw(st.sampled_from(["", " ", "  "]))
    return pad + s + pad


@settings(max_examples=80, deadline=None)
@given(st.lists(iso_strings(), min_size=1, max_size=10))
def test_parse_ts_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(parse_ts(F.col("s")).cast("timestamp_ntz")).collect()]
    assert got == [py_parse_ts(v) for v in values]
