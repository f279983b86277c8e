from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casemill.functions import dates, flags, numbers, text

SLOW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
LATIN = st.text(
    alphabet=st.one_of(
        st.characters(min_codepoint=32, max_codepoint=126),
        st.sampled_from("áéíóúñüçÁÉÍÓÚÑÜÇàèìòùâêîôûäëïöÿ\n\t\xa0"),
    ),
    max_size=30,
)


def test_normalize_text(values):
    got = values(text.normalize_text, ["  JÓSE Núñez  ", None, "", "Straße", "\tÆsir œuvre\n", "ñ"])
    assert got == ["jose nunez", "", "", "strasse", "aesir oeuvre", "n"]


def test_normalize_keeps_null_apart(values):
    assert values(text.normalize_or_null, [None, " Á "]) == [None, "a"]


def test_loose_marks_go_away(values):
    assert values(text.strip_accents, ["José", "“x” – y"]) == ["Jose", '"x" - y']


def test_trim_lower_keeps_accents(values):
    assert values(text.trim_lower, ["  ÁB\xa0\n", None]) == ["áb", None]


@SLOW
@given(st.lists(LATIN, min_size=20, max_size=60))
def test_title_case_is_pythons(values, words):
    assert values(text.title_case, words) == [w.title() for w in words]


@SLOW
@given(st.lists(LATIN, min_size=20, max_size=60))
def test_strip_is_pythons(values, words):
    assert values(text.strip, words) == [w.strip() for w in words]


def expected_order(name, kept):
    parts = name.split()
    if len(parts) == 6:
        return " ".join(parts[4:] + parts[:4])
    if len(parts) > 2 and name.lower() not in kept:
        return " ".join(parts[2:] + parts[:2])
    return " ".join(reversed(parts)) if len(parts) == 2 else name


def test_reorder_name(values):
    kept = ["uno dos tres cuatro", "a b"]
    names = [
        "x", " x ", "", "uno dos", "uno  dos ", "uno dos tres", "Uno Dos Tres Cuatro",
        "uno dos tres cuatro cinco", "uno dos tres cuatro cinco seis", "1 2 3 4 5 6 7",
        "a b", "ancho de espacio", "no\xa0break here",
    ]
    got = values(lambda c: text.reorder_name(c, kept), [*names, None])
    assert got == [*(expected_order(n, kept) for n in names), None]


def test_segments(values):
    assert values(text.account_of, ["APEREZ@corp@x", "plain", "", None]) == ["APEREZ", "plain", "", None]
    assert values(text.top_service, ["DEV > Apps > X", "a>b", None]) == ["DEV", "a>b", None]
    assert values(text.last_line, ["a\nDíaz Luz", "x", "x\n", None]) == ["Díaz Luz", "x", "", None]


def test_remove_literal_anywhere(values):
    got = values(lambda c: text.remove_literal(c, "SO-", " "), ["SO-77", "x SO- 1", None])
    assert got == ["77", "x1", None]


def test_remap_is_one_pass(values):
    assert values(lambda c: text.remap(c, {"a": "b", "b": "a"}), ["a", "b", "c", None]) == ["b", "a", "c", None]


def test_only_digits(values):
    got = values(text.only_digits, ["123", " 123 ", "٣", "12a", "", None, "1.0"])
    assert got == [True, True, True, False, False, False, False]


def test_parse_date(values):
    got = values(
        dates.parse_date,
        [
            "3/5/2026 9:14:30 AM", "4/6/2026 17:00:03", "2026-03-05 09:14:30", "25/12/2026 08:00:00",
            "not a date", None, "2026-03-05T09:14:30", "2026-03-05", "2/30/2026 10:00:00", "",
            "12/1/2026 12:00:00 pm", "2026-13-01 00:00:00", "0/1/2026 1:00:00", "3/5/2026 13:00:00 AM",
        ],
    )
    assert got == [
        datetime(2026, 3, 5, 9, 14, 30), datetime(2026, 4, 6, 17, 0, 3), datetime(2026, 3, 5, 9, 14, 30),
        datetime(2026, 12, 25, 8), None, None, None, None, None, None, datetime(2026, 12, 1, 12), None,
        None, None,
    ]


def test_date_columns_are_checked(rows):
    df = rows("t string, n int", ("x", 1))
    with pytest.raises(ValueError, match="not found"):
        dates.add_date_parts(df, "absent")
    with pytest.raises(ValueError, match="must be a date"):
        dates.add_elapsed(df, "t", "t")


def test_elapsed_and_slack(rows):
    df = rows(
        "a timestamp_ntz, b timestamp_ntz",
        (datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 30, 30, 500000)),
        (datetime(2026, 1, 1), None),
    )
    out = dates.add_slack(dates.add_elapsed(df, "a", "b", "e"), "a", "b", "s").collect()
    assert [(r.e, r.s) for r in out] == [(30 + 30.5 / 60, -(30 + 30.5 / 60)), (None, None)]


def test_durations(values):
    got = values(
        numbers.parse_duration,
        ["5 horas 30 minutos", "3 horas", "45 minutos", "1 hora 15 minutos", "2 HORAS 10 min", "", None],
    )
    assert got == [330, 180, 45, 75, 130, 0, None]


def test_integers(values):
    got = values(
        numbers.to_integer,
        ["12", " 12 ", "12.0", "12.7", "1e3", "x", None, "9007199254740993", "99999999999999999999", "12d", "-5"],
    )
    assert got == [12, 12, 12, None, 1000, None, None, 9007199254740993, None, None, -5]


def test_whole_minutes(values):
    assert values(numbers.whole_minutes, ["12.9", "-12.9", "x", None, "1e400"]) == [12, -12, 0, 0, 0]
    assert values(numbers.whole_number, [12.9, None, float("nan")], "double") == [12, 0, 0]


def test_flags(values):
    words = ["Cumple", "No cumple", "SI", "NO", "Otro", None]
    assert values(flags.sla_word, words) == ["SI", "NO", "SI", "NO", "Otro", None]
    swapped = values(lambda c: flags.sla_word(c, invert=True), words)
    assert swapped == ["NO", "SI", "NO", "SI", "Otro", None]
    assert values(flags.in_time, [5.0, -5.0, 0.0, None], "double") == ["SI", "NO", "NO", "NO"]
    assert values(flags.ahead_of_estimate, [-5.0, 5.0, None], "double") == ["SI", "NO", "NO"]


def test_flag_columns(rows):
    df = rows("x string", ("a",))
    assert flags.normalize_sla(df) is df
    assert flags.fill_defaults(df, {"absent": "y"}) is df
    with pytest.raises(ValueError):
        flags.add_in_time(df, "absent")


def test_fill_by_category_is_ordered(rows):
    df = rows("u string, s string", (None, "FARM BANK"), (None, "BANK"), ("x", "FARM"), (None, None))
    rules = [("FARM", "first"), ("BANK", "second")]
    out = df.select(flags.fill_by_category(F.col("u"), F.col("s"), rules).alias("u")).collect()
    assert [r.u for r in out] == ["first", "second", "x", None]


def test_other_formats(values):
    got = values(lambda c: dates.parse_date(c, ["yyyyMMdd"]), ["20260305", "2026-03-05 00:00:00", None])
    assert got == [datetime(2026, 3, 5), None, None]


def test_dates_at_the_edges(values):
    texts = ["2026-3-5 9:1:3", "2026-01-01 24:00:00", "2026-01-01 10:00:60", "2024-02-29 0:0:0", "2025-02-29 0:0:0", " 2026-01-01 10:00:00"]
    assert values(dates.parse_date, texts) == [datetime(2026, 3, 5, 9, 1, 3), None, None, datetime(2024, 2, 29), None, None]


def test_compatibility_forms_become_ascii(values):
    from casemill.functions.text import normalize_text

    got = values(normalize_text, ["ﬁn № ™ １２ Ａｂ", "x²", "λόγος Жук"])
    assert got == ["fin no tm 12 ab", "x2", "λόγος жук"]
