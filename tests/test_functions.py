"""Edge rows of the column functions."""

import datetime

from pyspark.sql import functions as F

from echotide import functions as fn

D = datetime.date


def test_trim_takes_any_white_space(values):
    assert values(fn.trim_all, [" a\t", "\xa0x　", "", None, "\x1cy\x1f"]) == [
        "a", "x", "", None, "y",
    ]


def test_clean_comes_after_trim(values):
    assert values(fn.clean_text, ["foo\nbar", "x \u0001", " a\x7fb "]) == ["foobar", "x ", "ab"]


def test_collapse(values):
    assert values(fn.collapse_ws, [" a \n\t b\xa0c ", "", None]) == ["a b c", "", None]


def test_deleted_markers_match_exactly(values):
    texts = ["[deleted]", "[removed]", "[deleted] ", "x"]
    assert values(fn.null_placeholders, texts) == ["", "", "[deleted] ", "x"]
    stripped = values(lambda c: fn.null_placeholders(fn.trim_all(c)), texts)
    assert stripped == ["", "", "", "x"]


def test_first_nonempty_and_first_present(spark):
    row = spark.range(1).select(
        fn.first_nonempty(F.lit(""), F.lit(None), F.lit("b")).alias("a"),
        fn.first_present(F.lit(None), F.lit(""), F.lit("b")).alias("b"),
        fn.first_nonempty(F.lit(None).cast("string")).alias("c"),
    ).first()
    assert tuple(row) == ("b", "", "")


def test_epoch_or_iso(values):
    texts = [
        "1700000000", "1700000000.7", "0", "-5", "abc", "2025-12-01T02:00:00+05:30",
        "2025-12-01T10:00:00Z", "inf", "1e30", "Tx", "", None, "1.0d",
    ]
    seconds = values(lambda c: F.unix_seconds(fn.parse_epoch_or_iso(c)), texts)
    assert seconds == [
        1700000000, 1700000000, 0, -5, None, 1764534600, 1764583200, None, None, None, None, None,
        None,
    ]
    assert values(fn.parse_epoch_or_iso, [1700000000], "bigint")[0].year == 2023


def test_formats_are_empty_up_to_the_epoch(values):
    texts = ["1700000000", "0", "-5", None]
    dmy = values(lambda c: fn.format_dmy(fn.parse_epoch_or_iso(c)), texts)
    assert dmy == ["14/11/2023", "", "", ""]
    iso = values(lambda c: fn.format_iso_utc(fn.parse_epoch_or_iso(c)), texts)
    assert iso == ["2023-11-14T22:13:20Z", "", "", ""]


def test_dates_of_all_shapes(values):
    texts = [
        "31/12/2025", "1/2/2025", "2025-12-01", "2025-12-01T02:00:00+05:30", "Dec 01, 2025",
        "Dec 1, 2025 · 3:45 PM UTC", "dec 1, 2025", "2025-02-30", "", None,
    ]
    first = D(2025, 12, 1)
    assert values(fn.parse_date_any, texts) == [
        D(2025, 12, 31), None, first, first, first, first, first, None, None, None,
    ]
    assert values(fn.parse_dmy, texts)[:4] == [D(2025, 12, 31), None, first, None]


def test_wall_date_is_not_shifted(values):
    assert values(fn.iso_wall_date, ["2025-12-01T02:00:00+05:30", "x"]) == [D(2025, 12, 1), None]
    assert values(fn.wall_dmy, ["2025-12-01T02:00:00+05:30", "yesterday, late", None]) == [
        "01/12/2025", "yesterday,", "",
    ]


def test_integers(values):
    texts = ["1,234", " 7 ", "12.5", "", None, "-3", "9999999999"]
    assert values(fn.safe_int, texts) == [1234, 7, 0, 0, 0, -3, 9999999999]


def test_stars_only_where_rated(spark):
    rows = spark.createDataFrame(
        [("5", "Google Play Store"), ("0", "Google Play Store"), ("6", "Apple App Store"),
         ("3", "Reddit"), ("", "Apple App Store"), ("4.5", "Apple App Store")],
        "s string, p string",
    )
    stars = rows.select(fn.star_rating(F.col("s"), F.col("p"))).collect()
    assert [r[0] for r in stars] == [5, None, None, None, None, None]


def test_division(spark):
    def ratio(n, d, *rest):
        return spark.range(1).select(fn.safe_divide(F.lit(n), F.lit(d), *rest)).first()[0]

    assert ratio(1, 0) is None
    assert ratio(1, 0, 0.0) == 0
    assert ratio(0, 5, 0.0) == 0
    # As a BI tool has it: a count over no rows is blank, blank over five is blank.
    assert ratio(0, 5, 0.0, True) is None
    assert ratio(0, 0, 0.0, True) == 0
    assert ratio(1, 4, 0.0, True) == 0.25
    assert spark.range(1).select(
        fn.safe_divide(F.lit(1), F.lit(None).cast("int"), 0.0)
    ).first()[0] == 0


def test_contains_ignores_case(values):
    assert values(lambda c: fn.contains_ci(c, "Acme Gold"), ["my ACME gold", "gold", None]) == [
        True, False, None,
    ]


def test_redirects(values):
    links = [
        "//s/l/?uddg=https%3A%2F%2Fa.com%2Fx%20y+z&rut=1", "http://a", "/x", "//x?uddg=https%3A%zz",
    ]
    assert values(fn.unwrap_redirect, links) == [
        "https://a.com/x y+z", "http://a", None, "https%3A%zz",
    ]
    kept = values(
        lambda c: fn.unwrap_redirect(c, ("https://quora.com", "https://www.quora.com")),
        ["https://www.quora.com/a", "https://fr.quora.com/a"],
    )
    assert kept == ["https://www.quora.com/a", None]


def test_entities_are_decoded_once(values):
    texts = ["a &amp;amp; b", "&lt;&#8364;&#x1F600;", "&bogus; &copy;&", "&#0; &#55296; &apos;"]
    assert values(fn.decode_entities, texts) == ["a &amp; b", "<€😀", "&bogus; ©&", "&#0; &#55296; '"]


def test_html_text(values):
    page = "<p>a <b>b</b>c</p><script>var x='</p>'</script><!-- z -->d &amp; e 1 < 2"
    assert values(fn.html_to_text, [page]) == ["a b c d & e 1 < 2"]
    assert values(lambda c: fn.html_to_text(c, ""), ["<p> a <b>b</b> c &nbsp;<i></i> d </p>"]) == [
        "abcd"
    ]


def test_html_text_survives_long_runs(values):
    page = "<i></i> \n" * 50_000 + "end"
    assert values(fn.html_to_text, [page]) == ["end"]


def test_titles(values):
    pages = [
        "<title>T</title><script>'<h1>x</h1>'</script><h1> A <b>B</b></h1>",
        "<title>T &amp; U</title>", "<h1></h1><title>T</title>", "<p>",
    ]
    assert values(fn.page_title, pages) == ["AB", "T & U", "", ""]
    assert values(fn.question_title, ['<span class="x Q_Text y">Q <b>r</b></span>', "<title>T"]) == [
        "Qr", "",
    ]


def test_script_values(values):
    pages = [
        "<script>var disqus_shortname = \"abc\"; this.page.identifier = 't-1';</script>",
        '<p>this.page.identifier="x"</p>',
    ]
    assert values(lambda c: fn.script_value(c, "disqus_shortname"), pages) == ["abc", None]
    assert values(lambda c: fn.script_value(c, "this.page.identifier"), pages) == ["t-1", None]


def test_masking(values):
    masked = values(lambda c: fn.mask_user(c, "salt"), ["ann", "ann", "bob", "", None])
    assert masked[0] == masked[1] != masked[2]
    assert len(masked[0]) == 64 and masked[3:] == ["", None]
