"""Raw lines: every reject reason, quoting, repair and round trips."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from threadpulse.functions.text import is_integer
from threadpulse.sources import files, ingest, views

SF_DIR = "/root/testdata/sf0.001"

GOOD = [
    "1514764860", "5a4980f57c459f246b63d649", "800", "41", "comment", "1514764800", "1", "False",
    "0", "", "12", "Opinion", "Ann", "77", "Oslo",
]


def line(**changed):
    from threadpulse.schema import WIRE_COLUMNS

    return ",".join(changed.get(c, v) for c, v in zip(WIRE_COLUMNS, GOOD, strict=True))


def parse(spark, *lines, **options):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(lines)], "n int, value string")
    return [r.asDict() for r in ingest.parse_lines(df.orderBy("n"), **options).collect()]


def test_clean_line(spark):
    (row,) = parse(spark, line())
    assert row["error"] is None
    assert row["comment_id"] == 41 and row["user_id"] == 77 and row["recommendations"] == 12
    assert row["editors_selection"] is False
    assert row["parent_user_display_name"] is None
    assert row["create_date"] == 1514764800 and row["user_location"] == "Oslo"


@pytest.mark.parametrize(
    "text, error",
    [
        (line(user_location="see https://a.b"), "http"),
        (line(section_name="http://a.b"), "http"),
        (",".join(GOOD[:9]), "invalid record"),
        (",".join(GOOD[:14]), "invalid record"),
        (line(user_display_name='"never closed'), "invalid record"),
        ("", "invalid record"),
        (line(approve_date="soon"), "approvedate"),
        (line(article_word_count="12.5"), "word count"),
        (line(comment_id="x"), "commentid"),
        (line(create_date=""), "createdate"),
        (line(depth=" 2"), "depth"),
        (line(in_reply_to="null"), "inreplyto"),
        (line(recommendations="3000000000"), "recs"),
        (line(user_id="anon"), "userid: anon"),
        (line(user_id=""), "userid: null"),
        (line(comment_id="x", depth="y"), "commentid"),
    ],
)
def test_reject_reasons(spark, text, error):
    (row,) = parse(spark, text)
    assert row["error"] == error
    assert row["value"] == text
    assert row["user_id"] == 0 and row["comment_id"] is None and row["editors_selection"] is None


@pytest.mark.parametrize(
    "text, column, value",
    [
        ("null," + line(), "comment_id", 41),
        (line(user_display_name='"Diaz, M."'), "user_display_name", "Diaz, M."),
        (line(user_display_name='"Kim, J., Jr."'), "user_display_name", "Kim, J., Jr."),
        (line(user_display_name='"Quoted"'), "user_display_name", "Quoted"),
        (line(user_display_name='"a ""b"", c"'), "user_display_name", 'a "b", c'),
        (line(user_display_name="", section_name="", user_location=""), "user_location", None),
        (line(parent_user_display_name='"Lee, Ann"'), "user_id", 77),
        (line(user_location='"Rome, IT"'), "user_location", "Rome - IT"),
        (line(user_location="Rome, IT, EU"), "user_location", "Rome"),
        (line(user_location=",x"), "user_location", None),
        (line(editors_selection="True"), "editors_selection", True),
        (line(editors_selection="maybe"), "editors_selection", True),
        (line(editors_selection=""), "editors_selection", True),
        (line(recommendations="+7"), "recommendations", 7),
        (line(user_id="0"), "user_id", 0),
    ],
)
def test_accepted_forms(spark, text, column, value):
    (row,) = parse(spark, text)
    assert row["error"] is None
    assert row[column] == value


def test_long_line_is_read_whole(spark):
    (row, odd) = parse(
        spark, line(user_display_name="x" * 300_000), line(user_location=",".join("y" * 30_000))
    )
    assert len(row["user_display_name"]) == 300_000
    assert odd["error"] is None and odd["user_location"] == "y"


def test_id_width(spark):
    wide = line(comment_id="3000000000")
    assert parse(spark, wide)[0]["comment_id"] == 3_000_000_000
    assert parse(spark, wide, id_type="int")[0]["error"] == "commentid"


def test_strict_mode_fails(spark):
    with pytest.raises(Exception, match="Invalid record"):
        parse(spark, "a,b,c", strict=True)
    assert parse(spark, line(depth="x"), strict=True)[0]["error"] == "depth"


def test_nothing_is_lost(spark):
    comments = views.load_comments(spark, SF_DIR)
    parsed = ingest.parse_lines(views.raw_lines(comments))
    good, bad = ingest.valid_comments(parsed).count(), ingest.rejected_lines(parsed).count()
    assert good + bad == comments.count() and good > bad > 0
    assert ingest.reject_counts(parsed).agg(F.sum("n")).first()[0] == bad


def test_clean_round_trip(spark):
    comments = views.load_comments(spark, SF_DIR)
    back = ingest.valid_comments(ingest.parse_lines(views.raw_lines(comments, defects=False)))
    columns = ["comment_id", "user_id", "depth", "in_reply_to", "recommendations", "editors_selection"]
    assert back.count() == comments.count()
    assert back.select(columns).exceptAll(comments.select(columns)).count() == 0


def repair(spark, text):
    return ingest.repair_lines(spark.createDataFrame([(text,)], "value string")).first()[0]


@pytest.mark.parametrize(
    "changed, want",
    [
        ({}, {"parent_user_display_name": "null"}),
        ({"comment_type": "userReply", "parent_user_display_name": "Bo"}, {}),
        (
            {"user_display_name": "Kim, J., Jr."},
            {"parent_user_display_name": "null", "user_display_name": "Kim J. Jr."},
        ),
        (
            {"user_location": "Rome, IT, EU"},
            {"parent_user_display_name": "null", "user_location": "Rome IT EU"},
        ),
        ({"user_display_name": "123"}, {"parent_user_display_name": "null"}),
        ({"user_display_name": ""}, {"parent_user_display_name": "null"}),
        ({"user_location": ""}, {"parent_user_display_name": "null"}),
    ],
)
def test_repair(spark, changed, want):
    assert repair(spark, line(**changed)) == line(**{**changed, **want})


def test_repair_without_user_id(spark):
    assert repair(spark, line(user_id="anon")) is None
    assert repair(spark, "a,b") is None


@pytest.mark.parametrize(
    "text, numeric",
    [("7", True), ("-7", True), ("+7", True), (" 7", False), ("7.5", False), ("", False),
     ("2147483647", True), ("2147483648", False), ("1e3", False), (None, False)],
)
def test_is_integer(spark, text, numeric):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(is_integer(F.col("t"))).first()[0] is numeric


def test_header_is_skipped(spark, tmp_path):
    header = "approveDate,articleID,articleWordCount,commentID"
    (tmp_path / "in.csv").write_text("\n".join([header, line(), line()]))
    assert files.read_lines(spark, str(tmp_path)).count() == 2
    assert files.read_lines(spark, str(tmp_path), header=False).count() == 3


def test_serialize_forms(spark):
    comments = views.load_comments(spark, SF_DIR).where("comment_id = 3")
    text = files.serialize(comments.drop("ts")).first()[0]
    assert text.startswith("Comment{articleID='") and "commentID=3" in text
    assert '"comment_id":3' in files.serialize(comments, "json").first()[0]


def test_lines_that_could_break_the_parser(spark):
    good = "1,aa,1,7,comment,1514764800,1,False,0,,4,S,na\u0003me,10,X"
    wide = good + ",x" * 2_000_100
    frame = spark.createDataFrame([(good,), (wide,), (None,)], "value string")
    got = ingest.parse_lines(frame).select("comment_id", "user_display_name", "error").collect()
    assert [tuple(r) for r in got] == [
        (7, "na\u0003me", None),
        (7, "na\u0003me", None),
        (None, None, "invalid record"),
    ]


@pytest.mark.parametrize("commas", [30, 1_000_100])
def test_commas_inside_quotes_have_no_limit(spark, commas):
    name = '"Lee' + "," * commas + ' ""Ann"" x"'
    good, shifted, bare, extra = parse(
        spark,
        line(user_display_name=name),
        "null," + line(parent_user_display_name=name, user_location='"Rome, IT"'),
        line(user_display_name=name.replace('"', "")),  # bare commas shift the columns behind them
        line() + "," * commas,
    )
    assert good["error"] is None and good["user_id"] == 77 and good["user_location"] == "Oslo"
    assert good["user_display_name"] == "Lee" + "," * commas + ' "Ann" x'
    assert shifted["error"] is None and shifted["user_location"] == "Rome - IT"
    assert len(shifted["parent_user_display_name"]) == commas + len('Lee "Ann" x')
    assert bare["error"] is not None
    assert extra["error"] is None and extra["user_location"] == "Oslo"
    (cut,) = parse(spark, line(user_display_name='"Lee' + "," * commas))
    assert cut["error"] == "invalid record"


def test_long_fields_and_few_columns(spark):
    short, long = parse(spark, ",".join(GOOD[:9]) + "y" * 1_200_000, line(section_name="s" * 1_200_000))
    assert short["error"] == "invalid record"
    assert long["error"] is None and len(long["section_name"]) == 1_200_000
