"""ANSI SQL that gives the expected result of each catalogue query.

Raw lines are not parsed here: the SQL states what ingest must find, from the
event columns and the defect each line was given.
"""

from __future__ import annotations

COMMENTS = """
comments AS (
  SELECT event_id AS comment_id, user_id, ts, epoch_us(ts) // 1000 AS ts_ms,
    regexp_extract(props, '[0-9]+', 0) AS article_id,
    CASE event_type WHEN 'purchase' THEN 'userReply' WHEN 'error' THEN 'reporterReply'
      ELSE 'comment' END AS comment_type,
    CAST(event_id % 3 + 1 AS INT) AS depth,
    CASE WHEN event_id % 3 = 0 THEN 0
         WHEN event_id % 11 = 0 THEN -1
         WHEN event_id % 3 = 2 AND event_id % 5 = 0 THEN event_id - 2
         ELSE event_id - 1 END AS in_reply_to,
    CAST(floor(value) AS INT) AS recommendations,
    event_type = 'purchase' AS editors_selection
  FROM events),
valid AS (SELECT * FROM comments WHERE user_id <> 0),
direct AS (
  SELECT *, CAST(extract(hour FROM ts) // 2 + 1 AS BIGINT) AS slot
  FROM valid WHERE contains(comment_type, 'comment'))"""

THREADS = """
links1 AS (
  SELECT comment_id, arg_max(user_id, ts) AS user_id FROM valid WHERE depth = 1 GROUP BY comment_id),
links2 AS (
  SELECT c.comment_id, c.user_id, p.user_id AS root_user, c.ts_ms
  FROM valid c JOIN links1 p ON c.in_reply_to = p.comment_id WHERE c.depth = 2),
under_replies AS (
  SELECT c.ts_ms, p.user_id AS mid_user, p.root_user
  FROM valid c JOIN links2 p ON c.in_reply_to = p.comment_id WHERE c.depth = 3),
under_roots AS (
  SELECT c.ts_ms, p.user_id AS author
  FROM valid c JOIN links1 p ON c.in_reply_to = p.comment_id WHERE c.depth = 3),
likes AS (
  SELECT ts_ms, user_id AS author, 0 AS level,
    recommendations::BIGINT * CASE WHEN editors_selection THEN 33 ELSE 30 END AS cents
  FROM valid WHERE depth = 1),
replies AS (
  SELECT ts_ms, root_user AS author, 1 AS level, 70 AS cents FROM links2
  UNION ALL SELECT ts_ms, mid_user, 2, 70 FROM under_replies
  UNION ALL SELECT ts_ms, root_user, 2, 70 FROM under_replies
  UNION ALL SELECT ts_ms, author, 2, 70 FROM under_roots),
credits AS (SELECT * FROM likes UNION ALL SELECT * FROM replies)"""

# Defect of each raw line, and the values of its text columns.
LINES = """
lines AS (
  SELECT *, comment_id % 29 AS defect, ts_ms // 1000 AS created,
    CASE WHEN depth = 1 THEN NULL WHEN comment_id % 4 = 0 THEN 'Lee, Ann'
      ELSE 'reader' || in_reply_to END AS parent_name,
    CASE comment_id % 3 WHEN 0 THEN 'Opinion' WHEN 1 THEN 'World' END AS section,
    CASE comment_id % 5 WHEN 0 THEN 'Diaz, M.' WHEN 1 THEN 'Kim, J., Jr.' WHEN 2 THEN 'Quoted'
      ELSE 'user' || user_id END AS user_name,
    CASE comment_id % 4 WHEN 0 THEN 'Rome - IT' WHEN 1 THEN 'Oslo' WHEN 3 THEN 'Paris - FR'
      END AS place
  FROM comments),
ingested AS (
  SELECT *, CASE defect WHEN 0 THEN 'http' WHEN 1 THEN 'invalid record' WHEN 3 THEN 'word count'
      WHEN 4 THEN 'commentid' WHEN 5 THEN 'createdate' WHEN 6 THEN 'depth' WHEN 7 THEN 'inreplyto'
      WHEN 8 THEN 'recs' WHEN 9 THEN 'userid: anon' WHEN 11 THEN 'invalid record'
      WHEN 12 THEN 'approvedate' END AS error,
    CASE WHEN defect = 10 THEN 'Rome' ELSE place END AS location
  FROM lines)"""

_HOUR_MS = 3_600_000
_DAY_MS = 24 * _HOUR_MS
_ORIGIN_MS = 1514761200000


def _with(body: str, *parts: str) -> str:
    return f"WITH {', '.join([COMMENTS, *parts])}\n{body}"


def _start(length_ms: int, origin_ms: int = 0) -> str:
    """Window start of ``ts_ms``; floors also before the origin."""
    shift = f"(ts_ms - {origin_ms})"
    return f"(ts_ms - (({shift} % {length_ms} + {length_ms}) % {length_ms}))"


def _article_counts(length_ms: int) -> str:
    return f"""SELECT {_start(length_ms)} AS win_start_ms, article_id, count(*) AS n
      FROM valid GROUP BY 1, 2"""


def _user_scores(length_ms: int) -> str:
    return f"""SELECT {_start(length_ms)} AS win_start_ms, author, CAST(sum(cents) AS BIGINT) AS cents
      FROM credits GROUP BY 1, 2"""


def _top(inner: str, k: int, value: str, key: str) -> str:
    return f"""SELECT * FROM (
      SELECT win_start_ms,
        row_number() OVER (PARTITION BY win_start_ms ORDER BY {value} DESC, {key}) AS rk,
        {key}, {value}
      FROM ({inner})) WHERE rk <= {k}"""


def _slots(length_ms: int, origin_ms: int = 0) -> str:
    cells = ", ".join(f"count(*) FILTER (slot = {i}) AS s{i:02d}" for i in range(1, 13))
    return f"SELECT {_start(length_ms, origin_ms)} AS win_start_ms, {cells} FROM direct GROUP BY 1"


def _lines(inner: str, key: str, value: str) -> str:
    return f"""SELECT win_start_ms,
      win_start_ms || ', ' || string_agg({key} || ', ' || {value}, ', ' ORDER BY rk) AS line
      FROM ({inner}) GROUP BY win_start_ms"""


def _gap(partition: str) -> str:
    over = f"OVER ({partition} ORDER BY ts, comment_id)"
    return f"(epoch_us(ts) - lag(epoch_us(ts)) {over}) / 1000000 AS gap_seconds"


def _debug(label: str, value: str, quoted: bool = False) -> str:
    mark = "''" if quoted else ""
    return f"'{label}={mark}' || coalesce(CAST({value} AS VARCHAR), 'null') || '{mark}'"


def _serialize() -> str:
    def ok(value: str) -> str:
        return f"CASE WHEN error IS NULL THEN {value} END"

    parts = [
        _debug("approveDate", ok("created + 60")),
        _debug("articleID", ok("substr(md5(article_id), 1, 24)"), True),
        _debug("articleWordCount", ok("comment_id % 2000")),
        _debug("commentID", ok("comment_id")),
        _debug("commentType", ok("comment_type"), True),
        _debug("createDate", ok("created")),
        _debug("depth", ok("depth")),
        _debug("editorsSelection", ok("editors_selection")),
        _debug("inReplyTo", ok("in_reply_to")),
        _debug("parentUserDisplayName", ok("parent_name"), True),
        _debug("recommendations", ok("recommendations")),
        _debug("sectionName", ok("section"), True),
        _debug("userDisplayName", ok("user_name"), True),
        _debug("userID", "CASE WHEN error IS NULL THEN user_id ELSE 0 END"),
        _debug("userLocation", ok("location"), True),
        _debug("ERROR", "error", True),
    ]
    joined = " || ', ' || ".join(parts)
    return f"SELECT 'Comment{{' || {joined} || '}}' AS value FROM ingested"


_INGEST_VALID = """
SELECT created + 60 AS approve_date, substr(md5(article_id), 1, 24) AS article_id,
  comment_id % 2000 AS article_word_count, comment_id, comment_type, created AS create_date,
  depth::BIGINT AS depth, editors_selection, in_reply_to,
  parent_name AS parent_user_display_name, recommendations::BIGINT AS recommendations,
  section AS section_name, user_name AS user_display_name, user_id,
  location AS user_location, created * 1000 AS ts_ms
FROM ingested WHERE error IS NULL"""

_CSV_REPAIR = """
SELECT comment_id, CASE WHEN comment_id % 37 <> 0 THEN concat_ws(',', created + 60,
  substr(md5(article_id), 1, 24), comment_id % 2000, comment_id, comment_type, created, depth,
  CASE WHEN editors_selection THEN 'True' ELSE 'False' END, in_reply_to,
  CASE WHEN comment_type = 'comment' THEN 'null' ELSE 'someone' END, recommendations,
  coalesce(section, ''),
  CASE comment_id % 4 WHEN 0 THEN 'Diaz' WHEN 1 THEN 'Kim J.' WHEN 2 THEN 'Roe P. Jr.' ELSE 'user 7' END,
  user_id,
  CASE comment_id % 3 WHEN 0 THEN 'Oslo' WHEN 1 THEN 'Rome IT' ELSE 'Paris IDF FR' END) END AS line
FROM lines"""

# Piece counts of each raw line follow from its commas; a piece is an integer
# where the field is one and the line was not shifted or cut before it.
_IS_NUMERIC = """
SELECT pos, count(*) FILTER (regexp_full_match(piece, '[+-]?[0-9]+')
    AND TRY_CAST(piece AS INT) IS NOT NULL) AS n_integer, count(*) AS n
FROM (
  SELECT unnest(pieces) AS piece, CAST(generate_subscripts(pieces, 1) - 1 AS BIGINT) AS pos
  FROM (
    SELECT string_split(CASE WHEN defect = 2 THEN 'null,' ELSE '' END || array_to_string(
      CASE defect WHEN 1 THEN f[1:9] WHEN 11 THEN f[1:14] ELSE f END, ','), ',') AS pieces
    FROM (
      SELECT defect, [
        CASE defect WHEN 12 THEN 'soon' ELSE CAST(created + 60 AS VARCHAR) END,
        substr(md5(article_id), 1, 24),
        CASE defect WHEN 3 THEN 'n/a' ELSE CAST(comment_id % 2000 AS VARCHAR) END,
        CASE defect WHEN 4 THEN 'x12' ELSE CAST(comment_id AS VARCHAR) END,
        comment_type,
        CASE defect WHEN 5 THEN '12.5' ELSE CAST(created AS VARCHAR) END,
        CASE defect WHEN 6 THEN ' 2' ELSE CAST(depth AS VARCHAR) END,
        CASE WHEN editors_selection THEN 'True' ELSE 'False' END,
        CASE defect WHEN 7 THEN '' ELSE CAST(in_reply_to AS VARCHAR) END,
        CASE WHEN parent_name LIKE '%,%' THEN '"' || parent_name || '"' ELSE coalesce(parent_name, '') END,
        CASE defect WHEN 8 THEN '3000000000' ELSE CAST(recommendations AS VARCHAR) END,
        coalesce(section, ''),
        CASE WHEN comment_id % 5 < 3 THEN '"' || user_name || '"' ELSE user_name END,
        CASE defect WHEN 9 THEN 'anon' ELSE CAST(user_id AS VARCHAR) END,
        CASE WHEN defect = 0 THEN 'https://example.com/me' WHEN defect = 10 THEN 'Rome, IT'
          WHEN comment_id % 4 = 0 THEN '"Rome, IT"' WHEN comment_id % 4 = 3 THEN '"Paris,FR"'
          ELSE coalesce(place, '') END
      ] AS f
      FROM lines)))
GROUP BY pos"""


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    hours = {"hour": 1, "day": 24, "week": 168, "month": 720}

    for name in ("hour", "day", "week"):
        inner = _article_counts(hours[name] * _HOUR_MS)
        out[f"article_counts_{name}"] = _with(inner)
        out[f"top3_articles_{name}"] = _with(_top(inner, 3, "n", "article_id"))

    for name, days in (("day", 1), ("week", 7), ("month", 31)):
        out[f"slots_{name}_origin"] = _with(_slots(days * _DAY_MS, _ORIGIN_MS))
    out["slots_day_epoch"] = _with(_slots(_DAY_MS))
    out["slot_counts_day"] = _with(
        f"SELECT {_start(_DAY_MS)} AS win_start_ms, slot, count(*) AS n FROM direct GROUP BY 1, 2"
    )
    out["slot_first_last"] = _with(
        f"""SELECT {_start(_DAY_MS)} AS win_start_ms, slot, count(*) AS n, min(ts_ms) AS first_ms,
          extract(dow FROM min(ts)) AS first_weekday,
          arg_max(comment_type, (ts, comment_type)) AS last_type
        FROM direct GROUP BY 1, 2"""
    )

    for name in ("day", "week", "month"):
        inner = _user_scores(hours[name] * _HOUR_MS)
        out[f"user_score_{name}"] = _with(inner, THREADS)
        out[f"top10_users_{name}"] = _with(_top(inner, 10, "cents", "author"), THREADS)
    out["like_score"] = _with(
        f"""SELECT {_start(_DAY_MS)} AS win_start_ms, author, CAST(sum(cents) AS BIGINT) AS cents
        FROM likes GROUP BY 1, 2""",
        THREADS,
    )
    out["reply_score_by_level"] = _with(
        f"""SELECT {_start(_DAY_MS)} AS win_start_ms, CAST(level AS BIGINT) AS level, author,
          CAST(sum(cents) AS BIGINT) AS cents
        FROM replies GROUP BY 1, 2, 3""",
        THREADS,
    )

    out["reply_links"] = _with("SELECT comment_id, user_id, root_user FROM links2", THREADS)
    out["reply_credits_l2"] = _with(
        """SELECT ts_ms, mid_user AS author, CAST(70 AS BIGINT) AS cents FROM under_replies
        UNION ALL SELECT ts_ms, root_user, CAST(70 AS BIGINT) FROM under_replies""",
        THREADS,
    )
    out["reply_credits_l1"] = _with(
        "SELECT ts_ms, author, CAST(70 AS BIGINT) AS cents FROM under_roots", THREADS
    )
    out["orphan_replies"] = _with(
        """SELECT comment_id, CAST(depth AS BIGINT) AS depth, in_reply_to FROM valid c
        WHERE (depth = 2 AND NOT EXISTS (SELECT 1 FROM links1 l WHERE l.comment_id = c.in_reply_to))
          OR (depth = 3 AND NOT EXISTS (SELECT 1 FROM links1 l WHERE l.comment_id = c.in_reply_to)
            AND NOT EXISTS (SELECT 1 FROM links2 l WHERE l.comment_id = c.in_reply_to))""",
        THREADS,
    )
    out["latest_link"] = _with(
        "SELECT comment_id AS link_id, user_id AS link_user FROM links1", THREADS
    )

    out["link_records"] = _with(
        """SELECT CAST(comment_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS value FROM links1
        UNION ALL
        SELECT CAST(comment_id AS VARCHAR), user_id || '_' || root_user FROM links2""",
        THREADS,
    )

    plain = "SELECT comment_id, user_id, ts_ms, comment_type FROM"
    out["filter_valid"] = _with(f"{plain} valid")
    out["filter_direct"] = _with(f"{plain} direct")
    for key, column, value in (
        ("hour_slot", "slot", "extract(hour FROM ts) // 2 + 1"),
        ("hour_of_day", "hour", "extract(hour FROM ts)"),
        ("weekday", "weekday", "extract(dow FROM ts)"),
    ):
        out[key] = _with(f"SELECT comment_id, CAST({value} AS BIGINT) AS {column} FROM comments")
    out["is_numeric"] = _with(_IS_NUMERIC, LINES)
    out["window_label"] = _with(
        """SELECT strftime(date_trunc('day', ts), '%a %b %d %H:%M:%S UTC %Y') AS label, count(*) AS n
        FROM comments GROUP BY 1"""
    )
    out["result_lines"] = _with(
        _lines(_top(_article_counts(_DAY_MS), 3, "n", "article_id"), "article_id", "n")
    )
    out["result_lines_users"] = _with(
        _lines(_top(_user_scores(_DAY_MS), 10, "cents", "author"), "author", "CAST(cents / 100 AS VARCHAR)"),
        THREADS,
    )
    cells = ", ".join(f"s{i:02d}" for i in range(1, 13))
    out["result_lines_slots"] = _with(
        f"""SELECT win_start_ms, concat_ws(', ',
          strftime(make_timestamp(win_start_ms * 1000), '%a %b %d %H:%M:%S UTC %Y'), {cells}) AS line
        FROM ({_slots(_DAY_MS)})"""
    )
    out["serialize_rows"] = _with(_serialize(), LINES)

    out["ingest_valid"] = _with(_INGEST_VALID, LINES)
    out["ingest_reject_counts"] = _with(
        "SELECT error, count(*) AS n FROM ingested WHERE error IS NOT NULL GROUP BY error", LINES
    )
    out["csv_repair"] = _with(_CSV_REPAIR, LINES)
    out["scan_limit"] = _with(
        "SELECT comment_id, user_id, ts_ms FROM comments ORDER BY ts, comment_id LIMIT 9999"
    )

    out["time_span"] = _with(
        """SELECT min(ts_ms) AS first_ms, max(ts_ms) AS last_ms,
          (max(ts_ms) - min(ts_ms)) / 1000 AS span_seconds,
          600 / ((max(ts_ms) - min(ts_ms)) / 1000) AS replay_factor
        FROM comments"""
    )
    out["interarrival_gap"] = _with(
        f"SELECT user_id, comment_id, {_gap('PARTITION BY user_id')} FROM comments"
    )
    out["interarrival_gap_article"] = _with(
        f"SELECT article_id, comment_id, {_gap('PARTITION BY article_id')} FROM comments"
    )
    out["interarrival_gap_stream"] = _with(f"SELECT comment_id, {_gap('')} FROM comments")

    # Kept tables and streams give what the queries over all comments give.
    for name in ("article_counts_week", "user_score_month", "slots_month_origin", "scan_limit"):
        out[f"{name}_days"] = out[name]
    out["stream_credits"] = _with(
        """SELECT ts_ms, author, CAST(level AS BIGINT) AS level, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
        FROM credits GROUP BY ts_ms, author, level""",
        THREADS,
    )
    out["stream_orphans"] = out["orphan_replies"]
    out["stream_link_records"] = out["link_records"]
    # The watermark is a second behind the newest row, in whole milliseconds.
    out["stream_gaps"] = _with(
        f"""SELECT user_id, comment_id, gap_seconds FROM (
          SELECT user_id, comment_id, ts, {_gap('PARTITION BY user_id')} FROM comments)
        WHERE epoch_us(ts) <= (SELECT max(ts_ms) - 1000 FROM comments) * 1000"""
    )
    closed = f"win_start_ms + {_DAY_MS} <= (SELECT max(ts_ms) - 1000 FROM valid)"
    top = _top(_article_counts(_DAY_MS), 3, "n", "article_id")
    out["stream_top3_articles_day"] = _with(f"SELECT * FROM ({top}) WHERE {closed}")
    return out
