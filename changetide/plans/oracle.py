"""The registered queries as SQL over the given tables, for checking."""

from __future__ import annotations

from changetide.schema import EXCLUDED_TITLE_PREFIXES

# The derived change events; `{source}` is the given table or the one with repeated events.
_STAGED = """
SELECT CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS ts_event_meta_dt,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_meta_dt,
  concat('m-', CAST(n AS VARCHAR)) AS event_meta_id,
  CASE WHEN n % 97 = 0 THEN 'canary' WHEN n % 101 = 0 THEN NULL ELSE 'example.org' END AS event_meta_domain,
  CASE WHEN n % 13 = 0 THEN NULL ELSE n END AS event_id,
  CASE kind WHEN 'click' THEN 'edit' WHEN 'view' THEN 'edit' WHEN 'signup' THEN 'new'
       WHEN 'purchase' THEN 'log' ELSE 'categorize' END AS event_type,
  CASE WHEN n % 211 = 0 THEN NULL WHEN g < 50 THEN 'wikidatawiki' WHEN g < 80 THEN 'commonswiki'
       WHEN g < 100 THEN 'enwiki' WHEN g < 112 THEN 'dewiki'
       ELSE concat('w', CAST(g AS VARCHAR), 'wiki') END AS event_wiki,
  CASE WHEN n % 59 = 0 THEN NULL ELSE concat('u', CAST(user_id AS VARCHAR)) END AS event_user,
  CASE WHEN n % 17 = 0 THEN NULL WHEN user_id % 3 = 0 THEN TRUE ELSE FALSE END AS event_bot,
  CASE WHEN n % 53 = 0 THEN NULL ELSE concat(
       CASE n % 11 WHEN 0 THEN 'Talk:' WHEN 1 THEN 'User:' WHEN 2 THEN 'User talk:' WHEN 3 THEN 'Wikipedia:'
            WHEN 4 THEN 'Wikipedia talk:' WHEN 5 THEN 'Template talk:' ELSE '' END,
       'Page ', regexp_extract(props, '([0-9]+)', 1)) END AS event_title,
  n, slice_start
FROM numbered
"""

_NUMBERED = """
SELECT event_id AS n, ts, user_id, event_type AS kind, props, (user_id * 61) % 150 AS g,
  date_trunc('hour', ts - INTERVAL 5 MINUTE) + INTERVAL 5 MINUTE AS slice_start
FROM events
"""

# All events as they were received: repeated and test events included.
_RECEIVED = f"""
WITH numbered AS ({_NUMBERED} UNION ALL {_NUMBERED} WHERE event_id % 40 = 0),
staged AS ({_STAGED}),
keyed AS (
  SELECT md5(concat(coalesce(event_meta_id, ''), '_-', coalesce(event_meta_dt, ''), '_-',
    coalesce(CAST(event_id AS VARCHAR), ''), '_-', coalesce(event_user, ''), '_')) AS _h, *
  FROM staged)
"""

_COLUMNS = """_h, ts_event_meta_dt, event_meta_dt, event_meta_id, event_meta_domain, event_id,
  event_type, event_wiki, event_user, event_bot, event_title"""

# The event table.
_TABLE = f"""{_RECEIVED},
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY _h ORDER BY
    (event_meta_domain IS NOT NULL AND event_meta_domain <> 'canary') DESC, ts_event_meta_dt NULLS FIRST,
    event_meta_dt NULLS FIRST, event_meta_id NULLS FIRST, event_meta_domain NULLS FIRST,
    event_id NULLS FIRST, event_type NULLS FIRST, event_wiki NULLS FIRST, event_user NULLS FIRST,
    event_bot NULLS FIRST, event_title NULLS FIRST) AS rn
  FROM keyed),
changes AS (SELECT {_COLUMNS}, slice_start FROM ordered WHERE rn = 1 AND event_meta_domain <> 'canary')
"""


def _rollup(name: str, where: str) -> str:
    return f"""
{name} AS (
  SELECT CAST(ts_event_meta_dt AS DATE) AS date, CAST(extract(hour FROM ts_event_meta_dt) AS INTEGER) AS hour,
    event_wiki,
    COUNT(*) AS count_bot_flagignore,
    COUNT(*) FILTER (WHERE event_bot) AS count_bot_true,
    COUNT(*) FILTER (WHERE NOT event_bot) AS count_bot_false
  FROM changes
  WHERE ts_event_meta_dt < (SELECT date_trunc('hour', MAX(ts_event_meta_dt)) FROM changes) {where}
  GROUP BY 1, 2, 3)
"""


_ROLLED = f"""{_TABLE}, {_rollup('counts_all', '')}, {_rollup('counts_edits', "AND event_type = 'edit'")}"""

_SHOWN = "event_meta_id, event_wiki, event_type, event_title, event_bot"


def _shown(where: str) -> str:
    return f"{_TABLE} SELECT {_SHOWN} FROM changes WHERE {where}"


_HOUR = "CAST(extract(hour FROM ts_event_meta_dt) AS INTEGER)"
_DAY = "CAST(ts_event_meta_dt AS DATE)"
_PREFIXES = " ".join(f"AND NOT starts_with(event_title, '{p}')" for p in EXCLUDED_TITLE_PREFIXES)


def _breakdown(counter: str, cum_total: str) -> str:
    """Shares by the definition: each wiki against all that rank before it or are itself.

    Counted from the events, not from the rollup.
    """
    return f"""{_TABLE},
counted AS (
  SELECT * FROM changes
  WHERE ts_event_meta_dt >= TIMESTAMP '2024-01-16 00:00:00'
    AND ts_event_meta_dt < (SELECT date_trunc('hour', MAX(ts_event_meta_dt)) FROM changes)),
whole AS (
  SELECT COUNT(*) AS tot_bot_flagignore, COUNT(CASE WHEN event_bot THEN 1 END) AS tot_bot_true,
    COUNT(CASE WHEN NOT event_bot THEN 1 END) AS tot_bot_false FROM counted),
sums AS (
  SELECT event_wiki, COUNT(*) AS sum_bot_flagignore, COUNT(CASE WHEN event_bot THEN 1 END) AS sum_bot_true,
    COUNT(CASE WHEN NOT event_bot THEN 1 END) AS sum_bot_false
  FROM counted GROUP BY event_wiki),
ranked AS (
  SELECT mine.event_wiki, mine.{counter} AS sum,
    (SELECT CAST(SUM(theirs.{counter}) AS BIGINT) FROM sums AS theirs
     WHERE theirs.{counter} > mine.{counter}
       OR (theirs.{counter} = mine.{counter} AND (mine.event_wiki IS NULL OR theirs.event_wiki <= mine.event_wiki))) AS cumsum
  FROM sums AS mine),
shares AS (
  SELECT event_wiki, sum, sum / (SELECT tot_bot_flagignore FROM whole)::DOUBLE AS rel_sum, cumsum,
    cumsum / (SELECT {cum_total} FROM whole)::DOUBLE AS rel_cumsum FROM ranked),
labelled AS (
  SELECT CASE WHEN cumsum * 100 < (SELECT {cum_total} FROM whole) * 95 THEN event_wiki ELSE 'other wikis' END AS event_wiki,
    sum, cumsum, (SELECT tot_bot_flagignore FROM whole) AS total FROM ranked)
"""


_WITH_BOTS = _breakdown("sum_bot_flagignore", "tot_bot_flagignore")
_NO_BOTS = _breakdown("sum_bot_false", "tot_bot_false")


def _trend_rollup(counter: str) -> str:
    return f"""{_ROLLED}
SELECT date, hour, CAST(SUM({counter}) FILTER (WHERE event_wiki = 'enwiki') AS BIGINT) AS enwiki,
  CAST(SUM({counter}) FILTER (WHERE event_wiki = 'dewiki') AS BIGINT) AS dewiki,
  CAST(date AS TIMESTAMP) + to_hours(hour) AS ts
FROM counts_edits
WHERE event_wiki IN ('enwiki', 'dewiki') AND date >= DATE '2024-01-08' AND date <= DATE '2024-01-15'
GROUP BY date, hour"""


def _trend_raw(where: str) -> str:
    return f"""{_TABLE}
SELECT {_DAY} AS date, {_HOUR} AS hour,
  CAST(SUM(1) FILTER (WHERE event_wiki = 'enwiki') AS BIGINT) AS enwiki,
  CAST(SUM(1) FILTER (WHERE event_wiki = 'dewiki') AS BIGINT) AS dewiki,
  date_trunc('hour', ts_event_meta_dt) AS ts
FROM changes
WHERE event_type = 'edit' AND event_wiki IN ('enwiki', 'dewiki') {where}
  AND ts_event_meta_dt < (SELECT date_trunc('hour', MAX(ts_event_meta_dt)) FROM changes)
GROUP BY 1, 2, 5"""


_PAGE_COUNTS = f"""{_TABLE},
counts AS (
  SELECT event_wiki, event_title, date_trunc('hour', ts_event_meta_dt) AS t, COUNT(*) AS c
  FROM changes WHERE event_type = 'edit' GROUP BY 1, 2, 3)
"""

# Every hour of the days with events, of which the page's own span is shown.
_FILLED = f"""{_TABLE},
page AS (
  SELECT ts_event_meta_dt AS edited FROM changes
  WHERE event_type = 'edit' AND event_wiki = 'wikidatawiki' AND event_title = 'Page 51'),
days AS (SELECT DISTINCT CAST(ts_event_meta_dt AS DATE) AS day FROM changes),
calendar AS (
  SELECT unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS t
  FROM (SELECT MIN(day) AS first_day, MAX(day) AS last_day FROM days)),
filled AS (
  SELECT t, (SELECT COUNT(*) FROM page WHERE date_trunc('hour', edited) = t) AS value FROM calendar
  WHERE EXISTS (SELECT 1 FROM page WHERE edited < t + INTERVAL 1 HOUR) AND EXISTS (SELECT 1 FROM page WHERE edited >= t))
"""

_HISTORIES = """,
axes AS (
  SELECT series_no, event_wiki, event_title, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM spans)
SELECT series_no, concat(axes.event_wiki, '/', axes.event_title) AS series, axes.t, coalesce(c, 0) AS value
FROM axes LEFT JOIN counts ON counts.event_wiki = axes.event_wiki AND counts.event_title = axes.event_title
  AND counts.t = axes.t
"""

# The plain definition: count over a sliding range.
_BACK = "RANGE BETWEEN INTERVAL 900 SECOND PRECEDING AND CURRENT ROW"
_FORTH = "RANGE BETWEEN CURRENT ROW AND INTERVAL 900 SECOND FOLLOWING"

_BURSTS = f"""{_TABLE},
b AS (SELECT ts_event_meta_dt AS window_end, COUNT(*) OVER (ORDER BY ts_event_meta_dt {_BACK}) AS c FROM changes),
f AS (
  SELECT ts_event_meta_dt AS window_start, COUNT(*) OVER (ORDER BY ts_event_meta_dt {_FORTH})
    - row_number() OVER (PARTITION BY ts_event_meta_dt) + 1 AS c FROM changes)
"""

# Lines of the dumps: every 500th event is followed by a broken one.
_LINES = f"""{_RECEIVED},
lines AS (
  SELECT *, concat('stream_', strftime(slice_start, '%Y%m%dT000500')) AS dump, TRUE AS ok FROM keyed
  UNION ALL
  SELECT *, concat('stream_', strftime(slice_start, '%Y%m%dT000500')) AS dump, FALSE AS ok FROM keyed
  WHERE n % 500 = 0)
"""

_NAMES = r"""
WITH stamped AS (
  SELECT event_id AS n, strftime(ts, '%Y%m%dT%H%M%S') AS s FROM events),
names AS (
  SELECT concat(CASE WHEN n % 5 = 0 THEN 'xstream_' ELSE 'stream_' END,
    CASE WHEN n % 13 = 0 THEN concat(s, '0')
         WHEN n % 17 = 0 THEN regexp_replace(s, '^202401', '202499') ELSE s END,
    '_', lpad(CAST(n AS VARCHAR), 9, '0'),
    CASE WHEN n % 7 = 0 THEN '.gz' WHEN n % 11 = 0 THEN '.gz.readyX' ELSE '.gz.ready' END) AS filename
  FROM stamped),
parsed AS (
  SELECT filename, CASE WHEN regexp_matches(filename, '^stream_([0-9]{8}T[0-9]{6})_[0-9]+.gz.ready$')
    THEN try_strptime(regexp_extract(filename, '^stream_([0-9]{8}T[0-9]{6})_', 1), '%Y%m%dT%H%M%S') END AS ts
  FROM names)
"""

_FACTS = """
WITH facts AS (
  SELECT strftime(ts, 'stream_%Y%m%dT%H0500_000001.gz.ready') AS filename,
    CASE event_type WHEN 'signup' THEN 'registered' WHEN 'click' THEN 'load_begin'
      WHEN 'view' THEN 'load_complete' WHEN 'purchase' THEN 'archived' ELSE 'transferred' END AS fact,
    ts, event_id, user_id
  FROM events)
"""


def _stream_counts(where: str) -> str:
    """The table's counts for the hours that ended an hour or more before its newest event."""
    return f"""{_TABLE}
SELECT {_DAY} AS date, {_HOUR} AS hour, event_wiki, COUNT(*) AS count_bot_flagignore,
  COUNT(*) FILTER (WHERE event_bot) AS count_bot_true,
  COUNT(*) FILTER (WHERE NOT event_bot) AS count_bot_false
FROM changes
WHERE date_trunc('hour', ts_event_meta_dt) + INTERVAL 2 HOUR <= (SELECT MAX(ts_event_meta_dt) FROM changes) {where}
GROUP BY 1, 2, 3"""


def _bucket() -> str:
    """SHA-256 modulo 10, folded over eight 32-bit digits as the number is too big for one value."""
    value = "0"
    for i in range(8):
        digit = f"CAST(concat('0x', substr(sha256(event_wiki), {1 + 8 * i}, 8)) AS BIGINT)"
        value = f"(({value}) * {2**32 % 10} + {digit}) % 10"
    return f"CAST({value} AS BIGINT)"


def oracle_sql() -> dict[str, str]:
    all_changes = f"{_TABLE} SELECT {_COLUMNS} FROM changes"
    rolled = "date, hour, event_wiki, count_bot_flagignore, count_bot_true, count_bot_false"
    age = "CAST(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(MAX(ts_event_meta_dt)) AS DOUBLE) / 1000000.0::DOUBLE"
    hourly = f"{_DAY} AS date, {_HOUR} AS hour, COUNT(*) AS c FROM changes"
    registry_state = f"""{_FACTS} SELECT filename,
            MIN(CASE WHEN fact = 'registered' THEN ts END) AS ts_entry_creation,
            MAX(CASE WHEN fact = 'transferred' THEN ts END) AS ts_file_transfer,
            MAX(CASE WHEN fact = 'load_begin' THEN ts END) AS ts_load_begin,
            MAX(CASE WHEN fact = 'load_complete' THEN ts END) AS ts_load_end,
            arg_max(event_id, ts) FILTER (WHERE fact = 'load_complete') AS loadstat_events_in_file,
            arg_max(user_id, ts) FILTER (WHERE fact = 'load_complete') AS loadstat_events_merged,
            MAX(CASE WHEN fact = 'archived' THEN ts END) AS ts_file_archive
            FROM facts GROUP BY filename"""
    return {
        "flagship": f"{_ROLLED} SELECT * FROM counts_all",
        "read_dumps": f"{_LINES} SELECT dump AS filename, COUNT(*) AS lines FROM lines GROUP BY 1",
        "parse_changes": f"""{_RECEIVED} SELECT event_meta_dt, event_meta_id, event_meta_domain, event_id,
            event_type, event_wiki, event_user, event_bot, event_title FROM keyed""",
        "select_ready_dumps": f"{_NAMES} SELECT filename, ts IS NOT NULL AS is_valid_filename, ts FROM parsed",
        "expired_dumps": f"""{_NAMES} SELECT filename, ts FROM parsed
            WHERE TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY > ts""",
        "load_registry": registry_state,
        "compacted_registry": registry_state,
        "new_dumps": f"""{_FACTS} SELECT DISTINCT filename FROM facts
            WHERE filename NOT IN (SELECT filename FROM facts WHERE fact = 'load_complete'
              AND ts < TIMESTAMP '2024-01-15 12:34:00')""",
        "add_content_key": f"{_RECEIVED} SELECT {_COLUMNS} FROM keyed",
        "parse_event_time": f"""WITH numbered AS ({_NUMBERED}), staged AS ({_STAGED})
            SELECT event_meta_dt, ts_event_meta_dt FROM staged""",
        "dedup_changes": all_changes,
        "merge_changes": f"""{_TABLE} SELECT _h, event_meta_id,
            CASE WHEN ts_event_meta_dt < TIMESTAMP '2024-01-15 12:34:00' THEN 'first' ELSE 'second' END AS load_id
            FROM changes""",
        "load_batch": all_changes,
        "load_stats": f"""{_LINES}, per_file AS (
            SELECT dump, _h, bool_or(ok AND event_meta_domain <> 'canary') AS survives FROM lines GROUP BY 1, 2),
            owners AS (SELECT _h, MIN(dump) AS dump FROM per_file WHERE survives GROUP BY 1),
            sizes AS (SELECT dump, COUNT(*) AS lines, COUNT(*) FILTER (WHERE ok) AS staged FROM lines GROUP BY 1)
            SELECT dump AS filename, lines, staged,
              (SELECT COUNT(*) FROM per_file WHERE per_file.dump = sizes.dump AND survives) AS deduplicated,
              (SELECT COUNT(*) FROM owners WHERE owners.dump = sizes.dump) AS merged FROM sizes""",
        "partitioned_event_sink": f"""{_TABLE} SELECT CAST(substr(event_meta_dt, 1, 10) AS DATE) AS event_date,
            CASE WHEN event_wiki = 'dewiki' THEN 'dewiki' WHEN event_wiki = 'enwiki' THEN 'enwiki'
              WHEN event_wiki IN ('commonswiki', 'wikidatawiki') THEN 'hightraffic' ELSE 'otherwikis' END AS wiki_group,
            COUNT(*) AS c FROM changes GROUP BY 1, 2""",
        "export_epochs": f"""{_TABLE} SELECT concat(CAST(epoch_us(ts_event_meta_dt) // 1000000 AS VARCHAR), '.',
            lpad(CAST(epoch_us(ts_event_meta_dt) % 1000000 AS VARCHAR), 6, '0')) AS e FROM changes""",
        "read_epochs": f"""{_TABLE} SELECT CAST(epoch_us(ts_event_meta_dt) AS DOUBLE) / 1000000.0::DOUBLE AS d
            FROM changes""",
        "dump_quality": f"""{_LINES} SELECT dump AS filename, COUNT(*) AS lines,
            COUNT(*) FILTER (WHERE NOT ok) AS undecodable FROM lines GROUP BY 1""",
        "first_event_time": f"""{_LINES} SELECT dump AS filename, MIN(ts_event_meta_dt) AS first_ts
            FROM lines WHERE ok GROUP BY 1""",
        "edits_only": _shown("event_type = 'edit'"),
        "wiki_filter": _shown("event_wiki = 'enwiki'"),
        "page_filter": _shown("event_wiki = 'wikidatawiki' AND event_title = 'Page 51'"),
        "exclude_title_prefixes": _shown(f"TRUE {_PREFIXES}"),
        "since_filter": _shown("ts_event_meta_dt >= TIMESTAMP '2024-01-05 00:00:00'"),
        "since_filter_strict": _shown("ts_event_meta_dt > TIMESTAMP '2024-01-05 00:00:00'"),
        "date_range_filter": f"""{_ROLLED} SELECT {rolled} FROM counts_edits
            WHERE date >= DATE '2024-01-08' AND date <= DATE '2024-01-15'""",
        "clamp_date_range": f"""{_ROLLED} SELECT {rolled} FROM counts_edits
            WHERE date >= DATE '2024-01-14' AND date <= DATE '2024-01-15'""",
        "exclude_bots": _shown("event_bot = FALSE"),
        "complete_hours_only": _shown(
            "ts_event_meta_dt < (SELECT date_trunc('hour', MAX(ts_event_meta_dt)) FROM changes)"
        ),
        "known_wikis": f"""{_TABLE}, asked AS (
            SELECT * FROM (VALUES (0, 'enwiki'), (1, 'nosuchwiki'), (2, 'dewiki')) AS v(position, event_wiki))
            SELECT position, event_wiki FROM asked
            WHERE event_wiki IN (SELECT event_wiki FROM changes WHERE event_type = 'edit')""",
        "wiki_in_list": _shown("event_wiki IN ('enwiki', 'dewiki')"),
        "drop_canary": f"""WITH numbered AS ({_NUMBERED}), staged AS ({_STAGED})
            SELECT event_meta_id, event_meta_domain FROM staged
            WHERE event_meta_domain IS NULL OR event_meta_domain <> 'canary'""",
        "drop_undecodable": f"{_LINES} SELECT event_meta_id AS message FROM lines WHERE ok",
        "watch_user": _shown("event_user = 'u7'"),
        "date_hour_keys": f"{_TABLE} SELECT event_meta_id, {_DAY} AS date, {_HOUR} AS hour FROM changes",
        "hour_timestamp": f"""{_ROLLED} SELECT date, hour, event_wiki, CAST(date AS TIMESTAMP) + to_hours(hour) AS ts
            FROM counts_all""",
        "hours_before": f"""{_FILLED} SELECT t, CAST(epoch_us(t) - epoch_us(TIMESTAMP '2024-01-31 00:00:00') AS DOUBLE)
            / 3600000000.0::DOUBLE AS hours, value FROM filled""",
        "label_other": f"{_WITH_BOTS} SELECT event_wiki, sum, cumsum FROM labelled",
        "drop_null_wiki": f"{_WITH_BOTS} SELECT event_wiki, sum, cumsum FROM labelled WHERE event_wiki IS NOT NULL",
        "stable_bucket": f"""{_TABLE} SELECT event_wiki, COUNT(*) AS c, {_bucket()} AS bucket FROM changes
            WHERE event_wiki IS NOT NULL GROUP BY event_wiki""",
        "series_label": f"""{_TABLE} SELECT concat_ws('/', event_wiki, event_title) AS series, COUNT(*) AS c
            FROM changes GROUP BY 1""",
        "bot_flags": f"""{_TABLE} SELECT event_meta_id, 1 AS count_bot_flagignore,
            CASE WHEN event_bot = TRUE THEN 1 END AS count_bot_true,
            CASE WHEN event_bot = FALSE THEN 1 END AS count_bot_false FROM changes""",
        "hourly_counts_all": f"{_ROLLED} SELECT {rolled} FROM counts_all",
        "hourly_counts_edits": f"{_ROLLED} SELECT {rolled} FROM counts_edits",
        "refresh_rollups": f"""{_ROLLED} SELECT {rolled}, 'all' AS rollup FROM counts_all
            UNION ALL SELECT {rolled}, 'edits' AS rollup FROM counts_edits""",
        "wiki_hourly_edits": f"""{_TABLE} SELECT {hourly}
            WHERE event_type = 'edit' AND event_wiki = 'enwiki' GROUP BY 1, 2""",
        "page_hourly_edits": f"""{_TABLE} SELECT {hourly} WHERE event_type = 'edit'
            AND event_wiki = 'wikidatawiki' AND event_title = 'Page 51' GROUP BY 1, 2""",
        "top_wikis": f"""{_TABLE} SELECT event_wiki, COUNT(*) AS c FROM changes GROUP BY 1
            ORDER BY 2 DESC, 1 ASC NULLS LAST LIMIT 10""",
        "event_types": f"{_TABLE} SELECT event_type, COUNT(*) AS c FROM changes GROUP BY 1",
        "wiki_list_rollup": f"""{_ROLLED} SELECT event_wiki, CAST(SUM(count_bot_flagignore) AS BIGINT) AS c
            FROM counts_edits GROUP BY 1""",
        "wiki_list_raw": f"""{_TABLE} SELECT event_wiki, COUNT(*) AS c FROM changes
            WHERE event_type = 'edit' GROUP BY 1""",
        "timetrend_rollup": _trend_rollup("count_bot_flagignore"),
        "timetrend_rollup_nobots": _trend_rollup("count_bot_false"),
        "timetrend_raw": _trend_raw(""),
        "timetrend_raw_nobots": _trend_raw("AND event_bot = FALSE"),
        "busiest_hours": f"""{_TABLE} SELECT {hourly} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
        "daily_rates": f"""{_TABLE} SELECT {_DAY} AS date, CAST(COUNT(*) AS DOUBLE) / 86400.0::DOUBLE AS total_per_sec,
            CAST(SUM(1) FILTER (WHERE event_type = 'edit') AS DOUBLE) / 86400.0::DOUBLE AS edits_per_sec
            FROM changes GROUP BY 1""",
        "top_pages": f"""{_TABLE} SELECT event_title, COUNT(*) AS c FROM changes
            WHERE ts_event_meta_dt >= TIMESTAMP '2024-01-05 00:00:00' AND event_type = 'edit'
              AND event_wiki = 'enwiki' {_PREFIXES}
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
        "breakdown_sums": f"{_WITH_BOTS} SELECT * FROM sums",
        "breakdown_totals": f"{_WITH_BOTS} SELECT * FROM whole",
        "breakdown_segments": f"""{_WITH_BOTS} SELECT event_wiki,
            CAST(SUM(sum) AS DOUBLE) / CAST(MAX(total) AS DOUBLE) AS rel_sum FROM labelled
            WHERE event_wiki IS NOT NULL GROUP BY 1""",
        "oldest_event": f"{_TABLE} SELECT MIN(ts_event_meta_dt) AS min_ts FROM changes",
        "newest_event": f"""{_TABLE} SELECT MAX(ts_event_meta_dt) AS max_ts,
            concat(regexp_replace(strftime(MAX(ts_event_meta_dt) + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.%f'),
              '[.]000000$', ''), '+01:00') AS max_ts_local FROM changes""",
        "freshness_age": f"{_TABLE} SELECT {age} AS freshness_sec FROM changes",
        "event_count": f"{_TABLE} SELECT COUNT(*) AS nevents FROM changes",
        "db_stats": f"""{_TABLE} SELECT MIN(ts_event_meta_dt) AS min_ts, MAX(ts_event_meta_dt) AS max_ts,
            {age} AS freshness_sec, COUNT(*) AS nevents FROM changes""",
        "duplicate_meta_ids": f"""{_RECEIVED} SELECT event_meta_id, COUNT(*) AS c FROM keyed
            GROUP BY 1 HAVING COUNT(*) >= 2""",
        "rollup_consistency": f"""{_ROLLED}, r AS (
              SELECT CAST(SUM(count_bot_flagignore) AS BIGINT) AS rollup_total FROM counts_all),
            raw AS (SELECT COUNT(*) AS raw_total FROM changes
              WHERE ts_event_meta_dt < (SELECT date_trunc('hour', MAX(ts_event_meta_dt)) FROM changes))
            SELECT rollup_total, raw_total, rollup_total = raw_total AS ok FROM r, raw""",
        "health_status": f"""{_TABLE} SELECT MAX(ts_event_meta_dt) AS last_event, {age} AS age_sec,
            CASE WHEN {age} <= 900 THEN 'OK' ELSE 'ERROR' END AS status FROM changes""",
        "page_history_filled": f"{_FILLED} SELECT t, value FROM filled",
        "page_history_many": f"""{_PAGE_COUNTS}, asked AS (
            SELECT * FROM (VALUES (0, 'wikidatawiki', 'Page 51'), (1, 'commonswiki', 'Page 7'),
              (2, 'enwiki', 'Template talk:Page 12')) AS v(series_no, event_wiki, event_title)),
            spans AS (SELECT series_no, event_wiki, event_title, MIN(t) AS lo, MAX(t) AS hi
              FROM asked JOIN counts USING (event_wiki, event_title) GROUP BY 1, 2, 3) {_HISTORIES}""",
        "wiki_history_many": f"""{_TABLE} SELECT event_wiki AS series, date_trunc('hour', ts_event_meta_dt) AS t,
            COUNT(*) AS value FROM changes WHERE event_type = 'edit'
              AND event_wiki IN ('commonswiki', 'wikidatawiki', 'enwiki', 'dewiki') GROUP BY 1, 2""",
        "top_pages_history": f"""{_PAGE_COUNTS}, top AS (
            SELECT event_title, COUNT(*) AS c FROM changes
            WHERE ts_event_meta_dt >= TIMESTAMP '2024-01-05 00:00:00' AND event_type = 'edit'
              AND event_wiki = 'enwiki' {_PREFIXES}
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10),
            spans AS (SELECT CAST(row_number() OVER (ORDER BY c DESC, event_title) - 1 AS INTEGER) AS series_no,
              'enwiki' AS event_wiki, event_title, TIMESTAMP '2024-01-09 00:00:00' AS lo,
              TIMESTAMP '2024-01-31 00:00:00' AS hi FROM top) {_HISTORIES}""",
        "wiki_breakdown": f"{_WITH_BOTS} SELECT event_wiki, sum, rel_sum, cumsum, rel_cumsum FROM shares",
        "wiki_breakdown_nobots": f"{_NO_BOTS} SELECT event_wiki, sum, rel_sum, cumsum, rel_cumsum FROM shares",
        "burst_counts": f"{_BURSTS} SELECT window_end, c FROM b",
        "peak_burst": f"{_BURSTS} SELECT window_end, c FROM b ORDER BY c DESC, window_end LIMIT 1",
        "burst_counts_forward": f"{_BURSTS} SELECT window_start, c FROM f",
        "peak_burst_forward": f"{_BURSTS} SELECT window_start AS t0, c AS len FROM f ORDER BY c DESC, t0 LIMIT 1",
        "peak_burst_rollup": f"{_BURSTS} SELECT window_end, c FROM b ORDER BY c DESC, window_end LIMIT 1",
        "peak_burst_forward_rollup": f"{_BURSTS} SELECT window_start AS t0, c AS len FROM f ORDER BY c DESC, t0 LIMIT 1",
        "stream_load": all_changes,
        "stream_dedup": f"{_RECEIVED} SELECT DISTINCT {_COLUMNS} FROM keyed",
        "dump_slices": f"""{_TABLE} SELECT event_meta_id, slice_start,
            CAST((row_number() OVER (PARTITION BY slice_start
              ORDER BY date_trunc('second', ts_event_meta_dt), _h) - 1) // 5 AS BIGINT) AS slice_part FROM changes""",
        "stream_dump_slices": f"""{_TABLE} SELECT event_meta_id, slice_start,
            CAST((row_number() OVER (PARTITION BY slice_start
              ORDER BY date_trunc('second', ts_event_meta_dt), _h) - 1) // 5 AS BIGINT) AS slice_part FROM changes""",
        "stream_late_rows": f"""{_RECEIVED} SELECT event_meta_id, ts_event_meta_dt FROM keyed
            WHERE ts_event_meta_dt < TIMESTAMP '2024-01-15 12:34:00'
            AND ts_event_meta_dt <= (SELECT MAX(ts_event_meta_dt) FROM keyed) - INTERVAL 1 HOUR""",
        "stream_health_timeout": f"""{_RECEIVED} SELECT UNNEST(['OK', 'ERROR']) AS status, MAX(ts_event_meta_dt) AS last_event
            FROM keyed""",
        "stored_extent": f"""{_TABLE} SELECT MIN(ts_event_meta_dt) AS min_ts, MAX(ts_event_meta_dt) AS max_ts FROM changes""",
        "stored_complete_hours": _shown(
            "ts_event_meta_dt < (SELECT date_trunc('hour', MAX(ts_event_meta_dt)) FROM changes)"
        ),
        "committed_changes": all_changes,
        "committed_rollups": f"""{_ROLLED} SELECT {rolled}, 'all' AS rollup FROM counts_all
            UNION ALL SELECT {rolled}, 'edits' AS rollup FROM counts_edits""",
        "stream_hourly_counts": _stream_counts(""),
        "stream_hourly_counts_edits": _stream_counts("AND event_type = 'edit'"),
        "stream_health": f"""{_RECEIVED} SELECT MAX(ts_event_meta_dt) AS last_event, {age} AS age_sec,
            CASE WHEN {age} <= 900 THEN 'OK' ELSE 'ERROR' END AS status FROM keyed""",
        "stream_watch_user": f"""{_RECEIVED} SELECT {_SHOWN} FROM keyed WHERE event_user = 'u7'
            AND event_meta_domain IS DISTINCT FROM 'canary'""",
    }
