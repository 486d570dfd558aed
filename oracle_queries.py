"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each text starts from the raw ``events`` view, projects it onto the
clickstream and the video log with the same fixed rules as
``playtrail.sources.fixture``, and computes the query with plain SQL windows
over whole partitions (no chunking, no broadcast). It shares only the query
parameters (dates, titles, thresholds) and the names of output columns with the Spark side, no logic.
Computed doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import datetime as dt

from playtrail.functions.rules import rule_set
from playtrail.plans.catalog import PARAMS

TZ = "America/New_York"


def norm(x: str) -> str:
    return f"regexp_replace(lower({x}), '[:,.&''!]', '', 'g')"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def local_ts(x: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {x}))"


ORDER_TIMELINE = ", ".join(
    f"{c} ASC NULLS FIRST"
    for c in ("event_ts", "video_id", "title", "action", "click_details", "player_event", "binge_type", "device",
              "seconds_no_ads", "feeder_title", "feeder_video_id")
)


def inputs(p=PARAMS, shared_every=None) -> str:
    page = p["details_page"]
    wide = p.get("wide", False)
    keep, base = ("event_id, s, k, ", "_base") if wide else ("", "")
    pooled = "CAST(floor(user_id / 5) AS BIGINT)"
    acct = pooled if shared_every is None else f"CASE WHEN user_id % {shared_every} = 0 THEN -1 ELSE {pooled} END"
    return f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         {acct} AS acct
  FROM events
),
ev_s AS (
  SELECT *, CASE WHEN k % 5 = 0 THEN 'Show: ' ELSE 'Show ' END || CAST(k % 5 AS VARCHAR) AS s,
         CASE WHEN acct = -1 THEN 'shared' ELSE CAST(acct AS VARCHAR) END AS acct_name,
         CASE WHEN acct = -1 THEN 0 ELSE acct % 4 END AS dk
  FROM ev
),
clickstream{base} AS (
  SELECT {keep}acct_name AS account_id,
         CAST(ts AS DATE) AS event_date,
         timezone('UTC', timezone('{TZ}', ts)) AS revised_ts,
         timezone('UTC', timezone('{TZ}', ts)) AS hit_ts,
         CASE WHEN event_id % 10 = 3 THEN {q(page)} || 'episodes:Episode ' || CAST(k % 12 AS VARCHAR) || '!'
              ELSE 'player' END AS player_event,
         CASE event_id % 10
           WHEN 0 THEN 'Series-Cue-Up||' || s || '|auto-play'
           WHEN 1 THEN 'Programme-Cue-Up||' || s || '|auto-play'
           WHEN 2 THEN 'Series-Cue-Up||' || s || '|click'
           WHEN 3 THEN 'details|play|click'
           WHEN 4 THEN 'Rail|' || s || '|click'
           WHEN 5 THEN 'deeplink|x'
           WHEN 6 THEN 'Episode-Cue-Up||' || s || '|auto-play'
           WHEN 7 THEN 'sle-binge|player||' || s || '|auto-play'
           WHEN 8 THEN 'cue-up|dismiss'
           ELSE 'tile|display' END AS click_details,
         CAST(NULL AS VARCHAR) AS platform,
         CASE dk WHEN 0 THEN 'PS4' WHEN 1 THEN 'Xbox One' WHEN 2 THEN 'Android TV' ELSE 'Xfinity' END AS device,
         CASE WHEN event_id % 10 = 7 THEN 'sle-binge|x' END AS binge_source
  FROM ev_s WHERE event_type IN ('click', 'signup', 'error')
),
video_log{base} AS (
  SELECT {keep}acct_name AS account_id,
         CAST(ts AS DATE) AS event_date,
         ts AS event_ts,
         CASE WHEN k % 5 = 4 AND event_id % 7 = 0 THEN 'N/A'
              ELSE s || CASE WHEN event_id % 13 = 0 THEN ' Trailer' ELSE '' END END AS display_name,
         'Show ' || CAST(k % 5 AS VARCHAR) AS program,
         'Episode ' || CAST(k % 12 AS VARCHAR) || '!' AS episode_title,
         CASE WHEN event_id % 19 = 0 THEN 'Show 3' ELSE 'N/A' END AS content_channel,
         CASE dk WHEN 0 THEN 'Playstation' WHEN 1 THEN 'Xbox'
              WHEN 2 THEN CASE WHEN event_id % 2 = 0 THEN 'Google TV' ELSE 'Android TV' END
              ELSE CASE WHEN event_id % 2 = 0 THEN 'Xfinity X1' ELSE 'Xfinity Flex' END END AS device,
         CAST(event_id AS VARCHAR) AS video_id,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS seconds_no_ads,
         value AS seconds_with_ads,
         event_id % 11 = 0 AS media_load
  FROM ev_s WHERE event_type IN ('view', 'purchase')
){"," + wide_ctes(page) if wide else ""}"""


def wide_ctes(page: str) -> str:
    """The projection in which every arm of the rules is met."""
    pg = q(page)
    return f"""
clickstream AS (
  SELECT CASE WHEN j = 13 THEN NULL ELSE account_id END AS account_id,
         CASE WHEN j IN (3, 11) THEN NULL ELSE event_date END AS event_date, revised_ts, hit_ts,
         CASE j WHEN 5 THEN {pg} || 'upsell:' || ep WHEN 6 THEN {pg} || 'more-like-this:' || ep
                WHEN 7 THEN {pg} || 'extras:' || ep WHEN 8 THEN {pg} || ep
                WHEN 15 THEN {pg} || 'episodes:Poker Face' WHEN 16 THEN {pg} || 'episodes:Yellowstone'
                WHEN 17 THEN {pg} || 'episodes:' || ep ELSE player_event END AS player_event,
         CASE WHEN j = 1 THEN 'Series-cue-up||' || s || '|auto-play'
              WHEN j = 2 THEN 'Programme-cue-up||' || s || '|auto-play'
              WHEN j = 3 THEN 'Series-cue-up||' || s || '|click'
              WHEN j = 4 THEN 'rail|' || s || '|click'
              WHEN j IN (5, 6, 7, 8, 15, 16) THEN 'details|play|click'
              WHEN j = 9 THEN 'Programme-Cue-Up||' || s || '|click'
              WHEN j = 14 THEN NULL
              WHEN j = 17 THEN 'deeplink|details' ELSE click_details END AS click_details,
         platform, CASE WHEN j = 10 THEN NULL ELSE device END AS device, binge_source
  FROM (SELECT *, (event_id // 10) % 20 AS j, 'Episode ' || CAST(k % 12 AS VARCHAR) || '!' AS ep FROM clickstream_base)
),
video_log AS (
  SELECT CASE WHEN j = 15 THEN NULL ELSE account_id END AS account_id, event_date, event_ts,
         CASE j WHEN 1 THEN 'NBC' WHEN 2 THEN 'Peacock TV' WHEN 3 THEN 'Local News (East)' WHEN 4 THEN 'KQED-DT'
                WHEN 5 THEN 'Movies Premium' WHEN 6 THEN 'Kgwn2' WHEN 7 THEN 'WXYZ-A News' WHEN 8 THEN 'KXYZ-B News'
                WHEN 13 THEN NULL ELSE display_name END AS display_name,
         program,
         CASE j WHEN 9 THEN 'Yellowstone' WHEN 10 THEN 'Poker Face' WHEN 11 THEN 'N/A' WHEN 12 THEN NULL
                ELSE episode_title END AS episode_title,
         CASE WHEN j = 17 THEN NULL ELSE content_channel END AS content_channel,
         CASE WHEN j = 14 THEN NULL ELSE device END AS device, video_id,
         CASE WHEN j = 16 THEN 0.0 ELSE seconds_no_ads END AS seconds_no_ads, seconds_with_ads, media_load
  FROM (SELECT *, (event_id // 10) % 24 AS j FROM video_log_base)
)"""


# Rule-set switches, written out independently of playtrail.functions.rules.
RULES = {
    "R4": dict(upstream_day=True, lower=True, contains=True, cue=True, binge=True, device="norm", cls="r4",
               empty=True, stop_pf=True, post_pf=False, kgwn2=True, shift=0, vdevice="norm", dev_keys=True,
               popular=False, ladder="r4", split=True, positive=True),
    "R3": dict(upstream_day=False, lower=True, contains=True, cue=True, binge=True, device="norm", cls="r4",
               empty=True, stop_pf=False, post_pf=True, kgwn2=True, shift=-40, vdevice="norm", dev_keys=True,
               popular=False, ladder="r3", split=True, positive=False),
    "R2": dict(upstream_day=False, lower=False, contains=False, cue=False, binge=True, device="raw", cls="r2",
               empty=True, stop_pf=False, post_pf=True, kgwn2=True, shift=-40, vdevice="raw", dev_keys=False,
               popular=False, ladder="r3", split=True, positive=False),
    "R1": dict(upstream_day=False, lower=False, contains=False, cue=False, binge=False, device="blank", cls="r1",
               empty=False, stop_pf=False, post_pf=True, kgwn2=False, shift=-40, vdevice="raw", dev_keys=False,
               popular=True, ladder="r1", split=False, positive=False),
}

STOP = ["yellowstone", "quantum leap", "dateline nbc", "pft live", "americas got talent all stars"]


def classify_sql(cls: str, d: str = "click_details", pe: str = "player_event", bt: str = "binge_type") -> str:
    if cls == "r4":
        arms = [
            (f"{d} LIKE '%series%cue%up%auto%play%'", "Auto-Play"),
            (f"lower({bt}) LIKE '%sle%binge%'", "Auto-Play"),
            (f"{d} LIKE '%programme%cue%up%auto%play%'", "Auto-Play"),
            (f"{d} LIKE '%series%cue%up%click%'", "Clicked-Up-Next"),
            (f"{d} LIKE '%programme%cue%up%click%'", "Clicked-Up-Next"),
            (f"{pe} LIKE '%details:%' AND {d} IS NOT NULL", "Manual-Selection"),
            (f"{d} LIKE '%deeplink%'", "Manual-Selection"),
            (f"{d} LIKE '%rail%click%'", "Manual-Selection"),
        ]
    elif cls == "r2":
        arms = [
            (f"{d} LIKE '%Series-cue-up%auto-play'", "Auto-Play"),
            (f"{d} LIKE '%Programme-cue-up%auto-play'", "Auto-Play"),
            (f"{d} LIKE '%cue%up%click'", "Clicked-Up-Next"),
            (f"{d} LIKE '%dismiss'", "Dismiss"),
            (f"{pe} LIKE '%details:%' AND {d} IS NOT NULL", "Manual-Selection"),
            (f"{d} LIKE '%deeplink%'", "Manual-Selection"),
            (f"{d} LIKE 'rail%click'", "Manual-Selection"),
        ]
    else:
        arms = [
            (f"{d} LIKE '%auto-play'", "Auto-Play"),
            (f"{d} LIKE '%cue%up%click'", "Clicked-Up-Next"),
            (f"{d} LIKE '%dismiss'", "Dismiss"),
            (f"{pe} LIKE '%details:%' AND {d} IS NOT NULL", "Manual-Selection"),
            (f"{d} LIKE '%deeplink%'", "Manual-Selection"),
            (f"{d} LIKE 'rail%click'", "Manual-Selection"),
        ]
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v in arms) + " END"


def title_sql(p=PARAMS, d: str = "click_details", pe: str = "player_event") -> str:
    page = p["details_page"]
    cue = r"[|][|](.*)[|]"
    rail = r"[|]([a-zA-Z0-9\s.:-]+)[|]click"
    arms = []
    for section in ("episodes", "upsell", "more-like-this", "extras"):
        arms.append(
            f"WHEN {pe} LIKE '%:{section}:%' AND {d} IS NOT NULL THEN replace({pe}, {q(page + section + ':')}, '')"
        )
    arms.append(f"WHEN {pe} LIKE '%:details:%' AND {d} IS NOT NULL THEN replace({pe}, {q(page)}, '')")
    arms.append(f"WHEN {d} LIKE '%auto-play' THEN CASE WHEN regexp_matches({d}, '{cue}') THEN regexp_extract({d}, '{cue}', 1) END")
    arms.append(f"WHEN {d} LIKE '%cue%up%click' THEN CASE WHEN regexp_matches({d}, '{cue}') THEN regexp_extract({d}, '{cue}', 1) END")
    arms.append(f"WHEN {d} LIKE 'rail%click' THEN CASE WHEN regexp_matches({d}, '{rail}') THEN regexp_extract({d}, '{rail}', 1) END")
    return "CASE " + " ".join(arms) + " END"


def linear_sql(dn: str, kgwn2: bool = True) -> str:
    names = ["ktvh-dt", "ksnv-dt"] + (["kgwn2"] if kgwn2 else [])
    return (
        f"(length({dn}) <= 4 OR lower({dn}) LIKE '%tv' OR lower({dn}) LIKE '%)' OR lower({dn}) LIKE '%-dt' "
        f"OR lower({dn}) LIKE '%premium' OR lower({dn}) IN ({', '.join(q(n) for n in names)}) "
        f"OR regexp_matches({dn}, '(W)[a-zA-Z0-9]+-[a-zA-Z0-9]') OR regexp_matches({dn}, '(K)[a-zA-Z0-9]+-[a-zA-Z0-9]'))"
    )


def click_device_sql(kind: str, dev: str = "device") -> str:
    if kind == "norm":
        return f"CASE WHEN lower({dev}) LIKE '%xbox%' THEN 'xbox' WHEN lower({dev}) = 'ps4' THEN 'playstation' ELSE lower({dev}) END"
    if kind == "raw":
        return dev
    return "''"


def video_device_sql(kind: str, dev: str = "device") -> str:
    if kind == "norm":
        return (
            f"CASE WHEN lower({dev}) LIKE '%xfinity%' THEN 'xfinity' "
            f"WHEN lower({dev}) LIKE '%google%tv%' THEN 'android tv' ELSE lower({dev}) END"
        )
    return dev


def clicks_ctes(rs: str, p=PARAMS) -> str:
    r = RULES[rs]
    day = "event_date" if r["upstream_day"] else f"CAST({local_ts('hit_ts')} AS DATE)"
    ts = local_ts("revised_ts") if r["upstream_day"] else local_ts("hit_ts")
    det = "lower(click_details)" if r["lower"] else "click_details"
    bt = "split_part(binge_source, '|', 1)" if r["binge"] else "CAST(NULL AS VARCHAR)"
    disp = "'%display%'" if r["contains"] else "'%display'"
    cue = "AND lower(click_details) NOT LIKE '%episode%cue%up%'" if r["cue"] else ""
    empty = "AND raw_title <> ''" if r["empty"] else ""
    return f"""
raw_clicks AS (
  SELECT account_id, {day} AS event_date, {ts} AS event_ts, player_event, {det} AS click_details,
         {bt} AS binge_type, {click_device_sql(r['device'])} AS device
  FROM clickstream
  WHERE account_id IS NOT NULL AND hit_ts IS NOT NULL AND click_details IS NOT NULL
    AND click_details NOT LIKE {disp} {cue}
    AND CAST({local_ts('hit_ts')} AS DATE) BETWEEN DATE '{p['from_date']}' AND DATE '{p['to_date']}'
),
classified AS (
  SELECT *, {classify_sql(r['cls'])} AS action, {title_sql(p)} AS raw_title FROM raw_clicks
),
clicks_ready AS (
  SELECT account_id, event_date, event_ts, player_event, click_details, binge_type, action, device,
         {norm('raw_title')} AS title
  FROM classified WHERE action IS NOT NULL AND raw_title IS NOT NULL {empty}
)"""


def map_ctes(rs: str, p=PARAMS) -> str:
    r = RULES[rs]
    stop = STOP + (["poker face"] if r["stop_pf"] else [])
    post = "AND episode NOT IN ('poker face')" if r["post_pf"] else ""
    return f"""
series_counts AS (
  SELECT {norm('episode_title')} AS episode,
         CASE WHEN {linear_sql('display_name', r['kgwn2'])} THEN NULL ELSE {norm('display_name')} END AS series,
         count(display_name) AS display_count
  FROM video_log
  WHERE episode_title IS NOT NULL AND lower(episode_title) NOT IN ({', '.join(q(s) for s in stop)})
    AND event_date = DATE '{p['map_date']}'
  GROUP BY 1, 2
),
series_ranked AS (
  SELECT episode, series, dense_rank() OVER (PARTITION BY episode ORDER BY display_count DESC) AS rk
  FROM series_counts WHERE series IS NOT NULL AND episode IS NOT NULL AND episode <> 'n/a'
),
series_map AS (SELECT episode, series FROM series_ranked WHERE rk = 1 {post}),
mapped_clicks AS (
  SELECT c.account_id, c.event_date, c.event_ts, c.player_event, c.click_details, c.binge_type, c.action, c.device,
         coalesce(m.series, c.title) AS title
  FROM clicks_ready c LEFT JOIN series_map m ON m.episode = c.title
)"""


def videos_ctes(rs: str, p=PARAMS) -> str:
    r = RULES[rs]
    ts = f"event_ts - INTERVAL {-r['shift']} SECOND" if r["shift"] else "event_ts"
    return f"""
videos_raw AS (
  SELECT account_id, event_date, {ts} AS event_ts,
         CASE WHEN lower(display_name) = 'n/a' THEN lower(program) ELSE lower(display_name) END AS raw_title,
         CASE WHEN lower(display_name) LIKE '%trailer%' THEN 'Manual-Selection' ELSE 'Vdo_End' END AS action,
         {video_device_sql(r['vdevice'])} AS device, video_id, seconds_no_ads
  FROM video_log
  WHERE account_id IS NOT NULL AND event_date BETWEEN DATE '{p['from_date']}' AND DATE '{p['to_date']}'
    AND media_load = false AND seconds_with_ads > 0
),
videos_ready AS (
  SELECT account_id, event_date, event_ts, action, device,
         {norm('lag(raw_title) OVER wv')} AS feeder_title,
         lag(video_id) OVER wv AS feeder_video_id,
         {norm('raw_title')} AS title, video_id, seconds_no_ads
  FROM videos_raw WHERE raw_title IS NOT NULL
  WINDOW wv AS (PARTITION BY account_id, event_date
                ORDER BY event_ts ASC NULLS FIRST, video_id ASC NULLS FIRST, {norm('raw_title')} ASC NULLS FIRST,
                         action ASC NULLS FIRST, device ASC NULLS FIRST, seconds_no_ads ASC NULLS FIRST)
)"""


def popular_ctes(p=PARAMS) -> str:
    return f"""
popular_counts AS (
  SELECT event_date,
         CASE WHEN lower(display_name) = 'n/a' THEN lower(program) ELSE lower(display_name) END AS raw_title,
         count(DISTINCT account_id) AS accounts
  FROM video_log
  WHERE seconds_no_ads > 0 AND event_date BETWEEN DATE '{p['from_date']}' AND DATE '{p['to_date']}'
  GROUP BY 1, 2
),
channel_list AS (
  SELECT event_date, {norm('content_channel')} AS channel FROM video_log
  WHERE event_date BETWEEN DATE '{p['from_date']}' AND DATE '{p['to_date']}' AND content_channel <> 'N/A'
  GROUP BY 1, 2
),
popular AS (
  SELECT pc.event_date, {norm('pc.raw_title')} AS title FROM popular_counts pc
  WHERE pc.accounts >= {p['min_accounts']} AND {norm('pc.raw_title')} IS NOT NULL
    AND {norm('pc.raw_title')} NOT IN (SELECT cl.channel FROM channel_list cl WHERE cl.event_date = pc.event_date)
)"""


def sequence_ctes(rs: str, p=PARAMS) -> str:
    r = RULES[rs]
    keys = "account_id, event_date" + (", device" if r["dev_keys"] else "")
    popular_filter = (
        "WHERE EXISTS (SELECT 1 FROM popular pp WHERE pp.event_date = s.event_date AND pp.title = s.title)"
        if r["popular"]
        else ""
    )
    return f"""
timeline AS (
  SELECT account_id, event_date, event_ts, player_event, click_details, binge_type, action, device,
         '' AS feeder_title, '' AS feeder_video_id, title, '' AS video_id, CAST(NULL AS DOUBLE) AS seconds_no_ads
  FROM mapped_clicks
  UNION ALL
  SELECT account_id, event_date, event_ts, '' AS player_event, '' AS click_details, '' AS binge_type, action, device,
         feeder_title, feeder_video_id, title, video_id, seconds_no_ads
  FROM videos_ready
),
seq AS (
  SELECT *,
         lag(action) OVER w AS last_action,
         CAST(sum(CASE WHEN feeder_title = title THEN 0 ELSE 1 END) OVER wr AS BIGINT) AS island,
         lag(title) OVER w AS prev_title,
         lag(feeder_title) OVER w AS prev_feeder,
         lead(title) OVER w AS next_title,
         lead(feeder_title) OVER w AS next_feeder
  FROM timeline
  WINDOW w AS (PARTITION BY {keys} ORDER BY {ORDER_TIMELINE}),
         wr AS (PARTITION BY {keys} ORDER BY event_ts ASC NULLS FIRST)
),
seq_kept AS (SELECT * FROM seq s {popular_filter}),
islands AS (
  SELECT *,
         sum(CASE WHEN feeder_title = title THEN seconds_no_ads ELSE 0.0 END)
           OVER (PARTITION BY {keys}, island) AS island_seconds
  FROM seq_kept
)"""


def label_sql(ladder: str) -> str:
    nf = "(feeder_title IS NULL OR feeder_title = '')"
    common = [
        (f"{nf} AND seconds_no_ads IS NOT NULL" if ladder != "r1" else "feeder_title IS NULL AND seconds_no_ads IS NOT NULL", "'Manual-Selection'"),
        ("feeder_title LIKE '%trailer%'", "'Manual-Selection'"),
        ("last_action LIKE '%Manual%' AND action = 'Vdo_End'", "'Manual-Selection'"),
    ]
    if ladder == "r4":
        arms = common + [
            ("last_action = 'Auto-Play' AND action = 'Vdo_End' AND feeder_title NOT LIKE '%trailer%' "
             "AND prev_title = title AND feeder_title <> title", "'Auto-Play'"),
            ("last_action = 'Clicked-Up-Next' AND action = 'Vdo_End' AND feeder_title NOT LIKE '%trailer%' "
             "AND feeder_title <> title", "'Clicked-Up-Next'"),
            (f"action = 'Auto-Play' AND {nf}", "'Manual-Selection'"),
        ]
        default = "'Manual-Selection'"
    elif ladder == "r3":
        arms = common + [
            ("last_action = 'Auto-Play' AND action = 'Vdo_End' AND feeder_title NOT LIKE '%trailer%' "
             "AND feeder_title <> title", "'Auto-Play'"),
            ("last_action = 'Clicked-Up-Next' AND action = 'Vdo_End' AND feeder_title NOT LIKE '%trailer%'", "'Clicked-Up-Next'"),
            ("feeder_title <> title AND island_seconds > 0 AND seconds_no_ads IS NOT NULL", "'Auto-Play'"),
            ("feeder_title <> title AND feeder_title <> '' AND island_seconds = 0 AND seconds_no_ads > 30", "'Unattributed'"),
            (f"action = 'Auto-Play' AND {nf}", "'Manual-Selection'"),
        ]
        default = "'Manual-Selection'"
    else:
        arms = common + [
            ("last_action = 'Auto-Play' AND action = 'Vdo_End' AND feeder_title NOT LIKE '%trailer%'", "'Auto-Play'"),
            ("last_action = 'Clicked-Up-Next' AND action = 'Vdo_End' AND feeder_title NOT LIKE '%trailer%'", "'Clicked-Up-Next'"),
            ("feeder_title <> title AND island_seconds > 0 AND seconds_no_ads IS NOT NULL", "'Auto-Play'"),
            ("feeder_title <> title AND feeder_title <> '' AND island_seconds = 0 AND seconds_no_ads <= 30", "'Auto-Play'"),
            ("feeder_title <> title AND feeder_title <> '' AND island_seconds = 0 AND seconds_no_ads > 30", "'Unattributed'"),
            (f"action = 'Auto-Play' AND {nf}", "'Manual-Selection'"),
        ]
        default = "action"
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in arms) + f" ELSE {default} END"


def label_ctes(rs: str) -> str:
    r = RULES[rs]
    nf = "(feeder_title IS NULL OR feeder_title = '')"
    if not r["split"]:
        return f"""
labelled AS (
  SELECT *, {label_sql(r['ladder'])} AS start_type,
         CASE WHEN feeder_title IS NULL OR feeder_title <> title
              THEN coalesce(seconds_no_ads, 0.0) + island_seconds ELSE 0.0 END AS watch_time
  FROM islands
)"""
    return f"""
labelled0 AS (
  SELECT *, {label_sql(r['ladder'])} AS start_type,
         CASE WHEN {nf} OR feeder_title <> title THEN coalesce(seconds_no_ads, 0.0) + island_seconds ELSE 0.0 END
           AS start_raw,
         CASE WHEN prev_title <> title AND (prev_feeder IS NULL OR prev_feeder = '') AND feeder_title = title
              THEN island_seconds ELSE 0.0 END AS watch_time_carry
  FROM islands
),
labelled1 AS (
  SELECT *,
         CASE WHEN (feeder_title = '' AND next_feeder = '') OR (title <> next_title AND seconds_no_ads IS NULL)
              THEN 0.0 ELSE start_raw END AS watch_time_start
  FROM labelled0
),
labelled AS (SELECT *, watch_time_start + watch_time_carry AS final_watch_time FROM labelled1)"""


def attribution_body(rs: str, p=PARAMS, shared_every=None) -> str:
    """WITH-list (without the WITH keyword) ending in ``labelled``."""
    parts = [inputs(p, shared_every), clicks_ctes(rs, p), map_ctes(rs, p), videos_ctes(rs, p)]
    if RULES[rs]["popular"]:
        parts.append(popular_ctes(p))
    parts += [sequence_ctes(rs, p), label_ctes(rs)]
    return ",".join(parts)


R4_OUT = ["account_id", "event_date", "event_ts", "player_event", "click_details", "binge_type", "last_action",
          "start_type", "device", "feeder_title", "feeder_video_id", "title", "video_id", "final_watch_time"]
OUT = {
    "R4": R4_OUT,
    "R3": R4_OUT[:-1] + ["seconds_no_ads", "island", "island_seconds", "final_watch_time"],
    "R2": R4_OUT[:-1] + ["seconds_no_ads", "island", "island_seconds", "watch_time_start", "watch_time_carry",
                         "final_watch_time"],
    "R1": ["account_id", "event_date", "event_ts", "last_action", "start_type", "device", "feeder_title",
           "feeder_video_id", "title", "video_id", "seconds_no_ads", "watch_time"],
}
ROUNDED = {"island_seconds", "watch_time_start", "watch_time_carry", "final_watch_time", "watch_time"}


def select_list(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in ROUNDED else c for c in cols)


def attribution_sql(rs: str, p=PARAMS, shared_every=None) -> str:
    where = "WHERE final_watch_time > 0" if RULES[rs]["positive"] else ""
    return f"WITH {attribution_body(rs, p, shared_every)}\nSELECT {select_list(OUT[rs])} FROM labelled {where}"


def attribution_table_sql(p=PARAMS) -> str:
    """The saved R4 attribution table as a CTE named ``attribution``."""
    return f"{attribution_body('R4', p)},\nattribution AS (SELECT * FROM labelled WHERE final_watch_time > 0)"


def r2(x: str) -> str:
    """ROUND(x, 2) half-up on the shortest decimal form, as Spark does."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 10)), 2) AS DOUBLE)"


def w(body: str, select: str) -> str:
    return f"WITH {body}\n{select}"


def period(p=PARAMS) -> str:
    return f"event_date BETWEEN DATE '{p['from_date']}' AND DATE '{p['to_date']}'"


TIMELINE_OUT = "account_id, event_date, event_ts, action, device, title, video_id, seconds_no_ads"


def _click_classes(rs: str, p=PARAMS) -> str:
    r = RULES[rs]
    det = "lower(click_details)" if r["lower"] else "click_details"
    bt = "split_part(binge_source, '|', 1)" if r["binge"] else "CAST(NULL AS VARCHAR)"
    day = "event_date" if r["upstream_day"] else f"CAST({local_ts('hit_ts')} AS DATE)"
    ts = local_ts("revised_ts") if r["upstream_day"] else local_ts("hit_ts")
    disp = "'%display%'" if r["contains"] else "'%display'"
    cue = "AND lower(click_details) NOT LIKE '%episode%cue%up%'" if r["cue"] else ""
    return w(
        inputs(p),
        f"""SELECT account_id, event_date, event_ts, click_details, {classify_sql(r['cls'])} AS action FROM (
  SELECT account_id, {day} AS event_date, {ts} AS event_ts, player_event, {det} AS click_details, {bt} AS binge_type
  FROM clickstream
  WHERE account_id IS NOT NULL AND hit_ts IS NOT NULL AND click_details IS NOT NULL
    AND click_details NOT LIKE {disp} {cue}
    AND CAST({local_ts('hit_ts')} AS DATE) BETWEEN DATE '{PARAMS['from_date']}' AND DATE '{PARAMS['to_date']}')""",
    )


def _funnel_ctes(p=PARAMS) -> str:
    src, dst = q(p["source_title"]), q(p["reached_title"])
    return f"""{attribution_table_sql(p)},
prompted AS (
  SELECT account_id, min(event_ts) AS start FROM attribution
  WHERE final_watch_time > 0 AND start_type IN ('Auto-Play', 'Clicked-Up-Next')
    AND title = {dst} AND feeder_title = {src} AND {period(p)}
  GROUP BY 1
),
manual AS (
  SELECT account_id, min(event_ts) AS start, {r2('sum(final_watch_time) / 3600')} AS total_hours FROM attribution
  WHERE final_watch_time > 0 AND start_type = 'Manual-Selection' AND title = {dst} AND {period(p)}
  GROUP BY 1
),
returners AS (
  SELECT i.account_id, i.start AS prompted_start, m.start AS manual_start, m.total_hours
  FROM prompted i JOIN manual m ON i.account_id = m.account_id AND i.start < m.start
),
stages AS (
  SELECT 'Watched Source Title' AS category, count(DISTINCT account_id) AS accounts,
         {r2('sum(seconds_no_ads) / 3600')} AS hours_watched
  FROM video_log WHERE lower(display_name) = {src} AND {period(p)} AND seconds_no_ads > 0
  UNION ALL
  SELECT 'Auto-played to Reached Title', count(DISTINCT account_id), {r2('sum(final_watch_time) / 3600')}
  FROM attribution
  WHERE {period(p)} AND start_type IN ('Auto-Play', 'Clicked-Up-Next') AND lower(feeder_title) = {src}
    AND lower(title) = {dst} AND final_watch_time > 0
  UNION ALL
  SELECT 'Returned to watch Reached Title', count(DISTINCT account_id), {r2('sum(total_hours)')}
  FROM returners
)"""


def _returners(source: str, reached: str) -> str:
    body = _funnel_ctes(PARAMS | {"source_title": source, "reached_title": reached})
    return f"SELECT * FROM ({w(body, f'SELECT {q(source)} AS source, {q(reached)} AS reached, * FROM returners')})"


FUNNEL_SELECT = f"""SELECT category, accounts, eligible_accounts,
       {r2('accounts / NULLIF(eligible_accounts, 0)')} AS take_rate, hours_watched,
       {r2('hours_watched / NULLIF(accounts, 0)')} AS hours_per_account
FROM (SELECT *, lag(accounts) OVER (ORDER BY accounts DESC, category ASC) AS eligible_accounts FROM stages)"""


def _positions(sql: str, rs: str, keys: list[str]) -> str:
    """Rows of a rule set's table numbered by ``keys``, ties by the other columns."""
    order = ", ".join(f"{c} NULLS FIRST" for c in [*keys, *(c for c in rule_set(rs).output_columns if c not in keys)])
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql})"


def oracle() -> dict[str, str]:
    ins = inputs()
    wide = PARAMS | {"wide": True}
    wins = inputs(wide)
    R4 = "R4"
    monitor = w(attribution_table_sql() + f""",
attributed AS (
  SELECT event_date, count(DISTINCT account_id) AS accts, {r2('sum(final_watch_time) / 3600')} AS watched_hours
  FROM attribution WHERE {period()} AND final_watch_time > 0 GROUP BY 1
),
logged AS (
  SELECT event_date, count(DISTINCT account_id) AS sv_accts, {r2('sum(seconds_no_ads) / 3600')} AS sv_watch_hours
  FROM video_log WHERE {period()} AND seconds_no_ads > 0 GROUP BY 1
)""", f"""SELECT a.event_date, a.accts, a.watched_hours, l.sv_accts, l.sv_watch_hours,
       {r2('a.accts / NULLIF(l.sv_accts, 0)')} AS acct_prc,
       {r2('a.watched_hours / NULLIF(l.sv_watch_hours, 0)')} AS hours_prc
FROM attributed a LEFT JOIN logged l ON a.event_date = l.event_date
ORDER BY a.event_date DESC""")
    first, last = (dt.date.fromisoformat(PARAMS[k]) for k in ("from_date", "to_date"))
    # Each day by itself, with its own map.
    every_day = "\nUNION ALL\n".join(
        "SELECT * FROM (" + attribution_sql("R3", PARAMS | {"from_date": d, "to_date": d, "map_date": d}) + ")"
        for d in (str(first + dt.timedelta(days=i)) for i in range((last - first).days + 1))
    )
    out = {
        "normalize_titles": w(ins, f"SELECT video_id, display_name, {norm('display_name')} AS title_norm, "
                                   f"{norm('episode_title')} AS episode_norm FROM video_log"),
        "click_devices": w(ins, f"SELECT device, {click_device_sql('norm')} AS device_norm, count(*) AS n "
                                f"FROM clickstream GROUP BY 1, 2"),
        "video_devices": w(ins, f"SELECT device, {video_device_sql('norm')} AS device_norm, count(*) AS n "
                                f"FROM video_log GROUP BY 1, 2"),
        "binge_types": w(ins, """SELECT binge_source, binge_type,
       CASE WHEN lower(binge_type) LIKE '%sle%binge%' THEN 'SLE'
            WHEN lower(click_details) LIKE '%series%cue%up%' OR lower(click_details) LIKE '%programme%cue%up%'
            THEN 'Cue-Up' END AS binge_kind,
       count(*) AS n
FROM (SELECT binge_source, click_details, split_part(binge_source, '|', 1) AS binge_type FROM clickstream)
GROUP BY 1, 2, 3"""),
        "click_classes_r1": _click_classes("R1"),
        "click_classes_r2": _click_classes("R2"),
        "click_classes_r4": _click_classes("R4"),
        "click_titles": w(ins + "," + clicks_ctes(R4), "SELECT account_id, event_ts, player_event, click_details, "
                                                       "raw_title FROM classified"),
        "linear_channels_flag": w(ins, f"SELECT display_name, {linear_sql('display_name')} AS is_linear, count(*) AS n "
                                       f"FROM video_log GROUP BY 1, 2"),
        "video_titles": w(ins, "SELECT video_id, CASE WHEN lower(display_name) = 'n/a' THEN lower(program) "
                               "ELSE lower(display_name) END AS title, CASE WHEN lower(display_name) LIKE '%trailer%' "
                               "THEN 'Manual-Selection' ELSE 'Vdo_End' END AS action FROM video_log"),
        "local_days": w(ins, f"SELECT account_id, hit_ts, {local_ts('hit_ts')} AS local_ts, "
                             f"CAST({local_ts('hit_ts')} AS DATE) AS local_day FROM clickstream"),
        "shifted_videos": w(ins, "SELECT video_id, event_ts, event_ts - INTERVAL 40 SECOND AS shifted_ts FROM video_log"),
        "clean_clicks": w(ins + "," + clicks_ctes(R4), "SELECT * FROM clicks_ready"),
        "clean_videos": w(ins + "," + videos_ctes(R4), f"SELECT {TIMELINE_OUT} FROM videos_ready"),
        "series_counts": w(ins + "," + clicks_ctes(R4) + "," + map_ctes(R4), "SELECT * FROM series_counts"),
        "series_map": w(ins + "," + clicks_ctes(R4) + "," + map_ctes(R4), "SELECT * FROM series_map"),
        "series_map_r3": w(ins + "," + clicks_ctes("R3") + "," + map_ctes("R3"), "SELECT * FROM series_map"),
        "mapped_clicks": w(ins + "," + clicks_ctes(R4) + "," + map_ctes(R4), "SELECT * FROM mapped_clicks"),
        "feeder": w(ins + "," + videos_ctes(R4), "SELECT account_id, event_date, event_ts, video_id, title, "
                                                 "feeder_title, feeder_video_id FROM videos_ready"),
        "timeline": w(attribution_body(R4), f"SELECT {TIMELINE_OUT}, feeder_title, feeder_video_id FROM timeline"),
        "sequence": w(attribution_body(R4), f"SELECT {TIMELINE_OUT}, feeder_title, last_action, island FROM seq"),
        "island_seconds": w(attribution_body(R4), f"SELECT {TIMELINE_OUT}, feeder_title, island, "
                                                  f"round(island_seconds, 6) AS island_seconds FROM islands"),
        "popular_titles": w(ins + "," + popular_ctes(), "SELECT event_date, title FROM popular"),
        "linear_channels": w(ins + "," + popular_ctes(), "SELECT event_date, channel FROM channel_list"),
        "popular_timeline": w(attribution_body("R1"), f"SELECT {TIMELINE_OUT}, feeder_title, last_action, island, "
                                                      f"round(island_seconds, 6) AS island_seconds FROM islands"),
        "attribution_r1": attribution_sql("R1"),
        "attribution_r2": attribution_sql("R2"),
        "attribution_r3": attribution_sql("R3"),
        "attribution_r4": attribution_sql("R4"),
        "attribution_r1_hot_keys": attribution_sql("R1"),
        "attribution_r2_hot_keys": attribution_sql("R2"),
        "attribution_r3_hot_keys": attribution_sql("R3"),
        "attribution_r4_hot_keys": attribution_sql("R4"),
        "attribution_r4_shared_account": attribution_sql("R4", shared_every=PARAMS["shared_every"]),
        "attribution_r3_shared_account": attribution_sql("R3", shared_every=PARAMS["shared_every"]),
        "watch_time_parts": w(attribution_body(R4), "SELECT account_id, event_date, event_ts, device, title, video_id, "
                                                    "start_type, " + select_list(["watch_time_start", "watch_time_carry",
                                                                                  "final_watch_time"]) + " FROM labelled"),
        "first_starts": w(_funnel_ctes(), "SELECT account_id, 'prompted' AS kind, start, CAST(NULL AS DOUBLE) AS total_hours "
                                          "FROM prompted UNION ALL SELECT account_id, 'manual', start, total_hours FROM manual"),
        "return_viewers": w(_funnel_ctes(), "SELECT * FROM returners"),
        "funnel_stages": w(_funnel_ctes(), "SELECT * FROM stages"),
        "funnel": w(_funnel_ctes(), FUNNEL_SELECT),
        "funnel_returning": w(
            _funnel_ctes(PARAMS | dict(zip(("source_title", "reached_title"), PARAMS["title_pairs"][1]))), FUNNEL_SELECT
        ),
        "return_viewers_pairs": "\nUNION ALL\n".join(_returners(*pair) for pair in PARAMS["title_pairs"]),
        "return_viewers_clustered": "\nUNION ALL\n".join(_returners(*pair) for pair in PARAMS["title_pairs"]),
        "coverage_monitor": monitor,
        "pruned": w(attribution_body("R2"), "SELECT " + select_list(
            ["account_id", "event_date", "event_ts", "last_action", "start_type", "device", "feeder_title",
             "feeder_video_id", "title", "video_id", "seconds_no_ads", "final_watch_time"]) + " FROM labelled"),
        # The reloaded day has its own map day; all others keep the period's.
        "reloaded_day": f"""SELECT * FROM ({attribution_sql("R3")}) WHERE event_date <> DATE '{PARAMS['reload_day']}'
UNION ALL
SELECT * FROM ({attribution_sql("R3", PARAMS | {"map_date": PARAMS["reload_day"]})})
WHERE event_date = DATE '{PARAMS['reload_day']}'""",
        "replaced_table": attribution_sql("R2", PARAMS | {"to_date": PARAMS["week_end"]}),
        "refreshed_days": every_day,
        "backfilled_days": every_day,
        "yesterday_reload": f"""SELECT * FROM ({attribution_sql("R3")}) WHERE event_date < DATE '{PARAMS['yesterday']}'
UNION ALL
SELECT * FROM ({attribution_sql("R3", PARAMS | {"map_date": PARAMS["yesterday"]})})
WHERE event_date = DATE '{PARAMS['yesterday']}'""",
        "ordered_r1": _positions(attribution_sql("R1"), "R1", ["account_id", "event_date", "event_ts"]),
        "ordered_r3": _positions(attribution_sql("R3"), "R3", ["account_id", "event_date", "device", "event_ts"]),
        "ordered_monitor": f"SELECT *, row_number() OVER (ORDER BY event_date DESC) AS position FROM ({monitor})",
        "monitor_from_sets": monitor,
        "popular_from_sets": w(ins + "," + popular_ctes(), "SELECT event_date, title FROM popular"),
        "attribution_r1_shuffle_joins": attribution_sql("R1"),
        "attribution_r4_shuffle_joins": attribution_sql("R4"),
        "click_classes_r1_all_arms": _click_classes("R1", wide),
        "click_classes_r2_all_arms": _click_classes("R2", wide),
        "click_classes_r4_all_arms": _click_classes("R4", wide),
        "click_titles_all_arms": w(wins + "," + clicks_ctes(R4), "SELECT account_id, event_ts, player_event, "
                                                                 "click_details, raw_title FROM classified"),
        "linear_channels_flag_all_arms": w(wins, f"SELECT display_name, {linear_sql('display_name')} AS is_linear, "
                                                 f"count(*) AS n FROM video_log GROUP BY 1, 2"),
        "series_map_all_arms": w(wins + "," + clicks_ctes(R4) + "," + map_ctes(R4), "SELECT * FROM series_map"),
        "series_map_r1_all_arms": w(wins + "," + clicks_ctes("R1") + "," + map_ctes("R1"), "SELECT * FROM series_map"),
        "attribution_r4_all_arms_hot_keys": attribution_sql("R4", wide),
    }
    for rules in RULES:
        out[f"attribution_{rules.lower()}_all_arms"] = attribution_sql(rules, wide)
    return out
