"""DuckDB SQL that computes every registered query from the plain table columns.

Nothing here goes through message text: ids, teams, scores and actions come from
arithmetic on ``events`` and ``orders``, and seasons and matches from calendar days.
"""

from __future__ import annotations

ORDER = 'ts, "partition", "offset"'
MATCH = "season_id, game_key, match_seq"
O = 'struct_pack(a := ts, b := "partition", c := "offset")'

_EVENTS = """
WITH RECURSIVE ev AS (
  SELECT event_id, user_id, event_type, ts, user_id % 12 AS g, (user_id // 12) % 2 AS side,
         epoch_us(ts) // 86400000000 AS day, (epoch_us(ts) // 1000000) % 86400 AS sec
  FROM events
), days AS (
  SELECT d.day, count(s.day) AS season_id
  FROM (SELECT DISTINCT day FROM ev) d
  LEFT JOIN (SELECT DISTINCT day FROM ev WHERE day % 10 = 0) s ON s.day <= d.day
  GROUP BY d.day
), game_days AS (
  SELECT g, day, row_number() OVER (PARTITION BY g ORDER BY day) AS match_seq
  FROM (SELECT DISTINCT g, day FROM ev)
), base AS (
  SELECT ev.*, days.season_id, game_days.match_seq, 'Game_' || (100 + ev.g) AS game_key,
         CAST(ev.g % 3 AS INTEGER) AS "partition",
         'T' || (2 * ev.g) AS home, 'T' || (2 * ev.g + 1) AS away,
         CAST(sec // (600 + 150 * (ev.g % 4)) AS INTEGER) AS sh,
         CAST(sec // (600 + 150 * ((ev.g + ev.day) % 3)) AS INTEGER) AS sa
  FROM ev JOIN days ON days.day = ev.day
  JOIN game_days ON game_days.g = ev.g AND game_days.day = ev.day
), acts AS (
  SELECT *, (event_id + 1) * 8 + 4 AS "offset",
         'T' || (2 * g + side) AS team, event_id % 53 = 0 AS bad_line,
         CAST(CASE WHEN event_id % 29 = 0 THEN NULL ELSE 1 + event_id % 4 END AS INTEGER) AS q,
         CASE WHEN event_id % 37 = 0 THEN 'UNKNOWN'
              WHEN event_type IN ('purchase', 'click') THEN 'POINT'
              WHEN event_type = 'error' THEN 'FOUL'
              WHEN event_type = 'view' THEN 'TURNOVER' ELSE 'SUBSTITUTION' END AS action
  FROM base
), plays AS (
  SELECT *, coalesce(q, -1) AS quarter,
         CASE WHEN bad_line THEN home || ' x X 3 ' || away
              ELSE home || ' ' || sh || ' X ' || sa || ' ' || away END AS scoreboard,
         CASE WHEN action = 'UNKNOWN' THEN NULL
              WHEN action = 'POINT' AND event_id % 31 = 0 THEN ''
              ELSE 'P' || user_id END AS player,
         CASE WHEN action = 'FOUL' THEN 'P' || (g + 12 * (1 - side))
              WHEN action = 'SUBSTITUTION' THEN 'P' || (g + 12 * (2 * (5 + event_id % 5) + side))
         END AS player2,
         CAST(CASE WHEN action = 'POINT' THEN CASE WHEN event_id % 7 = 0 THEN 3
              WHEN event_id % 7 = 1 THEN 2 ELSE 2 + event_id % 2 END END AS INTEGER) AS points,
         CASE WHEN action = 'POINT' AND event_id % 31 = 0 THEN ''
              WHEN action IN ('UNKNOWN', 'POINT', 'TURNOVER') THEN 'P' || user_id END AS subject
  FROM acts
), starts AS (
  SELECT * EXCLUDE (rn), (event_id + 1) * 8 + 1 AS "offset", home || ' X ' || away AS title
  FROM (SELECT *, row_number() OVER (PARTITION BY g, day ORDER BY ts, event_id) AS rn FROM base)
  WHERE rn = 1
), finals AS (
  SELECT * EXCLUDE (rn), (event_id + 1) * 8 + 6 AS "offset"
  FROM (SELECT *, row_number() OVER (PARTITION BY g, day ORDER BY ts DESC, event_id DESC) AS rn FROM base)
  WHERE rn = 1 AND (day + g) % 5 <> 4
), roster AS (
  SELECT s.season_id, s.game_key, s.match_seq, s.ts, s."partition", s."offset", s.title,
         CAST(sides.side AS INTEGER) AS team_pos, 'T' || (2 * s.g + sides.side) AS team,
         CASE WHEN k < 5 THEN 'starter' ELSE 'reserve' END AS slot,
         CAST(k % 5 AS INTEGER) AS pos, CAST(k AS INTEGER) AS k,
         'P' || (s.g + 12 * (2 * k + sides.side)) AS player
  FROM starts s, (SELECT unnest(range(2)) AS side) sides, (SELECT unnest(range(10)) AS k) ks
), seeds AS (
  SELECT season_id, 'T' || ((i * 7 + day) % 24) AS team, CAST(i AS INTEGER) AS seed
  FROM days, (SELECT unnest(range(24)) AS i) n WHERE day % 10 = 0
), info AS (
  SELECT d.season_id, '2025/2026' AS label,
         CAST(coalesce(arg_max(CASE WHEN d.day % 2 = 0 THEN (d.day % 10) // 2 + 1 END,
                               CASE WHEN d.day % 2 = 0 THEN d.day END), 0) AS INTEGER) AS current_round,
         bool_or(d.day % 10 = 9) AS season_ended
  FROM days d GROUP BY d.season_id
), scoring AS (
  SELECT * FROM plays WHERE action = 'POINT'
), season_points AS (
  SELECT season_id, player, CAST(sum(points) AS BIGINT) AS total
  FROM scoring WHERE player <> '' GROUP BY ALL
), games AS (
  SELECT season_id, player, count(*) AS games
  FROM (SELECT DISTINCT r.season_id, r.game_key, r.match_seq, r.player FROM roster r
        JOIN finals f USING (season_id, game_key, match_seq)) GROUP BY ALL
), play_odds AS (
  SELECT *, CASE WHEN NOT bad_line THEN 1 / p END AS oddsA,
         CASE WHEN NOT bad_line THEN 1 / (1 - p) END AS oddsB
  FROM (SELECT *, least(0.94::DOUBLE, greatest(0.06::DOUBLE, 1 / (1 + exp(-((sh - sa) *
          CAST(CASE quarter WHEN 1 THEN 0.025 WHEN 3 THEN 0.075 WHEN 4 THEN 0.1 ELSE 0.05 END AS DOUBLE)))))) AS p
        FROM plays)
), match_odds AS (
  SELECT season_id, game_key, match_seq,
         arg_max(coalesce(oddsA, 0), {O}) AS oa, arg_max(coalesce(oddsB, 0), {O}) AS ob
  FROM play_odds GROUP BY ALL
), live_state AS (
  SELECT season_id, game_key, match_seq, arg_max(bad, {O}) AS bad, max({O}) AS last_order,
         arg_max(home, {O}) AS home, arg_max(away, {O}) AS away,
         arg_max(sh, {O}) AS sh, arg_max(sa, {O}) AS sa,
         coalesce(arg_max(q, CASE WHEN q IS NOT NULL THEN {O} END), 0) AS quarter, min({O}) AS start_order
  FROM (SELECT season_id, game_key, match_seq, {ORDER}, bad_line AS bad, home, away, sh, sa, q FROM plays
        UNION ALL SELECT season_id, game_key, match_seq, {ORDER}, false, home, away, 0, 0, NULL FROM starts)
  GROUP BY ALL
), live AS (
  SELECT season_id, game_key, match_seq,
         CASE WHEN bad THEN '' ELSE home END AS home, CASE WHEN bad THEN '' ELSE away END AS away,
         CASE WHEN bad THEN 0 ELSE sh END AS home_score, CASE WHEN bad THEN 0 ELSE sa END AS away_score,
         quarter, start_order
  FROM live_state l
  WHERE match_seq = (SELECT max(m.match_seq) FROM live_state m
                     WHERE m.season_id = l.season_id AND m.game_key = l.game_key)
    AND NOT EXISTS (SELECT 1 FROM finals f WHERE f.season_id = l.season_id
                    AND f.game_key = l.game_key AND f.match_seq = l.match_seq)
), matchup_rows AS (
  SELECT s.season_id, s.game_key, s.match_seq, s.home, s.away, s.sh, s.sa, s.live, s.moment, o.oa, o.ob
  FROM (SELECT season_id, game_key, match_seq, any_value(home) AS home, any_value(away) AS away,
               arg_max(sh, {O}) AS sh, arg_max(sa, {O}) AS sa, max({O}) AS moment, true AS live
        FROM (SELECT season_id, game_key, match_seq, {ORDER}, home, away, sh, sa FROM plays WHERE NOT bad_line
              UNION ALL SELECT season_id, game_key, match_seq, {ORDER}, home, away, 0, 0 FROM starts)
        GROUP BY season_id, game_key, match_seq
        UNION ALL
        SELECT season_id, game_key, match_seq, home, away, sh, sa, {O}, false FROM finals) s
  LEFT JOIN match_odds o USING (season_id, game_key, match_seq)
), matchups AS (
  SELECT season_id, team, arg_max(sc, moment) AS team_score, round(arg_max(od, moment), 6) AS team_odds,
         arg_max(opp, moment) AS opponent, arg_max(osc, moment) AS opponent_score,
         round(arg_max(ood, moment), 6) AS opponent_odds, arg_max(live, moment) AS live
  FROM (SELECT season_id, home AS team, sh AS sc, oa AS od, away AS opp, sa AS osc, ob AS ood, live, moment FROM matchup_rows
        UNION ALL
        SELECT season_id, away, sa, ob, home, sh, oa, live, moment FROM matchup_rows)
  GROUP BY season_id, team
), season_results AS (
  SELECT season_id, team, count(*) FILTER (WHERE sc > op) AS win, count(*) FILTER (WHERE sc <= op) AS lose,
         CAST(sum(sc) AS BIGINT) AS point_made, CAST(sum(op) AS BIGINT) AS point_take
  FROM (SELECT season_id, home AS team, sh AS sc, sa AS op FROM finals
        UNION ALL SELECT season_id, away, sa, sh FROM finals) GROUP BY ALL
), standing AS (
  SELECT season_id, team, seed, coalesce(win, 0) AS win, coalesce(lose, 0) AS lose,
         coalesce(point_made, 0) AS point_made, coalesce(point_take, 0) AS point_take
  FROM seeds LEFT JOIN season_results USING (season_id, team)
), facts AS (
  SELECT season_id, {ORDER}, player, team, CAST(NULL AS INTEGER) AS quarter FROM roster
  UNION ALL
  SELECT season_id, {ORDER}, subject, team,
         CASE WHEN action = 'POINT' OR quarter > 0 THEN quarter END
  FROM plays WHERE subject <> ''
), context AS (
  SELECT season_id, player, arg_max(team, {O}) AS team,
         arg_max(quarter, CASE WHEN quarter IS NOT NULL THEN {O} END) AS quarter
  FROM facts GROUP BY ALL
), totals AS (
  SELECT p.season_id, p.player, coalesce(c.team, '—') AS team, p.total, coalesce(g.games, 0) AS games,
         CASE WHEN coalesce(g.games, 0) > 0 THEN floor(p.total * 10.0::DOUBLE / g.games + 0.5) / 10 ELSE 0 END AS average
  FROM season_points p LEFT JOIN games g USING (season_id, player) LEFT JOIN context c USING (season_id, player)
), box AS (
  SELECT season_id, game_key, match_seq, team, player,
         CAST(coalesce(sum(points), 0) AS BIGINT) AS points,
         count(*) FILTER (WHERE action = 'POINT') AS scoring_plays, count(*) FILTER (WHERE action = 'FOUL') AS fouls
  FROM plays WHERE action IN ('POINT', 'FOUL') AND player <> '' GROUP BY ALL
), subs AS (
  SELECT season_id, game_key, match_seq, team, user_id // 24 AS a, 5 + event_id % 5 AS b,
         row_number() OVER (PARTITION BY season_id, game_key, match_seq, team ORDER BY {ORDER}) AS rn
  FROM plays WHERE action = 'SUBSTITUTION' AND user_id // 24 < 10 AND user_id // 24 <> 5 + event_id % 5
), replay AS (
  SELECT DISTINCT season_id, game_key, match_seq, team, CAST(0 AS BIGINT) AS rn, range(10) AS places FROM roster
  UNION ALL
  SELECT r.season_id, r.game_key, r.match_seq, r.team, s.rn,
         CASE WHEN (r.places[s.a + 1] < 5) <> (r.places[s.b + 1] < 5)
              THEN [CASE WHEN i = s.a THEN r.places[s.b + 1] WHEN i = s.b THEN r.places[s.a + 1]
                    ELSE r.places[i + 1] END for i in range(10)]
              ELSE r.places END
  FROM replay r JOIN subs s ON s.season_id = r.season_id AND s.game_key = r.game_key
   AND s.match_seq = r.match_seq AND s.team = r.team AND s.rn = r.rn + 1
), lineup AS (
  SELECT r.season_id, r.game_key, r.match_seq, r.team, r.player, p.places[r.k + 1] AS place
  FROM roster r JOIN (SELECT season_id, game_key, match_seq, team, arg_max(places, rn) AS places
                      FROM replay GROUP BY ALL) p USING (season_id, game_key, match_seq, team)
), upd AS (
  SELECT * FROM (
    SELECT *, to_timestamp(epoch(ts) // 21600 * 21600)::TIMESTAMP AS window_start,
           CAST(sum(points) OVER (PARTITION BY player, epoch_us(ts) // 21600000000
                ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
    FROM scoring)
  WHERE total > 2
), together AS (
  SELECT *, count(*) OVER (PARTITION BY epoch_us(ts) // 3600000000 ORDER BY {ORDER}
                           ROWS UNBOUNDED PRECEDING) AS streaks
  FROM upd
), log AS (
  SELECT season_id, {ORDER}, 0 AS kind,
         'O ' || player || ' está pegando fogo! Fez ' || total || ' pontos em sequência!' AS message FROM upd
  UNION ALL
  SELECT season_id, {ORDER}, 1, streaks || ' jogadores em hot streak simultânea' FROM together WHERE streaks >= 2
), unquartered AS (
  SELECT season_id, ts, "partition", "offset", team, g, {O} AS asked FROM upd WHERE player <> '' AND quarter <= 0
), said AS (
  SELECT season_id, g, match_seq, {O} AS moment, bad_line AS bad, q, home, away, false AS over FROM plays
  UNION ALL SELECT season_id, g, match_seq, {O}, false, NULL, home, away, false FROM starts
  UNION ALL SELECT season_id, g, match_seq, {O}, NULL, NULL, home, away, true FROM finals
), then_match AS (
  SELECT u.season_id, u."partition", u."offset", u.team, s.match_seq, any_value(s.home) AS home, any_value(s.away) AS away,
         bool_or(s.over) AS over, arg_max(s.bad, CASE WHEN s.bad IS NOT NULL THEN s.moment END) AS bad,
         arg_max(s.q, CASE WHEN s.q IS NOT NULL THEN s.moment END) AS q
  FROM unquartered u JOIN said s ON s.season_id = u.season_id AND s.moment <= u.asked
   AND CAST(substr(u.team, 2) AS BIGINT) // 2 = s.g
  GROUP BY ALL
), then_live AS (
  SELECT season_id, "partition", "offset", coalesce(q, 0) AS quarter
  FROM (SELECT * FROM then_match
        QUALIFY match_seq = max(match_seq) OVER (PARTITION BY season_id, "partition", "offset"))
  WHERE NOT over AND NOT bad AND team IN (home, away)
), enriched AS (
  SELECT u.season_id, u.ts, u."partition", u."offset", u.player,
         CASE WHEN u.player = '' THEN '—' ELSE u.team END AS team,
         CASE WHEN u.player = '' THEN 0 WHEN u.quarter > 0 THEN u.quarter
              ELSE coalesce(l.quarter, 0) END AS quarter,
         CAST(CASE WHEN u.player = '' THEN 0 ELSE total END AS INTEGER) AS points
  FROM upd u LEFT JOIN then_live l USING (season_id, "partition", "offset")
), board AS (
  SELECT season_id, CAST(row_number() OVER (PARTITION BY season_id ORDER BY points DESC, player) AS INTEGER) AS rank,
         player, team, quarter, points
  FROM (SELECT season_id, player, arg_max(team, {O}) AS team, arg_max(quarter, {O}) AS quarter,
               arg_max(points, {O}) AS points FROM enriched GROUP BY ALL)
), spans AS (
  SELECT min(ts) AS s, max(ts) AS e FROM scoring WHERE player <> ''
  GROUP BY player, epoch_us(ts) // 21600000000 HAVING sum(points) > 2
), moments AS (
  SELECT ts, sum(o) AS o, sum(c) AS c
  FROM (SELECT s AS ts, 1 AS o, 0 AS c FROM spans UNION ALL SELECT e, 0, 1 FROM spans) GROUP BY ts
), swept AS (
  SELECT ts, sum(o) OVER w - sum(c) OVER w + c - o AS before, sum(o) OVER w - sum(c) OVER w + c AS moment
  FROM moments WINDOW w AS (ORDER BY ts ROWS UNBOUNDED PRECEDING)
), periods AS (
  SELECT ts, moment, sum(CASE WHEN before <= 2 THEN 1 ELSE 0 END) OVER (ORDER BY ts) AS period
  FROM swept WHERE moment > 2
)
""".replace("{ORDER}", ORDER).replace("{O}", O)

_ORDERS = """
WITH sides AS (
  SELECT o_orderkey, 'T' || (o_custkey % 24) AS home,
         'T' || ((o_custkey % 24 + 1 + o_orderkey % 23) % 24) AS away,
         CAST(80 + o_orderkey % 50 AS INTEGER) AS sh,
         CAST(80 + CAST(floor(o_totalprice) AS BIGINT) % 50 AS INTEGER) AS sa
  FROM orders
), outcomes AS (
  SELECT o_orderkey AS "offset", home AS team, sh AS score, sa AS op_score, sh > sa AS is_win FROM sides
  UNION ALL
  SELECT o_orderkey, away, sa, sh, sa > sh FROM sides
), stats AS (
  SELECT team, count(*) FILTER (WHERE is_win) AS win, count(*) FILTER (WHERE NOT is_win) AS lose,
         CAST(sum(score) AS BIGINT) AS point_made, CAST(sum(op_score) AS BIGINT) AS point_take
  FROM outcomes GROUP BY team
), lines AS (
  SELECT *, o_orderkey % 10 AS way FROM sides
)
"""

_PLAYERS = """
WITH players AS (
  SELECT c_custkey AS idx, c_name AS "Player", n_name AS "Team",
         ['C', 'PF', 'PG', 'SF', 'SG'][c_custkey % 5 + 1] AS "Pos", CAST(1 + c_custkey % 10 AS INTEGER) AS "Rank"
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)
"""


def _events(select: str) -> str:
    return _EVENTS + select.replace("{ORDER}", ORDER).replace("{O}", O).replace("{MATCH}", MATCH)


def _latest_odds(by: str) -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return (
        f"SELECT {keys}arg_max(home, {{O}}) AS \"teamA\", arg_max(away, {{O}}) AS \"teamB\", "
        "round(arg_max(coalesce(oddsA, 0), {O}), 6) AS \"oddsA\", "
        "round(arg_max(coalesce(oddsB, 0), {O}), 6) AS \"oddsB\" "
        f"FROM play_odds {group}"
    )


def _leaders(order: str) -> str:
    return (
        "SELECT season_id, CAST(rank AS INTEGER) AS rank, player, team, total, games, average{extra} FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY season_id ORDER BY {order}) AS rank "
        "FROM totals WHERE total > 0) WHERE rank <= 3"
    )


def _stream_window(seconds: int, table: str, keys: str, aggregates: str, having: str) -> str:
    us = seconds * 1_000_000
    return (
        f"SELECT {keys}make_timestamp(epoch_us(ts) // {us} * {us}) AS window_start, "
        f"make_timestamp((epoch_us(ts) // {us} + 1) * {us}) AS window_end, {aggregates} "
        f"FROM {table} GROUP BY {keys}epoch_us(ts) // {us} HAVING {having}"
    )


def _streaks(seconds: int, threshold: int) -> str:
    return _stream_window(
        seconds,
        "scoring",
        "player, ",
        "CAST(sum(points) AS BIGINT) AS points, min(ts) AS first_ts, max(ts) AS alert_ts",
        f"sum(points) > {threshold}",
    )


def _updates(seconds: int, threshold: int) -> str:
    us = seconds * 1_000_000
    return f"""SELECT {ORDER}, player, make_timestamp(w * {us}) AS window_start,
        make_timestamp((w + 1) * {us}) AS window_end, points, ts AS alert_ts FROM (
        SELECT {ORDER}, player, epoch_us(ts) // {us} AS w, CAST(sum(points) OVER (
          PARTITION BY player, epoch_us(ts) // {us} ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS points
        FROM scoring) WHERE points > {threshold}"""


def _pick(weight: str) -> str:
    hashed = "('0x' || substr(md5(\"Player\" || '|11'), 1, 13))::BIGINT"
    return _PLAYERS + f"""
SELECT "Team", arg_min(idx, d) AS idx, arg_min("Player", d) AS "Player", arg_min("Pos", d) AS "Pos",
       arg_min("Rank", d) AS "Rank"
FROM (SELECT *, -ln(({hashed} + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / {weight} AS d FROM players)
GROUP BY "Team" """


def _schedule(n: int, seed: int) -> str:
    # The plain rotation: team 0 stays, the others move one place per round.
    m = n + n % 2
    return _PLAYERS + f"""
, picked AS (
  SELECT row_number() OVER (ORDER BY md5("Team" || '|{seed}')) - 1 AS idx, "Team" AS team
  FROM (SELECT DISTINCT "Team" FROM players) ORDER BY md5("Team" || '|{seed}') LIMIT {n}
), turns AS (
  SELECT r, p, CASE WHEN p = 0 THEN 0 ELSE ((p - 1 - r) % {m - 1} + {m - 1}) % {m - 1} + 1 END AS t
  FROM (SELECT unnest(range({m - 1})) AS r), (SELECT unnest(range({m})) AS p)
)
SELECT CAST(a.r + 1 AS INTEGER) AS round, CAST(a.p AS INTEGER) AS slot, h.team AS home, v.team AS away
FROM turns a JOIN turns b ON b.r = a.r AND b.p = {m - 1} - a.p
JOIN picked h ON h.idx = a.t JOIN picked v ON v.idx = b.t
WHERE a.p < {m // 2}"""


_SCORES = "CASE WHEN way IN ({ok}) THEN sh END AS home_score, CASE WHEN way IN ({ok}) THEN sa END AS away_score"

ORACLE: dict[str, str] = {
    # Messages
    "plays": _events(
        "SELECT game_key, {ORDER}, quarter, team, scoreboard, action, player, player2, points, subject FROM plays"
    ),
    "scoring_plays": _events("SELECT game_key, {ORDER}, team, quarter, player, points FROM scoring"),
    "rosters": _events(
        "SELECT game_key, {ORDER}, title, team_pos, team, slot, pos, player FROM roster"
    ),
    "match_ends": _events(
        "SELECT game_key, {ORDER}, home || ' ' || sh || ' X ' || sa || ' ' || away AS final_scoreboard FROM finals"
    ),
    "control": _events(
        """SELECT 'unknown' AS game_key, make_timestamp(day * 86400000000) AS ts, CAST(0 AS INTEGER) AS "partition",
             CAST(0 AS BIGINT) AS "offset", 'SEASON_START' AS tipo, CAST(NULL AS INTEGER) AS round,
             (SELECT string_agg('T' || ((i * 7 + day) % 24), ',' ORDER BY i) FROM (SELECT unnest(range(24)) AS i)) AS teams
           FROM days WHERE day % 10 = 0
           UNION ALL
           SELECT 'unknown', make_timestamp(day * 86400000000), 0, 1, 'RODADA_INICIO',
             CAST((day % 10) // 2 + 1 AS INTEGER), NULL FROM days WHERE day % 2 = 0
           UNION ALL
           SELECT 'unknown', make_timestamp(day * 86400000000 + 86399999999), 0, 3, 'SEASON_END', NULL, NULL
           FROM days WHERE day % 10 = 9"""
    ),
    "quarantine": _events(
        """SELECT "partition", (event_id + 1) * 8 + 5 AS "offset",
             CASE (event_id // 41) % 4 WHEN 0 THEN '{"tipo":"EVENTO"' WHEN 2 THEN '{"tipo":"PAUSA"}' WHEN 3 THEN '[1]' END AS value,
             CASE (event_id // 41) % 4 WHEN 0 THEN 'malformed' WHEN 1 THEN 'empty' WHEN 2 THEN 'unknown kind' ELSE 'not an object' END AS reason
           FROM base WHERE event_id % 41 = 0 AND event_type = 'error'"""
    ),
    # Score lines
    "scoreboard_wide": _ORDERS
    + "SELECT o_orderkey, CASE WHEN way IN (0,1,2,7,8) THEN home WHEN way = 3 THEN 'LA ' || home END AS home, "
    + _SCORES.format(ok="0,1,2,3,7,8")
    + ", CASE WHEN way IN (0,1,2,3,7) THEN away WHEN way = 8 THEN away || ' X extra' END AS away FROM lines",
    "scoreboard_strict": _ORDERS
    + "SELECT o_orderkey, CASE WHEN way IN (0,1,2,7) THEN home END AS home, "
    + _SCORES.format(ok="0,1,2,7")
    + ", CASE WHEN way IN (0,1,2,7) THEN away END AS away FROM lines",
    "scoreboard_dashboard": _ORDERS
    + "SELECT o_orderkey, CASE WHEN way IN (0,1,2,6,7) THEN home ELSE '' END AS home, "
    "CASE WHEN way IN (0,1,2,7) THEN sh ELSE 0 END AS home_score, CASE WHEN way IN (0,1,2,7) THEN sa ELSE 0 END AS away_score, "
    "CASE WHEN way IN (0,1,2,6,7) THEN away ELSE '' END AS away FROM lines",
    "scoreboard_odds": _ORDERS
    + "SELECT o_orderkey, CASE WHEN way IN (0,1,2,5,8) THEN home WHEN way = 3 THEN 'LA' WHEN way = 7 THEN '' END AS home, "
    + _SCORES.format(ok="0,1,2,8")
    + ", CASE WHEN way IN (0,1,2,3,5,8) THEN away WHEN way = 7 THEN '' END AS away FROM lines",
    "title_parse": _ORDERS
    + """SELECT o_orderkey, CASE WHEN way IN (0,1,2,8) THEN home || ' ' || sh WHEN way = 3 THEN 'LA ' || home || ' ' || sh
           WHEN way = 5 THEN home || ' x' WHEN way = 6 THEN home WHEN way = 7 THEN home || '  ' || sh END AS home,
           CASE WHEN way IN (0,1,2,3,5) THEN sa || ' ' || away WHEN way = 6 THEN away WHEN way = 7 THEN sa || '  ' || away
           WHEN way = 8 THEN sa || ' ' || away || ' X extra' END AS away FROM lines""",
    "match_teams": _events("SELECT {MATCH}, title, home, away FROM starts"),
    # Results of finals
    "match_outcomes": _ORDERS + "SELECT * FROM outcomes",
    "match_results": _ORDERS
    + "SELECT team, CASE WHEN is_win THEN 'win' ELSE 'lose' END AS result, count(*) AS matches FROM outcomes GROUP BY ALL",
    "team_stats": _ORDERS + "SELECT * FROM stats",
    "team_averages": _ORDERS
    + """SELECT *, win + lose AS games, floor(point_made * 10.0::DOUBLE / (win + lose) + 0.5) / 10 AS avg_made,
           floor(point_take * 10.0::DOUBLE / (win + lose) + 0.5) / 10 AS avg_take FROM stats""",
    "team_stats_topic": _ORDERS
    + """SELECT team AS key, '{"win":' || win || ',"lose":' || lose || ',"point_made":' || point_made
           || ',"point_take":' || point_take || '}' AS value FROM stats""",
    # Seasons and matches
    "season_markers": _events(
        "SELECT season_id, make_timestamp(day * 86400000000) AS ts, CAST(24 AS INTEGER) AS n_teams FROM days WHERE day % 10 = 0"
    ),
    "match_segments": _events('SELECT "partition", "offset", {MATCH} FROM plays'),
    "season_segments_by_buckets": _events(
        """SELECT season_id, tipo, count(*) AS messages FROM (
             SELECT season_id, 'EVENTO' AS tipo FROM plays UNION ALL SELECT season_id, 'INICIO' FROM starts
             UNION ALL SELECT season_id, 'FINAL' FROM finals
             UNION ALL SELECT season_id, 'SEASON_START' FROM days WHERE day % 10 = 0
             UNION ALL SELECT season_id, 'RODADA_INICIO' FROM days WHERE day % 2 = 0
             UNION ALL SELECT season_id, 'RODADA_FIM' FROM days WHERE day % 2 = 1
             UNION ALL SELECT season_id, 'SEASON_END' FROM days WHERE day % 10 = 9) GROUP BY ALL"""
    ),
    "seed_order": _events("SELECT * FROM seeds"),
    "seed_order_shuffled": _events(
        "SELECT season_id, team, CAST(row_number() OVER (PARTITION BY season_id ORDER BY md5(team || '|7')) - 1 AS INTEGER) AS seed FROM seeds"
    ),
    "season_info": _events("SELECT * FROM info"),
    # Totals
    "player_points": _events("SELECT player, CAST(sum(points) AS BIGINT) AS total FROM scoring GROUP BY ALL"),
    "player_points_topic": _events(
        """SELECT player AS key, upper(format('{:08x}', total)) AS int32_hex, upper(format('{:016x}', total)) AS int64_hex,
             CAST(total AS INTEGER) AS int32, total AS int64
           FROM (SELECT player, CAST(sum(points) AS BIGINT) AS total FROM scoring GROUP BY ALL)"""
    ),
    "season_player_points": _events("SELECT * FROM season_points"),
    "player_fouls": _events(
        "SELECT season_id, player, count(*) AS fouls FROM plays WHERE action = 'FOUL' GROUP BY ALL"
    ),
    "match_players": _events("SELECT DISTINCT {MATCH}, player FROM roster"),
    "games_played": _events("SELECT * FROM games"),
    "player_season_averages": _events(
        """SELECT season_id, player, coalesce(total, 0) AS total, coalesce(fouls, 0) AS fouls, coalesce(games, 0) AS games,
             CASE WHEN coalesce(games, 0) > 0 THEN floor(coalesce(total, 0) * 10.0::DOUBLE / games + 0.5) / 10 ELSE 0 END AS avg_points,
             CASE WHEN coalesce(games, 0) > 0 THEN floor(coalesce(fouls, 0) * 10.0::DOUBLE / games + 0.5) / 10 ELSE 0 END AS avg_fouls
           FROM season_points FULL JOIN (SELECT season_id, player, count(*) AS fouls FROM plays
             WHERE action = 'FOUL' GROUP BY ALL) USING (season_id, player) LEFT JOIN games USING (season_id, player)"""
    ),
    "box_score": _events("SELECT * FROM box"),
    "turnovers": _events(
        "SELECT {MATCH}, count(*) FILTER (WHERE action = 'TURNOVER') AS turnovers FROM plays GROUP BY ALL"
    ),
    # Odds
    "odds": _events(
        'SELECT game_key, {ORDER}, home AS "teamA", away AS "teamB", round(oddsA, 6) AS "oddsA", round(oddsB, 6) AS "oddsB" FROM play_odds'
    ),
    "odds_topic": _events(
        'SELECT game_key AS key, "offset", bad_line AS has_null, home AS "teamA", away AS "teamB", round(oddsA, 6) AS "oddsA", round(oddsB, 6) AS "oddsB" FROM play_odds'
    ),
    "win_probabilities": _ORDERS
    + """SELECT "offset", team, diff, quarter, round(p, 6) AS p, round(b, 6) AS bounded, round(1 / b, 6) AS odds FROM (
           SELECT *, least(0.94::DOUBLE, greatest(0.06::DOUBLE, p)) AS b FROM (
             SELECT *, 1 / (1 + exp(-(diff * CAST(CASE quarter WHEN 1 THEN 0.025 WHEN 3 THEN 0.075 WHEN 4 THEN 0.1 ELSE 0.05 END AS DOUBLE)))) AS p
             FROM (SELECT "offset", team, score - op_score AS diff, CAST("offset" % 6 AS INTEGER) AS quarter FROM outcomes)))""",
    "latest_odds": _events(_latest_odds("")),
    "latest_odds_by_game": _events(_latest_odds("game_key")),
    "open_game_odds": _events(
        _latest_odds("{MATCH}").replace(
            "FROM play_odds",
            "FROM (SELECT * FROM play_odds p WHERE NOT EXISTS (SELECT 1 FROM finals f WHERE f.season_id = p.season_id "
            "AND f.game_key = p.game_key AND f.match_seq = p.match_seq))",
        )
    ),
    # Latest values
    "live_matches": _events(
        "SELECT {MATCH}, home, away, home_score, away_score, quarter FROM live"
    ),
    "team_matchups": _events("SELECT * FROM matchups"),
    "player_context": _events("SELECT * FROM context"),
    "match_scores": _events(
        """SELECT season_id, game_key, match_seq, CASE WHEN s IS NULL THEN NULL ELSE home END AS home,
             coalesce(s.sh, 0) AS home_score, coalesce(s.sa, 0) AS away_score,
             CASE WHEN s IS NULL THEN NULL ELSE away END AS away, coalesce(quarter, -1) AS quarter, ended
           FROM (SELECT season_id, game_key, match_seq, any_value(home) AS home, any_value(away) AS away,
             arg_max(struct_pack(sh, sa), CASE WHEN NOT bad THEN {O} END) AS s,
             arg_max(q, CASE WHEN q > 0 THEN {O} END) AS quarter, bool_or(fin) AS ended
           FROM (SELECT season_id, game_key, match_seq, {ORDER}, home, away, sh, sa, bad_line AS bad, q, false AS fin FROM plays
                 UNION ALL SELECT season_id, game_key, match_seq, {ORDER}, home, away, sh, sa, false, NULL, true FROM finals)
           GROUP BY season_id, game_key, match_seq)"""
    ),
    "match_lineups": _events(
        """SELECT {MATCH}, team, CASE WHEN place < 5 THEN 'starter' ELSE 'reserve' END AS slot,
             CAST(place % 5 AS INTEGER) AS pos, player FROM lineup"""
    ),
    # Board and report
    "top_scorers": _events(
        """SELECT {MATCH}, team, CAST(rank AS INTEGER) AS rank, player, points FROM (
             SELECT *, row_number() OVER (PARTITION BY season_id, game_key, match_seq, team ORDER BY points DESC, player) AS rank
             FROM box WHERE points > 0) WHERE rank <= 3"""
    ),
    "match_report": _events(
        """SELECT {MATCH}, team, CASE WHEN place < 5 THEN 'starter' ELSE 'reserve' END AS slot,
             CAST(place % 5 AS INTEGER) AS pos, player, coalesce(points, 0) AS points, coalesce(fouls, 0) AS fouls,
             CAST(row_number() OVER (PARTITION BY season_id, game_key, match_seq, team ORDER BY coalesce(points, 0) DESC, place) AS INTEGER) AS line,
             CASE WHEN length(player) > 4 THEN left(player, 1) || '...' ELSE player END AS label
           FROM lineup LEFT JOIN box USING (season_id, game_key, match_seq, team, player)"""
    ),
    "match_board": _events(
        """SELECT s.season_id, s.game_key, s.match_seq, s.home, coalesce(v.s.sh, 0) AS home_score,
             coalesce(v.s.sa, 0) AS away_score, s.away, coalesce(v.quarter, -1) AS quarter,
             coalesce(v.ended, false) AS ended, coalesce(v.turnovers, 0) AS turnovers,
             round(o.oa, 6) AS "oddsA", round(o.ob, 6) AS "oddsB"
           FROM starts s LEFT JOIN (
             SELECT season_id, game_key, match_seq, arg_max(struct_pack(sh, sa), CASE WHEN NOT bad THEN {O} END) AS s,
               arg_max(q, CASE WHEN q > 0 THEN {O} END) AS quarter, bool_or(fin) AS ended, sum(t)::BIGINT AS turnovers
             FROM (SELECT season_id, game_key, match_seq, {ORDER}, sh, sa, bad_line AS bad, q, false AS fin,
                     CASE WHEN action = 'TURNOVER' THEN 1 ELSE 0 END AS t FROM plays
                   UNION ALL SELECT season_id, game_key, match_seq, {ORDER}, sh, sa, false, NULL, true, 0 FROM finals)
             GROUP BY season_id, game_key, match_seq) v USING (season_id, game_key, match_seq)
           LEFT JOIN match_odds o USING (season_id, game_key, match_seq)"""
    ),
    # Streaks
    "hot_streaks": _events(_streaks(5, 2)),
    "hot_streaks_long_window": _events(_streaks(21600, 5)),
    "hot_streaks_by_stream_time": _events(
        _streaks(21600, 2).replace(
            "FROM scoring",
            """FROM (SELECT * FROM (SELECT *, max(epoch_us(ts)) OVER (PARTITION BY "partition"
                 ORDER BY "offset" + "offset" * 7919 % 4001, "offset" ROWS UNBOUNDED PRECEDING) AS clock
                 FROM scoring WHERE player IS NOT NULL)
               WHERE (epoch_us(ts) // 21600000000 + 1) * 21600000000 > clock)""",
        )
    ),
    "hot_streak_updates": _events(_updates(5, 2)),
    "hot_streak_updates_long_window": _events(_updates(21600, 2)),
    "alert_messages": _events(
        """SELECT "partition", "offset", player,
             'O ' || player || ' está pegando fogo! Fez ' || total || ' pontos em sequência!' AS message,
             player AS read_player, CAST(CASE WHEN player = '' THEN 0 ELSE total END AS INTEGER) AS read_points FROM upd"""
    ),
    "simultaneous_streaks": _events(
        _stream_window(3600, "upd", "", "count(*) AS streaks", "count(*) >= 2")
    ),
    "simultaneous_streaks_by_player": _events(
        _stream_window(3600, "upd", "", "count(DISTINCT player) AS streaks", "count(DISTINCT player) >= 2")
    ),
    "simultaneous_streak_updates": _events(
        """SELECT {ORDER}, ts AS alert_ts, make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS window_start,
             make_timestamp((epoch_us(ts) // 3600000000 + 1) * 3600000000) AS window_end, streaks
           FROM together WHERE streaks >= 2"""
    ),
    "enriched_alerts": _events(
        """SELECT season_id, "partition", "offset", player, team, quarter,
             CASE WHEN quarter <= 0 THEN 'Ao vivo' ELSE quarter || 'º Q' END AS quarter_label, points FROM enriched"""
    ),
    "hot_streak_board": _events("SELECT * FROM board WHERE rank <= 5"),
    "alert_log": _events(
        """SELECT season_id, CAST(position AS INTEGER) AS position, ts, message FROM (
             SELECT *, row_number() OVER (PARTITION BY season_id ORDER BY ts DESC, "partition" DESC, "offset" DESC, kind DESC, message DESC) AS position
             FROM log) WHERE position <= 50"""
    ),
    "streak_overlaps": _events(
        "SELECT min(ts) AS start_ts, max(ts) AS end_ts, CAST(max(moment) AS BIGINT) AS max_players FROM periods GROUP BY period"
    ),
    "streak_relations": _events(
        """SELECT CASE WHEN s = ds AND e = de THEN 'equals' WHEN s = ds THEN 'starts' WHEN e = de THEN 'finishes'
                       ELSE 'during' END AS relation, count(*) AS streaks
           FROM (SELECT player, epoch_us(min(ts)) // 86400000000 AS d, min(ts) AS s, max(ts) AS e FROM scoring
                 WHERE player IS NOT NULL GROUP BY player, epoch_us(ts) // 21600000000 HAVING sum(points) > 2)
           JOIN (SELECT player, epoch_us(min(ts)) // 86400000000 AS d, min(ts) AS ds, max(ts) AS de FROM scoring
                 WHERE player IS NOT NULL GROUP BY player, epoch_us(ts) // 86400000000 HAVING sum(points) > 2)
           USING (player, d) GROUP BY ALL"""
    ),
    # Standings, ranking, leaders
    "season_standings": _events("SELECT * FROM standing"),
    "all_time_standings": _events(
        """SELECT s.season_id, s.team, s.seed, coalesce(t.win, 0) AS win, coalesce(t.lose, 0) AS lose,
             coalesce(t.point_made, 0) AS point_made, coalesce(t.point_take, 0) AS point_take
           FROM seeds s LEFT JOIN (
             SELECT team, CAST(sum(win) AS BIGINT) AS win, CAST(sum(lose) AS BIGINT) AS lose,
               CAST(sum(point_made) AS BIGINT) AS point_made, CAST(sum(point_take) AS BIGINT) AS point_take
             FROM season_results GROUP BY team
             HAVING max(season_id) = (SELECT max(season_id) FROM seeds)) t USING (team)
           WHERE s.season_id = (SELECT max(season_id) FROM seeds)"""
    ),
    "season_team_stats": _ORDERS
    + """SELECT * FROM stats JOIN (
           SELECT season_id, 'T' || ((i * 7 + day) % 24) AS team FROM (SELECT unnest(range(24)) AS i),
             (SELECT day, row_number() OVER (ORDER BY day) AS season_id
              FROM (SELECT DISTINCT epoch_us(ts) // 86400000000 AS day FROM events) WHERE day % 10 = 0)) USING (team)""",
    "ranking": _events(
        """SELECT s.season_id, s.team, CAST(row_number() OVER (PARTITION BY s.season_id ORDER BY win DESC, seed) AS INTEGER) AS rank,
             CASE WHEN CAST(substr(s.team, 2) AS INTEGER) % 2 = 0 THEN 'Team ' || substr(s.team, 2) ELSE s.team END AS team_name,
             win * 3 AS points, win AS wins, lose AS losses, m.team_score, m.team_odds, m.opponent, m.opponent_score,
             m.opponent_odds, m.live,
             CASE WHEN m.team_odds IS NULL THEN '' ELSE printf('%.2f', m.team_odds) END AS odds_label
           FROM standing s LEFT JOIN matchups m USING (season_id, team)"""
    ),
    "player_totals": _events("SELECT * FROM totals"),
    "player_leaders": _events(
        _leaders("total DESC, average DESC, player").replace(
            "{extra}",
            ", CASE WHEN games <= 0 THEN '—' ELSE printf('%.1f méd', average) END AS label",
        )
    ),
    "player_leaders_as_coded": _events(
        _leaders("total, average DESC, player").replace("{extra}", "")
    ),
    "snapshot_maps": _events("SELECT * FROM season_points"),
    "standings_maps": _events(
        "SELECT season_id, team AS key, team, win, lose, point_made, point_take FROM standing"
    ),
    "dashboard_summary": _events(
        """SELECT i.season_id, i.current_round, i.season_ended, coalesce(t.n, 0) AS teams,
             t.first_team, l.first_player, CAST(0 AS BIGINT) AS assist_leaders, b.player AS hottest_player,
             coalesce(v.n, 0) AS live, coalesce(p.n, 0) AS players, coalesce(p.points, 0) AS points,
             coalesce(t.n, 0) AS standings, o."teamA" AS odds_team, coalesce(a.n, 0) AS n_alerts, a.newest AS newest_alert
           FROM info i
           LEFT JOIN (SELECT season_id, count(*) AS n, arg_min(team, struct_pack(a := -win, b := seed)) AS first_team FROM standing GROUP BY ALL) t USING (season_id)
           LEFT JOIN (SELECT season_id, arg_min(player, struct_pack(a := -total, b := -average, c := player)) AS first_player FROM totals WHERE total > 0 GROUP BY ALL) l USING (season_id)
           LEFT JOIN (SELECT season_id, player FROM board WHERE rank = 1) b USING (season_id)
           LEFT JOIN (SELECT season_id, count(*) AS n FROM live GROUP BY ALL) v USING (season_id)
           LEFT JOIN (SELECT season_id, count(*) AS n, CAST(sum(total) AS BIGINT) AS points FROM season_points GROUP BY ALL) p USING (season_id)
           LEFT JOIN (SELECT season_id, arg_max(home, {O}) AS "teamA" FROM plays GROUP BY ALL) o USING (season_id)
           LEFT JOIN (SELECT season_id, least(count(*), 50) AS n,
                        arg_max(message, struct_pack(a := ts, b := "partition", c := "offset", d := kind)) AS newest
                      FROM log GROUP BY ALL) a USING (season_id)"""
    ),
    # Player lists
    "list_teams": _PLAYERS + 'SELECT DISTINCT "Team" FROM players',
    "starters": _PLAYERS
    + """SELECT idx, "Player", "Team", "Pos", "Rank",
           CASE WHEN row_number() OVER (PARTITION BY "Team" ORDER BY idx) <= 5 THEN 'starter' ELSE 'reserve' END AS slot FROM players""",
    "sample_teams": _PLAYERS
    + """SELECT CAST(row_number() OVER (ORDER BY md5("Team" || '|3')) - 1 AS INTEGER) AS idx, "Team" AS team
         FROM (SELECT DISTINCT "Team" FROM players) ORDER BY idx LIMIT 6""",
    "round_robin": _schedule(6, 3),
    "round_robin_odd": _schedule(7, 5),
    "weighted_pick_equal": _pick("1"),
    "weighted_pick_min": _pick('(11 - "Rank")'),
    "weighted_pick_max": _pick('"Rank"'),
    # Streams, run to the end: the same as in batch
    "stream_hot_streaks": _events(_streaks(21600, 2)),
    "stream_hot_streak_updates": _events(
        """SELECT player, make_timestamp(epoch_us(ts) // 21600000000 * 21600000000) AS window_start, total AS points,
             ts AS alert_ts, "partition", "offset",
             'O ' || player || ' está pegando fogo! Fez ' || total || ' pontos em sequência!' AS message FROM upd"""
    ),
    "stream_live_matches": _events(
        """SELECT game_key, home, away, home_score, away_score, quarter FROM live l
           WHERE match_seq = (SELECT max(s.match_seq) FROM starts s WHERE s.game_key = l.game_key)"""
    ),
    "stream_open_odds": _events(
        _latest_odds("game_key").replace(
            "FROM play_odds",
            "FROM (SELECT * FROM play_odds p WHERE match_seq = (SELECT max(s.match_seq) FROM starts s "
            "WHERE s.game_key = p.game_key) AND NOT EXISTS (SELECT 1 FROM finals f WHERE f.game_key = p.game_key "
            "AND f.match_seq = p.match_seq))",
        )
    ),
    "stream_simultaneous_streaks": _events(
        _stream_window(3600, "upd", "", "count(*) AS streaks", "count(*) >= 2")
    ),
}

for _same in ("player_points", "team_stats", "odds"):
    ORACLE[f"stream_{_same}"] = ORACLE[_same]
ORACLE["compacted_player_points"] = ORACLE["player_points"]
for _now in ("season_info", "ranking", "player_leaders", "hot_streak_board"):
    _body = ORACLE[_now].removeprefix(_EVENTS)
    ORACLE[f"{_now}_now"] = _events(
        f"SELECT * FROM ({_body}) WHERE season_id = (SELECT max(season_id) FROM info)"
    )

ORACLE["simultaneous_topic"] = _events(
    """SELECT 'HOTSTREAK' AS key, lpad(hex(streaks), 16, '0') AS int64_hex, count(*) AS records
       FROM (SELECT count(*) AS streaks FROM upd GROUP BY epoch_us(ts) // 3600000000 HAVING count(*) >= 2) GROUP BY streaks"""
)
ORACLE["alert_topic"] = _events(
    """SELECT player AS key, 'O ' || player || ' está pegando fogo! Fez ' || total || ' pontos em sequência!' AS message FROM upd"""
)
