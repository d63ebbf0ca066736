"""DuckDB SQL equal to each registered query, over the raw driver tables.

Each statement defines the fixture views it needs as CTEs.  Half-up averages are
computed in integers so they do not depend on float rounding of either engine.
"""

from __future__ import annotations

EPOCH = "CAST(epoch_us({c}) // 1000000 AS INTEGER)"

V_RATINGS = f"""ratings AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS uid, CAST(l.l_partkey AS INTEGER) AS mid,
         CAST(ceil(l.l_quantity / 10) AS DOUBLE) AS score, {EPOCH.format(c='o.o_orderdate')} AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

V_MOVIES = """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
         concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres
  FROM part)"""

V_TAGS = f"""tags AS (
  SELECT CAST(user_id AS INTEGER) AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         event_type AS tag, {EPOCH.format(c='ts')} AS "timestamp"
  FROM events)"""

V_EVENT_RATINGS = f"""event_ratings AS (
  SELECT CAST(user_id AS INTEGER) AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         CAST(least(5, greatest(0.5, ceil(value / 10) / 2)) AS DOUBLE) AS score, {EPOCH.format(c='ts')} AS "timestamp"
  FROM events)"""


V_VECTORS = """item_vectors AS (
  SELECT CAST(vec_id AS INTEGER) AS mid, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)"""


def v_edges(t: float, name: str = "edges") -> str:
    """Ordered pairs of different items with cosine (rounded to 6) above t."""
    return f"""{name} AS (
  SELECT mid, rid, r FROM (
    SELECT a.mid, b.mid AS rid, round(list_cosine_similarity(a.features, b.features), 6) AS r
    FROM item_vectors a JOIN item_vectors b ON a.mid <> b.mid)
  WHERE r > {t} AND NOT isnan(r))"""


def v_factors(rank: int = 64, scale: float = 1.0, name: str = "factors") -> str:
    """Fixed factors of ids as items (v) and users (u)."""
    return f"""{name} AS (
  SELECT id, v, list_reverse(v) AS u FROM (
    SELECT CAST(vec_id AS INTEGER) AS id, list_transform(embedding[1:{rank}], lambda x: floor(CAST(x AS DOUBLE) * 16) * {scale}) AS v
    FROM embeddings))"""


V_PREDICTIONS = """predictions AS (
  SELECT r.*, list_inner_product(a.u, b.v) AS prediction
  FROM ratings r JOIN factors a ON a.id = r.uid JOIN factors b ON b.id = r.mid)"""


V_TRIGGERS = """triggers AS (
  SELECT uid, mid FROM (
    SELECT uid, mid, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC) AS pos
    FROM event_ratings) WHERE pos = 1)"""

V_RECENTS = """recents AS (
  SELECT uid, mid, score, "timestamp", CAST(pos AS INTEGER) AS pos FROM (
    SELECT *, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC) AS pos
    FROM event_ratings) WHERE pos <= 21)"""

V_RATED = "rated AS (SELECT DISTINCT uid, mid FROM event_ratings)"

V_UNRATED = """unrated AS (
  SELECT t.uid, t.mid, e.rid, e.r FROM triggers t JOIN edges e ON t.mid = e.mid
  WHERE NOT EXISTS (SELECT 1 FROM rated x WHERE x.uid = t.uid AND x.mid = e.rid))"""

V_CANDIDATES = """candidates AS (
  SELECT uid, mid, rid, r, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY r DESC, rid) AS rank FROM unrated)
  WHERE rank <= 20)"""


CUT_FIRST = """SELECT uid, mid, rid, r, CAST(rank AS INTEGER) AS rank FROM (
  SELECT t.uid, t.mid, e.rid, e.r, row_number() OVER (PARTITION BY t.uid, t.mid ORDER BY e.r DESC, e.rid) AS rank
  FROM triggers t JOIN edges e ON t.mid = e.mid) top
WHERE rank <= 20 AND NOT EXISTS (SELECT 1 FROM rated x WHERE x.uid = top.uid AND x.mid = top.rid)"""


def v_rerank(name: str, up: str) -> str:
    return f"""{name} AS (
  SELECT c.uid, c.cand AS mid,
         floor(CAST(sum(CAST(round(e.r * 1000000) AS BIGINT) * CAST(round(rc.score * 10000) AS BIGINT)) AS DOUBLE)
               / CAST(10000 * count(*) AS DOUBLE)
               + (log2(greatest(count_if({up}), 1)) - log2(greatest(count_if(NOT ({up})), 1))) * 1000000 + 0.5) / 1000000 AS score
  FROM (SELECT DISTINCT uid, rid AS cand FROM candidates) c
  JOIN recents rc ON c.uid = rc.uid
  JOIN edges e ON e.mid = c.cand AND e.rid = rc.mid
  WHERE e.r > 0.2
  GROUP BY c.uid, c.cand)"""


ONLINE = [V_EVENT_RATINGS, V_VECTORS, v_edges(0.2), V_TRIGGERS, V_RECENTS, V_RATED, V_UNRATED, V_CANDIDATES]


def java_double(x: str) -> str:
    """SQL text of a DOUBLE as Spark (Java) prints it, for |x| < 1e7.

    Java switches to ``d.dddE-n`` below 1e-3 (DuckDB only below 1e-4, as ``d.dde-05``)
    and always keeps a digit after the point (``1.0E-6``).  Built from DuckDB's own
    shortest digits, so no float arithmetic is involved.
    """
    a = f"abs({x})"
    s = f"CAST({a} AS VARCHAR)"
    sign = f"CASE WHEN {x} < 0 THEN '-' ELSE '' END"
    mant = f"split_part({s}, 'e', 1)"
    sci = (f"CASE WHEN contains({mant}, '.') THEN {mant} ELSE {mant} || '.0' END"
           f" || 'E' || CAST(CAST(split_part({s}, 'e', 2) AS INTEGER) AS VARCHAR)")
    frac = f"substr({s}, 3)"  # digits after '0.'
    digits = f"ltrim({frac}, '0')"
    plain = (f"substr({digits}, 1, 1) || '.' || CASE WHEN length({digits}) > 1 THEN substr({digits}, 2) ELSE '0' END"
             f" || 'E' || CAST(-(length({frac}) - length({digits}) + 1) AS VARCHAR)")
    return (f"CASE WHEN {x} <> 0 AND {a} < 0.001 THEN {sign} || CASE WHEN contains({s}, 'e') THEN {sci} ELSE {plain} END "
            f"ELSE CAST({x} AS VARCHAR) END")


def pack(view: str, key: str, rid: str, r: str, order: str) -> str:
    return (f"SELECT {key}, string_agg(CAST({rid} AS VARCHAR) || ':' || {java_double(r)}, '|' ORDER BY {order}) AS recs "
            f"FROM {view} GROUP BY {key}")


def merged(dedupe: bool, order: str, only_existing: bool) -> str:
    old_filter = "" if only_existing else ""
    new_filter = "WHERE uid IN (SELECT uid FROM rerank_ge)" if only_existing else ""
    dd = ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid, rid ORDER BY nw DESC, r DESC) AS d FROM both_lists) WHERE d = 1"
          if dedupe else "SELECT * FROM both_lists")
    return f""",
new_rows AS (SELECT uid, mid AS rid, score AS r, 1 AS nw FROM rerank {new_filter}),
old_rows AS (SELECT uid, mid AS rid, score AS r, 0 AS nw FROM rerank_ge WHERE uid IN (SELECT uid FROM new_rows) {old_filter}),
both_lists AS (SELECT * FROM old_rows UNION ALL SELECT * FROM new_rows),
kept AS ({dd}),
ranked_lists AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY {order}, rid) AS rank FROM kept)
""" + pack("(SELECT * FROM ranked_lists WHERE rank <= 20)", "uid", "rid", "r", "rank")


def half_up_avg(score: str = "score", places: int = 2) -> str:
    """Exact half-up of avg(score) for scores on a 0.5 grid, as a DOUBLE."""
    m = 10**places
    return (f"CAST(({m} * CAST(sum(2 * {score}) AS BIGINT) + count({score})) // (2 * count({score})) AS DOUBLE) / {m}")


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


AVG = f"SELECT mid, {half_up_avg()} AS avgscore FROM ratings GROUP BY mid"

GENRE_RANKED = f"""averages AS ({AVG}),
genre_rows AS (
  SELECT m.mid, a.avgscore, unnest(string_split(regexp_replace(m.genres, '[|]+$', ''), '|')) AS gen
  FROM movies m JOIN averages a ON m.mid = a.mid),
ranked AS (
  SELECT mid, gen, avgscore, CAST(row_number() OVER (PARTITION BY gen ORDER BY avgscore DESC, mid) AS INTEGER) AS rank
  FROM genre_rows)"""


def high_quality(view: str, min_avg: float, min_count: int) -> str:
    return f"""SELECT mid, {half_up_avg()} AS avg, count(*) AS count,
       CAST(row_number() OVER (ORDER BY avg(score) DESC, count(*) DESC, mid) AS INTEGER) AS rank
FROM {view} GROUP BY mid
HAVING avg(score) > {min_avg} AND count(*) > {min_count}"""


SQL: dict[str, str] = {
    "rating_counts": with_views(V_RATINGS) + "SELECT mid, count(mid) AS count FROM ratings GROUP BY mid",
    "monthly_rating_counts": with_views(V_RATINGS) + """SELECT mid, count(mid) AS count, yearmonth FROM (
  SELECT mid, CAST(year(d) * 100 + month(d) AS INTEGER) AS yearmonth
  FROM (SELECT mid, DATE '1970-01-01' + CAST(floor("timestamp" / 86400) AS INTEGER) AS d FROM ratings))
GROUP BY yearmonth, mid""",
    "average_scores": with_views(V_RATINGS) + AVG,
    "genre_top10": with_views(V_RATINGS, V_MOVIES, GENRE_RANKED) + "SELECT mid, gen, avgscore, rank FROM ranked WHERE rank <= 10",
    "genre_top10_nested": with_views(V_RATINGS, V_MOVIES, GENRE_RANKED)
    + """SELECT gen, string_agg(CAST(mid AS VARCHAR) || ':' || CAST(avgscore AS VARCHAR), '|' ORDER BY rank) AS recs
FROM ranked WHERE rank <= 10 GROUP BY gen""",
    "high_quality_items": with_views(V_RATINGS) + high_quality("ratings", 3.2, 25),
    "high_quality_default": with_views(V_RATINGS) + high_quality("ratings", 3.5, 50),
    "high_quality_events": with_views(V_EVENT_RATINGS) + high_quality("event_ratings", 2.5, 50),
    "recent_top10": with_views(V_RATINGS) + """SELECT mid, count(*) AS count FROM ratings
WHERE "timestamp" > (SELECT max("timestamp") - 7776000 FROM ratings)
GROUP BY mid ORDER BY count DESC, mid LIMIT 10""",
    "text_load_movies": """SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
  'A ' || p_name || ' of brand ' || p_brand AS descri, CAST(p_size AS VARCHAR) || ' minutes' AS timelong,
  'size ' || CAST(p_size AS VARCHAR) AS issue, CAST(1950 + p_size AS VARCHAR) AS shoot, substr(p_type, 1, 4) AS language,
  concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres, replace(p_name, ' ', '|') AS actors, p_brand AS directors
FROM part""",
    "user_item_pairs": with_views(V_RATINGS, V_MOVIES)
    + "SELECT DISTINCT uid, (SELECT count(*) FROM movies) AS n_pairs FROM ratings",
    "text_load_ratings": with_views(V_RATINGS) + "SELECT * FROM ratings",
    "text_load_tags": with_views(V_TAGS) + "SELECT * FROM tags",
    "layout_roundtrip": with_views(V_RATINGS) + "SELECT * FROM ratings",
    "search_documents": with_views(V_MOVIES, V_TAGS) + """SELECT m.mid AS _id, m.mid, m.name, m.genres, t.tags FROM movies m
LEFT JOIN (SELECT mid, coalesce(string_agg(DISTINCT tag, '|' ORDER BY tag), '') AS tags FROM tags GROUP BY mid) t
ON m.mid = t.mid""",
    "similar_pairs": with_views(V_VECTORS, v_edges(0.3)) + "SELECT mid, rid, r FROM edges",
    "similar_lists": with_views(V_VECTORS, v_edges(0.3)) + pack("edges", "mid", "rid", "r", "r DESC, rid"),
    "recent_ratings": with_views(V_EVENT_RATINGS, V_RECENTS) + "SELECT * FROM recents",
    "rated_exclusion": with_views(*ONLINE[:-1]) + "SELECT * FROM unrated",
    "candidates": with_views(*ONLINE) + "SELECT * FROM candidates",
    "candidates_cut_first": with_views(*ONLINE[:-2]) + CUT_FIRST,
    "rerank": with_views(*ONLINE, v_rerank("rerank", "rc.score > 3")) + "SELECT * FROM rerank",
    "rerank_ge": with_views(*ONLINE, v_rerank("rerank", "rc.score >= 3")) + "SELECT * FROM rerank",
    "packed_recs": with_views(*ONLINE, v_rerank("rerank", "rc.score > 3")) + pack("rerank", "uid", "mid", "score", "score DESC, mid"),
    "unpacked_recs": with_views(*ONLINE, v_rerank("rerank", "rc.score > 3")) + "SELECT uid, mid AS rid, score AS r FROM rerank",
    "merged_recs": with_views(*ONLINE, v_rerank("rerank", "rc.score > 3"), v_rerank("rerank_ge", "rc.score >= 3"))[:-1]
    + merged(True, "r DESC", False),
    "merged_recs_literal": with_views(*ONLINE, v_rerank("rerank", "rc.score > 3"), v_rerank("rerank_ge", "rc.score >= 3"))[:-1]
    + merged(False, "r ASC", True),
    "stream_recs": with_views(*ONLINE, v_rerank("rerank", "rc.score > 3"),
                              "packed AS (" + pack("rerank", "uid", "mid", "score", "score DESC, mid") + ")")
    + "SELECT t.uid, coalesce(p.recs, '') AS recs FROM triggers t LEFT JOIN packed p ON t.uid = p.uid",
    "items_with_tags": with_views(V_MOVIES, V_TAGS) + """SELECT m.mid, m.name, m.genres, t.tags FROM movies m
LEFT JOIN (SELECT mid, coalesce(string_agg(DISTINCT tag, '|' ORDER BY tag), '') AS tags FROM tags GROUP BY mid) t
ON m.mid = t.mid""",
}
SQL["factor_user_top20"] = with_views(V_RATINGS, V_MOVIES, v_factors(), """scored AS (
  SELECT a.id AS uid, b.id AS rid, list_inner_product(a.u, b.v) AS r FROM factors a CROSS JOIN factors b
  WHERE a.id IN (SELECT uid FROM ratings) AND b.id IN (SELECT mid FROM movies))""") + """SELECT uid, rid, r,
  CAST(row_number() OVER (PARTITION BY uid ORDER BY r DESC, rid) AS INTEGER) AS rank
FROM scored WHERE r > 0 QUALIFY rank <= 20"""
SQL["factor_predictions"] = with_views(V_RATINGS, v_factors(), V_PREDICTIONS) + "SELECT * FROM predictions"
SQL["factor_predictions_blocked"] = SQL["factor_predictions"]
SQL["als_properties"] = with_views(V_RATINGS) + "SELECT count(DISTINCT uid) AS n_users, count(DISTINCT mid) AS n_items, 50 AS rank, true AS beats_mean FROM ratings"
SQL["factor_rmse"] = with_views(V_RATINGS, v_factors(), V_PREDICTIONS) + """SELECT 'row' AS duplicates, sqrt(avg((score - prediction) ** 2)) AS rmse FROM predictions
UNION ALL SELECT 'join', sqrt(avg((r.score - p.prediction) ** 2)) FROM predictions r JOIN predictions p ON r.uid = p.uid AND r.mid = p.mid"""
SQL["factor_item_similarity"] = with_views(v_factors(), "item_vectors AS (SELECT id AS mid, v AS features FROM factors)", v_edges(0.3)) + "SELECT mid, rid, r FROM edges"
SQL["factor_best_params"] = with_views(
    V_RATINGS, *(v_factors(k, s, f"f{i}{j}") for i, k in enumerate((16, 64)) for j, s in enumerate((0.125, 0.5)))
) + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {k} AS rank, CAST({s} AS DOUBLE) AS reg, sqrt(avg((r.score - list_inner_product(a.u, b.v)) ** 2)) AS rmse "
    f"FROM ratings r JOIN f{i}{j} a ON a.id = r.uid JOIN f{i}{j} b ON b.id = r.mid"
    for i, k in enumerate((16, 64)) for j, s in enumerate((0.125, 0.5))
) + ") ORDER BY rmse, rank, reg LIMIT 1"
SQL["stream_recs_stateful"] = SQL["stream_recs"]
SQL["rerank_bucketed"] = SQL["rerank"]
V_ALTERED = V_VECTORS.replace("item_vectors AS (", "plain_vectors AS (") + """,
item_vectors AS (
  SELECT * FROM plain_vectors UNION ALL
  SELECT mid + 1000000, list_transform(features, lambda x, i: CASE WHEN (i - 1) % 8 = 0 THEN -x ELSE x END) FROM plain_vectors)"""
SQL["similar_pairs_default"] = with_views(V_ALTERED, v_edges(0.6)) + "SELECT mid, rid, r FROM edges"
SQL["similar_pairs_recall"] = with_views(V_ALTERED, v_edges(0.4)) + "SELECT count(*) AS n_exact, 0 AS n_wrong, true AS recall_ok FROM edges"
SQL["ranked_edges"] = with_views(V_VECTORS, v_edges(0.2)) + """SELECT mid, rid, r,
  CAST(row_number() OVER (PARTITION BY mid ORDER BY r DESC, rid) AS INTEGER) AS rank FROM edges"""
SQL["candidates_ranked"] = SQL["candidates"]
SQL["candidates_ranked_cut_first"] = SQL["candidates_cut_first"]
V_RAISED = """raised AS (
  SELECT mid % 100 AS mid, least(5.0, score + (mid % 100 % 3) * 0.5) AS score FROM ratings)"""
SQL["high_quality_raised"] = SQL["high_quality_sql"] = with_views(V_RATINGS, V_RAISED) + high_quality("raised", 3.5, 50)
SQL["items_with_tags_chunked"] = with_views(V_TAGS) + """SELECT mid, part, CAST(count(*) AS INTEGER) AS n_tags, string_agg(tag, '|' ORDER BY tag) AS tags FROM (
  SELECT mid, tag, CAST((row_number() OVER (PARTITION BY mid ORDER BY tag) - 1) // 2 AS INTEGER) AS part
  FROM (SELECT DISTINCT mid, tag FROM tags WHERE tag IS NOT NULL)) GROUP BY mid, part"""
SQL["layout_clustered"] = SQL["table_replaced"] = SQL["layout_roundtrip"]
SQL["nested_lists"] = with_views(V_VECTORS, v_edges(0.3)) + """SELECT mid, rid,
  CASE WHEN row_number() OVER (PARTITION BY mid ORDER BY r DESC, rid) = 1 THEN r / 2 ELSE r END AS r FROM edges"""
SQL["similar_lists_chunked"] = with_views(V_VECTORS, v_edges(0.2), """chunked AS (
  SELECT mid, rid, r, CAST((row_number() OVER (PARTITION BY mid ORDER BY r DESC, rid) - 1) // 64 AS INTEGER) AS chunk FROM edges)""") \
    + pack("chunked", "mid, chunk", "rid", "r", "r DESC, rid")
SQL["rerank_plain"] = with_views(*ONLINE) + """SELECT uid, mid, floor(score * 10000 + 0.500031415) / 10000.0 AS score FROM (
  SELECT c.uid, c.cand AS mid, avg(e.r * rc.score) + log2(greatest(count_if(rc.score > 3), 1)) - log2(greatest(count_if(NOT rc.score > 3), 1)) AS score
  FROM (SELECT DISTINCT uid, rid AS cand FROM candidates) c JOIN recents rc ON c.uid = rc.uid JOIN edges e ON e.mid = c.cand AND e.rid = rc.mid
  WHERE e.r > 0.2 GROUP BY c.uid, c.cand)"""
SQL["factor_grid"] = SQL["factor_best_params"].replace(" ORDER BY rmse, rank, reg LIMIT 1", "")
# lists of users without a scored candidate are empty
for _stream, _batch in (("stream_merged", "merged_recs"), ("stream_merged_literal", "merged_recs_literal")):
    SQL[_stream] = "SELECT t.uid, coalesce(m.recs, '') AS recs FROM (" + with_views(V_EVENT_RATINGS, V_TRIGGERS) + "SELECT uid FROM triggers) t LEFT JOIN (" + SQL[_batch] + ") m ON t.uid = m.uid"
SQL["stream_cut_first"] = with_views(*ONLINE[:-2], f"candidates AS ({CUT_FIRST})", v_rerank("rerank", "rc.score >= 3"),
                                     "packed AS (" + pack("rerank", "uid", "mid", "score", "score DESC, mid") + ")") \
    + "SELECT t.uid, coalesce(p.recs, '') AS recs FROM triggers t LEFT JOIN packed p ON t.uid = p.uid"
_LATE = V_TRIGGERS.replace("FROM event_ratings)", "FROM event_ratings WHERE mid % 2 = 1)")
SQL["stream_recs_rated_state"] = with_views(*(_LATE if v == V_TRIGGERS else v for v in ONLINE), v_rerank("rerank", "rc.score > 3"),
                                            "packed AS (" + pack("rerank", "uid", "mid", "score", "score DESC, mid") + ")") \
    + "SELECT t.uid, coalesce(p.recs, '') AS recs FROM triggers t LEFT JOIN packed p ON t.uid = p.uid"
for _name in ("rating_counts", "monthly_rating_counts", "average_scores", "genre_top10", "recent_top10"):
    SQL[f"{_name}_sql"] = SQL[_name]
