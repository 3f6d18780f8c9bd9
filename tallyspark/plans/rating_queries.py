"""Ratings, people and user-behaviour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import commerce, people, ratings, sizes
from ..sources import readers
from .registry import query

MOVIE = 42

RATINGS = """
ratings AS (
  SELECT l_suppkey AS user_id, l_partkey AS movie_id,
         CAST(l_quantity AS INTEGER) % 5 + 1 AS rating, l_shipdate AS ts
  FROM lineitem),
users AS (
  SELECT s_suppkey AS user_id, CASE WHEN s_suppkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CASE s_suppkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 18 WHEN 2 THEN 25 WHEN 3 THEN 35
              WHEN 4 THEN 45 WHEN 5 THEN 50 ELSE 56 END AS age,
         s_nationkey AS occupation_id
  FROM supplier)
"""

AUDIENCE = f"""
WITH {RATINGS}
SELECT gender, age, count(*) AS n FROM ratings JOIN users USING (user_id)
WHERE movie_id = {MOVIE} GROUP BY gender, age
"""


@query("audience", AUDIENCE)
def audience(t):
    return ratings.audience(t.ratings, t.users, MOVIE)


@query("audience_sql", AUDIENCE)
def audience_sql(t):
    return ratings.audience_sql(t.spark, t.ratings, t.users, MOVIE)


@query(
    "audience_profile",
    f"""
WITH {RATINGS}
SELECT user_id, age, gender, n_name AS occupation, count(*) AS n
FROM ratings JOIN users USING (user_id) JOIN nation ON n_nationkey = occupation_id
WHERE movie_id = {MOVIE} GROUP BY ALL
""",
)
def audience_profile(t):
    return ratings.audience_profile(t.ratings, t.users, t.occupations, MOVIE)


@query(
    "top_rated",
    f"""
WITH {RATINGS}, best AS (
  SELECT movie_id, CAST(sum(rating) AS DOUBLE) / count(*) AS m, count(*) AS n
  FROM ratings GROUP BY movie_id ORDER BY m DESC, movie_id LIMIT 10)
SELECT movie_id, round(m, 6) AS mean_rating, n, p_name AS title
FROM best JOIN part ON p_partkey = movie_id
""",
)
def top_rated(t):
    return ratings.top_rated(t.ratings, t.movies).withColumn("mean_rating", F.round("mean_rating", 6))


@query(
    "most_popular",
    f"""
WITH {RATINGS}, best AS (
  SELECT movie_id, count(*) AS n FROM ratings GROUP BY movie_id ORDER BY n DESC, movie_id LIMIT 10)
SELECT movie_id, n, p_name AS title FROM best JOIN part ON p_partkey = movie_id
""",
)
def most_popular(t):
    return ratings.most_popular(t.ratings, t.movies)


@query(
    "top_rated_by_group",
    f"""
WITH {RATINGS}, means AS (
  SELECT gender, movie_id, CAST(sum(rating) AS DOUBLE) / count(*) AS m, count(*) AS n
  FROM ratings JOIN users USING (user_id) GROUP BY gender, movie_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY gender ORDER BY m DESC, movie_id DESC) AS rn FROM means)
SELECT movie_id, round(m, 6) AS mean_rating, n, p_name AS title, gender
FROM ranked JOIN part ON p_partkey = movie_id WHERE rn <= 10
""",
)
def top_rated_by_group(t):
    best = ratings.top_rated_by_group(t.ratings, t.users, t.movies, "gender", ["M", "F"])
    return best.withColumn("mean_rating", F.round("mean_rating", 6))


@query(
    "segment_topn",
    f"""
WITH {RATINGS}, counted AS (
  SELECT age, movie_id, count(*) AS n FROM ratings JOIN users USING (user_id)
  WHERE age IN (18, 25) GROUP BY age, movie_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY age ORDER BY n DESC, movie_id) AS rn FROM counted)
SELECT movie_id, n, p_name AS title, age FROM ranked JOIN part ON p_partkey = movie_id WHERE rn <= 10
""",
)
def segment_topn(t):
    return ratings.segment_topn(t.ratings, t.users, t.movies, "age", [18, 25])


@query(
    "segment_members",
    f"""
WITH {RATINGS}
SELECT movie_id, count(*) AS n, CAST(sum(rating) AS BIGINT) AS stars
FROM ratings WHERE user_id IN (SELECT user_id FROM users WHERE age = 18) GROUP BY movie_id
""",
)
def segment_members(t):
    own = ratings.rated_by_members(t.ratings, t.users, F.col("age") == 18)
    return own.groupBy("movie_id").agg(F.count("*").alias("n"), F.sum("rating").alias("stars"))


@query(
    "latest_ratings",
    f"""
WITH {RATINGS}
SELECT user_id, movie_id, rating, CAST(ts AS DATE) AS day FROM ratings
ORDER BY ts DESC, rating DESC, user_id, movie_id LIMIT 10
""",
)
def latest_ratings(t):
    newest = ratings.latest_ratings(t.ratings)
    return newest.withColumn("day", F.to_date("ts")).drop("ts")


# behaviour ------------------------------------------------------------------------------

LOG = """
log AS (
  SELECT event_id AS log_id, user_id, ts AS time,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS typed, value AS consumed
  FROM events WHERE event_type IN ('view', 'click', 'purchase')),
people AS (SELECT c_custkey AS user_id, c_name AS name FROM customer),
accounts AS (
  SELECT user_id, name, min(ts) AS registered FROM events JOIN people USING (user_id)
  WHERE event_type = 'signup' GROUP BY user_id, name)
"""

PERIOD = ("2024-01-08", "2024-01-22")
LAST_WEEK, THIS_WEEK = ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-01-22")
COHORT = ("2024-01-01", "2024-01-15")
IN_PERIOD = "time >= TIMESTAMP '2024-01-08' AND time < TIMESTAMP '2024-01-22'"


@query(
    "visits_topn",
    f"""
WITH {LOG}
SELECT user_id, name, count(*) AS visits FROM log JOIN people USING (user_id)
WHERE {IN_PERIOD} AND typed = 0 GROUP BY user_id, name ORDER BY visits DESC, user_id LIMIT 5
""",
)
def visits_topn(t):
    return commerce.visits_topn(t.access_log, t.people, *PERIOD)


@query(
    "spend_topn",
    f"""
WITH {LOG}
SELECT user_id, name, round(sum(consumed), 2) AS spend FROM log JOIN people USING (user_id)
WHERE {IN_PERIOD} GROUP BY user_id, name ORDER BY spend DESC, user_id LIMIT 10
""",
)
def spend_topn(t):
    return commerce.spend_topn(t.access_log, t.people, *PERIOD)


@query(
    "purchases_topn",
    f"""
WITH {LOG}
SELECT user_id, name, round(sum(consumed), 2) AS spend FROM log JOIN people USING (user_id)
WHERE {IN_PERIOD} AND typed = 1 GROUP BY user_id, name ORDER BY spend DESC, user_id LIMIT 5
""",
)
def purchases_topn(t):
    return commerce.spend_topn(t.access_log, t.people, *PERIOD, n=5, typed=commerce.PURCHASE)


def _growth_sql(amount: str, typed: int, limit: int, rounded: str) -> str:
    return f"""
WITH {LOG}, signed AS (
  SELECT user_id, {amount} AS v FROM log
  WHERE time >= TIMESTAMP '2024-01-15' AND time < TIMESTAMP '2024-01-22' AND typed = {typed}
  UNION ALL
  SELECT user_id, -{amount} FROM log
  WHERE time >= TIMESTAMP '2024-01-08' AND time < TIMESTAMP '2024-01-15' AND typed = {typed})
SELECT user_id, name, {rounded} AS growth FROM signed JOIN people USING (user_id)
GROUP BY user_id, name ORDER BY growth DESC, user_id LIMIT {limit}
"""


@query("visit_growth", _growth_sql("1", 0, 10, "CAST(sum(v) AS BIGINT)"))
def visit_growth(t):
    return commerce.growth_topn(
        t.access_log, t.people, LAST_WEEK, THIS_WEEK, commerce.VISIT, F.lit(1), 10
    )


@query("spend_growth", _growth_sql("consumed", 1, 5, "round(sum(v), 2)"))
def spend_growth(t):
    return commerce.growth_topn(
        t.access_log, t.people, LAST_WEEK, THIS_WEEK, commerce.PURCHASE, F.col("consumed"), 5
    )


@query(
    "signed_union",
    f"""
WITH {LOG}
SELECT user_id, CAST(sum(CASE WHEN time >= TIMESTAMP '2024-01-15' THEN 1 ELSE -1 END) AS BIGINT) AS growth
FROM log WHERE {IN_PERIOD} AND typed = 0 GROUP BY user_id
""",
)
def signed_union(t):
    return commerce.signed_union(t.access_log, LAST_WEEK, THIS_WEEK)


def _first_days_sql(measure: str, typed: int) -> str:
    return f"""
WITH {LOG}
SELECT user_id, name, {measure} AS amount FROM log JOIN accounts USING (user_id)
WHERE registered >= TIMESTAMP '2024-01-01' AND registered < TIMESTAMP '2024-01-15'
  AND time >= registered AND CAST(time AS DATE) <= CAST(registered AS DATE) + 14 AND typed = {typed}
GROUP BY user_id, name ORDER BY amount DESC, user_id LIMIT 10
"""


@query("first_fortnight_visits", _first_days_sql("count(log_id)", 0))
def first_fortnight_visits(t):
    return commerce.first_days(t.access_log, t.accounts, COHORT, F.count("log_id"))


@query("first_fortnight_spend", _first_days_sql("round(sum(consumed), 2)", 1))
def first_fortnight_spend(t):
    spend = F.round(F.sum("consumed"), 2)
    return commerce.first_days(t.access_log, t.accounts, COHORT, spend, typed=commerce.PURCHASE)


@query(
    "items_top3_per_user",
    r"""
WITH counted AS (
  SELECT user_id, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS item, count(*) AS n
  FROM events WHERE contains('device-' || event_type, 'view') GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item) AS INTEGER) AS rank
  FROM counted)
SELECT * FROM ranked WHERE rank <= 3
""",
)
def items_top3_per_user(t):
    return commerce.items_top3(t.device_log, "view")


# people ---------------------------------------------------------------------------------

PEOPLE = """
people AS (
  SELECT c_custkey AS user_id, c_name AS name, CAST(c_custkey % 60 + 18 AS INTEGER) AS age,
         c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance
  FROM customer),
scores AS (
  SELECT o_orderkey AS score_id, o_custkey AS user_id, CAST(floor(o_totalprice / 5000) AS BIGINT) AS score
  FROM orders)
"""


@query(
    "people_stats",
    f"""
WITH {PEOPLE}
SELECT segment, CAST(sum(age) AS BIGINT) AS sum_age, round(avg(age), 6) AS avg_age, max(age) AS max_age,
       min(age) AS min_age, count(age) AS n_age, count(DISTINCT age) AS distinct_ages,
       round(avg(balance), 4) AS mean_score, TRUE AS is_dated
FROM people GROUP BY segment
""",
)
def people_stats(t):
    stats = people.group_stats(t.people, "segment", "age", "balance")
    return stats.select(
        "segment", "sum_age", F.round("avg_age", 6).alias("avg_age"), "max_age", "min_age", "n_age",
        "distinct_ages", F.round("mean_score", 4).alias("mean_score"),
        (F.col("as_of") == F.current_date()).alias("is_dated"),
    )


@query(
    "collect_sets",
    f"""
WITH {PEOPLE}, counted AS (SELECT segment, nation, count(*) AS n FROM people GROUP BY ALL)
SELECT segment, string_agg(CAST(nation AS VARCHAR), ',' ORDER BY nation) AS "values",
       string_agg(nation || 'x' || n, ',' ORDER BY nation) AS value_counts
FROM counted GROUP BY segment
""",
)
def collect_sets(t):
    lists = sizes.collected_values(t.people, "segment", "nation")
    pair = lambda p: F.concat(p["nation"].cast("string"), F.lit("x"), p["n"].cast("string"))
    return lists.select(
        "segment",
        F.array_join("values", ",").alias("values"),
        F.array_join(F.transform("value_counts", pair), ",").alias("value_counts"),
    )


@query(
    "collect_chunks",
    """
WITH chunks AS (
  SELECT user_id, CAST(ceil(count(*) / 20e0) AS BIGINT) AS k FROM events GROUP BY user_id),
placed AS (
  SELECT user_id, event_id,
         CAST(floor(event_id % 2147483647 * 2654435761 % 4294967296 / 4294967296e0 * k) AS BIGINT) AS chunk
  FROM events JOIN chunks USING (user_id))
SELECT user_id, chunk, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS "values"
FROM placed GROUP BY user_id, chunk
""",
)
def collect_chunks(t):
    lists = sizes.chunked_lists(t.read("events"), "user_id", "event_id", 20)
    return lists.withColumn("values", F.array_join("values", ","))


@query(
    "group_concat_keys",
    f"""
WITH {PEOPLE}
SELECT segment, age, segment || age AS label, count(*) AS n FROM people GROUP BY segment, age
""",
)
def group_concat_keys(t):
    return people.key_labels(t.people, "segment", "age")


@query(
    "join_pairs",
    f"""
WITH {PEOPLE}
SELECT p.name AS left_name, p.age AS left_age, s.score_id AS right_id, s.score AS right_score
FROM people p JOIN scores s ON p.user_id = s.user_id
""",
)
def join_pairs(t):
    both = people.pairs(t.people, t.scores, F.col("l.user_id") == F.col("r.user_id"))
    return both.select(
        F.col("left.name").alias("left_name"),
        F.col("left.age").alias("left_age"),
        F.col("right.score_id").alias("right_id"),
        F.col("right.score").alias("right_score"),
    )


@query(
    "left_join_default",
    f"""
WITH {PEOPLE}, seen AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT user_id, name, coalesce(n, 0) AS n FROM people LEFT JOIN seen USING (user_id)
""",
)
def left_join_default(t):
    seen = t.read("events").groupBy("user_id").agg(F.count("*").alias("n"))
    return people.left_with_default(t.people.select("user_id", "name"), seen, "user_id", "n", 0)


@query(
    "qualified_semi",
    f"""
WITH {PEOPLE}
SELECT user_id, name, age, count(*) AS n_scores, max(score) AS best_score
FROM people JOIN scores USING (user_id) WHERE score > 90 GROUP BY user_id, name, age
""",
)
def qualified_semi(t):
    return people.qualified(t.people.select("user_id", "name", "age"), t.scores, 90)


@query(
    "qualified_members",
    f"""
WITH {PEOPLE}
SELECT user_id, name, age FROM people WHERE user_id IN (SELECT user_id FROM scores WHERE score > 90)
""",
)
def qualified_members(t):
    return people.members_only(t.people.select("user_id", "name", "age"), t.scores, 90)


@query(
    "floored_sum",
    """
SELECT l_returnflag, sum(greatest(l_quantity, 30.0)) AS total FROM lineitem GROUP BY l_returnflag
""",
)
def floored_sum(t):
    return people.floored_sum(t.read("lineitem"), "l_returnflag", "l_quantity", 30.0)


@query(
    "dedup_by_key",
    """
WITH ranked AS (
  SELECT p_name, p_partkey, p_brand, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn
  FROM part)
SELECT p_name, p_partkey, p_brand FROM ranked WHERE rn = 1
""",
)
def dedup_by_key(t):
    parts = t.read("part").select("p_name", "p_partkey", "p_brand")
    return sizes.first_per_key(parts, ["p_name"], [F.asc("p_partkey")])


@query("distinct_rows", "SELECT DISTINCT p_name, p_brand FROM part")
def distinct_rows(t):
    return t.read("part").select("p_name", "p_brand").distinct()


@query(
    "conditional_map",
    f"""
WITH {PEOPLE}
SELECT user_id, CASE WHEN segment = 'MACHINERY' THEN age + 70 ELSE age + 30 END AS age FROM people
""",
)
def conditional_map(t):
    rows = t.people.select("user_id", "age", "segment")
    return people.aged(rows, F.col("segment") == "MACHINERY", "age").drop("segment")


@query("map_partitions", f"WITH {PEOPLE} SELECT user_id, age + 1000 AS age FROM people")
def map_partitions(t):
    return people.shifted(t.people.select("user_id", "age"), "age", 1000)


@query(
    "string_clean",
    """
SELECT p_partkey, replace(p_name, ' ', '') AS compact, upper(substring(p_name, 1, 3)) AS head,
       p_brand || ',0,' || p_type || ',0,0,' || p_size AS line
FROM part
""",
)
def string_clean(t):
    raw = F.concat(F.col("p_brand"), F.lit(",,"), F.col("p_type"), F.lit(",,,"), F.col("p_size").cast("string"))
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return t.read("part").select(
        "p_partkey",
        text.remove_blanks(padded).alias("compact"),
        F.upper(F.substring(F.trim(padded), 1, 3)).alias("head"),
        text.fill_empty_fields(raw).alias("line"),
    )


@query(
    "json_props",
    r"""
SELECT CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k, count(*) AS n FROM events GROUP BY ALL
""",
)
def json_props(t):
    rows = readers.json_strings(t.read("events"), "props", "k int")
    return rows.groupBy("k").agg(F.count("*").alias("n"))


@query(
    "json_compose",
    """
SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS js FROM events
""",
)
def json_compose(t):
    return t.read("events").select(
        "event_id", F.to_json(F.struct("user_id", "event_type")).alias("js")
    )


@query("sample_half")
def sample_half(t):
    return t.people.select("user_id", "name").sample(False, 0.5, 11)


@query("random_split")
def random_split(t):
    return people.random_parts(t.people.select("user_id", "name"), [10.0, 20.0], 11)
