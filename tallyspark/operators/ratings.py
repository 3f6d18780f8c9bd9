"""Ratings and popularity reports.

Inputs: ratings(user_id, movie_id, rating, ts), users(user_id, gender, age, occupation_id),
movies(movie_id, title, genres), occupations(occupation_id, occupation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sizes import top, top_per_group



def viewers(ratings: DataFrame, movie_id: int) -> DataFrame:
    """(user_id, n) for one movie, counted before any join."""
    return ratings.where(F.col("movie_id") == movie_id).groupBy("user_id").agg(F.count("*").alias("n"))


def audience(ratings: DataFrame, users: DataFrame, movie_id: int) -> DataFrame:
    """Viewers of a movie by gender and age."""
    return (
        viewers(ratings, movie_id)
        .join(users, "user_id")
        .groupBy("gender", "age")
        .agg(F.sum("n").alias("n"))
    )


def audience_sql(spark: SparkSession, ratings: DataFrame, users: DataFrame, movie_id: int) -> DataFrame:
    """The same report as SQL text over a temporary and a global temporary view."""
    ratings.createOrReplaceTempView("tally_ratings")
    users.createOrReplaceGlobalTempView("tally_users")
    return spark.sql(
        """
        SELECT u.gender, u.age, count(*) AS n
        FROM tally_ratings AS r JOIN global_temp.tally_users AS u ON r.user_id = u.user_id
        WHERE r.movie_id = :movie
        GROUP BY u.gender, u.age
        """,
        args={"movie": movie_id},
    )


def audience_profile(ratings: DataFrame, users: DataFrame, occupations: DataFrame, movie_id: int) -> DataFrame:
    """Each viewer of a movie with age, gender and occupation, and the number of ratings."""
    return (
        viewers(ratings, movie_id)
        .join(users, "user_id")
        .join(occupations, "occupation_id")
        .select("user_id", "age", "gender", "occupation", "n")
    )


def movie_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movie_id").agg(
        F.avg("rating").alias("mean_rating"), F.count("*").alias("n")
    )


def with_titles(ranked: DataFrame, movies: DataFrame) -> DataFrame:
    return ranked.join(movies.select("movie_id", "title"), "movie_id")


def top_rated(ratings: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """Movies with the highest mean rating; titles are joined to the ``n`` winners only."""
    best = top(movie_means(ratings), n, F.desc("mean_rating"), F.asc("movie_id"))
    return with_titles(best, movies)


def most_popular(ratings: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    counts = ratings.groupBy("movie_id").agg(F.count("*").alias("n"))
    return with_titles(top(counts, n, F.desc("n"), F.asc("movie_id")), movies)


def by_group(ratings: DataFrame, users: DataFrame, column: str, groups: Sequence) -> DataFrame:
    """Ratings by users of the given groups, with the group, in one pass for all groups."""
    members = users.where(F.col(column).isin(*groups)).select("user_id", column)
    return ratings.join(members, "user_id")


def top_rated_by_group(
    ratings: DataFrame, users: DataFrame, movies: DataFrame, column: str, groups: Sequence, n: int = 10
) -> DataFrame:
    """Highest mean rating within each group; equal means go to the larger movie id."""
    means = (
        by_group(ratings, users, column, groups)
        .groupBy(column, "movie_id")
        .agg(F.avg("rating").alias("mean_rating"), F.count("*").alias("n"))
    )
    best = top_per_group(means, [column], [F.desc("mean_rating"), F.desc("movie_id")], n)
    return with_titles(best.drop("rank"), movies)


def segment_topn(
    ratings: DataFrame, users: DataFrame, movies: DataFrame, column: str, groups: Sequence, n: int = 10
) -> DataFrame:
    """Most rated movies of each group."""
    counts = (
        by_group(ratings, users, column, groups)
        .groupBy(column, "movie_id")
        .agg(F.count("*").alias("n"))
    )
    best = top_per_group(counts, [column], [F.desc("n"), F.asc("movie_id")], n)
    return with_titles(best.drop("rank"), movies)


def rated_by_members(ratings: DataFrame, users: DataFrame, segment: Column) -> DataFrame:
    """Ratings given by the users of a segment, as a membership test."""
    members = users.where(segment).select("user_id").distinct()
    return ratings.join(members, "user_id", "left_semi")


def looked_up(ratings: DataFrame, users: DataFrame, *columns: str) -> DataFrame:
    """Every rating with the user's columns, NULL where the user is unknown."""
    return ratings.join(users.select("user_id", *columns), "user_id", "left")


def latest_ratings(ratings: DataFrame, n: int = 10) -> DataFrame:
    """The newest ratings, higher ones first among equal times."""
    return top(
        ratings, n, F.desc("ts"), F.desc("rating"), F.asc("user_id"), F.asc("movie_id")
    )
