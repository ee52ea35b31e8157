"""Language and community tables."""

from pyspark.sql import DataFrame, functions as F


def priority_languages(languages: DataFrame) -> DataFrame:
    """Languages on the priority list, in list order."""
    return languages.where(F.col("priority").isNotNull()).orderBy("priority")


def monitored_communities(languages: DataFrame, communities: DataFrame) -> DataFrame:
    """Sorted distinct names: all listed communities and those of the priority languages."""
    of_languages = languages.where(F.col("priority").isNotNull()).select(F.explode("subreddits").alias("name"))
    return communities.select("name").union(of_languages).distinct().orderBy("name")


def language_listing(languages: DataFrame) -> DataFrame:
    return languages.select("code", "name", F.array_join("subreddits", ", ").alias("communities"))


def language_names(languages: DataFrame) -> DataFrame:
    """Lower-cased name and native name of each language, in turn (``pos`` 0 and 1)."""
    names = F.array(F.lower("name"), F.lower("native_name"))
    return languages.select("code", F.posexplode(names).alias("pos", "needle"))
