"""Stored leads: the Parquet table, the CSV interchange form, and the keys already stored."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from postsift import schemas
from postsift.functions.text import post_id_from_url

# Quotes are doubled, line breaks may stand inside quotes.
CSV_DIALECT = {
    "header": "true", "sep": ",", "quote": '"', "escape": '"', "multiLine": "true",
    "encoding": "UTF-8",
}


def read_table(spark: SparkSession, path: str, schema=schemas.LEADS) -> DataFrame:
    """The Parquet table at ``path``, or an empty one with the same schema if there is none."""
    return _read(spark, schema, path)


def read_folders(spark: SparkSession, path: str, folders: str, schema) -> DataFrame:
    """The partitions of the table at ``path`` that the pattern ``folders`` names; no others are listed.

    Empty, with the same schema, if there are none.
    """
    return _read(spark, schema, f"{path}/{folders}", basePath=path)


def _read(spark: SparkSession, schema, path: str, **options) -> DataFrame:
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_lead_csv(spark: SparkSession, path: str) -> DataFrame:
    """Export rows from CSV. Only the empty field means NULL."""
    return spark.read.schema(schemas.EXPORT).options(**CSV_DIALECT).csv(path)


def select_leads(leads: DataFrame, status=None, language=None, limit=None) -> DataFrame:
    """Leads by status and language, in order of arrival when limited. Falsy means no filter."""
    if status:
        leads = leads.where(F.col("status") == status)
    if language:
        leads = leads.where(F.col("language_detected") == language)
    return leads.orderBy("seq").limit(limit) if limit else leads


def stored_ids(leads: DataFrame, url="post_url") -> DataFrame:
    """Distinct post ids found in the stored URLs."""
    ids = leads.select(post_id_from_url(F.col(url)).alias("post_id"))
    return ids.where(F.col("post_id").isNotNull()).distinct()


def not_stored(leads: DataFrame, ids: DataFrame) -> DataFrame:
    """Leads whose post id is not among the stored ids.

    The ids are read as they are, not made distinct first, so the runtime can split a hot post.
    """
    return leads.join(ids.select("post_id"), "post_id", "left_anti").select(leads.columns)
