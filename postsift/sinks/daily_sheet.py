"""The daily sheet and the action tab as tables partitioned by day."""

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from postsift import schemas
from postsift.operators import outcomes as oc
from postsift.operators.projections import action_rows, sheet_rows
from postsift.sinks.lead_store import RUN, count_row, counted, create_table, write_run
from postsift.sources.leads import read_folders, read_table, stored_ids

DAY = "sheet_date"


def _table(columns) -> T.StructType:
    kinds = {"Sent": T.BooleanType()}
    return T.StructType([
        T.StructField(name, kinds.get(name, T.StringType())) for name in [*columns, DAY, RUN]
    ])


def sheet_name(base: str, as_of, auto_date=True) -> str:
    """The sheet's name: the base name, with the day behind it unless ``auto_date`` is off."""
    return f"{base}-{str(as_of)[:10]}" if auto_date else base


class DailySheet:
    """Sheet rows under ``path/sheet`` and action rows under ``path/action``."""

    def __init__(self, spark: SparkSession, path: str, base="Leads", auto_date=True):
        self.spark, self.base, self.auto_date = spark, base, auto_date
        self.sheet_path, self.action_path = f"{path}/sheet", f"{path}/action"
        create_table(spark, self.sheet_path, _table(schemas.SHEET_COLUMNS), DAY, RUN)
        create_table(spark, self.action_path, _table(schemas.ACTION_COLUMNS), DAY, RUN)

    def read(self, as_of=None) -> DataFrame:
        return self._rows(self.sheet_path, schemas.SHEET_COLUMNS, as_of)

    def read_actions(self, as_of=None) -> DataFrame:
        return self._rows(self.action_path, schemas.ACTION_COLUMNS, as_of)

    def _rows(self, path, columns, as_of) -> DataFrame:
        if as_of is None:
            return read_table(self.spark, path, _table(columns))
        name = sheet_name(self.base, as_of, self.auto_date)
        rows = read_folders(self.spark, path, f"{DAY}={quote(name, safe='')}", _table(columns))
        return rows.where(F.col(DAY) == name)

    def append(self, leads: DataFrame, as_of, run_id: str, min_score=oc.SHEET_MIN_SCORE, gated=True) -> DataFrame:
        """Add leads to the day's sheet and the worthy ones to the action tab; counts as one row.

        Duplicates are looked for in this day's sheet only, which reads this day's partition only.
        """
        name = sheet_name(self.base, as_of, self.auto_date)
        today = stored_ids(self.read(as_of).where(F.col(RUN) != run_id), "Post URL")
        kept, seen = counted(oc.sheet_outcomes(leads, today, min_score, gated))
        self._clear(run_id, name)
        write_run(sheet_rows(kept, as_of), self.sheet_path, run_id, **{DAY: name})
        if gated:
            write_run(action_rows(kept.where("comment_worthy")), self.action_path, run_id, **{DAY: name})
        return count_row(self.spark, seen)

    def _clear(self, run_id: str, name: str) -> None:
        """Take back what an earlier attempt of this run wrote to another day's sheet.

        Only the folders of this run are opened, one a day at most; the other runs' files aren't listed.
        """
        for path, columns in ((self.sheet_path, schemas.SHEET_COLUMNS), (self.action_path, schemas.ACTION_COLUMNS)):
            own = f"{DAY}=*/{RUN}={quote(run_id, safe='')}"
            rows = read_folders(self.spark, path, own, _table(columns)).where(F.col(RUN) == run_id)
            for day in rows.where(F.col(DAY) != name).select(DAY).distinct().collect():
                write_run(rows.limit(0).drop(DAY, RUN), path, run_id, **{DAY: day[0]})

    def list_sheets(self) -> DataFrame:
        """Names and places of the sheets written so far; reads partition names only."""
        names = self.read().select(F.col(DAY).alias("name")).distinct()
        return names.select("name", F.concat(F.lit(f"{self.sheet_path}/{DAY}="), "name").alias("path")).orderBy("name")


def skipped_counts(leads: DataFrame) -> DataFrame:
    """The counts of a switched-off sheet: every lead is skipped."""
    return leads.agg(
        F.lit(0).cast("bigint").alias("saved"), F.count(F.lit(1)).alias("skipped"),
        F.lit(0).cast("bigint").alias("filtered"))
