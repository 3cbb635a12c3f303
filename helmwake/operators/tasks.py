"""Task annotations: validity, intervals, keys and the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helmwake.operators.intervals import valid_pair
from helmwake.operators.prefix import distributed_prefix_sum

#: The fields of one step of a task list.
TASKS = "array<struct<sub_instruction:string,revised_sub_instruction:string,sub_indexes:array<bigint>,sum_instruction:string,sum_indexes:array<bigint>>>"


def nonblank(c: Column) -> Column:
    """A text with any character that isn't white space."""
    return F.coalesce(c.rlike(r"[^\s\p{Z}]"), F.lit(False))


def valid_tasks(tasks: Column) -> Column:
    """Any step with a sub text and a valid sub pair, or a sum text and a valid sum pair (F02); false for null."""

    def ok(t: Column) -> Column:
        sub = (nonblank(t["sub_instruction"]) | nonblank(t["revised_sub_instruction"])) & valid_pair(t["sub_indexes"])
        return sub | (nonblank(t["sum_instruction"]) & valid_pair(t["sum_indexes"]))

    return F.coalesce(F.exists(tasks, ok), F.lit(False))


def parse_tasks(text: Column) -> Column:
    """The step list in a JSON text, else null (X07); texts that are no JSON list of objects are null."""
    return F.from_json(text, TASKS)


def sub_intervals(tasks: Column) -> Column:
    """The valid sub pairs as closed intervals, ordered by end, then start."""
    pairs = F.filter(F.transform(tasks, lambda t: t["sub_indexes"]), valid_pair)
    iv = F.transform(pairs, lambda p: F.struct(p[1].alias("end"), p[0].alias("start")))
    return F.transform(F.array_sort(iv), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))


def canonical_key(tasks: Column) -> Column:
    """One JSON text per task list, whatever its formatting was."""
    return F.to_json(tasks)


def require_valid(tasks: Column) -> Column:
    """The task list, or an error that ends the query where it is not valid (F05, strict form)."""
    return F.when(valid_tasks(tasks), tasks).otherwise(F.raise_error(F.concat(F.lit("no valid task in "), F.coalesce(F.to_json(tasks), F.lit("null")))).cast(TASKS))


def compact_json(tasks: Column) -> Column:
    """The task list as compact JSON in ASCII: other characters are escaped (X08, first form)."""
    text = F.to_json(tasks)
    escaped = lambda c: F.when(c.rlike(r"[\x00-\x7F]"), c).otherwise(F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(....)", r"\\u$1"))
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(F.split(text, ""), escaped), "")).otherwise(text)


def registry(rows: DataFrame, task: str, order: list[str], known: DataFrame | None = None) -> DataFrame:
    """(task_index, task): a dense number per distinct task in order of first appearance (J11, ST6).

    The numbers are a function of the data alone. Distinct tasks are found with
    map-side combining and counted bucket by bucket of the first order column,
    which must be an integer; a null there comes first. Tasks of ``known``, an earlier
    registry, keep their numbers and are not in the result; new ones go on behind them.
    """
    first = rows.where(F.col(task).isNotNull()).groupBy(F.col(task).alias("task")).agg(F.min(F.struct(*order)).alias("__o"))
    start = F.lit(0).cast("bigint")
    if known is not None:
        first = first.join(known.select("task"), "task", "left_anti")
        start = known.agg(F.coalesce(F.max("task_index") + 1, F.lit(0)).cast("bigint").alias("n")).scalar()
    at = F.coalesce(F.col(f"__o.{order[0]}").cast("bigint"), F.lit(-(1 << 62)).cast("bigint"))
    n = distributed_prefix_sum(first.withColumn("__one", F.lit(1)), [], F.shiftright(at, 10), ["__o", "task"], "__one", "__n")
    return n.select((F.col("__n") - 1 + start).cast("bigint").alias("task_index"), "task")


def encode(rows: DataFrame, reg: DataFrame, task: str) -> DataFrame:
    """The rows with their task's number; null for a null task."""
    return rows.join(reg.select(F.col("task").alias("__t"), "task_index"), F.col(task) == F.col("__t"), "left").drop("__t")


def latest_by(rows: DataFrame, key: list[str], order: Column, value: str, out: str) -> DataFrame:
    """The last value of each key: a later row overwrites an earlier one."""
    return rows.groupBy(*key).agg(F.max_by(value, order).alias(out))


def keep_unprocessed(rows: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key isn't among those already processed (J10, ST3)."""
    return rows.join(done.select(*key).distinct(), key, "left_anti")
