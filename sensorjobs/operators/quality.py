"""Data-quality checks as grouped jobs, and the summary of a run's results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The status words of run results.
OK = ("success", "pass", "warn", "skipped")
BAD = ("error", "fail", "failed")


def _rows(counts: DataFrame, kind: str) -> DataFrame:
    names = counts.columns
    return counts.select(F.explode(F.array(*[F.struct(F.lit(kind).alias("check_kind"), F.lit(c).alias("subject"), F.col(f"`{c}`").cast("bigint").alias("failures")) for c in names])).alias("x")).select("x.*")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of each column, in one pass."""
    return _rows(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), "not_null")


def check_accepted_values(df: DataFrame, accepted: Mapping[str, Sequence]) -> DataFrame:
    """Rows whose value is set and not in the column's list, in one pass."""
    return _rows(df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*v)).alias(c) for c, v in accepted.items()]), "accepted_values")


def check_expression(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows of which a condition is not true, in one pass."""
    return _rows(df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]), "expression")


def check_unique_combination(df: DataFrame, columns: Sequence[str], kind: str = "unique_combination") -> DataFrame:
    """Keys that occur more than once (null keys are left out)."""
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    again = keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return again.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(kind).alias("check_kind"), F.lit(",".join(columns)).alias("subject"), "failures")


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return check_unique_combination(df, [column], "unique")


def check_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key is set and has no parent."""
    keys = parent.select(F.col(parent_column).alias("__k"))
    lost = child.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__k"), "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("failures")).select(F.lit("relationship").alias("check_kind"), F.lit(column).alias("subject"), "failures")


def check_all(*checks: DataFrame) -> DataFrame:
    """The results of several checks."""
    return reduce(DataFrame.unionByName, checks)


def check_table(df: DataFrame, not_null: Sequence[str] = (), accepted: Mapping[str, Sequence] | None = None, expressions: Mapping[str, Column] | None = None, unique: Sequence[Sequence[str]] = (), relationships: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """All checks of a table in one scan and one shuffle: the rows that the functions above give one by one.

    A row of the table becomes one row for each condition that it fails, and one for each key that is checked (``unique``: lists of
    columns; ``relationships``: column to (parent, its column)); all are grouped by check and key, so they are summed before
    they move and a frequent key is no large group. Keys are compared as text. Parents are read once for each relationship.
    """
    checks: list[tuple[str, str]] = []
    cells: list[Column] = []
    none = F.lit(None).cast("array<string>")

    def cell(kind: str, subject: str, condition: Column, key: Column) -> None:
        cells.append(F.when(condition, F.struct(F.lit(len(checks)).alias("at"), key.alias("key"), F.lit(1).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("parents"))))
        checks.append((kind, subject))

    def texts(columns: Sequence[str]) -> tuple[Column, Column]:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]), F.array(*[F.col(c).cast("string") for c in columns])

    for c in not_null:
        cell("not_null", c, F.col(c).isNull(), none)
    for c, values in (accepted or {}).items():
        cell("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(*values), none)
    for name, condition in (expressions or {}).items():
        cell("expression", name, ~F.coalesce(condition, F.lit(False)), none)
    for columns in unique:
        cell("unique" if len(columns) == 1 else "unique_combination", ",".join(columns), *texts(columns))
    parents = []
    for c, (parent, parent_column) in (relationships or {}).items():
        own = parent.select(F.lit(len(checks)).alias("at"), F.array(F.col(parent_column).cast("string")).alias("key"), F.lit(0).cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("parents"))
        parents.append(own.filter(F.col("key")[0].isNotNull()))
        cell("relationship", c, *texts([c]))
    rows = df.select(F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("x")).select("x.*")
    groups = reduce(DataFrame.unionByName, parents, rows).groupBy("at", "key").agg(F.sum("n").alias("n"), F.sum("parents").alias("parents"))

    def failures(at: int, kind: str) -> Column:
        if kind.startswith("unique"):
            bad = F.when(F.col("n") > 1, F.lit(1))
        elif kind == "relationship":
            bad = F.when(F.col("parents") == 0, F.col("n"))
        else:
            bad = F.col("n")
        return F.coalesce(F.sum(F.when(F.col("at") == at, bad)), F.lit(0)).cast("bigint").alias(str(at))

    totals = groups.agg(*[failures(k, kind) for k, (kind, _) in enumerate(checks)])
    out = [F.struct(F.lit(kind).alias("check_kind"), F.lit(subject).alias("subject"), F.col(str(k)).alias("failures")) for k, (kind, subject) in enumerate(checks)]
    return totals.select(F.explode(F.array(*out)).alias("x")).select("x.*")


RESULT_SCHEMA = "struct<results:array<struct<unique_id:string,status:string,message:string>>>"


def run_results_summary(runs: DataFrame, run_id: str = "run_id", document: str = "document") -> DataFrame:
    """From run-result documents (JSON text) per run: models and tests passed and failed, and the first five errors.

    Each error is the id and its message on one line, cut to 220 characters. Only failures are gathered.
    """
    rows = runs.select(F.col(run_id).alias("run_id"), F.posexplode_outer(F.from_json(document, RESULT_SCHEMA)["results"]).alias("place", "r"))
    return summarize(rows.select("run_id", "place", "r.unique_id", "r.status", "r.message"))


def summarize(results: DataFrame) -> DataFrame:
    """The summary of result rows (run_id, place, unique_id, status, message).

    The first five failures are found among the first five of each of 64 parts of a run, so no task holds all of a run's.
    """
    status, uid = F.lower(F.coalesce("status", F.lit(""))), F.coalesce("unique_id", F.lit(""))
    short = F.substring(F.translate(F.btrim(F.coalesce("message", F.lit(""))), "\n", " "), 1, 220)
    line = F.when(short == "", uid).otherwise(F.concat(uid, F.lit(": "), short))
    model, test = uid.startswith("model."), uid.startswith("test.")
    first = Window.partitionBy("run_id", "part").orderBy("place", "line")
    failed = results.filter(status.isin(*BAD)).select("run_id", "place", line.alias("line"), F.pmod(F.xxhash64("place", "unique_id"), F.lit(64)).alias("part"))
    few = failed.withColumn("n", F.row_number().over(first)).filter("n <= 5")
    listed = few.groupBy("run_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("place", "line"))), 1, 5).alias("first"))
    errors = listed.select(F.col("run_id").alias("__r"), F.array_join(F.transform("first", lambda x: x["line"]), "; ").alias("error_summary"))
    totals = results.groupBy("run_id").agg(
        F.count_if(model & status.isin(*OK)).alias("models_passed"), F.count_if(model & status.isin(*BAD)).alias("models_failed"),
        F.count_if(test & status.isin(*OK)).alias("tests_passed"), F.count_if(test & status.isin(*BAD)).alias("tests_failed"),
    )
    return totals.join(errors, F.col("run_id").eqNullSafe(F.col("__r")), "left").drop("__r")


def quality_gate(summary: DataFrame, subject: str) -> DataFrame:
    """``passed`` (no model failed) and ``alert``: a message if tests failed, which stops nothing."""
    text = F.concat(
        F.lit(f"checks of '{subject}': "), F.col("tests_failed").cast("string"), F.lit(" failed, "), F.col("tests_passed").cast("string"),
        F.lit(" passed. "), F.coalesce("error_summary", F.lit("no details")),
    )
    return summary.select("run_id", (F.col("models_failed") == 0).alias("passed"), F.when(F.col("tests_failed") > 0, text).alias("alert"))


def enforce_gate(gate: DataFrame) -> None:
    """Raise if any run of the gate did not pass."""
    failed = gate.filter(~F.col("passed")).select("run_id").first()
    if failed:
        raise RuntimeError(f"run {failed[0]} failed")
