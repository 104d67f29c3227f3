"""Running named steps, each only for keys that are not done yet."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, functions as F

from pagetally.operators.joins import pending, skew_joins
from pagetally.operators.keyed import upsert
from pagetally.session import written
from pagetally.sources.keyed_table import KeyedTable

Step = Callable[[DataFrame], DataFrame]


def run_incremental(todo: DataFrame, done: DataFrame, step: Step, key: str = "slug",
                    force: bool = False) -> DataFrame:
    """Output table after a run: kept rows of ``done`` plus ``step`` applied to pending rows.

    ``force`` redoes every row; rows of ``done`` outside ``todo`` survive.
    """
    fresh = step(pending(todo, done, key, force))
    return upsert(done, fresh, key) if force else done.unionByName(fresh, allowMissingColumns=True)


def run_into(table: KeyedTable, todo: DataFrame, step: Step, force: bool = False) -> DataFrame:
    """As :func:`run_incremental`, but into a table that is merged on read: the rows in force.

    The run reads the keys of the table and writes the rows of the pending keys, nothing else.
    """
    table.upsert(step(pending(todo, table.keys(), table.key, force)))
    return table.read()


def run_statuses(todo: DataFrame, corpus: DataFrame, done: DataFrame, key: str = "slug",
                 force: bool = False) -> DataFrame:
    """Outcome of each row of a run: ``missing`` input, ``cached`` or ``processed``."""
    inputs = corpus.select(key).distinct().withColumn("_input", F.lit(True))
    outputs = done.select(key).distinct().withColumn("_output", F.lit(True))
    marked = skew_joins(todo, [(inputs, "left"), (outputs, "left")], key)
    cached = F.lit(False) if force else F.coalesce("_output", F.lit(False))
    return marked.select(
        *todo.columns,
        F.when(F.col("_input").isNull(), "missing").when(cached, "cached").otherwise(
            "processed").alias("status"))


def run_steps(catalog: dict[str, DataFrame],
              steps: dict[str, Callable[..., DataFrame]], names: Iterable[str] | None = None,
              force: bool = False) -> tuple[dict[str, DataFrame], list[str]]:
    """Run the named steps in the given order over a catalog of tables.

    A step reads tables of the catalog and its result becomes the table of its own name; one
    with a parameter ``force`` is told whether to redo what is done. Results are written as
    tables, since later steps build on them. Unknown names are skipped and returned.
    """
    tables, unknown = dict(catalog), []
    for name in (list(steps) if names is None else names):
        if name in steps:
            told = {"force": force} if "force" in inspect.signature(steps[name]).parameters else {}
            tables[name] = written(steps[name](tables, **told), name)
        else:
            unknown.append(name)
    return tables, unknown
