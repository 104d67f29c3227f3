"""Report tables that are kept up to date from changes of the records.

Every table of totals is a handful of cells: all records, a tier, a pay band, an education group. A
change adds a record's part to the cells it lies in or takes it away again; a revision does both.
Only changes are read, one row a cell is written for each batch, and the tables are sums over these
rows. Sums are whole numbers, and the numerator of a weighted mean is a decimal, so what is taken
away cancels what was added exactly, in any order; the division comes last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagetally import fixed
from pagetally.functions.aggregates import product0, weighable
from pagetally.functions.predicates import in_closed, in_half_open, member_of, truthy_number
from pagetally.operators.summaries import means_from, pay, rating, tiers_from, weight
from pagetally.sources.keyed_table import KeyedTable

COLUMNS = ("pay", "jobs", "education", "exposure")
SUMS = {"n": "bigint", "jobs": "bigint", "wages": "bigint", "rated": "bigint",
        "weighted": "decimal(38,12)"}
SCHEMA = "key string, batch string, kind string, ord int, name string, " + ", ".join(
    f"{name} {kind}" for name, kind in SUMS.items())


def changes(inserted: DataFrame | None = None, deleted: DataFrame | None = None,
            revised: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Records with ``sign`` 1 or -1; ``revised`` is (as they were, as they are)."""
    parts = [(1, inserted), (-1, deleted)]
    if revised is not None:
        parts += [(-1, revised[0]), (1, revised[1])]
    signed = [part.select(*COLUMNS, F.lit(sign).cast("bigint").alias("sign"))
              for sign, part in parts if part is not None]
    rows = signed[0]
    for part in signed[1:]:
        rows = rows.unionByName(part)
    return rows


def cells(tiers: list[tuple] = fixed.TIERS, bands: list[tuple] = fixed.PAY_BANDS,
          groups: list[tuple] = fixed.EDUCATION_GROUPS) -> list[tuple[str, int, str, Column]]:
    """(kind, position, name, whether a record lies in it) of every cell."""
    counted = weighable(rating(), weight())
    return [
        ("all", 0, "", F.lit(True)),
        *(("tier", i, name, rating().isNotNull() & in_closed(rating(), low, high))
          for i, (name, low, high) in enumerate(tiers)),
        *(("band", i, name, counted & truthy_number(pay()) & in_half_open(pay(), low, high))
          for i, (name, low, high) in enumerate(bands)),
        *(("group", i, name, counted & member_of(F.col("education"), members))
          for i, (name, members) in enumerate(groups)),
    ]


def changed_cells(signed: DataFrame, within: list[tuple[str, int, str, Column]]) -> DataFrame:
    """``kind, ord, name`` and the signed sums of each cell: one pass, one row out of each task.

    Ratings count to twelve decimals.
    """
    counted = weighable(rating(), weight())
    whole = weight().cast("decimal(20,0)") * F.col("sign").cast("decimal(1,0)")
    measures = {
        "n": F.col("sign"), "jobs": F.col("sign") * F.coalesce(weight(), F.lit(0)),
        "wages": F.col("sign") * product0(weight(), pay()),
        "rated": F.when(counted, F.col("sign") * weight()),
        "weighted": F.when(counted, (rating().cast("decimal(17,12)") * whole).cast("decimal(38,12)")),
    }
    slots = F.array(*(F.struct(
        F.lit(kind).alias("kind"), F.lit(i).alias("ord"), F.lit(name).alias("name"),
        *(F.coalesce(F.sum(F.when(test, value)), F.lit(0)).cast(SUMS[label]).alias(label)
          for label, value in measures.items())) for kind, i, name, test in within))
    return signed.agg(slots.alias("cells")).select(F.inline("cells"))


class ReportTotals:
    """Totals of all batches of changes at ``path``.

    A batch has a name; one that is applied again replaces itself. The same tiers, bands and
    groups must be given for all batches of a path.
    """

    def __init__(self, spark: SparkSession, path: str, tiers: list[tuple] = fixed.TIERS,
                 bands: list[tuple] = fixed.PAY_BANDS,
                 groups: list[tuple] = fixed.EDUCATION_GROUPS) -> None:
        self.table = KeyedTable(spark, path, "key", SCHEMA)
        self.cells = cells(tiers, bands, groups)

    def apply(self, batch: str, signed: DataFrame) -> None:
        """Writes the sums of a batch of :func:`changes`."""
        rows = changed_cells(signed, self.cells)
        self.table.upsert(rows.select(
            F.concat_ws("/", F.lit(batch), "kind", F.col("ord").cast("string")).alias("key"),
            F.lit(batch).alias("batch"), *rows.columns))

    def compact(self) -> None:
        """Brings the rows of all batches into one file; their names stay known."""
        self.table.compact()

    def _totals(self) -> DataFrame:
        """One row a cell."""
        return self.table.read().groupBy("kind", "ord", "name").agg(
            *(F.sum(name).cast(kind).alias(name) for name, kind in SUMS.items()))

    def _slots(self, kind: str) -> Column:
        row = F.struct("ord", "name", "n", "jobs", "wages",
                       F.col("weighted").cast("double").alias("weighted"))
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, row)))

    def _grand(self, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == "all", F.col(name))), F.lit(0))

    def headline(self) -> DataFrame:
        """As :func:`pagetally.operators.summaries.headline` of the records as they are now."""
        mean = F.try_divide(self._grand("weighted").cast("double"), self._grand("rated"))
        return self._totals().agg(
            *(self._grand(name).cast("bigint").alias(name) for name in ("n", "jobs", "wages")),
            F.coalesce(mean, F.lit(0.0)).alias("mean_exposure"))

    def tier_summary(self) -> DataFrame:
        """Tier table; empty tiers stay."""
        return tiers_from(self._totals().agg(
            self._slots("tier").alias("tiers"), self._grand("jobs").cast("bigint").alias("jobs"),
            self._grand("wages").cast("bigint").alias("wages"))).select(
            "ord", "name", "n", "jobs", "jobs_share", "wages", "wages_share", "avg_pay")

    def band_means(self) -> DataFrame:
        """Weighted means by pay band; empty bands are dropped."""
        return means_from(self._totals().agg(self._slots("band").alias("slots")), "slots")

    def group_means(self) -> DataFrame:
        """Weighted means by education group; empty groups are dropped."""
        return means_from(self._totals().agg(self._slots("group").alias("slots")), "slots")
