"""Roll-ups kept up to date month by month.

A roll-up whose groups belong to one document each (discounts of an order, delivered
quantities of an order, invoiced quantities of an invoice) is stored by the month of the
document. When documents change after their month was closed, only they are computed
anew: their old rows leave, their new ones come, and the months concerned switch together.
The rest of the state is neither read nor written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.warehouse import PERIOD, Target, replace_months


@dataclass(frozen=True)
class RollupState:
    """A stored roll-up: `key` is its document column, `rollup` computes it for given documents.

    `rollup` gets a frame with the one column `key`, distinct, and returns rows with that
    column; what it returns for a document must not depend on the others.
    """

    target: Target
    key: str
    rollup: Callable[[DataFrame], DataFrame]

    def refresh(self, touched: DataFrame, date_column: str) -> list[str]:
        """Recompute the documents of `touched` (`key`, `date_column`); returns the months that were written.

        A document dated in another month than before moves there; one whose date is
        null, or that has no rows any more, leaves the state. A document with several dates is kept
        under the latest.
        """
        dated = touched.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.date_format(F.max(date_column), "yyyy-MM").alias("_month"))
        stored = self.target.schema(touched.sparkSession)
        months = {r["_month"] for r in dated.select("_month").distinct().collect() if r["_month"]}
        documents = dated.select(F.col(self.key).alias("_document"), "_month")
        fresh = self.rollup(dated.where("_month is not null").select(self.key))
        fresh = fresh.join(documents, F.col(self.key) == F.col("_document")).drop("_document").withColumnRenamed("_month", PERIOD)
        if stored is not None:
            old = self.target.read(touched.sparkSession)
            gone = old.join(documents, F.col(self.key) == F.col("_document"), "left_semi").select(PERIOD)
            months |= {r[PERIOD] for r in gone.distinct().collect()}
            kept = self.target.read(touched.sparkSession, sorted(months))
            kept = kept.join(documents, F.col(self.key) == F.col("_document"), "left_anti")
            fresh = fresh.unionByName(kept)
        replace_months(fresh, self.target, sorted(months))
        return sorted(months)

    def read(self, spark) -> DataFrame:
        return self.target.read(spark).drop(PERIOD)
