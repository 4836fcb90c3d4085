"""The medallion pipeline as an ordered list of steps.

Each step names its inputs, builds one DataFrame, and is written below ``root`` before later steps read
it, so a lost executor repeats at most one step and a customer table used five times is computed once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import assert_table
from ..sources import versions
from ..sources.tables import write_clustered
from . import profile, silver


@dataclass(frozen=True)
class Step:
    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    cluster: tuple[str, ...] = ()
    non_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()


MEDALLION: tuple[Step, ...] = (
    Step("silver_customer", "silver", ("customer",), silver.customers, ("cif_id", "state"), ("cif_id",), ("cif_id",)),
    Step("silver_loan_app", "silver", ("loan_app",), silver.loan_applications, ("cif_id", "status"), ("appl_no", "cif_id")),
    Step("silver_card_app", "silver", ("card_app",), silver.card_applications, ("cif_id", "status"), ("appl_id", "cif_id")),
    Step("silver_collections", "silver", ("loan_coll", "card_coll"), silver.collections_summary, ("cif_id",),
         ("cif_id",), ("cif_id",)),
    Step("gold_profile", "gold", ("silver_customer", "silver_loan_app", "silver_card_app", "silver_collections", "card"),
         profile.customer_profile, ("state", "cif_id"), ("cif_id",), ("cif_id",)),
    Step("gold_features", "gold", ("gold_profile",), profile.feature_store, ("state", "cif_id"), ("cif_id",), ("cif_id",)),
)


def run(spark: SparkSession, sources: Mapping[str, DataFrame], root: str,
        steps: Sequence[Step] = MEDALLION) -> dict[str, DataFrame]:
    """Build, write, assert and then publish every step in order; returns all tables by name.

    All inputs have to be there before the first step begins. A step is written aside; one that fails its assertions is
    never published, so ``read`` keeps giving the version before.
    """
    built = {s.name for s in steps}
    if missing := sorted({i for s in steps for i in s.inputs if i not in sources and i not in built}):
        raise ValueError(f"no input {missing}")
    done = dict(sources)
    for step in steps:
        path, folder = f"{root}/{step.layer}/{step.name}", versions.new_folder()
        write_clustered(step.build(*[done[i] for i in step.inputs]), f"{path}/{folder}", list(step.cluster))
        done[step.name] = spark.read.parquet(f"{path}/{folder}")
        if step.non_null or step.unique:
            assert_table(done[step.name], step.non_null, step.unique)
        versions.publish(spark, path, {"all": folder})
    return done


def read(spark: SparkSession, root: str, step: Step) -> DataFrame:
    """A product as published last."""
    path = f"{root}/{step.layer}/{step.name}"
    return spark.read.parquet(f"{path}/{versions.current(spark, path)['all']}")


def lineage(steps: Sequence[Step], schemas: Mapping[str, DataFrame]) -> DataFrame:
    """One row per input and product with the columns they share and the rows of the input."""
    built = {s.name for s in steps}
    rows = []
    for order, step in enumerate(steps, 1):
        for name in step.inputs:
            traced = ", ".join(c for c in schemas[step.name].columns if c in schemas[name].columns)
            rows.append(schemas[name].agg(F.count(F.lit(1)).alias("source_rows")).select(
                F.lit(order).alias("stage"), F.lit(name).alias("source_table"),
                F.lit("product" if name in built else "bronze").alias("source_kind"),
                F.lit(step.name).alias("target_table"), F.lit(step.layer).alias("target_layer"),
                F.lit(traced).alias("traced_columns"), "source_rows"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
