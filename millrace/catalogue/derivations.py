"""Rows that follow from loaded tables and not from one source row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import lower_name
from millrace.operators.joins import left_lookup
from millrace.operators.rank import number_rows, ranked_assignments
from millrace.operators.resolve import missing_parents
from millrace.operators.shape import numbered_columns, split_header_steps, unpivot_slots
from millrace.catalogue.references import JUNK_BREEDS


def _scope(load) -> list[str]:
    return ["farm"] if load.farms else []


def missing_pens(load) -> DataFrame | None:
    """Pens that animals name but no pen list has: paddocks."""
    pens, cattle = load.target("pen.pens"), load.table("Cattle")
    if pens is None or cattle is None or "Pen_Number" not in cattle.columns:
        return None
    fresh = missing_parents(cattle, F.trim(F.col("Pen_Number")), pens, "name", "id", scope=_scope(load))
    return fresh.withColumns({"is_paddock": F.lit(True), "pen_type": F.lit("paddock")})


def missing_breeds(load) -> DataFrame | None:
    """Breeds of the breed list that the breed table lacks in any letter case."""
    lookups, breeds = load.target("system.lookups"), load.target("cattle.breeds")
    if lookups is None or breeds is None:
        return None
    named = lookups.where((F.col("category") == "breed") & ~F.col("label").isin(*JUNK_BREEDS))
    return missing_parents(named, F.trim(F.col("label")), breeds, "name", "id", lower_name, _scope(load))


def load_size_entries(load) -> DataFrame | None:
    df = load.table("Ration_Load_Sizes", "feed")
    if df is None:
        return None
    slots = unpivot_slots(df, [*_scope(load), "Ration_Type_ID"], numbered_columns("Truck_Size_{}_Wght", 1, 10), "truck_number", "weight")
    return slots.withColumnRenamed("Ration_Type_ID", "ration_type_id")


def feeding_order_data(load) -> DataFrame | None:
    df = load.table("Pen_Feeding_Order_Params", "feed")
    if df is None:
        return None
    slots = unpivot_slots(df, [*_scope(load), "Ration_Type"], numbered_columns("DATA{}", 0, 59))
    return slots.withColumnRenamed("Ration_Type", "param_ration_type")


def _regimes(load) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    rows = load.target("health.treatment_regimes__staged")
    diseases, drugs = load.target("health.diseases"), load.target("health.drugs")
    if rows is None or diseases is None or drugs is None:
        return None
    scope = _scope(load)
    steps = rows.select(
        *scope,
        F.col("diseaseid").alias("parent"),
        F.col("day_numb").alias("day"),
        F.col("drug_id").alias("item"),
        "dose",
        F.col("dosebyweight").alias("by_weight"),
        F.struct(*rows.columns).alias("row"),
    )
    return split_header_steps(steps, diseases, drugs, scope=scope)


def treatment_regimes(load) -> DataFrame | None:
    """One header per disease, and the rows whose disease is unknown as they came."""
    split = _regimes(load)
    if split is None:
        return None
    headers, _, unmatched = split
    headers = number_rows(
        headers.select(
            *_scope(load),
            "name",
            F.col("parent_id").alias("disease_id"),
            "days",
            F.col("by_weight").alias("dose_by_weight"),
            F.lit(True).alias("active"),
        ),
        ["disease_id"],
        "id",
    )
    return headers.unionByName(unmatched.select("row.*").drop("_source_table"), allowMissingColumns=True)


def treatment_regime_steps(load) -> DataFrame | None:
    split, regimes = _regimes(load), load.target("health.treatment_regimes")
    if split is None or regimes is None:
        return None
    scope = _scope(load)
    ids = regimes.where(F.col("id").isNotNull())
    ids = ids.select(*scope, F.col("disease_id").alias("parent_id"), F.col("id").alias("regime_id"))
    steps = left_lookup(split[1], ids, [*scope, "parent_id"], "inner")
    return steps.select(*scope, "regime_id", "day_number", F.col("item_id").alias("drug_id"), "dose")


def tag_assignments(load) -> DataFrame | None:
    """One active holder per ear tag; all earlier holders with the reason they lost it."""
    cows = load.target("cattle.cows")
    if cows is None:
        return None
    dates = ("updated_at", "created_at", "entry_date", "start_date", "date_died", "sale_date", "date_archived")
    cows = cows.withColumns({name: F.lit(None).cast("timestamp") for name in dates if name not in cows.columns})
    scope = _scope(load)
    tag = F.concat_ws("/", *scope, "ear_tag") if scope else F.col("ear_tag")
    held = cows.where("ear_tag IS NOT NULL AND ear_tag <> ''").withColumn("_tag", tag)
    ranked = ranked_assignments(held, "_tag", "id", "status", [F.col("updated_at").desc_nulls_last()])
    ended = F.coalesce("date_died", "sale_date", "date_archived")
    return ranked.select(
        *scope,
        "ear_tag",
        F.col("id").alias("cow_id"),
        "active",
        F.coalesce("entry_date", "start_date", "created_at").alias("assigned_at"),
        F.when(~F.col("active"), ended).alias("deactivated_at"),
        "deactivated_reason",
    )


# (target, name of the derived source, order after which it runs, builder)
DERIVATIONS = (
    ("cattle.breeds", "derived:missing_breeds", 10, missing_breeds),
    ("pen.pens", "derived:missing_pens", 15, missing_pens),
    ("feed.ration_load_size_entries", "derived:ration_load_sizes", 60, load_size_entries),
    ("feed.pen_feeding_order_data", "derived:feeding_order", 60, feeding_order_data),
    ("health.treatment_regimes", "derived:regime_headers", 61, treatment_regimes),
    ("health.treatment_regime_steps", "derived:regime_steps", 62, treatment_regime_steps),
    ("cattle.ear_tag_assignments", "derived:tag_assignments", 63, tag_assignments),
)
