"""The standard reports over a loaded store: validation, reconciliation, comparison, source audit, old names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalogue.categories import PATTERNS, RAW, category_frame
from millrace.catalogue.checks import (
    ANIMAL_TARGETS,
    COST_GROUP,
    FOREIGN_KEYS,
    PROFILE_META,
    STALE_COLUMNS,
    STRANDED_PAIRS,
)
from millrace.catalogue.tables import FEEDING_VARIANTS, SPECS
from millrace.operators.quality import fill_ratio, stranded_columns
from millrace.plans import reports
from millrace.plans.checks import Check, RowCheck, UniqueCheck
from millrace.plans.reports import ForeignKey
from millrace.sources.sinks import TargetStore
from millrace.sources.views import register_views

# What is compared field by field: source table, target, key on both sides, columns.
COMPARED = (
    ("Contacts", "contacts.contacts", ("Contact_ID", "contact_id"),
     {"Company": "company", "First_Name": "first_name", "Last_Name": "last_name", "Tel_No": "tel_no", "Email": "email"}),
    ("Diseases", "health.diseases", ("Disease_ID", "disease_id"), {"Disease_Name": "disease_name", "Symptoms": "symptoms"}),
    ("Drugs", "health.drugs", ("Drug_ID", "drug_id"), {"Units": "units", "Cost_per_unit": "cost_per_unit"}),
    ("Cattle", "cattle.cows", ("BeastID", "legacy_beast_id"), {"Ear_Tag": "ear_tag", "EID": "eid"}),
    ("Purchase_Lots", "purchasing.purchase_lots", ("Lot_Number", "lot_number"),
     {"Number_Head": "number_head", "Total_Weight": "total_weight"}),
    ("FeedDB_Pens_File", "feed.feeddb_pens_file", ("Pen_name", "pen_name"), {}),
    ("Cost_Codes", "finance.cost_codes", ("RevExp_Code", "revexp_code"), {"RevExp_Desc": "revexp_desc"}),
    ("Market_Category", "cattle.market_categories", ("Market_Cat_ID", "market_cat_id"), {"Market_Category": "market_category"}),
)

# References checked in the source before a load.
SOURCE_KEYS = tuple(ForeignKey(t, "BeastID", "Cattle", "BeastID") for t in ("Drugs_Given", "PensHistory", "Weighing_Events"))

# Old names of targets.
OLD_NAMES = {
    "cows": "cattle.cows",
    "cattle": "cattle.cows",
    "breeds": "cattle.breeds",
    "pens": "pen.pens",
    "diseases": "health.diseases",
    "drugs": "health.drugs",
    "drug_disposals": "health.drug_disposals",
    "weighing_events": "weighing.weighing_events",
    "weighing_types": "weighing.weighing_types",
    "purchase_lots": "purchasing.purchase_lots",
    "purchase_lot_cattle": "cattle.purchase_lot_cattle",
    "lots": "purchasing.purchase_lots",
    "contacts": "contacts.contacts",
    "contact_types": "contacts.contacttypes",
    "rations": "feed.rations",
    "feedlot_staff": "feed.feedlot_staff",
    "carcase_data": "carcase.carcase_data",
    "cost_codes": "finance.cost_codes",
    "costs": "finance.costs",
    "penshistory": "pen.penshistory",
    "pensfed": "pen.pensfed",
    "sick_beast_records": "health.sick_beast_records",
    "drugs_given": "health.drugs_given",
    "autopsy_records": "health.autopsy_records",
    "penfeedsdata": "feed.penfeedsdata",
    "bunk_readings": "feed.bunk_readings",
    "commodities": "commodity.commodities",
    "commodcontracts": "commodity.commodcontracts",
    "commodtrans": "commodity.commodtrans",
    "truck_loads": "transport.truck_loads",
    "deliverydockets": "transport.deliverydockets",
    "beast_breeding": "breeding.beast_breeding",
    "beastmovement": "cattle.beast_movements",
}
PENS_FILE = {"id": "pen_number_id", "name": "pen_name", "is_hospital": "hospital_pen"}


def old_names(store: TargetStore) -> list[str]:
    """Register the loaded targets under their old names."""
    runs = store.current_runs()
    frames = {view: store.read(target, runs) for view, target in OLD_NAMES.items()}
    frames = {view: df for view, df in frames.items() if df is not None}
    renames = {}
    if "pens" in frames:
        frames["pens_file"] = frames["pens"]
        renames["pens_file"] = {c: PENS_FILE.get(c, c) for c in frames["pens"].columns}
    return register_views(frames, renames)


def _scope(df: DataFrame) -> list[str]:
    return ["farm"] if "farm" in df.columns else []


def validate(store: TargetStore, source=None) -> DataFrame:
    """(check, passed, detail) over everything loaded: counts, references, quality, renamed columns, presence."""
    runs = store.current_runs()
    wanted = {k.child for k in FOREIGN_KEYS} | {k.parent for k in FOREIGN_KEYS}
    tables = {name: df for name in wanted if (df := store.read(name, runs)) is not None}
    current = store.spark.createDataFrame([(s, t, r) for (s, t), r in runs.items()], "source_table string, target_table string, run_id long")
    checks = [reports.count_checks(store.log().join(current, ["source_table", "target_table", "run_id"], "left_semi"))]
    keys = [k for k in FOREIGN_KEYS if k.child in tables and k.parent in tables]
    keys = [k for k in keys if k.column in tables[k.child].columns and k.key in tables[k.parent].columns]
    checks += reports.fk_checks(tables, keys)
    animals = [t for t in ANIMAL_TARGETS if t in tables and {"beast_id", "cow_id"} <= set(tables[t].columns)]
    checks += reports.filled_checks(tables, [(t, "beast_id", "cow_id") for t in animals])
    if "cattle.cows" in tables:
        checks += _animal_checks(tables["cattle.cows"])
    tags = store.read("cattle.ear_tag_assignments", runs)
    if tags is not None:
        checks.append(UniqueCheck("one active holder per tag", tags, (*_scope(tags), "ear_tag"), F.col("active")))
    costs = tables.get("finance.costs")
    if costs is not None and set(COST_GROUP) <= set(costs.columns):
        checks.append(UniqueCheck("one row per cost group", costs, (*_scope(costs), *COST_GROUP)))
    weights = tables.get("weighing.weighing_events")
    if weights is not None:
        checks.append(RowCheck("no negative weights", weights, F.col("weight") < 0))
    if source is not None:
        checks += _presence_checks(store, source, runs)
    return reports.all_checks(checks)


def _animal_checks(cows: DataFrame) -> list[DataFrame | Check]:
    active = F.col("status") == "active"
    eid = F.nullif(F.replace("eid", F.lit(" "), F.lit("")), F.lit("")).alias("eid")
    checks = [
        RowCheck("no empty tags", cows, F.col("ear_tag").isNull() | (F.col("ear_tag") == "")),
        UniqueCheck("unique electronic ids of active animals", cows, (*_scope(cows), eid), active),
    ]
    if "vendor_id" in cows.columns:
        checks.append(RowCheck("no zero vendors", cows, F.col("vendor_id") == 0))
    if "pen_id" in cows.columns:
        ratio = fill_ratio(cows, active, F.col("pen_id"))
        detail = F.concat_ws("", "filled_rows", F.lit("/"), "kept_rows", F.lit(" active animals in "), "distinct_values", F.lit(" pens"))
        checks.append(ratio.select(F.lit("active animals have pens").alias("check"), "passed", detail.alias("detail")))
    stranded = stranded_columns(cows, STRANDED_PAIRS).where("stranded")
    checks.append(reports.check("no data left in renamed columns", stranded, "columns"))
    stale = reports.stale_columns(cows, STALE_COLUMNS)
    row = [("no outdated columns", not stale, ",".join(stale) or "none")]
    return [*checks, cows.sparkSession.createDataFrame(row, "check string, passed boolean, detail string")]


def _presence_checks(store: TargetStore, source, runs) -> list[DataFrame]:
    groups = {"feed.feeding_details": "Details", "feed.feeding_regimens": "Regimens"}
    wanted = {t: [(f"{v}_Feeding_{part}", "feed") for v in FEEDING_VARIANTS] for t, part in groups.items()}
    checks = []
    for target, names in {**wanted, "system.lookups": [("SubGroupNames", "main")]}.items():
        found = [df for name, group in names if (df := source.read(name, group)) is not None]
        loaded = store.read(target, runs)
        if target == "system.lookups" and loaded is not None:
            loaded = loaded.where("category = 'sub_group'")
        if found and loaded is not None:
            checks.append(reports.loaded_check(f"loaded: {target}", [df.select(F.lit(1)) for df in found], loaded))
    return checks


def reconcile(store: TargetStore, source, tables: Sequence[str] | None = None) -> DataFrame:
    """Source and target rows of every mapped and raw table, each source against its own part of the target."""
    runs = store.current_runs()
    pairs = {}
    for spec in SPECS:
        if tables is None or spec.source in tables:
            run = runs.get((spec.source, spec.stored_as))
            part = None if run is None else store.read(spec.stored_as, {(spec.source, spec.stored_as): run})
            pairs[f"{spec.source} -> {spec.target}"] = (source.read(spec.source, spec.database), part)
    for name in RAW:
        if tables is None or name in tables:
            run = runs.get((name, "raw"))
            pairs[name] = (source.read(name, "main"), None if run is None else store.raw(name, run))
    return reports.reconcile(pairs)


def compare(store: TargetStore, source) -> DataFrame:
    """Field by field differences of the core tables over all keys."""
    runs, out = store.current_runs(), []
    for table, target, (source_key, target_key), columns in COMPARED:
        a, b = source.read(table, "main"), store.read(target, runs)
        if a is not None and b is not None and source_key in a.columns and target_key in b.columns:
            shared = {s: t for s, t in columns.items() if s in a.columns and t in b.columns}
            out.append(reports.diff(a, b, source_key, target_key, shared).select(F.lit(table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, out)


def audit_source(source) -> tuple[DataFrame, DataFrame]:
    """(profiles of the core tables, their references)."""
    tables = {name: df for name in PROFILE_META if (df := source.read(name, "main")) is not None}
    meta = {
        name: (key if key in tables[name].columns else None, [d for d in dates if d in tables[name].columns])
        for name, (key, dates) in PROFILE_META.items()
        if name in tables
    }
    keys = [k for k in SOURCE_KEYS if k.child in tables and k.parent in tables]
    return reports.profile_all(tables, meta), reports.fk_audit(tables, keys)


def coverage(spark, tables: DataFrame) -> DataFrame:
    """Strategy and issues of every table (table_name, row_count) found in a source."""
    return reports.coverage(tables, category_frame(spark), PATTERNS, [s.source for s in SPECS])
