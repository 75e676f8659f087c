"""What happens to every known source table: mapped, kept raw, or left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.catalogue.tables import SPECS

# Tables kept as raw JSON only.
RAW = ("Beast_days_in_pen_for_period", "Pen_DOF", "PenLaneOrder_old", "Pen_Print_Order_old")

# Report caches, staging tables and screen state.
EXCLUDED = (
    "BeastID_Archive_Filter",
    "BeastID_BU_Filter",
    "BeastID_Feed_Keys",
    "BeastID_Filter",
    "BeastID_Filter_BatchUpdate",
    "BeastID_KeyFile",
    "BeastID_Proj_KeyFile",
    "Bunk_Sheet_Report",
    "Bunks1203-IDS",
    "Com_Port_Settings",
    "CommodTrans_Crosstab_Kgs",
    "CommodTrans_Crosstab_val",
    "Computer_Names",
    "Costings_for_oracle",
    "Costs_Feed_Detail_tmp",
    "DB_Description",
    "Database_Flags",
    "DeliveryDockets_basic",
    "DigistarExportDataFile",
    "Digistar_Datakey_Import_Table",
    "Digistar_Import_Table",
    "DocketsApplied",
    "Drug_Usage_Analysis",
    "Drugs_Given_temp",
    "Feed_Card_Report_Data",
    "Feeding_Order_for_day",
    "Field_Names_Foreign_Conversion",
    "GraphImage",
    "GraphTable",
    "Head_by_pen_Comparison",
    "List of_Devices to be made Inactive",
    "Pen_CallWeight_date_snapshot",
    "Pen_Feeds_Tab",
    "Pen_Feeds_Temp",
    "Pen_Feeds_Temp_Cycles",
    "PenRiders_Report",
    "PensFedByDay1_CrossTab",
    "PensFedByDayRV1_CrossTab",
    "Period_Crosstab_Kgs",
    "Period_Crosstab_val",
    "RFIDs",
    "ScalesTypes",
    "StockRecFilter",
    "Transmitted_PensFed",
    "Transmitted_Pens_Fed_Datalink",
    "Transmitted_Truck_Loads",
    "Transmitted_Truck_Loads_Datalink",
    "Transmitted_Truckdata_Report",
    "Vet_Summary_report",
)

# Per-user work tables, by name pattern.
PATTERNS = ((r"(?i)^BatchUpdate_Keyfile_", "excluded"), (r"(?i)^BeastID_Keyfile_", "excluded"))


def categories() -> dict[str, str]:
    """Table -> strategy. A table with a mapping is mapped and nothing else, so no table is loaded twice."""
    named = dict.fromkeys(EXCLUDED, "excluded") | dict.fromkeys(RAW, "raw")
    return named | {spec.source: "mapped" for spec in SPECS}


def category_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(categories().items()), "table_name string, strategy string")
