"""The mapped tables.

Most tables need no more than their place: their columns follow the rules of `TableSpec`. What a table has
beyond that is in `DETAILS`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.catalogue import references as refs
from millrace.functions import codes, fallback_key
from millrace.functions.clean import trimmed
from millrace.operators.rank import disambiguate, number_rows
from millrace.spec import Latest, Rule, Surrogate, TableSpec, Unique

# Fixed values: (load order, source database, target schema) and the tables there. A table keeps its name in
# lower case unless another follows after a colon.
PLACES: dict[tuple[int, str, str], str] = {
    (10, "main", "carcase"): "Carcase_Grades Carcase_Grades_US",
    (10, "main", "cattle"): """Breeds Market_Category:market_categories Beast_Cull_Reasons:cull_reasons
        Cattle_Program_Types LocationTypes:location_types""",
    (10, "main", "commodity"): "Feed_Commodity_names:commodities",
    (10, "main", "contacts"): "Contacts ContactTypes",
    (10, "main", "feed"): "FeedDB_Pens_File RationNames:rations",
    (10, "main", "finance"): "Cost_Codes",
    (10, "main", "health"): "Diseases Drugs Sickness_Result_Codes Sickness_Result_Codes_RV:sickness_result_codes",
    (10, "main", "system"): """Breeds:lookups Beast_Sale_Types_RV:lookups BodySystems:lookups
        Breeding_Categories:lookups Code_References_Index Drug_Category:lookups Grower_Groups:lookups
        LocationTypes:lookups Purchase_Regions:lookups Sire_Lines:lookups SubGroupNames:lookups""",
    (10, "main", "weighing"): "Weighing_Types Weighing_Types_RV:weighing_types",
    (10, "feed", "feed"): "Bunk_Code_Desc Ration_Types Feed_Month_End_date",
    (10, "feed", "system"): """Transaction_Types MMEC_Table LoadDockageReasons:lookups Manure_Types:lookups
        Reason_List:lookups""",
    (15, "main", "carcase"): "Marbling_bonus",
    (15, "main", "cattle"): "Cattle_Specs",
    (15, "main", "contacts"): "Company Company_Settings",
    (15, "main", "feed"): "Feedlot_Staff",
    (15, "main", "finance"): """Cust_Feed_Charges:custom_feed_charges PackageCosts Price_adjustment_by_weight_range
        Tax_Invoice_Bank_details""",
    (15, "main", "health"): "Mort_Morb_triggers",
    (15, "main", "pen"): "Pen_Rider_Tolerances",
    (15, "main", "system"): "RV_Scheduled_DOF Computer_Names_old:computer_names",
    (15, "feed", "digistar"): "Digistar_Users",
    (15, "feed", "feed"): "Ration_Descriptions:rations Ration_Calc_Constants Ration_Load_Sizes",
    (15, "feed", "pen"): "Pens_File:pens PenLaneOrder Pen_Print_Order",
    (15, "feed", "transport"): "Truck_names Locations WbridgeCOMport",
    (20, "main", "carcase"): "Carcase_import_Data Carcase_Prices",
    (20, "main", "cattle"): "KD1_Records Trial_Description",
    (20, "main", "feed"): "Instrument_Calibration_tests Instruments_needing_Calibration Pen_and_Bunk_Cleaning",
    (20, "main", "finance"): "RCTI_payment_grid TR_Payment_rates TR_Payment_Breed_Adjust",
    (20, "main", "health"): """Chemical_inventory Chemical_inventory_old Drug_HGP_Forms
        Drug_Stocktake_records:drug_inventory_line_items Drug_Stocktakes:drug_inventory_events
        Drug_Transfer_Records:drug_inventory_line_items Drug_Transfers:drug_inventory_events
        Drugs_Purchase_event:drug_purchase_events Treatment_Regimes""",
    (20, "main", "purchasing"): "Purchase_Lots",
    (20, "main", "reporting"): "MRB_AVG_Supplier_Years",
    (20, "main", "weighing"): "Livestock_Weighbridge_Dockets",
    (20, "feed", "commodity"): "CommodContracts Period_Stocks_Closing_Balance Commodities",
    (20, "feed", "feed"): """Ration_Recipe_Records Pen_Feeding_Order_Params Titration_Ration_Regimes
        Pen_and_Bunk_Cleaning_Master:pen_and_bunk_cleaning""",
    (20, "feed", "system"): "Date_Design_Last_Updated:system_info PensFileIsOpen:database_flags",
    (30, "main", "cattle"): "Cattle:cows",
    (39, "main", "health"): "Sick_Beast_Records",
    (40, "main", "breeding"): "Beast_Breeding Breeding_Dams Breeding_Sires Rudd_800_Traits",
    (40, "main", "cattle"): """Agistment_Transfer_Register Beast_Ohead_Appl_History:overhead_application_history
        BeastMovement:beast_movements Cattle_DOF_and_DIP:cattle_dof_dip Cattle_Photos
        CattleProcessed:cattle_processed New_cattle_records_Log Purch_Lot_Cattle:purchase_lot_cattle
        Tag_Bucket_File:tag_bucket Overhead_application_history Despatched_RFIDs""",
    (40, "main", "contacts"): "ContactsContactTypes",
    (40, "main", "feed"): """Cattle_Feed_Update:cattle_feed_updates Paddock_Feeding
        Pen_Data_From_FeedDB:pen_data_from_feed_db Pending_Feed_Data Feeding_Time_Taken_By_Ration_Type""",
    (40, "main", "finance"): "Costs Beast_Accumed_Feed_by_commodity RV_RCTI_data",
    (40, "main", "health"): """Drugs_Given Resp_Disease_ReTreats SB_Rec_No_Booked Sick_Beast_BRD_Symptoms
        Sick_Beast_Temperature:sick_beast_temperatures""",
    (40, "main", "pen"): "PensHistory PenRiders_log PensFed",
    (40, "main", "reporting"): "SCU_RecData:scu_rec_data StockRecData:stock_rec_data",
    (40, "main", "transport"): "Location_Changes Datakey_truck_allocation",
    (40, "main", "weighing"): "Weighing_Events",
    (40, "feedtrans", "finance"): "Costs_Feed_Detail",
    (40, "feed", "commodity"): "CommodTrans",
    (40, "feed", "digistar"): "Digistar_Data_History",
    (40, "feed", "feed"): """Bunk_Readings Dual_Ration_Feeding Ration_Regimes Pen_Split_Rations:ration_regimes
        NSA_Bunk_Data Feeding_time_data PenFeedsData""",
    (40, "feed", "pen"): "Pen_Cleaning_dates Log_Pens_File",
    (40, "feed", "transport"): """Truck_Loads TruckLoadChangesLog Truck_Load_variation_data DeliveryDockets
        LoadDockages Location_Transactions Manure_carting Manure_From_Locations:manure_locations
        Manure_To_Locations:manure_locations""",
    (50, "main", "carcase"): """Carcase_data Carc_Feedback_Compliance Carc_Feedback_Mth_Avgs
        Carc_Feedback_Report_data:carcase_feedback_report_data Carcase_DataType2""",
    (50, "main", "cattle"): "Batch_Update_log Daily_Cattle_Inventory PenList_AsAt:pen_list_snapshots",
    (50, "main", "feed"): "Vendor_Declarations Feed_Totals_By_Ration",
    (50, "main", "finance"): """CustFeed_Invoices_list Custfeed_Lot_Summary Monthly_FL_Intake_Cost
        TandR_Buying_details TandR_Costs_Report:trading_costs_report""",
    (50, "main", "health"): """Autopsy_Records Drugs_Purchased Drug_Disposal:drug_disposals Head_By_Disease
        Sick_By_DOF""",
    (50, "main", "operations"): "Archiving_Log",
    (50, "main", "pen"): "Pen_mort_morb_list:pen_mort_morb",
    (50, "main", "purchasing"): "Purchase_Totals",
    (50, "main", "reporting"): """Cattle_by_Location_Table:cattle_by_location
        Cattle_Query_Month_Report_TAB:cattle_query_month_report Last_7_Days_Pulls_Headcounts:last_7_days_pulls
        Month_End_StockOnHand Monthly_Adjustment_OB Monthly_Agistor_Movements
        Monthly_Feedlot_Reconciliation:monthly_reconciliation Monthly_Movements Monthly_RV_Agist_Reconciliation
        SOH_by_Month""",
    (50, "main", "system"): "Error_Log User_Log_Ons",
}

# Feeding programmes, each with a table of details and one of regimens.
FEEDING_VARIANTS = ("GE150", "L150", "Plateau", "ShortFeed", "WAGYU")

# Event targets kept by year, their date columns, and the years.
BY_YEAR = {
    "health.drugs_given": "date_given",
    "feed.penfeedsdata": "feed_date",
    "finance.costs_feed_detail": "date_fed",
    "commodity.commodtrans": "trans_date",
    "digistar.digistar_data_history": "feed_date",
}
FIRST_YEAR, LAST_YEAR = 2020, 2029

# Columns a target row must have, per target.
REQUIRED: dict[str, str] = {
    "cattle.breeds": "name",
    "cattle.cattle_program_types": "program_id program_code",
    "cattle.trial_description": "trial_no",
    "cattle.location_types": "name",
    "cattle.batch_update_log": "date_done",
    "health.drug_inventory_events": "event_id event_date",
    "health.drug_inventory_line_items": "event_id",
    "health.sickness_result_codes": "sickness_result_code",
    "health.sb_rec_no_booked": "sb_rec_no_booked",
    "health.resp_disease_retreats": "drug_count head deaths",
    "health.drug_purchase_events": "drug_receival_id date_received",
    "health.sick_beast_brd_symptoms": "sb_rec_no",
    "feed.rations": "ration_code ration_name",
    "feed.feeding_time_data": "feed_date",
    "feed.feeding_time_taken_by_ration_type": "feed_date",
    "feed.penfeedsdata": "feed_date",
    "feed.feeddb_pens_file": "pen_name",
    "feed.cattle_feed_updates": "feed_date",
    "pen.pens": "name",
    "pen.penshistory": "movedate",
    "pen.penriders_log": "date_pen_checked",
    "finance.costs_feed_detail": "date_fed",
    "finance.custfeed_lot_summary": "purch_lot_no",
    "carcase.marbling_bonus": "marbling_score",
    "carcase.carc_feedback_compliance": "supplier_id",
    "carcase.carc_feedback_mth_avgs": "yr_mnth",
    "purchasing.purchase_lots": "lot_number",
    "commodity.commodtrans": "trans_date",
    "transport.truck_names": "truck_name",
    "transport.truck_loads": "load_date",
    "transport.locations": "location_name",
    "transport.location_changes": "movement_date",
    "transport.deliverydockets": "docket_date",
    "contacts.company": "company_name",
    "contacts.contacttypes": "contact_type",
    "contacts.contactscontacttypes": "contact_id contact_type_id",
    "system.lookups": "category code",
    "system.transaction_types": "trans_type_id",
    "system.computer_names": "computer_name",
    "digistar.digistar_data_history": "feed_date",
}

# What a column may hold, per target; a null passes.
ALLOWED: dict[str, dict[str, str]] = {
    "cattle.cows": {
        "sex": "sex IN ('heifer', 'cow', 'steer', 'bull')",
        "status": "status IN ('active', 'sold', 'died', 'archived')",
        "start_weight_kg": "start_weight_kg >= 0",
        "sale_weight_kg": "sale_weight_kg >= 0",
        "carcase_weight_kg": "carcase_weight_kg >= 0",
    },
    "weighing.weighing_events": {
        "weigh_type": "weigh_type IN ('intake', 'interim', 'exit', 'sale')",
        "weight": "weight >= 0",
    },
    "finance.cost_codes": {"type": "type IN ('revenue', 'expense')"},
    "contacts.contacts": {
        "type": "type IN ('vendor', 'agent', 'buyer', 'abattoir', 'carrier', 'agistor', 'customer-feeder', 'other')"
    },
    "feed.rations": {"dry_matter_pcnt": "dry_matter_pcnt BETWEEN 0 AND 100"},
    "feed.ration_recipe_records": {"pcnt_of_ration": "pcnt_of_ration BETWEEN 0 AND 100"},
    "commodity.commodities": {"shrinkage_factor": "shrinkage_factor BETWEEN 0 AND 1"},
    "system.transaction_types": {"trans_effect": "trans_effect IN ('+', '-')"},
}

# Tables whose target columns split names at capitals.
SPLIT_AT_CAPITALS = frozenset(
    """Carcase_data Beast_Cull_Reasons Cust_Feed_Charges Chemical_inventory Chemical_inventory_old Location_Changes
    BeastMovement Cattle_Feed_Update Cattle_Photos CattleProcessed New_cattle_records_Log Paddock_Feeding
    Pending_Feed_Data Purch_Lot_Cattle Resp_Disease_ReTreats Rudd_800_Traits SCU_RecData Sick_Beast_Temperature
    StockRecData Batch_Update_log Carc_Feedback_Compliance Carc_Feedback_Mth_Avgs Carc_Feedback_Report_data
    Cattle_by_Location_Table Cattle_Query_Month_Report_TAB Custfeed_Lot_Summary Feed_Totals_By_Ration
    Last_7_Days_Pulls_Headcounts Monthly_Movements Pen_mort_morb_list PenList_AsAt Sick_By_DOF
    TandR_Buying_details TandR_Costs_Report Pens_File PenLaneOrder Pen_Print_Order Digistar_Users
    WbridgeCOMport""".split()
)

# Tables whose animal reference is replaced by the new id.
ANIMAL_TABLES = frozenset(
    """Weighing_Events PensHistory Drugs_Given Costs Sick_Beast_Records Carcase_data Autopsy_Records
    Location_Changes Beast_Accumed_Feed_by_commodity Beast_Breeding Paddock_Feeding Sick_Beast_Temperature
    Carc_Feedback_Report_data Cattle_Query_Month_Report_TAB Feed_Totals_By_Ration PenList_AsAt
    TandR_Buying_details TandR_Costs_Report""".split()
)


def _kinds(kind: str, columns: str) -> dict[str, str]:
    return dict.fromkeys(columns.split(), kind)


def _lookup(category: str, code: str, label: str, **more) -> dict:
    columns = {code: "code", label: "label"} if code else {label: "label"}
    return {"rename": columns, "static": {"category": category}, "unique": (Unique(("category", "code")),), **more}


def _not_junk(column: str) -> str:
    words = ", ".join(f"'{w}'" for w in refs.JUNK_BREEDS)
    return f"{column} IS NOT NULL AND {column} NOT IN ({words})"


def _is_set(column: str):
    return lambda df: F.col(column).isNotNull()


def _junk_animal(df: DataFrame) -> Column:
    """Header lines and farm-name lines: no electronic id, and a tag that is a heading or has no number."""
    tag = trimmed(F.coalesce(F.col("Ear_Tag").cast("string"), F.lit("")))
    no_eid = trimmed(F.coalesce(F.col("EID").cast("string"), F.lit(""))) == ""
    heading = F.lower(tag).rlike(r"^(ear\s*tag|eid|beastid)$")
    weightless = F.coalesce(F.col("Start_Weight").try_cast("double") == 0, F.lit(False))
    return no_eid & (heading | (weightless & ~tag.rlike(r"^\d")))


def _animal_status(df: DataFrame) -> Column:
    names = ("Died", "Sale_Date", "Date_Archived")
    return codes.lifecycle_status(*[F.col(n) for n in names], tuple(df.schema[n].dataType for n in names))


def _scope(df: DataFrame) -> list[str]:
    return ["farm"] if "farm" in df.columns else []


def _named_drugs(df: DataFrame) -> DataFrame:
    return disambiguate(df, "Drug_Name", "Drug_ID", "Drug_Name", "Unknown", "Unknown Drug ", _scope(df))


def _keyed_lots(df: DataFrame) -> DataFrame:
    return df.withColumn("Lot_Number", fallback_key("Lot_Number", "ID"))


def _coded_rations(df: DataFrame) -> DataFrame:
    """Codes above 20000 in name order, clear of the feed system's own codes."""
    return number_rows(df, ["Ration_name"], "Ration_Code", 20000, _scope(df))


MODIFIED = {"Last_Modified_timestamp": ("legacy_modified_at",)}
BEAST = {"BeastID": "beast_id"}
BEAST_TWICE = {"BeastID": ("beastid",)}
MONTH_END = {"Month_End_Date": "period_date"}

DETAILS: dict[str, dict] = {
    "Breeds->system.lookups": _lookup("breed", "Breed_Code", "Breed_Name", validate=_not_junk("label"), sort=("Breed_Code",)),
    "Breeds->cattle.breeds": {
        "rename": {"Breed_Name": "name"},
        "drop": ("Breed_Code",),
        "where": _is_set("Breed_Name"),
        "validate": _not_junk("name"),
        "sort": ("Breed_Code",),
        "unique": (Unique(("name",)),),
        "surrogate": Surrogate("id", ("name",)),
    },
    "FeedDB_Pens_File": {"kind": _kinds("bool", "ispaddock include_in_pen_list"), "validate": "pen_name IS NOT NULL"},
    "Contacts": {
        "sort": ("Contact_ID",),
        "unique": (Unique(("contact_id",)),),
        "rename": {"PostCode": "post_code"},
        "mirror": {
            "PostCode": ("postcode",),
            "Salutation": ("title",),
            "Address_1": ("address",),
            "Tel_No": ("phone",),
            "Mobile_No": ("mobile",),
            "Fax_No": ("fax",),
            "Contact_Type": ("type",),
            "Tail_Tag_No": ("tail_tag",),
            "Bank_AC": ("bank_acct",),
            "Days_invoice_due": ("payment_due_days",),
            "Agistment_Paddock_Rate": ("paddock_agistment_rate",),
            "Agistment_Feedlot_Rate": ("feedlot_agistment_rate",),
            "Invoice_careof": ("invoice_co",),
            "Last_Modified_timestamp": ("updated_at", "legacy_modified_at"),
        },
        "kind": {"type": "contact_type", "contact_type": "num"},
    },
    "Diseases": {
        "sort": ("Disease_ID",),
        "mirror": {"Disease_Name": ("name",), "No_longer_used": ("active",), "PenApp_Disease_name": ("penapp_name",)},
        "kind": {"active": "not_bool", **_kinds("bool", "recoverable no_longer_used autopsy_disease")},
        "validate": "name IS NOT NULL",
        "unique": (Unique(("name",)), Unique(("disease_id",))),
        "surrogate": Surrogate("id", ("disease_id",)),
    },
    "Drugs": {
        "sort": ("Drug_ID",),
        "prepare": _named_drugs,
        "expect": ("Drug_Name", "Drug_ID"),
        "mirror": {
            "Drug_Name": ("name",),
            "Units": ("unit",),
            "WithHold_days_1": ("withhold_days",),
            "WithHold_days_ESI": ("esi_days",),
            "HGP": ("is_hgp",),
            "Antibiotic": ("is_antibiotic",),
            "Inactive": ("active",),
            "Current_Batch_Numb": ("current_batch",),
            "Reorder_SOH_units_trigger": ("reorder_trigger_units",),
            "Units_per_BoxOrBottle": ("units_per_package",),
            **MODIFIED,
        },
        "kind": {
            "active": "not_bool",
            "admin_units": "text",
            **_kinds("bool", "hgp is_hgp antibiotic is_antibiotic inactive"),
        },
        "validate": "name IS NOT NULL",
        "unique": (Unique(("name",)), Unique(("drug_id",))),
        "surrogate": Surrogate("id", ("drug_id",)),
    },
    "Cost_Codes": {
        "sort": ("RevExp_Code",),
        "mirror": {"RevExp_Desc": ("description",), "Rev_Exp": ("cost_type", "type")},
        "kind": {"type": "cost_type"},
        "validate": "revexp_desc IS NOT NULL",
        "unique": (Unique(("revexp_code",)),),
        "surrogate": Surrogate("id", ("revexp_code",)),
    },
    "Market_Category": {
        "sort": ("Market_Cat_ID",),
        "mirror": {"Market_Category": ("name",), "Predicted_dressing_pcnt": ("predicted_dressing_pct",)},
        "validate": "name IS NOT NULL",
        "unique": (Unique(("name",)),),
    },
    "Purchase_Lots": {
        "sort": ("ID",),
        "prepare": _keyed_lots,
        "expect": ("Lot_Number", "ID"),
        "rename": {"Agistor_Code": "agistor_id", "Date_Cattle_Inv_Approved": "cattle_inv_date_approved"},
        "mirror": {
            "Number_Head": ("numb_head",),
            "Total_Weight": ("total_weight_kg",),
            "Cost_of_Cattle": ("total_cost",),
            "Cattle_Freight_Cost": ("freight_cost",),
            "Lot_Notes": ("notes",),
            "Invoice_Amount": ("cattle_inv_amount",),
            "Buyer": ("buyer_id",),
            "Weigh_bridge_weight": ("weighbridge_weight",),
            **MODIFIED,
        },
        "kind": {
            **_kinds("fk", "vendor_id agent_code agistor_id buyer_id"),
            **_kinds("text", "market_category marbling_bonus_lot"),
            **_kinds("num", "finance_rate number_head"),
        },
        "validate": "lot_number IS NOT NULL",
        "unique": (Unique(("lot_number",)),),
        "surrogate": Surrogate("id", ("lot_number",)),
    },
    "Cattle": {
        "sort": ("BeastID",),
        "latest": Latest(("BeastID",), ("Feedlot_Entry_Date", "Start_Date")),
        "skip": _junk_animal,
        "expect": ("Ear_Tag", "EID", "Start_Weight", "Died", "Sale_Date", "Date_Archived", "Pen_Number", "Purch_Lot_No"),
        "rename": {
            "BeastID": "legacy_beast_id",
            "Breed": "breed_id",
            "Feedlot_Entry_Wght": "feedlot_entry_weight_kg",
            "Sale_Weight": "sale_weight_kg",
            "Start_Weight": "start_weight_kg",
            "Vendor_Ear_Tag": "previous_ear_tag",
            "Background_Doll_per_Kg": "background_cost_per_kg",
            "WHold_Until": "withhold_until",
            "Current_LocType_ID": "current_loc_type_id",
            "NFAS_Decl_Numb": "nfas_decl_number",
            "GrowerGroupCode": "grower_group_code",
            "ESI_Whold_until": "esi_withhold_until",
            "PregTested": "preg_tested",
            "CustomFeedOwnerID": "custom_feed_owner_id",
            "NLIS_tag_fail_at_induction": "nlis_tag_fail",
            "DNA_or_Blood_Number": "dna_blood_number",
            "VendorID": "vendor_id",
            "AgentID": "agent_id",
            "Agist_Charged_Up_To_Date": "agist_charged_to_date",
            "Last_Modified_timestamp": "legacy_modified_at",
            "Weight_Gain": "weight_gain_kg",
            "Carcase_Weight": "carcase_weight_kg",
            "Paddock_WG": "paddock_weight_gain_kg",
            "Feedlot_WG": "feedlot_weight_gain_kg",
        },
        "mirror": {"Feedlot_Entry_Date": ("entry_date",)},
        "kind": {
            "legacy_beast_id": "keep",
            "sex": "sex",
            "sale_date": "real_date",
            **_kinds("num", "breed_id teeth"),
            **_kinds("text", "ap_lot marbling_bonus_lot"),
            **_kinds("fk", "custom_feed_owner_id vendor_id agent_id program_id"),
            **_kinds("bool", "in_feedlot died hgp"),
            **_kinds("date", "date_died start_date feedlot_entry_date entry_date date_archived dob"),
        },
        "derive": {"status": _animal_status},
        "references": (refs.PEN_ROW, refs.LOT_ROW),
        "unique": (
            Unique(("legacy_beast_id",)),
            Unique(("replace(eid, ' ', '')",), "status = 'active' AND eid IS NOT NULL AND replace(eid, ' ', '') <> ''"),
        ),
        "surrogate": Surrogate("id", ("legacy_beast_id",)),
    },
    "Weighing_Events": {
        "rename": {**BEAST, "TimeWeighed": "time_weighed"},
        "mirror": {
            **BEAST_TWICE,
            "Weighing_Type": ("weigh_type",),
            "Weight": ("weight_kg",),
            "Weigh_Note": ("notes",),
            **MODIFIED,
        },
        "kind": {"weigh_type": "weigh_type", "weigh_date": "event_date", "time_weighed": "text"},
        "expect": ("Weigh_date",),
        "validate": "weight IS NOT NULL",
    },
    "PensHistory": {
        "rename": BEAST,
        "mirror": {**BEAST_TWICE, "Pen": ("pen_name",), **MODIFIED},
        "kind": {"movedate": "event_date"},
        "expect": ("MoveDate",),
    },
    "Drugs_Given": {
        "rename": BEAST,
        "mirror": {**BEAST_TWICE, **MODIFIED},
        "kind": {
            "drug_id": "fk",
            "units_given": "not_negative",
            "date_given": "event_date",
            "sb_rec_no": "record_number",
        },
        "expect": ("Date_Given",),
        "references": (refs.DRUG_ROW,),
        "without": ("health.drugs",),
    },
    "Costs": {
        "rename": BEAST,
        "mirror": {
            **BEAST_TWICE,
            "Rev_Exp_per_Unit": ("price_per_unit",),
            "Extended_RevExp": ("total",),
            **MODIFIED,
        },
        "kind": {"units": "num_or_one", "trans_date": "date"},
        "expect": ("Units",),
        "references": (refs.COST_CODE_ROW,),
        "validate": "total IS NOT NULL",
    },
    "Sick_Beast_Records": {
        "sort": ("SB_Rec_No",),
        "mirror": MODIFIED,
        "kind": {
            "sb_rec_no": "keep",
            **_kinds("fk", "disease_id diagnoser_empl_id customfeedownerid"),
            **_kinds("text", "result_code cause_of_death"),
            **_kinds("date", "date_diagnosed date_to_sick_pen date_back_to_pen date_recovered_died"),
            **_kinds("bool", "euthanased autopsied"),
        },
        "validate": "date_diagnosed IS NOT NULL",
        "unique": (Unique(("sb_rec_no",)),),
    },
    "Carcase_data": {
        "rename": {
            "Carc_Wght_left": "carc_weight_left",
            "Carc_Wght_right": "carc_weight_right",
            "Price_$/Kg_Left": "price_per_kg_left",
            "Price_$/Kg_Right": "price_per_kg_right",
            "Mscle_Score": "muscle_score",
            "Eye_Mscle_Area": "eye_muscle_area",
            "Mscle_Colour": "muscle_colour",
            "$/Kg_Deduction": "deduction_per_kg",
            "RCInvoice_Date": "rc_invoice_date",
            "MEQMSA": "meq_msa",
            "MEQAUSMRB": "meq_aus_mrb",
            "Abattoir_Establishment_Number": "abattoir_est_no",
            "Last_Modified_timestamp": "legacy_modified_at",
        },
        "mirror": {
            "Dress_Pcnt": ("dress_pct",),
            "PH_level": ("ph",),
            "Mscle_Colour": ("meat_colour",),
            "Live_Weight_Shrink_Pcnt": ("live_weight_shrink_pct",),
            "MSA_Index": ("carc_msa_index",),
            "Abattoir_ID": ("abattoir_contact_id",),
        },
        "kind": {
            **_kinds("num", "muscle_colour meat_colour"),
            **_kinds("text", "firmness pricing_method abattoir_est_no"),
            **_kinds("fk", "sold_to_contact_id abattoir_id abattoir_contact_id"),
        },
    },
    "Autopsy_Records": {"sort": ("SB_Rec_No",), "kind": {"liver_colour": "text"}, "unique": (Unique(("sb_rec_no",)),)},
    "Vendor_Declarations": {
        "rename": {
            "QA_Program_details": "qa_details",
            "Chem_Res_restriction": "chem_restriction",
            "Withholding_for_drugs": "withholding_drugs",
            "Withholding_for_feed": "withholding_feed",
        },
        "mirror": {"Form_Date": ("date_signed",)},
        "kind": {
            "owner_contact_id": "fk",
            "endosulfan_date": "date",
            **_kinds(
                "bool",
                """rfids_in_cattle hgp_treated qa_program fed_stockfeeds chem_restriction withholding_drugs
                withholding_feed endosulfan_exposure fed_animal_fats born_on_vend_prop owned_lt_2months
                owned_2_6_months owned_6_12_months owned_gt_12_months""",
            ),
        },
    },
    "Drugs_Purchased": {"kind": {"drugid": "fk"}},
    "Drug_Disposal": {
        "rename": {"Date_disposed": "disposal_date", "Disposal_ID": "legacy_disposal_id"},
        "mirror": {"Number_disposed": ("quantity",)},
        "kind": {"drugid": "fk"},
    },
    "Beast_Cull_Reasons": {
        "sort": ("Cull_Reason_ID",),
        "rename": {"Cull_Reason_ID": "code", "Cull_Reason": "description"},
        "kind": {"code": "text"},
        "validate": "code IS NOT NULL",
        "unique": (Unique(("code",)),),
    },
    "Beast_Sale_Types_RV": _lookup("beast_sale_type", "Sale_Type_ID", "Sale_Type"),
    "BodySystems": _lookup("body_system", "BS_ID", "BodySystem"),
    "Breeding_Categories": {
        **_lookup("breeding_category", "Breed_Category_ID", "Breed_Category"),
        "rename": {"Breed_Category_ID": "code", "Breed_Category": "label", "Breed_Category_Desc": "description"},
    },
    "Carcase_Grades": {
        "sort": ("ID",),
        "rename": {"Price_doll_per_Kg": "price_per_kg"},
        "mirror": {"Grade_Code": ("code",), "Description": ("grade_desc",)},
        "unique": (Unique(("code",)), Unique(("grade_code",))),
    },
    "Carcase_Grades_US": {
        "sort": ("ID",),
        "rename": {"Qual_Grade": "grade_code"},
        "mirror": {"Qual_Grade": ("grade_desc",)},
        "validate": "grade_code IS NOT NULL",
        "unique": (Unique(("grade_code",)),),
    },
    "Cattle_Program_Types": {"sort": ("Program_ID",), "unique": (Unique(("program_id",)),)},
    "ContactTypes": {"sort": ("Contact_Type_ID",), "unique": (Unique(("contact_type_id",)),)},
    "Drug_Category": _lookup("drug_category", "Drug_Category", "Category_Description"),
    "Feed_Commodity_names": {"rename": {"Commodity_Name": "commod_name"}, "sort": ("ID",)},
    "Grower_Groups": _lookup("grower_group", "GrowerGroup_Code", "GrowerGroup_Name"),
    "LocationTypes->system.lookups": _lookup("location_type", "Loc_Type_code", "Location_Type"),
    "LocationTypes->cattle.location_types": {
        "rename": {"Location_Type": "name"},
        "drop": ("Loc_Type_code",),
        "where": _is_set("Location_Type"),
        "validate": "name IS NOT NULL",
        "sort": ("Loc_Type_code",),
        "unique": (Unique(("name",)),),
    },
    "Purchase_Regions": _lookup("purchase_region", "Region_ID", "Region_name"),
    "RationNames": {
        "prepare": _coded_rations,
        "expect": ("Ration_name",),
        "sort": ("Ration_name",),
        "unique": (Unique(("ration_code",)),),
    },
    "Sickness_Result_Codes": {"static": {"variant": "Standard"}},
    "Sickness_Result_Codes_RV": {"static": {"variant": "RV"}},
    "Sire_Lines": _lookup("sire_line", "Sire_Line_ID", "Sire_Line"),
    "SubGroupNames": _lookup("sub_group", "", "Sub_Group", unique=()),
    "Weighing_Types": {"rename": {"Weighing_Type": "weighing_type_id"}, "mirror": {"Weighing_Desc": ("weighing_type",)}},
    "Cattle_Specs": {
        "rename": {"Dressing % From": "dressing_pct_from", "Dressing % To": "dressing_pct_to", "Marbling>=": "marbling_gte"}
    },
    "Company": {
        "kind": {
            "logo": "binary",
            **_kinds(
                "bool",
                """rfid_space_removed v11_database nsa_client user_logon digistar_datalink digistar_datakey
                password_complexity titration_feeding""",
            ),
        }
    },
    # passwords of the staff list are left behind on purpose
    "Feedlot_Staff": {
        "sort": ("User_ID",),
        "drop": ("Pass_word",),
        "kind": _kinds(
            "bool",
            """cattle_data_entry cattle_reports cattle_utilities cattle_lookup_tables feed_system_data_entry
            feed_system_reports feed_system_utilities pl_reports_allowed cattle_deletes pen_rider""",
        ),
        "unique": (Unique(("user_id",)),),
    },
    "Chemical_inventory": {"references": (refs.CHEMICAL_DRUG_ROW,)},
    "Chemical_inventory_old": {
        "kind": _kinds("text", "expiry_date stocktake_date"),
        "references": (refs.CHEMICAL_DRUG_ROW,),
    },
    "Drug_Stocktake_records": {
        "rename": {
            "Stocktake_ID": "event_id",
            "On_hand_theoritical": "on_hand_theoretical",
            "Counted": "quantity",
            "Diffrence": "balance",
        },
        "kind": {"applied_to_soh": "bool"},
        "static": {"record_type": "Stocktake"},
    },
    "Drug_Stocktakes": {
        "rename": {"Stocktake_ID": "event_id", "Stock_Date": "event_date"},
        "static": {"event_type": "Stocktake"},
    },
    "Drug_Transfer_Records": {
        "rename": {"Transfer_ID": "event_id", "Transferred": "quantity", "Remaining": "balance"},
        "kind": {"applied_to_soh": "bool"},
        "static": {"record_type": "Transfer"},
    },
    "Drug_Transfers": {
        "rename": {"Transfer_ID": "event_id", "Transfer_Date": "event_date"},
        "static": {"event_type": "Transfer"},
    },
    "Drugs_Purchase_event": {"sort": ("ID",), "unique": (Unique(("drug_receival_id",)),)},
    "Instrument_Calibration_tests": {
        "rename": {"Test_date": "calibration_date", "Instrument_name": "instrument_type", "Test_Notes": "notes"}
    },
    "Instruments_needing_Calibration": {
        "rename": {"Instrument_name": "instrument_type", "Date_last_tested": "last_calibration_date"}
    },
    "KD1_Records": {"rename": {"Group": "group_name"}},
    "Trial_Description": {"sort": ("Trial_No",), "unique": (Unique(("trial_no",)),)},
    "Livestock_Weighbridge_Dockets": {
        "rename": {"CarrierID": "carrier_id", "Origin_DestinationID": "origin_dest_id"},
        "kind": {"docket_number": "text", **_kinds("time", "docket_time exit_time"), **_kinds("fk", "carrier_id origin_dest_id")},
    },
    "Treatment_Regimes": {"kind": {**_kinds("fk", "diseaseid drug_id"), "dosebyweight": "bool"}, "staged": True},
    "Agistment_Transfer_Register": {"rename": {"WeightGain_$perKg": "weightgain_doll_per_kg"}},
    "Location_Changes": {"rename": BEAST},
    "Beast_Accumed_Feed_by_commodity": {
        "rename": {**BEAST, "Accumed_Kgs": "total_kgs", "Accumed_Cost": "total_value"},
    },
    "Beast_Breeding": {"references": (refs.BREED_NAME,), "sort": ("Beast_ID",)},
    "Breeding_Dams": {"references": (refs.BREED_NAME,), "sort": ("Dam_ID",), "unique": (Unique(("dam_id",)),)},
    "Breeding_Sires": {"references": (refs.BREED_NAME,), "sort": ("Sire_ID",), "unique": (Unique(("sire_id",)),)},
    "Beast_Ohead_Appl_History": {
        "rename": {
            "Ohead_$/Hd/Day": "ohead_doll_hd_day",
            **{f"Ohead_$/Hd/Day_{p}": f"ohead_cost_per_hd_day_{p.lower()}" for p in ("Pen1", "Pen2", "Pen3", "Pen4", "Pen5", "Oth")},
        },
        "kind": {
            f"ohead_{what}_{p}": "text"
            for what in ("cost_per_hd_day", "gross_value", "head")
            for p in ("pen1", "pen2", "pen3", "pen4", "pen5", "oth")
        },
    },
    "BeastMovement": {"rename": {"BeastID": "cow_id"}},
    "Cattle_DOF_and_DIP": {"rename": {"BeastID": "cow_id", "Date_Calculated": "calc_date"}},
    "Cattle_Photos": {"rename": {"BeastID": "cow_id"}, "kind": {"photo": "binary"}},
    "CattleProcessed": {"rename": {"BeastID": "cow_id"}},
    "New_cattle_records_Log": {
        "rename": {"BeastID": "cow_id", "Mod_ule": "module", "Proceedure_Name": "procedure_name"}
    },
    "ContactsContactTypes": {"sort": ("ID",), "unique": (Unique(("contact_id", "contact_type_id")),)},
    "PensFed": {
        "rename": {"KilosFed": "kilos_fed", "FeedValue": "feed_value", "Last_Modified_timestamp": "legacy_modified_at"}
    },
    "Purch_Lot_Cattle": {
        "rename": {
            "Numb_Head": "head_count",
            "Price_Cnts_per_Kg": "price_cents_per_kg",
            "Vndr_Decl_No": "vendor_decl_no",
            "Last_Modified_timestamp": "legacy_modified_at",
        }
    },
    "Sick_Beast_BRD_Symptoms": {"rename": {"BeastID": "cow_id"}},
    "Tag_Bucket_File": {"sort": ("RFID_Number",), "unique": (Unique(("rfid_number",)),)},
    "Daily_Cattle_Inventory": {"sort": ("Inventory_Date",), "unique": (Unique(("inventory_date",)),)},
    "Month_End_StockOnHand": {"rename": {**MONTH_END, "SOH_Head": "head_count", "Total_Costs": "total_value"}},
    "Monthly_Adjustment_OB": {"rename": {"Month_End_Date": "adj_date", "Head": "head_count", "Prime_Cost": "value"}},
    "Monthly_Agistor_Movements": {"rename": {**MONTH_END, "Section_Name": "movement_type", "Head": "head_count"}},
    "Monthly_Feedlot_Reconciliation": {"rename": {**MONTH_END, "Head": "closing_head"}},
    "Monthly_FL_Intake_Cost": {
        "rename": {"Month_End_Date": "month_year", "Prime_Cost": "avg_cost", "Head": "head_count"},
        "kind": {"month_year": "text"},
    },
    "Monthly_Movements": {"rename": {**MONTH_END, "Section_Name": "movement_type", "Culls_Head": "head_count"}},
    "Sick_By_DOF": {
        "rename": {
            f"{a}-{b}_Days": f"days_{a}_{b}"
            for a, b in (
                (0, 29), (30, 59), (60, 89), (90, 119), (120, 159), (160, 189),
                (190, 219), (220, 249), (250, 289), (290, 319), (320, 359),
            )
        }
    },
    "SOH_by_Month": {"rename": {"MnthYYYYmmm": "yr_mnth", "Head": "head_count"}},
    "TandR_Buying_details": {
        "rename": {"Date_Purchased": "purchase_date"},
        "sort": ("BeastID",),
        "unique": (Unique(("cow_id",)),),
    },
    "TandR_Costs_Report": {"rename": {"Group": "group_name"}},
    "Ration_Types": {
        "sort": ("Ration_Type_ID",),
        "rename": {"Ration_Type": "ration_type_desc"},
        "unique": (Unique(("ration_type_id",)),),
    },
    "Transaction_Types": {
        "sort": ("Trans_Type_ID",),
        "rename": {"Trans_Type_Long": "trans_desc"},
        "unique": (Unique(("trans_type_id",)),),
    },
    "MMEC_Table": {
        "rename": {"DOF": "mmec_code", "Target_Multiplier": "mmec_desc"},
        "kind": _kinds("text", "mmec_code mmec_desc"),
    },
    "LoadDockageReasons": _lookup("dockage_reason", "Reason_ID", "Dockage_Reason"),
    "Manure_Types": _lookup("manure_type", "ID", "Manure_Type"),
    "Reason_List": _lookup("reason_list", "Reason_ID", "Reason_Description"),
    "Ration_Descriptions": {
        "sort": ("Ration_Code",),
        "mirror": {"Current_Value_Kg": ("cost_per_tonne",)},
        "unique": (Unique(("ration_code",)),),
    },
    "Ration_Calc_Constants": {
        "rename": {"RationCode": "constant", "MinNEm_Constant": "value"},
        "kind": {"constant": "text"},
    },
    "Ration_Load_Sizes": {"sort": ("Ration_Type_ID",), "unique": (Unique(("ration_type_id",)),)},
    "Truck_names": {"rename": {"Max_Kgs_Load_Value": "capacity"}},
    "Locations": {"sort": ("ID",), "unique": (Unique(("location_id",)),)},
    "Pens_File": {
        "sort": ("Pen_Number_ID",),
        "rename": {
            "Pen_Number_ID": "id",
            "Pen_Name": "name",
            "Numb_Head": "current_head",
            "Ration_Code": "current_ration_code",
        },
        "kind": {"id": "num", "is_paddock": "bool", "date_last_cleaned": "date"},
        "unique": (Unique(("id",)), Unique(("name",))),
    },
    "WbridgeCOMport": {"rename": {"COMport": "port_name"}, "kind": {"baud_rate": "num"}},
    "Log_Pens_File": {"kind": {"ispaddock": "bool", "date_last_cleaned": "date"}},
    "DeliveryDockets": {"kind": {"weighunits": "bool"}},
    "Marbling_bonus": {
        "sort": ("ID",),
        "rename": {"Pay_rate_bonus_per_carcase_Kg": "bonus_per_kg"},
        "unique": (Unique(("marbling_score",)),),
    },
    "Company_Settings": {"sort": ("ModuleName",), "unique": (Unique(("setting_key",)),)},
    "CommodContracts": {
        "mirror": {
            "Start_date": ("delivery_from",),
            "End_date": ("delivery_to",),
            "Price_ton": ("price_per_tonne",),
            "Wght_contracted": ("quantity_ordered",),
            "Wght_delivered": ("quantity_delivered",),
        }
    },
    "Period_Stocks_Closing_Balance": {"rename": {"Stock_value": "closing_value", "Stock_Tons_Weight": "closing_qty"}},
    "Pen_Feeding_Order_Params": {"sort": ("Ration_Type",), "unique": (Unique(("ration_type",)),)},
    "Pen_and_Bunk_Cleaning_Master": {"rename": {"Date_Pen_Cleaned": "event_date", "Comments": "notes"}},
    "Pen_and_Bunk_Cleaning": {"rename": {"Date_Pen_Cleaned": "event_date", "Comments": "notes"}},
    "Commodities": {
        "sort": ("Commodity_Code",),
        "rename": {"Commod_Name": "commodity_name"},
        "unique": (Unique(("commodity_code",)),),
    },
    "Date_Design_Last_Updated": {"where": lambda df: F.col("ID") == 1, "expect": ("ID",)},
    "PensFileIsOpen": {
        "where": lambda df: F.col("ID") == 1,
        "expect": ("ID",),
        "rename": {"Is_Open": "pens_file_is_open"},
        "kind": {"pens_file_is_open": "text"},
    },
    "Bunk_Readings": {"static": {"origin": "cfr"}},
    "Ration_Regimes": {"sort": ("ID",), "unique": (Unique(("pen_id", "feed_date")),)},
    "Pen_Split_Rations": {"sort": ("ID",), "unique": (Unique(("pen_id", "feed_date")),)},
    "PenFeedsData": {
        "sort": ("ID",),
        "rename": {"Number_Cattle": "head_fed", "Feed_Weight": "kgs_fed", "Ration_Value_per_Ton": "cost_per_tonne"},
        "kind": {"feed_date": "event_date", "applied_to_cattle": "bool"},
        "expect": ("Feed_Date", "Applied_to_cattle"),
        "unique": (Unique(("pen_number_id", "feed_date", "ration_code"), "applied_to_cattle = false"),),
    },
    "CommodTrans": {"kind": {"trans_date": "event_date"}, "expect": ("Trans_Date",)},
    "Manure_From_Locations": {"static": {"direction": "from"}},
    "Manure_To_Locations": {"static": {"direction": "to"}},
    "Digistar_Data_History": {
        "kind": {"feed_date": "event_date", "load_number": "num"},
        "expect": ("Feed_date",),
    },
    "Costs_Feed_Detail": {
        "kind": {"date_fed": "event_date", **_kinds("bool", "paddock_feed forced_application")},
        "expect": ("Date_Fed",),
    },
    "Carcase_DataType2": {"rename": {"leftSideScanTime": "leftsidescanttime"}},
}


def _allowed(target: str) -> tuple[Rule, ...]:
    return tuple(Rule(c, text, c) for c, text in ALLOWED.get(target, {}).items())


def _spec(order: int, database: str, source: str, target: str) -> TableSpec:
    found = DETAILS.get(f"{source}->{target}") or DETAILS.get(source) or {}
    details = dict(found)
    details["rename"] = {"ID": "legacy_id", **details.get("rename", {})} if "ID" not in details.get("rename", {}) else details["rename"]
    details["required"] = tuple(REQUIRED.get(target, "").split())
    details["rules"] = _allowed(target)
    if target in BY_YEAR:
        details["years"] = (BY_YEAR[target], FIRST_YEAR, LAST_YEAR)
    without = tuple(details.get("without", ()))
    details["without"] = without if source in ANIMAL_TABLES else (*without, "cattle.cows")
    return TableSpec(source, target, order, database, split_words=source in SPLIT_AT_CAPITALS, **details)


def _all() -> list[TableSpec]:
    out = []
    for (order, database, schema), names in PLACES.items():
        for entry in names.split():
            source, _, other = entry.partition(":")
            out.append(_spec(order, database, source, f"{schema}.{other or source.lower()}"))
    for variant in FEEDING_VARIANTS:
        for part in ("Details", "Regimens"):
            spec = _spec(20, "feed", f"{variant}_Feeding_{part}", f"feed.feeding_{part.lower()}")
            out.append(TableSpec(**{**spec.__dict__, "static": {"variant": variant}}))
    return sorted(out, key=lambda s: s.order)


SPECS: tuple[TableSpec, ...] = tuple(_all())
