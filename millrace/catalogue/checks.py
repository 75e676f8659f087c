"""What the standard reports look at."""

from __future__ import annotations

from millrace.plans.reports import ForeignKey

# Key and date columns of the core source tables.
PROFILE_META: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "Breeds": ("Breed_Code", ()),
    "FeedDB_Pens_File": ("Pen_name", ()),
    "Contacts": ("Contact_ID", ("Last_Modified_timestamp",)),
    "Diseases": ("Disease_ID", ()),
    "Drugs": ("Drug_ID", ("Last_Modified_timestamp",)),
    "Cost_Codes": ("RevExp_Code", ()),
    "Market_Category": ("Market_Cat_ID", ()),
    "Purchase_Lots": ("ID", ("Purchase_date", "Last_Modified_timestamp")),
    "Cattle": ("BeastID", ("Start_Date", "Sale_Date", "DOB", "Feedlot_Entry_Date", "Date_Archived", "Date_died")),
    "Weighing_Events": (None, ("Weigh_date",)),
    "PensHistory": (None, ("MoveDate",)),
    "Drugs_Given": (None, ("Date_Given",)),
    "Costs": ("ID", ("Cost_Date",)),
    "Sick_Beast_Records": ("SB_Rec_No", ("Date_Diagnosed", "Date_Recovered_Died")),
    "Carcase_data": ("Beast_ID", ("Kill_Date",)),
    "Autopsy_Records": ("SB_Rec_No", ("Date_Dead", "Date_Autopsy")),
    "Vendor_Declarations": ("Vendor_Dec_Number", ("Form_Date",)),
    "Drugs_Purchased": ("Receival_ID", ("Expiry_date",)),
    "Drug_Disposal": ("Disposal_ID", ("Date_disposed",)),
}

# References checked after a load.
FOREIGN_KEYS = (
    ForeignKey("weighing.weighing_events", "beast_id", "cattle.cows", "id"),
    ForeignKey("pen.penshistory", "beast_id", "cattle.cows", "id"),
    ForeignKey("health.drugs_given", "beast_id", "cattle.cows", "id"),
    ForeignKey("health.drugs_given", "drug_id", "health.drugs", "id"),
    ForeignKey("finance.costs", "beast_id", "cattle.cows", "id"),
    ForeignKey("health.sick_beast_records", "beast_id", "cattle.cows", "id"),
    ForeignKey("purchasing.purchase_lots", "vendor_id", "contacts.contacts", "contact_id"),
    ForeignKey("purchasing.purchase_lots", "agent_code", "contacts.contacts", "contact_id"),
    ForeignKey("feed.vendor_declarations", "owner_contact_id", "contacts.contacts", "contact_id"),
    ForeignKey("carcase.carcase_data", "beast_id", "cattle.cows", "id"),
    ForeignKey("health.autopsy_records", "beast_id", "cattle.cows", "id"),
    ForeignKey("health.drugs_purchased", "drugid", "health.drugs", "drug_id"),
    ForeignKey("health.drug_disposals", "drugid", "health.drugs", "drug_id"),
)

# Targets whose animal reference must have its new id beside it.
ANIMAL_TARGETS = (
    "weighing.weighing_events",
    "pen.penshistory",
    "health.drugs_given",
    "finance.costs",
    "health.sick_beast_records",
    "carcase.carcase_data",
    "health.autopsy_records",
)

# Columns of the animal table that were renamed, and columns that should be gone.
STRANDED_PAIRS = (
    ("start_weight", "start_weight_kg"),
    ("sale_weight", "sale_weight_kg"),
    ("feedlot_entry_wght", "feedlot_entry_weight_kg"),
    ("whold_until", "withhold_until"),
    ("esi_whold_until", "esi_withhold_until"),
    ("background_doll_per_kg", "background_cost_per_kg"),
    ("last_modified_timestamp", "legacy_modified_at"),
    ("vendorid", "vendor_id"),
    ("agentid", "agent_id"),
    ("customfeedownerid", "custom_feed_owner_id"),
    ("current_loctype_id", "current_loc_type_id"),
    ("growergroupcode", "grower_group_code"),
    ("vendor_ear_tag", "previous_ear_tag"),
)
STALE_COLUMNS = (
    *(old for old, _ in STRANDED_PAIRS),
    "tag_number",
    "agist_charged_up_to_date",
    "dna_or_blood_number",
    "nfas_decl_numb",
    "nlis_tag_fail_at_induction",
    "pregtested",
    "breed",
)

COST_GROUP = ("cow_id", "revexp_code", "ration")
