"""References that apply to every target with a column of that name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import canonical_text, trimmed
from millrace.functions.names import lower_name
from millrace.operators.joins import left_lookup
from millrace.spec import Reader, Reference

# Columns that hold a contact's id, a drug's or disease's id, an animal's id.
CONTACT_COLUMNS = (
    "vendor_id",
    "agent_code",
    "sold_to_contact_id",
    "abattoir_id",
    "agent_id",
    "buyer_id",
    "supplier_id",
    "agistor_code",
    "cattle_owner_id",
    "custom_feed_owner_id",
    "owner_contact_id",
    "supplier_ac_no",
    "carrier_id",
    "origin_dest_id",
)
DRUG_COLUMNS = ("drug_id", "drugid")
ANIMAL_COLUMNS = ("beastid", "beast_id")
# Fixed value: a header that found its way into the breed list.
JUNK_BREEDS = ("Breed Name",)


def breed_labels(reader: Reader, scope: list[str]) -> DataFrame | None:
    """Breed code -> label."""
    lookups = reader("system.lookups")
    if lookups is None or "label" not in lookups.columns:
        return None
    code = F.nullif(trimmed(canonical_text(F.col("code"), lookups.schema["code"].dataType)), F.lit(""))
    rows = lookups.where(F.col("category") == "breed").select(*scope, code.alias("_key"), F.col("label").alias("_value"))
    return rows.where("_key IS NOT NULL").groupBy(*scope, "_key").agg(F.max("_value").alias("_value"))


def breed_ids(reader: Reader, scope: list[str]) -> DataFrame | None:
    """Breed code -> label -> id; labels meet breed names trimmed and in any letter case."""
    labels, breeds = breed_labels(reader, scope), reader("cattle.breeds")
    if labels is None or breeds is None:
        return None
    names = breeds.select(*scope, lower_name("name").alias("_name"), F.col("id").alias("_id"))
    names = names.where("_name IS NOT NULL").groupBy(*scope, "_name").agg(F.max("_id").alias("_id"))
    coded = labels.withColumn("_name", lower_name("_value")).drop("_value")
    return left_lookup(coded, names, [*scope, "_name"], "inner").select(*scope, "_key", F.col("_id").alias("_value"))


def breed_names(reader: Reader, scope: list[str]) -> DataFrame | None:
    labels = breed_labels(reader, scope)
    return None if labels is None else labels.where(~F.col("_value").isin(*JUNK_BREEDS))


SHARED: tuple[Reference, ...] = (
    *(Reference(c, "health.drugs", "drug_id") for c in DRUG_COLUMNS),
    Reference("disease_id", "health.diseases", "disease_id"),
    *(Reference(c, "contacts.contacts", "contact_id") for c in CONTACT_COLUMNS),
    Reference("breed_id", "cattle.breeds", build=breed_ids),
    *(Reference(c, "cattle.cows", "legacy_beast_id", "id", required=True, also="cow_id") for c in ANIMAL_COLUMNS),
)

DRUG_ROW = Reference("drug_id", "health.drugs", "drug_id", "id")
CHEMICAL_DRUG_ROW = Reference("chemical_drug_id", "health.drugs", "drug_id", "id")
COST_CODE_ROW = Reference("revexp_code", "finance.cost_codes", "revexp_code", "id", into="cost_code_id")
PEN_ROW = Reference("pen_number", "pen.pens", "name", "id", names=True, into="pen_id")
LOT_ROW = Reference("purch_lot_no", "purchasing.purchase_lots", "lot_number", "id", into="purchase_lot_id")
BREED_NAME = Reference("breed", "system.lookups", build=breed_names)
