"""A small farm: one or a few rows per core table, with the edge cases the load has to handle."""

from datetime import date

D = date(2024, 1, 15)

TABLES = {
    ("Breeds", "main"): ("Breed_Code int, Breed_Name string", [(1, "Angus"), (2, " hereford "), (3, "Breed Name"), (4, None)]),
    ("FeedDB_Pens_File", "main"): (
        "Pen_name string, IsPaddock string, Include_in_Pen_List int, Current_exit_pen boolean",
        [("  FP01  ", "Y", 1, True), ("  ", "N", 0, False)],
    ),
    ("Contacts", "main"): (
        "Contact_ID int, Company string, First_Name string, Salutation string, Notes string, Contact_Type int",
        [(1, "Gold Corp", "Jane", "Ms", "a\0b", 3), (2, "Silver", None, None, None, 11)],
    ),
    ("Diseases", "main"): (
        "Disease_ID int, Disease_Name string, No_longer_used boolean",
        [(1, "BRD", False), (2, "Lame", True), (3, "BRD", False), (4, None, False)],
    ),
    ("Drugs", "main"): (
        "Drug_ID int, Drug_Name string, Units string, WithHold_days_1 int, HGP string, Inactive boolean",
        [(10, "Draxxin", "mL", 30, "N", False), (11, "Bovilis", "mL", None, "Y", True), (12, "bovilis", "mL", 0, None, None)],
    ),
    ("Cost_Codes", "main"): (
        "RevExp_Code int, RevExp_Desc string, Rev_Exp string",
        [(1, "Feed", "-"), (8, "Sale", "+"), (9, None, "+")],
    ),
    ("Market_Category", "main"): (
        "Market_Cat_ID int, Market_Category string, Min_DOF int, HGP_Free boolean",
        [(1, "Grain-fed", 100, False)],
    ),
    ("RationNames", "main"): ("Ration_name string, ValuePerTon double", [("Starter", 200.0), ("Finisher", 300.0)]),
    ("Manure_Types", "feed"): ("ID int, Manure_Type string", [(1, "Dry")]),
    ("Ration_Descriptions", "feed"): (
        "Ration_Code int, Ration_Name string, Current_Value_Kg double",
        [(5, "Grower", 0.3), (5, "Grower again", 0.4)],
    ),
    ("Pens_File", "feed"): (
        "Pen_Number_ID int, Pen_Name string, IsPaddock string, DateEnteredFeedlot timestamp",
        [(7, "P01", "N", None), (9, "P02", "Y", None)],
    ),
    ("Ration_Load_Sizes", "feed"): (
        "Ration_Type_ID int, Truck_Size_1_Wght double, Truck_Size_2_Wght double, Truck_Size_10_Wght double",
        [(1, 100.0, None, 900.0), (2, None, None, None)],
    ),
    ("Pen_Feeding_Order_Params", "feed"): ("Ration_Type int, DATA0 int, DATA59 int", [(1, 3, 4), (2, None, 5)]),
    ("Purchase_Lots", "main"): (
        "ID int, Lot_Number string, Purchase_date date, Vendor_ID int, Agent_Code int, Number_Head int, Buyer string",
        [(1, "L001", D, 1, 0, 50, "2"), (2, "  ", D, 99, None, 10, None)],
    ),
    ("Treatment_Regimes", "main"): (
        "ID int, DiseaseID int, Day_Numb int, Drug_Name string, Dose double, DoseByWeight string, Drug_ID int",
        [(1, 1, 1, "Draxxin", 2.5, "N", 10), (2, 1, 3, "Bovilis", 1.0, "Y", 11), (3, 77, 1, "Draxxin", 4.0, "N", 10)],
    ),
    ("Cattle", "main"): (
        """BeastID long, Ear_Tag string, EID string, Breed int, Sex string, Died boolean, Start_Date date,
        Start_Weight double, Sale_Date string, Feedlot_Entry_Date date, Pen_Number string, Purch_Lot_No string,
        Date_Archived date, VendorID int""",
        [
            (100, "A001", "E1", 1, "S", False, D, 300.0, None, D, " p01 ", "L001", None, 1),
            (100, "A001", "E1", 1, "S", False, D, 290.0, None, date(2023, 1, 1), "P02", "L001", None, 1),
            (101, "A001", "E2", 2, "F", False, D, 310.0, "15/02/2024", D, "P02", None, None, 0),
            (102, "A002", "E 1", 1, "B", False, D, 310.0, None, D, "Back paddock", None, None, 55),
            (103, "Ear Tag", "", 1, "B", False, D, 310.0, None, D, None, None, None, None),
            (104, "Gold Farm", None, 1, "B", False, D, 0.0, None, D, None, None, None, None),
            (105, "A003", None, 9, None, True, D, 1.0, None, D, "P01", "none", D, None),
        ],
    ),
    ("Sick_Beast_Records", "main"): (
        "SB_Rec_No int, Beast_ID long, Date_Diagnosed date, Disease_ID int, Result_Code int, Autopsied string",
        [(1, 100, D, 1, 1, "Y"), (2, 100, None, 1, 1, "N"), (3, 101, D, 99, 2, None)],
    ),
    ("Weighing_Events", "main"): (
        "ID long, BeastID long, Weighing_Type int, Weigh_date date, Weight double, P8_Fat int, Weigh_Note string",
        [(1, 100, 1, D, 300.0, 5, "intake"), (2, 999, 1, D, 300.0, 5, None), (3, 100, 2, None, 301.0, None, None),
         (4, 101, 3, D, None, None, None), (5, None, 4, D, 3.0, None, None), (6, 100, 1, D, -1.0, None, None)],
    ),
    ("PensHistory", "main"): ("ID long, BeastID long, MoveDate date, Pen string", [(1, 100, D, "P01")]),
    ("Drugs_Given", "main"): (
        "ID long, BeastID long, Drug_ID int, Units_Given double, Date_Given date, SB_Rec_No int",
        [(1, 100, 11, 2.5, D, 1), (2, 100, 50, -1.0, None, 0)],
    ),
    ("Costs", "main"): (
        "ID long, BeastID long, RevExp_Code int, Trans_Date date, Rev_Exp_per_Unit double, Units double, Extended_RevExp double",
        [(1, 100, 8, D, 2.5, 100.0, 250.0), (2, 100, 77, D, 2.5, None, 5.0), (3, 100, 1, D, 1.0, 1.0, None)],
    ),
    ("Breeding_Sires", "main"): ("Sire_ID int, Breed int, EID string", [(1, 1, "x"), (2, 3, "y"), (1, 2, "z")]),
    ("Beast_Ohead_Appl_History", "main"): (
        "ID int, `Ohead_$/Hd/Day` double, `Ohead_$/Hd/Day_Pen1` double",
        [(1, 2.5, 3.0)],
    ),
    ("Feedlot_Staff", "main"): (
        "User_ID int, Surname string, FirstName string, Pass_word string, Pen_Rider string",
        [(1, "Lee", "Ann", "secret", "Y")],
    ),
    ("PensFileIsOpen", "feed"): ("ID int, Is_Open string", [(1, "no"), (2, "yes")]),
    ("Commodities", "feed"): (
        "Commodity_Code int, Commod_Name string, Shrinkage_Factor double",
        [(1, "Bad", 7.0), (1, "Barley", 0.5), (2, "Oats", None)],
    ),
    ("ContactsContactTypes", "main"): ("ID int, Contact_ID int, Contact_Type_ID int", [(1, 1, 3), (2, 1, 3), (3, None, 3)]),
    ("GE150_Feeding_Details", "feed"): ("Rec_ID int, Day_No int, Amount double", [(1, 1, 2.0)]),
    ("WAGYU_Feeding_Details", "feed"): ("Rec_ID int, Day_No int, Amount double", [(1, 1, 3.0), (2, 2, 4.0)]),
    ("Pen_DOF", "main"): ("Pen string, DOF int, Pic binary", [("P01", None, b"abc")]),
}


def build(spark):
    return {key: spark.createDataFrame(rows, schema) for key, (schema, rows) in TABLES.items()}
