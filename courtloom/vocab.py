"""Vocabulary of the court records.

Every literal below is a fixed value: results are only right if it is spelt exactly so.
"""

# Search form domains.
COMPANY_CODES = {"Y": "Company", "N": "Person"}
CASE_CATEGORIES = ("CIVIL", "CRIMINAL", "TRAFFIC", "CP")
COURT_CODES = {"C": "Circuit", "D": "District"}
SORT_LINK_MARK = "inquiry-results"

# Markup of a case page.
IGNORED_CLASS = "AltBodyWindowDcCivil"
PROMPT_CLASSES = ("FirstColumnPrompt", "Prompt")
VALUE_CLASS = "Value"
STATEMENT_CLASS = "InfoChargeStatement"
BREAK_TAGS = ("hr", "h5", "h6", "i")
CHARGE_SUBHEADINGS = ("Disposition", "Jail", "Probation", "Fine", "Community Work Service")
NOISE_VALUE = "MONEY JUDGMENT"
TERM_PROMPTS = ("Jail Term", "Suspended Term", "UnSuspended Term", "Probation", "Supervised", "UnSupervised")
DEFAULT_TITLE = "Case Information"

# Section title -> table.
SECTION_TABLE = {
    "Case Information": "cases",
    "Plaintiff/Petitioner Information": "parties",
    "Plaintiff": "parties",
    "Surety": "parties",
    "Bond Remitter/Bondsman": "parties",
    "Officer - Arresting/Complainant": "parties",
    "Attorney(s) for the Plaintiff/Petitioner": "attorneys",
    "Attorney(s) for the Plaintiff": "attorneys",
    "Defendant/Respondent Information": "parties",
    "Defendant Information": "parties",
    "Defendant": "parties",
    "Attorney(s) for the Defendant/Respondent": "attorneys",
    "Attorney(s) for the Defendant": "attorneys",
    "Court Scheduling Information": "events",
    "Case History Information": "events",
    "ORIGINAL JUDGMENT": "judgements",
    "Judgement Information": "judgements",
    "Related Person Information": "parties",
    "Related Persons Information": "parties",
    "Attorney(s) for the Related Person": "attorneys",
    "Charge and Disposition Information": "charges",
    "Charge Information": "charges",
    "Disposition": "charges",
    "Document Tracking": "documents",
    "Document Information": "documents",
    "Complaint Information": "complaints",
}

# Label -> attribute, where the attribute is not simply the label in snake case.
LABEL_ATTRIBUTE = {
    "Case Number": "case_id",
    "Citation Number": "case_id",
    "Case Type": "type",
    "Case Title": "title",
    "Claim Type": "type",
    "Case Disposition": "disposition",
    "Case Status": "status",
    "Complaint Status": "status",
    "Vs": "against",
    "Connection": "type",
    "Connection to Complaint": "type",
    "Party Type": "type",
    "Business or Organization Name": "bus_org_name",
    "Attorney's Firm": "practice_name",
    "AgencyName": "agency_name",
    "Zip Code": "zip",
    "Event Type": "type",
    "Event Date": "date",
    "Event Time": "time",
    "Charge Description": "description",
    "Vehicle State": "state",
    "Probable Cause Indicator": "probable_cause",
    "Contributed to Accident": "accident_contribution",
    "Convicted Speed": "recorded_speed",
    "Seat Belts Used": "seatbelts_used",
    "Personal Injury": "injuries",
    "Charge Class": "class",
    "Life/Death": "jail_extreme_punishment",
    "Suspended Term": "jail_suspended_term",
    "UnSuspended Term": "jail_unsuspended_term",
    "Probation": "probation_term",
    "Supervised": "probation_supervised_term",
    "UnSupervised": "probation_unsupervised_term",
    "First Pmt Due": "fine_first_pmt_due",
    "Hours": "cws_hours",
    "Complete By": "cws_deadline",
    "Report To": "cws_location",
    "Report Date": "cws_date",
    "Document Name": "name",
    "File Date": "filing_date",
    "Entered Date": "date",
    "Ordered Date": "date",
    "Judgement Interest": "interest",
    "PreJudgement Interest": "interest",
    "Is Awarded To The": "in_favor_of",
    "Amount": "amt",
    "Amount of Judgement": "amt",
}

# Attributes stored as flags, and the words that mean yes.
FLAG_ATTRIBUTES = (
    "probable_cause",
    "accident_contribution",
    "property_damage",
    "seatbelts_used",
    "mandatory_court_appearance",
)
YES_WORDS = ("y", "yes")

# Titles and party types that say whom somebody acts for.
ATTORNEY_TITLE = "Attorney(s) for the "
ATTORNEY_PARTY = "attorney for "
TITLED_PARTIES = ("Surety", "Bond", "Defendant", "Plaintiff", "Officer")
TITLE_SUFFIX = " Information"

# Outcome of a charge by disposition.
GUILTY = ("Guilty", "Guilty - Prepaid", "Nolo Contendere")
NOT_GUILTY = (
    "Abated by Death",
    "Compromise",
    "Court Dismissed Case",
    "Dismissed",
    "Judgment of Acquittal",
    "Nolle Prosequi",
    "Not Guilty",
)
IN_PROCESS = (
    "Probation Before Judgment",
    "Probation Before Judgment - 292",
    "Probation Before Judgment - 641",
    "Probation Before Judgment - Supervised",
    "Probation Before Judgment - Unsupervised",
    "Forwarded - Circuit Court",
    "Jury Trial Prayed",
    "Merged",
    "Merged with a Related Citation",
    "Stet",
)

# Spellings of the race field by bucket.
RACE_BUCKETS = {
    "black": (
        "BLACK, AFRICAN AMERICAN",
        "BLACK,AFRICAN AMERICAN",
        "Black",
        "BLACK",
        "African American",
        "African American/Black",
    ),
    "white": ("White", "Caucasian", "WHITE", "Caucasion"),
    "asian": (
        "Asian",
        "Other Asian",
        "ASIAN, NATIVE HAWAIIAN,OTHER PACIFIC ISLANDER",
        "ASIAN, NATIVE HAWAIIAN, OTHER PACIFIC ISLANDER",
        "Native Hawaiian or Other Pacific Islander",
        "INDIAN",
    ),
    "hispanic": ("Hispanic",),
    "other": (
        "WHITE, CAUCASIAN, ASIATIC INDIAN, ARAB",
        "WHITE,CAUCASIAN,ASIATIC INDIAN,ARAB",
        "UNKNOWN,OTHER",
        "Other",
        "UNKNOWN, OTHER",
        "Unavailable",
        "AMERICAN INDIAN, ALASKA NATIVE",
        "Indian",
        "UNKNOWN",
        "AMERICAN INDIAN,ALASKA NATIVE",
        "Unknown",
        "OTHER",
    ),
}

# Second part of the court system name by court type.
COURT_TYPE_BUCKETS = {"criminal": (" Criminal System", " Criminal"), "traffic": (" Traffic System",)}
UNKNOWN_COURT_TYPE = "courttype"

# Court families, in order of precedence when a case type belongs to several.
FAMILIES = ("criminal", "civil", "civil citation", "traffic")
EXCLUDED_PART = {"civil": "civil citation"}
