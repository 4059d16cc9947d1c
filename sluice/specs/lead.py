"""Contracts of the three lead tables (examples of ``TableSpec``).

Column names, types and source spellings are fixed values: they must equal
the source system's tables and the warehouse tables the rows are loaded into.
"""

from __future__ import annotations

from sluice.functions.fixed import DEFAULT_SOURCE_ZONE
from sluice.spec import AuditSpec, TableSpec, make_spec

# --- fixed values: keep exactly as written ---------------------------------

# (source column, target column, type) of lead, in load order
LEAD_COLUMNS = [
    ("leadguid", "LEAD_GUID", "string"),
    ("legacyleadid", "LEGACY_LEAD_ID", "string"),
    ("individ", "INDIV_ID", "string"),
    ("hhid", "HH_ID", "string"),
    ("addrid", "ADDR_ID", "string"),
    ("leadcode", "LEAD_CODE", "string"),
    ("leadtypeid", "LEAD_TYPE_ID", "decimal(38,0)"),
    ("leadtype", "LEAD_TYPE", "string"),
    ("leadsource", "LEAD_SOURCE", "string"),
    ("leadcreatedate", "LEAD_CREATE_DATE", "timestamp"),
    ("firstname", "FIRST_NAME", "string"),
    ("middlename", "MIDDLE_NAME", "string"),
    ("lastname", "LAST_NAME", "string"),
    ("suffix", "SUFFIX", "string"),
    ("birthdate", "BIRTH_DATE", "string"),
    ("age", "AGE", "decimal(38,0)"),
    ("sex", "SEX", "string"),
    ("street1", "STREET_1", "string"),
    ("street2", "STREET_2", "string"),
    ("city", "CITY", "string"),
    ("stateid", "STATE_ID", "decimal(38,0)"),
    ("state", "STATE", "string"),
    ("zip", "ZIP", "string"),
    ("zip5", "ZIP5", "string"),
    ("county", "COUNTY", "string"),
    ("country", "COUNTRY", "string"),
    ("phone", "PHONE", "string"),
    ("homephone", "HOME_PHONE", "string"),
    ("cellphone", "CELL_PHONE", "string"),
    ("workphone", "WORK_PHONE", "string"),
    ("donotcall", "DO_NOT_CALL", "string"),
    ("callerid", "CALLER_ID", "string"),
    ("email", "EMAIL", "string"),
    ("dynamiclead", "DYNAMIC_LEAD", "string"),
    ("prospectid", "PROSPECT_ID", "string"),
    ("extpartnerid", "EXT_PARTNER_ID", "string"),
    ("channelid", "CHANNEL_ID", "decimal(38,0)"),
    ("channel", "CHANNEL", "string"),
    ("optsourceid", "OPT_SOURCE_ID", "string"),
    ("sourceid", "SOURCE_ID", "decimal(38,0)"),
    ("subsourceid", "SUB_SOURCE_ID", "boolean"),
    ("sourceofreferral", "SOURCE_OF_REFERRAL", "string"),
    ("division", "DIVISION", "string"),
    ("leadsubsource", "LEAD_SUB_SOURCE", "string"),
    ("leadsubsourceid", "LEAD_SUB_SOURCE_ID", "string"),
    ("lender", "LENDER", "string"),
    ("loanamount", "LOAN_AMOUNT", "string"),
    ("loandate", "LOAN_DATE", "date"),
    ("diabetes", "DIABETES", "string"),
    ("healthproblems", "HEALTH_PROBLEMS", "string"),
    ("heartproblems", "HEART_PROBLEMS", "string"),
    ("height", "HEIGHT", "string"),
    ("highbpchol", "HIGH_BP_CHOL", "string"),
    ("isinsured", "IS_INSURED", "string"),
    ("smoker", "SMOKER", "string"),
    ("occupation", "OCCUPATION", "string"),
    ("spouse", "SPOUSE", "string"),
    ("coborrowerage", "COBORROWER_AGE", "double"),
    ("coborrowerbirthdate", "COBORROWER_BIRTH_DATE", "timestamp"),
    ("coborrowerheight", "COBORROWER_HEIGHT", "string"),
    ("coborroweronmortgage", "COBORROWER_ON_MORTGAGE", "string"),
    ("coborrowername", "COBORROWER_NAME", "string"),
    ("coborrowerrelation", "COBORROWER_RELATION", "string"),
    ("coborrowersex", "COBORROWER_SEX", "string"),
    ("coborrowersmoker", "COBORROWER_SMOKER", "string"),
    ("coborrowerweight", "COBORROWER_WEIGHT", "string"),
    ("coborroweroccupation", "COBORROWER_OCCUPATION", "string"),
    ("datasource", "DATA_SOURCE", "string"),
    ("leadoriginurl", "LEAD_ORIGIN_URL", "string"),
    ("mailingid", "MAILING_ID", "string"),
    ("suspectcampaignid", "SUSPECT_CAMPAIGN_ID", "decimal(38,0)"),
    ("consumerdebt", "CONSUMER_DEBT", "double"),
    ("mortgagedebt", "MORTGAGE_DEBT", "string"),
    ("utmcampaign", "UTM_CAMPAIGN", "string"),
    ("utmmedium", "UTM_MEDIUM", "string"),
    ("utmsource", "UTM_SOURCE", "string"),
    ("referringurl", "REFERRING_URL", "string"),
    ("pcspoliciesid", "PCS_POLICIES_ID", "decimal(38,0)"),
    ("createdate", "CREATE_DATE", "timestamp"),
    ("modifydate", "MODIFY_DATE", "timestamp"),
    ("sourcetable", "SOURCE_TABLE", "string"),
    ("isdeletedsource", "IS_DELETED_SOURCE", "string"),
    ("expdate", "EXP_DATE", "timestamp"),
    ("sourcetype", "SOURCE_TYPE", "string"),
    ("sourcetypeid", "SOURCE_TYPE_ID", "decimal(38,0)"),
    ("producttype", "PRODUCT_TYPE", "string"),
    ("leadattributes", "LEAD_ATTRIBUTES", "string"),
    ("custodytargetaudience", "CUSTODY_TARGET_AUDIENCE", "string"),
    ("source", "SOURCE", "string"),
    ("producttypeid", "PRODUCT_TYPE_ID", "decimal(38,0)"),
    ("leadsourceid", "LEAD_SOURCE_ID", "string"),
    ("originsystemid", "ORIGIN_SYSTEM_ID", "string"),
    ("originsystem", "ORIGIN_SYSTEM", "string"),
    ("originsystem_orig", "ORIGIN_SYSTEM_ORIG", "string"),
    ("leadingestionmethod", "LEAD_INGESTION_METHOD", "string"),
]

# (source column, target column, type) of lead_xref, in load order
LEAD_XREF_COLUMNS = [
    ("leadxrefguid", "LEAD_XREF_GUID", "string"),
    ("legacyleadid", "LEGACY_LEAD_ID", "string"),
    ("leadcode", "LEAD_CODE", "string"),
    ("leadlevelid", "LEAD_LEVEL_ID", "string"),
    ("leadlevel", "LEAD_LEVEL", "string"),
    ("datasourceid", "DATA_SOURCE_ID", "string"),
    ("leveldate", "LEVEL_DATE", "timestamp"),
    ("createdate", "CREATE_DATE", "timestamp"),
    ("modifydate", "MODIFY_DATE", "timestamp"),
    ("availableforpurchaseind", "AVAILABLE_FOR_PURCHASE_IND", "string"),
    ("isdeletedsource", "IS_DELETED_SOURCE", "string"),
    ("leadlevelalias", "LEAD_LEVEL_ALIAS", "string"),
]

# (source column, target column, type) of lead_assignment, in load order
LEAD_ASSIGNMENT_COLUMNS = [
    ("leadassignmentguid", "LEAD_ASSIGNMENT_GUID", "string"),
    ("leadxrefguid", "LEAD_XREF_GUID", "string"),
    ("agentcode", "AGENT_CODE", "string"),
    ("purchasedate", "PURCHASE_DATE", "timestamp"),
    ("purchaseprice", "PURCHASE_PRICE", "double"),
    ("assigndate", "ASSIGN_DATE", "timestamp"),
    ("inactiveind", "INACTIVE_IND", "string"),
    ("status", "STATUS", "string"),
    ("agentextuid", "AGENT_EXTUID", "string"),
    ("allocateind", "ALLOCATE_IND", "string"),
    ("comments", "COMMENTS", "string"),
    ("sfgdirectagentid", "SFG_DIRECT_AGENT_ID", "string"),
    ("baseshopowneragentid", "BASE_SHOP_OWNER_AGENT_ID", "string"),
    ("totaluplineagentcodes", "TOTAL_UPLINE_AGENT_CODES", "string"),
    ("unpaidind", "UNPAID_IND", "string"),
    ("appcount", "APP_COUNT", "string"),
    ("appapv", "APP_APV", "string"),
    ("actualappcount", "ACTUAL_APP_COUNT", "string"),
    ("actualapv", "ACTUAL_APV", "string"),
    ("createdate", "CREATE_DATE", "timestamp"),
    ("modifydate", "MODIFY_DATE", "timestamp"),
    ("sourcetable", "SOURCE_TABLE", "string"),
    ("metadata", "METADATA", "string"),
    ("statusdate", "STATUS_DATE", "timestamp"),
    ("isdeletedsource", "IS_DELETED_SOURCE", "boolean"),
    ("ordernumber", "ORDER_NUMBER", "string"),
    ("leadstatusid", "LEAD_STATUS_ID", "string"),
    ("leadstatus", "LEAD_STATUS", "string"),
    ("hqpurchaseamount", "HQ_PURCHASE_AMOUNT", "double"),
    ("leadordersystemid", "LEAD_ORDER_SYSTEM_ID", "string"),
    ("leadordersystem", "LEAD_ORDER_SYSTEM", "string"),
    ("ordersystemid", "ORDER_SYSTEM_ID", "string"),
    ("ordersystem", "ORDER_SYSTEM", "string"),
    ("ordersystemorig", "ORDER_SYSTEM_ORIG", "string"),
    ("exclusivityenddate", "EXCLUSIVITY_END_DATE", "timestamp"),
]
# Second spelling of one source column seen in another extract.
LEAD_ASSIGNMENT_ALIASES = {"ordersystem_orig": "ORDER_SYSTEM_ORIG"}

# Key column per table.
LEAD_KEY = "STG_LCR_LEAD_KEY"
LEAD_XREF_KEY = "STG_LCR_LEAD_XREF_KEY"
LEAD_ASSIGNMENT_KEY = "STG_LCR_LEAD_ASSIGNMENT_KEY"

# Columns holding JSON text, and string columns holding boolean tokens.
LEAD_JSON_COLUMNS = ("LEAD_ATTRIBUTES",)
LEAD_ASSIGNMENT_JSON_COLUMNS = ("METADATA",)
BOOLEAN_STRING_COLUMNS = ("IS_DELETED_SOURCE",)

# Timestamps of lead_assignment whose future values are clamped to the run time.
LEAD_ASSIGNMENT_CLAMPED = (
    "PURCHASE_DATE",
    "ASSIGN_DATE",
    "CREATE_DATE",
    "MODIFY_DATE",
    "STATUS_DATE",
    "EXCLUSIVITY_END_DATE",
)

# Table names in the order they are processed.
TABLE_ORDER = ("lead_assignment", "lead_xref", "lead")

# Source tables copied by the sync, in order, and the warehouse name prefix.
SOURCE_TABLES = ('public."leadassignment"', 'public."leadxref"', 'public."lead"')
WAREHOUSE_PREFIX = "STG_"

# --- end of fixed values -----------------------------------------------------


def lead_specs(source_system: str = "SOURCE_SYSTEM", time_zone: str | None = DEFAULT_SOURCE_ZONE,
               audit: AuditSpec | None = None) -> dict[str, TableSpec]:
    """The three contracts, keyed by table name, in processing order."""
    audit = audit or AuditSpec(source_system=source_system)
    lead = make_spec(
        "lead", LEAD_KEY, LEAD_COLUMNS, json_cols=LEAD_JSON_COLUMNS,
        bool_string_cols=BOOLEAN_STRING_COLUMNS, audit=audit, time_zone=time_zone,
    )
    xref = make_spec(
        "lead_xref", LEAD_XREF_KEY, LEAD_XREF_COLUMNS,
        bool_string_cols=BOOLEAN_STRING_COLUMNS, audit=audit, time_zone=time_zone,
    )
    assignment = make_spec(
        "lead_assignment", LEAD_ASSIGNMENT_KEY, LEAD_ASSIGNMENT_COLUMNS,
        aliases=LEAD_ASSIGNMENT_ALIASES, json_cols=LEAD_ASSIGNMENT_JSON_COLUMNS,
        bool_string_cols=BOOLEAN_STRING_COLUMNS,
        future_policy={c: "clamp" for c in LEAD_ASSIGNMENT_CLAMPED},
        audit=audit, time_zone=time_zone,
    )
    by_name = {"lead": lead, "lead_xref": xref, "lead_assignment": assignment}
    return {name: by_name[name] for name in TABLE_ORDER}
